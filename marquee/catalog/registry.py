"""Named checks: a Spark query over the test tables and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from marquee.bindings import with_ctes
from marquee.session import tune

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    def register(function: Callable) -> Callable:
        @wraps(function)
        def run(spark, sf):
            return function(tune(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(ctes, sql)
        return function

    return register
