"""Queries of this package and their SQL counterparts."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from importlib import import_module
from pathlib import Path

from marquee.session import tune

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
MODULES = ["chaining", "quantised", "licenses", "placement", "toxicity", "packing", "bagminhash", "lattice", "ledger",
           "pii", "collocations", "interactions", "linedup"]


def importable(spark):
    """Lets Python workers started from now on import this package from where the driver has it.

    A cluster ships the package its own way; there the added folder is merely absent.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for x in (environment, os.environ) for p in x.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def query(name: str, sql: str | None = None):
    def register(function: Callable) -> Callable:
        @wraps(function)
        def run(spark, sf):
            return function(importable(tune(spark)), sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def load_all() -> tuple[dict, dict]:
    """(queries, oracles) of every operator and of the pipeline."""
    for name in MODULES:
        import_module(f"marquee.llm.{name}")
    pipeline = import_module("corpus_pipeline")
    queries, oracles = dict(QUERIES), dict(ORACLES)
    queries["pipeline"] = pipeline.run
    if pipeline.ORACLE_SQL is not None:
        oracles["pipeline"] = pipeline.ORACLE_SQL
    return queries, oracles
