"""A cache of looked-up rows that outlives the run: a version per refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.operators.joins import refresh_cache
from marquee.sources.versions import Versions


def refresh(store: Versions, name: str, ids: DataFrame, fetch, key: str, version: str, empty: DataFrame) -> DataFrame:
    """The cache table ``name`` with the ids it lacked fetched, published as ``version`` and read back.

    ``empty`` has the schema and stands for the cache before its first version.
    Readers have the old version until the new one is whole; a refresh that
    failed, or is replayed, writes its version anew and fetches the same ids.
    """
    current = store.current()
    if current != version:
        cached = store.read(name) if current is not None else empty
        store.publish({name: refresh_cache(ids, cached, fetch, key)}, version)
    return store.read(name, version)
