"""De-duplication, lookups and enrichment joins.

Row order never exists in Spark, so every "first" or "last" takes an explicit
order column list.  ``row_number() = 1`` filters plan as WindowGroupLimit: each
map task keeps at most one row per key before the shuffle, so a key that holds
a third of all rows still sends only one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise

SALTS = 16

#: Entries of a word list that is sent to every executor (some 20 MB).
FEW_WORDS = 200_000


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_top(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of every key, rank kept as ``rank``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def lookup(left: DataFrame, right: DataFrame, on: list[str], defaults: dict | None = None) -> DataFrame:
    """Left join onto a side that has one row per key, with defaults for misses."""
    joined = left.join(right, on, "left")
    return joined.na.fill(defaults) if defaults else joined


def written_lookup(left: DataFrame, right: DataFrame, on: list[str], label: str, defaults: dict | None = None) -> DataFrame:
    """``lookup`` for a side that is derived, and small as a rule: it is written first.

    Spark then knows its size before it plans the join: below the broadcast
    threshold the left side stays where it is, hot keys and all; beyond it both
    are shuffled and AQE splits the partitions of hot keys.
    """
    return lookup(left, materialise(right, label), on, defaults)


def merge_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a side that has a row for every row of the left: both are shuffled and merged.

    Such a side packs so well in a shuffle that Spark would take it for a small
    one, collect it in the driver and send it to every executor.
    """
    return left.join(right.hint("merge"), on, how)


def word_join(words: DataFrame, listed: DataFrame, on: str, label: str) -> DataFrame:
    """Inner join of exploded words with a word list, which is written and counted first.

    A list of up to ``FEW_WORDS`` goes to the words; beyond, both are shuffled.
    Without that Spark compares guesses: those of exploded text are far too low,
    and it would collect the words in the driver to send them to the list.
    """
    written = materialise(listed, label)
    return words.join(F.broadcast(written) if written.count() <= FEW_WORDS else written.hint("merge"), on)


def salted_lookup(left: DataFrame, right: DataFrame, on: list[str], salt_by: Column, how: str = "left",
                  salts: int = SALTS) -> DataFrame:
    """Lookup for a left side with hot keys (titles, names, genres).

    The left rows of one key spread over ``salts`` tasks; the right side, one
    row per key, is repeated once per salt.
    """
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def join_by_lower_title(left: DataFrame, right: DataFrame, value: str, row_id: str) -> DataFrame:
    """Case-insensitive title lookup; of titles that differ only in case the first in title order counts."""
    keyed = left.withColumn("_title", F.lower("title"))
    side = keep_first(right.withColumn("_title", F.lower("title")), ["_title"], ["title"])
    return salted_lookup(keyed, side.select("_title", value), ["_title"], F.col(row_id)).drop("_title")


def last_value(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the value with the highest order."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def enrich_overwrite(df: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Replace columns only on rows whose key has an update; of repeated updates the greatest row counts."""
    latest = F.struct(*[F.col(c) for c in columns])
    updates = updates.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(latest).alias("_u")).select(key, "_u.*")
    renamed = updates.select(key, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(renamed, key, "left")
    replaced = {c: F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(replaced).drop("_matched", *[f"_new_{c}" for c in columns])


def refresh_cache(ids: DataFrame, cache: DataFrame, fetch, key: str) -> DataFrame:
    """Cache plus freshly fetched rows for ids it lacks, each once; NULL ids are not fetched."""
    missing = ids.where(F.col(key).isNotNull()).dropDuplicates([key]).join(cache.select(key), key, "left_anti")
    return cache.unionByName(fetch(missing))


def pick_candidate(df: DataFrame, key: str, rank: str, comments: str, first: int = 5) -> DataFrame:
    """Of the first few candidates, the first one with comments, else the first."""
    shortlist = keep_top(df, [key], [F.col(rank)], first).drop("rank") if rank != "rank" else df.filter(
        F.col("rank") <= first)
    return keep_first(shortlist, [key], [(F.col(comments) > 0).cast("int").desc(), F.col(rank)])
