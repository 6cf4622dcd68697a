"""Shards by a weighted hash tree: regions hold racks, racks hold shards.

Every (document, shard) has a draw ``-ln(u) / weight`` from a hash; the draw of
a rack or region is the least below it, so it is exponential with the weight of
its whole subtree.  A document descends from the root, at each level into the
child with the least draw, and so reaches a shard with probability proportional
to the shard's weight.  When a weight changes, only the draws of that shard and
of the nodes above it change: documents move only into the shard (weight up,
new shard) or only out of it (weight down, removed), never between others.

A document costs one hash per shard, inside generated code, and no shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm.registry import documents, query
from marquee.session import materialise

SHARDS = 24
PER_RACK = 4
RACKS_PER_REGION = 2


class Shard(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = PER_RACK, racks_per_region: int = RACKS_PER_REGION) -> list[Shard]:
    """Shards of weight 1, filled rack by rack and region by region; a larger count only adds to it."""
    return [Shard(s // (per_rack * racks_per_region), s // per_rack, s) for s in range(shards)]


def _draw(key: Column, shard: Shard) -> Column:
    # 52 bits of the hash, moved off zero: u in (0, 1).
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(f"shard-{shard.shard}")), 12)
    return -F.log((bits + 0.5) / float(1 << 52)) / shard.weight


def place(key: Column, tree: list[Shard]) -> Column:
    """struct(region, rack, shard) that the key descends to.  NULL is a key like any other.

    Shards of weight 0 or less get nothing; at least one must have a weight.
    """
    leaves = [s for s in tree if s.weight > 0]
    if not leaves:
        raise ValueError("no shard has a weight")

    def least(children: list[Column]) -> Column:
        return F.least(*children) if len(children) > 1 else children[0]

    regions = []
    for region in sorted({s.region for s in leaves}):
        racks = []
        for rack in sorted({s.rack for s in leaves if s.region == region}):
            racks.append(least([
                F.struct(_draw(key, s).alias("draw"), F.lit(region).alias("region"), F.lit(rack).alias("rack"),
                         F.lit(s.shard).alias("shard"))
                for s in leaves if (s.region, s.rack) == (region, rack)]))
        regions.append(least(racks))
    won = least(regions)
    return F.struct(won["region"].alias("region"), won["rack"].alias("rack"), won["shard"].alias("shard"))


def with_slots(placed: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``slot``: each shard's rows counted from 0 without gaps.

    Rows are ranked within (shard, part), where ``part`` is a column of the
    written table that spreads a shard over many tasks; the parts' counts then
    give each its first slot.  No task holds a shard whole.
    """
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "part").orderBy(*order)
    ranked = placed.withColumn("rank", F.row_number().over(inside))
    return (ranked.join(first, ["shard", "part"])
            .withColumn("slot", (F.col("first") + F.col("rank") - 1).cast("long")).drop("first", "rank", "part"))


def shard_documents(docs: DataFrame, tree: list[Shard], grown: list[Shard] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, region, rack, shard, slot and, for a second tree, grown_shard.

    The id and the tree alone decide the shard.  NULL ids go to one shard; a
    NULL text counts as empty (size 8); repeated rows go to one shard and get a
    slot each; an empty table gives no rows.  Other columns are ignored.
    """
    # A literal first, so that a NULL id is hashed too.
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = F.coalesce(F.col("text"), F.lit(""))
    columns = [
        F.col("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), place(key, tree).alias("at"),
        (place(key, grown)["shard"] if grown else F.lit(None)).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("part")]
    placed = docs.select(*columns).select(
        "doc_id", "size", "text_crc32", "at.region", "at.rack", "at.shard", "grown_shard", "part")
    # Written once: both the counts and the ranks read the same parts.
    return with_slots(materialise(placed, "placed"), ["doc_id", "text_crc32", "size"])


@query("op4_hash_tree_shards")
def op4(spark, sf):
    """Every document's shard among 24 and among 25, by id alone, with its place in the shard."""
    out = shard_documents(documents(spark, sf), topology(SHARDS), topology(SHARDS + 1))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                      "region", "rack")
