"""What filters do to one another: every order of five filters, from 32 states.

A document's failures are one mask of five bits, found in one pass.  Per part
the documents of a mask are one cell.  A Gray code visits all 32 sets of active
filters, toggling one filter at a time: each cell keeps the number of active
filters it fails, and only cells whose number leaves or reaches zero change the
running survivors.  The 32 states are stored; a step of any order is the
difference of two of them.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.registry import documents, query
from marquee.session import materialise

FILTERS = "ABCDE"
STATES = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["n", "good", "toxic"]

WORD = r"[^\x20\x09-\x0D]+"


def text_failures(text: Column) -> Column:
    """Bits A to D of a text: few words, few distinct words, capitals, symbols.  NULL is the empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long"),
        100 * capitals > 2 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]
    mask = F.lit(0)
    for bit, failed in enumerate(fails):
        mask = mask.bitwiseOR(F.when(failed, F.lit(1 << bit)).otherwise(F.lit(0)))
    return mask


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): the documents of every part by the filters they fail.

    ``part`` is ``source``, the empty string where that is NULL.  E fails where
    a row of a smaller id has an identical text (equal SHA-256): of the rows of
    the smallest id that has a text none fails, however many there are.  A NULL
    id is neither smaller nor larger, so its row never fails E and makes no
    other fail.  Several label rows of one id count as one that is good, or
    toxic, if any of them is; NULL ids have no labels.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    seen = materialise(docs.select(
        F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_failures(F.col("text")).alias("bits")), "failures")
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    known = seen.where("id IS NOT NULL").join(marks, "id", "left").na.fill(0, ["good", "toxic"])
    # Rows alike in all respects are one: whatever repeats, a key below is met once per id.
    alike = known.groupBy("digest", "id", "part", "bits", "good", "toxic").agg(F.count("*").alias("n"))
    # Each task sends the rows of its smallest id per text, so copies, however many, do not meet in one task.
    first = alike.withColumn("r", F.rank().over(Window.partitionBy("digest").orderBy("id"))).where("r = 1")
    kinds = ["part", "bits", "good", "toxic"]
    counted = lambda df, duplicate: df.groupBy(*kinds).agg(F.sum("n").alias("n")).select(
        *kinds, F.lit(duplicate).alias("duplicate"), "n")
    everyone = known.withColumn("n", F.lit(1).cast("long"))
    nameless = seen.where("id IS NULL").select("part", "bits", F.lit(0).alias("good"), F.lit(0).alias("toxic"),
                                               F.lit(1).cast("long").alias("n"))
    # All rows as duplicates, less the first ones, which come back as originals.
    signed = (counted(everyone, True).unionByName(counted(first, True).withColumn("n", -F.col("n")))
              .unionByName(counted(first, False)).unionByName(counted(nameless, False)))
    mask = F.col("bits").bitwiseOR(F.when(F.col("duplicate"), F.lit(16)).otherwise(F.lit(0)))
    return signed.groupBy("part", mask.alias("mask")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def gray_walk(table):
    """States of (parts, 32 masks, 3 counts): survivors (parts, 32 sets of active filters, 3 counts)."""
    import numpy as np

    parts = table.shape[0]
    states = np.zeros((parts, STATES, table.shape[2]), np.int64)
    failing = np.zeros(STATES, np.int64)  # per mask cell: active filters that it fails
    survivors, active = table.sum(axis=1), 0
    states[:, 0] = survivors
    masks = np.arange(STATES)
    for step in range(1, STATES):
        bit = step & -step  # the filter that a reflected Gray code toggles at this step
        hit = masks[masks & bit != 0]
        active ^= bit
        if active & bit:
            leaving = hit[failing[hit] == 0]
            failing[hit] += 1
            survivors = survivors - table[:, leaving].sum(axis=1)
        else:
            failing[hit] -= 1
            returning = hit[failing[hit] == 0]
            survivors = survivors + table[:, returning].sum(axis=1)
        states[:, active] = survivors
    return states


AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def audit(table: DataFrame) -> DataFrame:
    """All orders of the filters, step by step, for every part of ``cells``: 600 rows a part, none for no parts."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        bits = np.array([[1 << FILTERS.index(f) for f in order] for order in ORDERS])
        after = np.bitwise_or.accumulate(bits, axis=1)
        before = after ^ bits
        full = STATES - 1
        for batch in batches:
            rows = batch.column("cells").to_pylist()
            counts = np.zeros((len(rows), STATES, len(COUNTS)), np.int64)
            for k, row in enumerate(rows):
                for cell in row:
                    counts[k, cell["mask"]] = [cell[c] for c in COUNTS]
            states = gray_walk(counts)
            lost = states[:, before] - states[:, after]  # part, order, step, count
            n = states[..., 0]
            single = np.array([1 << FILTERS.index(f) for f in FILTERS])
            fails = n[:, [0]] - n[:, single]  # documents that fail the filter at all
            alone = n[:, full ^ single] - n[:, [full]]
            place = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
            shapley = np.zeros((len(rows), len(FILTERS)), np.int64)
            for f in range(len(FILTERS)):
                shapley[:, f] = lost[..., 0][:, place == f].sum(axis=1)
            each = len(ORDERS) * len(FILTERS)
            columns = [n[:, after], lost[..., 0], fails[:, place] - lost[..., 0], alone[:, place], lost[..., 1], lost[..., 2],
                       shapley[:, place]]
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p in batch.column("part").to_pylist() for _ in range(each)], pa.string()),
                pa.array([o for o in ORDERS for _ in FILTERS] * len(rows), pa.string()),
                pa.array(list(range(1, len(FILTERS) + 1)) * len(ORDERS) * len(rows), pa.int32()),
                *[pa.array(c.reshape(-1)) for c in columns]], names=[f.split()[0] for f in AUDIT.split(", ")])

    # At most 32 cells a part.
    per_part = table.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    return per_part.mapInArrow(run, AUDIT)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1
), m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN marks USING (doc_id)
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
), o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step - 1]) AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), steps AS (
  SELECT filter_order, step, bit, coalesce(earlier, 0)::BIGINT AS earlier FROM s
), cell AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY 1, 2
), r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & earlier > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cell CROSS JOIN steps GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""


@query("op12_gray_code_filters", ORACLE)
def op12(spark, sf):
    """The five filters in every order, for every source."""
    return audit(cells(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")))
