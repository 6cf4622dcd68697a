"""Lines that many documents share, removed by levelled sorted runs of line hashes.

A run is a table of (line key hash, documents that hold it), hashed into a
fixed number of buckets and sorted within each.  Every batch of documents
becomes one run of level 0; as soon as a level holds ``fanout`` runs they are
merged into one of the next level, so n batches are kept in about log(n) runs
and a hash is rewritten about log(n) times.  Before a batch adds its own run it
is merge-anti-joined with the runs there are: a key that one of them has
settled (it holds the threshold already) needs no more counting and is left
out, so the commonest lines are stored once.  With a threshold of 1 every known
key is settled and a run holds the keys that its batch is the first to have.
All runs have equal buckets, so neither that join nor a merge shuffles a run.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from marquee.llm.registry import documents, query
from marquee.session import materialise, scratch_path

KEY = ["hi", "lo"]

#: Shared keys up to which they are sent to every task: 8 MB, about 60 MB as a set of a Python worker.
FEW_SHARED = 500_000


def line_keys(text: str | None) -> list[bytes]:
    """Per line of the text its key: blanks off both ends, A-Z in lower case.  NULL is one empty line."""
    return [line.strip().lower() for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]


def key_hash(key: bytes) -> bytes:
    """128 bits, as two little-endian signed longs."""
    import xxhash

    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, batch: str = "0") -> DataFrame:
    """(batch, hi, lo): the hash of every distinct non-blank line key of every row; ``batch`` is SQL over the row.

    Rows count as documents of their own, whatever their ids.
    """
    def run(parts):
        import numpy as np
        import pyarrow as pa

        for part in parts:
            batches, digests, counts = part.column("batch").to_numpy(zero_copy_only=False), [], []
            for text in part.column("text").to_pylist():
                distinct = set(line_keys(text))
                distinct.discard(b"")
                digests.extend(map(key_hash, distinct))
                counts.append(len(distinct))
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batches, counts), pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                names=["batch", "hi", "lo"])

    return docs.select(F.expr(batch).cast("int").alias("batch"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "batch int, hi long, lo long")


COUNTED = [StructField("_n_lines", LongType()), StructField("_n_dropped", LongType())]


class Run(NamedTuple):
    level: int
    table: str
    path: str


class LineRuns:
    """Runs of line hashes under the shared folder; ``runs`` lists them and is all the state there is."""

    def __init__(self, spark: SparkSession, threshold: int = 10, fanout: int = 3, buckets: int | None = None,
                 runs: list[Run] | None = None):
        self.spark, self.threshold, self.fanout = spark, threshold, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs = list(runs or [])

    def _write(self, counted: DataFrame, level: int) -> Run:
        """A run: bucketed and sorted by hash, one file a bucket."""
        path = scratch_path(self.spark, f"line-run-{level}")
        table = f"line_run_{uuid.uuid4().hex}"
        (counted.repartition(self.buckets, *KEY).write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", path).saveAsTable(table))
        return Run(level, table, path)

    def _merged(self, runs: list[Run]) -> DataFrame:
        """The runs' keys once each with the sum of their documents, bucket by bucket."""
        out = self.spark.table(runs[0].table)
        for run in runs[1:]:
            other = self.spark.table(run.table).withColumnRenamed("n", "more")
            out = out.join(other.hint("merge"), KEY, "full_outer").select(
                *KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"))
        return out

    def unsettled(self, counted: DataFrame) -> DataFrame:
        """The rows of (hi, lo, n) whose key no run has settled."""
        for run in self.runs:
            known = self.spark.table(run.table).where(F.col("n") >= self.threshold).select(*KEY)
            counted = counted.join(known.hint("merge"), KEY, "left_anti")
        return counted

    def add(self, counted: DataFrame) -> None:
        """Take in one batch: (hi, lo, n) with one row per key."""
        self.runs.append(self._write(self.unsettled(counted), 0))
        level = 0
        while len(full := [r for r in self.runs if r.level == level]) >= self.fanout:
            merged = self._write(self._merged(full), level + 1)
            self.runs = [r for r in self.runs if r.level != level] + [merged]
            self._forget(full)
            level += 1

    def shared(self) -> DataFrame:
        """(hi, lo) of every key with the threshold's documents or more, written."""
        if not self.runs:
            return self.spark.createDataFrame([], "hi long, lo long")
        return materialise(self._merged(self.runs).where(F.col("n") >= self.threshold).select(*KEY), "shared-lines")

    def close(self) -> None:
        """Take the runs out of the session's catalog; their files stay."""
        self._forget(self.runs)

    def _forget(self, runs: list[Run]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run.table}")


def _without(text: str | None, gone) -> tuple[str, int, int]:
    """The text without the lines whose number is in ``gone``; its lines, and how many went."""
    lines = (text or "").split("\n")
    kept = [line for k, line in enumerate(lines) if k not in gone]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _drop_by_table(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """Row-local: the shared keys, few by count, travel to the tasks as one sorted array."""
    import numpy as np
    from pyspark.sql.types import StructType

    table = shared.toArrow()
    keys = np.empty(len(table), [("hi", np.int64), ("lo", np.int64)])
    keys["hi"], keys["lo"] = table["hi"].to_numpy(), table["lo"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(keys.tobytes())

    def run(parts):
        import pyarrow as pa

        held = sent.value
        settled = {held[k:k + 16] for k in range(0, len(held), 16)}
        for part in parts:
            out = []
            for text in part.column("_text").to_pylist():
                gone = {k for k, key in enumerate(line_keys(text)) if key and key_hash(key) in settled}
                out.append(_without(text, gone))
            texts, n_lines, n_dropped = zip(*out) if out else ((), (), ())
            columns = [part.column(c) for c in part.schema.names if c != "_text"]
            names = [c for c in part.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*names, "_text", "_n_lines", "_n_dropped"])

    ordered = docs.select(*[c for c in docs.columns if c != "_text"], "_text")
    return ordered.mapInArrow(run, StructType([*ordered.schema, *COUNTED]))


def _drop_by_join(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """For shared keys beyond what may travel: line places are joined to them, then come back to their text.

    What goes depends on the text alone, so places are found once per distinct text.
    """
    from pyspark.sql.types import StructType

    def places(parts):
        import numpy as np
        import pyarrow as pa

        for part in parts:
            digest, place, found = [], [], []
            for d, text in zip(part.column("digest").to_pylist(), part.column("_text").to_pylist()):
                for k, key in enumerate(line_keys(text)):
                    if key:
                        digest.append(d)
                        place.append(k)
                        found.append(key_hash(key))
            both = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest, pa.binary()), pa.array(place, pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                names=["digest", "place", "hi", "lo"])

    def cut(parts):
        import pyarrow as pa

        for part in parts:
            out = [_without(t, set(g or ())) for t, g in zip(part.column("_text").to_pylist(), part.column("_gone").to_pylist())]
            texts, n_lines, n_dropped = zip(*out) if out else ((), (), ())
            names = [c for c in part.schema.names if c not in ("_text", "_gone")]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in names], pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64())], names=[*names, "_text", "_n_lines", "_n_dropped"])

    digest = F.unhex(F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256))
    keyed = docs.withColumn("_digest", digest)
    each = keyed.groupBy("_digest").agg(F.first("_text").alias("_text")).withColumnRenamed("_digest", "digest")
    # Rows of a very common line are split among tasks; the shared keys are repeated for each.
    spread = each.mapInArrow(places, "digest binary, place int, hi long, lo long").withColumn(
        "_salt", F.pmod(F.xxhash64("digest"), F.lit(16)).cast("int"))
    repeated = shared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    gone = spread.join(repeated, [*KEY, "_salt"]).groupBy("digest").agg(F.collect_list("place").alias("_gone"))
    joined = keyed.join(gone.withColumnRenamed("digest", "_digest"), "_digest", "left").drop("_digest")
    ordered = joined.select(*[c for c in docs.columns if c != "_text"], "_text", "_gone")
    return ordered.mapInArrow(cut, StructType([*ordered.drop("_gone").schema, *COUNTED]))


def drop_lines(docs: DataFrame, shared: DataFrame, few: int = FEW_SHARED) -> DataFrame:
    """The documents with ``text`` rid of lines whose key is in ``shared`` (hi, lo), and ``_n_lines``, ``_n_dropped``.

    NULL counts as one empty line and becomes the empty text; blank lines always
    stay.  All other columns pass as they are.  Up to ``few`` keys (16 bytes
    each) they are sent to the tasks; beyond, places are joined with them.
    """
    renamed = docs.withColumnRenamed("text", "_text").withColumn("_text", F.col("_text").cast("string"))
    way = _drop_by_table if shared.count() <= few else _drop_by_join
    return way(renamed, shared).withColumnRenamed("_text", "text")


def shared_line_keys(docs: DataFrame, threshold: int = 10, batches: int = 4, fanout: int = 3) -> DataFrame:
    """(hi, lo) of the line keys that ``threshold`` rows or more hold, found batch by batch.

    Rows fall into batches by hash; what the batches hold is written in one scan.
    """
    spark = docs.sparkSession
    which = f"pmod(xxhash64(doc_id, text), {batches})"
    counted = line_hashes(docs, which).groupBy("batch", *KEY).agg(F.count("*").alias("n"))
    path = scratch_path(spark, "line-batches")
    counted.write.partitionBy("batch").parquet(path)
    incoming = spark.read.schema("hi long, lo long, n long, batch int").parquet(path)
    runs = LineRuns(spark, threshold, fanout)
    for batch in range(batches):
        runs.add(incoming.where(F.col("batch") == batch).drop("batch"))
    shared = runs.shared()
    runs.close()
    return shared


_BLANK = r"\x20\x09-\x0D"
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT row_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d
), k AS (
  SELECT *, translate(regexp_replace(line, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), shared AS (
  SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT row_id) >= 10
), kept AS (
  SELECT row_id, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY place) AS text
  FROM k WHERE key NOT IN (SELECT key FROM shared) GROUP BY row_id
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n_kept, 0))::BIGINT AS n_dropped,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (row_id)"""


@query("op13_line_runs", ORACLE)
def op13(spark, sf):
    """Every document without the lines that ten documents or more share."""
    docs = documents(spark, sf).select("doc_id", "text")
    return drop_lines(docs, shared_line_keys(docs)).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
