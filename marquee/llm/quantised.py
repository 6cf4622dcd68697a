"""Near-equal vectors by iterative quantisation and multi-index Hamming tables.

Fit: principal directions of a bounded sample, and a rotation of them that
brings the sample's coordinates closest to their signs (alternating between
signs and the orthogonal Procrustes rotation), so that bits are balanced and
close vectors differ in few of them.  Search: ``TABLES`` keys of
``bits`` code bits each; vectors that agree in a key meet in a bucket, and
their cosine is computed from the original vectors in double precision.

Equal vectors are one node, however many.  A bucket is compared in blocks of
``BLOCK`` vectors by matrix products; a large bucket's pairs of blocks are spread
over tasks.  A block pair yields each vector's number of links and a spanning
forest of the links, not the links, so the output is linear in the vectors.  A
pair that meets in several tables counts in the first of them only.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.graph import components
from marquee.llm.registry import query
from marquee.session import materialise

SIMILAR = 0.98
SAMPLE = 10_000       # vectors the rotation is fitted on
ROUNDS = 40
SHARPNESS = 0.995     # wanted chance that a pair at the threshold meets
PER_BUCKET = 64       # vectors a bucket should hold where vectors differ
BLOCK = 512


class Quantiser(NamedTuple):
    rotation: list    # dimension x code bits
    keys: list        # code bits of each table

    def codes(self, vectors):
        import numpy as np

        return vectors @ np.array(self.rotation) > 0


def fit(sample, rows: int, seed: int = 7) -> Quantiser:
    """Rotation from the sample (unit vectors), and tables for ``rows`` vectors.

    Key length grows with log2(rows); with p the chance that a bit of a pair at
    the threshold agrees (1 - angle / pi) a key of s bits agrees with p^s, and as
    many tables are made as bring the chance of meeting to ``SHARPNESS``.
    """
    import numpy as np

    rng = np.random.default_rng(seed)
    # Not centred: the cosine is an angle at the origin, and so must the bits be.
    _, directions = np.linalg.eigh(sample.T @ sample)
    width = len(directions)
    projected = sample @ directions
    rotation, _ = np.linalg.qr(rng.normal(size=(width, width)))
    for _ in range(ROUNDS):
        signs = np.where(projected @ rotation > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(signs.T @ projected)
        rotation = (u @ v).T
    size = min(width, 24, max(4, round(math.log2(max(rows, 2) / PER_BUCKET))))
    agree = (1 - math.acos(SIMILAR) / math.pi) ** size
    tables = max(1, math.ceil(math.log(1 - SHARPNESS) / math.log(1 - agree)))
    keys, bag = [], []
    for _ in range(tables):
        if len(bag) < size:
            bag += [b for b in rng.permutation(width).tolist() if b not in bag]
        keys.append(sorted(bag[:size]))
        bag = bag[size:]
    return Quantiser((directions @ rotation).tolist(), keys)


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(label, embedding, node = least vec_id, n): distinct usable vectors.

    Left out: NULL labels, NULL or empty vectors, NULL or non-finite components, zero vectors.
    """
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                            F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    usable = usable.where("label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0")
    usable = usable.where(F.forall("embedding", fine) & F.exists("embedding", lambda x: x != 0))
    # Without negative zeros, so that equal vectors are equal keys.
    usable = usable.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    return usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))


def _keyed(nodes: DataFrame, model: Quantiser) -> DataFrame:
    """A row per node and table: bucket, and the node's place in the other tables (``sub``)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        weights = [1 << np.arange(len(k), dtype=np.int64) for k in model.keys]
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.array(batch.column("embedding").to_pylist(), np.float64)
            bits = model.codes(raw / np.linalg.norm(raw, axis=1, keepdims=True))
            sub = np.stack([bits[:, k] @ w for k, w in zip(model.keys, weights)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "label", "n")), batch.column("embedding"),
                 pa.array(list(sub), pa.list_(pa.int64()))], names=["id", "label", "n", "embedding", "sub"])

    kind = nodes.schema["label"].dataType.simpleString()
    out = nodes.select("id", "label", "n", "embedding").mapInArrow(
        run, f"id long, label {kind}, n long, embedding array<double>, sub array<bigint>")
    return out.select("*", F.posexplode("sub").alias("tab", "bucket"))


def _compare(blocks: DataFrame) -> DataFrame:
    """Links within every block pair: (a, b, n).  b NULL: a gained n links; else a and b are connected."""
    def run(key, table):
        import numpy as np
        import pyarrow as pa

        tab, low, high = key[1].as_py(), key[3].as_py(), key[4].as_py()
        block = table.column("block").to_numpy()
        order = np.lexsort((table.column("id").to_numpy(), block))
        table = table.take(pa.array(order))
        ids, n = table.column("id").to_numpy(), table.column("n").to_numpy()
        raw = np.array(table.column("embedding").to_pylist(), np.float64)
        sub = np.array(table.column("sub").to_pylist(), np.int64)
        left = np.flatnonzero(block[order] == low)
        right = np.flatnonzero(block[order] == high)
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        close = unit[left] @ unit[right].T >= SIMILAR
        if low == high:
            close &= left[:, None] < right[None, :]
        i, j = np.nonzero(close)
        # Only where no earlier table has brought the two together.
        fresh = ~(sub[left[i]][:, :tab] == sub[right[j]][:, :tab]).any(axis=1)
        i, j = left[i[fresh]], right[j[fresh]]
        gained = np.bincount(i, n[j], len(ids)) + np.bincount(j, n[i], len(ids))
        parent = np.arange(len(ids))

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        tree = []
        for x, y in zip(i.tolist(), j.tolist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                tree.append((ids[x], ids[y]))
        got = np.flatnonzero(gained)
        return pa.table({
            "a": pa.array([*ids[got].tolist(), *(int(t[0]) for t in tree)], pa.int64()),
            "b": pa.array([*[None] * len(got), *(int(t[1]) for t in tree)], pa.int64()),
            "n": pa.array([*gained[got].astype(np.int64).tolist(), *[0] * len(tree)], pa.int64())})

    return blocks.groupBy("label", "tab", "bucket", "low", "high").applyInArrow(run, "a long, b long, n long")


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per input row.

    A vector links with others of the same label whose cosine is at least
    ``SIMILAR``; equal vectors count as links like any.  Unusable vectors (see
    ``nodes_of``) have no link and are their own component.  Rows that repeat a
    vec_id are vectors of their own; a NULL vec_id has component NULL only if
    its whole component has none.  Vectors of different lengths never link.
    """
    spark = vectors.sparkSession
    # ``id``: a written row number; vec_ids may repeat.
    rows = materialise(nodes_of(vectors).withColumn("id", F.monotonically_increasing_id()), "nodes")
    # One row per vector length: the rows of its largest label, as labels have buckets of their own.
    per_width = (rows.groupBy(F.size("embedding").alias("width"), "label").agg(F.count("*").alias("rows"))
                 .groupBy("width").agg(F.max("rows").alias("rows")).collect())
    found = None
    for width, n in sorted((r.width, r.rows) for r in per_width):
        import numpy as np

        nodes = rows.where(F.size("embedding") == width)
        # Bounded: at most SAMPLE vectors, the lowest hashes of their ids.
        sample = nodes.orderBy(F.xxhash64("embedding", "label"), "id").select("embedding").limit(SAMPLE).toPandas()
        sample = np.array(sample["embedding"].tolist(), np.float64)
        model = fit(sample / np.linalg.norm(sample, axis=1, keepdims=True), n)
        keyed = _keyed(nodes, model)
        sizes = (keyed.groupBy("label", "tab", "bucket").agg(F.count("*").alias("m")).where("m > 1")
                 .withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int")))
        # Node x of block k goes to the block pairs (k, 0), ..., (k, blocks - 1).
        met = keyed.join(sizes.select("label", "tab", "bucket", "blocks"), ["label", "tab", "bucket"])
        met = met.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        part = _compare(met.select("label", "tab", "bucket", F.least("block", "other").alias("low"),
                                   F.greatest("block", "other").alias("high"), "block", "id", "n", "embedding", "sub"))
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    found = materialise(found, "links")
    gained = found.where("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    joined = components(found.where("b IS NOT NULL").select("a", "b"), "links")
    labelled = (rows.select("id", "label", "embedding", "node", "n").join(gained, "id", "left")
                .join(joined.select(F.col("node").alias("id"), "component"), "id", "left")
                .withColumn("component", F.coalesce("component", "id")))
    heads = labelled.groupBy("component").agg(F.min("node").alias("component_id"))
    verdict = labelled.join(heads, "component").select(
        "label", "embedding", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("embedding"))
    out = plain.join(verdict, ["label", "embedding"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


@query("op2_itq_near_vectors")
def op2(spark, sf):
    """Links and components of all embeddings."""
    return near_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"))
