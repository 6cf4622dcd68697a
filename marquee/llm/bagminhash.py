"""Near copies under weighted Jaccard similarity of their shingle counts, by BagMinHash signatures.

A document is the multiset of its five-word shingles.  A shingle's count is a
weight on the integer levels 0, 1, 2, ...  For each shingle the levels are split
into dyadic stretches [0,1), [1,2), [2,4), [4,8), ..., each with a Poisson
process of its own whose rate is the stretch's width; a point has a time, a
level and a signature slot.  A document of count c sees the points below level c:
whole stretches, and the last one thinned by level.  A slot holds the earliest
time it has seen, so two documents agree in a slot with probability
sum(min counts) / sum(max counts), without bias.  Times ascend along a process,
so a process ends as soon as it passes the latest of its document's slots, and a
count of c costs about log2(c) processes and not c.

Signatures are cut into bands; documents that agree in a band are candidates,
and every link is verified on the whole texts' counts.  Within a band's bucket
links are first sought to a hub, round by round with another hub, and what is
then already connected is not compared again; pairs of a bucket that are still
in different components after that are all considered.  The texts still concerned
get a longer signature, of which a sketch keeps two bits a slot; only pairs whose
sketches agree in ``AGREEING`` of ``SKETCHED`` slots are compared.  A pair at the
threshold agrees in 870 on average (deviation 11), and in fewer than 824 with
probability below 1e-4.  A group of n copies costs about n comparisons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm.graph import components
from marquee.llm.registry import documents, query
from marquee.llm.words import WordHashes, few, mix, shingle_hashes, words
from marquee.session import materialise

SHINGLE = 5
SIMILAR = 0.8
BANDS = 26
ROWS = 5          # a pair at 0.8 shares a band with probability 1 - (1 - 0.8^5)^26 > 0.9999
HUB_ROUNDS = 3
SKETCHED = 1024   # slots in a sketch
PLANES = 2        # bits of each
AGREEING = 824
SLICE = 1024      # documents signed together


def counted(text: str | None, hashes: WordHashes):
    """(shingle hashes, counts) of a text, ascending; both empty for a text without words."""
    import numpy as np

    return np.unique(shingle_hashes(hashes.of(words(text)), SHINGLE), return_counts=True)


def weighted_jaccard(a, b) -> float:
    """Similarity of two ``counted`` results; 0 where either has no shingles."""
    import numpy as np

    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    return low / (int(a[1].sum()) + int(b[1].sum()) - low)


def sign(shingles, counts, owner, n_owners: int, slots: int = BANDS * ROWS):
    """BagMinHash signatures, one row of ``slots`` times per owner; rows of owners without shingles are infinite.

    ``shingles`` (uint64), ``counts`` and ``owner`` (0 to n_owners - 1) are parallel.
    """
    import numpy as np

    # One process per shingle and dyadic stretch that the count reaches into.
    stretch = np.zeros(len(counts), np.int64)
    processes = [np.arange(len(counts))]
    stretches = [stretch]
    for k in range(1, 64):
        reached = np.flatnonzero(counts > 1 << (k - 1))
        if not len(reached):
            break
        processes.append(reached)
        stretches.append(np.full(len(reached), k))
    item, stretch = np.concatenate(processes), np.concatenate(stretches)
    low = np.where(stretch == 0, 0, 1 << np.maximum(stretch - 1, 0)).astype(np.float64)
    width = np.maximum(low, 1.0)
    limit, who = counts[item].astype(np.float64), owner[item]
    seed = mix(shingles[item] + stretch.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    time = np.zeros(len(item))
    out = np.full(n_owners * slots, np.inf)
    latest = np.full(n_owners, np.inf)
    active, step = np.arange(len(item)), 0
    unit = 1.0 / (1 << 53)
    while len(active):
        step += 1
        draw = mix(seed[active] + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time[active] += -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * unit) / width[active]
        active_owner = who[active]
        going = time[active] < latest[active_owner]
        active, active_owner, draw = active[going], active_owner[going], draw[going]
        place = mix(draw + np.uint64(0xA0761D6478BD642F))
        slot = ((place >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)
        level = low[active] + width[active] * ((place & np.uint64(0xFFFFFFFF)).astype(np.float64) / (1 << 32))
        level[stretch[active] == 0] = 0.0
        seen = level < limit[active]
        np.minimum.at(out, active_owner[seen] * slots + slot[seen], time[active[seen]])
        touched = np.unique(active_owner)
        latest[touched] = out.reshape(n_owners, slots)[touched].max(axis=1)
    return out.reshape(n_owners, slots)


def bands_of(signatures):
    """One 64-bit key per band and signature."""
    import numpy as np

    bits = np.ascontiguousarray(signatures).view(np.uint64).reshape(len(signatures), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return key.view(np.int64)


def sketches_of(signatures):
    """Bit planes of the slots: PLANES times SKETCHED / 64 words per signature."""
    import numpy as np

    value = mix(np.ascontiguousarray(signatures).view(np.uint64))
    planes = [np.packbits((value >> np.uint64(p)).astype(np.uint8) & 1, axis=1).view(np.int64) for p in range(PLANES)]
    return np.concatenate(planes, axis=1)


def _agreeing(a: str, b: str):
    """Number of slots in which two sketch columns agree."""
    words = SKETCHED // 64
    total = F.lit(0)
    for w in range(words):
        differ = F.lit(0).cast("long")
        for p in range(PLANES):
            at = p * words + w
            differ = differ.bitwiseOR(F.col(a)[at].bitwiseXOR(F.col(b)[at]))
        total = total + 64 - F.bit_count(differ)
    return total


def _with_node(docs: DataFrame) -> DataFrame:
    """``node``: a digest of the text, the same for equal texts; NULL counts as empty."""
    return docs.withColumn("node", F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))))


def signatures(docs: DataFrame) -> DataFrame:
    """node, doc_id, bands (NULL for texts without words), one row per row of (node, doc_id, text)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                bags = [counted(t, hashes) for t in part.column("text").to_pylist()]
                sizes = [len(b[0]) for b in bags]
                signed = sign(np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]),
                              np.repeat(np.arange(len(bags)), sizes), len(bags))
                bands = pa.array([k if n else None for k, n in zip(bands_of(signed), sizes)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("doc_id"), bands],
                                                 names=["node", "doc_id", "bands"])

    return docs.select("node", F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "node binary, doc_id long, bands array<long>")


def sketches(texts: DataFrame) -> DataFrame:
    """(node, sketch) of (node, text), for texts with words."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE // 8):
                part = batch.slice(at, SLICE // 8)
                bags = [counted(t, hashes) for t in part.column("text").to_pylist()]
                signed = sign(np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]),
                              np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags]), len(bags), SKETCHED)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(list(sketches_of(signed)), pa.list_(pa.int64()))], names=["node", "sketch"])

    return texts.select("node", "text").mapInArrow(run, "node binary, sketch array<long>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough."""
    def run(batches):
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            remembered: dict = {}  # a hub's text comes many times in a row
            keep = []
            for key, a, b in zip(batch.column("a").to_pylist(), batch.column("ta").to_pylist(),
                                 batch.column("tb").to_pylist()):
                if key not in remembered:
                    remembered = {key: counted(a, hashes)}
                keep.append(weighted_jaccard(remembered[key], counted(b, hashes)) >= SIMILAR)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"t{name}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb").mapInArrow(
        run, "a binary, b binary")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The linked nodes and all nodes.

    Linked: node, class (a node), class_id (least doc_id of the class, NULL if
    none has one) and ``first``, true for the node that holds that id.  All:
    node, least doc_id, copies, bands.  Nodes are distinct texts; a text without words
    links with nothing.
    """
    noded = _with_node(docs.select("doc_id", "text"))
    nodes = materialise(signatures(noded).groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.any_value("bands").alias("bands")), "nodes")
    buckets = nodes.where("bands IS NOT NULL").select(F.explode("bands").alias("key"), "node")
    shared = buckets.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    # Only buckets of two or more texts, and only the texts in them, go on.
    members = materialise(buckets.join(shared.select("key"), "key", "left_semi").distinct(), "members")
    wanted = materialise(members.select("node").distinct(), "wanted")
    texts = materialise(noded.join(few(wanted), "node", "left_semi").groupBy("node").agg(F.any_value("text").alias("text")),
                        "texts")
    links = compared = None
    for round in range(HUB_ROUNDS + 1):
        placed = members
        if links is not None:
            found = components(links, "links")
            placed = members.join(found, "node", "left").select(
                "key", "node", F.coalesce("component", "node").alias("component"))
            open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            placed = materialise(placed.join(open_keys.where("low <> high").select("key"), "key", "left_semi"), "open")
        else:
            placed = members.withColumn("component", F.col("node"))
        if round < HUB_ROUNDS:
            rank = F.struct(F.xxhash64("node", F.lit(round)).alias("rank"), "node", "component")
            hubs = placed.groupBy("key").agg(F.min(rank).alias("hub")).select("key", "hub.node", "hub.component")
            alike = F.lit(True)
        else:
            concerned = texts.join(placed.select("node").distinct(), "node", "left_semi")
            placed = placed.join(materialise(sketches(concerned), "sketches"), "node")
            hubs = placed.withColumnRenamed("sketch", "other_sketch")
            alike = (F.col("node") < F.col("other")) & (_agreeing("sketch", "other_sketch") >= AGREEING)
        hubs = hubs.withColumnsRenamed({"node": "other", "component": "apart"})
        pairs = placed.join(hubs, "key").where((F.col("component") != F.col("apart")) & alike).select(
            F.greatest("node", "other").alias("b"), F.least("node", "other").alias("a")).distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = materialise(pairs.select("a", "b"), "pairs")
        good = materialise(_verified(pairs, texts), "verified")
        compared = pairs if compared is None else compared.unionAll(pairs)
        links = good if links is None else links.unionAll(good)
    found = components(links, "links")
    ids = found.join(nodes.select("node", "doc_id"), "node")
    # The node of the least id, the least node among equals; NULL ids come last.
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    head = ids.groupBy("component").agg(F.min(least).alias("head"))
    return ids.join(head, "component").select(
        "node", F.col("component").alias("class"), F.col("head.doc_id").alias("class_id"),
        (F.col("node") == F.col("head.node")).alias("first")), nodes


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_copies (rows of the same text), kept (doc_id = class_id), one row per input row.

    The class of a text without links is the class of its equal texts.  Equal
    texts without words (NULL, empty, marks only) are no copies: each such row
    is a class of its own.  A NULL id has class NULL when no row of its class
    has an id, and is never kept; rows that repeat an id and text share its verdict.
    """
    linked, nodes = classes(docs)
    rows = _with_node(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("node", "doc_id")
    copies = rows.groupBy("node").agg(F.count("*").alias("n_copies"))
    verdict = (nodes.select("node", F.col("doc_id").alias("own"), F.col("bands").isNull().alias("blank"))
               .join(copies, "node").join(linked.select("node", "class_id"), "node", "left"))
    out = rows.join(verdict, "node")
    class_id = F.when(F.col("blank"), F.col("doc_id")).otherwise(F.coalesce("class_id", "own"))
    return out.select("doc_id", class_id.alias("class_id"), "n_copies",
                      F.coalesce(F.col("doc_id") == class_id, F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, the one of the least id; rows without words all stay."""
    linked, nodes = classes(docs)
    # Texts that go are linked and not the first of their class; of texts with copies one row stays.
    gone = linked.where("NOT first").select("node", F.lit(True).alias("gone"))
    judged = nodes.where("bands IS NOT NULL").join(gone, "node", "left").where("gone OR copies > 1")
    judged = few(materialise(judged.select("node", F.coalesce("gone", F.lit(False)).alias("gone")), "judged"))
    rows = _with_node(docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))).select("node", "row")
    alone = rows.join(judged.select("node"), "node", "left_anti")
    order = Window.partitionBy("node").orderBy(F.col("row.doc_id").asc_nulls_last())
    copied = rows.join(judged.where("NOT gone").select("node"), "node").withColumn("rank", F.row_number().over(order))
    return alone.select("row.*").unionAll(copied.where("rank = 1").select("row.*"))


@query("op7_bagminhash_near_duplicates")
def op7(spark, sf):
    """The near-copy class of every document."""
    return near_duplicates(documents(spark, sf))
