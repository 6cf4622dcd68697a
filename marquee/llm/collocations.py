"""Phrases that occur together, by dynamic itemset counting over shards of the corpus.

The corpus is written once as blocks of word numbers, dealt into shards that
are scanned in a cycle.  Words are counted from the first scan on.  A longer
phrase becomes active in the scan after both its subphrases (all words but the
last, all but the first) have reached the threshold, and is counted for one full
cycle from there, so phrases of all lengths are counted side by side and a
phrase seen often early on does not wait for the end of a pass.  Its count over
that cycle is exact; a phrase that never becomes active has a subphrase below
the threshold, and so is below it itself.

Tasks learn what has reached the threshold from a table of fixed size: hashed by
phrase, it keeps the earliest scan after which any phrase of that slot had
reached it.  Two phrases in one slot can only make a third one active too early,
alike in every task, which costs counting and changes no count.  Counts travel
under 93 bits of the phrase's hash and its length; the words of what reached
the threshold are looked up in one more scan.  It begins with about two blocks,
however many there are, and takes twice as many as all before with each turn,
looking only for what has no words yet; so a phrase is sent by a few blocks,
frequent or rare, in a small corpus or a large one, and the last turn takes all
that are left.

A phrase's cycle lies within as many consecutive scans as there are shards, so
the totals of every such window are written, and a scan that no later window
needs is deleted: the scratch folder holds one window, however many scans there
are.
"""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.registry import documents, query
from marquee.llm.words import few
from marquee.session import materialise, scratch_path

LONGEST = 5
#: Entries of the table of reached phrases, one byte each: its size does not depend on the data.  A power of two.
SLOTS = 1 << 24
#: The look-up of words takes so many blocks at first, and this many times as many as all before at each further turn.
FIRST_TURN, GROWTH = 2, 2
#: Blocks are dealt into so many lots, of which a turn takes some.
LOTS = 1 << 20
#: Bytes of text in a written block, and words that a task holds as arrays at once.
BLOCK, CHUNK = 1 << 21, 1 << 20
NEVER = 255

_SPACE, _BREAK = 0x20, 0x0A
# One byte per byte: A-Z to lower case, what parts pieces to a line end, tabs to spaces.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else _BREAK if b in b".,;:!?\n\x0b\x0c\r" else _SPACE if b == 9 else b
              for b in range(256))


def encode(texts: list[str | None]):
    """Distinct words of the texts (binary array) and the number of every word in order, from 1; 0 parts pieces.

    Texts end with a piece, NULL has no words.
    """
    import numpy as np
    import pyarrow as pa

    folded = "\n".join([t or "" for t in texts]).encode("utf-8", "surrogatepass").translate(_FOLD)
    data = np.frombuffer(folded + b"\n", np.uint8)
    inside = (data != _SPACE) & (data != _BREAK)
    edges = np.flatnonzero(np.diff(inside, prepend=False))  # begin, end, begin, end, ...
    begin, end = edges[::2], edges[1::2]
    offsets = np.zeros(len(begin) + 1, np.int32)
    np.cumsum(end - begin, out=offsets[1:])
    words = pa.BinaryArray.from_buffers(
        pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
    breaks = np.cumsum(data == _BREAK, dtype=np.int32)
    parted = breaks[np.append(begin[1:], len(data) - 1)] > breaks[end - 1] if len(begin) else np.zeros(0, bool)
    numbers = np.zeros(len(begin) + int(parted.sum()), np.int32)
    numbers[np.arange(len(begin)) + np.cumsum(parted) - parted] = words.indices.to_numpy() + 1
    return words.dictionary, numbers


def _blocks(batches):
    """Task function: texts of one language as blocks of distinct words and of their numbers in order."""
    import pyarrow as pa

    def written(held):
        coded = [encode(texts) for texts in held.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([b"\n".join(w.to_pylist()) for w, _ in coded], pa.binary()),
             pa.array([n.tobytes() for _, n in coded], pa.binary()),
             pa.array([int((n > 0).sum()) for _, n in coded], pa.int64())], names=["lang", "words", "numbers", "n"])

    held, size = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            held.setdefault(lang, []).append(text)
            size += len(text or "")
            if size >= BLOCK:
                yield written(held)
                held, size = {}, 0
    if held:
        yield written(held)


def _hashes(lang: str, words: list[bytes]):
    """(words, 2) hashes of words within a language."""
    import numpy as np
    import xxhash

    seed, digest = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")), xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(w, seed) for w in words]), np.uint64).reshape(-1, 2)


def _longer(shorter, words):
    """The two hashes of phrases, from those of all their words but the last and those of the last."""
    import numpy as np

    value = (shorter ^ words) * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
    return value ^ (value >> np.uint64(29))


def _since(hashes, reached):
    """Scan after which each phrase's slot had reached the threshold."""
    import numpy as np

    return reached[(hashes[:, 0] & np.uint64(len(reached) - 1)).astype(np.int64)]


def _chain(ids, hashes, reached, scan: int, longest: int):
    """Per length from 1 the places of phrases that are active by this scan, their hashes, and the scan before that one.

    ``hashes`` are those of the words numbered from 1 in ``ids``.  A phrase is
    active after both its subphrases had reached the threshold, a word always.
    """
    import numpy as np

    first = _longer(np.zeros_like(hashes), hashes)
    alive = np.flatnonzero(ids)
    value = first[ids[alive] - 1]
    yield 1, alive, value, np.zeros(len(alive), np.uint8)
    since = np.append(np.uint8(NEVER), _since(first, reached))[ids]
    for size in range(2, longest + 1):
        known = np.maximum(since[:-1], since[1:])  # scan after which both subphrases had reached it
        alive = alive[:np.searchsorted(alive, len(known))]
        keep = known[alive] < scan
        alive, value = alive[keep], value[:len(keep)][keep]
        if not len(alive):
            return
        value = _longer(value, hashes[ids[alive + size - 1] - 1])
        known = known[alive]
        yield size, alive, value, known
        # Never before its parts: a slot may have been set early by another phrase.
        since = np.full(len(since) - 1, NEVER, np.uint8)
        since[alive] = np.maximum(_since(value, reached), known)


def _keys(size: int, value):
    """A phrase's hash as a signed long and a signed int, its length in the int's last three bits."""
    import numpy as np

    low = ((value[:, 1] >> np.uint64(32)) & ~np.uint64(7)) | np.uint64(size)
    return value[:, 0].copy().view(np.int64), low.astype(np.uint32).view(np.int32)


def _distinct(places, value):
    """One place of every phrase, and how often it stands; a phrase may come twice."""
    import numpy as np

    order = np.argsort(value[:, 0])
    places, value = places[order], value[order]
    # Equal first hashes of unlike phrases only cut a group in two.
    new = np.flatnonzero(np.append(len(places) > 0, (value[1:] != value[:-1]).any(axis=1)))
    return places[new], value[new], np.diff(np.append(new, len(places)))


def _unseen(value, seen):
    """Which of these hashes are not among ``seen``, and all of both, ordered by their first half.

    One whose first half another has may come again.
    """
    import numpy as np

    at = np.searchsorted(seen[:, 0], value[:, 0])
    there = np.flatnonzero(at < len(seen))
    new = np.ones(len(value), bool)
    new[there] = (seen[at[there]] != value[there]).any(axis=1)
    both = np.concatenate([seen, value[new]])
    return new, both[np.argsort(both[:, 0], kind="stable")]


def _of_blocks(sent, work):
    """Task function: ``work(reached, blocks, own)`` for as many blocks as make a chunk; a block is lang, words, numbers.

    ``own`` is a dict that lasts as long as the task.
    """
    def run(batches):
        import numpy as np

        reached, held, size, own = np.frombuffer(zlib.decompress(sent.value), np.uint8), [], 0, {}
        for batch in batches:
            for lang, words, numbers in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "numbers"))):
                if words:
                    held.append((lang, words.split(b"\n"), np.frombuffer(numbers, np.int32)))
                    size += len(held[-1][2])
                if size >= CHUNK:
                    yield from work(reached, held, own)
                    held, size = [], 0
        if held:
            yield from work(reached, held, own)

    return run


def _joined(held):
    """Numbers of the words of all blocks as one array, and their hashes."""
    import numpy as np

    shift = np.cumsum([0, *[len(words) for _, words, _ in held]])
    ids = np.concatenate([np.where(numbers > 0, numbers + offset, 0) for (*_, numbers), offset in zip(held, shift)])
    return ids, np.concatenate([_hashes(lang, words) for lang, words, _ in held])


def _counter(sent, scan: int, shards: int, longest: int):
    """Task function: (k1, k2, n) of the phrases that are active and in their cycle; one may come in several rows."""
    def counted(reached, held, _):
        import pyarrow as pa

        ids, hashes = _joined(held)
        for size, places, value, known in _chain(ids, hashes, reached, scan, longest if scan else 1):
            if size == 1:
                now = slice(None) if scan < shards else slice(0)
            else:
                now = known.astype(int) + shards >= scan
            places, value = places[now], value[now]
            if len(places):
                _, value, n = _distinct(places, value)
                keys = _keys(size, value)
                yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(keys[1]), pa.array(n)], names=["k1", "k2", "n"])

    return _of_blocks(sent, counted)


def _namer(sent, wanted, longest: int):
    """Task function: (k1, k2, lang, phrase) of all phrases in wanted slots, one row a task for each.

    A task remembers the hashes of those it has named, 16 bytes each.
    """
    def named(reached, held, own):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if "wanted" not in own:
            own["wanted"] = np.frombuffer(zlib.decompress(wanted.value), np.uint8)
        ids, hashes = _joined(held)
        words = pa.array([w for _, words, _ in held for w in words], pa.binary())
        langs = pa.array([lang for lang, *_ in held], pa.string())
        block_of = np.repeat(np.arange(len(held)), [len(w) for _, w, _ in held])  # by word
        for size, places, value, _ in _chain(ids, hashes, reached, NEVER, longest):
            there = _since(value, own["wanted"]) < NEVER
            at, value, _ = _distinct(places[there], value[there])
            new, own[size] = _unseen(value, own.get(size, value[:0]))
            at, value = at[new], value[new]
            if not len(at):
                continue
            runs = [words.take(pa.array(ids[at + k] - 1)) for k in range(size)]
            phrases = pc.binary_join_element_wise(*runs, pa.scalar(b" ", pa.binary())) if size > 1 else runs[0]
            keys = _keys(size, value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[0]), pa.array(keys[1]), langs.take(pa.array(block_of[ids[at] - 1])), phrases.cast(pa.string())],
                names=["k1", "k2", "lang", "phrase"])

    return _of_blocks(sent, named)


def phrase_counts(docs: DataFrame, threshold: int = 100, longest: int = LONGEST, shards: int = 2,
                  slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of every phrase of 1 to ``longest`` words with f >= threshold, and (lang, n) of all words.

    ``docs`` has lang (NULL: ``und``) and text (NULL: no words); other columns
    are not read, repeated rows count each.  No documents give no rows.
    """
    import numpy as np

    if not 1 <= longest <= 7 or slots & (slots - 1):
        raise ValueError("phrases have 1 to 7 words, and slots are a power of two")
    spark = docs.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    blocks = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(
        _blocks, "lang string, words binary, numbers binary, n long")
    dealt = scratch_path(spark, "phrase-shards")
    # Blocks are dealt in turn, each task beginning with another shard.
    turn = F.spark_partition_id() + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lot = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(LOTS)).cast("int")
    (blocks.select("*", F.pmod(turn, F.lit(shards)).cast("int").alias("shard"), lot.alias("lot"))
     .write.partitionBy("shard").option("compression", "zstd").parquet(dealt))
    corpus = spark.read.schema("lang string, words binary, numbers binary, n long, lot int, shard int").parquet(dealt)

    table = np.full(slots, NEVER, np.uint8)
    least = -(-threshold // shards)  # what reaches the threshold within a cycle has so many in one of its scans
    scans, windows, scan, wait = [], [], 0, shards
    while scan < wait:
        if scan >= NEVER:
            raise ValueError("more scans than the table can number: use fewer shards")
        sent = spark.sparkContext.broadcast(zlib.compress(table.tobytes(), 1))
        found = corpus.where(F.col("shard") == scan % shards).select("lang", "words", "numbers").mapInArrow(
            _counter(sent, scan, shards, longest), "k1 long, k2 int, n long")
        path = scratch_path(spark, f"phrase-scan-{scan}")
        (found.groupBy("k1", "k2").agg(F.sum("n").alias("n")).withColumn("often", F.col("n") >= least)
         .write.partitionBy("often").parquet(path))
        sent.destroy()
        scans.append(path)
        # A phrase's cycle lies within the last scans; what was not often in one of them is below the threshold.
        rows = [spark.read.schema("k1 long, k2 int, n long, often boolean").parquet(p) for p in scans[-shards:]]
        windows.append(materialise(_totals(rows, threshold), "phrase-window"))
        if scan + 1 >= shards:
            _forget(spark, scans[-shards])
        # At most one row per slot and length comes here.
        now = windows[-1].select(
            F.col("k1").bitwiseAND(F.lit(slots - 1)).cast("int").alias("slot"),
            (F.col("k2").bitwiseAND(F.lit(7)) < longest).alias("extends")).distinct().toArrow()
        slot = now["slot"].to_numpy()
        new = table[slot] == NEVER
        if new[now["extends"].to_numpy()].any():
            wait = max(wait, scan + 1 + shards)  # what becomes active with the next scan needs a cycle
        table[slot[new]] = scan
        scan += 1

    # The window of a phrase's cycle holds its count, others hold a part of it.
    reached = materialise(reduce(DataFrame.unionByName, windows).groupBy("k1", "k2").agg(F.max("n").alias("f")), "phrases-reached")
    sent, left, parts = spark.sparkContext.broadcast(zlib.compress(table.tobytes(), 1)), reached, []
    for first, last in turns(corpus.count()):
        slot = left.select(F.col("k1").bitwiseAND(F.lit(slots - 1)).cast("int").alias("slot")).distinct().toArrow()["slot"].to_numpy()
        table = np.full(slots, NEVER, np.uint8)
        table[slot] = 0
        wanted = spark.sparkContext.broadcast(zlib.compress(table.tobytes(), 1))
        found = corpus.where(F.col("lot").between(first, last - 1)).select("lang", "words", "numbers").mapInArrow(
            _namer(sent, wanted, longest), "k1 long, k2 int, lang string, phrase string")
        parts.append(materialise(found.distinct().join(few(left), ["k1", "k2"]), "phrase-words"))
        wanted.destroy()
        left = materialise(left.join(parts[-1].select("k1", "k2"), ["k1", "k2"], "left_anti"), "phrases-left")
        if left.isEmpty():
            break
    sent.destroy()
    size = F.col("k2").bitwiseAND(F.lit(7)).cast("int").alias("size")
    n = corpus.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0")
    counts = reduce(DataFrame.unionByName, parts).select("lang", size, "phrase", "f")
    return materialise(counts, "phrase-counts"), materialise(n, "words-of-languages")


def turns(blocks: int) -> list[tuple[int, int]]:
    """The lots (first, first of the next turn) that the look-up takes turn by turn, all lots in the end."""
    edges, taken = [0], FIRST_TURN
    while taken < blocks:
        edges.append(max(edges[-1] + 1, LOTS * taken // blocks))
        taken += GROWTH * taken
    return list(zip(edges, [*edges[1:], LOTS]))


def _forget(spark, path: str) -> None:
    """Deletes a table of the shared folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _totals(scans: list[DataFrame], threshold: int) -> DataFrame:
    """(k1, k2, n): the phrases that reach the threshold over these scans, with their sums."""
    rows = reduce(DataFrame.unionByName, scans)
    often = few(rows.where("often").select("k1", "k2").distinct())
    return rows.join(often, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.sum("n").alias("n")).where(F.col("n") >= threshold)


def collocations(docs: DataFrame, threshold: int = 100, longest: int = LONGEST, top: int = 2000, shards: int = 2,
                 slots: int = SLOTS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: every language's phrases of 2 words or more, best first.

    The score of a phrase is that of its weakest cut, floor(1000 * a * n / (l *
    r)) in whole numbers.  A phrase that always stands inside one that is a word
    longer is left out: as counts never grow with length, that covers every
    longer phrase as frequent as it.  Ties go to more occurrences, then to the
    phrase's bytes.
    """
    counts, words = phrase_counts(docs, threshold, longest, shards, slots)
    part = lambda first, last: F.array_join(F.slice("w", first, last), " ")
    split = counts.withColumn("w", F.split("phrase", " "))
    candidates = split.where("size > 1").withColumnRenamed("f", "a")
    inside = candidates.where("size > 2").select(
        "lang", "a", F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("phrase"))
    kept = candidates.join(inside.distinct(), ["lang", "phrase", "a"], "left_anti")
    cuts = kept.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    side = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    # Few languages, but no bound on them: each cut's n comes by join, as its parts do.
    known = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"]).join(words, "lang")
    scored = known.withColumn("score", F.expr(
        "CAST((CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(18,0))) div "
        "(CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS BIGINT)"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (weakest.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), t AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM t, (SELECT unnest([1, 2, 3, 4, 5]) AS size))
), f AS (
  SELECT lang, size, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), n AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM t GROUP BY 1
), c AS (
  SELECT * FROM f WHERE size > 1 AND NOT EXISTS (
    SELECT 1 FROM f b WHERE b.lang = f.lang AND b.size > f.size AND 100 * b.f >= 100 * f.f
      AND contains(' ' || b.phrase || ' ', ' ' || f.phrase || ' '))
), cut AS (
  SELECT lang, size, phrase, w, f AS a, unnest(generate_series(1, size - 1)) AS k FROM c
), s AS (
  SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.w[1:k], ' ')
           JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.w[k + 1:], ' ') JOIN n ON n.lang = cut.lang
), one AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM one QUALIFY rank <= 2000"""


@query("op11_dynamic_phrase_counts", ORACLE)
def op11(spark, sf):
    """The best 2,000 phrases of every language."""
    return collocations(documents(spark, sf))
