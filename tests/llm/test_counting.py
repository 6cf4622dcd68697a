"""Phrase counting, filter interactions and line runs against plain Python."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import collocations, interactions, linedup
from tests.llm.conftest import ODD, prose, table

LABELS = "doc_id long, quality int, toxic int"


# --- phrases -----------------------------------------------------------------

def plain_phrases(rows, threshold, top=2000):
    """rows of (lang, text) to the result rows, from whole counts."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, 6):
                for k in range(len(words) - size + 1):
                    f[lang or "und", tuple(words[k:k + size])] += 1
    f = {k: v for k, v in f.items() if v >= threshold}
    inside = defaultdict(int)
    for (lang, p), v in f.items():
        for size in range(2, len(p)):
            for k in range(len(p) - size + 1):
                inside[lang, p[k:k + size]] = max(inside[lang, p[k:k + size]], v)
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or inside[lang, p] >= a:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(lang, k + 1, *x[1:]) for k, x in enumerate(best)]
    return sorted(ranked)


def spoken(seed, docs, vocabulary=12):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(vocabulary)] + ["ÄÖ", "ß🙂", "it's", "(a)", " x", "\x00z"]
    idioms = [["New", "York", "City"], ["as", "well", "as", "possible", "then", "some"], ["w1", "w1", "w1"]]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts += rng.choice(idioms) if rng.random() < 0.15 else [rng.choice(names)]
            if rng.random() < 0.1:
                parts[-1] += rng.choice([".", ",", ";", ":", "!", "?", "\n", "\r", "\x0b", "\x0c", "..", "\t"])
        rows.append((rng.choice(["en", "en", "de", None, "und"]), rng.choice([" ", "  ", "\t"]).join(parts)))
    return rows + [("en", None), ("fr", ""), (None, None), ("en", "\x1d\x85 odd blanks   stay in words")]


@pytest.mark.parametrize("threshold, shards, slots", [(10, 3, 1 << 16), (25, 2, 64), (1, 1, 64)])
def test_phrases_equal_whole_counts(spark, threshold, shards, slots, monkeypatch):
    """Also with a table so small that all phrases share slots, and with blocks and chunks of a few words."""
    rows = spoken(threshold, 15 if threshold == 1 else 150)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    if shards != 2:
        monkeypatch.setattr(collocations, "BLOCK", 500)
    got = collocations.collocations(docs, threshold, shards=shards, slots=slots)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, threshold)


def test_phrase_lists_are_cut_after_ranking(spark):
    rows = spoken(3, 100)
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), 5, top=3, shards=1, slots=2)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 5, top=3)


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10 ** 15
    counts = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)],
                                   "lang string, size int, phrase string, f long")
    n = spark.createDataFrame([("en", 10 ** 17)], "lang string, n long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: (counts, n))
    row = collocations.collocations(None).first()
    assert row.score == 1000 * (big - 1) * 10 ** 17 // (big * (big + 1))


def test_phrases_of_odd_and_no_rows(odd, none, spark):
    rows = [("en", t) for _, t in ODD]
    assert sorted(map(tuple, collocations.collocations(odd, 2, shards=2).collect())) == plain_phrases(rows, 2)
    assert collocations.collocations(none, 2, shards=1).collect() == []
    counts, n = collocations.phrase_counts(odd, 2, 1, shards=1)
    assert counts.where("size = 1 AND phrase = 'word'").first().f == 30_000


def test_blocks_hold_the_words_in_order():
    words, numbers = collocations.encode(["A b.\tc  b;", None, "", "B\x0bd"])
    assert words.to_pylist() == [b"a", b"b", b"c", b"d"]
    assert numbers.tolist() == [1, 2, 0, 3, 2, 0, 2, 0, 4, 0]
    assert [x.tolist() for x in collocations.encode([None, " . "])[1:]] == [[]]


def test_phrases_activate_as_soon_as_their_parts_are_known():
    """One scan after both parts reached the threshold, for one cycle."""
    hashes = np.arange(1, 9, dtype=np.uint64).reshape(-1, 2)
    reached = np.full(1 << 16, collocations.NEVER, np.uint8)
    first = collocations._longer(np.zeros_like(hashes), hashes)
    reached[(first[:, 0] % len(reached)).astype(int)] = [0, 2, 1, collocations.NEVER]
    ids = np.array([1, 2, 3, 4, 0, 1, 3])
    found = {scan: [(size, p.tolist(), known.tolist()) for size, p, _, known in collocations._chain(ids, hashes, reached, scan, 5)][1:]
             for scan in range(4)}
    assert found == {0: [], 1: [], 2: [(2, [5], [1])], 3: [(2, [0, 1, 5], [2, 2, 1])]}


def test_tasks_name_a_phrase_once():
    value = np.array([[5, 1], [7, 2], [7, 3]], np.uint64)
    new, seen = collocations._unseen(value, value[:0])
    assert new.all() and seen.tolist() == value.tolist()
    new, seen = collocations._unseen(np.array([[1, 1], [5, 1], [5, 2], [9, 9]], np.uint64), seen)
    assert new.tolist() == [True, False, True, True]
    assert seen.tolist() == [[1, 1], [5, 1], [5, 2], [7, 2], [7, 3], [9, 9]]


def test_words_are_looked_up_in_turns(spark, monkeypatch):
    """Many small blocks, so that every turn has some, and phrases that stand in the last turn's blocks only."""
    monkeypatch.setattr(collocations, "BLOCK", 200)
    rows = spoken(4, 120) + [("fr", f"only here {k % 3}, once more") for k in range(30)]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(3), 10)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 10)


def test_only_the_last_scans_stay_on_disk(spark, monkeypatch):
    """The first scans are gone, and the counts are those of whole cycles."""
    gone, forget = [], collocations._forget
    monkeypatch.setattr(collocations, "_forget", lambda s, path: (gone.append(path), forget(s, path)))
    rows = spoken(8, 80)
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(3), 10, shards=3)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 10)
    assert len(gone) > 2 and len(set(gone)) == len(gone)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone[0])


# --- filters -----------------------------------------------------------------

def plain_audit(rows, labels):
    """rows of (doc_id, text, source); every order applied document by document."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    docs = []
    for i, text, source in rows:
        t = text or ""
        w = re.findall("[^ \t-\r]+", t)
        duplicate = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": duplicate}
        docs.append((source or "", {x for x in fails if fails[x]}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = Counter()
        steps = []
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                failing = sum(f in d[1] for d in own)
                steps.append((f, ["".join(order), k + 1, len(left), len(gone), failing - len(gone), sum(d[1] == {f} for d in own),
                                  sum(d[2] for d in gone), sum(d[3] for d in gone)]))
        out += [(part, *row, shapley[f]) for f, row in steps]
    return sorted(out)


def test_filters_equal_walking_every_order(spark):
    rng = random.Random(5)
    texts = [prose(k, rng.choice([3, 120, 250, 400])) for k in range(20)] + [
        "A B C " * 90, "word " * 300, "50 % off | now", "", None, "CAPITALS ONLY", "a\x1cb\x85c d " * 210, "é" * 500]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["s", "s", "t", None, ""])) for _ in range(150)]
    rows += [(7, "x y z", "s")] * 3 + [(6, "x y z", "t"), (7, "x y z", "t"), (None, "x y z", "s")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 40, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {n: F.lit("mine") for n in ("part", "mask", "n", "good", "toxic", "id", "digest", "bits")})
    got = interactions.audit(interactions.cells(docs, spark.createDataFrame(labels, LABELS)))
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, labels)


def test_filters_of_odd_and_no_rows(odd, none, spark):
    labels = spark.createDataFrame([(8, 1, 1)], LABELS)
    got = interactions.audit(interactions.cells(odd, labels))
    assert sorted(map(tuple, got.collect())) == plain_audit([(i, t, "src0") for i, t in ODD], [(8, 1, 1)])
    assert interactions.audit(interactions.cells(none, labels)).collect() == []
    assert len(interactions.audit(interactions.cells(odd, labels.limit(0))).collect()) == 600


def test_gray_walk_equals_direct_sums():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 2 ** 50, (7, 32, 3))
    masks = np.arange(32)
    direct = np.stack([cells[:, masks & active == 0].sum(axis=1) for active in range(32)], axis=1)
    assert (interactions.gray_walk(cells) == direct).all()


# --- lines -------------------------------------------------------------------

def plain_lines(rows, threshold=10):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    split = [(i, (t or "").split("\n")) for i, t in rows]
    held = Counter(k for _, lines in split for k in {key(x) for x in lines} if k)
    out = []
    for i, lines in split:
        kept = [x for x in lines if held[key(x)] < threshold]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def lined(seed, docs):
    rng = random.Random(seed)
    common = ["Share this page", "  SHARE this Page\t", "© all rights", "ÄB", "äb", "\x85kept", "\x1ckept", "Read more\r", "", "  "]
    common += [f"line {k}" for k in range(30)]
    return [(rng.choice([None, k]), rng.choice([None, "", "\n", *["\n".join(
        rng.choice(common) if rng.random() < 0.6 else f"own {seed} {rng.random()}" for _ in range(rng.randint(1, 12)))] * 9]))
        for k in range(docs)]


def results(df):
    return sorted((str(r.doc_id), r._n_lines, r._n_dropped, r.text) for r in df.collect())


@pytest.mark.parametrize("threshold, batches, fanout", [(10, 4, 3), (3, 7, 2), (1, 5, 2), (25, 1, 3)])
def test_lines_equal_whole_counts(spark, threshold, batches, fanout):
    rows = lined(threshold, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    shared = linedup.shared_line_keys(docs, threshold, batches, fanout)
    expected = plain_lines(rows, threshold)
    assert results(linedup.drop_lines(docs, shared)) == expected
    assert results(linedup.drop_lines(docs, shared, few=0)) == expected  # by join


def test_lines_of_odd_and_no_rows(odd, none, spark):
    shared = linedup.shared_line_keys(odd, 2)
    for few in (0, 100):
        out = linedup.drop_lines(odd, shared, few)
        assert set(out.columns) == {*odd.columns, "_n_lines", "_n_dropped"}
        assert results(out) == plain_lines(ODD, 2)
        assert linedup.drop_lines(none, linedup.shared_line_keys(none), few).collect() == []


def counts(spark, rows):
    return spark.createDataFrame([(k, k, n) for k, n in rows], "hi long, lo long, n long")


def test_runs_are_levelled_sorted_and_leave_out_settled_keys(spark):
    runs = linedup.LineRuns(spark, threshold=5, fanout=3)
    runs.add(counts(spark, [(k, 5 if k < 10 else 1) for k in range(100)]))
    assert runs.unsettled(counts(spark, [(3, 1), (20, 1), (200, 1)])).count() == 2
    for _ in range(3):
        runs.add(counts(spark, [(k, 1) for k in range(50)]))
    assert [r.level for r in runs.runs] == [1, 0]
    held = [spark.table(r.table) for r in runs.runs]
    assert sorted(map(tuple, held[0].where("hi < 10").select("hi", "n").collect())) == [(k, 5) for k in range(10)]
    assert held[1].where("hi < 10").count() == 0
    for path in (r.path for r in runs.runs):
        for part in spark.read.parquet(path).withColumn("file", F.input_file_name()).groupBy("file").agg(
                F.collect_list("hi").alias("hi")).collect():
            assert part.hi == sorted(part.hi)
    assert runs.shared().count() == 10
    # The state can be taken up again, and one more batch settles the rest.
    again = linedup.LineRuns(spark, threshold=5, fanout=3, runs=runs.runs)
    again.add(counts(spark, [(k, 1) for k in range(50)]))
    assert again.shared().count() == 50
    again.close()


def test_neither_join_nor_merge_shuffles_a_run(spark):
    runs = linedup.LineRuns(spark, threshold=1, fanout=9)
    for _ in range(2):
        runs.add(counts(spark, [(k, 1) for k in range(1000)]))
    assert runs.runs[1].level == 0 and spark.table(runs.runs[1].table).count() == 0  # all known
    anti = runs.unsettled(counts(spark, [(1, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert anti.count("Exchange hashpartitioning") == 1 and anti.count("SortMergeJoin") == 2
    merge = runs._merged(runs.runs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in merge and merge.count("SortMergeJoin") == 1
    runs.close()


def test_keys_of_lines():
    assert linedup.line_keys(" A\tb \r\n\n\x0bÄ\n") == [b"a\tb", b"", "Ä".encode(), b""]
    assert linedup.line_keys(None) == [b""]


def test_the_look_up_begins_with_two_blocks_however_many_there_are():
    for blocks in (0, 1, 2, 3, 100, 826, 5_000, 3_000_000):
        found = collocations.turns(blocks)
        edges = [0, *[last for _, last in found]]
        assert [first for first, _ in found] == edges[:-1] and edges[-1] == collocations.LOTS
        assert all(a < b for a, b in found)
        for k, (first, last) in enumerate(found[:-1]):
            # Before: a share of all blocks at first, so that a phrase was sent by more blocks the larger the corpus.
            wanted = max((last - first) * blocks / collocations.LOTS for first, last in found[:1])
            assert wanted <= max(collocations.FIRST_TURN, blocks / collocations.LOTS) + 1e-9
            assert last <= max((1 + collocations.GROWTH) * first + 2, found[0][1])
