"""Operators that bring rows together, against brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import bagminhash, chaining, graph, lattice, placement, quantised
from marquee.llm.words import WordHashes, words

from .conftest import ODD, prose, table


def groups(edges, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2001 + k) for k in range(80)] + [(5, 5)]
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    want = groups(edges, {x for e in edges if e[0] != e[1] for x in e})
    assert {r.node: r.component for r in graph.components(frame).collect()} == want
    assert graph.components(frame.limit(0)).count() == 0


# --- shards ---

def test_shards(spark, odd, none):
    docs = table(spark, [(k, prose(k, 5)) for k in range(3000)])
    rows = placement.shard_documents(docs, placement.topology(24), placement.topology(25)).collect()
    assert {r.shard for r in rows} == set(range(24)) and len(rows) == 3000
    assert all(r.grown_shard in (r.shard, 24) for r in rows) and 60 < sum(r.grown_shard == 24 for r in rows) < 190
    for shard in range(24):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    for r in rows:
        raw = prose(r.doc_id, 5).encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    got = placement.shard_documents(odd, placement.topology(24)).collect()
    assert len(got) == len(ODD) and len({(r.shard, r.slot) for r in got}) == len(ODD)
    assert {r.size for r in got if r.doc_id == 1} == {8} and len({r.shard for r in got if r.doc_id is None}) == 1
    assert placement.shard_documents(none, placement.topology(24)).count() == 0


def test_only_a_changed_weight_moves_rows(spark):
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    before = placement.topology(12)
    heavier = [s._replace(weight=3.0) if s.shard == 5 else s for s in before]
    without = [s for s in before if s.shard != 7]
    rows = keys.select(*[placement.place(F.col("k"), t)["shard"].alias(n) for n, t in
                         (("a", before), ("b", heavier), ("c", without))]).collect()
    assert all(r.b in (r.a, 5) for r in rows) and 2 < sum(r.b == 5 for r in rows) / sum(r.a == 5 for r in rows) < 3.5
    assert all(r.c == r.a or r.a == 7 for r in rows)
    with pytest.raises(ValueError):
        placement.place(F.col("k"), [])


# --- near copies ---

def test_signatures_are_unbiased():
    rng = np.random.default_rng(2)
    for _ in range(4):
        items = rng.integers(0, 2**63, 80).astype(np.uint64)
        a = rng.integers(0, 20, 80)
        b = np.maximum(0, a + rng.integers(-5, 6, 80))
        owner = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        out = bagminhash.sign(np.concatenate([items[a > 0], items[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), owner, 2, 20_000)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((out[0] == out[1]).mean() - want) < 0.02


def changed(text, seed, n):
    rng, out = random.Random(seed), text.split()
    for at in rng.sample(range(len(out)), n):
        out[at] = f"changed{seed}x{at}"
    return " ".join(out)


@pytest.fixture(scope="module")
def copies():
    rows, k = [], 0
    for seed in range(12):
        text = prose(seed, 300)
        for n in (0, 0, 1, 3, 5, 9, 20):
            rows.append((k, changed(text, k, n)))
            k += 1
    # A long chain of copies of copies, and texts whose counts alone differ.
    text = prose(99, 300)
    for _ in range(12):
        rows.append((k, text))
        text, k = changed(text, k, 4), k + 1
    rows += [(k, "one two three four five six " * 40), (k + 1, "one two three four five six " * 44),
             (k + 2, "one two three four five six " * 90), (k + 3, "just three words"), (k + 4, "just three words")]
    return rows


def test_classes_against_brute_force(spark, copies, none):
    rows = copies + ODD
    hashes = WordHashes()
    bags = [bagminhash.counted(t, hashes) for _, t in rows]
    edges = [(x, y) for x in range(len(rows)) for y in range(x) if bagminhash.weighted_jaccard(bags[x], bags[y]) >= 0.8]
    root = groups(edges, range(len(rows)))
    ids = {}
    for x, (i, _) in enumerate(rows):
        ids.setdefault(root[x], []).append(i)
    least = lambda found: min((i for i in found if i is not None), default=None)
    want = sorted(((rows[x][0] is None, rows[x][0] or 0, least(ids[root[x]])) for x in range(len(rows))), key=str)
    out = bagminhash.near_duplicates(table(spark, rows, extra=True)).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.class_id) for r in out), key=str) == want
    stay = bagminhash.drop_near_duplicates(table(spark, rows, extra=True))
    blank = sum(not words(t) for _, t in rows)
    spoken = {root[x] for x in range(len(rows)) if words(rows[x][1])}
    assert stay.count() == len(spoken) + blank and stay.columns[5] == "node" and stay.first().node == "mine"
    assert bagminhash.near_duplicates(none).count() == 0 and bagminhash.drop_near_duplicates(none).count() == 0


# --- passages ---

def test_chain_scores_against_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        found = sorted({(i := rng.randrange(0, 200, 12), rng.randrange(0, 200, 12), rng.randrange(5, 9)): 0 for _ in range(14)})
        best, score = 0.0, []
        for k, (i, j, n) in enumerate(found):
            options = [score[e] - chaining.GAP * (i - a - m + j - b - m) for e, (a, b, m) in enumerate(found[:k]) if a + m <= i and b + m <= j]
            score.append(n + max([0.0, *options]))
            best = max(best, score[-1])
        chain = chaining.chains(found)[0]
        got = sum(found[k][2] for k in chain) - chaining.GAP * sum(
            found[y][0] - found[x][0] + found[y][1] - found[x][1] - 2 * found[x][2] for x, y in zip(chain, chain[1:]))
        assert abs(got - best) < 1e-9


def test_planted_passages(spark, none):
    shared, fuzzy = prose(500, 70), prose(501, 90)
    rows = [(k, prose(k, 200)) for k in range(30)]
    for k in (3, 7, 11, 19):
        rows[k] = (k, f"{prose(k, 80)} {shared} {prose(k + 100, 80)}")
    rows[22] = (22, f"{prose(22, 60)} {fuzzy} {prose(122, 60)}")
    rows[23] = (23, f"{prose(23, 60)} {changed(fuzzy, 1, 6)} {prose(123, 60)}")
    rows += [(40, prose(600, 120)), (41, prose(600, 120)), (42, prose(600, 30)), (43, prose(600, 30))]
    docs = table(spark, rows, extra=True)
    report = chaining.passage_report(docs).collect()
    exact = [r for r in report if r.doc_id in (3, 7, 11, 19)]
    assert len({r.doc_id for r in exact}) == 3 and {r.other_doc_id for r in exact} <= {3, 7, 11, 19}
    assert all(abs(r.start - 80) <= 1 and abs(r.end - 150) <= 1 for r in exact)
    assert len([r for r in report if {r.doc_id, r.other_doc_id} == {22, 23}]) == 1
    assert [(r.doc_id, r.other_doc_id, r.start, r.end) for r in report if r.doc_id in (40, 41)] == [(41, 40, 0, 120)]
    assert {r.doc_id for r in report} <= {3, 7, 11, 19, 22, 23, 41}
    after = {r.doc_id: r for r in chaining.drop_passages(docs).collect()}
    assert len(after) == len(rows) and sum(shared in after[k].text for k in (3, 7, 11, 19)) == 1
    assert all(after[k].text == t for k, t in rows if k not in (3, 7, 11, 19, 22, 23))
    assert all(r.n_chars == len(r.text) and r.node == "mine" for r in after.values())
    assert chaining.drop_passages(none).count() == 0 and chaining.passage_report(none).count() == 0


def noise(rng, n):
    return " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))


def pairs_found(spark, rows):
    return {frozenset((r.doc_id, r.other_doc_id)) for r in chaining.passage_report(table(spark, rows)).collect()}


def test_passages_of_blocks_that_others_hold_apart(spark):
    rng, rows, want = random.Random(12), [], set()
    for case in range(12):
        sizes = ((40, 40), (45, 45), (30, 30, 30), (48, 2))[case % 4]
        blocks = [noise(rng, n) for n in sizes]
        whole = " ".join(blocks)
        both = (20 * case, 20 * case + 1)
        rows += [(k, f"{noise(rng, 50)} {whole} {noise(rng, 50)}") for k in both]
        want.add(frozenset(both))
        for k in range(5):  # several hold the blocks apart, the other way round
            rows.append((20 * case + 2 + k, " ".join(f"{noise(rng, 30)} {b}" for b in blocks[::-1]) + " " + noise(rng, 30)))
    assert pairs_found(spark, rows) == want


def test_passages_of_repeated_wording(spark):
    rng, rows, want = random.Random(13), [], set()
    for period in range(1, 15):
        line = noise(rng, period)
        shared = " ".join([line] * (120 // period + 1))
        rows += [(2 * period + k, f"{noise(rng, 60)} {shared} {noise(rng, 60)}") for k in (0, 1)]
        want.add(frozenset((2 * period, 2 * period + 1)))
    assert pairs_found(spark, rows) == want


def test_recall_of_changed_passages(spark):
    """Against comparing the pairs themselves, at the least identity that is a passage."""
    rng, rows, want, hashes = random.Random(14), [], set(), WordHashes()
    for n, share in ((55, 0.15), (60, 0.15), (60, 0.19), (70, 0.19), (90, 0.19)):
        for _ in range(40):
            shared = noise(rng, n)
            both = [f"{noise(rng, 40)} {x} {noise(rng, 40)}" for x in (shared, changed(shared, len(rows), round(n * share)))]
            if chaining.passages(*(hashes.of(words(t)) for t in both)):
                want.add(frozenset((len(rows), len(rows) + 1)))
            rows += enumerate(both, len(rows))
    found = pairs_found(spark, rows)
    assert len(want) > 60 and found <= want and len(found) >= 0.98 * len(want)


def test_passages_of_odd_rows(odd):
    assert chaining.drop_passages(odd).count() == len(ODD)
    assert chaining.passage_report(odd).count() == 0


def test_cut_keeps_the_rest():
    assert chaining.cut("Ab, cd éf; gh!", [(1, 3)]) == "Ab, ; gh!" and chaining.cut(None, [(0, 1)]) is None
    assert chaining.cut("a b c d", [(0, 2), (1, 3)]) == " d"


# --- vectors ---

@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(120):
            rows.append((k, rng.normal(size=24).astype("f4").tolist(), label))
            k += 1
        for _ in range(15):
            base = rng.normal(size=24)
            for _ in range(6):
                rows.append((k, (base + rng.normal(size=24) * 0.14).astype("f4").tolist(), label))
                k += 1
        rows += [(k + n, rows[5][1], label) for n in range(8)] + [(k + 8, [2 * x for x in rows[5][1]], label)]
        k += 9
    rows += [(k, None, 1), (k + 1, [0.0] * 24, 1), (k + 2, [float("nan")] + [1.0] * 23, 1), (k + 3, [None] + [1.0] * 23, 1),
             (k + 4, rows[5][1], None), (k + 5, [float("inf")] * 24, 1), (k + 6, [], 1), (k + 7, [1.0, 2.0], 1), (k + 8, [2.0, 4.0], 1)]
    return rows


def usable(v, label):
    return label is not None and v and None not in v and np.isfinite(v).all() and any(v)


def test_vector_links_against_brute_force(spark, vectors):
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v, label in vectors if usable(v, label)}
    kind = {i: (label, len(v or [])) for i, v, label in vectors}
    edges = [(a, b) for a in unit for b in unit if b < a and kind[a] == kind[b] and unit[a] @ unit[b] >= 0.98]
    root = groups(edges, [r[0] for r in vectors])
    degree = {r[0]: 0 for r in vectors}
    for a, b in edges:
        degree[a] += 1
        degree[b] += 1
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in quantised.near_vectors(frame).collect()}
    assert len(got) == len(vectors) and len(edges) > 200
    assert all(got[i].n_links <= degree[i] for i in degree)
    assert sum(r.n_links for r in got.values()) >= 0.97 * 2 * len(edges)
    same = sum(got[i].component_id == root[i] for i in root)
    assert same >= 0.97 * len(root) and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert quantised.near_vectors(frame.limit(0)).count() == 0


def test_a_large_bucket_is_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(quantised, "BLOCK", 16)
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    rows = [(k, (base + rng.normal(size=16) * 0.01).astype("f4").tolist(), 1) for k in range(150)]
    got = quantised.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r.n_links for r in got} == {149} and {r.component_id for r in got} == {0}


# --- pieces ---

@pytest.fixture(scope="module")
def vocabulary():
    return lattice.read_vocabulary(lattice.vocabulary_path())


TEXTS = [prose(1, 200), "", "  two  blanks ", "line\nbreak\n\n", "▁mark ▁▁ x", "日本語 ß 🙂🙂 naïve", "a" * 300, "don't 12345 x=1;", "\t tab\r\n"]


def test_pieces_equal_the_library(spark, vocabulary, odd, none):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=lattice.vocabulary_path())
    docs = table(spark, [*enumerate(TEXTS), (100, None)])
    encoded = lattice.encode_documents(docs, vocabulary, block_rows=4).cache()
    got = {r.doc_id: list(r.ids) for r in encoded.collect()}
    assert got.pop(100) == [] and got == {k: library.encode(t) for k, t in enumerate(TEXTS)}
    back = {r.doc_id: r.text for r in lattice.decode_documents(encoded, vocabulary).collect()}
    assert all(back[k] == t.replace("▁", " ") for k, t in enumerate(TEXTS))
    assert lattice.encode_documents(none, vocabulary).count() == 0
    few = odd.where("doc_id IS NULL OR doc_id NOT IN (7)")
    assert lattice.encode_documents(few, vocabulary).count() == few.count()


def test_pieces_query_returns_ids_and_decoded_texts(spark, tmp_path):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=lattice.vocabulary_path())
    table(spark, [*enumerate(TEXTS), (None, "no id"), (100, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in lattice.op8(spark, str(tmp_path)).collect()}
    assert got[None].text == "no id" and (got[100].ids, got[100].text) == ([], "") and len(got) == len(TEXTS) + 2
    assert all(list(got[k].ids) == library.encode(t) and got[k].text == t.replace("▁", " ") for k, t in enumerate(TEXTS))


def test_viterbi_equals_the_library(spark, vocabulary):
    """The same pieces as a unigram model, with scores of their own."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(lattice.vocabulary_path(), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    rng = random.Random(9)
    for piece in model.pieces:
        if piece.type == 1:
            piece.score = -6.0 - rng.random() * 6 - 4 / len(piece.piece) if "▁" not in piece.piece[1:] else -1e9
    scores = {p.piece: p.score for p in model.pieces}
    ours = vocabulary._replace(kind="unigram", pieces=[(p, i, scores[p]) for p, i, _ in vocabulary.pieces])
    ours = ours._replace(unknown=min(p[2] for p in ours.pieces) - lattice.UNKNOWN)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    texts = [prose(k, 60) for k in range(4)] + ["日本語 naïve 🙂 don't"]
    got = {r.doc_id: list(r.ids) for r in lattice.encode_documents(table(spark, list(enumerate(texts))), ours).collect()}
    for k, text in enumerate(texts):
        total = lambda ids: sum(scores.get(library.id_to_piece(i), 0.0) for i in ids)
        assert abs(total(got[k]) - total(library.encode(text))) < 1e-3 and library.decode(got[k]) == text


def test_pieces_of_long_words_equal_the_library_and_no_document_is_shuffled(spark, vocabulary):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=lattice.vocabulary_path())
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdeインt▁ñ") for _ in range(n)) for n in (63, 64, 65, 3000)] + ["the" * 5000, "日本" * 2000]
    encoded = lattice.encode_documents(table(spark, list(enumerate(texts))).coalesce(2), vocabulary)
    assert "Exchange" not in encoded._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: list(r.ids) for r in encoded.collect()} == {k: library.encode(t) for k, t in enumerate(texts)}
