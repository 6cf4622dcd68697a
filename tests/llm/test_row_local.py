"""Operators that look at one text at a time, against plain Python and hand-worked cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.llm import ledger, licenses, packing, pii, toxicity

from .conftest import ODD, prose, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- licenses ---

def test_phrases_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["MIT", "license", "CC", "by", "gnu", "general", "public", "Apache", "x", "é", "mit-license", "cc.by"]
    rows = [(k, " ".join(rng.choices(pool, k=40))) for k in range(40)] + ODD
    got = licenses.with_labels(licenses.scan_licenses(table(spark, rows))).collect()
    want = []
    for i, text in rows:
        w = WORD.findall(fold(text))
        hits = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(w))
                if w[k:k + len(phrase.split())] == phrase.split()]
        at = [k for k, _ in hits]
        want.append((i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("text, found", [
    ("Released under the MIT License.", [("mit", 0, 5)]),
    ("released under the terms of the mit license", [("mit", 0, 8)]),
    ("released under terms of the mit license", []),
    ("Licensed under the Apache License, Version 2.0.", [("apache-2.0", 0, 8)]),
    ("Licensed under the Apache License 2.0", [("apache-2.0", 0, 7)]),
    ("Licensed under the Apache License, Version 1.1", []),
    ("x licensed under the GNU General Public License, version 3. y", [("gpl-3.0", 1, 10)]),
    ("Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.", [("cc-by-nc-4.0", 0, 7), ("cc-by-4.0", 7, 13)]),
])
def test_templates(text, found):
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    assert [m[:3] for m in scanner.scan(text)[2]] == found


def test_notices_need_their_disclaimer():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    for label, opening, rest in (("mit", "permission is hereby", " the software is provided"),
                                 ("isc", "permission to use", " the software is provided"),
                                 ("apache-2.0", "licensed under the apache license version 2 0 the", " see the license")):
        template = next(t for k, t in licenses.TEMPLATES if k == label and t.startswith(opening))
        notice = re.sub(r"\{\{\w+:\d+-\d+\}\}", "somebody", re.sub(r"\[\[.*?\]\] ?", "", template))
        ends = lambda text: max((m[2] for m in scanner.scan(text)[2]), default=0)
        cut, words = notice.split(rest)[0], notice.split()
        # The short phrase at the start of Apache's has eight words.
        assert ends(cut) <= 8 and ends(notice) == len(words)
        assert ends(" ".join([*words[:-5], "changed", *words[-4:]])) <= 8


def test_replaceable_and_nested_regions():
    a = licenses.Automaton.compile("t", "a b [[c [[d]] e]] {{any:1-2}} f")
    accept = lambda s: a.accept(s.encode().split(), 0)
    assert accept("a b x f") == (4, 3) and accept("a b c e x y f") == (7, 3) and accept("a b c d e x f") == (7, 3)
    assert accept("a b f") is None and accept("a b x y z f") is None and accept("a b d x f") == (5, 3)
    with pytest.raises(ValueError):
        licenses.Automaton.compile("t", "[[a]] b")
    with pytest.raises(ValueError):
        licenses.Automaton.compile("t", "a [[b")


# --- rules ---

def brute_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    many = Counter(runs)
    covered = {k + d for k, run in enumerate(runs) if many[run] > 1 for d in range(8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered))


def test_measures_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choices(["a ", "b ", "c\n", "d# ", "é\t", "\n", " "], k=rng.randrange(200)))) for k in range(60)]
    rows += [(100, prose(1, 30) + " " + prose(1, 30)), (101, "\n".join(["same line"] * 5)), *ODD]
    got = [tuple(r)[:7] for r in ledger.quality_ledger(table(spark, rows)).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(((i, *brute_measures(t)) for i, t in rows), key=key)


def test_policies_and_ablation(spark):
    good = prose(7, 200)
    rows = [(1, good), (2, "short"), (3, prose(8, 30) * 3), (4, " ".join(w + "###" for w in prose(9, 60).split())),
            (5, prose(10, 60).upper())]
    book = ledger.quality_ledger(table(spark, rows))
    kept = lambda p: {r.doc_id for r in book.where(ledger.passes(p)).collect()}
    assert kept("base-1") == {1, 4, 5} and kept("web-1") == {1, 5} and kept("web-2") == {1}
    by = {r.rule: r for r in ledger.ablation(book, "web-2").collect()}
    assert (by["few_words"].fails, by["few_words"].alone, by["few_words"].kept_without) == (1, 1, 2)
    assert by["capitals"].alone == 1 and by["symbols"].fails == 1
    assert sum(r.rows for r in ledger.combinations(book).collect()) == 5
    both = ledger.agreement(book).first()
    assert both.all_fail == 0 and both.any_fail & 1


def test_ablation_of_nothing(none):
    rows = ledger.ablation(ledger.quality_ledger(none), "web-2").collect()
    assert len(rows) == len(ledger.RULES) and all(r.fails == 0 for r in rows)


# --- toxicity ---

@pytest.fixture(scope="module")
def insulted(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for k in range(600):
        toxic = int(k % 4 == 0)
        sentences = [prose((k, s), 9) for s in range(rng.randrange(3, 12))]
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] = sentences[at] + " you are a " + rng.choice(["villain", "scoundrel", "blackguard"])
        rows.append((k, ". ".join(sentences) + "."))
        labels.append((k, 1, toxic))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_location(insulted):
    docs, labels = insulted
    model = toxicity.fit(docs, labels)
    out = toxicity.score_documents(docs, model).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()
    held = [r for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 60 and sum((r.score >= 0.5) == r.toxic for r in held) >= 0.95 * len(held)
    for r in held:
        for s in r.sentences:
            assert re.search("villain|scoundrel|blackguard", r.text[s.start:s.end])
    clean = {r.doc_id for r in toxicity.clean_documents(docs, model).select("doc_id").collect()}
    assert clean == {r.doc_id for r in out if r.score < 0.5}


def test_spans_where_lower_case_is_longer():
    text = "\u0130\u0130stanbul is large. You VILLAIN! Good day."
    score, n, found = toxicity.score_text(text, toxicity.Model(-6.0, {"villain": 12.0}))
    assert score > 0.9 and n == 3 and [text[a:b] for a, b, _ in found] == [" You VILLAIN"]


def test_held_out_labels_are_not_used(insulted):
    docs, labels = insulted
    lies = labels.withColumn("toxic", F.when(F.expr("crc32(cast(doc_id AS string)) % 5 = 0"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, lies)


def test_no_labels_and_odd_rows(spark, odd, none, insulted):
    docs, labels = insulted
    model = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.score < 1e-9 for r in toxicity.score_documents(docs, model).collect()} == {True}
    assert toxicity.fit(none, labels).weights == {}
    trained = toxicity.fit(docs, labels)
    got = toxicity.score_documents(odd, trained).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.clean_documents(odd, trained).columns == odd.columns
    assert toxicity.score_documents(none, trained).count() == 0


# --- personal data ---

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0


def brute_spans(text):
    number = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(number(m)) <= 19 and luhn(number(m))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(number(m)) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_patterns_against_brute_force():
    rng = random.Random(13)
    for _ in range(3000):
        text = "".join(rng.choices("0123456789.@+-() ab%é", weights=[3] * 10 + [6, 4, 3, 2, 1, 1, 3, 4, 2, 1, 1], k=60))
        assert pii.base_spans(text) == brute_spans(text), text


def test_field_carries_labels_to_repeats_only():
    text = "card 4381893557741609 and 4381.8935.5774.1609; tel +1 (784) 555-8120, 784 555 8120; other 7845559999 12345678"
    base, added = pii.find(text)
    assert [s[0] for s in base] == ["card", "phone"]
    assert [(k, text[a:b]) for k, a, b in added] == [("card", "4381.8935.5774.1609"), ("phone", "784 555 8120")]
    assert pii.find("numbers 4381.8935.5774.1608 and 784 555 8120") == ([], [])
    assert pii.masked(text).startswith("card <CARD> and <CARD>; tel <PHONE>, <PHONE>; other 7845559999")


def test_field_reaches_national_forms_and_past_unlike_numbers():
    def added(text):
        return [text[a:b] for _, a, b in pii.find(text)[1]]

    assert added("call +49 170 1234567 or 0170 1234567") == ["0170 1234567"]
    assert added("call 0170 1234567 or +49 170 1234567") == ["0170 1234567"]
    # Unlike numbers with the same last seven digits in between.
    assert added("call +49 170 1234567, not 99 881 1234567, or 49 170 1234567") == ["49 170 1234567"]
    assert added("call +49 170 1234567, not 99 881 1234567, or 0170 1234567") == ["0170 1234567"]


def test_digest(spark, odd, none):
    text = "é a.b@c.de 10.2.3.4"
    row = table(spark, [(1, text)]).transform(lambda d: pii.find_personal_data(d)).select(
        pii._joined(F.col("base")).alias("s"), F.sha2(pii._joined(F.col("base")), 256).alias("h")).first()
    assert row.s == "email:2:10,ip:11:19" and row.h == hashlib.sha256(row.s.encode()).hexdigest()
    assert pii.find_personal_data(odd).count() == len(ODD) and pii.find_personal_data(none).count() == 0
    assert pii.mask_documents(odd).columns == odd.columns and pii.mask_documents(none).count() == 0


# --- packing ---

def reference_cost(positions, costs, length):
    best = [0] + [float("inf")] * len(positions)
    at = [0, *positions]
    for j in range(1, len(at)):
        best[j] = min((best[i] + length - (at[j] - at[i]) + costs[j - 1] for i in range(j) if at[j] - at[i] <= length))
    return best[-1]


def test_cuts_are_optimal():
    rng = random.Random(17)
    for _ in range(200):
        steps = [rng.randrange(1, 9) for _ in range(rng.randrange(1, 40))]
        positions = [sum(steps[:k + 1]) for k in range(len(steps))]
        costs = [rng.choice([0, 2, 7]) for _ in steps]
        cuts = packing.best_cuts(positions, costs, 10)
        cost = sum(costs[positions.index(c)] for c in cuts) + sum(10 - (b - a) for a, b in zip([0, *cuts], cuts))
        assert cuts[-1] == positions[-1] and max(b - a for a, b in zip([0, *cuts], cuts)) <= 10
        assert cost == reference_cost(positions, costs, 10)


def test_packed_ids_equal_the_library(spark, none):
    import numpy as np
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.tokenizer_path())
    texts = [prose(k, 300) for k in range(12)] + [
        "It's  ΣΑΣ <|endoftext|> don't x é ́ ﬁ İ ß 12ab34 \r\n a\tb …?!", "A,B;C's 日本語。 🙂🙂", "x" * 3000 + " " + "!" * 3000]
    rows = list(enumerate(texts)) + ODD[:7] + ODD[8:]
    got = packing.pack(table(spark, rows).coalesce(1), packing.tokenizer_path()).collect()
    docs = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        docs.setdefault(r.doc_id, []).append(r)
    for k, text in enumerate(texts):
        if k in {i for i, _ in ODD}:
            continue
        pieces = sorted(docs[k], key=lambda r: r.start)
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in pieces]).tolist()
        assert ids == [*library.encode(text, add_special_tokens=False).ids, 1], k
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:n]) for n in range(len(pieces))]
        assert {p.doc_tokens for p in pieces} == {len(ids)}
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:n]) for n in range(len(parts))]
        assert sum(p.length for p in parts) <= 2048
    used = sum(r.length for r in got)
    assert used / (2048 * len(sequences)) > 0.9
    assert packing.pack(none, packing.tokenizer_path()).count() == 0


def test_words_are_remembered_without_their_marks():
    import numpy as np

    words = prose(1, 40).replace(".", "").split()
    encoder = packing.Encoder(packing.tokenizer_path())
    odd = ["river", "CAF\u00c9", "Stra\u00dfe", "U.S.", "e\u0301", "don't", "3.14", "\u03a3a", "<|ENDOFTEXT|>", "a\u0338", "\u65e5\u672c"]
    for word in [*odd, *words]:
        for mark in [".", ",", ";", ":", "!", "?", "...", "?!", "'s.", ".)", "'", ""]:
            for text in (word + mark, word.upper() + mark + " x", f"({word}{mark}{word.title()}{mark}"):
                ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
                assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, text
    encoder = packing.Encoder(packing.tokenizer_path())
    encoder.encode(" ".join(w + m for w in words for m in ".,;:!?"))
    assert len(encoder.chunks) == len(set(words)) + 6  # before: a chunk for every word with each mark
