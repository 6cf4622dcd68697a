"""Personal data: four patterns, and a skip-chain field that carries their labels to repeats written another way.

The patterns give the base spans.  Around them a small conditional random field
is laid over the document's *mentions*: runs that look like a number of seven or
more digits, or like an address with ``@``.  Neighbouring mentions are linked in
a chain, and distant mentions that repeat or resemble each other (same digits,
same last digits, same local part) are linked by skip edges which reward equal
labels.  Loopy belief propagation then decides: a card number repeated with dots,
a phone number without its ``+``, an address with a port follow the label of the
mention that a pattern has recognised, while a number that resembles nothing
recognised stays unlabelled.  Base spans are evidence and never change.

No spans are labelled by hand in the tables, so the potentials below are set,
not fitted; patterns and potentials see one document at a time.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.registry import documents, query
from marquee.llm.words import map_texts

KINDS = ["email", "ip", "card", "phone"]

# The patterns and limits of the contract.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The first digit cannot follow a digit: a match from inside a run of digits would extend to the run's start.
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Mentions the field looks at.
NUMBER = re.compile(r"\+?\(?[0-9](?:[ ().:/_-]{0,2}[0-9])+")
HOST = re.compile(r"@[^\s@<>()\[\],;]+")
BREAK = frozenset(" \t\n\r\f\v@<>()[],;")
KEY_DIGITS = 7
MOST_DIGITS = 19      # of a card; longer numbers are of no kind

# Potentials (log scale).
UNLABELLED = 2.0      # a mention that no pattern recognised
IMPOSSIBLE = -8.0     # a kind that the mention's form excludes
EVIDENCE = 8.0        # a mention that a pattern recognised
NEIGHBOURS = 0.2      # equal kinds of neighbouring mentions
SAME = 3.5            # equal kinds of mentions with the same digits or address
ALIKE = 3.0           # equal kinds where one's digits end the other's, or local parts agree
ROUNDS = 12
DAMPING = 0.3

_DIGITS = re.compile(r"[0-9]+")
COLUMNS = "base array<struct<kind:string,start:int,end:int>>, added array<struct<kind:string,start:int,end:int>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the four patterns by start, then kind; in time proportional to the text."""
    out = []
    if "@" in text:
        free = 0
        for found in DOMAIN.finditer(text):
            start = found.start()
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < found.start():
                out.append(("email", start, found.end()))
                free = found.end()
    for found in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.groups()):
            out.append(("ip", *found.span()))
    for found in CARD.finditer(text):
        digits = "".join(_DIGITS.findall(found.group()))
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *found.span()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 10 <= sum(map(len, _DIGITS.findall(found.group()))) <= 15:
                out.append(("phone", *found.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, key, form) of number-like and address-like runs in reading order."""
    out = []
    for found in NUMBER.finditer(text):
        digits = "".join(_DIGITS.findall(found.group()))
        if len(digits) >= KEY_DIGITS:
            out.append((*found.span(), digits, "number"))
    if "@" in text:
        free = 0
        for found in HOST.finditer(text):
            start, end = found.start(), found.start() + len(found.group().rstrip(".:!?'\""))
            while start > free and text[start - 1] not in BREAK:
                start -= 1
            free = found.end()
            if start < found.start() and end > found.start() + 1:
                out.append((start, end, text[start:end].lower(), "address"))
    return sorted(out)


def _possible(text: str, start: int, end: int, key: str, form: str) -> list[bool]:
    if form == "address":
        return [True, False, False, False]
    dotted = text[start:end].count(".") >= 3 and len(key) <= 12 + 5
    return [False, dotted, 13 <= len(key) <= 19, KEY_DIGITS <= len(key) <= 15]


def _skip_edges(nodes: list) -> list[tuple[int, int, float]]:
    """Each mention with the last one of the same key and the last ones that resemble it; a few edges a mention at most.

    Numbers resemble each other where, without leading zeros, one's digits end the other's.
    """
    last: dict[tuple, int] = {}
    edges = []
    for k, (_, _, key, form) in enumerate(nodes):
        linked = set()

        def link(place, weight):
            if place in last and last[place] not in linked:
                linked.add(last[place])
                edges.append((last[place], k, weight))

        link((form, "key", key), SAME)
        last[form, "key", key] = k
        if form == "address":
            group = (form, "local", key.split("@")[0])
            link(group, ALIKE)
            last[group] = k
            continue
        digits = key.lstrip("0")
        ends = [digits[-n:] for n in range(KEY_DIGITS, min(len(digits), MOST_DIGITS) + 1)]
        if ends:
            link((form, "ends", digits), ALIKE)
            before = [last[form, "whole", e] for e in ends if (form, "whole", e) in last]
            if before:
                last[form, "near", digits] = max(before)
                link((form, "near", digits), ALIKE)
            last[form, "whole", digits] = k
            for e in ends:
                last[form, "ends", e] = k
        # An address with a port: its leading digits repeat an earlier mention.
        head = (form, "head", key[:KEY_DIGITS])
        if head in last and key.startswith(nodes[last[head]][2]):
            link(head, ALIKE)
        last[head] = k
    return edges


def infer(unary, edges: list[tuple[int, int, float]]):
    """Marginals by loopy belief propagation; label 0 is "none", an edge rewards equal other labels."""
    import numpy as np

    n, labels = unary.shape
    if not edges:
        return np.exp(unary - np.logaddexp.reduce(unary, axis=1, keepdims=True))
    source = np.array([e[0] for e in edges] + [e[1] for e in edges])
    target = np.array([e[1] for e in edges] + [e[0] for e in edges])
    gain = np.exp(np.array([e[2] for e in edges] * 2))[:, None] - 1
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    rewarded = np.ones(labels)
    rewarded[0] = 0
    message = np.zeros((2 * len(edges), labels))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, message)
        out = belief[source] - message[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        # sum over x of out(x) * exp(weight * [x = y, y not none])
        new = np.log(out.sum(axis=1, keepdims=True) + gain * out * rewarded)
        new -= new.max(axis=1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * new
    belief = unary.copy()
    np.add.at(belief, target, message)
    return np.exp(belief - np.logaddexp.reduce(belief, axis=1, keepdims=True))


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Mentions outside the base spans that the field labels."""
    import numpy as np

    if not base:
        return []
    nodes, known, k = mentions(text), [], 0
    for start, end, *_ in nodes:
        while k < len(base) and base[k][2] <= start:
            k += 1
        near = [s for s in base[k:k + 4] if s[1] < end and s[2] > start]
        known.append(KINDS.index(near[0][0]) if near else None)
    if None not in known:
        return []
    edges = _skip_edges(nodes)
    edges += [(i, i + 1, NEIGHBOURS) for i in range(len(nodes) - 1)]
    unary = np.full((len(nodes), len(KINDS) + 1), IMPOSSIBLE)
    for i, (start, end, key, form) in enumerate(nodes):
        if known[i] is not None:
            unary[i, 1 + known[i]] = EVIDENCE
        else:
            unary[i, 0] = UNLABELLED
            unary[i, 1:][_possible(text, start, end, key, form)] = 0.0
    chance = infer(unary, edges)
    out = []
    for i, (start, end, *_) in enumerate(nodes):
        best = int(chance[i].argmax())
        if known[i] is None and best and chance[i, best] >= 0.5:
            out.append((KINDS[best - 1], start, end))
    return out


def find(text: str | None) -> tuple[list, list]:
    text = text or ""
    if "@" not in text and not _DIGITS.search(text):
        return [], []
    base = base_spans(text)
    return base, added_spans(text, base)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``added`` spans in code points (end exclusive), one row per input row.

    NULL or empty text: no spans.  NULL and repeated ids keep their rows.
    Row-local, no shuffle; a text is held whole by one task.
    """
    return map_texts(docs, lambda: find, COLUMNS)


def masked(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    base, added = find(text)
    if not base:
        return text
    out, at = [], 0
    for kind, start, end in sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars``, where there is one, set to the new length."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [masked(t) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, batch.column(k).type) if k == at else batch.column(k) for k in range(batch.num_columns)],
                schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def _joined(spans):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["end"].alias("end"),
            s["kind"].alias("kind")))),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(ordered, ",")


@query("op10_skip_chain_pii")
def op10(spark, sf):
    """Personal data in all documents: counts and digest of the patterns' spans, and all spans."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_personal_data(documents(spark, sf)).select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"))
