"""Quality rules as a ledger: every rule is evaluated once, its outcome kept as one bit.

``quality_ledger`` reads each text once and writes its measurements and a
bitmask of the rules it fails.  A policy is a named, dated set of rules, hence
a mask; applying one, or asking what a rule removes that no other rule does,
reads the ledger's masks and never the texts again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.registry import documents, query
from marquee.llm.words import map_texts, mix

WINDOW = 8

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_adjacent", "n_upper",
            "n_letters"]


class Rule(NamedTuple):
    """``fails`` is SQL over the measurements, in whole numbers, so that it is exact in any engine."""

    bit: int
    name: str
    fails: str


# A bit is never reused: a rule that changes gets a new one, so old ledgers keep their meaning.
RULES = [
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule(4, "capitals", "100 * n_upper > 40 * n_letters AND n_letters >= 20"),
    Rule(5, "repeated_neighbours", "100 * n_adjacent > 30 * n_words"),
    Rule(6, "word_length", "word_chars > 25 * n_words"),
    Rule(7, "no_letters", "2 * n_letters < word_chars"),
]

# Versioned: name to rules.  The base rules are in every policy.
POLICIES = {
    "base-1": ["few_words", "repeated_windows"],
    "web-1": ["few_words", "repeated_windows", "symbols", "duplicate_lines"],
    "web-2": [r.name for r in RULES],
}
PRODUCTION = "web-2"

COLUMNS = ", ".join(f"{m} long" for m in MEASURES)
_BLANK = bytes(range(9, 14)) + b" "
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in b"#*$%&|<>")


def mask(rules: list[str]) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in set(rules))


def measure(text: str | None) -> tuple:
    """The measurements of one text, in the order of ``MEASURES``; all 0 for NULL or empty."""
    import numpy as np

    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    tokens = raw.split()
    blanks = len(raw) - len(raw.translate(None, _BLANK))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = adjacent = 0
    if len(tokens) > 1:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(t, len(numbers)) for t in tokens), np.uint64, len(tokens))
        adjacent = int((ids[1:] == ids[:-1]).sum())
        if len(tokens) > WINDOW and len(numbers) < len(tokens):
            n = len(tokens) - WINDOW + 1
            windows = np.zeros(n, np.uint64)
            for k in range(WINDOW):
                windows = mix(windows * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n] + np.uint64(1))
            order = np.argsort(windows, kind="stable")
            same = windows[order[1:]] == windows[order[:-1]]
            if same.any():
                twice = np.zeros(n, bool)
                twice[order[1:][same]] = twice[order[:-1][same]] = True
                cover = np.zeros(len(tokens) + 1, np.int64)
                cover[:n] += twice
                cover[WINDOW:WINDOW + n] -= twice
                repeated = int((np.cumsum(cover[:-1]) > 0).sum())
    letters = len(text) if text.isalpha() else sum(map(str.isalpha, text))
    return (len(tokens), len(text) - blanks, len(raw.translate(None, _NOT_SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), repeated, adjacent, sum(map(str.isupper, text)), letters)


def quality_ledger(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, every measurement and ``fail_bits``, one row per input row.

    NULL and empty texts measure 0 everywhere and so fail ``few_words`` only.
    NULL and repeated ids keep their rows.  Row-local, no shuffle.
    """
    measured = map_texts(docs, lambda: measure, COLUMNS)
    bits = F.lit(0).cast("long")
    for rule in rules or RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0).cast("long"))
    return measured.withColumn("fail_bits", bits)


def passes(policy: str, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def combinations(ledger: DataFrame) -> DataFrame:
    """fail_bits, rows: the ledger reduced to the masks that occur; all questions about policies start here."""
    return ledger.groupBy("fail_bits").agg(F.count("*").alias("rows"))


def ablation(ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: rows it fails, rows only it fails, and rows kept without it."""
    rules = [r for r in RULES if r.name in POLICIES[policy]]
    whole = mask(POLICIES[policy])
    rows = []
    for r in rules:
        rows.append(F.struct(
            F.lit(r.name).alias("rule"),
            F.sum(F.when(F.col("fail_bits").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("rows")).otherwise(0)).alias("fails"),
            F.sum(F.when(F.col("fail_bits").bitwiseAND(F.lit(whole)) == 1 << r.bit, F.col("rows")).otherwise(0)).alias("alone"),
            F.sum(F.when(F.col("fail_bits").bitwiseAND(F.lit(whole & ~(1 << r.bit))) == 0, F.col("rows")).otherwise(0))
            .alias("kept_without")))
    return (combinations(ledger).agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
            .fillna(0))


def agreement(ledger: DataFrame) -> DataFrame:
    """One row: bits that every document fails (``all_fail``), that any fails (``any_fail``)."""
    return ledger.agg(F.bit_and("fail_bits").alias("all_fail"), F.bit_or("fail_bits").alias("any_fail"))


_ORACLE_FAILS = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in RULES)
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS run
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM twice CROSS JOIN (SELECT unnest(generate_series(0, {WINDOW - 1})) AS k) GROUP BY r
), m AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1]))::BIGINT AS n_adjacent,
         length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))::BIGINT AS n_letters
  FROM w LEFT JOIN covered USING (r)
), b AS (
  SELECT *, ({_ORACLE_FAILS})::BIGINT AS fail_bits FROM m
)
SELECT *, fail_bits & 3 > 0 AS base_failed, fail_bits & {mask(POLICIES[PRODUCTION])} = 0 AS kept FROM b"""


@query("op9_rule_ledger", ORACLE)
def op9(spark, sf):
    """The ledger of all documents under the production policy."""
    return (quality_ledger(documents(spark, sf))
            .withColumn("base_failed", ~passes("base-1")).withColumn("kept", passes(PRODUCTION)))
