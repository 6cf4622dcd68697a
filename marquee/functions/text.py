"""Column expressions over whole texts: tokens, cues, names, money, key phrases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions import fixed


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def sentiment_words(text: Column) -> Column:
    """Lower-case runs of letters of any script, digits and apostrophes, repeats kept."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(fixed.SENTIMENT_TOKEN_PATTERN), F.lit(0))


def tokenize(text: Column, stop_words: list[str] | None = None) -> Column:
    """Distinct tokens longer than two characters, stop words removed."""
    stop = F.array(*[F.lit(w) for w in (stop_words or fixed.STOP_WORDS)])
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.array_except(F.regexp_extract_all(lowered, F.lit(fixed.LONG_TOKEN_PATTERN), F.lit(0)), stop)


def jaccard(left: Column, right: Column) -> Column:
    shared = F.size(F.array_intersect(left, right))
    combined = F.size(left) + F.size(right) - shared
    return F.when(combined > 0, shared / combined)


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\S+"), F.lit(0)))


def clean_overview(text: Column) -> Column:
    return F.trim(F.lower(F.coalesce(text, F.lit(""))))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def cue_hits(text: Column, cues: list[str]) -> Column:
    """Number of distinct cue phrases the lower-case text contains.

    One loop over a constant array: a sum of as many ``contains`` calls would
    grow the generated method past the size the JVM compiles.
    """
    return _bind(text, lambda t: F.size(F.filter(_literals(cues), lambda cue: F.contains(t, cue))))


def contains_any(text: Column, phrases: list[str], word_boundary: bool = False) -> Column:
    if word_boundary:
        quoted = "|".join("".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in p) for p in phrases)
        return text.rlike(rf"\b(?:{quoted})\b")
    return _bind(text, lambda t: F.exists(_literals(phrases), lambda phrase: F.contains(t, phrase)))


def is_nonsense(overview: Column, budget: Column) -> Column:
    return _bind(clean_overview(overview), lambda t: ((word_count(t) < 3) & (budget > 0)) | contains_any(
        t, fixed.NONSENSE_PHRASES, word_boundary=True))


def is_synthetic_title(title: Column) -> Column:
    return F.lower(_strip(F.coalesce(title, F.lit("")))).rlike(fixed.SYNTHETIC_TITLE_PATTERN)


def is_franchise(title: Column, word_boundary: bool = False) -> Column:
    """Part markers, a digit among the last two characters, or a known series name."""
    lowered = F.lower(title)
    markers = F.contains(title, F.lit(":")) | F.contains(title, F.lit("Part"))
    numbered = title.rlike(r"\d.?$") | F.contains(lowered, F.lit(" 2")) | F.contains(lowered, F.lit(" 3"))
    known = contains_any(lowered, fixed.FRANCHISE_KEYWORDS, word_boundary)
    return markers | numbered | F.contains(lowered, F.lit("chapter")) | known


def _strip(value: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def extract_names(text: Column, inner_caps: bool = False) -> Column:
    """Distinct person names in order of appearance.

    A line is either "Name - anything" (bullet allowed) or "Role: name, name
    and name"; a name is two to four capitalised words.
    """
    part = fixed.NAME_PART_INNER_CAPS if inner_caps else fixed.NAME_PART
    full_name = rf"({part}(?:\s{part}){{1,3}})"
    leading = rf"^{full_name}\s*[-–—]"
    whole = rf"^{full_name}$"

    def names_on(line: Column) -> Column:
        stripped = F.regexp_replace(_strip(line), fixed.BULLET_PATTERN, "")
        listed = F.split(F.regexp_extract(stripped, fixed.ROLE_LINE_PATTERN, 1), fixed.NAME_SEPARATORS)
        credited = F.filter(F.transform(listed, _strip), lambda n: n.rlike(whole))
        return F.when(stripped.rlike(leading), F.array(F.regexp_extract(stripped, leading, 1))).otherwise(credited)

    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.array_distinct(F.flatten(F.transform(lines, names_on)))


def extract_money(text: Column, decimals: bool = True) -> Column:
    """Struct(box_office, domestic, budget) of money strings; the last matching line wins.

    Box-office lines give their last amount, budget lines their first.
    ``decimals=False`` stops an amount at the decimal point.
    """
    pattern = fixed.MONEY_DECIMAL_PATTERN if decimals else fixed.MONEY_PATTERN
    lines = F.split(F.coalesce(text, F.lit("")), "\n")

    def amounts(keyword: str) -> Column:
        hits = F.filter(lines, lambda line: F.contains(F.lower(line), F.lit(keyword)) & line.rlike(pattern))
        return F.regexp_extract_all(F.try_element_at(hits, F.lit(-1)), F.lit(pattern), F.lit(0))

    return F.struct(
        F.try_element_at(amounts("box office"), F.lit(-1)).alias("worldwide_box_office"),
        F.lit(None).cast("string").alias("domestic_box_office"),
        F.try_element_at(amounts("budget"), F.lit(1)).alias("budget"),
    )


def parse_money(value: Column) -> Column:
    """Money text to millions; NULL when it does not parse."""
    cleaned = F.lower(F.trim(F.regexp_replace(value, r"[$,]", "")))
    number = F.trim(F.regexp_replace(cleaned, "billion|million", "")).try_cast("double")
    return (
        F.when(F.contains(cleaned, F.lit("billion")), number * 1000)
        .when(F.contains(cleaned, F.lit("million")), number)
        .otherwise(number / 1_000_000)
    )


def key_phrases(text: Column, limit: int = 5, stop_words: list[str] | None = None) -> Column:
    """First distinct runs of words between stop words and punctuation."""
    stop = "|".join(stop_words or fixed.STOP_WORDS)
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9\s]+", "|")
    cut = F.regexp_replace(plain, rf"\b(?:{stop})\b", "|")
    runs = F.transform(F.split(cut, r"\|"), lambda r: F.trim(F.regexp_replace(r, r"\s+", " ")))
    return F.slice(F.array_distinct(F.filter(runs, lambda r: F.length(r) > 2)), 1, limit)


def polarity_label(score: Column) -> Column:
    return F.when(score > 0.1, "Positive").when(score < -0.1, "Negative").otherwise("Neutral")


def flatten_threads(items: Column) -> Column:
    """Comment texts of nested comment threads, empty when there are none."""
    texts = F.transform(items, lambda i: i["snippet"]["topLevelComment"]["snippet"]["textDisplay"])
    return F.coalesce(texts, _empty_strings())
