"""Column expressions for cleaning, typing and deriving features.

All are plain Catalyst expressions: they stay inside whole-stage codegen and
tolerate ANSI mode (``try_cast``, guarded divisions, ``get`` on arrays).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions import fixed


def primary_genre(genres: Column) -> Column:
    """Name of the first genre, "Unknown" for a missing or empty list."""
    return F.coalesce(F.get(genres, F.lit(0))["name"], F.lit("Unknown"))


def to_bigint(value: Column) -> Column:
    return value.try_cast("bigint")


def trailer_popularity_index(views: Column) -> Column:
    return views / F.lit(1_000_000)


def interaction_rate(likes: Column, views: Column) -> Column:
    return F.when(views > 0, likes / views).otherwise(F.lit(0.0))


def engagement_velocity(views: Column) -> Column:
    return views / F.lit(30)


def release_month(iso_date: Column) -> Column:
    return F.coalesce(F.substring(iso_date, 6, 2).try_cast("int"), F.lit(0))


def release_year(iso_date: Column) -> Column:
    return F.regexp_extract(F.trim(iso_date), r"^(\d{4})", 1).try_cast("int")


def parse_date(iso_date: Column) -> Column:
    return iso_date.try_cast("date")


def success_class(revenue: Column, budget: Column) -> Column:
    """Training target: the share of the budget earned back, in three bands."""
    ratio = revenue / budget
    return (
        F.when(budget == 0, "Unknown")
        .when(ratio >= 3, "Hit")
        .when(ratio >= 1, "Average")
        .otherwise("Flop")
    )


def hype_score(popularity: Column, vote_count: Column, views: Column, likes: Column) -> Column:
    return popularity * 0.3 + vote_count * F.lit(0.001) + views * F.lit(0.00001) + likes * F.lit(0.001)


def overview_or_default(overview: Column, genre: Column) -> Column:
    blank = overview.isNull() | F.trim(overview).isin("", "0")
    return F.when(blank, F.concat(F.lit("A "), F.lower(genre), F.lit(" film."))).otherwise(overview)


def normalise_id(value: Column) -> Column:
    """Whole-number text of a numeric id; NULL for anything else."""
    return value.try_cast("double").try_cast("bigint").cast("string")


def clamp(value: Column, low, high) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def social_clip(value: Column, default: float, low: float, high: float) -> Column:
    """Clamp a social signal; a missing, non-finite or floor value gives the default."""
    number = value.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    clipped = clamp(F.when(finite, number).otherwise(F.lit(default)), low, high)
    return F.when(clipped <= low, F.lit(default)).otherwise(clipped)


def finite_or_zero(value: Column) -> Column:
    return F.when(F.abs(value) == float("inf"), F.lit(0.0)).otherwise(value)


def numeric_text(value: Column) -> Column:
    """Value of plain digits with at most one point; NULL for signs, exponents, ``<1``."""
    return F.when(value.rlike(fixed.NUMERIC_TEXT_PATTERN), value.try_cast("double"))


def error_pct(actual: Column, predicted: Column) -> Column:
    return F.abs(predicted - actual) / F.greatest(actual, F.lit(1.0)) * 100


def has_signal(views: Column, popularity: Column) -> Column:
    """Row filter: engagement exists, or the title is popular anyway."""
    return (views > 0) | (popularity >= 40)


def imputed_views(views: Column, popularity: Column, vote_average: Column) -> Column:
    return F.when(views == 0, popularity * vote_average * 5000).otherwise(views.cast("double"))


def vote_power(vote_average: Column, vote_count: Column) -> Column:
    return vote_average * vote_count


def budget_popularity_ratio(budget: Column, popularity: Column) -> Column:
    return F.when(popularity > 0, budget / popularity).otherwise(F.lit(0.0))


def budget_tier(budget: Column) -> Column:
    """0 (none) to 5 (above 200 million)."""
    edges = [0, 1_000_000, 10_000_000, 50_000_000, 100_000_000, 200_000_000]
    tier = F.lit(0)
    for number, edge in enumerate(edges[1:], start=1):
        tier = F.when(budget >= edge, F.lit(number)).otherwise(tier)
    return tier


def is_sequel(title: Column) -> Column:
    pattern = r"(?i)\b(?:part|chapter|vol)\b|\s(?:\d+|ii|iii|iv|v|vi|vii|viii|ix|x)$"
    return F.trim(title).rlike(pattern).cast("int")


def stable_percent(key: Column, seed: int) -> Column:
    """0..99 from a hash of the key: the same on every run and partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def stable_split(key: Column, seed: int = 42, train_percent: int = 80) -> Column:
    return F.when(stable_percent(key, seed) < train_percent, "train").otherwise("test")


def sanitize_people(bounds: dict | None = None) -> dict[str, Column]:
    """Clamp expressions for the cast and crew columns, from the bounds table."""
    return {name: clamp(F.col(name), low, high) for name, (low, high) in (bounds or fixed.PEOPLE_BOUNDS).items()}
