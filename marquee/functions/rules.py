"""Scoring rules as Column expressions.  Multipliers apply in the order of ``plans.scoring``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions import fixed, text


def nonsense_cap(prediction: Column, overview: Column, budget: Column) -> Column:
    cap = budget * 0.4
    return F.when(text.is_nonsense(overview, budget) & (prediction > cap), cap).otherwise(prediction)


def low_cue_factor(hits: Column) -> Column:
    return F.when(hits >= 2, F.greatest(F.lit(0.35), F.lit(1.0) - F.lit(0.1) * hits)).otherwise(F.lit(1.0))


def high_cue_factor(hits: Column) -> Column:
    return F.when(hits >= 2, F.least(F.lit(1.25), F.lit(1.0) + F.lit(0.04) * hits)).otherwise(F.lit(1.0))


def franchise_factor(franchise: Column, genre: Column, vote_average: Column, budget: Column) -> Column:
    return (
        F.when(~F.coalesce(franchise, F.lit(False)), F.lit(1.0))
        .when((genre == "Animation") & (vote_average > 7.0), F.lit(1.3))
        .when(budget > 150_000_000, F.lit(1.25))
        .otherwise(F.lit(1.15))
    )


def sentiment_factor(sentiment: Column, franchise: Column) -> Column:
    return (
        F.when((sentiment >= 8.0) & franchise, F.lit(1.15))
        .when(sentiment >= 8.0, F.lit(1.1))
        .when(sentiment <= 3.0, F.lit(0.9))
        .otherwise(F.lit(1.0))
    )


def cast_factor(num_cast: Column, avg_cast: Column, max_cast: Column, max_director: Column) -> Column:
    signal = (num_cast > 0) | (avg_cast > 0) | (max_cast > 0) | (max_director > 0)
    return (
        F.when((avg_cast > 15.0) | (max_director > 20.0), F.lit(1.06))
        .when(signal & (num_cast >= 2) & (avg_cast < 8.0) & (max_director < 8.0), F.lit(0.88))
        .otherwise(F.lit(1.0))
    )


def tentpole_factor(budget: Column, genre: Column, overview: Column, max_director: Column, avg_cast: Column) -> Column:
    hits = text.cue_hits(F.lower(F.coalesce(overview, F.lit(""))), fixed.EVENT_CUES)
    tentpole = (budget >= 180_000_000) & F.lower(genre).isin(fixed.TENTPOLE_GENRES)
    base = F.least(F.lit(1.35), F.lit(1.10) + F.lit(0.06) * hits)
    led = (max_director >= 10.0) | (avg_cast >= 8.0)
    boosted = F.when(led, F.least(F.lit(1.50), base + 0.12)).otherwise(base)
    return F.when(tentpole & (hits >= 2), boosted).otherwise(F.lit(1.0))


def visibility_factor(vote_count: Column, popularity: Column, budget: Column) -> Column:
    obscure = (vote_count < 500) & (popularity < 5.0) & (budget > 50_000_000)
    some_trace = (vote_count > 150) | (popularity > 1.5)
    return F.when(obscure & some_trace, F.lit(0.85)).otherwise(F.lit(1.0))


def phrase_override(prediction: Column, overview: Column) -> Column:
    lowered = F.lower(F.coalesce(overview, F.lit("")))
    hit = F.contains(lowered, F.lit(fixed.OVERRIDE_PHRASE)) & text.contains_any(lowered, fixed.OVERRIDE_ANY)
    lifted = F.lit(fixed.OVERRIDE_BASE) + prediction * fixed.OVERRIDE_FACTOR
    return F.when(hit & (prediction < fixed.OVERRIDE_BELOW), lifted).otherwise(prediction)


def quality_guardrail(prediction: Column, low_hits: Column, budget: Column) -> Column:
    cap = budget * 2.0
    return F.when((low_hits >= 3) & (budget > 0) & (prediction > cap), cap).otherwise(prediction)


def outcome_class(prediction: Column, budget: Column, low_hits: Column) -> Column:
    big = budget >= 200_000_000
    very_hit = F.when(big, F.lit(3.0)).otherwise(F.lit(5.0))
    hit = F.when(big, F.lit(2.2)).otherwise(F.lit(3.0))
    roi = F.when(budget > 0, prediction / budget)
    return (
        F.when(~F.coalesce(budget > 0, F.lit(False)) | prediction.isNull(), "Unknown")
        .when((low_hits >= 3) & (roi >= hit), "Average")
        .when((low_hits >= 5) & (roi >= 1.0), "Flop")
        .when(roi >= very_hit, "Very Hit")
        .when((roi >= hit) | (big & (prediction >= 700_000_000) & (low_hits < 2)), "Hit")
        .when(roi >= 1.0, "Average")
        .otherwise("Flop")
    )


def confidence(overview: Column) -> Column:
    lowered = F.lower(F.coalesce(overview, F.lit("")))
    return F.when(F.contains(lowered, F.lit(fixed.OVERRIDE_PHRASE)), F.lit(0.98)).otherwise(F.lit(0.85))


def reputation_factor(avg_pop: Column, max_pop: Column, pops: Column, avg_roi: Column, rois: Column) -> Column:
    """Multiplier in 0.75..1.25 from people's popularity and past returns."""
    fame = (
        F.when((pops > 0) & ((avg_pop >= 25) | (max_pop >= 40)), F.lit(0.10))
        .when((pops > 0) & (avg_pop <= 8) & (max_pop <= 12), F.lit(-0.10))
        .otherwise(F.lit(0.0))
    )
    returns = (
        F.when((rois > 0) & (avg_roi >= 6.0), F.lit(0.08))
        .when((rois > 0) & (avg_roi <= 1.2), F.lit(-0.08))
        .otherwise(F.lit(0.0))
    )
    return F.least(F.greatest(F.lit(1.0) + fame + returns, F.lit(0.75)), F.lit(1.25))


def blended(current: Column, found: Column) -> Column:
    """Fill an absent signal, or lean 60 % towards a larger found one."""
    return F.when(current <= 0, found).when(found > current, current * 0.4 + found * 0.6).otherwise(current)
