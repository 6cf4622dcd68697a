"""The ordered scoring transform, used by batch and stream alike."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import fixed, rules, scalars, text
from marquee.operators import features, lexicon as lexicon_ops, people as people_ops, similarity
from marquee.operators.joins import lookup, merge_join
from marquee.session import materialise
from marquee.sources.versions import Versions

c = F.col

ROW = "_row"


class ScoringTables(NamedTuple):
    """What records are scored against, as written tables: nothing here is derived again by a batch.

    ``people``: name, popularity, roi.  ``lexicon``: token, polarity,
    subjectivity.  ``index``: the reference titles, None without any.
    """

    people: DataFrame
    lexicon: DataFrame
    index: similarity.Index | None


def publish_tables(spark: SparkSession, root: str, version: str, people: DataFrame, roi: DataFrame, lexicon: DataFrame,
                   index: similarity.Index | None = None) -> ScoringTables:
    """Derive the tables once, publish them as a version under ``root`` and open it with an index published apart."""
    store = Versions(spark, root)
    if store.current() != version:
        store.publish({"people": people_ops.known_people(people, roi),
                       "lexicon": lexicon.select("token", "polarity", "subjectivity")}, version)
    return open_tables(spark, root, version, index)


def open_tables(spark: SparkSession, root: str, version: str | None = None,
                index: similarity.Index | None = None) -> ScoringTables:
    """The published tables of one version, the current one unless named."""
    store = Versions(spark, root)
    version = version or store.current()
    return ScoringTables(store.read("people", version), store.read("lexicon", version), index)


def with_row_id(records: DataFrame) -> DataFrame:
    """The records with a row number, written: it keeps apart records whose id is repeated, NULL or missing."""
    if "movie_id" not in records.columns:
        records = records.withColumn("movie_id", F.lit(None).cast("bigint"))
    return materialise(records.withColumn(ROW, F.monotonically_increasing_id()), "records")


def apply_social(records: DataFrame, index: similarity.Index | None) -> DataFrame:
    """Social signals of the nearest reference title (or the record's own), clipped."""
    if index is not None:
        signals = similarity.social_signals(records, index, ROW)
        records = merge_join(records.drop(*fixed.SOCIAL_BOUNDS), signals.drop("source"), [ROW], "left")
    return records.withColumns({n: scalars.social_clip(c(n), *b) for n, b in fixed.SOCIAL_BOUNDS.items()})


def nlp_adjust(df: DataFrame) -> DataFrame:
    """Overview polarity (``sentiment_score``) corrects sentiment, popularity and hype."""
    score = c("sentiment_score")
    poor = score < -0.15
    return df.withColumns({
        "youtube_sentiment": F.when((score > 0.3) & (c("youtube_sentiment") == 5.0), F.lit(7.5))
        .when(poor, F.least(c("youtube_sentiment"), F.lit(2.5))).otherwise(c("youtube_sentiment")),
        "popularity": F.when(poor, F.least(c("popularity"), F.greatest(F.lit(5.0), c("popularity") * 0.3)))
        .otherwise(c("popularity")),
        "hype_score": F.when(poor, F.least(c("hype_score"), F.lit(0.2))).otherwise(c("hype_score")),
    })


def cast_blend(df: DataFrame, found: DataFrame | None = None, key: str = "movie_id") -> DataFrame:
    """Blend in statistics of people the overview names (overviews over 20 characters).

    ``found`` has one row per key; without it they stand in the struct column ``cast``.
    """
    if found is not None:
        df = df.join(found.select(key, F.struct(*fixed.CAST_FEATURES).alias("cast")), key, "left")
    joined = df.withColumns({f"_f_{n}": c("cast")[n] for n in fixed.CAST_FEATURES}).drop("cast")
    applies = c("_f_avg_cast_popularity").isNotNull() & (F.length("overview") > 20)
    changed = {
        "avg_cast_popularity": rules.blended(c("avg_cast_popularity"), c("_f_avg_cast_popularity")),
        "max_cast_popularity": F.greatest("max_cast_popularity", "_f_max_cast_popularity"),
        "star_power_score": rules.blended(c("star_power_score"), c("_f_star_power_score")),
        "num_cast_members": F.when(c("num_cast_members") <= 1, c("_f_num_cast_members")).otherwise(
            c("num_cast_members")),
    }
    blended = joined.withColumns({n: F.when(applies, v).otherwise(c(n)) for n, v in changed.items()})
    return people_ops.sanitize(blended.drop(*[f"_f_{n}" for n in fixed.CAST_FEATURES]))


def reputation_apply(df: DataFrame, reputation: DataFrame | None = None, key: str = "movie_id") -> DataFrame:
    """Fill absent director signals, scale six people signals, lift the past return.

    ``reputation`` has one row per key; without it it stands in the struct column ``reputation``.
    """
    fields = ["factor", "avg_popularity", "max_popularity", "avg_historical_roi"]
    if reputation is not None:
        df = df.join(reputation.select(key, F.struct(*fields).alias("reputation")), key, "left")
    joined = df.withColumns(dict(zip(
        ["_factor", "_avg", "_max", "_roi"], [c("reputation")[f] for f in fields]))).drop("reputation")
    known = c("_factor").isNotNull()

    def filled(name: str, source: str):
        return F.when((c(name) <= 0) & (c(source) > 0), c(source)).otherwise(c(name))

    scaled = {
        "avg_director_popularity": filled("avg_director_popularity", "_avg"),
        "max_director_popularity": filled("max_director_popularity", "_max"),
        "director_experience_score": filled("director_experience_score", "_avg"),
        "avg_cast_popularity": c("avg_cast_popularity"),
        "max_cast_popularity": c("max_cast_popularity"),
        "star_power_score": c("star_power_score"),
    }
    changed = {n: F.when(known, v * c("_factor")).otherwise(c(n)) for n, v in scaled.items()}
    changed["avg_cast_historical_roi"] = F.when(
        known & (c("_roi") > 0), F.greatest("avg_cast_historical_roi", "_roi")).otherwise(c("avg_cast_historical_roi"))
    return people_ops.sanitize(joined.withColumns(changed).drop("_factor", "_avg", "_max", "_roi"))


def adjust_prediction(df: DataFrame, prediction: str = "base_prediction", out: str = "predicted_revenue") -> DataFrame:
    """Cap, cue factors, then (without an article figure) the five boosts, floored at 0."""
    overview = text.clean_overview(c("overview"))
    marked = df.withColumns({
        "_low": text.cue_hits(overview, fixed.LOW_QUALITY_CUES),
        "_high": text.cue_hits(overview, fixed.HIGH_QUALITY_CUES),
        "_franchise": text.is_franchise(c("title")),
        "_capped": rules.nonsense_cap(c(prediction), c("overview"), c("budget")),
    })
    boosts = [
        rules.franchise_factor(c("_franchise"), c("primary_genre"), c("vote_average"), c("budget")),
        rules.sentiment_factor(c("youtube_sentiment"), c("_franchise")),
        rules.cast_factor(c("num_cast_members"), c("avg_cast_popularity"), c("max_cast_popularity"),
                          c("max_director_popularity")),
        rules.tentpole_factor(c("budget"), c("primary_genre"), c("overview"), c("max_director_popularity"),
                              c("avg_cast_popularity")),
        rules.visibility_factor(c("vote_count"), c("popularity"), c("budget")),
    ]
    cued = c("_capped") * rules.low_cue_factor(c("_low")) * rules.high_cue_factor(c("_high"))
    boosted = cued
    for factor in boosts:
        boosted = boosted * factor
    has_article = c("wikipedia_worldwide_box_office") > 0
    adjusted = F.greatest(F.when(has_article, cued).otherwise(boosted), F.lit(0.0))
    return marked.withColumn(out, adjusted).drop("_high", "_franchise", "_capped").withColumnRenamed("_low", "low_hits")


def finish(df: DataFrame, prediction: str = "predicted_revenue") -> DataFrame:
    """Phrase override, low-quality guardrail, outcome class and confidence."""
    overridden = df.withColumn(prediction, rules.phrase_override(c(prediction), c("overview")))
    guarded = overridden.withColumn(prediction, rules.quality_guardrail(c(prediction), c("low_hits"), c("budget")))
    return guarded.withColumns({
        "success_class": rules.outcome_class(c(prediction), c("budget"), c("low_hits")),
        "confidence": rules.confidence(c("overview")),
    })


def score(records: DataFrame, predict: Callable[[DataFrame], DataFrame], tables: ScoringTables) -> DataFrame:
    """Records to predictions, one per record.  ``predict`` adds ``base_prediction``.

    ``movie_id`` may repeat, be NULL or be absent: what is derived from a text
    comes back to its own record by a written row number.  Only those lookups
    shuffle; every rule is a projection.
    """
    numbered = with_row_id(records)
    aligned = people_ops.sanitize(apply_social(features.align_record(numbered), tables.index))
    texts = aligned.select(ROW, "overview")
    nlp = lexicon_ops.overview_stats(texts, tables.lexicon, ROW)
    found = merge_join(nlp, people_ops.text_people(texts, tables.people, ROW), [ROW], "left")
    adjusted = nlp_adjust(merge_join(aligned, found, [ROW], "left"))
    scored = finish(adjust_prediction(predict(reputation_apply(cast_blend(adjusted)))))
    return scored.select(
        "movie_id", "title", "predicted_revenue", "success_class", "confidence",
        F.struct(
            "avg_cast_popularity", "star_power_score", c("predicted_revenue").alias("revenue_raw"),
            F.struct("sentiment_score", "subjectivity_score", "sentiment_label", "keywords", "word_count").alias(
                "nlp_analysis"),
        ).alias("debug_info"))


def linear_by_genre(train: DataFrame) -> DataFrame:
    """(genre, slope, intercept) of revenue on budget; the deterministic stand-in for a fitted model.

    Coefficients are rounded, so the figure does not hang on summation order.
    """
    usable = train.filter("budget > 0")
    y, x = c("revenue").cast("double"), c("budget").cast("double")
    fits = usable.groupBy("primary_genre").agg(
        F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.covar_pop(y, x).alias("cov"),
        F.var_pop(x).alias("var"))
    slope = F.when(c("var") > 0, c("cov") / c("var")).otherwise(F.lit(0.0))
    return fits.select(
        "primary_genre", F.round(slope, 6).alias("slope"), F.round(c("my") - slope * c("mx"), 0).alias("intercept"))


def predict_linear(coefficients: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Adds ``base_prediction`` from the genre's line; ``coefficients`` are written once, however often they are used."""
    written = materialise(coefficients, "coefficients")

    def predict(df: DataFrame) -> DataFrame:
        joined = lookup(df, written, ["primary_genre"])
        value = F.coalesce(c("intercept") + c("slope") * c("budget"), F.lit(0.0))
        return joined.withColumn("base_prediction", value).drop("slope", "intercept")

    return predict
