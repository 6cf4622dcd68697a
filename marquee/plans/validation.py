"""Validation report: filter, score with the rules, error, sort."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import scalars, text
from marquee.operators import features, joins
from marquee.plans import scoring


def validation_report(titles: DataFrame, predict: Callable[[DataFrame], DataFrame], as_of: str,
                      min_year: int = 2010) -> DataFrame:
    """(movie_id, title, actual_revenue, predicted_revenue, error_percentage), largest revenue first."""
    valid = features.validation_filter(titles.filter("revenue > 1000"), as_of, min_year)
    actual = valid.select("movie_id", F.col("revenue").cast("double").alias("actual_revenue"))
    aligned = features.align_record(features.fill_all(valid))
    scored = scoring.adjust_prediction(predict(aligned)).join(actual, "movie_id")
    kept = scored.filter((F.col("actual_revenue") > 0) & (F.col("predicted_revenue") > 0))
    return kept.select(
        "movie_id", "title", "actual_revenue", "predicted_revenue",
        scalars.error_pct(F.col("actual_revenue"), F.col("predicted_revenue")).alias("error_percentage"),
    ).orderBy(F.desc("actual_revenue"), "movie_id")


def filter_report(report: DataFrame, titles: DataFrame, as_of: str, min_year: int = 2010) -> DataFrame:
    """Stored report rows whose title passes the validation filter and whose figures are positive."""
    allowed = features.validation_filter(titles, as_of, min_year).select("title").distinct()
    positive = report.filter(
        (F.col("actual_revenue") > 0) & (F.col("predicted_revenue") > 0) & ~text.is_synthetic_title(F.col("title")))
    figures = F.struct("actual_revenue", "predicted_revenue")
    return joins.salted_lookup(positive, allowed, ["title"], figures, "left_semi").orderBy(
        F.desc("actual_revenue"), "title")
