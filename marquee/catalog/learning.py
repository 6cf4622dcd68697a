"""Checks: MLlib training, selection and explanation (row counts and value ranges only)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marquee import bindings as b
from marquee.catalog.registry import query
from marquee.functions import scalars
from marquee.operators import features, people, stats
from marquee.plans import learning
from marquee.session import materialise, scratch_path
from marquee.sources import readers, sinks

c = F.col


_KEPT: dict = {}


def _kept(spark, sf, name, make):
    """What several queries of one application need alike is made once."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def frame(spark, sf):
    """Facts with engineered features fitted on the train rows, written once because estimators rescan it."""
    def make():
        split = learning.with_split(b.facts(spark, sf))
        return materialise(features.engineered_features(split, c("split") == "train"), "training")

    return _kept(spark, sf, "frame", make)


def _prepared(spark, sf):
    return _kept(spark, sf, "prepared", lambda: learning.prepare(frame(spark, sf)))


def _forest(spark, sf):
    """The forest of the reference's size: measured, explained and compared from one fit."""
    return _kept(spark, sf, "forest", lambda: learning.fit_on(_prepared(spark, sf), learning.regressors()["random_forest"]))


def _metrics(scored, label="revenue"):
    return stats.regression_metrics(scored, label, "predicted", by=["split"]).orderBy("split")


@query("ml_preprocess")
def ml_preprocess(spark, sf):
    dense = _prepared(spark, sf).ready.select("movie_id", "split", vector_to_array("features").alias("x"))
    return dense.select("movie_id", "split", F.size("x").alias("width"),
                        F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v).alias("squared_norm"))


@query("ml_linear")
def ml_linear(spark, sf):
    prepared = _prepared(spark, sf)
    model = learning.fit_on(prepared, learning.regressors()["linear"])
    return learning.predict(model, prepared).select("movie_id", "split", "revenue", "predicted")


@query("ml_random_forest")
def ml_random_forest(spark, sf):
    return _metrics(learning.predict(_forest(spark, sf), frame(spark, sf)))


@query("ml_gbt")
def ml_gbt(spark, sf):
    marked = frame(spark, sf).withColumn("holdout", scalars.stable_percent(c("movie_id"), 7) < 20)
    stopped = learning.fit_early_stopping(marked, "revenue", "holdout")
    curve = F.array(*[F.lit(e) for e in stopped.errors])
    return _metrics(learning.predict(stopped.model, marked)).withColumns({
        "trees": F.lit(stopped.model.stages[-1].getNumTrees), "best_round": F.lit(stopped.best), "holdout_errors": curve})


@query("ml_weighted")
def ml_weighted(spark, sf):
    weighted = materialise(features.sample_weights(frame(spark, sf)), "weighted")
    model = learning.fit(weighted, learning.regressors(weight="sample_weight")["random_forest"])
    return _metrics(learning.predict(model, weighted))


@query("ml_classifier")
def ml_classifier(spark, sf):
    df = stats.label_encode(frame(spark, sf), "success_class").withColumn("label", c("success_class_index").cast("double"))
    name, model, table = learning.select_best_classifier(df, learning.classifiers())
    rows = spark.createDataFrame(table, "candidate string, accuracy double, f1 double")
    return rows.withColumn("chosen", c("candidate") == name)


@query("ml_select_best")
def ml_select_best(spark, sf):
    df = frame(spark, sf)
    name, model, table = learning.select_best_regressor(
        _prepared(spark, sf), learning.regressors(), fitted={"random_forest": _forest(spark, sf)})
    rows = spark.createDataFrame(table, "candidate string, rows bigint, r2 double, rmse double, mae double, mape double")
    scored = learning.predict(model, df).agg(F.count("predicted").alias("scored_rows")).scalar()
    return rows.withColumns({"chosen": c("candidate") == name, "scored_rows": scored})


@query("ml_importance")
def ml_importance(spark, sf):
    return learning.importance(_forest(spark, sf), frame(spark, sf))


@query("ml_save_load")
def ml_save_load(spark, sf):
    prepared = _prepared(spark, sf)
    path = scratch_path(spark, "model")
    model = learning.fit_on(prepared, learning.regressors()["linear"])
    learning.save(model, path)
    absent = learning.load(scratch_path(spark, "no-model")) is None
    again = learning.predict(learning.load(path), frame(spark, sf)).select("movie_id", c("predicted").alias("reloaded"))
    first = learning.predict(model, prepared).select("movie_id", "predicted")
    return first.join(again, "movie_id").agg(
        F.count("*").alias("rows"), F.count_if(c("predicted") == c("reloaded")).alias("equal_rows"),
        F.lit(absent).alias("missing_model_is_none"))


@query("ml_text_quality")
def ml_text_quality(spark, sf):
    texts = learning.with_split(b.labelled_texts(spark, sf)).withColumns({
        "label": c("quality").cast("double"), "description_length": F.length("overview")})
    ready = materialise(texts, "labelled")
    model = learning.fit(ready, learning.classifiers()["logistic"], vocabulary=200)
    return learning.predict(model, ready).select("movie_id", "split", "label", "predicted")


def _people_stats(spark, sf):
    """Cached figures for closed orders, and a source of the others."""
    figures = people.stats_v2(b.credits(spark, sf))
    closed = b.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(c("o_orderkey").alias("movie_id"))
    return figures.join(closed, "movie_id", "left_semi"), lambda missing: missing.join(figures, "movie_id")


@query("enriched_titles", ctes="facts credits", sql="""
    WITH s AS (SELECT movie_id, CAST(count_if(role = 'cast') AS DOUBLE) AS n,
        coalesce(max(popularity) FILTER (role = 'cast' AND popularity > 0), 0e0) AS peak FROM credits GROUP BY 1)
    SELECT f.movie_id, coalesce(n, 0e0) AS num_cast_members, coalesce(peak, 0e0) AS max_cast_popularity,
      CASE WHEN trim(overview) IN ('', '0') THEN 'A ' || lower(primary_genre) || ' film.' ELSE overview END AS overview,
      round(popularity * 0.3e0 + vote_count * 0.001e0 + trailer_views * 0.00001e0 + trailer_likes * 0.001e0, 6) AS hype_score
    FROM facts f LEFT JOIN s USING (movie_id)""")
def enriched_titles(spark, sf):
    out = learning.enriched_titles(b.facts(spark, sf), *_people_stats(spark, sf))
    return out.select("movie_id", "num_cast_members", "max_cast_popularity", "overview",
                      F.round("hype_score", 6).alias("hype_score"))


@query("ml_enrich_retrain")
def ml_enrich_retrain(spark, sf):
    name, table = learning.enrich_retrain(b.facts(spark, sf), *_people_stats(spark, sf), scratch_path(spark, "retrained"))
    return table.withColumn("model", F.lit(name))


@query("scorecard_from_report", ctes="pred", sql="""
    SELECT 'stored validation report' AS model_type, count(*) AS total_movies, CAST(36 AS INTEGER) AS total_features,
      CAST(NULL AS DOUBLE) AS r2_score, round(sqrt(avg((actual - predicted) * (actual - predicted))), 0) AS rmse,
      round(avg(abs(actual - predicted)), 0) AS mae, round(avg(pred_error), 1) AS overall_mape,
      (SELECT round(avg(pred_error), 1) FROM (SELECT * FROM pred ORDER BY actual DESC, title, predicted LIMIT 50)) AS top50_mape
    FROM pred""")
def scorecard_from_report(spark, sf):
    row = F.struct("title", c("actual").cast("double").alias("actual_revenue"),
                   c("predicted").alias("predicted_revenue"), c("pred_error").alias("error_percentage"))
    stored = b.predictions(spark, sf).select(
        F.lit(1).cast("bigint").alias("total_count"), F.array(row).alias("results"))
    report = readers.read_report(spark, sinks.write_json(stored, scratch_path(spark, "stored-report")))
    total = b.table(spark, sf, "orders").agg(F.count("*").alias("n"))
    return learning.scorecard_from_report(report, total, 36).drop("feature_groups")
