"""Checks: aggregates, error reports, distributions, top-k, paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee import bindings as b
from marquee.catalog.registry import query
from marquee.operators import lexicon, stats

_NUMERIC = ["revenue", "budget", "runtime", "popularity", "vote_average", "vote_count", "trailer_views",
            "trailer_likes", "interaction_rate", "engagement_velocity", "youtube_sentiment", "trend_momentum"]


def _round(df, digits=6, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("sentiment_by_movie", sql="""
    WITH s AS (SELECT conv_id AS movie_id, (length(text) % 200 - 100) / 100 AS compound FROM conversations)
    SELECT o_orderkey AS movie_id, round(coalesce(avg(compound), 0e0), 6) AS youtube_sentiment,
      round(coalesce(stddev_samp(compound), 0e0), 6) AS sentiment_volatility
    FROM orders LEFT JOIN s ON movie_id = o_orderkey GROUP BY 1""")
def sentiment_by_movie(spark, sf):
    scores = b.comments(spark, sf).select("movie_id", ((F.length("text") % 200 - 100) / 100).alias("compound"))
    titles = b.release_dates(spark, sf).select("movie_id")
    return _round(lexicon.sentiment_by_title(scores, titles), 6, "youtube_sentiment", "sentiment_volatility")


@query("dataset_stats", ctes="facts", sql="""
    SELECT count(*) AS total_movies, round(avg(revenue), 2) AS avg_revenue, round(avg(budget), 2) AS avg_budget,
      round(avg(youtube_sentiment), 6) AS avg_sentiment FROM facts""")
def dataset_stats(spark, sf):
    out = stats.dataset_stats(b.facts(spark, sf))
    return _round(_round(out, 2, "avg_revenue", "avg_budget"), 6, "avg_sentiment")


@query("error_by_genre", ctes="pred", sql="""
    SELECT primary_genre, round(avg(pred_error), 6) AS mean, count(*) AS count FROM pred GROUP BY 1""")
def error_by_genre(spark, sf):
    return _round(stats.error_by_genre(b.predictions(spark, sf)), 6, "mean")


@query("high_error_by_genre", ctes="pred", sql="""
    SELECT primary_genre, count(*) AS count FROM pred WHERE pred_error >= 40 GROUP BY 1""")
def high_error_by_genre(spark, sf):
    return stats.high_error_by_genre(b.predictions(spark, sf))


@query("high_error_profile", ctes="pred", sql="""
    SELECT round(avg(popularity) FILTER (pred_error >= 40), 6) AS high_avg_popularity,
      round(avg(popularity), 6) AS avg_popularity,
      round(avg(vote_count) FILTER (pred_error >= 40), 6) AS high_avg_vote_count,
      round(avg(vote_count), 6) AS avg_vote_count,
      count(*) FILTER (pred_error >= 40 AND trailer_views = 0) AS high_zero_views,
      count(*) FILTER (pred_error >= 40) AS high_rows FROM pred""")
def high_error_profile(spark, sf):
    return _round(stats.high_error_profile(b.predictions(spark, sf)), 6, "high_avg_popularity", "avg_popularity",
                  "high_avg_vote_count", "avg_vote_count")


@query("error_summary", ctes="pred", sql="""
    SELECT count(*) AS rows, round(avg(pred_error), 6) AS mean_error, count(*) FILTER (pred_error >= 40) AS at_least_40,
      count(*) FILTER (pred_error > 40) AS over_40, count(*) FILTER (pred_error > 100) AS over_100,
      count(*) FILTER (pred_error > 500) AS over_500, round(median(pred_error), 6) AS median_error FROM pred""")
def error_summary(spark, sf):
    return _round(stats.error_summary(b.predictions(spark, sf)), 6, "mean_error", "median_error")


@query("class_distribution", ctes="facts", sql="SELECT success_class, count(*) AS count FROM facts GROUP BY 1")
def class_distribution(spark, sf):
    return stats.class_distribution(b.facts(spark, sf))


_SIGNALS = ["trailer_views", "trailer_likes", "trailer_comments", "youtube_sentiment", "interaction_rate",
            "engagement_velocity", "trailer_popularity_index"]
_OTHERS = ["youtube_sentiment", "engagement_velocity", "interaction_rate", "trailer_popularity_index"]


@query("coverage_counts", ctes="facts", sql="SELECT count(*) AS rows, " + ", ".join(
    f"count(*) FILTER ({c} > 0) AS with_{c}" for c in _SIGNALS)
    + ", min(youtube_sentiment) AS min_sentiment, max(youtube_sentiment) AS max_sentiment, "
      "count(*) FILTER (trailer_views = 0) AS zero_views, " + ", ".join(
    f"count(*) FILTER (trailer_views = 0 AND {c} > 0) AS zero_views_with_{c}" for c in _OTHERS)
    + ", count(*) FILTER (trailer_views = 0 AND (youtube_sentiment > 0 OR engagement_velocity > 0 "
      "OR interaction_rate > 0)) AS zero_views_with_any, "
      "count(*) FILTER (trailer_views > 0 OR popularity >= 40) AS kept_rows FROM facts")
def coverage_counts(spark, sf):
    return stats.coverage_counts(b.facts(spark, sf))


@query("budget_describe", ctes="facts", sql="""
    SELECT count(*) AS count, round(avg(budget), 2) AS mean, round(stddev_samp(budget), 2) AS std, min(budget) AS min,
      max(budget) AS max, round(quantile_cont(CAST(budget AS DOUBLE), 0.25), 2) AS q25,
      round(quantile_cont(CAST(budget AS DOUBLE), 0.5), 2) AS q50,
      round(quantile_cont(CAST(budget AS DOUBLE), 0.75), 2) AS q75 FROM facts WHERE budget > 0""")
def budget_describe(spark, sf):
    return _round(stats.describe_positive(b.facts(spark, sf), "budget"), 2, "mean", "std", "q25", "q50", "q75")


@query("corr_matrix", ctes="facts", sql=" UNION ALL ".join(
    f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), 6) AS correlation FROM facts"
    for x in _NUMERIC for y in _NUMERIC))
def corr_matrix(spark, sf):
    return _round(stats.correlation_matrix(b.facts(spark, sf), _NUMERIC), 6, "correlation")


@query("corr_ranking", ctes="facts", sql="SELECT feature, round(importance, 6) AS importance FROM (" + " UNION ALL ".join(
    f"SELECT '{x}' AS feature, abs(corr({x}, revenue)) AS importance FROM facts" for x in _NUMERIC if x != "revenue")
    + ") ORDER BY importance DESC, feature LIMIT 10")
def corr_ranking(spark, sf):
    ranked = stats.correlation_ranking(b.facts(spark, sf).withColumn("constant", F.lit(1.0)), "revenue",
                                       [*_NUMERIC, "constant"], 10)
    return _round(ranked, 6, "importance")


_METRICS = """count(*) AS rows,
      round(1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(actual)), 6) AS r2,
      round(sqrt(avg((actual - predicted) * (actual - predicted))), 2) AS rmse,
      round(avg(abs(actual - predicted)), 2) AS mae, round(avg(pred_error), 6) AS mape,
      round(avg(pred_error) FILTER (actual > 0), 6) AS mape_positive,
      round(count(*) FILTER (pred_error < 40) / count(*) * 100, 6) AS share_under_40"""


@query("regression_metrics", ctes="pred", sql=f"SELECT primary_genre, {_METRICS} FROM pred GROUP BY 1")
def regression_metrics(spark, sf):
    out = stats.regression_metrics(b.predictions(spark, sf), by=["primary_genre"])
    return _round(_round(out, 6, "r2", "mape", "mape_positive", "share_under_40"), 2, "rmse", "mae")


@query("topk_mape", ctes="pred", sql="""
    SELECT count(*) AS rows, round(avg(pred_error), 6) AS topk_mape
    FROM (SELECT * FROM pred ORDER BY actual DESC, movie_id LIMIT 50)""")
def topk_mape(spark, sf):
    return _round(stats.topk_mape(b.predictions(spark, sf)), 6, "topk_mape")


@query("rank_split_error", ctes="pred", sql="""
    WITH r AS (SELECT pred_error, row_number() OVER (ORDER BY actual DESC, movie_id) AS rk FROM pred)
    SELECT round(avg(pred_error) FILTER (rk <= 100), 6) AS top_mean, count(*) FILTER (rk > 100) AS rest_rows,
      round(avg(pred_error) FILTER (rk > 100), 6) AS rest_mean, round(avg(pred_error), 6) AS all_mean FROM r""")
def rank_split_error(spark, sf):
    return _round(stats.rank_split_error(b.predictions(spark, sf)), 6, "top_mean", "rest_mean", "all_mean")


_CLASSES = ["Average", "Flop", "Hit", "Unknown"]


def _labelled(spark, sf):
    ratio = F.col("predicted") / F.col("budget")
    scored = b.predictions(spark, sf)
    guess = F.when(F.col("budget") == 0, "Unknown").when(ratio >= 3, "Hit").when(ratio >= 1, "Average").otherwise("Flop")
    safe = F.when(F.col("budget") > 0, F.round(ratio, 2)).otherwise(F.lit(0.0))
    return scored.select(
        F.col("success_class").alias("label"), guess.alias("predicted"), safe.alias("score_Hit"),
        (-safe).alias("score_Flop"), (-F.abs(safe - 2)).alias("score_Average"),
        F.when(F.col("budget") == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("score_Unknown"))


@query("classification_metrics", ctes="pred", sql="""
    WITH s AS (SELECT success_class AS label, CASE WHEN budget = 0 THEN 'Unknown' WHEN predicted / budget >= 3 THEN 'Hit'
          WHEN predicted / budget >= 1 THEN 'Average' ELSE 'Flop' END AS guess,
        CASE WHEN budget > 0 THEN round(predicted / budget, 2) ELSE 0e0 END AS safe, budget FROM pred),
      long AS (SELECT label, 'Hit' AS class, safe AS score FROM s UNION ALL SELECT label, 'Flop', -safe FROM s
        UNION ALL SELECT label, 'Average', -abs(safe - 2) FROM s
        UNION ALL SELECT label, 'Unknown', CASE WHEN budget = 0 THEN 1e0 ELSE 0e0 END FROM s),
      ranked AS (SELECT class, label = class AS pos, rank() OVER (PARTITION BY class ORDER BY score)
          + (count(*) OVER (PARTITION BY class, score) - 1) / 2 AS rk FROM long),
      aucs AS (SELECT class, (sum(rk) FILTER (pos) - count(*) FILTER (pos) * (count(*) FILTER (pos) + 1) / 2)
          / (count(*) FILTER (pos) * count(*) FILTER (NOT pos)) AS auc FROM ranked GROUP BY 1),
      f AS (SELECT c.class, count(*) FILTER (label = c.class) AS support,
          2 * count(*) FILTER (label = c.class AND guess = c.class)
          / (count(*) FILTER (label = c.class) + count(*) FILTER (guess = c.class)) AS f1
        FROM s CROSS JOIN (SELECT DISTINCT class FROM long) c GROUP BY 1)
    SELECT (SELECT round(avg(CASE WHEN label = guess THEN 1e0 ELSE 0e0 END), 6) FROM s) AS accuracy,
      (SELECT round(sum(f1 * support) / sum(support), 6) FROM f) AS f1, (SELECT round(avg(auc), 6) FROM aucs) AS auc""")
def classification_metrics(spark, sf):
    return _round(stats.classification_metrics(_labelled(spark, sf), _CLASSES), 6, "accuracy", "f1", "auc")


def _histogram_sql(column, source, bins):
    return f"""SELECT '{column}' AS name, CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 6) AS lower,
      round(lo + (g.bin + 1) * w, 6) AS upper, count({column}) AS count
    FROM range({bins}) AS g(bin) CROSS JOIN (
      SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins} AS w FROM {source})
    LEFT JOIN {source} ON least(floor(({column} - lo) / w), {bins - 1}) = g.bin GROUP BY g.bin, lo, w"""


@query("histogram", ctes="pred", sql=_histogram_sql("youtube_sentiment", "facts", 20) + " UNION ALL "
       + _histogram_sql("pred_error", "pred", 30))
def histogram(spark, sf):
    sentiment = stats.histogram(b.facts(spark, sf), "youtube_sentiment", 20)
    errors = stats.histogram(b.predictions(spark, sf), "pred_error", 30)
    both = sentiment.withColumn("name", F.lit("youtube_sentiment")).unionByName(
        errors.withColumn("name", F.lit("pred_error")))
    return _round(both, 6, "lower", "upper")


@query("density_grid", ctes="facts", sql="""
    WITH s AS (SELECT min(youtube_sentiment) AS lo, max(youtube_sentiment) AS hi, count(*) AS n,
        stddev_samp(youtube_sentiment) * pow(count(*), -0.2e0) AS h FROM facts)
    SELECT CAST(point AS INTEGER) AS point, round(lo + point * (hi - lo) / 49, 6) AS x,
      round(sum(exp(-pow((youtube_sentiment - (lo + point * ((hi - lo) / 49))) / h, 2) / 2)) / (n * h * sqrt(2 * pi())), 6)
        AS density
    FROM facts CROSS JOIN s CROSS JOIN range(50) AS g(point) GROUP BY point, lo, hi, n, h""")
def density_grid(spark, sf):
    return _round(stats.density_grid(b.facts(spark, sf), "youtube_sentiment"), 6, "x", "density")


@query("distinct_pairs", ctes="facts", sql="SELECT DISTINCT primary_genre, release_month FROM facts")
def distinct_pairs(spark, sf):
    return stats.distinct_pairs(b.facts(spark, sf), ["primary_genre", "release_month"])


@query("report_head", ctes="pred", sql="""
    SELECT movie_id, title, actual / 1000000 AS actual_millions, pred_error AS error_percentage FROM pred
    ORDER BY actual DESC, movie_id LIMIT 400""")
def report_head(spark, sf):
    head = b.predictions(spark, sf).orderBy(F.desc("actual"), "movie_id").limit(400)
    return head.select("movie_id", "title", (F.col("actual") / 1_000_000).alias("actual_millions"), "error_percentage")


@query("worst_errors", ctes="pred", sql="""
    SELECT movie_id, title, error_percentage FROM (
      SELECT movie_id, title, CASE WHEN movie_id % 71 = 0 THEN 'inf'::DOUBLE ELSE pred_error END AS error_percentage
      FROM pred) WHERE error_percentage < 'inf'::DOUBLE ORDER BY error_percentage DESC, movie_id LIMIT 15""")
def worst_errors(spark, sf):
    broken = F.when(F.col("movie_id") % 71 == 0, F.lit(float("inf"))).otherwise(F.col("error_percentage"))
    rows = b.predictions(spark, sf).withColumn("error_percentage", broken)
    return stats.worst_errors(rows).select("movie_id", "title", "error_percentage")


@query("browse_page", ctes="facts", sql=" UNION ALL ".join(f"""
    SELECT * FROM (SELECT '{name}' AS sort, movie_id, title, count(*) OVER () AS total FROM facts
      WHERE contains(lower(title), '{q}') OR contains(lower(primary_genre), '{q}')
      ORDER BY {column} DESC, movie_id LIMIT 50 OFFSET {(page - 1) * 50})"""
    for name, column, q, page in [("revenue", "revenue", "drama", 1), ("budget", "budget", "", 3),
                                  ("sentiment", "youtube_sentiment", "river", 2), ("popularity", "popularity", "shadow", 1),
                                  ("vote", "vote_average", "silent", 1)]))
def browse_page(spark, sf):
    facts = b.facts(spark, sf)
    pages = [("revenue", "Drama", 1), ("budget", "", 3), ("sentiment", "river", 2), ("popularity", "shadow", 1),
             ("vote", "silent", 1)]
    out = None
    for sort, text, page in pages:
        one = stats.browse_page(facts, text, sort, page).select(
            F.lit(sort).alias("sort"), "movie_id", "title", "total")
        out = one if out is None else out.unionByName(one)
    return out
