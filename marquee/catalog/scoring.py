"""Checks: scoring rules one by one, then the whole transform in batch and on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee import bindings as b
from marquee.catalog.joining import _FACTS_SQL, _TREND, _article_facts, similar_sql
from marquee.catalog.registry import query
from marquee.catalog.texts import BEST_CTE, NAMES_CTE, OVERVIEW_CTE, REPUTATION_CTE, SENTIMENT_CTE, _cues_sql
from marquee.functions import fixed, rules, text
from marquee.operators import features, joins, lexicon, people, stats
from marquee.plans import final_dataset, scoring, validation
from marquee.session import materialise, scratch_path, shared_path
from marquee.streaming.scoring_stream import score_stream

c = F.col

# --- SQL form of the rules ---

_WORDS = "|".join(fixed.NONSENSE_PHRASES)
_KNOWN = " OR ".join(f"contains(lower(title), '{w}')" for w in fixed.FRANCHISE_KEYWORDS)


def _marked(source):
    return f"""
    marked AS (SELECT *, {_cues_sql('o', fixed.LOW_QUALITY_CUES)} AS low, {_cues_sql('o', fixed.HIGH_QUALITY_CUES)} AS high,
        {_cues_sql('lower(overview)', fixed.EVENT_CUES)} AS evt,
        (title LIKE '%:%' OR title LIKE '%Part%' OR regexp_matches(right(title, 2), '[0-9]') OR lower(title) LIKE '% 2%'
          OR lower(title) LIKE '% 3%' OR lower(title) LIKE '%chapter%' OR {_KNOWN}) AS fr,
        CASE WHEN ((length(regexp_extract_all(o, '\\S+')) < 3 AND budget > 0) OR regexp_matches(o, '\\b(?:{_WORDS})\\b'))
          AND base_prediction > budget * 0.4e0 THEN budget * 0.4e0 ELSE base_prediction END AS capped
      FROM (SELECT *, trim(lower(overview)) AS o FROM {source}))"""


_LOW = "CASE WHEN low >= 2 THEN greatest(0.35e0, 1e0 - 0.1e0 * low) ELSE 1e0 END"
_HIGH = "CASE WHEN high >= 2 THEN least(1.25e0, 1e0 + 0.04e0 * high) ELSE 1e0 END"
_FRANCHISE = ("CASE WHEN NOT fr THEN 1e0 WHEN primary_genre = 'Animation' AND vote_average > 7 THEN 1.3e0 "
              "WHEN budget > 150000000 THEN 1.25e0 ELSE 1.15e0 END")
_SENTIMENT = ("CASE WHEN youtube_sentiment >= 8 AND fr THEN 1.15e0 WHEN youtube_sentiment >= 8 THEN 1.1e0 "
              "WHEN youtube_sentiment <= 3 THEN 0.9e0 ELSE 1e0 END")
_CAST = ("CASE WHEN avg_cast_popularity > 15 OR max_director_popularity > 20 THEN 1.06e0 "
         "WHEN num_cast_members >= 2 AND avg_cast_popularity < 8 AND max_director_popularity < 8 THEN 0.88e0 "
         "ELSE 1e0 END")
_TENTPOLE = ("CASE WHEN budget >= 180000000 AND lower(primary_genre) IN ('action', 'science fiction', 'adventure') "
             "AND evt >= 2 THEN CASE WHEN max_director_popularity >= 10 OR avg_cast_popularity >= 8 "
             "THEN least(1.5e0, least(1.35e0, 1.1e0 + 0.06e0 * evt) + 0.12e0) ELSE least(1.35e0, 1.1e0 + 0.06e0 * evt) END "
             "ELSE 1e0 END")
_VISIBILITY = ("CASE WHEN vote_count < 500 AND popularity < 5 AND budget > 50000000 "
               "AND (vote_count > 150 OR popularity > 1.5e0) THEN 0.85e0 ELSE 1e0 END")
_ADJUSTED = (f"greatest(CASE WHEN wikipedia_worldwide_box_office > 0 THEN capped * {_LOW} * {_HIGH} ELSE "
             f"capped * {_LOW} * {_HIGH} * {_FRANCHISE} * {_SENTIMENT} * {_CAST} * {_TENTPOLE} * {_VISIBILITY} END, 0e0)")


def _override(p):
    return (f"CASE WHEN contains(lower(overview), 'inception') AND (contains(lower(overview), 'nolan') "
            f"OR contains(lower(overview), 'dream')) AND {p} < 3e8 THEN 650000000e0 + {p} * 2e0 ELSE {p} END")


def _guard(p):
    return f"CASE WHEN low >= 3 AND budget > 0 AND {p} > budget * 2e0 THEN budget * 2e0 ELSE {p} END"


def _outcome(p):
    hit = "CASE WHEN budget >= 200000000 THEN 2.2e0 ELSE 3e0 END"
    very = "CASE WHEN budget >= 200000000 THEN 3e0 ELSE 5e0 END"
    return (f"CASE WHEN NOT budget > 0 THEN 'Unknown' WHEN low >= 3 AND {p} / budget >= {hit} THEN 'Average' "
            f"WHEN low >= 5 AND {p} / budget >= 1 THEN 'Flop' WHEN {p} / budget >= {very} THEN 'Very Hit' "
            f"WHEN {p} / budget >= {hit} OR (budget >= 200000000 AND {p} >= 700000000 AND low < 2) THEN 'Hit' "
            f"WHEN {p} / budget >= 1 THEN 'Average' ELSE 'Flop' END")


_CONFIDENCE = "CASE WHEN contains(lower(overview), 'inception') THEN 0.98e0 ELSE 0.85e0 END"
_BASED = """based AS (SELECT r.*, coalesce(intercept + slope * budget, 0e0) AS base_prediction
      FROM records r LEFT JOIN coefficients USING (primary_genre))"""
_RULES = f"WITH {_BASED}, {_marked('based')}"


def _based(spark, sf):
    fitted = scoring.linear_by_genre(b.facts(spark, sf))
    return scoring.predict_linear(fitted)(b.records(spark, sf))


def _with_cues(spark, sf):
    overview = text.clean_overview(c("overview"))
    return _based(spark, sf).withColumns({
        "low_hits": text.cue_hits(overview, fixed.LOW_QUALITY_CUES),
        "high_hits": text.cue_hits(overview, fixed.HIGH_QUALITY_CUES),
        "franchise": text.is_franchise(c("title"))})


# --- rule by rule ---


@query("baseline_regression", ctes="coefficients", sql="SELECT primary_genre, slope, intercept FROM coefficients")
def baseline_regression(spark, sf):
    return scoring.linear_by_genre(b.facts(spark, sf))


@query("nonsense_cap", ctes="records coefficients", sql=f"{_RULES} SELECT movie_id, base_prediction, capped FROM marked")
def nonsense_cap(spark, sf):
    capped = rules.nonsense_cap(c("base_prediction"), c("overview"), c("budget"))
    return _based(spark, sf).select("movie_id", "base_prediction", capped.alias("capped"))


@query("cue_adjust", ctes="records coefficients", sql=f"""{_RULES}
    SELECT movie_id, {_LOW} AS low_factor, {_HIGH} AS high_factor, base_prediction * {_LOW} * {_HIGH} AS adjusted
    FROM marked""")
def cue_adjust(spark, sf):
    low, high = rules.low_cue_factor(c("low_hits")), rules.high_cue_factor(c("high_hits"))
    return _with_cues(spark, sf).select("movie_id", low.alias("low_factor"), high.alias("high_factor"),
                                        (c("base_prediction") * low * high).alias("adjusted"))


@query("franchise_boost", ctes="records coefficients", sql=f"{_RULES} SELECT movie_id, {_FRANCHISE} AS factor FROM marked")
def franchise_boost(spark, sf):
    return _with_cues(spark, sf).select("movie_id", rules.franchise_factor(
        c("franchise"), c("primary_genre"), c("vote_average"), c("budget")).alias("factor"))


@query("sentiment_boost", ctes="records coefficients", sql=f"{_RULES} SELECT movie_id, {_SENTIMENT} AS factor FROM marked")
def sentiment_boost(spark, sf):
    return _with_cues(spark, sf).select(
        "movie_id", rules.sentiment_factor(c("youtube_sentiment"), c("franchise")).alias("factor"))


@query("cast_adjust", ctes="records", sql=f"SELECT movie_id, {_CAST} AS factor FROM records")
def cast_adjust(spark, sf):
    return b.records(spark, sf).select("movie_id", rules.cast_factor(
        c("num_cast_members"), c("avg_cast_popularity"), c("max_cast_popularity"),
        c("max_director_popularity")).alias("factor"))


@query("tentpole_boost", ctes="records coefficients", sql=f"{_RULES} SELECT movie_id, {_TENTPOLE} AS factor FROM marked")
def tentpole_boost(spark, sf):
    return b.records(spark, sf).select("movie_id", rules.tentpole_factor(
        c("budget"), c("primary_genre"), c("overview"), c("max_director_popularity"),
        c("avg_cast_popularity")).alias("factor"))


@query("low_visibility", ctes="records", sql=f"""
    SELECT movie_id, {_VISIBILITY} AS factor FROM (
      SELECT movie_id, vote_count, budget, CASE WHEN movie_id % 3 = 0 THEN popularity / 20 ELSE popularity END
        AS popularity FROM records)""")
def low_visibility(spark, sf):
    dimmed = F.when(c("movie_id") % 3 == 0, c("popularity") / 20).otherwise(c("popularity"))
    return b.records(spark, sf).withColumn("popularity", dimmed).select("movie_id", rules.visibility_factor(
        c("vote_count"), c("popularity"), c("budget")).alias("factor"))


@query("phrase_override", ctes="records coefficients", sql=f"""{_RULES}
    SELECT movie_id, {_override('p')} AS predicted FROM (SELECT *, base_prediction / 2 AS p FROM marked)""")
def phrase_override(spark, sf):
    return _based(spark, sf).select(
        "movie_id", rules.phrase_override(c("base_prediction") / 2, c("overview")).alias("predicted"))


@query("quality_guardrail", ctes="records coefficients", sql=f"""{_RULES}
    SELECT movie_id, {_guard('base_prediction')} AS predicted FROM marked""")
def quality_guardrail(spark, sf):
    return _with_cues(spark, sf).select(
        "movie_id", rules.quality_guardrail(c("base_prediction"), c("low_hits"), c("budget")).alias("predicted"))


@query("outcome_class", ctes="records coefficients", sql=f"""{_RULES}
    SELECT movie_id, {_outcome('base_prediction * 1.3e0')} AS success_class, {_CONFIDENCE} AS confidence FROM marked""")
def outcome_class(spark, sf):
    return _with_cues(spark, sf).select(
        "movie_id", rules.outcome_class(c("base_prediction") * 1.3, c("budget"), c("low_hits")).alias("success_class"),
        rules.confidence(c("overview")).alias("confidence"))


_NLP = """CASE WHEN p > 0.3e0 AND youtube_sentiment = 5 THEN 7.5e0 WHEN p < -0.15e0 THEN least(youtube_sentiment, 2.5e0)
      ELSE youtube_sentiment END AS youtube_sentiment,
    CASE WHEN p < -0.15e0 THEN least(popularity, greatest(5e0, popularity * 0.3e0)) ELSE popularity END AS popularity,
    CASE WHEN p < -0.15e0 THEN least(hype_score, 0.2e0) ELSE hype_score END AS hype_score"""
_SCORED_TEXT = """nlp AS (SELECT b.movie_id, CASE WHEN coalesce(overview, '') <> '' THEN coalesce(p, 0e0) END AS p
      FROM base b LEFT JOIN omeans ON omeans.movie_id = b.movie_id)"""


@query("nlp_adjust", ctes="records base lexicon", sql=f"""
    WITH {OVERVIEW_CTE}, {_SCORED_TEXT}
    SELECT movie_id, {_NLP} FROM records JOIN nlp USING (movie_id)""")
def nlp_adjust(spark, sf):
    records = b.records(spark, sf)
    scored = lexicon.overview_stats(records.select("movie_id", "overview"), b.lexicon(spark), "movie_id")
    return scoring.nlp_adjust(joins.merge_join(records, scored, ["movie_id"])).select(
        "movie_id", "youtube_sentiment", "popularity", "hype_score")


_FOUND = f"""{NAMES_CTE}, {BEST_CTE}, found_stats AS (SELECT movie_id, avg(popularity) AS fa, max(popularity) AS fm,
      CAST(count(*) AS INTEGER) AS fn, avg(popularity) * count(*) AS fs FROM named JOIN best USING (name) GROUP BY 1)"""


def _bounded(expression, name):
    low, high = fixed.PEOPLE_BOUNDS[name]
    return f"least(greatest({expression}, {low}), {high})"


def _blend(name, found):
    return (f"CASE WHEN fa IS NULL OR length(overview) <= 20 THEN {name} WHEN {name} <= 0 THEN {found} "
            f"WHEN {found} > {name} THEN {name} * 0.4e0 + {found} * 0.6e0 ELSE {name} END")


_BLENDED = {
    "avg_cast_popularity": _blend("avg_cast_popularity", "fa"),
    "max_cast_popularity": "CASE WHEN fa IS NULL OR length(overview) <= 20 THEN max_cast_popularity "
                           "ELSE greatest(max_cast_popularity, fm) END",
    "star_power_score": _blend("star_power_score", "fs"),
    "num_cast_members": "CASE WHEN fa IS NOT NULL AND length(overview) > 20 AND num_cast_members <= 1 THEN fn "
                        "ELSE num_cast_members END",
}


@query("cast_blend", ctes="records base people", sql=f"""
    WITH {_FOUND} SELECT movie_id, """ + ", ".join(
    f"round({_bounded(e, n)}, 6) AS {n}" if n != "num_cast_members" else f"CAST({_bounded(e, n)} AS INTEGER) AS {n}"
    for n, e in _BLENDED.items()) + " FROM records LEFT JOIN found_stats USING (movie_id)")
def cast_blend(spark, sf):
    records = b.records(spark, sf)
    found = people.text_cast_stats(records.select("movie_id", "overview"), b.people(spark, sf))
    out = scoring.cast_blend(records, found).select("movie_id", *fixed.CAST_FEATURES)
    return out.withColumns({n: F.round(n, 6) for n in fixed.CAST_FEATURES if n != "num_cast_members"})


def _filled(name, source):
    return f"CASE WHEN {name} <= 0 AND {source} > 0 THEN {source} ELSE {name} END"


_REPUTED = {
    "avg_director_popularity": _filled("avg_director_popularity", "ap"),
    "max_director_popularity": _filled("max_director_popularity", "mp"),
    "director_experience_score": _filled("director_experience_score", "ap"),
    "avg_cast_popularity": "avg_cast_popularity",
    "max_cast_popularity": "max_cast_popularity",
    "star_power_score": "star_power_score",
}
_REPUTED = {n: f"CASE WHEN factor IS NULL THEN {n} ELSE ({e}) * factor END" for n, e in _REPUTED.items()}
_REPUTED["avg_cast_historical_roi"] = (
    "CASE WHEN factor IS NOT NULL AND ar > 0 THEN greatest(avg_cast_historical_roi, ar) ELSE avg_cast_historical_roi END")


@query("reputation_apply", ctes="records base people roi", sql=f"""
    WITH {REPUTATION_CTE} SELECT movie_id, """ + ", ".join(
    f"round({_bounded(e, n)}, 6) AS {n}" for n, e in _REPUTED.items())
    + " FROM records LEFT JOIN reputation USING (movie_id)")
def reputation_apply(spark, sf):
    records = b.records(spark, sf)
    found = people.reputation(records.select("movie_id", "overview"), b.people(spark, sf), b.roi(spark, sf))
    out = scoring.reputation_apply(records, found).select("movie_id", *_REPUTED)
    return out.withColumns({n: F.round(n, 6) for n in _REPUTED})


# --- the whole transform ---


def _clip(name):
    default, low, high = fixed.SOCIAL_BOUNDS[name]
    inner = f"least(greatest({name}, {low}e0), {high}e0)"
    return f"CASE WHEN {inner} <= {low}e0 THEN {default}e0 ELSE {inner} END AS {name}"


_SOCIAL = f"""
    social AS (WITH {similar_sql('records')}
      SELECT rec.* REPLACE ({", ".join(f"coalesce(r.{n}, {d}e0) AS {n}" for n, (d, _, _) in fixed.SOCIAL_BOUNDS.items())})
      FROM records rec JOIN matched m ON m.movie_id = rec.movie_id JOIN r ON r.id = m.match_id)"""
_SCORE_SQL = f"""
    WITH {REPUTATION_CTE.replace(NAMES_CTE + ', ' + BEST_CTE, _FOUND)}, {OVERVIEW_CTE}, {_SCORED_TEXT}, {_SOCIAL},
    clean AS (SELECT * REPLACE ({", ".join(_clip(n) for n in fixed.SOCIAL_BOUNDS)},
        {", ".join(f"{_bounded(n, n)} AS {n}" for n in fixed.PEOPLE_BOUNDS)}) FROM social),
    felt AS (SELECT c.* REPLACE ({_NLP}), p FROM clean c LEFT JOIN nlp USING (movie_id)),
    blended AS (SELECT f.* REPLACE ({", ".join(f"{_bounded(e, n)} AS {n}" for n, e in _BLENDED.items())})
      FROM felt f LEFT JOIN found_stats USING (movie_id)),
    reputed AS (SELECT l.* REPLACE ({", ".join(f"{_bounded(e, n)} AS {n}" for n, e in _REPUTED.items())})
      FROM blended l LEFT JOIN reputation USING (movie_id)),
    based AS (SELECT r.*, coalesce(intercept + slope * budget, 0e0) AS base_prediction
      FROM reputed r LEFT JOIN coefficients USING (primary_genre)),
    {_marked('based')},
    adjusted AS (SELECT *, {_ADJUSTED} AS p0 FROM marked), over AS (SELECT *, {_override('p0')} AS p1 FROM adjusted),
    done AS (SELECT *, {_guard('p1')} AS predicted_revenue FROM over)
    SELECT movie_id, title, predicted_revenue,
      {_outcome('predicted_revenue')} AS success_class, {_CONFIDENCE} AS confidence"""


def _score(spark, sf):
    """Scoring against published tables: batches and micro-batches read them and derive nothing."""
    tables = scoring.publish_tables(spark, shared_path(spark, "scoring-tables", sf), "1", b.people(spark, sf), b.roi(spark, sf),
                                    b.lexicon(spark), b.reference_index(spark, sf))
    predict = scoring.predict_linear(scoring.linear_by_genre(b.facts(spark, sf)))
    return lambda records: scoring.score(records, predict, tables)


@query("score_batch", ctes="records coefficients base people roi lexicon refs", sql=_SCORE_SQL + """,
      round(avg_cast_popularity, 6) AS avg_cast_popularity, round(star_power_score, 6) AS star_power_score,
      CASE WHEN p IS NULL THEN NULL WHEN p > 0.1e0 THEN 'Positive' WHEN p < -0.1e0 THEN 'Negative' ELSE 'Neutral' END
        AS sentiment_label FROM done""")
def score_batch(spark, sf):
    scored = _score(spark, sf)(b.records(spark, sf))
    return scored.select(
        "movie_id", "title", "predicted_revenue", "success_class", "confidence",
        F.round("debug_info.avg_cast_popularity", 6).alias("avg_cast_popularity"),
        F.round("debug_info.star_power_score", 6).alias("star_power_score"),
        c("debug_info.nlp_analysis.sentiment_label").alias("sentiment_label"))


@query("stream_scoring", ctes="records coefficients base people roi lexicon refs", sql=_SCORE_SQL + " FROM done")
def stream_scoring(spark, sf):
    source, sink = scratch_path(spark, "records-in"), scratch_path(spark, "predictions-out")
    incoming = b.records(spark, sf).select("movie_id", *[name for name, _, _ in fixed.RECORD_FIELDS])
    incoming.repartition(4, "movie_id").write.parquet(source)
    running = score_stream(spark, source, sink, scratch_path(spark, "stream-state"), _score(spark, sf), max_files=2)
    running.awaitTermination()
    return spark.read.parquet(sink).drop("batch")


@query("validation_report", ctes="facts coefficients", sql=rf"""
    WITH based AS (SELECT f.* REPLACE (CAST(budget AS DOUBLE) AS budget), 0 AS num_cast_members,
        0e0 AS avg_cast_popularity, 0e0 AS max_director_popularity, 0e0 AS wikipedia_worldwide_box_office,
        coalesce(intercept + slope * CAST(budget AS DOUBLE), 0e0) AS base_prediction
      FROM facts f LEFT JOIN coefficients USING (primary_genre)
      WHERE revenue > 1000 AND NOT regexp_matches(lower(trim(title)), '^bad movie\s+\d+$')
        AND year(TRY_CAST(release_date AS DATE)) >= {b.MIN_YEAR} AND TRY_CAST(release_date AS DATE) <= DATE '{b.AS_OF}'
        AND revenue >= 50000000 AND budget >= 5000000 AND vote_count >= 100), {_marked('based')}
    SELECT movie_id, title, CAST(revenue AS DOUBLE) AS actual_revenue, p AS predicted_revenue,
      round(abs(p - revenue) / revenue * 100, 6) AS error_percentage
    FROM (SELECT *, {_ADJUSTED} AS p FROM marked) WHERE p > 0""")
def validation_report(spark, sf):
    facts = b.facts(spark, sf)
    predict = scoring.predict_linear(scoring.linear_by_genre(facts))
    report = validation.validation_report(facts, predict, b.AS_OF, b.MIN_YEAR)
    return report.withColumn("error_percentage", F.round("error_percentage", 6))


def _final(spark, sf):
    """All sources with later duplicates that must not count (or, for overviews, must)."""
    k = c("movie_id")

    def again(df, every, changes):
        once = df.withColumn("seq", F.lit(0))
        return once.unionByName(once.filter(k % every == 0).withColumns({**changes, "seq": F.lit(1)}))

    movies = again(features.clean_movies(b.movie_docs(spark, sf)), 3, {"title": F.upper("title")})
    trailers = again(features.clean_trailers(b.trailer_docs(spark, sf)), 4, {"trailer_views": F.lit(0).cast("bigint")})
    scores = lexicon.comment_scores(b.comments(spark, sf), b.lexicon(spark), ["movie_id", "turn"])
    sentiment = again(lexicon.sentiment_by_title(scores), 2, {"youtube_sentiment": F.lit(0.0)})
    trends = features.trend_momentum(b.series(spark, sf))
    articles = _article_facts(spark, sf).filter(k % 3 != 0)
    overviews = again(b.release_dates(spark, sf).select("movie_id", "overview"), 5, {"overview": F.lit("Reissue")})
    return final_dataset.build_final_dataset(
        movies, trailers, sentiment, trends, people.stats_v1(b.credits(spark, sf)), articles, overviews)


@query("final_dataset", ctes="base audience lexicon series credits", sql=f"""
    WITH spoken AS (SELECT conv_id AS movie_id, turn, text FROM conversations), {SENTIMENT_CTE},
      comp AS (SELECT movie_id, coalesce(s, 0e0) / sqrt(coalesce(s, 0e0) * coalesce(s, 0e0) + 15e0) AS compound
        FROM spoken LEFT JOIN totals USING (movie_id, turn)),
      sent AS (SELECT movie_id, avg(compound) AS ys, coalesce(stddev_samp(compound), 0e0) AS sv FROM comp GROUP BY 1),
      trends AS ({_TREND}), once AS (SELECT lower(title) AS t, trend_momentum FROM trends
        QUALIFY row_number() OVER (PARTITION BY lower(title) ORDER BY title) = 1),
      peoplestats AS (SELECT movie_id, CAST(count_if(role = 'cast') AS DOUBLE) AS n,
        max(popularity) FILTER (role = 'cast') AS peak, avg(popularity) FILTER (role = 'director') AS d
        FROM credits GROUP BY 1),
      facts AS ({_FACTS_SQL})
    SELECT b.movie_id, b.title, coalesce(a.budget, 0) AS budget, revenue,
      CASE WHEN b.movie_id % 43 = 0 OR b.movie_id % 41 = 0 THEN 'Unknown' ELSE primary_genre END AS primary_genre,
      coalesce(CASE WHEN b.movie_id % 31 = 0 AND a.movie_id IS NOT NULL THEN 0 ELSE trailer_views END, 0) AS trailer_views,
      coalesce(TRY_CAST(substr(release_date, 6, 2) AS INTEGER), 0) AS release_month,
      round(coalesce(ys, 0e0), 6) AS youtube_sentiment, round(coalesce(sv, 0e0), 6) AS sentiment_volatility,
      coalesce(trend_momentum, 0e0) AS trend_momentum, coalesce(n, 0e0) AS num_cast_members,
      coalesce(peak, 0e0) AS max_cast_popularity, round(coalesce(d, 0e0), 6) AS avg_director_popularity,
      coalesce(worldwide_box_office, 0e0) AS wikipedia_worldwide_box_office,
      coalesce(f.budget, 0e0) AS wikipedia_budget,
      CASE WHEN b.movie_id % 5 = 0 THEN 'Reissue' ELSE coalesce(overview, '') END AS overview,
      CASE WHEN coalesce(a.budget, 0) = 0 THEN 'Unknown' WHEN revenue / a.budget >= 3 THEN 'Hit'
        WHEN revenue / a.budget >= 1 THEN 'Average' ELSE 'Flop' END AS success_class
    FROM base b LEFT JOIN audience a ON a.movie_id = b.movie_id LEFT JOIN sent ON sent.movie_id = b.movie_id
      LEFT JOIN once ON t = lower(b.title) LEFT JOIN peoplestats ps ON ps.movie_id = b.movie_id
      LEFT JOIN facts f ON f.movie_id = b.movie_id AND b.movie_id % 3 <> 0""")
def final_dataset_query(spark, sf):
    out = _final(spark, sf).select(
        "movie_id", "title", "budget", "revenue", "primary_genre", "trailer_views", "release_month", "youtube_sentiment",
        "sentiment_volatility", "trend_momentum", "num_cast_members", "max_cast_popularity", "avg_director_popularity",
        "wikipedia_worldwide_box_office", "wikipedia_budget", "overview", "success_class")
    return out.withColumns({x: F.round(x, 6) for x in (
        "youtube_sentiment", "sentiment_volatility", "trend_momentum", "avg_director_popularity")})


@query("model_scorecard", ctes="pred", sql="""
    SELECT 'linear by genre' AS model_type, count(*) AS total_movies, CAST(1 AS INTEGER) AS total_features,
      round(1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(actual)), 4) AS r2_score,
      round(sqrt(avg((actual - predicted) * (actual - predicted))), 0) AS rmse,
      round(avg(abs(actual - predicted)), 0) AS mae, round(avg(pred_error), 1) AS overall_mape,
      (SELECT round(avg(pred_error), 1) FROM (SELECT * FROM pred ORDER BY actual DESC, movie_id LIMIT 50)) AS top50_mape,
      'audience,cast_crew,engineered,financial,sentiment,trailer' AS group_names,
      CAST(24 AS INTEGER) AS grouped_features FROM pred""")
def model_scorecard(spark, sf):
    from marquee.plans.learning import scorecard

    scored = b.predictions(spark, sf)
    card = scorecard(stats.regression_metrics(scored), stats.topk_mape(scored), "linear by genre", 1)
    members = F.aggregate(F.map_values("feature_groups"), F.lit(0), lambda n, group: n + F.size(group))
    return card.select(
        "*", F.array_join(F.array_sort(F.map_keys("feature_groups")), ",").alias("group_names"),
        members.alias("grouped_features")).drop("feature_groups")
