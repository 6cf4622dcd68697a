"""Checks: projections, cleaning, scalar expressions, engineered features."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee import bindings as b
from marquee.catalog.registry import query
from marquee.functions import fixed, scalars, text
from marquee.operators import features, joins, people, stats



@query("clean_movies", ctes="base audience", sql="""
    SELECT b.movie_id, title, coalesce(budget, 0) AS budget, revenue, runtime, coalesce(popularity, 0e0) AS popularity,
      vote_average, vote_count, release_date,
      CASE WHEN b.movie_id % 43 = 0 OR b.movie_id % 41 = 0 THEN 'Unknown' ELSE primary_genre END AS primary_genre
    FROM base b LEFT JOIN audience a ON a.movie_id = b.movie_id""")
def clean_movies(spark, sf):
    return features.clean_movies(b.movie_docs(spark, sf))


@query("primary_genre", ctes="base", sql="""
    SELECT CASE WHEN movie_id % 43 = 0 OR movie_id % 41 = 0 THEN 'Unknown' ELSE primary_genre END AS primary_genre,
      count(*) AS n FROM base GROUP BY 1""")
def primary_genre(spark, sf):
    return b.movie_docs(spark, sf).groupBy(scalars.primary_genre(F.col("genres")).alias("primary_genre")).agg(
        F.count("*").alias("n"))


@query("clean_trailers", ctes="audience", sql="""
    SELECT movie_id, CASE WHEN movie_id % 31 = 0 THEN 0 ELSE trailer_views END AS trailer_views,
      CASE WHEN movie_id % 29 = 0 THEN 0 ELSE trailer_likes END AS trailer_likes, trailer_comments FROM audience""")
def clean_trailers(spark, sf):
    return features.clean_trailers(b.trailer_docs(spark, sf))


@query("fill_numeric", ctes="films", sql="""
    SELECT movie_id, title, coalesce(budget, 0) AS budget, revenue, coalesce(vote_average, 0e0) AS vote_average,
      coalesce(vote_count, 0) AS vote_count, coalesce(trailer_views, 0) AS trailer_views,
      coalesce(trailer_popularity_index, 0e0) AS trailer_popularity_index,
      coalesce(release_date, '') AS release_date, coalesce(overview, '') AS overview FROM films""")
def fill_numeric(spark, sf):
    return features.fill_all(b.films(spark, sf).select(
        "movie_id", "title", "budget", "revenue", "vote_average", "vote_count", "trailer_views",
        "trailer_popularity_index", "release_date", "overview"))


@query("engagement_features", ctes="films", sql="""
    SELECT movie_id, trailer_popularity_index, interaction_rate, engagement_velocity, release_month FROM films""")
def engagement_features(spark, sf):
    return features.engagement_features(b.release_dates(spark, sf), b.trailers(spark, sf)).select(
        "movie_id", "trailer_popularity_index", "interaction_rate", "engagement_velocity", "release_month")


@query("release_month", ctes="base", sql="""
    SELECT coalesce(TRY_CAST(substr(release_date, 6, 2) AS INTEGER), 0) AS release_month, count(*) AS n
    FROM base GROUP BY 1""")
def release_month(spark, sf):
    return b.release_dates(spark, sf).groupBy(scalars.release_month(F.col("release_date")).alias("release_month")).agg(
        F.count("*").alias("n"))


@query("release_year", ctes="base", sql=r"""
    SELECT TRY_CAST(regexp_extract(trim(release_date), '^(\d{4})', 1) AS INTEGER) AS release_year, count(*) AS n
    FROM base GROUP BY 1""")
def release_year(spark, sf):
    return b.release_dates(spark, sf).groupBy(scalars.release_year(F.col("release_date")).alias("release_year")).agg(
        F.count("*").alias("n"))


@query("success_class", ctes="facts", sql="SELECT movie_id, revenue, budget, success_class FROM facts")
def success_class(spark, sf):
    return b.facts(spark, sf).select("movie_id", "revenue", "budget", "success_class")


@query("hype_score", ctes="facts", sql="""
    SELECT movie_id, popularity * 0.3e0 + vote_count * 0.001e0 + trailer_views * 0.00001e0 + trailer_likes * 0.001e0
      AS hype_score FROM facts""")
def hype_score(spark, sf):
    return b.facts(spark, sf).select("movie_id", scalars.hype_score(
        F.col("popularity"), F.col("vote_count"), F.col("trailer_views"), F.col("trailer_likes")).alias("hype_score"))


@query("overview_default", ctes="base", sql="""
    SELECT movie_id, CASE WHEN overview IS NULL OR trim(overview) IN ('', '0')
      THEN 'A ' || lower(primary_genre) || ' film.' ELSE overview END AS overview FROM base""")
def overview_default(spark, sf):
    return b.release_dates(spark, sf).select(
        "movie_id", scalars.overview_or_default(F.col("overview"), F.col("genre_name")).alias("overview"))


@query("trailer_filter_impute", ctes="facts", sql="""
    SELECT movie_id, CASE WHEN trailer_views = 0 THEN popularity * vote_average * 5000
      ELSE CAST(trailer_views AS DOUBLE) END AS trailer_views
    FROM (SELECT movie_id, popularity, vote_average, CASE WHEN movie_id % 5 = 0 THEN 0 ELSE trailer_views END
          AS trailer_views FROM facts) WHERE trailer_views > 0 OR popularity >= 40""")
def trailer_filter_impute(spark, sf):
    lost = F.when(F.col("movie_id") % 5 == 0, F.lit(0)).otherwise(F.col("trailer_views"))
    return features.filter_and_impute_views(b.facts(spark, sf).withColumn("trailer_views", lost)).select(
        "movie_id", "trailer_views")


_RAW_ID = """CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS STRING) || '.0'
    WHEN o_orderkey % 5 = 1 THEN 'synthetic_flop_' || CAST(o_orderkey AS STRING)
    WHEN o_orderkey % 5 = 2 THEN CAST(o_orderkey AS STRING) || '.75' ELSE CAST(o_orderkey AS STRING) END"""


@query("normalise_id", sql=f"""
    SELECT o_orderkey AS movie_id, CAST(CAST(trunc(TRY_CAST(raw AS DOUBLE)) AS BIGINT) AS VARCHAR) AS clean_id
    FROM (SELECT o_orderkey, {_RAW_ID} AS raw FROM orders)""")
def normalise_id(spark, sf):
    return b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("movie_id"), scalars.normalise_id(F.expr(_RAW_ID)).alias("clean_id"))


_RAW_PEOPLE = {
    "num_cast_members": "k % 45 - 5", "num_directors": "k % 9 - 1", "num_composers": "k % 14 - 2",
    "avg_cast_popularity": "(k % 1300 - 100) / 10", "max_cast_popularity": "(k % 2600 - 100) / 10",
    "star_power_score": "(k % 90000 - 1000) / 10", "avg_cast_historical_roi": "(k % 300 - 20) / 10",
    "avg_director_popularity": "(k % 1250 - 50) / 10", "max_director_popularity": "(k % 1450 - 50) / 10",
    "director_experience_score": "(k % 1700 - 60) / 10", "avg_composer_popularity": "(k % 1110 - 50) / 10",
    "max_composer_popularity": "(k % 1330 - 50) / 10", "music_prestige_score": "(k % 1550 - 50) / 10",
}


@query("sanitize_scores", sql="SELECT k AS movie_id, " + ", ".join(
    f"CAST(least(greatest({e}, {fixed.PEOPLE_BOUNDS[c][0]}), {fixed.PEOPLE_BOUNDS[c][1]}) AS "
    f"{'BIGINT' if c.startswith('num_') else 'DOUBLE'}) AS {c}" for c, e in _RAW_PEOPLE.items())
    + " FROM (SELECT o_orderkey AS k FROM orders)")
def sanitize_scores(spark, sf):
    raw = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return people.sanitize(raw.select(F.col("k").alias("movie_id"), *[
        F.expr(e).alias(c) for c, e in _RAW_PEOPLE.items()]))


_RAW_SOCIAL = """CASE o_orderkey % 6 WHEN 0 THEN 'n/a' WHEN 1 THEN 'Infinity' WHEN 2 THEN NULL
    WHEN 3 THEN '-' || CAST(o_orderkey % 30 AS STRING) ELSE CAST(o_orderkey % 30 AS STRING) || '.5' END"""


def _clip_sql(default, low, high):
    number = f"CASE WHEN x IS NOT NULL AND NOT isnan(x) AND abs(x) <> 'inf'::DOUBLE THEN x ELSE {default}e0 END"
    clipped = f"least(greatest({number}, {low}e0), {high}e0)"
    return f"CASE WHEN {clipped} <= {low}e0 THEN {default}e0 ELSE {clipped} END"


@query("social_clip", sql="SELECT movie_id, " + ", ".join(
    f"{_clip_sql(*bounds)} AS {name}" for name, bounds in fixed.SOCIAL_BOUNDS.items())
    + f" FROM (SELECT o_orderkey AS movie_id, TRY_CAST({_RAW_SOCIAL} AS DOUBLE) AS x FROM orders)")
def social_clip(spark, sf):
    raw = F.expr(_RAW_SOCIAL)
    return b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("movie_id"),
        *[scalars.social_clip(raw, *bounds).alias(name) for name, bounds in fixed.SOCIAL_BOUNDS.items()])


_ALIGNED = ["budget", "popularity", "trailer_views", "youtube_sentiment", "overview", "primary_genre", "release_month"]


@query("align_features", ctes="base audience", sql="""
    SELECT b.movie_id, coalesce(budget, 0) AS budget, popularity, CAST(0 AS INTEGER) AS trailer_views,
      CAST(0 AS INTEGER) AS youtube_sentiment, coalesce(overview, '') AS overview, primary_genre,
      coalesce(CAST(trunc(TRY_CAST(CASE WHEN b.movie_id % 7 = 0 THEN 'x' WHEN b.movie_id % 7 = 1 THEN '3.0'
        ELSE CAST(b.movie_id % 12 + 1 AS VARCHAR) END AS DOUBLE)) AS INTEGER), 6) AS release_month,
      coalesce(CAST(popularity AS DOUBLE), 1e0) AS record_popularity, CAST(120 AS INTEGER) AS record_runtime,
      CAST(6 AS INTEGER) AS record_month, coalesce(vote_average, 5e0) AS record_vote_average
    FROM base b LEFT JOIN audience a ON a.movie_id = b.movie_id""")
def align_features(spark, sf):
    figures = b.audience(spark, sf).select("movie_id", "budget", "popularity", "vote_average")
    month = F.expr("CASE WHEN movie_id % 7 = 0 THEN 'x' WHEN movie_id % 7 = 1 THEN '3.0' "
                   "ELSE CAST(movie_id % 12 + 1 AS STRING) END")
    films = b.release_dates(spark, sf).drop("runtime").withColumnRenamed("genre_name", "primary_genre").join(
        figures, "movie_id", "left").withColumn("release_month", month).withColumn("budget", F.coalesce("budget", F.lit(0)))
    frame = features.align_features(films, _ALIGNED)
    record = features.align_record(films).select(
        "movie_id", F.col("popularity").alias("record_popularity"), F.col("runtime").alias("record_runtime"),
        F.col("release_month").alias("record_month"), F.col("vote_average").alias("record_vote_average"))
    return frame.join(record, "movie_id")


@query("validation_filter", ctes="facts", sql=rf"""
    SELECT movie_id, title, release_date FROM facts
    WHERE NOT regexp_matches(lower(trim(title)), '^bad movie\s+\d+$')
      AND year(TRY_CAST(release_date AS DATE)) >= {b.MIN_YEAR} AND TRY_CAST(release_date AS DATE) <= DATE '{b.AS_OF}'
      AND revenue >= 50000000 AND budget >= 5000000 AND vote_count >= 100""")
def validation_filter(spark, sf):
    return features.validation_filter(b.facts(spark, sf), b.AS_OF, b.MIN_YEAR).select(
        "movie_id", "title", "release_date")


@query("quality_counts", ctes="films", sql="""
    SELECT count(*) AS rows, count(*) FILTER (revenue = 0) AS zero_revenue,
      count(*) FILTER (budget = 0) AS zero_budget, count(*) FILTER (revenue = 0 AND budget = 0) AS both_zero,
      count(*) FILTER (revenue > 0 AND budget = 0) AS revenue_without_budget,
      count(*) FILTER (revenue > 1000 AND budget > 1000) AS valid,
      count(*) FILTER (revenue > 0 AND budget > 0) AS testable, count(*) FILTER (revenue > 1000) AS revenue_over_1000
    FROM (SELECT CASE WHEN movie_id % 23 = 0 THEN 0 ELSE revenue END AS revenue, coalesce(budget, 0) AS budget
          FROM films)""")
def quality_counts(spark, sf):
    revenue = F.when(F.col("movie_id") % 23 == 0, F.lit(0)).otherwise(F.col("revenue"))
    return stats.quality_counts(b.films(spark, sf).select(revenue.alias("revenue"), "budget").na.fill(0))


_GAPPY = ["budget", "popularity", "vote_average", "interaction_rate"]


@query("impute_median", ctes="films", sql="""
    WITH raw AS (SELECT movie_id, revenue, CAST(budget AS DOUBLE) AS budget, popularity, vote_average,
        CASE WHEN movie_id % 47 = 0 THEN 'inf'::DOUBLE ELSE interaction_rate END AS interaction_rate FROM films),
      m AS (SELECT median(budget) AS mb, median(popularity) AS mp, median(vote_average) AS mv,
        median(interaction_rate) AS mi FROM raw)
    SELECT movie_id, coalesce(budget, mb) AS budget, coalesce(popularity, mp) AS popularity,
      coalesce(vote_average, mv) AS vote_average,
      CASE WHEN abs(coalesce(interaction_rate, mi)) = 'inf'::DOUBLE THEN 0e0 ELSE coalesce(interaction_rate, mi) END
        AS interaction_rate
    FROM raw CROSS JOIN m WHERE revenue < 400000000""")
def impute_median(spark, sf):
    broken = F.when(F.col("movie_id") % 47 == 0, F.lit(float("inf"))).otherwise(F.col("interaction_rate"))
    raw = b.films(spark, sf).withColumn("interaction_rate", broken)
    return features.impute_median(raw, _GAPPY, below=400_000_000).select("movie_id", *_GAPPY)


@query("cast_stats_v1", ctes="credits", sql="""
    SELECT movie_id, CAST(count_if(role = 'cast') AS DOUBLE) AS num_cast_members,
      round(coalesce(avg(popularity) FILTER (role = 'cast'), 0e0), 6) AS avg_cast_popularity,
      coalesce(max(popularity) FILTER (role = 'cast'), 0e0) AS max_cast_popularity,
      round(coalesce(avg(popularity) FILTER (role = 'cast'), 0e0) * count_if(role = 'cast'), 6) AS star_power_score,
      CAST(count_if(role = 'director') AS DOUBLE) AS num_directors,
      round(coalesce(avg(popularity) FILTER (role = 'director'), 0e0), 6) AS avg_director_popularity,
      coalesce(max(popularity) FILTER (role = 'director'), 0e0) AS max_director_popularity,
      round(coalesce(avg(popularity) FILTER (role = 'director'), 0e0), 6) AS director_experience_score,
      CAST(count_if(role = 'composer') AS DOUBLE) AS num_composers,
      round(coalesce(avg(popularity) FILTER (role = 'composer'), 0e0), 6) AS avg_composer_popularity,
      coalesce(max(popularity) FILTER (role = 'composer'), 0e0) AS max_composer_popularity,
      round(coalesce(avg(popularity) FILTER (role = 'composer'), 0e0), 6) AS music_prestige_score
    FROM credits GROUP BY movie_id""")
def cast_stats_v1(spark, sf):
    return _rounded(people.stats_v1(b.credits(spark, sf)), fixed.PEOPLE_FEATURES)


@query("cast_stats_v2", ctes="credits", sql="""
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY movie_id, role ORDER BY popularity DESC, seq) AS rk
                    FROM credits)
    SELECT movie_id, CAST(count_if(role = 'cast') AS DOUBLE) AS num_cast_members,
      round(coalesce(avg(popularity) FILTER (role = 'cast' AND popularity > 0), 0e0), 6) AS avg_cast_popularity,
      coalesce(max(popularity) FILTER (role = 'cast' AND popularity > 0), 0e0) AS max_cast_popularity,
      round(coalesce(sum(popularity) FILTER (role = 'cast' AND popularity > 0 AND rk <= 3), 0e0), 6) AS star_power_score,
      CAST(count_if(role = 'director') AS DOUBLE) AS num_directors,
      round(coalesce(avg(popularity) FILTER (role = 'director' AND popularity > 0), 0e0), 6) AS avg_director_popularity,
      coalesce(max(popularity) FILTER (role = 'director' AND popularity > 0), 0e0) AS max_director_popularity,
      round(coalesce(sum(popularity) FILTER (role = 'director' AND popularity > 0), 0e0), 6) AS director_experience_score,
      CAST(count_if(role = 'composer') AS DOUBLE) AS num_composers,
      round(coalesce(avg(popularity) FILTER (role = 'composer' AND popularity > 0), 0e0), 6) AS avg_composer_popularity,
      coalesce(max(popularity) FILTER (role = 'composer' AND popularity > 0), 0e0) AS max_composer_popularity,
      round(coalesce(sum(popularity) FILTER (role = 'composer' AND popularity > 0), 0e0), 6) AS music_prestige_score
    FROM ranked GROUP BY movie_id""")
def cast_stats_v2(spark, sf):
    return _rounded(people.stats_v2(b.credits(spark, sf)), fixed.PEOPLE_FEATURES)


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Nested credit documents built row by row: up to seven cast and seven crew entries.
_CAST_SPARK = """transform(sequence(0, cast(o_orderkey % 7 as int)), i -> named_struct('name',
    concat('Actor ', cast((o_orderkey + i) % 50 as string)), 'character', '', 'popularity',
    CASE WHEN i = 2 THEN NULL ELSE cast((o_orderkey * 7 + i * 13) % 400 as double) / 10 END))"""
_CREW_SPARK = """transform(sequence(0, cast(o_orderkey % 8 as int)), i -> named_struct('name',
    concat('Crew ', cast((o_orderkey + i) % 50 as string)), 'job',
    element_at(array('Director', 'Editor', 'Original Music Composer', 'Music'), cast((o_orderkey + i) % 4 as int) + 1),
    'popularity', cast((o_orderkey * 3 + i * 11) % 300 as double) / 10))"""


def _credits_sql(top, jobs):
    return f"""
    SELECT o_orderkey AS movie_id, 'cast' AS role, CAST(i AS INTEGER) AS seq,
      'Actor ' || CAST((o_orderkey + i) % 50 AS VARCHAR) AS name,
      CASE WHEN i = 2 THEN 0e0 ELSE (o_orderkey * 7 + i * 13) % 400 / 10 END AS popularity
    FROM (SELECT o_orderkey, unnest(range(o_orderkey % 7 + 1)) AS i FROM orders) WHERE i < {top}
    UNION ALL
    SELECT movie_id, role, CAST(row_number() OVER (PARTITION BY movie_id, role ORDER BY i) - 1 AS INTEGER), name, popularity
    FROM (SELECT o_orderkey AS movie_id, i, (['director', '', 'composer', '{jobs}'])[(o_orderkey + i) % 4 + 1] AS role,
            'Crew ' || CAST((o_orderkey + i) % 50 AS VARCHAR) AS name, (o_orderkey * 3 + i * 11) % 300 / 10 AS popularity
          FROM (SELECT o_orderkey, unnest(range(o_orderkey % 8 + 1)) AS i FROM orders)) WHERE role <> ''"""


@query("credits_by_role", sql=f"""
    SELECT *, 'narrow' AS variant FROM ({_credits_sql(5, '')}) UNION ALL
    SELECT *, 'wide' AS variant FROM ({_credits_sql(10, 'composer')})""")
def credits_by_role(spark, sf):
    docs = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.expr(_CAST_SPARK).alias("cast"), F.expr(_CREW_SPARK).alias("crew"))
    narrow = people.credits_from_docs(docs).withColumn("variant", F.lit("narrow"))
    wide = people.credits_from_docs(docs, 10, people.COMPOSER_JOBS_WIDE).withColumn("variant", F.lit("wide"))
    return narrow.unionByName(wide)


@query("flatten_comments", sql="""
    SELECT conv_id AS movie_id, turn, CAST(pos AS INTEGER) AS pos, comment FROM (
      SELECT conv_id, turn, unnest(range(turn % 3 + 1)) AS pos,
        role || ' ' || CAST(unnest(range(turn % 3 + 1)) AS VARCHAR) || ': ' || text AS comment FROM conversations)
    UNION ALL SELECT -1, 0, NULL, NULL UNION ALL SELECT -2, 0, NULL, NULL""")
def flatten_comments(spark, sf):
    """Every turn as a thread of one to three comments, and two rows more: no thread, and an empty one."""
    thread = """transform(sequence(0, cast(turn % 3 as int)), i ->
        named_struct('snippet', named_struct('topLevelComment', named_struct('snippet', named_struct('textDisplay',
        concat(role, ' ', cast(i as string), ': ', text))))))"""
    threads = b.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("movie_id"), "turn", F.expr(thread).alias("items"))
    odd = spark.createDataFrame([(-1, 0, None), (-2, 0, [])], threads.schema)
    return threads.unionByName(odd).select(
        "movie_id", "turn", F.posexplode_outer(text.flatten_threads(F.col("items"))).alias("pos", "comment"))


@query("series_unpivot", sql="""
    SELECT title, ts, value FROM (
      SELECT 'value' AS title, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
        CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS value FROM events
      UNION ALL SELECT 'user_id', strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(user_id AS VARCHAR) FROM events
      UNION ALL SELECT 'event_id', strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(event_id AS VARCHAR) FROM events)""")
def series_unpivot(spark, sf):
    wide = b.table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), b.cents("value").alias("value"), "user_id", "event_id",
        F.lit(False).alias("isPartial"))
    return features.series_to_long(wide, "ts", ["value", "user_id", "event_id"])


_RAW_TEXT = {
    "budget": "CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE CAST(o_orderkey * 1000 AS STRING) || '.5' END",
    "runtime": "CASE WHEN o_orderkey % 19 = 0 THEN '2h' WHEN o_orderkey % 23 = 0 THEN NULL "
               "ELSE CAST(o_orderkey % 200 AS STRING) END",
}


@query("skip_bad_records", sql=f"""
    WITH raw AS (SELECT o_orderkey AS movie_id, {_RAW_TEXT['budget']} AS budget, {_RAW_TEXT['runtime']} AS runtime
                 FROM orders)
    SELECT movie_id, TRY_CAST(budget AS DOUBLE) AS budget, TRY_CAST(runtime AS INTEGER) AS runtime, '' AS bad_fields
    FROM raw WHERE NOT (budget = 'n/a' OR coalesce(runtime, '') = '2h')
    UNION ALL
    SELECT movie_id, NULL, NULL, CASE WHEN budget = 'n/a' AND coalesce(runtime, '') = '2h' THEN 'budget,runtime'
      WHEN budget = 'n/a' THEN 'budget' ELSE 'runtime' END
    FROM raw WHERE budget = 'n/a' OR coalesce(runtime, '') = '2h'""")
def skip_bad_records(spark, sf):
    raw = b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("movie_id"), *[F.expr(e).alias(c) for c, e in _RAW_TEXT.items()])
    good, rejects = features.skip_bad_records(raw, {"budget": "double", "runtime": "int"})
    return good.withColumn("bad_fields", F.lit("")).unionByName(rejects.select(
        "movie_id", F.lit(None).cast("double").alias("budget"), F.lit(None).cast("int").alias("runtime"), "bad_fields"))


@query("error_pct", ctes="pred", sql="SELECT movie_id, actual, predicted, pred_error AS error_percentage FROM pred")
def error_pct(spark, sf):
    return b.predictions(spark, sf).select("movie_id", "actual", "predicted", "error_percentage")


@query("is_franchise", ctes="base", sql="""
    SELECT movie_id, title, title LIKE '%:%' OR title LIKE '%Part%' OR regexp_matches(right(title, 2), '[0-9]')
      OR lower(title) LIKE '% 2%' OR lower(title) LIKE '% 3%' OR lower(title) LIKE '%chapter%' OR """
    + " OR ".join(f"contains(lower(title), '{w}')" for w in fixed.FRANCHISE_KEYWORDS) + """ AS franchise,
      title LIKE '%:%' OR title LIKE '%Part%' OR regexp_matches(right(title, 2), '[0-9]')
      OR lower(title) LIKE '% 2%' OR lower(title) LIKE '% 3%' OR lower(title) LIKE '%chapter%' AS franchise_by_word
    FROM base""")
def is_franchise(spark, sf):
    return b.release_dates(spark, sf).select(
        "movie_id", "title", text.is_franchise(F.col("title")).alias("franchise"),
        text.is_franchise(F.col("title"), word_boundary=True).alias("franchise_by_word"))


@query("engineered_features", ctes="facts", sql=r"""
    SELECT movie_id, vote_average * vote_count AS vote_power,
      CASE WHEN popularity > 0 THEN budget / popularity ELSE 0e0 END AS budget_popularity_ratio,
      CAST(CASE WHEN budget >= 200000000 THEN 5 WHEN budget >= 100000000 THEN 4 WHEN budget >= 50000000 THEN 3
        WHEN budget >= 10000000 THEN 2 WHEN budget >= 1000000 THEN 1 ELSE 0 END AS INTEGER) AS budget_tier,
      CAST(regexp_matches(trim(title), '(?i)\b(?:part|chapter|vol)\b|\s(?:\d+|ii|iii|iv|v|vi|vii|viii|ix|x)$')
        AS INTEGER) AS is_sequel,
      CAST(length(overview) AS INTEGER) AS description_length
    FROM facts""")
def engineered_features(spark, sf):
    return features.engineered_features(b.facts(spark, sf)).select(
        "movie_id", "vote_power", "budget_popularity_ratio", "budget_tier", "is_sequel", "description_length")


_SPLIT_SQL = "CASE WHEN CAST('0x' || substr(md5('42:' || CAST({k} AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 " \
             "THEN 'train' ELSE 'test' END"


@query("split_stable", sql=f"SELECT o_orderkey AS movie_id, {_SPLIT_SQL.format(k='o_orderkey')} AS split FROM orders")
def split_stable(spark, sf):
    return b.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("movie_id"), scalars.stable_split(F.col("o_orderkey")).alias("split"))


@query("genre_avg_revenue", ctes="facts", sql=f"""
    WITH fit AS (SELECT primary_genre, round(avg(revenue), 2) AS genre_avg_revenue FROM facts
                 WHERE {_SPLIT_SQL.format(k='movie_id')} = 'train' GROUP BY 1)
    SELECT movie_id, primary_genre, genre_avg_revenue FROM facts LEFT JOIN fit USING (primary_genre)""")
def genre_avg_revenue(spark, sf):
    facts = b.facts(spark, sf).select("movie_id", "primary_genre", "revenue")
    fitted = features.genre_averages(facts, scalars.stable_split(F.col("movie_id")) == "train")
    return joins.written_lookup(facts, fitted, ["primary_genre"], "genre-averages").select(
        "movie_id", "primary_genre", F.round("genre_avg_revenue", 2).alias("genre_avg_revenue"))


@query("sample_weights", ctes="facts", sql="""
    WITH m AS (SELECT median(revenue) AS med FROM facts), w AS (SELECT movie_id, ln(1 + revenue / med) AS raw
      FROM facts CROSS JOIN m)
    SELECT movie_id, round(raw / (SELECT avg(raw) FROM w), 6) AS sample_weight FROM w""")
def sample_weights(spark, sf):
    return features.sample_weights(b.facts(spark, sf).select("movie_id", "revenue")).select(
        "movie_id", F.round("sample_weight", 6).alias("sample_weight"))


_SCALED = ["popularity", "vote_average", "runtime", "interaction_rate"]


@query("standardize", ctes="facts", sql="SELECT movie_id, " + ", ".join(
    f"round(CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0e0 END, 6) AS {c}" for c in _SCALED)
    + " FROM facts CROSS JOIN (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED) + " FROM facts)")
def standardize(spark, sf):
    scaled = features.standardize(b.facts(spark, sf), _SCALED)
    return _rounded(scaled.select("movie_id", *_SCALED), _SCALED)


@query("label_encode", ctes="facts", sql="""
    SELECT movie_id, success_class, CAST(dense_rank() OVER (ORDER BY success_class) - 1 AS INTEGER)
      AS success_class_index FROM facts""")
def label_encode(spark, sf):
    return stats.label_encode(b.facts(spark, sf).select("movie_id", "success_class"), "success_class")


def _mod(multiplier, offset, modulus):
    return f"((k % 1000003) * {multiplier} + {offset}) % {modulus}"


def _choice(words, position):
    return b._duck_pick(words, position)


_LOW = f"{_mod(37, 11, 100)} < 70"
_FLOP_SQL = f"""
    SELECT 'synthetic_flop_' || CAST(k AS VARCHAR) AS movie_id, 'Bad Movie ' || CAST(k AS VARCHAR) AS title, budget,
      CAST(floor(budget * share / 1000) AS BIGINT) AS revenue, (1 + {_mod(331, 7, 50)}) / 10 AS popularity,
      CAST((1 + {_mod(331, 7, 50)}) * 100 AS BIGINT) AS trailer_views,
      {_choice(features.FLOP_GENRES, _mod(13, 5, 7))} AS primary_genre,
      {_choice(features.FLOP_STARTS, _mod(5, 0, 3))} || ' ' || {_choice(features.FLOP_SUBJECTS, _mod(3, 1, 4))} || ' '
        || {_choice(features.FLOP_WORDS, _mod(41, 2, 26))} || ' and ' || {_choice(features.FLOP_WORDS, _mod(43, 8, 26))}
        || '. It fails to deliver.' AS overview, 'Flop' AS success_class
    FROM (SELECT k, CASE WHEN {_LOW} THEN 10000 + {_mod(7919, 13, 990001)}
            ELSE 20000000 + {_mod(104729, 17, 80000001)} END AS budget,
            CASE WHEN {_LOW} THEN 100 + {_mod(613, 5, 701)} ELSE 100 + {_mod(613, 5, 401)} END AS share
          FROM (SELECT p_partkey AS k FROM part))"""
_AUGMENTED = ["movie_id", "title", "budget", "revenue", "popularity", "trailer_views", "primary_genre", "overview",
              "success_class"]


@query("augment_classes", ctes="facts", sql=f"""
    SELECT CAST(movie_id AS VARCHAR) AS movie_id, title, budget, revenue, popularity, trailer_views, primary_genre,
      overview, success_class FROM facts UNION ALL {_FLOP_SQL}""")
def augment_classes(spark, sf):
    generated = features.synthetic_flops(b.table(spark, sf, "part"), "p_partkey")
    once = features.augment(b.facts(spark, sf), generated)
    return features.augment(once, generated).select(*_AUGMENTED)
