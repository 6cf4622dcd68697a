"""The test tables in the roles the operators expect.

Each role exists twice: as a DataFrame built here, and as a SQL common table
expression (``CTES``) for the oracle statements.  Text fields no table offers
(titles, overviews, article lines) are chosen by arithmetic on the row's key,
so both engines derive the same values from the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import scalars
from marquee.operators import features, similarity
from marquee.plans import scoring
from marquee.session import shared_path

FIRST_WORDS = ["Silent", "Golden", "Broken", "Hidden", "Crimson", "Winter", "Electric", "Lost"]
SECOND_WORDS = ["River", "Empire", "Garden", "Signal", "Harbor", "Author", "Circus", "Mirror", "Frontier", "Shadow",
                "Voyage"]
GIVEN_NAMES = ["Ann", "Bo", "Cy", "Dee", "Emily", "Ken", "Zoe"]
FAMILY_NAMES = ["Lee", "Ray", "Fox", "Hart", "Blunt", "Stone", "Vale", "Moss", "Pike", "Reed", "Shaw", "Tate", "West"]
STORIES = [
    "A quiet drama about a brave family",
    "Test movie with a great cast",
    "idk",
    "A heist with a plot hole, predictable and generic",
    "Rushed, formulaic story with flat dialogue and messy pacing and low stakes",
    "A tight screenplay with smart dialogue and emotional depth",
    "A theatrical event with global appeal and franchise potential and large-scale action",
    "An inception of a dream for nolan fans, not good",
    "Fresh premise, clear stakes and excellent pacing, a great story",
]
# token, valence, polarity, subjectivity
LEXICON = [
    ("great", 3.1, 0.8, 0.75), ("good", 1.9, 0.7, 0.6), ("brave", 2.4, 0.8, 1.0), ("smart", 1.7, 0.2, 0.6),
    ("fresh", 1.3, 0.3, 0.5), ("excellent", 2.7, 1.0, 1.0), ("predictable", -0.7, -0.2, 0.4),
    ("generic", -0.9, -0.3, 0.3), ("flat", -0.6, -0.5, 0.5), ("messy", -1.5, -0.4, 0.6), ("quiet", 0.6, 0.1, 0.3),
    ("that", 0.4, 0.1, 0.2), ("with", 0.3, 0.1, 0.1), ("this", -0.5, -0.1, 0.2), ("from", -0.8, -0.2, 0.3),
    ("was", 1.1, 0.2, 0.4), ("der", 0.7, 0.1, 0.5), ("die", -2.9, -0.6, 0.9), ("und", 0.2, 0.0, 0.1),
    ("que", -0.4, -0.1, 0.3), ("ein", 0.9, 0.3, 0.6), ("tion", 1.5, 0.5, 0.5), ("ther", -1.2, -0.3, 0.4),
]
AS_OF = "2001-06-30"
MIN_YEAR = 1998


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- expressions valid in both engines; ``pick`` is the one difference ---


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _spark_pick(words: list[str], position: str) -> str:
    return f"element_at(array({_quoted(words)}), cast({position} as int) + 1)"


def _duck_pick(words: list[str], position: str) -> str:
    return f"([{_quoted(words)}])[({position}) + 1]"


def _title(pick, k: str) -> str:
    return (
        f"CASE WHEN {k} % 37 = 0 THEN 'Bad Movie ' || CAST({k} AS STRING) ELSE "
        f"{pick(FIRST_WORDS, f'{k} % 8')} || ' ' || {pick(SECOND_WORDS, f'{k} % 11')} || "
        f"CASE {k} % 13 WHEN 0 THEN ' 2' WHEN 1 THEN ': Part One' WHEN 2 THEN ' Chapter Three' WHEN 3 THEN ' III' "
        "ELSE '' END END"
    )


def _person(pick, k: str) -> str:
    return f"{pick(GIVEN_NAMES, f'({k}) % 7')} || ' ' || {pick(FAMILY_NAMES, f'({k}) % 13')}"


def _overview(pick, k: str) -> str:
    a, b, c = _person(pick, k), _person(pick, f"{k} + 3"), _person(pick, f"{k} + 5")
    return (
        f"CASE WHEN {k} % 53 = 0 THEN NULL WHEN {k} % 59 = 0 THEN '' WHEN {k} % 61 = 0 THEN '0' ELSE "
        f"{pick(STORIES, f'{k} % 9')} || CASE {k} % 4 "
        f"WHEN 0 THEN chr(10) || 'Cast: ' || {a} || ', ' || {b} || ' and ' || {c} "
        f"WHEN 1 THEN chr(10) || '- ' || {a} || ' - plays the lead' || chr(10) || 'Director: ' || {b} "
        f"WHEN 2 THEN chr(10) || 'Music: ' || {a} || ' & ' || {b} ELSE '' END END"
    )


def _release(k: str, iso: str) -> str:
    return f"CASE WHEN {k} % 97 = 0 THEN NULL WHEN {k} % 89 = 0 THEN 'bad' ELSE {iso} END"


def _genre(priority: str) -> str:
    return (
        f"CASE {priority} WHEN '1-URGENT' THEN 'Action' WHEN '2-HIGH' THEN 'Animation' "
        "WHEN '3-MEDIUM' THEN 'Science Fiction' WHEN '4-NOT SPECIFIED' THEN 'Drama' ELSE 'Comedy' END"
    )


def _article(k: str) -> str:
    amount = f"CAST(1 + {k} % 9 AS STRING) || ',' || lpad(CAST({k} % 1000 AS STRING), 3, '0')"
    return (
        f"'The film opened well.' || chr(10) || CASE WHEN {k} % 10 = 0 THEN 'Worldwide box office of $2.798 billion' "
        f"WHEN {k} % 10 = 1 THEN 'No box office figure is known' "
        f"ELSE 'Box office: $50 million at home, $' || {amount} || ' million in all' END || chr(10) || "
        f"CASE WHEN {k} % 11 = 0 THEN 'Its budget was secret' WHEN {k} % 11 = 1 THEN 'Budget: $' || {amount} || ',000' "
        f"ELSE 'Budget $' || CAST(1 + {k} % 300 AS STRING) || ' million, later $7 million' END || chr(10) || "
        "'A box office record without a number.'"
    )


# --- roles as DataFrames ---


def cents(column: str):
    return F.rint(F.col(column) * 100).cast("bigint")


def release_dates(spark: SparkSession, sf: str) -> DataFrame:
    """movie_id, title, revenue, runtime, release_date, genre_name, overview: orders only."""
    iso = "date_format(o_orderdate, 'yyyy-MM-dd')"
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("movie_id"),
        F.expr(_title(_spark_pick, "o_orderkey")).alias("title"),
        (cents("o_totalprice") * 10).alias("revenue"),
        (80 + F.col("o_orderkey") % 80).cast("int").alias("runtime"),
        F.expr(_release("o_orderkey", iso)).alias("release_date"),
        F.expr(_genre("o_orderpriority")).alias("genre_name"),
        F.expr(_overview(_spark_pick, "o_orderkey")).alias("overview"),
    )


def audience(spark: SparkSession, sf: str) -> DataFrame:
    """Trailer counts, budget and audience figures per title, from one pass over lineitem."""
    price = F.sum(cents("l_extendedprice"))
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("movie_id")).agg(
        price.alias("trailer_views"),
        (F.sum(F.col("l_quantity").cast("bigint")) * 1000).alias("trailer_likes"),
        F.count("*").alias("trailer_comments"),
        (price * 10).alias("budget"),
        (F.sum(cents("l_discount")) * 10 / F.count("*")).alias("popularity"),
        (F.sum(cents("l_tax")) / F.count("*")).alias("vote_average"),
        (F.count("*") * 100).alias("vote_count"),
    )


def movie_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Movie detail documents with nested genres; some lists empty or missing."""
    k = F.col("movie_id")
    genre = F.array(F.struct((k % 5).alias("id"), F.col("genre_name").alias("name")),
                    F.struct(F.lit(18).cast("bigint").alias("id"), F.lit("Drama").alias("name")))
    genres = F.when(k % 43 == 0, F.lit(None)).when(k % 41 == 0, F.slice(genre, 1, 0)).otherwise(genre)
    figures = audience(spark, sf).select("movie_id", "budget", "popularity", "vote_average", "vote_count")
    return release_dates(spark, sf).join(figures, "movie_id", "left").select(
        k.alias("id"), "title", "budget", "revenue", "runtime", "popularity", "vote_average", "vote_count",
        "release_date", "overview", genres.alias("genres"))


def trailer_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Trailer documents whose counts are strings, some of them unreadable."""
    k = F.col("movie_id")
    return audience(spark, sf).select(
        "movie_id",
        F.concat(F.lit("Trailer "), k.cast("string")).alias("title"),
        F.concat(F.lit("v"), k.cast("string")).alias("video_id"),
        F.struct(
            F.when(k % 31 == 0, F.lit("n/a")).otherwise(F.col("trailer_views").cast("string")).alias("viewCount"),
            F.when(k % 29 == 0, F.lit(None)).otherwise(F.col("trailer_likes").cast("string")).alias("likeCount"),
            F.col("trailer_comments").cast("string").alias("commentCount"),
        ).alias("trailer_stats"),
        F.array().cast("array<string>").alias("comments"),
    )


def trailers(spark: SparkSession, sf: str) -> DataFrame:
    return audience(spark, sf).select("movie_id", "trailer_views", "trailer_likes", "trailer_comments")


def films(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned titles left-joined with trailer counts and the engagement features; unmatched stay NULL."""
    figures = audience(spark, sf)
    base = release_dates(spark, sf).withColumnRenamed("genre_name", "primary_genre")
    return features.engagement_features(base, figures)


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Films with social signals and success class; numbers filled with 0, overview with ""."""
    k = F.col("movie_id")
    social = films(spark, sf).withColumns({
        "youtube_sentiment": k % 101 / 10, "sentiment_volatility": k % 10 / 10, "trend_momentum": (k % 21 - 10) / 10})
    filled = features.fill_numeric(social).na.fill({"overview": ""})
    return filled.withColumn("success_class", scalars.success_class(F.col("revenue"), F.col("budget")))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Facts with a per-genre linear prediction and its percentage error."""
    base = facts(spark, sf)
    predicted = scoring.predict_linear(scoring.linear_by_genre(base))(base)
    actual = F.col("revenue").cast("double")
    return predicted.withColumns({
        "actual": F.col("revenue"), "predicted": F.col("base_prediction"),
        "pred_error": scalars.error_pct(actual, F.col("base_prediction")),
        "error_percentage": scalars.error_pct(actual, F.col("base_prediction"))})


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring records: facts plus people figures from arithmetic on the key."""
    k = F.col("movie_id")
    return features.align_record(facts(spark, sf).withColumns({
        "num_cast_members": k % 6,
        "avg_cast_popularity": k % 400 / 10,
        "max_cast_popularity": k % 400 / 5,
        "star_power_score": k % 900 / 3,
        "num_directors": F.lit(1),
        "avg_director_popularity": k % 300 / 20,
        "max_director_popularity": k % 300 / 10,
        "director_experience_score": k % 7000 / 10,
        "wikipedia_worldwide_box_office": F.when(k % 19 == 0, F.lit(5e8)).otherwise(F.lit(0.0)),
        "hype_score": k % 50 / 10,
    }))


def credits(spark: SparkSession, sf: str) -> DataFrame:
    """Credits as long rows: the return flag gives the role, the supplier the person."""
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("movie_id"), F.col("l_suppkey").alias("person_id"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'cast' WHEN 'R' THEN 'director' ELSE 'composer' END").alias("role"),
        F.col("l_linenumber").alias("seq"), F.col("l_partkey").alias("part"))
    return items.join(people(spark, sf), "person_id")


def people(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("person_id"),
        F.expr(_person(_spark_pick, "s_suppkey")).alias("name"),
        (F.floor(F.col("s_acctbal") / 10 + 0.5) / 10).alias("popularity"))


def roi(spark: SparkSession, sf: str) -> DataFrame:
    """(name, roi) of people, from customer balances."""
    return table(spark, sf, "customer").groupBy(F.expr(_person(_spark_pick, "c_custkey")).alias("name")).agg(
        F.round(F.sum(cents("c_acctbal")) / F.count("*") / 100_000, 3).alias("roi"))


def comments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("movie_id"), "turn", "text")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "token string, valence double, polarity double, subjectivity double")


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Interest points (title, ts, value text); some values are not plain numbers."""
    title = f"{_spark_pick(FIRST_WORDS, 'user_id % 8')} || ' ' || {_spark_pick(SECOND_WORDS, 'user_id % 11')}"
    amount = F.rint(F.col("value") * 100).cast("bigint").cast("string")
    return table(spark, sf, "events").select(
        F.expr(f"CASE WHEN user_id % 2 = 0 THEN lower({title}) ELSE upper({title}) END").alias("title"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.when(F.col("event_id") % 7 == 0, "<1").when(F.col("event_id") % 7 == 1, F.concat(F.lit("-"), amount))
        .when(F.col("event_id") % 7 == 2, F.concat(amount, F.lit("e2")))
        .when(F.col("event_id") % 7 == 3, F.concat(amount, F.lit(".5"))).otherwise(amount).alias("value"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("movie_id"), F.expr(_article("o_orderkey")).alias("text"))


def references(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as reference titles; some signals missing."""
    k = F.col("doc_id")
    return table(spark, sf, "documents").select(
        k.alias("movie_id"), F.col("source").alias("title"), F.col("text").alias("overview"),
        F.col("lang").alias("primary_genre"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(k % 180 / 10).alias("youtube_sentiment"),
        (k % 13 / 10).alias("sentiment_volatility"), ((k % 41 - 20) / 10).alias("trend_momentum"))


def reference_index(spark: SparkSession, sf: str) -> similarity.Index:
    """The references' similarity index, built by the first query that asks for it and opened by the others."""
    return similarity.build_index(references(spark, sf), shared_path(spark, "reference-index", sf))


def asked(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark texts as queries: known, blank and unknown genres; and two without words."""
    k = F.col("item_id")
    genre = F.expr(_spark_pick(["en", "de", "fr", "es", "", "xx"], "item_id % 6"))
    texts = table(spark, sf, "benchmark").select(
        k.alias("movie_id"), F.lit("").alias("title"), F.col("text").alias("overview"), genre.alias("primary_genre"))
    return texts.unionByName(spark.createDataFrame([(-1, "", "", "en"), (-2, "", "", "xx")], texts.schema))


def labelled_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").alias("movie_id"), F.col("text").alias("overview"), F.col("lang").alias("primary_genre"),
        "quality", "toxic")


# --- the same roles as SQL ---

_K = "o_orderkey"
CTES: dict[str, tuple[list[str], str]] = {
    "audience": ([], """
        SELECT l_orderkey AS movie_id,
          CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS trailer_views,
          CAST(sum(CAST(l_quantity AS BIGINT)) * 1000 AS BIGINT) AS trailer_likes,
          count(*) AS trailer_comments,
          CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) * 10 AS BIGINT) AS budget,
          CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) * 10 AS BIGINT) / count(*) AS popularity,
          CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) / count(*) AS vote_average,
          count(*) * 100 AS vote_count
        FROM lineitem GROUP BY l_orderkey"""),
    "base": ([], f"""
        SELECT o_orderkey AS movie_id, {_title(_duck_pick, _K)} AS title,
          CAST(round(o_totalprice * 100) AS BIGINT) * 10 AS revenue, CAST(80 + o_orderkey % 80 AS INTEGER) AS runtime,
          {_release(_K, "strftime(o_orderdate, '%Y-%m-%d')")} AS release_date,
          {_genre("o_orderpriority")} AS primary_genre, {_overview(_duck_pick, _K)} AS overview
        FROM orders"""),
    "films": (["base", "audience"], """
        SELECT b.*, a.* EXCLUDE (movie_id), trailer_views / 1000000 AS trailer_popularity_index,
          CASE WHEN trailer_views > 0 THEN trailer_likes / trailer_views ELSE 0e0 END AS interaction_rate,
          trailer_views / 30 AS engagement_velocity,
          coalesce(TRY_CAST(substr(release_date, 6, 2) AS INTEGER), 0) AS release_month
        FROM base b LEFT JOIN audience a ON a.movie_id = b.movie_id"""),
    "facts": (["films"], """
        SELECT movie_id, title, revenue, runtime, release_date, primary_genre, coalesce(overview, '') AS overview,
          coalesce(trailer_views, 0) AS trailer_views, coalesce(trailer_likes, 0) AS trailer_likes,
          coalesce(trailer_comments, 0) AS trailer_comments, coalesce(budget, 0) AS budget,
          coalesce(popularity, 0e0) AS popularity, coalesce(vote_average, 0e0) AS vote_average,
          coalesce(vote_count, 0) AS vote_count,
          coalesce(trailer_popularity_index, 0e0) AS trailer_popularity_index, interaction_rate,
          coalesce(engagement_velocity, 0e0) AS engagement_velocity, release_month,
          movie_id % 101 / 10 AS youtube_sentiment, movie_id % 10 / 10 AS sentiment_volatility,
          (movie_id % 21 - 10) / 10 AS trend_momentum,
          CASE WHEN coalesce(budget, 0) = 0 THEN 'Unknown' WHEN revenue / budget >= 3 THEN 'Hit'
               WHEN revenue / budget >= 1 THEN 'Average' ELSE 'Flop' END AS success_class
        FROM films"""),
    "coefficients": (["facts"], """
        SELECT primary_genre, round(regr_slope(revenue, budget), 6) AS slope,
          round(avg(revenue) - regr_slope(revenue, budget) * avg(budget), 0) AS intercept
        FROM facts WHERE budget > 0 GROUP BY primary_genre"""),
    "pred": (["facts", "coefficients"], """
        SELECT f.*, CAST(intercept + slope * CAST(budget AS DOUBLE) AS DOUBLE) AS base_prediction,
          revenue AS actual, CAST(intercept + slope * CAST(budget AS DOUBLE) AS DOUBLE) AS predicted,
          abs(intercept + slope * CAST(budget AS DOUBLE) - revenue) / greatest(CAST(revenue AS DOUBLE), 1e0) * 100
            AS pred_error
        FROM facts f JOIN coefficients c USING (primary_genre)"""),
    "records": (["facts"], """
        SELECT movie_id, title, CAST(budget AS DOUBLE) AS budget, runtime, popularity, vote_average,
          CAST(vote_count AS INTEGER) AS vote_count, trailer_views, trailer_likes, trailer_comments,
          trailer_popularity_index, interaction_rate, engagement_velocity, youtube_sentiment, sentiment_volatility,
          trend_momentum, CAST(movie_id % 6 AS INTEGER) AS num_cast_members,
          movie_id % 400 / 10 AS avg_cast_popularity, movie_id % 400 / 5 AS max_cast_popularity,
          movie_id % 900 / 3 AS star_power_score, 0e0 AS avg_cast_historical_roi, CAST(1 AS INTEGER) AS num_directors,
          movie_id % 300 / 20 AS avg_director_popularity, movie_id % 300 / 10 AS max_director_popularity,
          movie_id % 7000 / 10 AS director_experience_score, CAST(0 AS INTEGER) AS num_composers,
          0e0 AS avg_composer_popularity, 0e0 AS max_composer_popularity, 0e0 AS music_prestige_score,
          CASE WHEN movie_id % 19 = 0 THEN 5e8 ELSE 0e0 END AS wikipedia_worldwide_box_office, 0e0 AS wikipedia_budget,
          overview, primary_genre, CAST(0 AS INTEGER) AS is_franchise, CAST(0 AS INTEGER) AS is_sequel,
          CAST(0 AS INTEGER) AS budget_tier, 0e0 AS genre_avg_revenue, CAST(0 AS INTEGER) AS description_length,
          movie_id % 50 / 10 AS hype_score, 0e0 AS budget_popularity_ratio, 0e0 AS vote_power,
          CAST(6 AS INTEGER) AS release_month
        FROM facts"""),
    "people": ([], f"""
        SELECT s_suppkey AS person_id, {_person(_duck_pick, "s_suppkey")} AS name,
          floor(s_acctbal / 10 + 0.5e0) / 10 AS popularity FROM supplier"""),
    "credits": (["people"], """
        SELECT l_orderkey AS movie_id, person_id, name, popularity, l_linenumber AS seq, l_partkey AS part,
          CASE l_returnflag WHEN 'A' THEN 'cast' WHEN 'R' THEN 'director' ELSE 'composer' END AS role
        FROM lineitem JOIN people ON person_id = l_suppkey"""),
    "roi": ([], f"""
        SELECT {_person(_duck_pick, "c_custkey")} AS name,
          round(CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) / count(*) / 100000, 3) AS roi
        FROM customer GROUP BY 1"""),
    "lexicon": ([], "SELECT * FROM (VALUES " + ", ".join(
        f"('{t}', CAST({v} AS DOUBLE), CAST({p} AS DOUBLE), CAST({s} AS DOUBLE))" for t, v, p, s in LEXICON)
        + ") AS lx(token, valence, polarity, subjectivity)"),
    "series": ([], f"""
        SELECT CASE WHEN user_id % 2 = 0 THEN lower(t) ELSE upper(t) END AS title,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
          CASE event_id % 7 WHEN 0 THEN '<1' WHEN 1 THEN '-' || amount WHEN 2 THEN amount || 'e2'
               WHEN 3 THEN amount || '.5' ELSE amount END AS value
        FROM (SELECT *, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS amount,
                {_duck_pick(FIRST_WORDS, 'user_id % 8')} || ' ' || {_duck_pick(SECOND_WORDS, 'user_id % 11')} AS t
              FROM events)""".replace("SELECT *, CAST(CAST(round(value", "SELECT event_id, user_id, ts, CAST(CAST(round(value")),
    "articles": ([], f"SELECT o_orderkey AS movie_id, {_article(_K)} AS text FROM orders"),
    "refs": ([], """
        SELECT doc_id AS movie_id, source AS title, text AS overview, lang AS primary_genre,
          CASE WHEN doc_id % 17 = 0 THEN NULL ELSE doc_id % 180 / 10 END AS youtube_sentiment,
          doc_id % 13 / 10 AS sentiment_volatility, (doc_id % 41 - 20) / 10 AS trend_momentum FROM documents"""),
    "asked": ([], f"""
        SELECT item_id AS movie_id, '' AS title, text AS overview,
          {_duck_pick(["en", "de", "fr", "es", "", "xx"], "item_id % 6")} AS primary_genre FROM benchmark
        UNION ALL SELECT -1, '', '', 'en' UNION ALL SELECT -2, '', '', 'xx'"""),
    "labelled": ([], """
        SELECT doc_id AS movie_id, text AS overview, lang AS primary_genre, quality, toxic
        FROM documents JOIN labels USING (doc_id)"""),
}


def with_ctes(names: str, statement: str) -> str:
    """``WITH`` the named role expressions and what they build on, then the statement."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dependency in CTES[name][0]:
            add(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in ordered)
    body = statement.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}" if parts else body
    return f"WITH {parts}\n{body}" if parts else body
