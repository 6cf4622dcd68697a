"""Checks: joins, lookups, de-duplication, people matching, similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee import bindings as b
from marquee.catalog.registry import query
from marquee.functions import fixed, scalars, text
from marquee.operators import features, joins, people, similarity
from marquee.plans import validation


@query("join_engagement", ctes="base audience", sql="""
    SELECT b.movie_id, title, trailer_views, trailer_likes, trailer_comments
    FROM base b LEFT JOIN audience a ON a.movie_id = b.movie_id""")
def join_engagement(spark, sf):
    return joins.lookup(b.release_dates(spark, sf), b.trailers(spark, sf), ["movie_id"]).select(
        "movie_id", "title", "trailer_views", "trailer_likes", "trailer_comments")


@query("join_sentiment", sql="""
    SELECT movie_id, youtube_sentiment, sentiment_volatility
    FROM (SELECT o_orderkey AS movie_id FROM orders) LEFT JOIN (
      SELECT conv_id, length(text) / 100 AS youtube_sentiment, turn / 10 AS sentiment_volatility
      FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = 1)
      ON conv_id = movie_id""")
def join_sentiment(spark, sf):
    scored = b.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("movie_id"), (F.length("text") / 100).alias("youtube_sentiment"),
        (F.col("turn") / 10).alias("sentiment_volatility"), "turn", "role", "text")
    once = joins.keep_first(scored, ["movie_id"], ["turn", "role", "text"]).drop("turn", "role", "text")
    return joins.lookup(b.release_dates(spark, sf).select("movie_id"), once, ["movie_id"])


_TREND = r"""SELECT title, round(coalesce(avg(CASE WHEN regexp_full_match(value, '\d+\.?\d*|\.\d+')
    THEN TRY_CAST(value AS DOUBLE) END), 0e0), 6) AS trend_momentum FROM series GROUP BY title"""


@query("trend_momentum", ctes="series", sql=_TREND)
def trend_momentum(spark, sf):
    return features.trend_momentum(b.series(spark, sf)).withColumn("trend_momentum", F.round("trend_momentum", 6))


@query("join_trend_by_title", ctes="base series", sql=f"""
    WITH trends AS ({_TREND}), once AS (SELECT lower(title) AS t, trend_momentum FROM trends
      QUALIFY row_number() OVER (PARTITION BY lower(title) ORDER BY title) = 1)
    SELECT movie_id, title, trend_momentum FROM base LEFT JOIN once ON t = lower(title)""")
def join_trend_by_title(spark, sf):
    trends = features.trend_momentum(b.series(spark, sf))
    joined = joins.join_by_lower_title(
        b.release_dates(spark, sf).select("movie_id", "title"), trends, "trend_momentum", "movie_id")
    return joined.withColumn("trend_momentum", F.round("trend_momentum", 6))


@query("lookup_overview", sql="""
    SELECT conv_id AS movie_id, turn, coalesce(overview, '') AS overview FROM conversations LEFT JOIN (
      SELECT doc_id % 40 AS k, arg_max(text, doc_id) AS overview FROM documents GROUP BY 1) ON k = conv_id""")
def lookup_overview(spark, sf):
    texts = b.table(spark, sf, "documents").select(
        (F.col("doc_id") % 40).alias("movie_id"), F.col("doc_id").alias("seq"), F.col("text").alias("overview"))
    titles = b.comments(spark, sf).select("movie_id", "turn")
    latest = joins.last_value(texts, "movie_id", "overview", "seq")
    return joins.salted_lookup(titles, latest, ["movie_id"], F.col("turn")).na.fill({"overview": ""})


@query("join_cast_features", ctes="base credits", sql="""
    SELECT b.movie_id, coalesce(n, 0e0) AS num_cast_members, coalesce(peak, 0e0) AS max_cast_popularity,
      coalesce(d, 0e0) AS num_directors
    FROM base b LEFT JOIN (
      SELECT movie_id, CAST(count_if(role = 'cast') AS DOUBLE) AS n, CAST(count_if(role = 'director') AS DOUBLE) AS d,
        max(popularity) FILTER (role = 'cast') AS peak FROM credits GROUP BY 1) s ON s.movie_id = b.movie_id""")
def join_cast_features(spark, sf):
    stats = people.stats_v1(b.credits(spark, sf))
    return joins.lookup(b.release_dates(spark, sf).select("movie_id"), stats, ["movie_id"],
                        {c: 0.0 for c in fixed.PEOPLE_FEATURES}).select(
        "movie_id", "num_cast_members", "max_cast_popularity", "num_directors")


_FACTS_SQL = r"""
    SELECT movie_id, CASE WHEN k10 = 0 THEN 2798e0 WHEN k10 = 1 THEN NULL ELSE amount END AS worldwide_box_office,
      CAST(NULL AS DOUBLE) AS domestic_box_office,
      CASE WHEN k11 = 0 THEN NULL WHEN k11 = 1 THEN amount * 1000 / 1000000 ELSE 1e0 + movie_id % 300 END AS budget
    FROM (SELECT movie_id, movie_id % 10 AS k10, movie_id % 11 AS k11,
            CAST((1 + movie_id % 9) * 1000 + movie_id % 1000 AS DOUBLE) AS amount FROM base)"""


def _article_facts(spark, sf):
    money = text.extract_money(F.col("text"))
    found = b.articles(spark, sf).select("movie_id", money.alias("m"))
    return found.select("movie_id", *[
        text.parse_money(F.col(f"m.{c}")).alias(c) for c in ("worldwide_box_office", "domestic_box_office", "budget")])


@query("join_article_facts", ctes="base", sql=f"""
    SELECT b.movie_id, worldwide_box_office AS wikipedia_worldwide_box_office, budget AS wikipedia_budget
    FROM base b LEFT JOIN ({_FACTS_SQL}) f ON f.movie_id = b.movie_id AND b.movie_id % 3 <> 0""")
def join_article_facts(spark, sf):
    facts = _article_facts(spark, sf).filter("movie_id % 3 <> 0").select(
        "movie_id", F.col("worldwide_box_office").alias("wikipedia_worldwide_box_office"),
        F.col("budget").alias("wikipedia_budget"))
    return joins.lookup(b.release_dates(spark, sf).select("movie_id"), facts, ["movie_id"])


@query("enrich_overwrite", ctes="records credits", sql="""
    SELECT r.movie_id, CASE WHEN s.movie_id IS NULL THEN CAST(num_cast_members AS DOUBLE) ELSE n END AS num_cast_members,
      CASE WHEN s.movie_id IS NULL THEN max_cast_popularity ELSE peak END AS max_cast_popularity
    FROM records r LEFT JOIN (
      SELECT movie_id, CAST(count_if(role = 'cast') AS DOUBLE) AS n,
        coalesce(max(popularity) FILTER (role = 'cast' AND popularity > 0), 0e0) AS peak
      FROM credits WHERE movie_id % 2 = 0 GROUP BY 1) s ON s.movie_id = r.movie_id""")
def enrich_overwrite(spark, sf):
    old = b.records(spark, sf).select(
        "movie_id", F.col("num_cast_members").cast("double").alias("num_cast_members"), "max_cast_popularity")
    fresh = people.stats_v2(b.credits(spark, sf).filter("movie_id % 2 = 0"))
    return joins.enrich_overwrite(old, fresh, "movie_id", ["num_cast_members", "max_cast_popularity"])


@query("report_semi_join", ctes="pred", sql=rf"""
    SELECT title, actual_revenue, predicted_revenue FROM (
      SELECT title, CAST(actual AS DOUBLE) AS actual_revenue, predicted - 200000000 AS predicted_revenue FROM pred)
    WHERE actual_revenue > 0 AND predicted_revenue > 0
      AND NOT regexp_matches(lower(trim(title)), '^bad movie\s+\d+$')
      AND title IN (SELECT title FROM facts
        WHERE NOT regexp_matches(lower(trim(title)), '^bad movie\s+\d+$')
          AND year(TRY_CAST(release_date AS DATE)) >= {b.MIN_YEAR}
          AND TRY_CAST(release_date AS DATE) <= DATE '{b.AS_OF}'
          AND revenue >= 50000000 AND budget >= 5000000 AND vote_count >= 100)""")
def report_semi_join(spark, sf):
    report = b.predictions(spark, sf).select(
        "title", F.col("actual").cast("double").alias("actual_revenue"),
        (F.col("predicted") - 200_000_000).alias("predicted_revenue"))
    return validation.filter_report(report, b.facts(spark, sf), b.AS_OF, b.MIN_YEAR)


@query("person_best_match", ctes="people base", sql="""
    WITH best AS (SELECT name, arg_max(person_id, (popularity, -person_id)) AS person_id, max(popularity) AS popularity
                  FROM people GROUP BY name)
    SELECT custkey, name, person_id, popularity FROM (SELECT c_custkey AS custkey, """
    + b._person(b._duck_pick, "c_custkey + 2") + " AS name FROM customer) LEFT JOIN best USING (name)")
def person_best_match(spark, sf):
    wanted = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), F.expr(b._person(b._spark_pick, "c_custkey + 2")).alias("name"))
    return joins.salted_lookup(wanted, people.best_match(b.people(spark, sf)), ["name"], F.col("custkey"))


@query("dedup_first", sql="""
    SELECT l_orderkey AS movie_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""")
def dedup_first(spark, sf):
    items = b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("movie_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return joins.keep_first(items, ["movie_id"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query("pick_candidate", sql="""
    WITH c AS (SELECT l_orderkey AS movie_id, CAST(row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS rank,
        greatest(CAST(l_quantity AS BIGINT) - 25, 0) AS comments FROM lineitem)
    SELECT movie_id, rank, comments FROM c WHERE rank <= 5
    QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY CASE WHEN comments > 0 THEN 0 ELSE 1 END, rank) = 1""")
def pick_candidate(spark, sf):
    items = b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("movie_id"), "l_linenumber", "l_partkey", "l_suppkey",
        F.greatest(F.col("l_quantity").cast("bigint") - 25, F.lit(0)).alias("comments"))
    ranked = joins.keep_top(items, ["movie_id"], ["l_linenumber", "l_partkey", "l_suppkey"], 5)
    return joins.pick_candidate(ranked, "movie_id", "rank", "comments").select("movie_id", "rank", "comments")


_ROI_BASE = """
    returns AS (SELECT movie_id, CAST(round_even(revenue / budget * 1000000, 0) AS BIGINT) AS own
                FROM facts WHERE budget > 0),
    cast_rows AS (SELECT DISTINCT c.movie_id, name, own FROM credits c JOIN returns r ON r.movie_id = c.movie_id
                  WHERE role = 'cast')"""


@query("actor_roi", ctes="facts credits", sql=f"""
    WITH {_ROI_BASE}, totals AS (SELECT name, CAST(sum(own) AS BIGINT) AS total, count(*) AS n FROM cast_rows GROUP BY 1)
    SELECT movie_id, round(avg((total - own) / (n - 1) / 1000000), 6) AS avg_cast_historical_roi
    FROM cast_rows JOIN totals USING (name) WHERE n > 1 GROUP BY movie_id""")
def actor_roi(spark, sf):
    titles = b.facts(spark, sf).select("movie_id", "revenue", "budget")
    return people.actor_roi(b.credits(spark, sf), titles).select(
        "movie_id", F.round("avg_cast_historical_roi", 6).alias("avg_cast_historical_roi"))


@query("actor_roi_map", ctes="facts credits", sql=f"""
    WITH {_ROI_BASE} SELECT name, round(CAST(sum(own) AS BIGINT) / count(*) / 1000000, 6) AS roi
    FROM cast_rows GROUP BY 1""")
def actor_roi_map(spark, sf):
    titles = b.facts(spark, sf).select("movie_id", "revenue", "budget")
    return people.actor_roi_map(b.credits(spark, sf), titles).select("name", F.round("roi", 6).alias("roi"))


_STOP = "[" + ", ".join(f"'{w}'" for w in fixed.STOP_WORDS) + "]"


def _tokens_sql(expression):
    return (f"list_distinct(list_filter(regexp_extract_all(lower({expression}), '[a-z0-9]+'), "
            f"lambda w: length(w) > 2 AND NOT list_contains({_STOP}, w)))")


def similar_sql(asked: str) -> str:
    """Common table expressions ending in ``matched``: the nearest of ``refs`` for every row of ``asked``."""
    return f"""
    r AS (SELECT movie_id AS id, lower(trim(primary_genre)) AS g, title, youtube_sentiment, sentiment_volatility,
            trend_momentum, {_tokens_sql("coalesce(title, '') || ' ' || coalesce(overview, '')")} AS toks FROM refs),
    q AS (SELECT movie_id AS id, lower(trim(primary_genre)) AS g,
            {_tokens_sql("coalesce(title, '') || ' ' || coalesce(overview, '')")} AS toks FROM {asked}),
    placed AS (SELECT q.id, q.toks, CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.g = q.g) THEN q.g ELSE '' END AS blk FROM q),
    rt AS (SELECT id, g, unnest(toks) AS tok FROM r), qt AS (SELECT id, blk, unnest(toks) AS tok FROM placed),
    shared AS (SELECT qt.id AS qid, rt.id AS rid, count(*) AS n FROM qt JOIN rt
               ON qt.tok = rt.tok AND (blk = '' OR blk = g) GROUP BY 1, 2),
    scored AS (SELECT p.id AS qid, r.id AS rid, coalesce(n, 0) / (length(p.toks) + length(r.toks) - coalesce(n, 0)) AS s
               FROM placed p JOIN r ON (blk = '' OR blk = g) AND length(r.toks) > 0
               LEFT JOIN shared ON qid = p.id AND rid = r.id WHERE length(p.toks) > 0),
    best AS (SELECT qid, rid, s FROM scored QUALIFY row_number() OVER (PARTITION BY qid ORDER BY s DESC, rid) = 1),
    matched AS (SELECT p.id AS movie_id,
        CASE WHEN length(p.toks) = 0 THEN (SELECT min(r.id) FROM r WHERE p.blk = '' OR r.g = p.blk) ELSE rid END AS match_id,
        s AS score, CASE WHEN length(p.toks) = 0 THEN 'genre_default' ELSE 'similar' END AS kind
      FROM placed p LEFT JOIN best ON qid = p.id)"""


_SIMILAR = similar_sql("asked")


@query("similar_title", ctes="refs asked", sql=f"WITH {_SIMILAR} SELECT movie_id, match_id, score, kind FROM matched")
def similar_title(spark, sf):
    return similarity.nearest(b.asked(spark, sf), b.reference_index(spark, sf))


@query("infer_social", ctes="refs asked", sql=f"""
    WITH {_SIMILAR}, raw AS (
      SELECT m.movie_id, coalesce(youtube_sentiment, 5e0) AS y, coalesce(sentiment_volatility, 0.1e0) AS v,
        coalesce(trend_momentum, 0e0) AS t, CASE WHEN kind = 'similar'
          THEN 'similar_movie:' || title || '@' || format('{{:.3f}}', score) ELSE kind || ':' || title END AS source
      FROM matched m JOIN r ON r.id = match_id)
    SELECT movie_id, CASE WHEN least(greatest(y, 0e0), 15e0) <= 0 THEN 5e0 ELSE least(greatest(y, 0e0), 15e0) END
        AS youtube_sentiment,
      CASE WHEN least(greatest(v, 0e0), 1e0) <= 0 THEN 0.1e0 ELSE least(greatest(v, 0e0), 1e0) END AS sentiment_volatility,
      CASE WHEN least(greatest(t, -1e0), 1e0) <= -1 THEN 0e0 ELSE least(greatest(t, -1e0), 1e0) END AS trend_momentum,
      source FROM raw""")
def infer_social(spark, sf):
    signals = similarity.social_signals(b.asked(spark, sf), b.reference_index(spark, sf))
    return signals.withColumns({
        n: scalars.social_clip(F.col(n), *bounds) for n, bounds in fixed.SOCIAL_BOUNDS.items()})
