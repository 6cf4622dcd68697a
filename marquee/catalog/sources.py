"""Checks: scans and sinks, each written to the scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee import bindings as b, schemas
from marquee.catalog.registry import query
from marquee.functions import scalars
from marquee.operators import joins
from marquee.plans import final_dataset, learning, steps
from marquee.session import scratch_path
from marquee.sources import cache as persisted, readers, sinks
from marquee.sources.versions import Versions


@query("scan_movies", ctes="base audience", sql="""
    SELECT b.movie_id AS id, title, budget, revenue, runtime, popularity, vote_average, vote_count, release_date, overview,
      CASE WHEN b.movie_id % 43 = 0 THEN NULL WHEN b.movie_id % 41 = 0 THEN ''
        ELSE primary_genre || ',Drama' END AS genre_names
    FROM base b LEFT JOIN audience a ON a.movie_id = b.movie_id""")
def scan_movies(spark, sf):
    path = sinks.write_json(b.movie_docs(spark, sf), scratch_path(spark, "movies"))
    names = F.array_join(F.transform("genres", lambda g: g["name"]), ",")
    return readers.read_movies(spark, path).withColumn("genre_names", names).drop("genres")


@query("scan_trailers", ctes="audience", sql="""
    SELECT movie_id, 'v' || CAST(movie_id AS VARCHAR) AS video_id,
      CASE WHEN movie_id % 31 = 0 THEN 'n/a' ELSE CAST(trailer_views AS VARCHAR) END AS views,
      CASE WHEN movie_id % 29 = 0 THEN NULL ELSE CAST(trailer_likes AS VARCHAR) END AS likes FROM audience""")
def scan_trailers(spark, sf):
    path = sinks.write_json(b.trailer_docs(spark, sf), scratch_path(spark, "trailers"))
    return readers.read_trailers(spark, path).select(
        "movie_id", "video_id", F.col("trailer_stats.viewCount").alias("views"),
        F.col("trailer_stats.likeCount").alias("likes"))


@query("scan_map_json", ctes="people", sql="""
    SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, name, popularity, 'part ' || CAST(l_partkey AS VARCHAR) AS character
    FROM lineitem JOIN people ON person_id = l_suppkey WHERE l_returnflag = 'A'""")
def scan_map_json(spark, sf):
    cast = b.credits(spark, sf).filter("role = 'cast'")
    member = F.struct("name", F.concat(F.lit("part "), F.col("part").cast("string")).alias("character"), "popularity")
    entry = F.struct(F.array(member).alias("cast"))
    path = sinks.write_map_json(cast, "movie_id", entry, scratch_path(spark, "credits-map"))
    return readers.read_credits_map(spark, path).select("movie_id", F.inline("cast")).select(
        "movie_id", "name", "popularity", "character")


@query("scan_timeseries_map", ctes="series", sql="SELECT title, ts, value FROM series")
def scan_timeseries_map(spark, sf):
    points = b.series(spark, sf)
    path = sinks.write_map_json(points, "title", F.create_map("ts", "value"), scratch_path(spark, "series"))
    return readers.read_series_map(spark, path)


@query("scan_report", ctes="pred", sql="""
    SELECT title, CAST(actual AS DOUBLE) AS actual_revenue, predicted AS predicted_revenue,
      pred_error AS error_percentage FROM pred""")
def scan_report(spark, sf):
    row = F.struct("title", F.col("actual").cast("double").alias("actual_revenue"),
                   F.col("predicted").alias("predicted_revenue"), "error_percentage")
    documents = b.predictions(spark, sf).select(F.lit(1).alias("total_count"), F.array(row).alias("results"))
    return readers.read_report(spark, sinks.write_json(documents, scratch_path(spark, "report")))


@query("scan_parquet", sql="""
    SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY 1""")
def scan_parquet(spark, sf):
    orders = readers.read_parquet(spark, f"{sf}/orders.parquet")
    return orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"))


@query("csv_roundtrip", ctes="base", sql="""
    SELECT movie_id, title, revenue, 'He said "' || coalesce(overview, 'none') || '", twice' AS overview FROM base""")
def csv_roundtrip(spark, sf):
    quoted = F.concat(F.lit('He said "'), F.coalesce("overview", F.lit("none")), F.lit('", twice'))
    out = b.release_dates(spark, sf).select("movie_id", "title", "revenue", quoted.alias("overview"))
    return readers.read_csv(spark, sinks.write_csv(out, scratch_path(spark, "final-csv")), out.schema)


@query("sink_parquet", ctes="facts", sql="""
    SELECT movie_id, title, budget, revenue, interaction_rate, success_class FROM facts""")
def sink_parquet(spark, sf):
    path = scratch_path(spark, "features")
    out = b.facts(spark, sf).select("movie_id", "title", "budget", "revenue", "interaction_rate", "success_class")
    sinks.write_parquet(out.filter("budget = 0"), path)
    sinks.write_parquet(out, path, partition_by=["success_class"])
    return readers.read_parquet(spark, path, out.schema)


@query("sink_json", ctes="facts", sql="""
    SELECT movie_id, youtube_sentiment, sentiment_volatility FROM facts""")
def sink_json(spark, sf):
    out = b.facts(spark, sf).select("movie_id", "youtube_sentiment", "sentiment_volatility")
    return readers.read_sentiment(spark, sinks.write_json(out, scratch_path(spark, "sentiment")))


@query("sink_append", sql="""
    SELECT 'people' AS collection, 'supplier' AS kind, s_suppkey AS id, s_name AS name FROM supplier
    UNION ALL SELECT 'people', 'customer', c_custkey, c_name FROM customer
    UNION ALL SELECT 'titles', 'part', p_partkey, p_name FROM part""")
def sink_append(spark, sf):
    root = scratch_path(spark, "raw")
    batches = [("people", "supplier", "s_suppkey", "s_name"), ("people", "customer", "c_custkey", "c_name"),
               ("titles", "part", "p_partkey", "p_name")]
    for collection, name, key, label in batches:
        docs = b.table(spark, sf, name).select(F.lit(name).alias("kind"), F.col(key).alias("id"),
                                               F.col(label).alias("name"))
        sinks.append_documents(docs, root, collection)
    sinks.append_documents(docs.filter("id is null"), root, "titles")
    parts = [
        spark.read.schema("kind string, id bigint, name string").json(f"{root}/{c}").withColumn("collection", F.lit(c))
        for c in ("people", "titles")]
    return parts[0].unionByName(parts[1])


@query("sink_predictions", ctes="pred", sql="""
    SELECT title, predicted AS predicted_revenue, success_class, 0.85e0 AS confidence FROM pred
    UNION ALL SELECT title, predicted * 2, success_class, 0.98e0 FROM pred""")
def sink_predictions(spark, sf):
    path = scratch_path(spark, "predictions")
    scored = b.predictions(spark, sf).select(
        "title", F.col("predicted").alias("predicted_revenue"), "success_class", F.lit(0.85).alias("confidence"))
    sinks.append_predictions(scored, path)
    again = scored.withColumns({"predicted_revenue": F.col("predicted_revenue") * 2, "confidence": F.lit(0.98)})
    sinks.append_predictions(again, path)
    return readers.read_parquet(spark, path, schemas.PREDICTION)


@query("optional_source", ctes="base", sql="""
    SELECT movie_id, 0e0 AS youtube_sentiment, 0e0 AS sentiment_volatility FROM base""")
def optional_source(spark, sf):
    missing = readers.optional_source(spark, scratch_path(spark, "absent"), schemas.SENTIMENT)
    titles = b.release_dates(spark, sf).select("movie_id")
    return joins.lookup(titles, missing, ["movie_id"], {"youtube_sentiment": 0.0, "sentiment_volatility": 0.0})


def _raw_folders(spark, sf):
    """Raw documents as files: every title, then every third again under another name, then damaged lines."""
    root = scratch_path(spark, "raw")
    movies, clips = b.movie_docs(spark, sf), b.trailer_docs(spark, sf)
    again = movies.filter(F.col("id") % 3 == 0).withColumn("title", F.upper("title"))
    sinks.write_json(movies, f"{root}/movies/a")
    sinks.write_json(again, f"{root}/movies/b")
    movies.select(F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "title": "cut o')).alias("value")).filter(
        F.col("id") % 10 == 0).write.text(f"{root}/movies/c")
    more = clips.withColumn("trailer_stats", F.col("trailer_stats").withField("viewCount", F.lit("7")))
    sinks.write_json(clips, f"{root}/trailers/a")
    sinks.write_json(more.filter(F.col("movie_id") % 4 == 0), f"{root}/trailers/b")
    return {"movies": f"{root}/movies/*", "trailers": f"{root}/trailers/*",
            **{n: f"{root}/no-{n}" for n in ("credits", "series", "articles")}}


@query("pipeline_from_files", ctes="base audience", sql="""
    SELECT b.movie_id, b.title, coalesce(a.budget, 0) AS budget, revenue,
      CASE WHEN b.movie_id % 43 = 0 OR b.movie_id % 41 = 0 THEN 'Unknown' ELSE primary_genre END AS primary_genre,
      coalesce(CASE WHEN b.movie_id % 31 = 0 AND a.movie_id IS NOT NULL THEN 0 ELSE trailer_views END, 0) AS trailer_views,
      coalesce(overview, '') AS overview, 0e0 AS youtube_sentiment
    FROM base b LEFT JOIN audience a ON a.movie_id = b.movie_id""")
def pipeline_from_files(spark, sf):
    out = final_dataset.run_pipeline(spark, _raw_folders(spark, sf), b.lexicon(spark), bad="skip")
    return out["final_dataset"].select("movie_id", "title", "budget", "revenue", "primary_genre", "trailer_views",
                                       "overview", "youtube_sentiment")


@query("pipeline_run")
def pipeline_run(spark, sf):
    """The ledger of the seven steps over files, collection skipped; of the candidates the two that are quick to fit."""
    root = scratch_path(spark, "run")
    small = {"regressors": {"linear": learning.regressors()["linear"]}, "classifiers": {"logistic": learning.classifiers()["logistic"]}}
    plan = steps.seven_steps(spark, _raw_folders(spark, sf), b.lexicon(spark), root, bad="skip", **small)
    return steps.run(spark, root, plan)


@query("rejected_lines", sql="""
    SELECT 'movies' AS source, count(*) AS lines FROM orders WHERE o_orderkey % 10 = 0 HAVING count(*) > 0""")
def rejected_lines(spark, sf):
    bad = final_dataset.rejected_lines(spark, _raw_folders(spark, sf))
    return bad.groupBy("source").agg(F.count("*").alias("lines"))


@query("cache_refresh", ctes="credits", sql="""
    SELECT o_orderkey AS movie_id, CASE WHEN o_orderstatus = 'F' THEN 'cache' ELSE 'fetched' END AS origin,
      n AS credits FROM orders JOIN (SELECT movie_id, count(*) AS n FROM credits GROUP BY 1) ON movie_id = o_orderkey""")
def cache_refresh(spark, sf):
    counted = b.credits(spark, sf).groupBy("movie_id").agg(F.count("*").alias("credits"))
    orders = b.table(spark, sf, "orders")
    # Ids pass through the id normaliser first, as raw keys may be text.
    ids = orders.select(
        scalars.normalise_id(F.col("o_orderkey").cast("string")).cast("bigint").alias("movie_id"))
    known = orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("movie_id"))
    cache = known.join(counted, "movie_id").withColumn("origin", F.lit("cache"))

    def fetch(missing):
        return missing.join(counted, "movie_id").withColumn("origin", F.lit("fetched"))

    store = Versions(spark, scratch_path(spark, "credits-cache"))
    store.publish({"credits": cache}, "1")
    return persisted.refresh(store, "credits", ids, fetch, "movie_id", "2", cache.limit(0))
