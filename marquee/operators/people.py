"""Cast and crew: credits, per-title statistics, names found in text, reputation.

Credits travel as long rows (movie_id, role, seq, name, popularity), never as
per-title arrays, so a title with any number of credits stays spread out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import fixed, rules, scalars, text
from marquee.operators import joins

ROLES = {
    "cast": ("num_cast_members", "avg_cast_popularity", "max_cast_popularity", "star_power_score"),
    "director": ("num_directors", "avg_director_popularity", "max_director_popularity", "director_experience_score"),
    "composer": ("num_composers", "avg_composer_popularity", "max_composer_popularity", "music_prestige_score"),
}
COMPOSER_JOBS = ["Original Music Composer"]
COMPOSER_JOBS_WIDE = ["Original Music Composer", "Music"]


def credits_from_docs(docs: DataFrame, top_cast: int = 5, composer_jobs: list[str] | None = None) -> DataFrame:
    """Nested (id, cast, crew) documents to long credit rows."""

    def people(entries: Column, role: str) -> Column:
        tagged = F.transform(
            entries,
            lambda p, i: F.struct(
                F.lit(role).alias("role"),
                i.alias("seq"),
                p["name"].alias("name"),
                F.coalesce(p["popularity"], F.lit(0.0)).alias("popularity"),
            ),
        )
        return F.coalesce(tagged, F.array().cast("array<struct<role:string,seq:int,name:string,popularity:double>>"))

    jobs = composer_jobs or COMPOSER_JOBS
    directors = F.filter("crew", lambda p: p["job"] == "Director")
    composers = F.filter("crew", lambda p: p["job"].isin(jobs))
    everyone = F.concat(
        people(F.slice("cast", 1, top_cast), "cast"), people(directors, "director"), people(composers, "composer")
    )
    return docs.select(F.col("id").alias("movie_id"), F.inline(everyone))


def stats_v1(credits: DataFrame) -> DataFrame:
    """Count, mean, maximum per role; star power = mean x count, other scores = mean."""
    aggs = []
    for role, (count, mean, peak, score) in ROLES.items():
        here = F.col("role") == role
        number = F.count_if(here).cast("double")
        average = F.coalesce(F.avg(F.when(here, F.col("popularity"))), F.lit(0.0))
        aggs += [
            number.alias(count),
            average.alias(mean),
            F.coalesce(F.max(F.when(here, F.col("popularity"))), F.lit(0.0)).alias(peak),
            (average * number if role == "cast" else average).alias(score),
        ]
    return credits.groupBy("movie_id").agg(*aggs)


def stats_v2(credits: DataFrame) -> DataFrame:
    """Count of all; mean and maximum of positive popularity; star power = top three, other scores = sum."""
    positive = F.col("popularity") > 0
    aggs = []
    for role, (count, mean, peak, score) in ROLES.items():
        here = (F.col("role") == role) & positive
        valued = F.when(here, F.col("popularity"))
        aggs += [
            F.count_if(F.col("role") == role).cast("double").alias(count),
            F.coalesce(F.avg(valued), F.lit(0.0)).alias(mean),
            F.coalesce(F.max(valued), F.lit(0.0)).alias(peak),
        ]
        if role != "cast":
            aggs.append(F.coalesce(F.sum(valued), F.lit(0.0)).alias(score))
    cast = credits.filter((F.col("role") == "cast") & positive)
    top = joins.keep_top(cast, ["movie_id"], [F.col("popularity").desc(), F.col("seq")], 3)
    star_power = top.groupBy("movie_id").agg(F.sum("popularity").alias("star_power_score"))
    return joins.lookup(credits.groupBy("movie_id").agg(*aggs), star_power, ["movie_id"], {"star_power_score": 0.0})


def best_match(people: DataFrame) -> DataFrame:
    """One row per name: the most popular person of that name, lowest id on ties."""
    best = F.max_by(F.struct("person_id", "popularity"), F.struct("popularity", -F.col("person_id")))
    return people.groupBy("name").agg(best.alias("b")).select("name", "b.person_id", "b.popularity")


def names_in_text(df: DataFrame, key: str, overview: str, first: int | None = None) -> DataFrame:
    """(key, seq, name) of the names a text mentions."""
    names = text.extract_names(F.col(overview))
    if first is not None:
        names = F.slice(names, 1, first)
    return df.select(key, F.posexplode(names).alias("seq", "name"))


def text_cast_stats(df: DataFrame, people: DataFrame, key: str = "movie_id", overview: str = "overview") -> DataFrame:
    """Popularity statistics over the found people a text names."""
    found = joins.salted_lookup(names_in_text(df, key, overview), best_match(people), ["name"], F.col(key), "inner")
    average = F.avg("popularity")
    return found.groupBy(key).agg(
        average.alias("avg_cast_popularity"),
        F.max("popularity").alias("max_cast_popularity"),
        F.count("*").cast("int").alias("num_cast_members"),
        (average * F.count("*")).alias("star_power_score"),
    )


def found_names(df: DataFrame, people: DataFrame, key: str = "movie_id", overview: str = "overview") -> DataFrame:
    """One row per found name, labelled "name (popularity)"."""
    found = joins.salted_lookup(names_in_text(df, key, overview), best_match(people), ["name"], F.col(key), "inner")
    return found.select(key, "seq", F.format_string("%s (%.1f)", "name", "popularity").alias("label"))


def reputation(df: DataFrame, people: DataFrame, roi: DataFrame, key: str = "movie_id", overview: str = "overview",
               first: int = 12) -> DataFrame:
    """Reputation factor per text from the first named people; no row when nothing is known."""
    side = best_match(people).filter("popularity > 0").join(roi, "name", "full")
    named = names_in_text(df, key, overview, first)
    known = joins.salted_lookup(named, side, ["name"], F.col(key))
    stats = known.groupBy(key).agg(
        F.count("popularity").alias("pops"),
        F.coalesce(F.avg("popularity"), F.lit(0.0)).alias("avg_popularity"),
        F.coalesce(F.max("popularity"), F.lit(0.0)).alias("max_popularity"),
        F.count("roi").alias("rois"),
        F.coalesce(F.avg("roi"), F.lit(0.0)).alias("avg_historical_roi"),
        F.count("*").alias("names_checked"),
    ).filter("pops > 0 or rois > 0")
    factor = rules.reputation_factor(
        F.col("avg_popularity"), F.col("max_popularity"), F.col("pops"), F.col("avg_historical_roi"), F.col("rois")
    )
    return stats.select(key, factor.alias("factor"), "avg_popularity", "max_popularity", "avg_historical_roi",
                        "names_checked")


def known_people(people: DataFrame, roi: DataFrame) -> DataFrame:
    """(name, popularity, roi) of everybody known by popularity or by past return."""
    return best_match(people).join(roi, "name", "full").select("name", "popularity", "roi")


def text_people(df: DataFrame, side: DataFrame, key: str, overview: str = "overview", first: int = 12) -> DataFrame:
    """``text_cast_stats`` and ``reputation`` of every text in one row: names found once, people joined once.

    ``side`` is ``known_people``, written before.  ``cast`` and ``reputation``
    are structs, NULL where the text names nobody known.
    """
    known = joins.lookup(names_in_text(df, key, overview), side, ["name"])
    known = known.withColumns({"_early": F.col("seq") < first,
                               "_fame": F.when((F.col("seq") < first) & (F.col("popularity") > 0), F.col("popularity")),
                               "_roi": F.when(F.col("seq") < first, F.col("roi"))})
    average = F.avg("popularity")
    stats = known.groupBy(key).agg(
        F.count("popularity").alias("found"),
        F.struct(average.alias("avg_cast_popularity"), F.max("popularity").alias("max_cast_popularity"),
                 F.count("popularity").cast("int").alias("num_cast_members"),
                 (average * F.count("popularity")).alias("star_power_score")).alias("cast"),
        F.count("_fame").alias("pops"), F.coalesce(F.avg("_fame"), F.lit(0.0)).alias("avg_popularity"),
        F.coalesce(F.max("_fame"), F.lit(0.0)).alias("max_popularity"), F.count("_roi").alias("rois"),
        F.coalesce(F.avg("_roi"), F.lit(0.0)).alias("avg_historical_roi"))
    factor = rules.reputation_factor(
        F.col("avg_popularity"), F.col("max_popularity"), F.col("pops"), F.col("avg_historical_roi"), F.col("rois"))
    return stats.select(
        key, F.when(F.col("found") > 0, F.col("cast")).alias("cast"),
        F.when((F.col("pops") > 0) | (F.col("rois") > 0), F.struct(
            factor.alias("factor"), "avg_popularity", "max_popularity", "avg_historical_roi")).alias("reputation"))


def actor_roi(credits: DataFrame, titles: DataFrame) -> DataFrame:
    """Mean past return of a title's cast, the title itself left out.

    Returns are held as whole millionths, so totals are exact and subtracting
    a title's own return leaves no rounding residue.
    """
    returns = titles.filter("budget > 0").select(
        "movie_id", F.rint(F.col("revenue") / F.col("budget") * 1_000_000).cast("bigint").alias("own")
    )
    cast = credits.filter("role = 'cast'").select("movie_id", "name").distinct().join(returns, "movie_id")
    totals = cast.groupBy("name").agg(F.sum("own").alias("total"), F.count("*").alias("n"))
    others = joins.salted_lookup(cast, totals, ["name"], F.col("movie_id"), "inner").filter("n > 1")
    mean = (F.col("total") - F.col("own")) / (F.col("n") - 1) / 1_000_000
    return others.groupBy("movie_id").agg(F.avg(mean).alias("avg_cast_historical_roi"))


def actor_roi_map(credits: DataFrame, titles: DataFrame) -> DataFrame:
    """(name, roi): mean return of every cast member over all their titles."""
    returns = titles.filter("budget > 0").select(
        "movie_id", F.rint(F.col("revenue") / F.col("budget") * 1_000_000).cast("bigint").alias("own")
    )
    cast = credits.filter("role = 'cast'").select("movie_id", "name").distinct().join(returns, "movie_id")
    return cast.groupBy("name").agg((F.sum("own") / F.count("*") / 1_000_000).alias("roi"))


def sanitize(df: DataFrame) -> DataFrame:
    return df.withColumns(scalars.sanitize_people({c: b for c, b in fixed.PEOPLE_BOUNDS.items() if c in df.columns}))
