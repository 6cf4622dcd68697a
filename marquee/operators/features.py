"""Feature engineering over title tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import fixed, scalars, text
from marquee.operators import joins, quantiles


def clean_movies(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Movie detail documents to the ten cleaned columns, and the columns in ``keep`` as they are."""
    return docs.select(
        F.col("id").alias("movie_id"), "title", "budget", "revenue", "runtime", "popularity", "vote_average",
        "vote_count", "release_date", scalars.primary_genre(F.col("genres")).alias("primary_genre"), *(keep or []),
    ).na.fill({"budget": 0, "revenue": 0, "popularity": 0.0, "primary_genre": "Unknown"})


def clean_trailers(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Trailer documents to numeric counts; unreadable counts become 0."""
    stats = F.col("trailer_stats")
    return docs.select(
        "movie_id",
        scalars.to_bigint(stats["viewCount"]).alias("trailer_views"),
        scalars.to_bigint(stats["likeCount"]).alias("trailer_likes"),
        scalars.to_bigint(stats["commentCount"]).alias("trailer_comments"), *(keep or []),
    ).na.fill(0)


def fill_numeric(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def fill_all(df: DataFrame) -> DataFrame:
    """Numbers to 0 and strings to "": types stay what they were."""
    return df.na.fill(0).na.fill("")


def engagement_features(movies: DataFrame, trailers: DataFrame) -> DataFrame:
    """Movies left-joined with trailer counts, plus the four engagement features."""
    views, likes = F.col("trailer_views"), F.col("trailer_likes")
    return joins.merge_join(movies, trailers, ["movie_id"], "left").withColumns({
        "trailer_popularity_index": scalars.trailer_popularity_index(views),
        "interaction_rate": scalars.interaction_rate(likes, views),
        "engagement_velocity": scalars.engagement_velocity(views),
        "release_month": scalars.release_month(F.col("release_date")),
    })


def genre_averages(df: DataFrame, train) -> DataFrame:
    """(genre, mean revenue), fitted on the rows the ``train`` condition selects."""
    return df.filter(train).groupBy("primary_genre").agg(F.avg("revenue").alias("genre_avg_revenue"))


def engineered_features(df: DataFrame, train=None) -> DataFrame:
    """The eight engineered columns; ``train`` limits which rows fit the genre mean."""
    fitted = genre_averages(df, F.lit(True) if train is None else train)
    joined = joins.written_lookup(df, fitted, ["primary_genre"], "genre-averages")
    return joined.withColumns({
        "genre_avg_revenue": F.coalesce("genre_avg_revenue", F.lit(0.0)),
        "hype_score": scalars.hype_score(
            F.col("popularity"), F.col("vote_count"), F.col("trailer_views"), F.col("trailer_likes")),
        "vote_power": scalars.vote_power(F.col("vote_average"), F.col("vote_count")),
        "budget_popularity_ratio": scalars.budget_popularity_ratio(F.col("budget"), F.col("popularity")),
        "budget_tier": scalars.budget_tier(F.col("budget")),
        "is_franchise": text.is_franchise(F.col("title")).cast("int"),
        "is_sequel": scalars.is_sequel(F.col("title")),
        "description_length": F.length(F.coalesce("overview", F.lit(""))),
    })


def trend_momentum(series: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """Mean of the usable points per title; no usable point gives 0."""
    return series.groupBy("title").agg(
        F.coalesce(F.avg(scalars.numeric_text(F.col("value"))), F.lit(0.0)).alias("trend_momentum"))


def series_to_long(wide: DataFrame, index: str, keywords: list[str]) -> DataFrame:
    """One column per keyword to (title, ts, value) text rows; the partial flag is dropped."""
    kept = wide.drop("isPartial").select(F.col(index).cast("string").alias("ts"), *[
        F.col(k).cast("string").alias(k) for k in keywords])
    return kept.unpivot(["ts"], keywords, "title", "value").filter("value is not null")


def sample_weights(df: DataFrame, target: str = "revenue") -> DataFrame:
    """log1p(target / median), scaled to mean 1; both statistics are scalar subqueries.

    Where the median is 0 the target itself takes the ratio's place; where no
    target is above 0 every weight is 1.
    """
    median = quantiles.median_of(df, target)
    ratio = F.coalesce(F.try_divide(F.col(target).cast("double"), median.cast("double")), F.col(target).cast("double"))
    raw = df.withColumn("_raw", F.log1p(ratio))
    mean = raw.agg(F.avg("_raw")).scalar()
    weight = F.when(F.col("_raw").isNotNull(), F.coalesce(F.try_divide(F.col("_raw"), mean), F.lit(1.0)))
    return raw.withColumn("sample_weight", weight).drop("_raw")


def impute_median(df: DataFrame, columns: list[str], target: str = "revenue", below: float = 3e9) -> DataFrame:
    """NULL and NaN to the column's exact median, infinities to 0, outlier targets dropped."""
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in columns}
    df = df.withColumns(known)
    row = quantiles.medians(df, columns).select(F.struct(*columns)).scalar()
    filled = {c: scalars.finite_or_zero(F.coalesce(F.col(c).cast("double"), F.col("_m")[c])) for c in columns}
    return df.filter(F.col(target) < below).withColumn("_m", row).withColumns(filled).drop("_m")


def standardize(df: DataFrame, columns: list[str], fit_on=None) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    source = df if fit_on is None else df.filter(fit_on)
    stats = source.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns])).scalar()
    fit = {c: F.col("_s")[c] for c in columns}
    scaled = {
        c: F.when(fit[c]["std"] > 0, (F.col(c) - fit[c]["mean"]) / fit[c]["std"]).otherwise(F.lit(0.0))
        for c in columns}
    return df.withColumn("_s", stats).withColumns(scaled).drop("_s")


def align_record(df: DataFrame) -> DataFrame:
    """Every scoring field, defaults filled, month fixed; absent columns are created."""
    have = set(df.columns)
    out = [F.col(name) for name in ("movie_id", "_row") if name in have]
    for name, dtype, default in fixed.RECORD_FIELDS:
        if name in have:
            value = F.col(name).try_cast(dtype)
            out.append((value if default is None else F.coalesce(value, F.lit(default).cast(dtype))).alias(name))
        elif default is None:
            raise ValueError(f"column {name} is required")
        else:
            out.append(F.lit(default).cast(dtype).alias(name))
    return df.select(*out, F.lit(6).alias("release_month"))


def align_features(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """The model's input columns: missing ones defaulted, text and genre never NULL."""
    special = {"overview": F.lit(""), "primary_genre": F.lit("Unknown"), "release_month": F.lit(6)}
    out = []
    for name in features or fixed.MODEL_FEATURES:
        if name not in df.columns:
            out.append(special.get(name, F.lit(0)).alias(name))
        elif name == "release_month":
            out.append(F.coalesce(F.col(name).try_cast("double").try_cast("int"), F.lit(6)).alias(name))
        elif name in special:
            out.append(F.coalesce(F.col(name).cast("string"), special[name]).alias(name))
        else:
            out.append(F.col(name))
    keep = [F.col("movie_id")] if "movie_id" in df.columns else []
    return df.select(*keep, *out)


def skip_bad_records(raw: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, rejected raw rows with the fields that did not parse)."""
    bad = {c: F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in fields.items()}
    marked = raw.withColumn("_bad", F.array_compact(F.array(*[F.when(b, F.lit(c)) for c, b in bad.items()])))
    good = marked.filter(F.size("_bad") == 0).drop("_bad")
    rejects = marked.filter(F.size("_bad") > 0).withColumn("bad_fields", F.array_join("_bad", ",")).drop("_bad")
    return good.withColumns({c: F.col(c).try_cast(t) for c, t in fields.items()}), rejects


def filter_and_impute_views(df: DataFrame) -> DataFrame:
    """Drop rows without any signal, then estimate missing views."""
    kept = df.filter(scalars.has_signal(F.col("trailer_views"), F.col("popularity")))
    return kept.withColumn(
        "trailer_views", scalars.imputed_views(F.col("trailer_views"), F.col("popularity"), F.col("vote_average")))


def validation_filter(df: DataFrame, as_of: str, min_year: int = 2010) -> DataFrame:
    """Rows fit for error reporting: real title, released in range, enough money and votes."""
    released = scalars.parse_date(F.col("release_date"))
    return df.filter(
        ~text.is_synthetic_title(F.col("title"))
        & (F.year(released) >= min_year)
        & (released <= F.lit(as_of).cast("date"))
        & (F.col("revenue") >= 50_000_000)
        & (F.col("budget") >= 5_000_000)
        & (F.col("vote_count") >= 100)
    )


# --- fixed values: words and genres of generated loss-making titles ---
FLOP_WORDS = [
    "boring", "terrible", "waste", "disaster", "awful", "dull", "lifeless",
    "uninspired", "mess", "failure", "flop", "worst", "garbage", "cliche",
    "predictable", "poorly", "amateur", "forgetful", "bland", "cheap",
    "pointless", "slow", "confusing", "weak", "badly", "horrible",
]
FLOP_GENRES = ["Action", "Comedy", "Drama", "Horror", "Thriller", "Science Fiction", "Romance"]
FLOP_STARTS = ["A", "The", "This"]
FLOP_SUBJECTS = ["movie is", "film is", "story is", "plot is"]


def synthetic_flops(seeds: DataFrame, seed_id: str) -> DataFrame:
    """One generated loss-making title per seed row, from arithmetic on the row's id.

    Every figure is a function of the id, so any engine and any partitioning
    gives the same rows; 70 of 100 ids get the low budget band.
    """
    k = F.col(seed_id)

    def spread(multiplier: int, offset: int, modulus: int):
        return F.pmod(F.pmod(k, F.lit(1_000_003)) * multiplier + offset, F.lit(modulus))

    def pick(choices: list[str], position):
        return F.element_at(F.array(*[F.lit(c) for c in choices]), (position + 1).cast("int"))

    low = spread(37, 11, 100) < 70
    budget = F.when(low, 10_000 + spread(7919, 13, 990_001)).otherwise(20_000_000 + spread(104_729, 17, 80_000_001))
    share = F.when(low, 100 + spread(613, 5, 701)).otherwise(100 + spread(613, 5, 401))
    tenths = 1 + spread(331, 7, 50)
    views = tenths * 100
    cast_pop = spread(211, 3, 500) / 100
    num_cast = 1 + spread(17, 1, 15)
    director_pop = spread(89, 9, 200) / 100
    body = F.concat_ws(
        " ", pick(FLOP_STARTS, spread(5, 0, 3)), pick(FLOP_SUBJECTS, spread(3, 1, 4)),
        pick(FLOP_WORDS, spread(41, 2, 26)), F.lit("and"),
        F.concat(pick(FLOP_WORDS, spread(43, 8, 26)), F.lit(".")), F.lit("It fails to deliver."))
    zero = F.lit(0.0)
    return seeds.select(
        F.concat(F.lit("synthetic_flop_"), k.cast("string")).alias("movie_id"),
        F.concat(F.lit("Bad Movie "), k.cast("string")).alias("title"),
        budget.alias("budget"),
        F.floor(budget * share / 1000).cast("bigint").alias("revenue"),
        (60 + spread(19, 4, 41)).cast("int").alias("runtime"),
        (tenths / 10).alias("popularity"),
        (1 + spread(23, 6, 36) / 10).alias("vote_average"),
        (5 + spread(29, 2, 46)).cast("bigint").alias("vote_count"),
        F.lit("2020-01-01").alias("release_date"),
        pick(FLOP_GENRES, spread(13, 5, 7)).alias("primary_genre"),
        views.cast("bigint").alias("trailer_views"),
        F.floor(views / 100).cast("bigint").alias("trailer_likes"),
        F.floor(views / 1000).cast("bigint").alias("trailer_comments"),
        F.lit(0.1).alias("trailer_popularity_index"),
        F.lit(0.01).alias("interaction_rate"),
        zero.alias("engagement_velocity"),
        (1 + spread(31, 3, 12)).cast("int").alias("release_month"),
        (spread(47, 1, 301) / 100).alias("youtube_sentiment"),
        (0.1 + spread(53, 2, 21) / 100).alias("sentiment_volatility"),
        zero.alias("trend_momentum"),
        num_cast.cast("double").alias("num_cast_members"),
        cast_pop.alias("avg_cast_popularity"),
        (cast_pop * 1.2).alias("max_cast_popularity"),
        (cast_pop * num_cast).alias("star_power_score"),
        F.lit(1.0).alias("num_directors"),
        director_pop.alias("avg_director_popularity"),
        director_pop.alias("max_director_popularity"),
        director_pop.alias("director_experience_score"),
        F.lit(1.0).alias("num_composers"),
        zero.alias("avg_composer_popularity"),
        zero.alias("max_composer_popularity"),
        zero.alias("music_prestige_score"),
        zero.alias("wikipedia_worldwide_box_office"),
        zero.alias("wikipedia_budget"),
        body.alias("overview"),
        F.lit("Flop").alias("success_class"),
    )


def augment(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Real rows (earlier generated ones removed) plus generated rows, aligned by name."""
    kept = real.withColumn("movie_id", F.col("movie_id").cast("string")).filter(
        ~F.col("movie_id").startswith("synthetic_flop"))
    return kept.unionByName(synthetic, allowMissingColumns=True)
