"""Analytics: coverage, error reports, correlations, distributions, model metrics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import quantiles
from marquee.operators.joins import written_lookup
from marquee.operators.numbering import numbered
from marquee.session import materialise


def dataset_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_movies"), F.avg("revenue").alias("avg_revenue"),
        F.avg("budget").alias("avg_budget"), F.avg("youtube_sentiment").alias("avg_sentiment"))


def error_by_genre(df: DataFrame) -> DataFrame:
    return df.groupBy("primary_genre").agg(
        F.avg("pred_error").alias("mean"), F.count("*").alias("count")).orderBy(F.desc("mean"), "primary_genre")


def high_error_by_genre(df: DataFrame, at_least: float = 40.0) -> DataFrame:
    high = df.filter(F.col("pred_error") >= at_least).groupBy("primary_genre").agg(F.count("*").alias("count"))
    return high.orderBy(F.desc("count"), "primary_genre")


def high_error_profile(df: DataFrame, at_least: float = 40.0) -> DataFrame:
    """Means of the high-error rows beside the means of all rows, in one pass."""
    high = F.col("pred_error") >= at_least
    return df.agg(
        F.avg(F.when(high, F.col("popularity"))).alias("high_avg_popularity"),
        F.avg("popularity").alias("avg_popularity"),
        F.avg(F.when(high, F.col("vote_count"))).alias("high_avg_vote_count"),
        F.avg("vote_count").alias("avg_vote_count"),
        F.count_if(high & (F.col("trailer_views") == 0)).alias("high_zero_views"),
        F.count_if(high).alias("high_rows"))


def error_summary(df: DataFrame) -> DataFrame:
    """Mean, exact median and tail counts of the error column."""
    error = F.col("pred_error")
    return df.agg(
        F.count("*").alias("rows"), F.avg(error).alias("mean_error"),
        F.count_if(error >= 40).alias("at_least_40"), F.count_if(error > 40).alias("over_40"),
        F.count_if(error > 100).alias("over_100"), F.count_if(error > 500).alias("over_500"),
    ).withColumn("median_error", quantiles.median_of(df, "pred_error"))


def class_distribution(df: DataFrame, column: str = "success_class") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)


def coverage_counts(df: DataFrame) -> DataFrame:
    """How many rows carry each engagement signal, overall and among rows without views."""
    signals = ["trailer_views", "trailer_likes", "trailer_comments", "youtube_sentiment", "interaction_rate",
               "engagement_velocity", "trailer_popularity_index"]
    none = F.col("trailer_views") == 0
    others = ["youtube_sentiment", "engagement_velocity", "interaction_rate", "trailer_popularity_index"]
    any_other = (F.col(others[0]) > 0) | (F.col(others[1]) > 0) | (F.col(others[2]) > 0)
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c) > 0).alias(f"with_{c}") for c in signals],
        F.min("youtube_sentiment").alias("min_sentiment"), F.max("youtube_sentiment").alias("max_sentiment"),
        F.count_if(none).alias("zero_views"),
        *[F.count_if(none & (F.col(c) > 0)).alias(f"zero_views_with_{c}") for c in others],
        F.count_if(none & any_other).alias("zero_views_with_any"),
        F.count_if((F.col("trailer_views") > 0) | (F.col("popularity") >= 40)).alias("kept_rows"))


def quality_counts(df: DataFrame) -> DataFrame:
    revenue, budget = F.col("revenue"), F.col("budget")
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(revenue == 0).alias("zero_revenue"), F.count_if(budget == 0).alias("zero_budget"),
        F.count_if((revenue == 0) & (budget == 0)).alias("both_zero"),
        F.count_if((revenue > 0) & (budget == 0)).alias("revenue_without_budget"),
        F.count_if((revenue > 1000) & (budget > 1000)).alias("valid"),
        F.count_if((revenue > 0) & (budget > 0)).alias("testable"),
        F.count_if(revenue > 1000).alias("revenue_over_1000"))


def describe_positive(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of the positive values."""
    positive = df.filter(F.col(column) > 0)
    spread = quantiles.column_quantiles(positive, [column], [0.25, 0.5, 0.75])
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    quartiles = spread.agg(F.struct(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for p, name in names.items()])).scalar()
    value = F.col(column)
    return positive.agg(
        F.count("*").alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    ).withColumn("_q", quartiles).select("count", "mean", "std", "min", "max", "_q.*")


_CELL = "a int, b int, n long, mx double, my double, xx double, yy double, xy double, x0 double, x1 double, y0 double, y1 double, bad long"


def _masked_products(left: int, right: int, rows: int = 1 << 16):
    """Task function: per block of rows one row per cell (a, b), over the rows where both columns are known.

    Counts, means and centred sums of squares and products are matrix products
    of the values and of their masks.  ``bad`` counts values that are no numbers.
    """
    def cells(values, known):
        import numpy as np
        import pyarrow as pa

        bad = known & ~np.isfinite(values)
        held = np.where(known & ~bad, values, 0.0)
        shift = held.sum(axis=0) / np.maximum((known & ~bad).sum(axis=0), 1)
        held = np.where(known & ~bad, held - shift, 0.0)  # centred, so that products do not cancel
        mask = known.astype(float)
        x, mx = held[:, :left], mask[:, :left]
        y, my = held[:, left:], mask[:, left:]
        n = mx.T @ my
        at_least = np.maximum(n, 1)
        sx, sy = (x.T @ my) / at_least, (mx.T @ y) / at_least
        low, high = np.where(known, values, np.inf), np.where(known, values, -np.inf)
        extremes = np.empty((4, left, right))
        for k in range(right):
            rows_of = known[:, left + k]
            extremes[0, :, k] = low[rows_of, :left].min(axis=0, initial=np.inf)
            extremes[1, :, k] = high[rows_of, :left].max(axis=0, initial=-np.inf)
        for k in range(left):
            rows_of = known[:, k]
            extremes[2, k] = low[rows_of, left:].min(axis=0, initial=np.inf)
            extremes[3, k] = high[rows_of, left:].max(axis=0, initial=-np.inf)
        at = np.indices((left, right), dtype=np.int32)
        found = [at[0], at[1], n.astype(np.int64), sx + shift[:left, None], sy + shift[None, left:],
                 (x * x).T @ my - n * sx * sx, mx.T @ (y * y) - n * sy * sy, x.T @ y - n * sx * sy, *extremes,
                 (bad[:, :left].T.astype(float) @ my + mx.T @ bad[:, left:]).astype(np.int64)]
        keep = n.ravel() > 0
        return pa.RecordBatch.from_arrays([pa.array(f.ravel()[keep]) for f in found],
                                          names=[c.split()[0] for c in _CELL.split(", ")])

    def run(batches):
        import numpy as np

        held, size = [], 0
        for batch in batches:
            columns = [batch.column(k) for k in range(batch.num_columns)]
            held.append((np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]),
                         np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])))
            size += batch.num_rows
            if size >= rows:
                yield cells(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield cells(*map(np.concatenate, zip(*held)))

    return run


def _pair_correlations(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """(a, b, correlation) of every column of ``left`` with every one of ``right``, each over the rows where both are
    known; a column constant there gives NULL, one with a value that is no number NaN.

    One pass over the rows: every block of rows gives a cell per pair, and the
    cells are merged about their common mean.
    """
    order = F.create_map(*[x for k, c in enumerate(left) for x in (F.lit(k), F.lit(c))])
    across = F.create_map(*[x for k, c in enumerate(right) for x in (F.lit(k), F.lit(c))])
    values = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate([*left, *right])])
    parts = materialise(values.mapInArrow(_masked_products(len(left), len(right)), _CELL), "correlation-cells")
    mean = parts.groupBy("a", "b").agg(
        (F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("ax"), (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("ay"))
    dx, dy, n = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay"), F.col("n")
    merged = parts.join(mean, ["a", "b"]).groupBy("a", "b").agg(
        F.sum(F.col("xx") + n * dx * dx).alias("xx"), F.sum(F.col("yy") + n * dy * dy).alias("yy"),
        F.sum(F.col("xy") + n * dx * dy).alias("xy"), F.sum("bad").alias("bad"),
        ((F.max("x1") > F.min("x0")) & (F.max("y1") > F.min("y0"))).alias("varies"))
    cells = df.sparkSession.createDataFrame(
        [(k, j) for k in range(len(left)) for j in range(len(right))], "a int, b int").join(merged, ["a", "b"], "left")
    value = F.when(F.col("bad") > 0, F.lit(float("nan"))).when(
        F.col("varies"), F.col("xy") / (F.sqrt("xx") * F.sqrt("yy")))
    return cells.select(F.element_at(order, F.col("a")).alias("a"), F.element_at(across, F.col("b")).alias("b"),
                        value.alias("correlation"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """All cells of the Pearson matrix, long form, each over the rows where both columns are known; a constant column
    gives NULL."""
    return _pair_correlations(df, columns, columns)


def correlation_ranking(df: DataFrame, target: str, columns: list[str], top: int = 20) -> DataFrame:
    """Features by absolute correlation with the target, strongest first."""
    pairs = _pair_correlations(df, [c for c in columns if c != target], [target])
    ranked = pairs.select(F.col("a").alias("feature"), F.abs("correlation").alias("importance")).dropna()
    return ranked.orderBy(F.desc("importance"), "feature").limit(top)


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                       by: list[str] | None = None) -> DataFrame:
    """R2, RMSE, MAE, MAPE over max(actual, 1) and over actual > 0, share under 40 %."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    pct = F.abs(y - p) / F.greatest(y, F.lit(1.0)) * 100
    sse, sst = F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y)
    grouped = df.groupBy(*(by or []))
    return grouped.agg(
        F.count("*").alias("rows"),
        F.when(F.max(y) > F.min(y), 1 - sse / sst).alias("r2"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg(pct).alias("mape"),
        F.avg(F.when(y > 0, pct)).alias("mape_positive"),
        (F.count_if(pct < 40) / F.count("*") * 100).alias("share_under_40"))


def topk_mape(df: DataFrame, k: int = 50, key: str = "movie_id") -> DataFrame:
    """MAPE of the k rows with the largest actual value."""
    top = df.orderBy(F.desc("actual"), key).limit(k)
    error = F.abs(F.col("actual") - F.col("predicted")) / F.greatest(F.col("actual").cast("double"), F.lit(1.0)) * 100
    return top.agg(F.count("*").alias("rows"), F.avg(error).alias("topk_mape"))


def rank_split_error(df: DataFrame, first: int = 100, key: str = "movie_id") -> DataFrame:
    """Mean error of the first rows by actual value, of the rest, and of all.

    The first rows come from a top-k, the totals from a plain aggregate; no
    global numbering of the rows is needed.
    """
    error = F.col("error_percentage")
    leading = df.orderBy(F.desc("actual"), key).limit(first).agg(
        F.struct(F.count("*").alias("n"), F.sum(error).alias("s"))).scalar()
    totals = df.agg(F.count("*").alias("n"), F.sum(error).alias("s")).withColumn("t", leading)
    top = F.col("t")
    rest_n, rest_s = F.col("n") - top["n"], F.col("s") - top["s"]
    return totals.select(
        (top["s"] / top["n"]).alias("top_mean"),
        rest_n.alias("rest_rows"),
        F.when(rest_n > 0, rest_s / rest_n).alias("rest_mean"),
        (F.col("s") / F.col("n")).alias("all_mean"))


def classification_metrics(df: DataFrame, classes: list[str], label: str = "label",
                           predicted: str = "predicted") -> DataFrame:
    """Accuracy, weighted F1 and macro one-vs-rest AUC.

    ``df`` has a score column ``score_<class>`` per class.  AUC is the rank-sum
    statistic over (class, score) counts with bucketed running totals; a class
    with no positive or no negative row makes it 0, as an undefined AUC.
    """
    confusion = df.groupBy(label, predicted).agg(F.count("*").alias("n"))
    n = F.col("n")
    cells = F.array(*[F.struct(
        F.lit(c).alias("class"), F.when(F.col(label) == c, n).otherwise(0).alias("support"),
        F.when(F.col(predicted) == c, n).otherwise(0).alias("called"),
        F.when((F.col(label) == c) & (F.col(predicted) == c), n).otherwise(0).alias("right")) for c in classes])
    per_class = confusion.select(F.inline(cells)).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("right").alias("right"))
    found = F.col("support") + F.col("called")
    f1 = F.when(found > 0, 2 * F.col("right") / found).otherwise(F.lit(0.0))
    total = F.sum("support")
    scores = per_class.agg((F.sum("right") / total).alias("accuracy"), (F.sum(f1 * F.col("support")) / total).alias("f1"))

    long = df.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("class"), F.col(f"score_{c}").cast("double").alias("score"),
        (F.col(label) == c).cast("long").alias("pos")) for c in classes])))
    counts = long.groupBy("class", "score").agg(F.sum("pos").alias("pos"), F.count("*").alias("all"))
    counts = counts.withColumn("neg", F.col("all") - F.col("pos")).drop("all")
    ranked = quantiles.running_totals(counts, "class", "score", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    possible = F.sum("pos") * F.sum("neg")
    per_class_auc = ranked.groupBy("class").agg(F.when(possible > 0, wins / possible).alias("auc"))
    auc = per_class_auc.agg(
        F.when(F.count("auc") == len(classes), F.avg("auc")).otherwise(F.lit(0.0))).scalar()
    return scores.withColumn("auc", auc)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum, empty ones included; the last bin holds the maximum."""
    value = F.col(column).cast("double")
    edges = df.agg(F.struct(
        F.min(value).alias("lo"), ((F.max(value) - F.min(value)) / bins).alias("width"))).scalar()
    lo, width = F.col("_e.lo"), F.col("_e.width")
    number = F.when(width > 0, F.least(F.floor((value - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    placed = df.filter(value.isNotNull()).withColumn("_e", edges).select(number.cast("int").alias("bin"))
    counted = placed.groupBy("bin").agg(F.count("*").alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), edges.alias("_e"))
    return every.join(counted, "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("lower"), (lo + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"))


def density_grid(df: DataFrame, column: str, points: int = 50) -> DataFrame:
    """Gaussian kernel density on an even grid, normal-reference (Scott) bandwidth.

    Each grid point is one sum in a single aggregate, over (value, count), so
    rows are never multiplied by grid points.
    """
    value = F.col(column).cast("double")
    grouped = df.filter(value.isNotNull()).groupBy(value.alias("x")).agg(F.count("*").alias("w"))
    bandwidth = F.stddev_samp(value) * F.pow(F.count(value).cast("double"), F.lit(-0.2))
    stats = df.agg(F.struct(
        F.min(value).alias("lo"), ((F.max(value) - F.min(value)) / (points - 1)).alias("step"),
        F.count(value).alias("n"), bandwidth.alias("h"))).scalar()
    prepared = grouped.withColumn("_s", stats).select("x", "w", "_s.*")
    sums = [
        F.sum(F.col("w") * F.exp(-F.pow((F.col("x") - (F.col("lo") + i * F.col("step"))) / F.col("h"), 2) / 2)).alias(
            f"s{i}") for i in range(points)]
    one_row = prepared.filter("h > 0").agg(*sums, *[F.max(c).alias(c) for c in ("h", "lo", "step", "n")])
    cells = F.array(*[F.struct(F.lit(i).alias("point"), F.col(f"s{i}").alias("total")) for i in range(points)])
    norm = F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    return one_row.select("h", "lo", "step", "n", F.inline(cells)).filter("total is not null").select(
        "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"), (F.col("total") / norm).alias("density"))


def distinct_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def worst_errors(df: DataFrame, top: int = 15, key: str = "movie_id") -> DataFrame:
    """The largest errors among rows with finite figures."""
    finite = df.filter(
        F.col("actual").isNotNull() & (F.abs(F.col("actual").cast("double")) < float("inf"))
        & F.col("error_percentage").isNotNull() & (F.abs("error_percentage") < float("inf")))
    return finite.orderBy(F.desc("error_percentage"), key).limit(top)


SORT_KEYS = {"revenue": "revenue", "budget": "budget", "sentiment": "youtube_sentiment",
             "popularity": "popularity", "vote": "vote_average"}


def browse_page(df: DataFrame, query: str = "", sort: str = "revenue", page: int = 1, limit: int = 50,
                key: str = "movie_id") -> DataFrame:
    """One page of titles whose title or genre contains the query, with the total count."""
    needle = F.lit(query.lower())
    found = df.filter(F.contains(F.lower("title"), needle) | F.contains(F.lower("primary_genre"), needle))
    total = found.agg(F.count("*")).scalar()
    ordered = found.orderBy(F.desc(SORT_KEYS[sort]), key)
    return ordered.offset((page - 1) * limit).limit(limit).withColumn("total", total)


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """Adds ``<column>_index``: alphabetical position among the distinct labels, NULL for NULL.

    The distinct labels are numbered in ranges, so no task holds them all.
    """
    labels = df.where(F.col(column).isNotNull()).select(column).distinct()
    numbers = numbered(labels, [column], f"{column}_index", "label-numbers")
    return written_lookup(df, numbers.withColumn(f"{column}_index", F.col(f"{column}_index").cast("int")), [column], "labels").select(
        *df.columns, f"{column}_index")
