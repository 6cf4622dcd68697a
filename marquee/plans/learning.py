"""Model training, selection and explanation on MLlib."""

from __future__ import annotations

from typing import NamedTuple

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Imputer, Normalizer, OneHotEncoder, RegexTokenizer, StandardScaler,
    StringIndexer, VectorAssembler)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import fixed, scalars
from marquee.operators import features, joins, stats, tfidf
from marquee.session import checkpointing, materialise


def preprocessing(train: DataFrame, numeric: list[str], categorical: list[str], text: str | None, vocabulary: int = 100) -> list:
    """Mean impute and scale, one-hot with unseen values kept apart, TF-IDF of the text.

    The terms and their weights are those of ``tfidf.vocabulary`` over the train
    rows; that list, ``vocabulary`` terms at most, is all that comes to the driver.
    """
    stages = [
        Imputer(inputCols=numeric, outputCols=[f"{c}__i" for c in numeric], strategy="mean"),
        VectorAssembler(inputCols=[f"{c}__i" for c in numeric], outputCol="numeric_raw"),
        StandardScaler(inputCol="numeric_raw", outputCol="numeric", withMean=True, withStd=True),
        StringIndexer(inputCols=categorical, outputCols=[f"{c}__x" for c in categorical], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}__x" for c in categorical], outputCols=[f"{c}__h" for c in categorical]),
    ]
    inputs = ["numeric", *[f"{c}__h" for c in categorical]]
    weights = {r.term: r.idf for r in tfidf.vocabulary(train, text, vocabulary).collect()} if text is not None else {}
    if weights:
        stages += [
            RegexTokenizer(inputCol=text, outputCol="words_all", pattern=tfidf.TERM, gaps=False),
            CountVectorizerModel.from_vocabulary(list(weights), inputCol="words_all", outputCol="term_counts"),
            ElementwiseProduct(scalingVec=Vectors.dense(list(weights.values())), inputCol="term_counts", outputCol="term_weights"),
            Normalizer(inputCol="term_weights", outputCol="terms"),
        ]
        inputs.append("terms")
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def model_frame(df: DataFrame) -> tuple[DataFrame, list[str], list[str], str | None]:
    """Frame with typed inputs, and which numeric, categorical and text features it has."""
    numeric = [c for c in fixed.NUMERIC_FEATURES if c in df.columns]
    categorical = [c for c in fixed.CATEGORICAL_FEATURES if c in df.columns]
    text = "overview" if "overview" in df.columns else None
    casts = {c: F.col(c).cast("double") for c in numeric}
    casts |= {c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in categorical}
    if text:
        casts[text] = F.coalesce(text, F.lit(""))
    return df.withColumns(casts), numeric, categorical, text


#: MLlib's deepest tree, where the reference sets no depth.
DEEPEST = 30

#: How trees are grown; none of it changes a tree.  Every row keeps the node it is in, checkpointed as rounds go, so no
#: task is sent the trees so far; and more nodes are split in one pass over the rows.
GROWING = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 512}


def regressors(label: str = "revenue", weight: str | None = None, trees: int = 100, depth: int = DEEPEST,
               rounds: int = 100, boosted_depth: int = 6, step: float = 0.3, subsample: float = 1.0,
               least_rows: int = 1, seed: int = 42) -> dict:
    """Candidate regressors, in tie-breaking order."""
    weighted = {"weightCol": weight} if weight else {}
    return {
        "linear": LinearRegression(labelCol=label, **weighted),
        "random_forest": RandomForestRegressor(
            labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=least_rows, seed=seed, **GROWING, **weighted),
        "boosted": GBTRegressor(
            labelCol=label, maxIter=rounds, stepSize=step, maxDepth=boosted_depth, subsamplingRate=subsample, seed=seed,
            **GROWING, **weighted),
    }


def retraining_regressors(label: str = "revenue", weight: str | None = "sample_weight") -> dict:
    """The larger candidates of the retraining."""
    return regressors(label, weight, trees=300, depth=20, rounds=300, boosted_depth=10, step=0.08, subsample=0.8,
                      least_rows=3)


def classifiers(label: str = "label", trees: int = 100, depth: int = DEEPEST, rounds: int = 100, boosted_depth: int = 6,
                step: float = 0.3, seed: int = 42) -> dict:
    """Candidate classifiers, in tie-breaking order."""
    return {
        "logistic": LogisticRegression(labelCol=label, family="multinomial", maxIter=1000),
        "random_forest": RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, **GROWING),
        "boosted": OneVsRest(classifier=GBTClassifier(maxIter=rounds, maxDepth=boosted_depth, stepSize=step, seed=seed, **GROWING),
                             labelCol=label, parallelism=3),
    }


def best_round(errors: list[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) of least error before ``patience`` rounds in a row brought none less, and whether they did."""
    best = 0
    for k, error in enumerate(errors):
        if best == 0 or error < errors[best - 1]:
            best = k + 1
        elif k + 1 - best >= patience:
            return best, True
    return best, False


def first_trees(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The boosted model as it was after ``rounds`` rounds."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    kinds = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(kinds.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for k in range(rounds):
        trees[k], weights[k] = java.trees()[k], java.treeWeights()[k]
    return GBTRegressionModel(kinds.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())).setFeaturesCol(
        model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


class Stopped(NamedTuple):
    """A boosted model cut to its best round, and the hold-out's mean squared error after every round looked at."""

    model: PipelineModel
    best: int
    errors: list[float]


def fit_early_stopping(df: DataFrame, label: str, holdout: str, train: str = "split = 'train'", rounds: int = 300,
                       patience: int = 10, depth: int = 8, step: float = 0.05, subsample: float = 0.8, least_rows: int = 20,
                       seed: int = 42) -> Stopped:
    """Boosting on the train rows until the rows marked in ``holdout`` have not improved for ``patience`` rounds.

    The trees after the best round are dropped.  MLlib can't go on with a
    boosted model, but its first rounds do not depend on how many follow: the
    horizon doubles until patience ends within it, which costs at most as many
    rounds again.
    """
    fitted = prepare(df, train)
    rows = fitted.ready.where(train).where(f"NOT {holdout}")
    held = fitted.ready.where(train).where(holdout)
    horizon = min(rounds, 4 * patience)
    while True:
        model = GBTRegressor(labelCol=label, maxIter=horizon, stepSize=step, maxDepth=depth, subsamplingRate=subsample,
                             minInstancesPerNode=least_rows, seed=seed, **GROWING).fit(rows)
        errors = [float(e) for e in model.evaluateEachIteration(held, "squared")]
        best, stopped = best_round(errors, patience)
        if stopped or horizon == rounds:
            looked_at = errors[:best + patience]
            return Stopped(PipelineModel(stages=[*fitted.stages, first_trees(model, best)]), best, looked_at)
        horizon = min(rounds, 2 * horizon)


class Prepared(NamedTuple):
    """Fitted preprocessing, and all rows with their features, written and spread over the cores."""

    stages: list
    ready: DataFrame


def prepare(df: DataFrame, train: str = "split = 'train'", vocabulary: int = 100) -> Prepared:
    """Preprocessing fitted on the train rows only; estimators then rescan what is written here."""
    frame, numeric, categorical, text = model_frame(df)
    rows = frame.filter(train)
    model = Pipeline(stages=preprocessing(rows, numeric, categorical, text, vocabulary)).fit(rows)
    # What the stages hand to each other would be several times what is asked of these rows.
    rows = model.transform(frame).select(*frame.columns, "features")
    checkpointing(df.sparkSession)
    return Prepared(model.stages, spread(materialise(rows, "prepared")))


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores: few files would keep most cores idle in every pass."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    key = [c for c in ("movie_id",) if c in df.columns]
    return materialise(df.repartition(cores, *key), "spread") if df.rdd.getNumPartitions() < cores else df


def fit(df: DataFrame, estimator, train: str = "split = 'train'", vocabulary: int = 100) -> PipelineModel:
    """Preprocessing and estimator fitted on the train rows only."""
    return fit_on(prepare(df, train, vocabulary), estimator, train)


def fit_on(prepared: Prepared, estimator, train: str = "split = 'train'") -> PipelineModel:
    return PipelineModel(stages=[*prepared.stages, estimator.fit(prepared.ready.filter(train))])


def predict(model: PipelineModel, df: DataFrame | Prepared, out: str = "predicted") -> DataFrame:
    """All rows with their prediction.  Rows prepared by the model's own preprocessing only meet its last stage."""
    if isinstance(df, Prepared):
        return model.stages[-1].transform(df.ready).withColumnRenamed("prediction", out)
    frame, *_ = model_frame(df)
    return model.transform(frame).withColumnRenamed("prediction", out)


def with_split(df: DataFrame, key: str = "movie_id", seed: int = 42, train_percent: int = 80) -> DataFrame:
    return df.withColumn("split", scalars.stable_split(F.col(key), seed, train_percent))


def select_best_regressor(df: DataFrame | Prepared, candidates: dict, label: str = "revenue",
                          fitted: dict[str, PipelineModel] | None = None) -> tuple[str, PipelineModel, list]:
    """(name, model, one metrics row per candidate); highest test R2 wins, the earlier on ties.

    The preprocessing is fitted once and shared.  A candidate that was fitted
    before on the same preparation is taken from ``fitted``.  Only the one-row
    metric aggregates reach the driver.
    """
    prepared = df if isinstance(df, Prepared) else prepare(df)
    best, table = None, []
    for name, estimator in candidates.items():
        model = (fitted or {}).get(name) or fit_on(prepared, estimator)
        scored = model.stages[-1].transform(prepared.ready.filter("split = 'test'"))
        row = stats.regression_metrics(scored, label, "prediction").first()
        table.append((name, row["rows"], row["r2"], row["rmse"], row["mae"], row["mape_positive"]))
        if best is None or row["r2"] > best[1]:
            best = (name, row["r2"], model)
    return best[0], best[2], table


def select_best_classifier(df: DataFrame | Prepared, candidates: dict, label: str = "label") -> tuple[str, PipelineModel, list]:
    """As ``select_best_regressor``, by weighted F1 of the test rows."""
    prepared = df if isinstance(df, Prepared) else prepare(df)
    best, table = None, []
    for name, estimator in candidates.items():
        model = fit_on(prepared, estimator)
        scored = model.stages[-1].transform(prepared.ready.filter("split = 'test'"))
        accuracy, f1 = accuracy_f1(scored, label, "prediction")
        table.append((name, accuracy, f1))
        if best is None or f1 > best[1]:
            best = (name, f1, model)
    return best[0], best[2], table


def accuracy_f1(scored: DataFrame, label: str, predicted: str) -> tuple[float, float]:
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol=predicted)
    return (evaluator.evaluate(scored, {evaluator.metricName: "accuracy"}),
            evaluator.evaluate(scored, {evaluator.metricName: "f1"}))


def importance(model: PipelineModel, df: DataFrame, top: int = 20) -> DataFrame:
    """Feature importance of the last stage under readable names, strongest first."""
    frame, *_ = model_frame(df)
    assembled = model.transform(frame.limit(1))
    meta = assembled.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in meta.values() for a in group}
    vocabulary = next((s.vocabulary for s in model.stages if hasattr(s, "vocabulary")), [])
    numeric = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    values = model.stages[-1].featureImportances
    rows = []
    for index in range(values.size):
        name = names.get(index, f"feature_{index}")
        if name.startswith("numeric_"):
            name = numeric[int(name.rsplit("_", 1)[1])].removesuffix("__i")
        elif name.startswith("terms_"):
            name = f"overview:{vocabulary[int(name.rsplit('_', 1)[1])]}"
        rows.append((name.replace("__h_", "="), float(values[index])))
    # One row per model input.
    ranked = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return ranked.orderBy(F.desc("importance"), "feature").limit(top)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel | None:
    """The stored model, or None when there is none: callers fall back to correlations."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    try:
        return PipelineModel.load(path)
    except (Py4JJavaError, PySparkException) as error:
        if not any(sign in str(error) for sign in ("PATH_NOT_FOUND", "Input path does not exist")):
            raise
        return None


def scorecard(metrics: DataFrame, topk: DataFrame, model_type: str, total_features: int) -> DataFrame:
    """One row: rounded metrics, counts and the feature groups as a map."""
    groups = F.create_map(*[
        part for name, members in fixed.FEATURE_GROUPS.items()
        for part in (F.lit(name), F.array(*[F.lit(m) for m in members]))])
    return metrics.select(
        F.lit(model_type).alias("model_type"), F.col("rows").alias("total_movies"),
        F.lit(total_features).alias("total_features"), F.round("r2", 4).alias("r2_score"),
        F.round("rmse", 0).alias("rmse"), F.round("mae", 0).alias("mae"),
        F.round("mape", 1).alias("overall_mape"), F.round(topk.select("topk_mape").scalar(), 1).alias("top50_mape"),
        groups.alias("feature_groups"))


def scorecard_from_report(report: DataFrame, total_movies: DataFrame, total_features: int, top: int = 50) -> DataFrame:
    """The scorecard of a stored validation report: no R2, the top rows' error as stored.

    ``report`` has title, actual_revenue, predicted_revenue, error_percentage;
    ``total_movies`` one row with the number of titles known.
    """
    best = report.orderBy(F.desc("actual_revenue"), "title", "predicted_revenue").limit(top)
    metrics = stats.regression_metrics(report, "actual_revenue", "predicted_revenue")
    card = scorecard(metrics.withColumn("r2", F.lit(None).cast("double")),
                     best.agg(F.avg("error_percentage").alias("topk_mape")), "stored validation report", total_features)
    return card.withColumn("total_movies", total_movies.scalar())


def enriched_titles(titles: DataFrame, cached_stats: DataFrame, fetch_stats) -> DataFrame:
    """Titles with people's figures refreshed, absent overviews filled, hype and weights recomputed.

    ``cached_stats`` has one row of people's figures per known title;
    ``fetch_stats`` gives such rows for the ids that it lacks.
    """
    fresh = joins.refresh_cache(titles.select("movie_id"), cached_stats, fetch_stats, "movie_id")
    columns = [n for n in fixed.PEOPLE_FEATURES if n in fresh.columns]
    have = titles.withColumns({n: F.lit(0.0) for n in columns if n not in titles.columns})
    overwritten = joins.enrich_overwrite(have.withColumns({n: F.col(n).cast("double") for n in columns}), fresh, "movie_id", columns)
    described = overwritten.withColumns({
        "overview": scalars.overview_or_default(F.col("overview"), F.col("primary_genre")),
        "hype_score": scalars.hype_score(F.col("popularity"), F.col("vote_count"), F.col("trailer_views"),
                                         F.col("trailer_likes"))})
    return features.sample_weights(described)


def enrich_retrain(titles: DataFrame, cached_stats: DataFrame, fetch_stats, path: str,
                   candidates: dict | None = None, top: int = 20) -> tuple[str, DataFrame]:
    """Refresh, train the weighted candidates, save the best at ``path``; its name and the error of the ``top`` titles."""
    ready = with_split(materialise(enriched_titles(titles, cached_stats, fetch_stats), "enriched"))
    name, model, _ = select_best_regressor(ready, candidates or retraining_regressors())
    save(model, path)
    largest = ready.orderBy(F.desc("revenue"), "movie_id").limit(top)
    scored = predict(model, largest)
    return name, scored.select("movie_id", "title", "revenue", "predicted", scalars.error_pct(
        F.col("revenue").cast("double"), F.col("predicted")).alias("error_percentage"))
