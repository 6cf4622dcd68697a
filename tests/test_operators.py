"""Operators on small fixtures: hand-worked cases, brute force, skew and invariants."""

import inspect
import json
import random

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Row
from pyspark.sql import functions as F

from marquee import bindings as b
from marquee import schemas
from marquee.functions import rules, text
from marquee.catalog import sources as catalog_sources
from marquee.operators import features, joins, lexicon, numbering, people, quantiles, similarity, stats, tfidf
from marquee.plans import final_dataset, learning, scoring, steps
from marquee.session import scratch_path
from marquee.sources import cache as persisted, readers, sinks
from marquee.sources.versions import Versions


def test_keep_first_and_plan(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1), (1, "c", 2)], "id int, v string, seq int")
    once = joins.keep_first(df, ["id"], ["seq"])
    assert sorted((r.id, r.v) for r in once.collect()) == [(1, "a"), (2, "b")]
    assert sorted(joins.keep_first(once, ["id"], ["seq"]).collect()) == sorted(once.collect())
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # one row per key and task before the shuffle


def test_salted_lookup_keeps_every_row(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("4", 2)], "k string, v int")
    out = joins.salted_lookup(left, right, ["k"], F.col("id"))
    assert out.count() == 3000
    assert out.filter("v = 1").count() == 1000 and out.filter("v = 2").count() == 1


def test_pick_candidate(spark):
    rows = [(1, 1, 0), (1, 2, 0), (1, 3, 7), (1, 4, 9), (2, 1, 0), (2, 2, 0), (3, 1, 0), (3, 6, 5)]
    df = spark.createDataFrame(rows, "movie_id int, rank int, comments int")
    got = {r.movie_id: r["rank"] for r in joins.pick_candidate(df, "movie_id", "rank", "comments").collect()}
    assert got == {1: 3, 2: 1, 3: 1}


def credit_rows(spark, cast, directors=()):
    rows = [(1, "cast", i, f"c{i}", float(p)) for i, p in enumerate(cast)]
    rows += [(1, "director", i, f"d{i}", float(p)) for i, p in enumerate(directors)]
    return spark.createDataFrame(rows, "movie_id int, role string, seq int, name string, popularity double")


def test_people_stats(spark):
    v1 = people.stats_v1(credit_rows(spark, [10, 20, 30])).first()
    assert (v1.num_cast_members, v1.avg_cast_popularity, v1.max_cast_popularity, v1.star_power_score) == (3, 20, 30, 60)
    assert v1.num_directors == 0 and v1.director_experience_score == 0
    v2 = people.stats_v2(credit_rows(spark, [0, 10, 20, 30, 40], [5, 0, 7])).first()
    assert (v2.num_cast_members, v2.avg_cast_popularity, v2.max_cast_popularity, v2.star_power_score) == (5, 25, 40, 90)
    assert (v2.num_directors, v2.avg_director_popularity, v2.max_director_popularity,
            v2.director_experience_score) == (3, 6, 7, 12)


def test_sentiment(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4), (2, 0.5)], "movie_id int, compound double")
    titles = spark.createDataFrame([(1,), (2,), (3,)], "movie_id int")
    got = {r.movie_id: (r.youtube_sentiment, r.sentiment_volatility)
           for r in lexicon.sentiment_by_title(df, titles).collect()}
    assert got[1] == pytest.approx((0.3, 0.141421), abs=1e-6)
    assert got[2] == (0.5, 0.0) and got[3] == (0.0, 0.0)


@pytest.mark.parametrize("total, out", [(1.9, 0.4404), (-2.5, -0.5423), (4.0, 0.7184)])
def test_compound(spark, total, out):
    assert spark.range(1).select(lexicon.compound(F.lit(total))).first()[0] == pytest.approx(out, abs=5e-5)


def test_negation_and_boost(spark):
    words = spark.createDataFrame([("good", 1.9, 0.0, 0.0)], "token string, valence double, polarity double, subjectivity double")
    texts = spark.createDataFrame(
        [(1, "good"), (2, "not good"), (3, "very good"), (4, "nothing said"), (5, None)], "id int, text string")
    got = {r.id: r.compound for r in lexicon.comment_scores(texts, words, ["id"]).collect()}
    assert got[1] == pytest.approx(0.4404, abs=5e-5)
    assert got[2] < 0 < got[1] < got[3]
    assert got[4] == 0 and got[5] == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    # A third of all rows share one value, the rest is heavy-tailed.
    values = np.concatenate([np.full(20_000, 7.0), rng.lognormal(3, 2, 40_001).round(3)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
    got = {r.prob: r.quantile for r in quantiles.column_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.999, 1.0]).collect()}
    for prob, value in got.items():
        assert value == pytest.approx(np.quantile(values, prob), rel=1e-12)
    assert len(got) == 5


def test_running_totals(spark):
    rng = random.Random(3)
    rows = [("a" if i % 3 else "b", rng.randrange(500) / 4, 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double, n bigint").groupBy("g", "v").agg(F.sum("n").alias("n"))
    got = quantiles.running_totals(df, "g", "v", ["n"]).collect()
    for r in got:
        assert r.n_before == sum(1 for g, v, _ in rows if g == r.g and v < r.v)


def brute_force(queries, references):
    tokens = lambda t: {w for w in t.split() if len(w) > 2}
    out = {}
    for qid, genre, body in queries:
        pool = [r for r in references if genre and r[1] == genre] or references
        q = tokens(body)
        if not q:
            out[qid] = (min(r[0] for r in pool), None)
            continue
        scored = [(len(q & tokens(r[2])) / len(q | tokens(r[2])), -r[0]) for r in pool if tokens(r[2])]
        best = max(scored)
        out[qid] = (-best[1], best[0])
    return out


@pytest.mark.parametrize("seed, limits", [(5, {}), (6, {}), (6, {"PROBED": 1, "SMALLEST": 1}), (7, {"PROBED": 10_000})])
def test_similarity_matches_brute_force(spark, monkeypatch, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(similarity, name, value)
    rng = random.Random(seed)
    # Skewed words, so that some tokens are in most texts; a third of the references are copies of one text.
    words = [f"w{int(rng.paretovariate(0.6)) % 400:03d}" for _ in range(4000)]
    body = lambda: " ".join(rng.sample(words, rng.randrange(0, 14)))
    copied = "alpha beta gamma " + body()
    references = [(i, rng.choice(["a", "b", "c"]), copied if i % 3 == 0 else body()) for i in range(240)]
    queries = [(i, rng.choice(["a", "b", "", "zz"]), copied if i % 7 == 0 else body()) for i in range(60)]
    schema = "movie_id int, primary_genre string, overview string"
    q = spark.createDataFrame(queries, schema).withColumn("title", F.lit(""))
    r = spark.createDataFrame(references, schema).withColumn("title", F.lit(None).cast("string"))
    # Lists of more than 10 postings are cut, so the longest lie in several slices.
    index = similarity.build_index(r, slice_rows=10)
    assert index.postings.agg(F.max("slice")).first()[0] >= 2
    got = {x.movie_id: (x.match_id, x.score) for x in similarity.nearest(q, index).collect()}
    expected = brute_force(queries, references)
    assert got.keys() == expected.keys()
    for key, (match, score) in expected.items():
        assert got[key][0] == match, (key, got[key], expected[key])
        assert got[key][1] == (pytest.approx(score) if score is not None else None)


def test_similarity_without_references(spark):
    q = spark.createDataFrame([(1, "x", "some words", "a")], "movie_id int, title string, overview string, primary_genre string")
    got = similarity.most_similar(q, q.filter("movie_id < 0")).first()
    assert (got.kind, got.match_id) == ("fallback_default", None)


def test_index_is_read_not_derived(spark, sf):
    """One index serves any number of batches, and a batch reads no reference text."""
    index = b.reference_index(spark, sf)
    again = b.reference_index(spark, sf)
    assert sorted(index.postings.inputFiles()) == sorted(again.postings.inputFiles())
    out = similarity.social_signals(b.asked(spark, sf), again)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan and "overview" not in plan


def test_few_pairs_are_reached(spark, sf):
    """Pairs met by the posting lists, of all pairs of a question and a set of its block."""
    index = b.reference_index(spark, sf)
    placed = b.asked(spark, sf).select(
        F.lit("").alias("block"), similarity.text.tokenize(F.col("overview")).alias("tokens")).withColumn(
        "set_key", similarity._set_key())
    _, questions = similarity._questions(placed, index)
    probed, rest = similarity.candidate_pairs(questions, index)
    reached = probed.count() + rest.count()
    assert probed.join(rest, ["ask", "set_id"]).count() == 0
    assert 0 < reached <= 0.25 * questions.count() * index.sets.count()


def test_ties_and_odd_texts_in_the_index(spark):
    schema = "movie_id int, title string, overview string, primary_genre string"
    refs = spark.createDataFrame([(9, "same words", "here", "a"), (4, "same words", "here", "a"), (3, None, None, "a"), (5, "", "the of", "a"),
                                  (2, "same words", "here", "b"), (8, "x", "y" * 5000, None), (None, "same words", "here", "c")], schema)
    asked = spark.createDataFrame([(1, "same", "words here", "A "), (1, "same", "words here", "zz"), (None, "words", None, None), (3, "of", "the", "b"),
                                   (6, "nothing known", "", "a"), (7, None, None, None)], schema)
    got = sorted(map(str, similarity.most_similar(asked, refs).collect()))
    row = lambda *v: str(Row(movie_id=v[0], match_id=v[1], score=v[2], kind=v[3]))
    assert got == sorted([row(1, 4, 1.0, "similar"), row(1, 2, 1.0, "similar"), row(None, 2, 1 / 3, "similar"),
                          row(3, 2, None, "genre_default"), row(6, 4, 0.0, "similar"), row(7, 2, None, "genre_default")])


def test_versions_switch_last(spark):
    store = Versions(spark, scratch_path(spark, "versions"))
    assert store.current() is None
    with pytest.raises(LookupError):
        store.read("t")
    store.publish({"t": spark.range(3), "u": spark.range(1)}, "a")
    held = store.read("t")
    # A writer that fails between its tables and the switch leaves the old version to read.
    store.stage({"t": spark.range(30)}, "b")
    assert store.current() == "a" and store.read("t").count() == 3
    with pytest.raises(ValueError):
        store.stage({"t": spark.range(9)}, "a")
    # The replay replaces what it had written; readers keep what they opened.
    store.publish({"t": store.read("t").union(spark.range(10, 12))}, "b")
    store.publish({"t": spark.range(99)}, "b")
    assert store.current() == "b" and store.read("t").count() == 5 and held.count() == 3
    assert store.read("u", "a").count() == 1


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("x").alias("extra"))
    out = numbering.numbered(df, ["v"], "n").collect()
    assert sorted((r.n, r.v) for r in out) == [(k, k) for k in range(1000)]
    assert numbering.numbered(df.limit(0), ["v"], "n").count() == 0


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "actual double, predicted double")
    m = stats.regression_metrics(df).first()
    assert (m.mae, m.mape) == pytest.approx((0.5, 25.0))
    assert m.rmse == pytest.approx(0.645497, abs=1e-6) and m.r2 == pytest.approx(0.732143, abs=1e-6)


def test_undefined_auc_is_zero(spark):
    df = spark.createDataFrame([("A", "A", 1.0, 0.0), ("A", "A", 0.5, 0.1)],
                               "label string, predicted string, score_A double, score_B double")
    assert stats.classification_metrics(df, ["A", "B"]).first().auc == 0.0


def test_constant_column_correlation_is_null(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("a"), F.lit(3.0).alias("b"))
    cells = {(r.a, r.b): r.correlation for r in stats.correlation_matrix(df, ["a", "b"]).collect()}
    assert cells[("a", "a")] == pytest.approx(1.0) and cells[("a", "b")] is None


def test_histogram_counts_every_row(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1, 2, 10, None or 10]], "x double")
    bins = stats.histogram(df, "x", 5).orderBy("bin").collect()
    assert [b["count"] for b in bins] == [3, 1, 0, 0, 2]


def test_json_map_and_whole_documents(spark, tmp_path):
    movies = [{"id": 1, "title": "A", "genres": [{"id": 1, "name": "Drama"}], "revenue": 5}, {"id": 2, "title": "B"}]
    (tmp_path / "movies.json").write_text(json.dumps(movies, indent=2))
    read = readers.read_movies(spark, str(tmp_path / "movies.json"), multiline=True)
    clean = {r.movie_id: r for r in features.clean_movies(read).collect()}
    assert clean[1].primary_genre == "Drama" and clean[2].primary_genre == "Unknown" and clean[2].budget == 0
    (tmp_path / "trends.json").write_text(json.dumps({"Alpha": {"t1": 1, "t2": "<1"}, "Beta": {"t1": 3.5}}, indent=2))
    points = readers.read_series_map(spark, str(tmp_path / "trends.json"), multiline=True)
    assert {(r.title, r.trend_momentum) for r in features.trend_momentum(points).collect()} == {("Alpha", 1.0), ("Beta", 3.5)}


def test_pipeline_with_absent_sources(spark, tmp_path):
    rows = [{"id": 1, "title": "Alpha", "budget": 10, "revenue": 40, "release_date": "2001-05-01", "overview": "x"},
            {"id": 2, "title": "Beta", "budget": 0, "revenue": 4}]
    (tmp_path / "movies.json").write_text("\n".join(json.dumps(r) for r in rows))
    (tmp_path / "series.json").write_text(json.dumps({"ALPHA": {"t": "2"}}))
    paths = {"movies": str(tmp_path / "movies.json"), "series": str(tmp_path / "series.json"),
             **{n: str(tmp_path / f"no-{n}") for n in ("credits", "trailers", "articles")}}
    words = spark.createDataFrame([("good", 1.0)], "token string, valence double")
    out = {r.movie_id: r for r in final_dataset.run_pipeline(spark, paths, words)["final_dataset"].collect()}
    assert out[1].success_class == "Hit" and out[1].trend_momentum == 2.0 and out[1].release_month == 5
    assert out[2].success_class == "Unknown" and out[2].num_cast_members == 0 and out[2].overview == ""


def test_append_of_nothing_adds_nothing(spark):
    root = scratch_path(spark, "raw")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    sinks.append_documents(df, root, "people")
    sinks.append_documents(df.filter("id > 1"), root, "people")
    assert spark.read.json(f"{root}/people").count() == 1


def test_model_beats_the_mean(spark):
    df = spark.range(400).select(
        F.col("id").alias("movie_id"), (F.col("id") * 1000).alias("budget"), (F.col("id") % 7).cast("double").alias("popularity"),
        F.lit("some film text").alias("overview"), F.when(F.col("id") % 2 == 0, "Drama").otherwise("Action").alias("primary_genre"),
        (F.col("id") * 3000 + 50).alias("revenue"))
    split = learning.with_split(df)
    name, model, table = learning.select_best_regressor(split, learning.regressors(trees=5, rounds=3))
    assert name == "linear" and len(table) == 3
    path = scratch_path(spark, "model")
    learning.save(model, path)
    assert learning.predict(learning.load(path), split).count() == 400
    forest = learning.fit(split, learning.regressors(trees=5)["random_forest"])
    top = learning.importance(forest, split).first()
    assert top.feature == "budget" and top.importance > 0.5


def test_model_sizes_are_the_references(spark):
    size = lambda m: (m.getMaxIter() if hasattr(m, "getMaxIter") else m.getNumTrees(), m.getMaxDepth())
    plain, large, kinds = learning.regressors(), learning.retraining_regressors(), learning.classifiers()
    assert [size(m[k]) for m in (plain, large) for k in ("random_forest", "boosted")] == [
        (100, 30), (100, 6), (300, 20), (300, 10)]
    assert size(kinds["random_forest"]) == (100, 30) and size(kinds["boosted"].getClassifier()) == (100, 6)
    assert kinds["logistic"].getMaxIter() == 1000
    defaults = inspect.signature(learning.fit_early_stopping).parameters
    assert [defaults[n].default for n in ("rounds", "patience", "depth", "step")] == [300, 10, 8, 0.05]


@pytest.mark.parametrize("errors, patience, expected", [
    ([], 3, (0, False)), ([5.0], 3, (1, False)), ([5, 4, 3, 3, 3], 3, (3, False)), ([5, 4, 3, 3, 3, 3], 3, (3, True)),
    # Worse for nine rounds, then better again, then worse for good; what comes after is not looked at.
    ([9, 8] + [10] * 9 + [7] + [11] * 10 + [1], 10, (12, True)),
    ([9, 8] + [10] * 10 + [7], 10, (2, True)),
])
def test_best_round(errors, patience, expected):
    assert learning.best_round(errors, patience) == expected


def _boosting_rows(spark):
    """A line with noise: boosting first learns it, then the noise of the train rows."""
    noise = F.pmod(F.xxhash64("movie_id"), F.lit(1000)) / 1000 - 0.5
    df = spark.range(1500).select(F.col("id").alias("movie_id"), (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(997)) / 10).alias("budget"))
    return learning.with_split(df.withColumn("revenue", F.col("budget") + noise * 60)).withColumn(
        "held", F.pmod(F.xxhash64("movie_id", F.lit(9)), F.lit(4)) == 0)


def test_early_stopping_keeps_the_best_round(spark):
    df = _boosting_rows(spark)
    stopped = learning.fit_early_stopping(df, "revenue", "held", rounds=60, patience=4, depth=6, step=0.3, least_rows=1)
    trees = stopped.model.stages[-1]
    assert 1 <= stopped.best < 60 and trees.getNumTrees == stopped.best and len(stopped.errors) == stopped.best + 4
    assert min(stopped.errors) == stopped.errors[stopped.best - 1]
    # The cut model predicts what a model trained for just so many rounds does, and it can be stored.
    prepared = learning.prepare(df)
    rows = prepared.ready.where("split = 'train' AND NOT held")
    direct = GBTRegressor(labelCol="revenue", maxIter=stopped.best, stepSize=0.3, maxDepth=6, subsamplingRate=0.8, seed=42).fit(rows)
    path = scratch_path(spark, "cut-model")
    learning.save(stopped.model, path)
    ours = {r.movie_id: r.predicted for r in learning.predict(learning.load(path), df).collect()}
    theirs = {r.movie_id: r.prediction for r in direct.transform(prepared.ready).collect()}
    assert ours.keys() == theirs.keys() and all(ours[k] == pytest.approx(theirs[k]) for k in ours)


def test_report_schema_matches(spark):
    assert schemas.REPORT["results"].dataType.elementType == schemas.REPORT_ROW


# --- repeated and NULL keys, damaged input, gaps ---

def _lexicon(spark):
    return spark.createDataFrame([("good", 1.9, 0.7, 0.6), ("bad", -2.5, -0.7, 0.7)],
                                 "token string, valence double, polarity double, subjectivity double")


def test_scoring_keeps_records_apart(spark):
    names = "movie_id bigint, title string, overview string, primary_genre string, budget double"
    rows = [(1, "A", "a good film", "Drama", 1e6), (1, "A", "a bad film", "Drama", 1e6), (None, "B", "a good film", "Drama", 1e6)]
    people = spark.createDataFrame([], "person_id bigint, name string, popularity double")
    roi = spark.createDataFrame([], "name string, roi double")
    predict = lambda df: df.withColumn("base_prediction", F.lit(5e6))
    tables = scoring.publish_tables(spark, scratch_path(spark, "tables"), "1", people, roi, _lexicon(spark))
    for records in (spark.createDataFrame(rows, names), spark.createDataFrame(rows, names).drop("movie_id")):
        out = scoring.score(records, predict, tables).collect()
        felt = sorted(r.debug_info.nlp_analysis.sentiment_score for r in out)
        assert felt == pytest.approx([-0.7, 0.7, 0.7])


def test_scoring_takes_the_nearest_titles_signals(spark):
    records = spark.createDataFrame([(1, "A", "silver river garden", "Drama"), (None, "B", "golden empire", "Drama")],
                                    "movie_id bigint, title string, overview string, primary_genre string")
    known = spark.createDataFrame([(7, "X", "silver river garden", "Drama", 9.0, 0.5, 0.5), (8, "Y", "golden empire", "Drama", 3.0, 0.2, 0.1)],
                                  "movie_id bigint, title string, overview string, primary_genre string, "
                                  "youtube_sentiment double, sentiment_volatility double, trend_momentum double")
    numbered = scoring.with_row_id(records)
    out = scoring.apply_social(numbered, similarity.build_index(known)).select("title", "youtube_sentiment").collect()
    assert {tuple(r) for r in out} == {("A", 9.0), ("B", 3.0)}


@pytest.mark.parametrize("text, sign", [("good", 1), ("isn't good", -1), ("I don't think good", -1), ("kind of good", 0.5), ("incredibly good", 1.5)])
def test_valence_rules(spark, text, sign):
    comments = spark.createDataFrame([(1, "good"), (1, text), (None, text)], "id int, text string")
    scores = lexicon.comment_scores(comments, _lexicon(spark), ["id"]).collect()
    plain, values = 0.4404, sorted(r.compound for r in scores)
    assert len(scores) == 3
    if sign == -1:
        assert values[0] == values[1] < 0
    elif sign == 0.5:
        assert 0 < values[0] == values[1] < plain - 0.01
    elif sign == 1.5:
        assert values[2] == values[1] > plain + 0.01


def test_damaged_input_is_not_lost_silently(spark, tmp_path):
    (tmp_path / "movies.json").write_text('{"id": 1, "title": "Zeta", "revenue": 5}\n{"id": 1, "title": "Alpha"}\n{"id": 2, "ti')
    clips = [{"movie_id": 1, "comments": ["good"], "trailer_stats": {"viewCount": "3"}}, {"movie_id": 1, "comments": ["bad"]}]
    (tmp_path / "trailers.json").write_text("\n".join(json.dumps(c) for c in clips))
    (tmp_path / "articles.json").write_text('{"1": {"budget": 1.0}}\n{"1": {"budget": 2.0}}\n{"x')
    credit = {"id": 1, "credits": {"cast": [{"name": "A", "popularity": 2.0}], "crew": []}}
    (tmp_path / "credits.json").write_text(json.dumps(credit) + "\n" + json.dumps(credit))
    paths = {n: str(tmp_path / f"{n}.json") for n in ("movies", "trailers", "articles", "credits", "series")}
    with pytest.raises(Exception):
        final_dataset.run_pipeline(spark, paths, _lexicon(spark))["final_dataset"].collect()
    rows = final_dataset.run_pipeline(spark, paths, _lexicon(spark), bad="skip")["final_dataset"].collect()
    assert len(rows) == 1
    row = rows[0]
    assert row.title == "Zeta" and row.trailer_views == 3 and row.num_cast_members == 1.0 and row.wikipedia_budget == 2.0
    assert row.youtube_sentiment == pytest.approx(0.4404, abs=1e-4)
    bad = final_dataset.rejected_lines(spark, paths).groupBy("source").count().collect()
    assert {tuple(r) for r in bad} == {("movies", 1), ("articles", 1)}
    (tmp_path / "movies.json").write_text(json.dumps([{"id": 1, "title": "A"}, {"id": 2, "title": "B"}], indent=1))
    (tmp_path / "articles.json").write_text(json.dumps({"1": {"budget": 1.0}}, indent=1))
    for n in ("trailers", "credits"):
        (tmp_path / f"{n}.json").unlink()
    whole = final_dataset.run_pipeline(spark, paths, _lexicon(spark), multiline=True)["final_dataset"].collect()
    assert {(r.movie_id, r.wikipedia_budget) for r in whole} == {(1, 1.0), (2, 0.0)}


def test_correlation_with_gaps(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 100.0)], "x double, revenue double")
    cells = {(r.a, r.b): r.correlation for r in stats.correlation_matrix(df, ["x", "revenue"]).collect()}
    assert len(cells) == 4 and cells[("x", "revenue")] == cells[("revenue", "x")] == pytest.approx(1.0)
    assert stats.correlation_ranking(df, "revenue", ["x"]).first().importance == pytest.approx(1.0)


def test_gaps_in_imputation_and_weights(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 0), (nan, 0), (None, 0), (3.0, 9)], "x double, revenue int")
    assert sorted(r.x for r in features.impute_median(df, ["x"]).collect()) == [1.0, 2.0, 2.0, 3.0]
    weights = [r.sample_weight for r in features.sample_weights(df).collect()]
    assert sorted(weights) == pytest.approx([0.0, 0.0, 0.0, 4.0])
    assert {r.sample_weight for r in features.sample_weights(df.limit(0).union(df.filter("revenue = 0"))).collect()} == {1.0}


def test_repeated_and_null_keys(spark):
    ids = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    cache = spark.createDataFrame([(2, "c")], "k int, v string")
    got = joins.refresh_cache(ids, cache, lambda m: m.withColumn("v", F.lit("f")), "k").collect()
    assert sorted(tuple(r) for r in got) == [(1, "f"), (2, "c")]
    fresh = spark.createDataFrame([(2, "x"), (2, "y"), (None, "z")], "k int, v string")
    assert [tuple(r) for r in joins.enrich_overwrite(cache, fresh, "k", ["v"]).collect()] == [(2, "y")]


def test_rules_with_nulls(spark):
    row = spark.range(1).select(
        rules.franchise_factor(text.is_franchise(F.lit(None).cast("string")), F.lit("Drama"), F.lit(5.0), F.lit(1.0)).alias("f"),
        rules.outcome_class(F.lit(5.0), F.lit(None).cast("double"), F.lit(0)).alias("c"),
        text.extract_names(F.lit("\tAnn Lee - lead")).alias("n")).first()
    assert (row.f, row.c, row.n) == (1.0, "Unknown", ["Ann Lee"])


# --- the run in steps, the persisted cache, correlations, labels, terms ---

def test_a_failing_step_ends_the_run(spark):
    root, ran = scratch_path(spark, "run"), []

    def step(name):
        def work():
            ran.append(name)
            if name == "four":
                raise ValueError("no such column\nand more")
            return {name: spark.range(len(ran))}
        return name, work

    ledger = steps.run(spark, root, [("one", None), *map(step, ["two", "three", "four", "five", "six", "seven"])])
    rows = [(r.step, r.status, [tuple(t) for t in r.tables], r.error) for r in ledger.orderBy("step").collect()]
    assert rows == [(1, "skipped", [], None), (2, "done", [("two", 1)], None), (3, "done", [("three", 2)], None),
                    (4, "failed", [], "ValueError: no such column"), (5, "not run", [], None), (6, "not run", [], None),
                    (7, "not run", [], None)]
    assert ran == ["two", "three", "four"]


def test_seven_steps_train_on_the_written_dataset(spark, sf):
    ledger = {r.name: r for r in catalog_sources.pipeline_run(spark, sf).collect()}
    assert [ledger[n].status for n in ("collection", "cleaning", "comment sentiment", "features", "integration", "training", "reports")] \
        == ["skipped"] + ["done"] * 6, [r.error for r in ledger.values()]
    assert {t.name for t in ledger["training"].tables} == {"regression_models", "classification_models"}
    assert all(t.rows > 0 for n in ("integration", "training", "reports") for t in ledger[n].tables)


def test_a_failed_refresh_leaves_the_old_cache(spark):
    store = Versions(spark, scratch_path(spark, "cache"))
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "movie_id int")
    empty = spark.createDataFrame([], "movie_id int, origin string")
    fetched = lambda origin: lambda missing: missing.withColumn("origin", F.lit(origin))
    seen = lambda df: sorted(map(tuple, df.collect()))
    assert seen(persisted.refresh(store, "c", ids, fetched("a"), "movie_id", "1", empty)) == [(1, "a"), (2, "a")]

    more = ids.union(spark.createDataFrame([(3,)], "movie_id int"))
    committed = store.commit
    store.commit = lambda version: (_ for _ in ()).throw(RuntimeError("lost between write and switch"))
    with pytest.raises(RuntimeError):
        persisted.refresh(store, "c", more, fetched("b"), "movie_id", "2", empty)
    store.commit = committed
    assert store.current() == "1" and seen(store.read("c")) == [(1, "a"), (2, "a")]
    for _ in range(2):  # the replay, and another one
        assert seen(persisted.refresh(store, "c", more, fetched("b"), "movie_id", "2", empty)) == [(1, "a"), (2, "a"), (3, "b")]


def test_correlations_over_gaps_and_far_from_zero(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(1e9, 1, (400, 4))
    x[:, 1] = x[:, 0] * 3 + rng.normal(0, 2, 400)
    x[:, 3] = 0.1
    hole = rng.random((400, 4)) < 0.3
    rows = [[None if h else float(v) for v, h in zip(*r)] for r in zip(x, hole)]
    df = spark.createDataFrame([*rows, [None, None, float("nan"), 1.0]], "a double, b double, c double, d double").repartition(5)
    got = {(r.a, r.b): r.correlation for r in stats.correlation_matrix(df.where("NOT coalesce(isnan(c), false)"), list("abcd")).collect()}
    assert len(got) == 16
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            both = ~hole[:, i] & ~hole[:, j]
            assert got[p, q] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-7)
        assert got[p, "d"] is None and got["d", p] is None
    with_nan = {(r.a, r.b): r.correlation for r in stats.correlation_matrix(df, list("acd")).collect()}
    assert np.isnan(with_nan["c", "d"]) and with_nan["a", "c"] == pytest.approx(got["a", "c"], abs=1e-7)
    assert all(r.correlation is None for r in stats.correlation_matrix(df.limit(0), ["a", "b"]).collect())


def test_labels_without_one_task_that_holds_them(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).cast("string").alias("s")).union(
        spark.createDataFrame([(None,), ("5",)], "s string"))
    out = stats.label_encode(df, "s")
    assert "collect_set" not in out._jdf.queryExecution().toString()
    labels = sorted({r.s for r in df.collect() if r.s is not None})
    place = {s: k for k, s in enumerate(labels)}
    assert all(r.s_index == (place[r.s] if r.s is not None else None) for r in out.collect())


def test_terms_are_counted_in_their_row(spark):
    texts = ["The cat sat, the cat ran", "a dog ran", "", None, "cat " * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    out = tfidf.tfidf_terms(df, "id", "t", 3)
    plan = tfidf.vocabulary(df, "t", 3)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan and "hashpartitioning(term" in plan
    idf = {"cat": np.log(6 / 3) + 1, "ran": np.log(6 / 3) + 1, "dog": np.log(6 / 2) + 1}
    norm = lambda w: {t: v / np.sqrt(sum(x * x for x in w.values())) for t, v in w.items()}
    expected = {0: norm({"cat": 2 * idf["cat"], "ran": idf["ran"]}), 1: norm({"dog": idf["dog"], "ran": idf["ran"]}), 4: {"cat": 1.0}}
    got = {}
    for r in out.collect():
        got.setdefault(r.id, {})[r.term] = r.tfidf
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k]) for k in got)


def test_model_terms_have_the_same_weights(spark):
    df = learning.with_split(spark.createDataFrame(
        [(k, "cat sat" if k % 3 else "dog ran ran", "Drama", float(k), float(k)) for k in range(60)],
        "movie_id long, overview string, primary_genre string, budget double, revenue double"))
    prepared = learning.prepare(df)
    train = df.where("split = 'train'")
    names = [r.term for r in tfidf.vocabulary(train, "overview").collect()]
    ours = {}
    for r in tfidf.tfidf_terms(train, "movie_id", "overview").collect():
        ours.setdefault(r.movie_id, {})[r.term] = r.tfidf
    for r in prepared.ready.where("split = 'train'").select("movie_id", "terms").collect():
        assert {names[i]: v for i, v in zip(r.terms.indices, r.terms.values)} == pytest.approx(ours[r.movie_id])
