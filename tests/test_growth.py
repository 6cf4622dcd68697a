"""What grows with the rows: nothing of that size goes through the driver or one task."""

import re

from pyspark.sql import functions as F

from marquee import bindings
from marquee.catalog import load_all
from marquee.operators import joins, lexicon
from marquee.plans import learning

WORDS = [("good", 1.9, 0.7, 0.6), ("bad", -2.5, -0.7, 0.7)]
LEXICON = "token string, valence double, polarity double, subjectivity double"


def _final_plan(df):
    """The plan as it ended, and the rows."""
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0], rows


def _texts(spark):
    return spark.range(200).select(F.col("id").alias("movie_id"), F.when(F.col("id") % 3 == 0, "A good film").when(
        F.col("id") % 3 == 1, "bad, bad and good").otherwise("").alias("overview"))


def test_overview_stats_merges_the_sums_of_the_texts(spark):
    plan, rows = _final_plan(lexicon.overview_stats(_texts(spark), spark.createDataFrame(WORDS, LEXICON), "movie_id"))
    assert "SortMergeJoin [movie_id" in plan and "BroadcastHashJoin [movie_id" not in plan
    got = {r.movie_id: r.sentiment_score for r in rows}
    assert len(rows) == 200 and got[0] == 0.7 and round(got[1], 9) == round((0.7 - 1.4) / 3, 9) and got[2] is None


def test_nlp_adjust_merges_the_scores_of_the_records(spark, sf):
    plan, rows = _final_plan(load_all()[0]["nlp_adjust"](spark, sf))
    assert "BroadcastHashJoin [movie_id" not in plan
    assert len(rows) == bindings.table(spark, sf, "orders").count()


def test_words_of_a_comment_are_summed_in_its_task(spark):
    comments = _texts(spark).select(F.col("movie_id").alias("id"), F.col("overview").alias("text"))
    plan, rows = _final_plan(lexicon.comment_scores(comments, spark.createDataFrame(WORDS, LEXICON), ["id"]))
    # The list goes to the words, and a text's words are summed before any shuffle.
    assert re.search(r"BroadcastHashJoin \[token[^\]]*\], \[token[^\]]*\], Inner, BuildRight", plan)
    assert "hashpartitioning(token" not in plan
    got = {r.id: r.compound for r in rows}
    assert len(got) == 200 and got[0] > 0 > got[1] and got[2] == 0


def test_a_long_word_list_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(joins, "FEW_WORDS", 1)
    words = spark.createDataFrame([(1, "good"), (2, "bad"), (2, "bad"), (3, "other")], "id long, token string")
    plan, rows = _final_plan(joins.word_join(words, spark.createDataFrame(WORDS, LEXICON), "token", "list"))
    assert "SortMergeJoin [token" in plan
    assert sorted((r.id, r.valence) for r in rows) == [(1, 1.9), (2, -2.5), (2, -2.5)]


def test_prepared_rows_hold_features_only(spark, sf):
    df = learning.with_split(bindings.facts(spark, sf))
    ready = learning.prepare(df).ready
    assert sorted(ready.columns) == sorted([*df.columns, "features"])
    assert ready.where("features IS NULL").isEmpty()


def test_prepared_rows_are_predicted_without_their_text_again(spark, sf):
    df = learning.with_split(bindings.facts(spark, sf))
    prepared = learning.prepare(df)
    model = learning.fit_on(prepared, learning.regressors()["linear"])
    ready = learning.predict(model, prepared)
    # The features are read as they were written.
    assert "words_all" not in ready.columns and sorted(ready.columns) == sorted([*df.columns, "features", "predicted"])
    raw = {(r.movie_id, r.split, r.predicted) for r in learning.predict(model, df).select(
        "movie_id", "split", "predicted").collect()}
    assert {(r.movie_id, r.split, r.predicted) for r in ready.select("movie_id", "split", "predicted").collect()} == raw
