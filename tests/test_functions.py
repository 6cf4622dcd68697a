"""Hand-worked cases for column expressions."""

import pytest
from pyspark.sql import functions as F

from marquee.functions import fixed, rules, scalars, text


def one(spark, expression, **values):
    """The value of a column expression over one row of literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) if not hasattr(v, "alias") else v.alias(k)
                                  for k, v in values.items()] or ["id"])
    return row.select(expression.alias("out")).first()["out"]


def test_primary_genre(spark):
    schema = "g array<struct<id:bigint,name:string>>"
    df = spark.createDataFrame([([(1, "Action"), (2, "Drama")],), ([],), (None,)], schema)
    assert [r[0] for r in df.select(scalars.primary_genre(F.col("g"))).collect()] == ["Action", "Unknown", "Unknown"]


@pytest.mark.parametrize("views, likes, rate", [(100, 5, 0.05), (0, 5, 0.0), (None, None, 0.0)])
def test_interaction_rate(spark, views, likes, rate):
    df = spark.createDataFrame([(views, likes)], "v bigint, l bigint")
    assert df.select(scalars.interaction_rate(F.col("l"), F.col("v"))).first()[0] == rate


@pytest.mark.parametrize("date, month", [("2009-12-18", 12), (None, 0), ("", 0), ("bad", 0)])
def test_release_month(spark, date, month):
    df = spark.createDataFrame([(date,)], "d string")
    assert df.select(scalars.release_month(F.col("d"))).first()[0] == month


@pytest.mark.parametrize("revenue, budget, label", [
    (300, 100, "Hit"), (299, 100, "Average"), (100, 100, "Average"), (99, 100, "Flop"), (5, 0, "Unknown")])
def test_success_class(spark, revenue, budget, label):
    df = spark.createDataFrame([(revenue, budget)], "r bigint, b bigint")
    assert df.select(scalars.success_class(F.col("r"), F.col("b"))).first()[0] == label


def test_hype_score(spark):
    out = one(spark, scalars.hype_score(*[F.col(c) for c in "pvwl"]), p=50.0, v=5000, w=5_000_000, l=50_000)
    assert out == pytest.approx(120.0)


@pytest.mark.parametrize("raw, value", [("12", 12.0), ("12.5", 12.5), ("0", 0.0), ("-3", None), ("<1", None),
                                        ("1e5", None), (".", None), ("", None), (".5", 0.5), ("7.", 7.0)])
def test_numeric_text(spark, raw, value):
    assert one(spark, scalars.numeric_text(F.col("x")), x=raw) == value


@pytest.mark.parametrize("raw, value", [("550.0", "550"), ("550", "550"), ("synthetic_flop_3", None), ("-2.9", "-2")])
def test_normalise_id(spark, raw, value):
    assert one(spark, scalars.normalise_id(F.col("x")), x=raw) == value


@pytest.mark.parametrize("value, default, low, high, out", [
    (0.165, 5.0, 0.0, 15.0, 0.165), (0.0, 5.0, 0.0, 15.0, 5.0), (-2.0, 5.0, 0.0, 15.0, 5.0), (45.0, 0.0, -1.0, 1.0, 1.0),
    (float("inf"), 0.1, 0.0, 1.0, 0.1), (float("nan"), 0.1, 0.0, 1.0, 0.1)])
def test_social_clip(spark, value, default, low, high, out):
    assert one(spark, scalars.social_clip(F.col("x"), default, low, high), x=value) == out


def test_engineered(spark):
    assert one(spark, scalars.budget_tier(F.col("x")), x=100_000_000) == 4
    assert one(spark, scalars.vote_power(F.lit(7.5), F.lit(5000))) == 37_500
    assert one(spark, scalars.budget_popularity_ratio(F.lit(100_000_000), F.lit(50.0))) == 2_000_000


def test_tokens_and_jaccard(spark):
    assert sorted(one(spark, text.tokenize(F.col("x")), x="The Dark-Knight 2 in it")) == ["dark", "knight"]
    three = F.array(*[F.lit(w) for w in ("dark", "knight", "rises")])
    two = F.array(F.lit("dark"), F.lit("knight"))
    assert one(spark, text.jaccard(three, two)) == pytest.approx(2 / 3)
    assert one(spark, text.jaccard(two, three)) == pytest.approx(2 / 3)
    assert one(spark, text.jaccard(two, F.array(F.lit("batman")))) == 0


CREW = """Shadow Protocol is a film.

Cast

Leonardo DiCaprio – Lead operative

Emily Blunt – Intelligence analyst and strategic partner

- John Boyega – Field agent
Crew

Director: Christopher Nolan

Cast: Ann Lee, Bo Ray and Cy Fox
Production Company: Atlas Crown Studios"""


def test_names(spark):
    names = one(spark, text.extract_names(F.col("x")), x=CREW)
    assert names == ["Emily Blunt", "John Boyega", "Christopher Nolan", "Ann Lee", "Bo Ray", "Cy Fox"]
    assert "Leonardo DiCaprio" in one(spark, text.extract_names(F.col("x"), inner_caps=True), x=CREW)


@pytest.mark.parametrize("body, decimals, office, budget", [
    ("Box office: $1,234 million", True, "$1,234 million", None),
    ("Budget $5 million, later $7 million", True, None, "$5 million"),
    ("Box office $5\nthe box office was good", True, "$5", None),
    ("box office $2.798 billion", False, "$2", None),
    ("box office $2.798 billion", True, "$2.798 billion", None),
])
def test_extract_money(spark, body, decimals, office, budget):
    found = one(spark, text.extract_money(F.col("x"), decimals), x=body)
    assert (found["worldwide_box_office"], found["domestic_box_office"], found["budget"]) == (office, None, budget)


@pytest.mark.parametrize("raw, millions", [("$237 million", 237.0), ("$1 billion", 1000.0), ("$1,234,567", 1.234567),
                                           ("$2.798 billion", 2798.0), ("$2", 2e-6), ("", None)])
def test_parse_money(spark, raw, millions):
    out = one(spark, text.parse_money(F.col("x")), x=raw)
    assert out is None if millions is None else out == pytest.approx(millions)


@pytest.mark.parametrize("title, franchise, by_word", [
    ("Alien: Covenant", True, True), ("Toy Story", True, True), ("Rocky 2", True, True), ("Author Club", True, False),
    ("Test Movie", False, False)])
def test_franchise(spark, title, franchise, by_word):
    assert one(spark, text.is_franchise(F.col("x")), x=title) is franchise
    assert one(spark, text.is_franchise(F.col("x"), word_boundary=True), x=title) is by_word


def test_nonsense_and_cues(spark):
    cap = rules.nonsense_cap(F.lit(500.0), F.col("x"), F.lit(100.0))
    assert one(spark, cap, x="two words") == 40
    assert one(spark, cap, x="four quite ordinary words") == 500
    assert one(spark, cap, x="this is lorem ipsum text") == 40
    low = [one(spark, rules.low_cue_factor(F.lit(n))) for n in (1, 3, 7)]
    assert low == pytest.approx([1.0, 0.7, 0.35])
    assert [one(spark, rules.high_cue_factor(F.lit(n))) for n in (2, 7)] == pytest.approx([1.08, 1.25])
    assert one(spark, text.cue_hits(F.col("x"), fixed.LOW_QUALITY_CUES), x="thin character arc") == 2


def test_tentpole(spark):
    overview = "theatrical event, global appeal, franchise potential"
    out = one(spark, rules.tentpole_factor(F.lit(2e8), F.lit("Action"), F.col("x"), F.lit(12.0), F.lit(0.0)), x=overview)
    assert out == pytest.approx(1.40)


@pytest.mark.parametrize("avg_pop, max_pop, pops, avg_roi, rois, factor", [
    (37.5, 45.0, 2, 7.0, 1, 1.18), (5.5, 6.0, 2, 0.0, 0, 0.90)])
def test_reputation(spark, avg_pop, max_pop, pops, avg_roi, rois, factor):
    out = one(spark, rules.reputation_factor(*[F.lit(v) for v in (avg_pop, max_pop, pops, avg_roi, rois)]))
    assert out == pytest.approx(factor)


@pytest.mark.parametrize("budget, prediction, low, label", [
    (100e6, 500e6, 0, "Very Hit"), (100e6, 300e6, 0, "Hit"), (200e6, 440e6, 0, "Hit"), (350e6, 700e6, 0, "Hit"),
    (100e6, 150e6, 0, "Average"), (100e6, 50e6, 0, "Flop"), (100e6, 300e6, 3, "Average"), (100e6, 150e6, 5, "Flop"),
    (0.0, 9.0, 0, "Unknown")])
def test_outcome(spark, budget, prediction, low, label):
    assert one(spark, rules.outcome_class(F.lit(prediction), F.lit(budget), F.lit(low))) == label
