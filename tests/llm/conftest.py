import random

import pytest

WORDS = ("river stone garden signal harbor mirror empire winter golden silent broken hidden crimson electric lost "
         "frontier shadow voyage author circus").split()


def prose(seed, n):
    """``n`` words that hardly repeat from one seed to another."""
    rng = random.Random(str(seed))
    out = []
    for k in range(n):
        out.append(rng.choice(WORDS) + rng.choice(WORDS)[:3] + "." * (k % 12 == 11))
    return " ".join(out)


def table(spark, rows, extra=False):
    """documents of (doc_id, text); with ``extra``, columns whose names the operators use themselves."""
    out = spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        for name in ("node", "digest", "rank", "row", "spans", "score", "shard", "slot", "block", "part", "ids"):
            out = out.selectExpr("*", f"'mine' AS {name}")
    return out


ODD = [(1, None), (2, ""), (None, "no id here at all"), (None, None), (3, "twice the same row"), (3, "twice the same row"),
       (4, "one id two texts"), (4, "two texts one id"), (5, " \n\t "), (6, "!!! ... ---"), (7, "x" * 50_000),
       (8, "word " * 30_000), (9, "ß Ünï çödé 日本語 🙂 \x00 end")]


@pytest.fixture(scope="session")
def odd(spark):
    return table(spark, ODD, extra=True).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
