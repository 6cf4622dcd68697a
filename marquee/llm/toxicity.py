"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

A sentence has probability ``s = sigmoid(bias + sum of its features' weights)``;
the document has the noisy-or ``1 - prod(1 - s)``.  Only documents carry labels;
maximising their likelihood sends the blame to the sentences that explain it,
so the model also says where a document offends.

Features of a word: the word, and its first 4 and 5 letters (word families).
Nothing but the text enters a score.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.registry import documents, query
from marquee.llm.words import map_texts

# Bounds of what the fit may hold on the driver, whatever the input's size.
MAX_SAMPLE = 12_000      # labelled documents the model is fitted on
MAX_FEATURES = 3_000     # features kept by association with the label
MIN_TOXIC = 3            # toxic documents a feature must occur in
ROUNDS = 400
RIDGE = 0.01

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]+")

COLUMNS = "score double, n_sentences long, sentences array<struct<start:long,end:long,score:double>>"


def features(word: str) -> list[str]:
    return [word] + [f"{word[:k]}-" for k in (4, 5) if len(word) > k]


class Model(NamedTuple):
    bias: float
    weights: dict[str, float]


class _Weights(dict):
    """Weight of a word, remembered."""

    def __init__(self, weights: dict[str, float], limit: int = 300_000):
        super().__init__()
        self.weights, self.limit = weights, limit

    def __missing__(self, word: str) -> float:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return value


def score_text(text: str | None, model: Model, memory: _Weights | None = None) -> tuple[float, int, list]:
    """(score, number of sentences, offending sentences as (start, end, probability) in characters)."""
    import math

    memory = memory if memory is not None else _Weights(model.weights)
    log_clean, offending, n = 0.0, [], 0
    quiet = math.log1p(math.exp(model.bias))  # -log(1 - sigmoid(bias))
    # Lower-cased one by one: that may change a sentence's length.
    for found in SENTENCE.finditer(text or ""):
        n += 1
        weight = sum(map(memory.__getitem__, WORD.findall(found.group().lower())))
        if weight == 0.0:
            log_clean -= quiet
            continue
        z = max(-30.0, min(30.0, model.bias + weight))
        log_clean -= math.log1p(math.exp(z))
        p = 1 / (1 + math.exp(-z))
        if p >= 0.5:
            offending.append((found.start(), found.end(), p))
    return -math.expm1(log_clean), n, offending


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_SAMPLE) -> DataFrame:
    """doc_id, toxic for at most ``limit`` documents to learn from.

    Left out: ids with crc32(id as text) mod 5 = 0 (held out), NULL ids and
    NULL labels.  Ids with several labels count as toxic if any says so.  The
    sample is the lowest hashes of the ids, so it is the same on every run.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND crc32(cast(doc_id AS string)) % 5 != 0")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(known, "doc_id", "left_semi")
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _bags(docs: DataFrame, toxic_of: dict[int, int]) -> DataFrame:
    """Per task, how many toxic and clean sample documents each feature occurs in."""
    def count(batches):
        from collections import Counter

        import pandas as pd

        seen = (Counter(), Counter())
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                bag = {f for part in SENTENCE.findall(text or "") for w in WORD.findall(part.lower()) for f in features(w)}
                seen[toxic_of[int(doc_id)]].update(bag)
        names = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(names), 50_000):
            part = names[i:i + 50_000]
            yield pd.DataFrame({"feature": part, "clean": [seen[0][f] for f in part],
                                "toxic": [seen[1][f] for f in part]})

    return docs.mapInPandas(count, "feature string, clean long, toxic long")


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_SAMPLE) -> Model:
    """Noisy-or model of the labelled documents; without any toxic or any clean one it scores 0 everywhere.

    On the driver: the ids of the sample, the chosen features and, of each
    sample document, the feature numbers of its sentences, all bounded by the
    constants above.
    """
    import numpy as np

    toxic_of = {r.doc_id: r.toxic for r in labelled_sample(docs, labels, limit).toLocalIterator()}
    positives = sum(toxic_of.values())
    if not 0 < positives < len(toxic_of):
        return Model(-30.0, {})
    spark = docs.sparkSession
    # Bounded by ``limit`` ids of 8 bytes.
    ids = F.broadcast(spark.createDataFrame([(i,) for i in toxic_of], "doc_id long"))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    negatives = len(toxic_of) - positives
    counts = _bags(sample, toxic_of).groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (positives + 1.0)) - F.log((F.col("clean") + 0.5) / (negatives + 1.0))
    chosen = (counts.where(F.col("toxic") >= MIN_TOXIC).withColumn("odds", odds).where("odds > 1.5")
              .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "feature").limit(MAX_FEATURES))
    names = [r.feature for r in chosen.select("feature").collect()]
    number = {f: k for k, f in enumerate(names)}

    def bags(batches):
        import pandas as pd

        for batch in batches:
            out = []
            for text in batch["text"]:
                sentences, quiet = [], 0
                for part in SENTENCE.findall(text or ""):
                    hits = {number[f] for w in WORD.findall(part.lower()) for f in features(w) if f in number}
                    if hits:
                        sentences.append(sorted(hits))
                    else:
                        quiet += 1
                out.append((sentences, quiet))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "sentences": [o[0] for o in out], "quiet": [o[1] for o in out]})

    rows = sample.mapInPandas(bags, "doc_id long, sentences array<array<int>>, quiet long").toLocalIterator()
    target, quiet, doc, at, feature, n = [], [], [], [], [], 0
    for k, row in enumerate(sorted(rows, key=lambda r: (r.doc_id, r.quiet, r.sentences))):
        target.append(toxic_of[row.doc_id])
        quiet.append(row.quiet)
        for sentence in row.sentences:
            doc.append(k)
            at += [n] * len(sentence)
            feature += sentence
            n += 1
    return _ascend(np.array(target, float), np.array(quiet, float), np.array(doc, int), np.array(at, int),
                   np.array(feature, int), names)


def _ascend(target, quiet, doc, at, feature, names) -> Model:
    """Adam on the penalised log-likelihood of the documents' labels."""
    import numpy as np

    n_docs, n_sentences, n_features = len(target), len(doc), len(names)
    theta = np.zeros(n_features + 1)
    theta[-1] = -6.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        z = theta[-1] + np.bincount(at, theta[:-1][feature], n_sentences)
        s, s0 = 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 / (1 + np.exp(-theta[-1]))
        clean = np.bincount(doc, -np.logaddexp(0, z), n_docs) - quiet * np.logaddexp(0, theta[-1])
        p = np.clip(-np.expm1(clean), 1e-12, 1 - 1e-12)
        # d logL / d z of a sentence: s * (y / p - 1), as d(log clean) / dz = -s.
        pull = target * (1 - p) / p - (1 - target)
        dz = s * pull[doc]
        slope = np.append(np.bincount(feature, dz[at], n_features), dz.sum() + (s0 * quiet * pull).sum())
        slope[:-1] -= RIDGE * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        theta += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(float(theta[-1]), {f: float(w) for f, w in zip(names, theta) if abs(w) > 1e-6})


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_sentences and offending ``sentences`` (character spans), one row per input row.

    A NULL or empty text has no sentence and scores 0.  NULL and repeated ids
    keep their rows.  Row-local, no shuffle; the model is bounded.
    """
    def make():
        memory = _Weights(model.weights)
        return lambda text: score_text(text, model, memory)

    return map_texts(docs, make, COLUMNS)


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, with all their columns as they are."""
    def keep(batches):
        import pyarrow as pa

        memory = _Weights(model.weights)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield batch.filter(pa.array([score_text(t, model, memory)[0] < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


@query("op5_noisy_or_toxicity")
def op5(spark, sf):
    """Toxicity of every whole document; learned from labels outside the held-out fifth."""
    docs = documents(spark, sf)
    model = fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return score_documents(docs, model).select(
        "doc_id", (F.crc32(key.cast("binary")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences",
        F.size("sentences").cast("long").alias("n_offending"))
