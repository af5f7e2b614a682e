"""Quality classifier learnt from trusted positives and unlabelled text.

A linear scorer over statistics of the whole text minimises the non-negative
unbiased risk of positive-unlabelled learning: the positives' loss weighted by
the class prior, plus the unlabelled texts' negative loss less the positives'
share of it, kept from falling below zero.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, text_batches

#: Byte classes: lower, upper, digit, space, line feed, sentence marks, other marks, beyond ASCII.
_CLASS = np.array([7 if b >= 128 else 0 if chr(b).islower() else 1 if chr(b).isupper() else 2 if chr(b).isdigit()
                   else 3 if b == 32 else 4 if b == 10 else 5 if chr(b) in ".,;:!?" else 6 for b in range(256)])
N_FEATURES = 96 + 64 + 10


def features(text: str | None) -> np.ndarray:
    """Byte shares, byte-class transitions, word and line statistics of one text (null: empty)."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    n = max(1, len(raw))
    kinds = _CLASS[raw]
    words, lines = text.split(), text.split("\n")
    n_words = max(1, len(words))
    counts = Counter(words)
    again = sum(map(str.__eq__, words, words[1:]))
    return np.concatenate([
        np.bincount(raw, minlength=128)[32:128] / n,
        np.bincount(kinds[:-1] * 8 + kinds[1:], minlength=64) / n,
        [np.log1p(len(raw)), np.log1p(len(words)), sum(map(len, words)) / n_words, len(counts) / n_words,
         max(counts.values(), default=0) / n_words, again / n_words, len(set(lines)) / len(lines),
         np.log1p(len(raw) / len(lines)), np.log1p(len(lines)),
         len({w.lower().strip(".,") for w in counts}) / n_words]]).astype(np.float32)


def feature_matrix(texts) -> np.ndarray:
    rows = [features(t) for t in texts]
    return np.stack(rows) if rows else np.zeros((0, N_FEATURES), np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the intercept
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -500, 500)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float,
        l2: float = 1e-3, steps: int = 800, rate: float = 0.05) -> Model:
    """Minimise the non-negative risk with the logistic loss.

    Full-batch Adam with a falling rate. While the negative part of the risk is
    below zero only that part is stepped up again. The result is the mean of
    the last half's weights. Without positives or unlabelled rows the model
    scores every text by the prior.
    """
    width = positive.shape[1]
    base = Model(np.zeros(width), np.ones(width), np.zeros(width + 1), prior)
    base.weights[-1] = np.log(prior / (1 - prior))
    if not len(positive) or not len(unlabelled):
        return base
    base.mean, base.scale = unlabelled.mean(axis=0, dtype=float), unlabelled.std(axis=0, dtype=float) + 1e-6
    p, u = (np.c_[np.clip((x - base.mean) / base.scale, -6, 6), np.ones(len(x))] for x in (positive, unlabelled))
    w, m, v, mean, kept = base.weights.copy(), 0.0, 0.0, 0.0, 0
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for i in range(1, steps + 1):
        sp, su = p @ w, u @ w
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        g_neg = u.T @ sigmoid(su) / len(u) - prior * (p.T @ sigmoid(sp)) / len(p)
        g = g_neg - prior * (p.T @ sigmoid(-sp)) / len(p) if negative >= 0 else -g_neg
        g = g + l2 * np.r_[w[:-1], 0]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (1 - i / (steps + 1)) * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        if 2 * i > steps:
            mean, kept = mean + w, kept + 1
    base.weights = mean / kept
    return base


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learnt from; rows without an id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          max_positive: int = 8000, max_unlabelled: int = 12000) -> Model:
    """Fit on at most ``max_positive`` trusted and ``max_unlabelled`` unlabelled texts.

    Both samples are the rows with the smallest hash of their id, so they are the
    same at every run; their features (a few kB a row) are all the driver gets.
    Positives are ids labelled 1 outside the held-out fold; ids with
    contradicting labels are left out. An id with several texts is learnt by its least one. Labels of 0 serve for the class prior
    alone, estimated as the share of 1 among the learnt labels less one
    standard error (an estimate above the truth makes the risk go negative); it is
    a half without labels.
    """
    lab = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y"))
           .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("id")))
           .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2"))
    n, ones = lab.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("y") == 1).cast("int")), F.lit(0))).first()
    share = (ones + 1) / (n + 2)
    prior = min(0.99, max(0.01, share - (share * (1 - share) / (n + 2)) ** 0.5)) if n else 0.5
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where("id IS NOT NULL")
    take = lambda ids, k, seed: ids.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(k)
    pos = take(lab.where("y = 1").select("id"), max_positive, 1)
    unl = take(rows.select("id").distinct().join(lab, "id", "left_anti"), max_unlabelled, 2)
    chosen = pos.withColumn("y", F.lit(1)).union(unl.withColumn("y", F.lit(0)))
    # bounded by the two limits
    sample = rows.join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            x = feature_matrix(batch.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, N_FEATURES, dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), lists], ["id", "y", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    got = sample.select("id", "y", "text").mapInArrow(run, f"id {kind}, y int, x array<float>").toArrow().combine_chunks().sort_by("id")
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
    y = got["y"].to_numpy()
    model = fit(x[y == 1], x[y == 0], prior)
    del got, x, y
    give_back()
    return model


def score(text: Column, model: Model) -> Column:
    """Score of a text column, 0 to 1, higher for better text; null and empty texts are scored as empty."""
    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        out = [model.score(feature_matrix(texts.slice(i, 500).to_pylist())) for i in range(0, len(texts), 500)]
        give_back()
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return of(text.cast("string"))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Repeated rows are scored alike; a null id is held out; null and empty texts
    are scored as empty; empty tables give an empty result. Only the text enters
    the score.
    """
    model = train(docs, labels)
    s = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score reaches ``threshold``, all columns as they were."""
    model = train(docs, labels, text=text)
    return docs.where(score(F.col(f"`{text}`"), model) >= threshold)
