"""Quality classifier: ordinal cumulative-link regression over hashed text.

Grades are ordered, 0 the worst. One weight per hash bucket is shared by all grades;
a text's score s is the mean weight of its words and word shapes, and ordered
thresholds t_k give P(grade > k) = logistic(s - t_k). The sum of these tails is the
expected grade; one tail selects. The model is fitted on a bounded sample of graded
rows whose features, not texts, meet in one task.

Nulls count as empty texts; an empty text has score 0. Without grades, or with one
grade only, every text is kept. A document with several grades has the lowest; a null
grade is none. Repeated rows are rated each. An empty table gives no rows;
other columns are kept or not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import fresh, labelled_sample, whole
from plainloom.session import stage

#: Hash buckets; also the most features that one row of the sample can have.
BUCKETS = 1 << 13
#: Graded rows that are fitted on, at most.
SAMPLE_ROWS = 6_000
#: A text is kept if P(grade > REJECTED) is at least KEEP_TAIL.
REJECTED, KEEP_TAIL = 0, 0.5
_KEPT_WORDS = 300_000
_SHAPES = ((re.compile("[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"), (re.compile(r"\d+"), "0"))


def buckets_of(word: str) -> tuple[int, int]:
    """Buckets of a word: its letters in lower case, and its shape."""
    shape = word
    for pattern, sign in _SHAPES:
        shape = pattern.sub(sign, shape)
    return zlib.crc32(word.lower().encode()) % BUCKETS, zlib.crc32(b"shape " + shape[:12].encode()) % BUCKETS


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    @property
    def grades(self) -> int:
        return len(self.thresholds) + 1


class _Weights(dict):
    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        a, b = buckets_of(word)
        value = float(self.weights[a] + self.weights[b])
        if len(self) < _KEPT_WORDS and len(word) <= 64:
            self[word] = value
        return value


def rater(model: Model):
    """A Pandas function from texts to scores."""
    weights = model.weights

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Weights(weights)
        for texts in batches:
            scores = []
            for text in texts:
                words = text.split()
                scores.append(sum([known[w] for w in words]) / (2 * len(words)) if words else 0.0)
            yield pd.Series(scores, dtype=float)

    return rate


def tails(score: Column, model: Model) -> list[Column]:
    """P(grade > k) for k from 0."""
    return [F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(float(t)) - score)) for t in model.thresholds]


#: Weight of the ridge penalty, half of which times the squared weights is added to the loss.
RIDGE = 1e-6


class Likelihood:
    """Mean negative log likelihood of graded sparse rows, with the ridge penalty.

    Parameters are the weights, the first threshold, and the logarithms of the steps to the next ones.
    """

    def __init__(self, rows: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray):
        self.grades, self.levels = grades, int(grades.max()) + 1
        self.idx, self.val = np.concatenate(rows), np.concatenate(values)
        self.sizes = np.array([len(r) for r in rows])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def at(self, param: np.ndarray) -> tuple[float, np.ndarray]:
        """The loss and its gradient."""
        idx, val, sizes, grades, levels = self.idx, self.val, self.sizes, self.grades, self.levels
        w, steps = param[:BUCKETS], np.exp(param[BUCKETS + 1 :])
        cuts = param[BUCKETS] + np.concatenate([[0.0], np.cumsum(steps)])
        s = np.where(sizes > 0, np.add.reduceat(np.append(w[idx] * val, 0.0), np.minimum(self.starts, len(idx))), 0.0)
        upper = np.where(grades < levels - 1, 1 / (1 + np.exp(s - cuts[np.minimum(grades, levels - 2)])), 1.0)
        lower = np.where(grades > 0, 1 / (1 + np.exp(s - cuts[np.maximum(grades - 1, 0)])), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / p, lower * (1 - lower) / p
        d_score = (up - low) / len(grades)
        d_cut = np.zeros(levels - 1)
        np.add.at(d_cut, np.minimum(grades, levels - 2), np.where(grades < levels - 1, -up, 0.0) / len(grades))
        np.add.at(d_cut, np.maximum(grades - 1, 0), np.where(grades > 0, low, 0.0) / len(grades))
        after = np.cumsum(d_cut[::-1])[::-1]
        by_weight = np.bincount(idx, weights=val * np.repeat(d_score, sizes), minlength=BUCKETS) + RIDGE * w
        return float(-np.log(p).mean() + RIDGE / 2 * (w**2).sum()), np.concatenate([by_weight, after[:1], after[1:] * steps])


def fit_thresholds(rows: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray, rounds: int = 200) -> Model:
    """Maximum likelihood with a small ridge penalty, by adaptive gradient steps on sparse rows."""
    likelihood = Likelihood(rows, values, grades)
    levels = likelihood.levels
    share = np.array([(grades > k).mean() for k in range(levels - 1)])
    first = -np.log(share / (1 - share))
    first = np.maximum.accumulate(first + np.arange(levels - 1) * 1e-3)
    steps = np.log(np.maximum(np.diff(first), 1e-3))
    param = np.concatenate([np.zeros(BUCKETS), first[:1], steps])
    m, v = np.zeros_like(param), np.zeros_like(param)
    for t in range(1, rounds + 1):
        _, grad = likelihood.at(param)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        param = param - 0.3 * min(1.0, 200 / t) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    steps = np.exp(param[BUCKETS + 1 :])
    return Model(param[:BUCKETS], param[BUCKETS] + np.concatenate([[0.0], np.cumsum(steps)]))


def fit(docs: DataFrame, graded: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on (doc_id, grade) with grades 0, 1, ...; None if there are fewer than two grades."""
    known = graded.where("grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    sample = labelled_sample(docs.select("doc_id", "text"), known, "doc_id", rows)
    sample = sample.select("doc_id", "grade", whole("text").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, shares = [], []
            for text in batch.column("text").to_pylist():
                words = text.split()
                counts = Counter(b for w in words for b in buckets_of(w))
                found.append(np.array(list(counts), dtype=np.int32))
                shares.append(np.array(list(counts.values()), dtype=np.float32) / max(2 * len(words), 1))
            arrays = [batch.column("doc_id"), batch.column("grade"), pa.array(found, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "grade", "buckets", "shares"])

    key = sample.schema["doc_id"].dataType.simpleString()
    features = stage(sample.mapInArrow(counted, f"doc_id {key}, grade int, buckets array<int>, shares array<float>"))
    found = sorted(r["grade"] for r in features.select("grade").distinct().collect())
    if len(found) < 2:
        return None
    place = {g: k for k, g in enumerate(found)}

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = pd.concat(list(batches)).sort_values("doc_id", kind="stable")
        model = fit_thresholds(
            [np.asarray(b, dtype=np.int64) for b in table["buckets"]],
            [np.asarray(s, dtype=float) for s in table["shares"]],
            table["grade"].map(place).to_numpy(),
        )
        yield pd.DataFrame({"weights": [model.weights], "thresholds": [model.thresholds]})

    row = features.coalesce(1).mapInPandas(fitted, "weights array<double>, thresholds array<double>").first()
    return Model(np.array(row["weights"]), np.array(row["thresholds"]))


def rate(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, expected_grade, tail and kept of every row."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("expected_grade"), F.lit(1.0).alias("tail"), F.lit(True).alias("kept"))
    scored = docs.select("doc_id", rater(model)(whole("text")).alias("score"))
    chances = tails(F.col("score"), model)
    expected = chances[0]
    for chance in chances[1:]:
        expected = expected + chance
    tail = chances[REJECTED]
    return scored.select("doc_id", expected.alias("expected_grade"), tail.alias("tail"), (tail >= KEEP_TAIL).alias("kept"))


def select(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with their columns."""
    if model is None:
        return docs
    (score,) = fresh(docs, "quality_score")
    rated = docs.withColumn(score, rater(model)(whole("text")))
    return rated.where(tails(F.col(score), model)[REJECTED] >= KEEP_TAIL).drop(score)


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 poor, 1 good but toxic, 2 good and not toxic."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))
