"""Toxicity: gradient-boosted trees over dense features of a text, then isotonic calibration.

Features: densities of a stated and of a learned lexicon, hits near a second person,
second persons, capitals, punctuation and obfuscated hits. The learned lexicon holds
words that stand mostly in toxic texts of the fitting rows. Trees and calibration are
fitted on different rows of a bounded sample of labelled rows; rows of the held-out
fold are never read for either.

Nulls count as empty texts; an empty text has all features 0 and the score that the
model gives to those. Without labels of both kinds every score is the share of toxic
labels (0 without any). A document with several labels is toxic if one says so; a
null label is none. A null doc_id is held out. Repeated rows are scored each. An empty table gives no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import each_text, labelled_sample, whole, with_columns
from plainloom.session import stage

#: Labelled rows that are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Words of the learned lexicon, at most.
LEXICON_WORDS = 200
#: A second person within so many words of a hit is near it.
NEAR_WORDS = 4
# Insults.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers clown clowns worthless pathetic fool fools jerk trash garbage "
    "scum filth filthy disgusting ugly imbecile dimwit coward liar hate hateful despicable vile creep freak pig pigs "
    "crap damn bastard bastards bitch asshole shit fuck fucking kill die "
    "idioten dumm dummkopf arschloch verlierer imbécile crétin abruti connard salaud estúpido imbécil tonto basura"
).split()
# Second persons in four languages.
SECOND_PERSONS = (
    "you your yours yourself yourselves u ur du dich dir dein deine euch euer tu te toi ton ta tes vous votre vos "
    "tú ti usted ustedes vosotros vuestro"
).split()
# Signs that stand for letters.
_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
_INNER = re.compile(r"[.\-_*'’]")
_REPEATED = re.compile(r"(.)\1+")
_EDGES = ".,;:!?\"'()[]{}<>|…“”«»*-_/\\"

FEATURES = (
    "stated_density", "learned_density", "stated_hits", "learned_hits", "near_second_person", "second_person_density",
    "capital_share", "shouted_density", "exclamation_density", "question_density", "other_mark_density",
    "obfuscated_density", "obfuscated_hits",
)
STATED, LEARNED, HIDDEN, SECOND = 1, 2, 4, 8
_MARKS = ",.;:-\"'()#*$%&|<>"


class Words(dict):
    """What a word is, as a sum of STATED, LEARNED, HIDDEN and SECOND; a bounded number is held."""

    def __init__(self, learned: list[str], most: int = 300_000):
        super().__init__()
        self.most = most
        self.stated, self.learned, self.second = set(INSULTS), set(learned), set(SECOND_PERSONS)
        self.squeezed = {_REPEATED.sub(r"\1", w) for w in self.stated | self.learned}

    def __missing__(self, word: str) -> int:
        bare = word.strip(_EDGES)
        kind = STATED * (bare in self.stated) + LEARNED * (bare in self.learned) + SECOND * (bare in self.second)
        if not kind and len(bare) >= 4:
            shown = _REPEATED.sub(r"\1", _INNER.sub("", word.translate(_SIGNS).strip(_EDGES)))
            squeezed = _REPEATED.sub(r"\1", bare)
            changed = shown != squeezed or squeezed != bare
            if changed and (shown in self.squeezed or squeezed in self.squeezed):
                kind = HIDDEN
            elif "*" in bare and any(_starred(bare, w) for w in self.stated):
                kind = HIDDEN
        if len(self) < self.most:
            self[word] = kind
        return kind


def _starred(bare: str, word: str) -> bool:
    return len(bare) == len(word) and bare.count("*") * 2 <= len(word) and all(a in ("*", b) for a, b in zip(bare, word))


def features_of(text: str, words: Words) -> tuple[float, ...]:
    parts = text.lower().split()
    if not parts:
        return (0.0,) * len(FEATURES)
    n = len(parts)
    kinds = np.fromiter((words[w] for w in parts), dtype=np.int8, count=n)
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    capitals = (raw >= 65) & (raw <= 90)
    letters = np.count_nonzero(capitals | ((raw >= 97) & (raw <= 122)))
    shouted = np.count_nonzero(capitals[1:] & capitals[:-1])
    stated, learned, hidden, second = (int(np.count_nonzero(kinds & bit)) for bit in (STATED, LEARNED, HIDDEN, SECOND))
    near = 0
    if second and stated + learned + hidden:
        persons = np.flatnonzero(kinds & SECOND)
        hits = np.flatnonzero(kinds & (STATED | LEARNED | HIDDEN))
        after = np.searchsorted(persons, hits)
        gap = np.minimum(
            np.abs(hits - persons[np.minimum(after, len(persons) - 1)]), np.abs(hits - persons[np.maximum(after - 1, 0)])
        )
        near = int(np.count_nonzero(gap <= NEAR_WORDS))
    marks, questions = text.count("!"), text.count("?")
    others = sum(map(text.count, _MARKS))
    return (
        stated / n, learned / n, np.log1p(stated), np.log1p(learned), near / n, second / n,
        np.count_nonzero(capitals) / max(letters, 1), shouted / n, marks / n, questions / n, others / n,
        hidden / n, np.log1p(hidden),
    )


def with_features(docs: DataFrame, keep: list[str], learned: list[str], text: str = "text") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(learned)
        for batch, texts in each_text(batches, "whole_text"):
            found = np.array([features_of(t, words) for t in texts], dtype=float).reshape(-1, len(FEATURES))
            yield with_columns(batch, "whole_text", FEATURES, [pa.array(c) for c in found.T])

    chosen = docs.select(*keep, whole(text).alias("whole_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "whole_text")
    return chosen.mapInArrow(run, f"{kept}, " + ", ".join(f"{c} double" for c in FEATURES))


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 5; fold 0 is held out."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5


def held_out(key: str = "doc_id") -> Column:
    return F.col(key).isNull() | (fold(key) == 0)


def learn_lexicon(sample: DataFrame, most: int = LEXICON_WORDS, least: int = 5, ratio: float = 6.0) -> list[str]:
    """Words that far more toxic than other texts of the sample hold."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{3,})"), F.lit(1)))
    totals = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    counts = sample.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("p"), F.count_if(F.col("toxic") == 0).alias("n")
    )
    odds = ((F.col("p") + 0.5) / (totals[0] + 1)) / ((F.col("n") + 0.5) / (totals[1] + 1))
    enough = F.col("p") >= F.greatest(F.lit(least), F.lit(totals[0] // 200))
    best = counts.where(enough & (odds >= ratio)).orderBy((odds * F.sqrt("p")).desc(), "word").limit(most)
    return [r["word"] for r in best.select("word").collect()]


class Model:
    def __init__(self, prior: float, lexicon: list[str], trees: PipelineModel | None = None, calibrated=None):
        self.prior, self.lexicon, self.trees, self.calibrated = prior, lexicon, trees, calibrated

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id, score of every row."""
        if self.trees is None:
            return docs.select("doc_id", F.lit(self.prior).alias("score"))
        found = with_features(docs, ["doc_id"], self.lexicon)
        return self._rated(found).select("doc_id", "score")

    def _rated(self, found: DataFrame) -> DataFrame:
        rated = _margins(self.trees, found)
        if self.calibrated is None:
            return rated.withColumn("score", F.col("margin"))
        out = self.calibrated.transform(rated).withColumnRenamed("prediction", "score")
        return out.withColumn("score", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)))


def _margins(trees: PipelineModel, found: DataFrame) -> DataFrame:
    return trees.transform(found).withColumn("margin", vector_to_array("probability")[1]).drop("prediction")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled rows outside the held-out fold: folds 1 to 3 grow trees, fold 4 calibrates."""
    known = labels.where(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = labelled_sample(docs.select("doc_id", "text"), known, "doc_id", rows)
    sample = sample.select("doc_id", "toxic", whole("text").alias("text"))
    growing = sample.where(fold() < 4)
    lexicon = learn_lexicon(growing)
    features = with_features(sample, ["doc_id", "toxic"], lexicon).withColumn("fold", fold())
    # A few MB whatever the corpus; one ordered part, so that refits give the same trees.
    features = stage(features.coalesce(8)).orderBy("doc_id", *FEATURES).coalesce(1)
    by_kind = {(r["toxic"], r["grows"]): r["count"] for r in features.groupBy("toxic", (F.col("fold") < 4).alias("grows")).count().collect()}
    seen = sum(by_kind.values())
    prior = sum(n for (toxic, _), n in by_kind.items() if toxic == 1) / seen if seen else 0.0
    if not by_kind.get((0, True)) or not by_kind.get((1, True)):
        return Model(prior, lexicon)
    columns = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    boosted = GBTClassifier(labelCol="toxic", maxDepth=3, maxIter=20, stepSize=0.25, seed=7, minInstancesPerNode=5)
    boosted.setRawPredictionCol("raw").setProbabilityCol("probability")
    ready = columns.transform(features.where("fold < 4")).select("toxic", "features").cache()
    trees = PipelineModel([columns, boosted.fit(ready)])
    ready.unpersist()
    if not by_kind.get((0, False)) or not by_kind.get((1, False)):
        return Model(prior, lexicon, trees)
    margins = _margins(trees, features.where("fold = 4"))
    monotone = IsotonicRegression(featuresCol="margin", labelCol="label").fit(
        margins.select("margin", F.col("toxic").cast("double").alias("label"))
    )
    return Model(prior, lexicon, trees, monotone.setFeaturesCol("margin"))
