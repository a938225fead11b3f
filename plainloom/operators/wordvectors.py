"""Word vectors from co-occurrence counts, without a vocabulary on the driver.

Words that stand within ``window`` places of each other are counted as pairs, the counts
turned to positive pointwise mutual information (PPMI), and the sparse matrix reduced by
block power iteration: a few columns of random numbers, made from a hash of the word, are
multiplied by the matrix again and again and made orthogonal in between. Only the inner
products of the columns, a few hundred numbers, come to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.operators.ordering import lookup
from plainloom.session import stage


def cooccurrences(df: DataFrame, tokens: Column, window: int = 4, min_count: int = 5) -> DataFrame:
    """(term, context, n) of words that occur ``min_count`` times or more; each pair counts both ways."""
    rows = df.select(tokens.alias("_t"))
    ahead = [F.slice("_t", d + 1, F.greatest(F.size("_t") - d, F.lit(0))) for d in range(1, window + 1)]
    behind = [F.slice("_t", 1, F.greatest(F.size("_t") - d, F.lit(0))) for d in range(1, window + 1)]
    both = F.concat(*[F.arrays_zip(a.alias("a"), b.alias("b")) for a, b in zip(behind, ahead)])
    pairs = rows.select(F.explode(both).alias("p")).select(F.least("p.a", "p.b").alias("a"), F.greatest("p.a", "p.b").alias("b"))
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    often = rows.select(F.explode("_t").alias("term")).groupBy("term").count().where(F.col("count") >= min_count)
    often = stage(often.select("term"))
    known = lookup(counts, often.withColumnRenamed("term", "a"), ["a"])
    known = stage(known.join(often.withColumnRenamed("term", "b"), "b").select("a", "b", "n"))
    turned = known.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "n")
    same = known.select("a", "b", F.when(F.col("a") == F.col("b"), 2 * F.col("n")).otherwise(F.col("n")).alias("n"))
    return same.unionByName(turned).select(F.col("a").alias("term"), F.col("b").alias("context"), "n")


def ppmi(counts: DataFrame) -> DataFrame:
    """(term, context, weight): log(n * total / (n of term * n of context)) where that is above 0."""
    counts = stage(counts)
    sums = stage(counts.groupBy("term").agg(F.sum("n").alias("_row")))
    total = counts.agg(F.sum("n")).scalar()
    joined = counts.join(sums, "term").join(sums.select(F.col("term").alias("context"), F.col("_row").alias("_col")), "context")
    weight = F.log(F.col("n") * total / (F.col("_row") * F.col("_col")))
    return joined.withColumn("weight", weight).where("weight > 0").select("term", "context", "weight")


def synonyms(weights: DataFrame, word: str, k: int = 10) -> DataFrame:
    """(term, similarity): the words whose rows of weights have the greatest cosine with that of ``word``."""
    own = stage(weights.where(F.col("term") == word).select("context", F.col("weight").alias("_own")))
    size = F.sqrt(own.agg(F.sum(F.col("_own") * F.col("_own"))).scalar())
    near = weights.join(own, "context", "left").groupBy("term").agg(
        F.sum(F.col("weight") * F.col("_own")).alias("_dot"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_size")
    )
    near = near.where((F.col("term") != word) & F.col("_dot").isNotNull())
    out = near.select("term", F.try_divide("_dot", F.col("_size") * size).alias("similarity"))
    return out.orderBy(F.round("similarity", 9).desc(), "term").limit(k)


def _orthonormal(columns: DataFrame, names: list[str]) -> DataFrame:
    """The columns made orthogonal and of length one, by the Cholesky factor of their inner products."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = columns.agg(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
    inner = np.zeros((len(names), len(names)))
    for (i, j), s in zip(pairs, sums):
        inner[i, j] = inner[j, i] = s or 0.0
    # Directions that the matrix does not have stay near zero instead of blowing up.
    factor = np.linalg.cholesky(inner + np.eye(len(names)) * (1e-12 * np.trace(inner) + 1e-300))
    back = np.linalg.inv(factor).T
    mixed = []
    for j, name in enumerate(names):
        column = F.lit(0.0)
        for i in range(j + 1):
            column = column + F.col(names[i]) * float(back[i, j])
        mixed.append(column.alias(name))
    return columns.select("term", *mixed)


def word_vectors(weights: DataFrame, size: int = 16, rounds: int = 6, seed: int = 1) -> DataFrame:
    """(term, vector): rows of the weights' matrix times its leading ``size`` directions.

    Words of equal use get near vectors whatever their spelling. The matrix must be symmetric.
    """
    names = [f"q{i}" for i in range(size)]
    unit = lambda i: F.xxhash64(F.lit(seed * 1000 + i), "term") / F.lit(float(1 << 63))
    weights = stage(weights)
    block = stage(_orthonormal(stage(weights.select("term").distinct().select("term", *[unit(i).alias(n) for i, n in enumerate(names)])), names))

    def times(columns: DataFrame) -> DataFrame:
        right = columns.withColumnRenamed("term", "context")
        sums = [F.sum(F.col("weight") * F.col(n)).alias(n) for n in names]
        return stage(weights.join(right, "context").groupBy("term").agg(*sums))

    for _ in range(rounds):
        block = stage(_orthonormal(times(block), names))
    return times(block).select("term", F.array(*names).alias("vector"))
