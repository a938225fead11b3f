"""Train/test splits: by key hash, stratified, and by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.functions.columns import half_even, hash_bucket
from plainloom.operators.ordering import number_rows


def hash_split(df: DataFrame, key: str, train_percent: int, name: str = "split") -> DataFrame:
    """Row-local split: the same key lands on the same side in every run and engine."""
    is_train = hash_bucket(F.col(key)) < train_percent
    return df.withColumn(name, F.when(is_train, "train").otherwise("test"))


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def stratified_split(
    df: DataFrame, label: str, key: str, train_fraction: float, name: str = "split"
) -> DataFrame:
    """In every class the first ``train_fraction`` of its rows, in hash order, is train."""
    hashed = df.withColumn("_h", F.md5(F.col(key).cast("string")))
    numbered = number_rows(hashed, [label], ["_h", key], "_p", total="_n")
    is_train = F.col("_p") <= F.col("_n") * F.lit(train_fraction)
    return numbered.withColumn(name, F.when(is_train, "train").otherwise("test")).drop("_h", "_p", "_n")


def ordered_split(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    test_fraction: float,
    name: str = "split",
    position: str = "position",
) -> DataFrame:
    """Per series, the first round(n * (1 - f)) rows are train; rounds half to even."""
    numbered = number_rows(df, by, order, position, total="_n")
    cut = half_even(F.col("_n") * F.lit(1 - test_fraction))
    split = F.when(F.col(position) <= cut, "train").otherwise("test")
    return numbered.withColumn(name, split).drop("_n")
