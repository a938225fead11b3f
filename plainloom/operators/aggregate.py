"""Grouped aggregates: popularity, shares, top-k with a remainder, recency/frequency/spend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.functions.dates import elapsed_days


def group_sum(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum per non-null key; an all-null group sums to 0."""
    present = df.na.drop(subset=list(by))
    return present.groupBy(*by).agg(F.coalesce(F.sum(value), F.lit(0)).alias(name))


def value_counts(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """Count per non-null key."""
    return df.na.drop(subset=list(by)).groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def value_shares(df: DataFrame, column: str, name: str = "share") -> DataFrame:
    """Relative frequency of every non-null value."""
    counts = value_counts(df, [column])
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn(name, F.col("n") / total)


def top_k_and_others(df: DataFrame, column: str, k: int, others: str = "Others") -> DataFrame:
    """The k most frequent values, and everything beyond them (if anything is) as one row, with shares.

    Ranked by count, then value. The top k come from a top-k sort; the rest is the
    total minus the top, so nothing is ranked in one task.
    """
    counts = value_counts(df, [column])
    top = counts.orderBy(F.col("n").desc(), F.col(column)).limit(k)
    total = counts.agg(F.sum("n")).scalar()
    rest = top.agg((total - F.sum("n")).alias("n")).where("n > 0").select(F.lit(others).alias(column), "n")
    return top.unionByName(rest).withColumn("share", F.col("n") / total)


def rfm(
    df: DataFrame, customer: str, date: str, amount: str, as_of: Column
) -> DataFrame:
    """Recency in whole elapsed days, number of orders and total spend per customer."""
    grouped = df.na.drop(subset=[customer]).groupBy(customer).agg(
        F.max(date).alias("_last"),
        F.count(date).alias("frequency"),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("monetary"),
    )
    return grouped.select(
        customer, elapsed_days(as_of, F.col("_last")).alias("recency"), "frequency", "monetary"
    )


def arg_max(df: DataFrame, by: Sequence[str], value: str, score: str, name: str) -> DataFrame:
    """Value with the highest score per group, the smallest value on ties; null if no score is known."""
    best = F.min(F.when(F.col(score).isNotNull(), F.struct((-F.col(score)).alias("s"), F.col(value).alias("v"))))
    return df.groupBy(*by).agg(best.alias("_b")).select(*by, F.col("_b.v").alias(name))
