"""Filling missing values from constants, column statistics and group statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plainloom.functions.columns import nan_to_null
from plainloom.operators.ordering import lookup
from plainloom.operators.quantiles import medians, modes


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill per column; each constant must match its column's type."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def _known(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a NaN of the column as null, so that it is filled too."""
    if df.schema[column].dataType.typeName() not in ("double", "float"):
        return df
    return df.withColumn(column, nan_to_null(F.col(column)))


def _statistic(df: DataFrame, column: str, by: Sequence[str], stat: str) -> DataFrame:
    if stat == "median":
        return medians(df, column, by, "_fill")
    if stat == "mode":
        return modes(df, column, by, "_fill")
    if stat == "mean":
        return df.groupBy(*by).agg(F.avg(column).alias("_fill"))
    raise ValueError(f"unknown statistic {stat}")


def fill_statistic(df: DataFrame, column: str, stat: str) -> DataFrame:
    """Fill with the column's mean, median or mode (smallest on ties)."""
    known = _known(df, column)
    value = _statistic(known, column, [], stat).scalar()
    return known.withColumn(column, F.coalesce(F.col(column), value))


def fill_group(df: DataFrame, column: str, by: Sequence[str], stat: str) -> DataFrame:
    """Fill with the group's mean, median or mode; an all-null group and a null key stay null.

    The statistic is aggregated (combined before the shuffle) and joined back:
    a window over the group would send a hot group to one task.
    """
    df = _known(df, column)
    groups = _statistic(df.na.drop(subset=list(by)), column, by, stat)
    filled = lookup(df, groups, by, "left").withColumn(column, F.coalesce(F.col(column), F.col("_fill")))
    return filled.select(*df.columns)


def fill_chain(df: DataFrame, column: str, by: Sequence[str], stat: str, constant: object) -> DataFrame:
    """Group statistic first, then a constant for what is left."""
    return fill_constants(fill_group(df, column, by, stat), {column: constant})
