"""Scaling and encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.operators.ordering import lookup, number_rows
from plainloom.session import stage


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population std; a constant column becomes 0."""
    stats = []
    for i, c in enumerate(columns):
        stats += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    fitted = df.agg(F.struct(*stats)).scalar()
    scaled = {}
    for i, c in enumerate(columns):
        std = fitted.getField(f"s{i}")
        scaled[c] = (F.col(c) - fitted.getField(f"m{i}")) / F.when(std == 0, 1.0).otherwise(std)
    return df.withColumns(scaled)


def minmax_fit(df: DataFrame, columns: Sequence[str]) -> Column:
    """Minimum and maximum per column, for scaling this or another table."""
    stats = []
    for c in columns:
        stats += [F.min(c).cast("double").alias(f"{c}_lo"), F.max(c).cast("double").alias(f"{c}_hi")]
    return df.agg(F.struct(*stats)).scalar()


def minmax_scale(df: DataFrame, columns: Sequence[str], fitted: Column) -> DataFrame:
    """To [0, 1]; a constant column becomes 0."""
    def scaled(c: str) -> Column:
        lo, hi = fitted.getField(f"{c}_lo"), fitted.getField(f"{c}_hi")
        return (F.col(c) - lo) / F.when(hi == lo, 1.0).otherwise(hi - lo)

    return df.withColumns({c: scaled(c) for c in columns})


def minmax_inverse(df: DataFrame, columns: Sequence[str], fitted: Column) -> DataFrame:
    def restored(c: str) -> Column:
        lo, hi = fitted.getField(f"{c}_lo"), fitted.getField(f"{c}_hi")
        return F.col(c) * F.when(hi == lo, 1.0).otherwise(hi - lo) + lo

    return df.withColumns({c: restored(c) for c in columns})


def minmax_by_group(df: DataFrame, column: str, by: Sequence[str], name: str) -> DataFrame:
    """Min-max scale inside each group, for example per train/test part."""
    ranges = df.groupBy(*by).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    span = F.when(F.col("_hi") == F.col("_lo"), 1.0).otherwise(F.col("_hi") - F.col("_lo"))
    joined = lookup(df, ranges, by, null_safe=True)
    return joined.withColumn(name, (F.col(column) - F.col("_lo")) / span).drop("_lo", "_hi")


def categories(df: DataFrame, column: str) -> list:
    """Sorted distinct non-null values."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in found)


def dummy_positions(df: DataFrame, columns: Sequence[str], drop_first: bool = True, name: str = "positions") -> DataFrame:
    """The dummies of ``columns`` as one sparse vector: sorted ``positions`` of the ones among ``width`` entries.

    For any number of categories: their codes come from ranged positions and a join, so
    neither a list of categories nor a column for each is made. The first column's
    categories come first, in their order; the null of a column sets no position.
    """
    first, out, offset, places = int(drop_first), df, F.lit(0).cast("long"), []
    for i, c in enumerate(columns):
        out = label_encode(out, c, f"_code{i}")
        own = F.col(f"_code{i}") - first
        places.append(F.when(own >= 0, own + offset))
        offset = offset + F.greatest(df.agg(F.count_distinct(c)).scalar() - first, F.lit(0))
    return out.select(*df.columns, F.array_compact(F.array(*places)).alias(name), offset.alias("width"))


def dummies(df: DataFrame, columns: Sequence[str], drop_first: bool = True) -> DataFrame:
    """One 0/1 column per category in place of each column; a null row is all zero.

    The columns of the result are the categories, so they pass through the driver; for
    more of them than a table can have columns use ``dummy_positions``.
    """
    made = []
    for c in columns:
        values = categories(df, c)[1 if drop_first else 0 :]
        made += [
            F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in values
        ]
    return df.select("*", *made).drop(*columns)


def mixed_columns(
    numeric: Sequence[str], ordinal: Sequence[str], categorical: Sequence[str], output: str = "features"
) -> Pipeline:
    """One estimator for all column roles: numbers scaled, ordinals coded, categories one-hot.

    Codes and categories are alphabetical and none is dropped; the one-hot part stays sparse.
    """
    coded = [*ordinal, *categorical]
    stages = [
        VectorAssembler(inputCols=list(numeric), outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_scaled", withMean=True, withStd=True),
    ]
    if coded:
        stages.append(
            StringIndexer(
                inputCols=coded, outputCols=[f"_code_{c}" for c in coded],
                stringOrderType="alphabetAsc", handleInvalid="keep",
            )
        )
    if categorical:
        stages.append(
            OneHotEncoder(
                inputCols=[f"_code_{c}" for c in categorical],
                outputCols=[f"_hot_{c}" for c in categorical], dropLast=False,
            )
        )
    parts = ["_scaled", *[f"_code_{c}" for c in ordinal], *[f"_hot_{c}" for c in categorical]]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol=output)])


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Alphabetical codes from 0; null stays null."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = number_rows(stage(values), [], [column], "_p").select(column, (F.col("_p") - 1).alias(name))
    return lookup(df, codes, [column], "left")
