"""A column profile that can be added to.

Each part of the input (a day, a file) gets one row of sketches per column: exact counts,
least and greatest value, a sketch of the distinct values and one of the quantiles. The rows
are stored; a profile of any parts merges their rows. New input costs its own scan only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.operators.quantiles import number

#: Logarithm of the size of a distinct sketch (relative error about 1.04 / sqrt(2 ** size)), and size of a
#: quantile sketch (rank error about 1.3 % at 200).
DISTINCT_SIZE, QUANTILE_SIZE = 12, 200


def sketch(df: DataFrame, columns: Sequence[str], part: Column) -> DataFrame:
    """(part, column, rows, n, sum, min, max, distinct, quantiles): one row per part and numeric column; one pass."""
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, c in enumerate(columns):
        x = number(c)
        aggs += [
            F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(DISTINCT_SIZE)).alias(f"d{i}"),
            F.kll_sketch_agg_double(x, F.lit(QUANTILE_SIZE)).alias(f"q{i}"),
        ]
        fields = {"n": "n", "sum": "s", "min": "lo", "max": "hi", "distinct": "d", "quantiles": "q"}
        rows.append(F.struct(F.lit(c).alias("column"), "rows", *[F.col(f"{p}{i}").alias(f) for f, p in fields.items()]))
    made = df.groupBy(part.alias("part")).agg(*aggs)
    return made.select("part", F.inline(F.array(*rows)))


def merged(sketches: DataFrame) -> DataFrame:
    """One row of sketches per column over all parts."""
    return sketches.groupBy("column").agg(
        *[F.sum(c).alias(c) for c in ("rows", "n", "sum")], F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def profile(sketches: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, rows, n, n_null, mean, min, max, n_distinct, q) from stored sketches; n_distinct and q are estimates."""
    whole = merged(sketches)
    picks = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))) for p in probs]
    return whole.select(
        "column", "rows", "n", (F.col("rows") - F.col("n")).alias("n_null"), F.try_divide("sum", "n").alias("mean"),
        "min", "max", F.hll_sketch_estimate("distinct").alias("n_distinct"), F.array(*picks).alias("q"),
    )
