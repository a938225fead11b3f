"""Lag windows over ordered series, and matching predictions to their times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plainloom.operators.ordering import PIECE_ROWS, lookup, with_pieces


def lookback_windows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    lookback: int,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Rows with ``features`` = the ``lookback`` values before them and ``target`` = their own.

    Rows without a full history are left out; null values are dropped first. Windows run
    within (series, piece). Each piece of a series hands the last ``lookback`` values it
    knows on to the next: a small row per (series, piece), whatever the length of a series.
    """
    placed, pieces = with_pieces(df.where(F.col(value).isNotNull()), by, order, "_piece", piece_rows)
    group = Window.partitionBy(*by, "_piece")
    out = placed.withColumn("features", F.collect_list(value).over(group.orderBy(*order).rowsBetween(-lookback, -1)))
    if pieces > 1:
        carried = lookup(out, _carried(placed, by, order, value, lookback), [*by, "_piece"], "left", null_safe=True)
        known = F.concat(F.coalesce("_carried", F.array().cast(out.schema["features"].dataType)), "features")
        out = carried.withColumn("features", F.slice(known, F.lit(-lookback), F.lit(lookback))).drop("_carried")
    return out.where(F.size("features") == lookback).withColumn("target", F.col(value)).drop("_piece")


def _carried(placed: DataFrame, by: Sequence[str], order: Sequence[str], value: str, lookback: int) -> DataFrame:
    """(by..., _piece, _carried): the last values of the series before each of its pieces, at most ``lookback``."""
    group = Window.partitionBy(*by, "_piece")
    last = group.orderBy(*[(F.col(c) if isinstance(c, str) else c).desc() for c in order])
    edges = placed.withColumn("_back", F.row_number().over(last)).where(F.col("_back") <= lookback)
    edge = F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("at"), F.col(value).alias("value"))))
    edges = edges.groupBy(*by, "_piece").agg(edge["value"].alias("_edge"))
    # Each piece of the series has a value at least, so as many pieces before it are enough.
    before = Window.partitionBy(*by).orderBy("_piece").rowsBetween(-lookback, -1)
    carried = F.flatten(F.collect_list("_edge").over(before))
    few = F.slice(carried, F.greatest(F.lit(1), F.size(carried) - lookback + 1), F.lit(lookback))
    return edges.select(*by, "_piece", few.alias("_carried"))


def align_predictions(
    predictions: DataFrame, timeline: DataFrame, by: Sequence[str], lookback: int, index: str = "k"
) -> DataFrame:
    """Give the k-th (0-based) prediction of a series' train or test part its place in time.

    A prediction needs ``lookback`` earlier values of its own part: train
    predictions start at position lookback, test ones at split position + lookback.
    ``timeline`` holds (by..., position from 1, split).
    """
    train_rows = timeline.groupBy(*by).agg(F.sum((F.col("split") == "train").cast("long")).alias("_cut"))
    placed = predictions.join(train_rows, list(by)) if by else predictions.withColumn("_cut", train_rows.select("_cut").scalar())
    start: Column = F.when(F.col("split") == "test", F.col("_cut")).otherwise(F.lit(0))
    placed = placed.withColumn("position", F.col(index) + lookback + start + 1).drop("_cut", index)
    return placed.join(timeline, [*by, "split", "position"])


def _solved(matrix: list[list[Column]], right: list[Column]) -> list[Column]:
    """Solution of a symmetric positive definite system in expressions, by elimination without pivots."""
    n = len(right)
    m, r = [list(row) for row in matrix], list(right)
    for k in range(n):
        for i in range(k + 1, n):
            factor = m[i][k] / m[k][k]
            for j in range(k + 1, n):
                m[i][j] = m[i][j] - factor * m[k][j]
            r[i] = r[i] - factor * r[k]
    out: list[Column] = [F.lit(0.0)] * n
    for i in reversed(range(n)):
        known = r[i]
        for j in range(i + 1, n):
            known = known - m[i][j] * out[j]
        out[i] = known / m[i][i]
    return out


def series_models(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, lags: int = 2, ridge: float = 1.0
) -> DataFrame:
    """One autoregression for every series: (by..., n, intercept, b1 (latest lag), b2, ..., forecast).

    The normal equations of a series are sums of products of its lag vectors, added up
    in one aggregation (combined before the shuffle, so a long series is no hot group)
    and solved in expressions. ``ridge`` is added to the diagonal, which also decides
    series too short for their coefficients. A series needs ``lags`` + 1 known values.
    """
    windows = lookback_windows(df.select(*by, *order, value), by, order, value, lags)
    x = [F.lit(1.0)] + [F.col("features")[lags - i].cast("double") for i in range(1, lags + 1)]
    y, size = F.col("target").cast("double"), lags + 1
    sums = [F.sum(x[i] * x[j]).alias(f"_s{i}_{j}") for i in range(size) for j in range(i, size)]
    sums += [F.sum(x[i] * y).alias(f"_r{i}") for i in range(size)]
    last = F.max_by(F.array(y, *x[1:lags]), F.struct(*order)).alias("_last")
    normal = windows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), last, *sums)
    cell = lambda i, j: F.col(f"_s{min(i, j)}_{max(i, j)}") + (ridge if i == j else 0.0)
    names = ["intercept", *[f"b{i}" for i in range(1, size)]]
    found = _solved([[cell(i, j) for j in range(size)] for i in range(size)], [F.col(f"_r{i}") for i in range(size)])
    # Solved once; the forecast reads the solution.
    solved = normal.select(*by, "n", "_last", *[f.alias(name) for f, name in zip(found, names)])
    forecast = F.col("intercept")
    for i in range(1, size):
        forecast = forecast + F.col(f"b{i}") * F.col("_last")[i - 1]
    return solved.select(*by, "n", *names, forecast.alias("forecast"))
