"""Exact and approximate quantiles, medians and modes.

Exact quantiles are selected by narrowing ranges of values. The first pass over the
table takes count, least and greatest value of every group and column. Each further pass
cuts the ranges that hold a wanted rank into ``BINS`` bins and counts them, with the
least and greatest value of each; a bin that holds a wanted rank is the range of the next
pass, unless it has one value only or the rank is at its edge. Ranges of at most ``LEAF``
values are listed, sorted, at the end. Nothing is sorted but those lists, and a pass
shuffles at most a row per task and bin, whatever the size of a group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from plainloom.operators.ordering import join_null_safe
from plainloom.session import stage

#: Bins a range is cut into, and values of a range that may be listed.
BINS, LEAF = 4_096, 4_096


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by..., column, value as double)."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    return df.select(*by, F.explode(F.array(*pairs)).alias("_kv")).select(*by, "_kv.column", "_kv.value")


def _per_column(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], quantile: Callable[[Column], Column]
) -> DataFrame:
    """One aggregate per column in a single pass, turned to one row per column."""
    wide = df.groupBy(*by).agg(*[quantile(number(c)).alias(f"_q{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_q{i}").alias("q")) for i, c in enumerate(columns)]
    long = wide.select(*by, F.explode(F.array(*rows)).alias("_s")).select(*by, "_s.column", "_s.q")
    return long.where(F.col("q").isNotNull())


def number(column: str) -> Column:
    """The column as double, null where it is no number."""
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)


def _ranks(probs: Sequence[float]) -> list[str]:
    """The two ranks, from 0, around every wanted place."""
    return [f"{end}((size - 1) * {float(p)!r}D)" for p in probs for end in ("floor", "ceil")]


def _whole_ranges(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., c, size, before, n, lo, hi): one range for every group and column with a number; one pass."""
    aggs, each = [], []
    for i, c in enumerate(columns):
        x = number(c)
        aggs += [F.count(x).alias(f"_n{i}"), F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
        each.append(f"struct({i} AS c, _n{i} AS size, 0L AS before, _n{i} AS n, _lo{i} AS lo, _hi{i} AS hi)")
    long = df.groupBy(*by).agg(*aggs).select(*by, F.expr(f"inline(array({', '.join(each)}))"))
    return long.where("n > 0")


def _lists(ranges: DataFrame, columns: Sequence[str], by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The ranges that hold a wanted rank, as lists r0, r1, ... of the columns in one row a group.

    ``told`` has the values of the wanted ranks that a range's edges tell; it is ``open`` if it
    holds another one. ``short`` and ``wide`` say how many open ranges a column has at most,
    of no more and of more than ``LEAF`` values.
    """
    inside = [f"({rank} >= before AND {rank} < before + n)" for rank in _ranks(probs)]
    told = [
        f"CASE WHEN {held} AND ({rank} = before OR lo = hi) THEN lo WHEN {held} AND {rank} = before + n - 1 THEN hi END"
        for rank, held in zip(_ranks(probs), inside)
    ]
    open_ = " OR ".join(f"({held} AND {value} IS NULL)" for held, value in zip(inside, told))
    marked = ranges.where(" OR ".join(inside)).withColumns({"told": F.expr(f"array({', '.join(told)})"), "open": F.expr(open_)})
    aggs = []
    for i in range(len(columns)):
        own = f"CASE WHEN c = {i} THEN struct(size, before, n, lo, hi, open, told) END"
        aggs += [
            F.expr(f"collect_list({own})").alias(f"r{i}"),
            F.expr(f"count_if(c = {i} AND open AND n <= {LEAF})").alias(f"short{i}"),
            F.expr(f"count_if(c = {i} AND open AND n > {LEAF})").alias(f"wide{i}"),
        ]
    return marked.groupBy(*by).agg(*aggs)


def _in_ranges(df: DataFrame, columns: Sequence[str], by: Sequence[str], lists: list[list[str]]) -> DataFrame:
    """(by..., c, size, before, lo, hi, x): the numbers in one of the ranges of their column; null ranges hold none.

    A range is an expression for a struct of (size, before, lo, hi).
    """
    rows = df.select("*", *[number(c).alias(f"_x{i}") for i, c in enumerate(columns)])
    found = []
    for i, ranges in enumerate(lists):
        if ranges:
            cases = " ".join(f"WHEN _x{i} BETWEEN {r}.lo AND {r}.hi THEN {r}" for r in ranges)
            found.append(f"struct({i} AS c, CASE {cases} END AS at, _x{i} AS x)")
    long = rows.select(*by, F.expr(f"inline(array({', '.join(found)}))")).where("at IS NOT NULL")
    return long.select(*by, "c", "at.size", "at.before", "at.lo", "at.hi", "x")


def _bins(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ranges like those given, each cut in bins; halves keep the width of a range finite."""
    share = "coalesce(nanvl((x / 2 - lo / 2) / nullif(hi / 2 - lo / 2, 0D), 0.5D), 0.5D)"
    # The two edges never share a bin, so every pass narrows a range.
    place = f"CASE WHEN x = lo THEN 0 WHEN x = hi THEN {BINS - 1} ELSE least(floor({share} * {BINS}), {BINS - 1}) END"
    cut = values.groupBy(*by, "c", "size", "before", F.expr(f"cast({place} AS int)").alias("bin")).agg(
        F.expr("count(1)").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")
    )
    earlier = Window.partitionBy(*by, "c", "before").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return cut.select(*by, "c", "size", reached.alias("before"), "n", "lo", "hi")


def _listed(values: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(by..., c, size, told): the wanted ranks in ranges that are short enough to be listed."""
    lists = values.groupBy(*by, "c", "size", "before").agg(F.expr("sort_array(collect_list(x))").alias("_all"))
    picks = [f"CASE WHEN {rank} >= before THEN get(_all, cast({rank} - before AS int)) END" for rank in _ranks(probs)]
    return lists.select(*by, "c", "size", F.expr(f"array({', '.join(picks)})").alias("told"))


def _order_statistics(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by..., c, size, told): the values of the wanted ranks, each in one of the rows of a group and column.

    Without groups the ranges are a few literals; with groups they are a staged table that joins the rows.
    """
    names = [f"r{i}" for i in range(len(columns))]
    found: list[DataFrame] = []
    ranges = _whole_ranges(df, columns, by)
    while True:
        table = _lists(ranges, columns, by, probs)
        if by:
            table = stage(table)
            most = table.agg(*[F.max(f"{kind}{i}").alias(f"{kind}{i}") for i in range(len(columns)) for kind in ("short", "wide")]).first()
        else:
            most = table.first()
            table = df.sparkSession.createDataFrame([most], table.schema)
        for i, name in enumerate(names):
            found.append(table.select(*by, F.inline(name)).select(*by, F.lit(i).alias("c"), "size", "told"))

        def inside(kind: str) -> DataFrame | None:
            """The numbers in open ranges of one kind; None if there is no such range."""
            counts = [most[f"{kind}{i}"] or 0 for i in range(len(columns))]
            if not any(counts):
                return None
            if by:
                fits = f"<= {LEAF}" if kind == "short" else f"> {LEAF}"
                kept = table.select(*by, *[F.expr(f"filter({name}, r -> r.open AND r.n {fits})").alias(name) for name in names])
                lists = [[f"get({name}, {j})" for j in range(n)] for name, n in zip(names, counts)]
                return _in_ranges(join_null_safe(df, kept, by), columns, by, lists)
            short = kind == "short"
            own = [[_literal(r) for r in most[name] if r["open"] and (r["n"] <= LEAF) == short] for name in names]
            return _in_ranges(df, columns, by, own)

        listable, wide = inside("short"), inside("wide")
        if listable is not None:
            found.append(_listed(listable, by, probs))
        if wide is None:
            return reduce(DataFrame.unionByName, found)
        ranges = _bins(wide, by)


def _literal(r: Row) -> str:
    lo, hi = (f"double('{x!r}')" if math.isinf(x) else f"{x!r}D" for x in (r["lo"], r["hi"]))
    return f"struct({r['size']}L AS size, {r['before']}L AS before, {lo} AS lo, {hi} AS hi)"


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    approximate: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """One row per (by, column): array ``q`` of linearly interpolated quantiles.

    Nulls and NaN are left out; a group without a number has no row. Runs its passes
    over ``df`` when called.
    """
    by = list(by)
    if approximate:
        levels = F.array(*[F.lit(float(p)) for p in probs])
        return _per_column(df, columns, by, lambda x: F.percentile_approx(x, levels, accuracy))
    # Own names: a group column may be called like one of those used inside.
    keys = [f"_by{i}" for i in range(len(by))]
    needed = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], *dict.fromkeys(columns))
    found = _order_statistics(needed, columns, probs, keys)
    picked = found.groupBy(*keys, "c", "size").agg(*[F.expr(f"max(told[{j}])").alias(f"_v{j}") for j in range(2 * len(probs))])
    values = []
    for i, p in enumerate(probs):
        lo, hi, place = f"_v{2 * i}", f"_v{2 * i + 1}", f"((size - 1) * {float(p)!r}D)"
        values.append(f"CASE WHEN {lo} = {hi} THEN {lo} ELSE {lo} + ({hi} - {lo}) * ({place} - floor({place})) END")
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("c") + 1)
    own = [F.col(k).alias(b) for b, k in zip(by, keys)]
    return picked.select(*own, name.alias("column"), F.expr(f"array({', '.join(values)})").alias("q"))


def quantile_struct(df: DataFrame, columns: Sequence[str], prob: float, **kwargs) -> DataFrame:
    """One row, one column per input column: its ``prob`` quantile."""
    long = quantiles(df, columns, [prob], **kwargs)
    return long.agg(*[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in columns])


def medians(df: DataFrame, column: str, by: Sequence[str], name: str, **kwargs) -> DataFrame:
    return quantiles(df, [column], [0.5], by, **kwargs).select(*by, F.col("q")[0].alias(name))


def modes(df: DataFrame, column: str, by: Sequence[str] = (), name: str = "mode") -> DataFrame:
    """Most frequent non-null value per group, the smallest on ties.

    Counting (group, value) first spreads a hot group over its values.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("rank"), F.col(column).alias("value")))
    return counts.groupBy(*by).agg(best.alias("_best")).select(*by, F.col("_best.value").alias(name))
