"""Row positions and running totals that never gather a group in one task.

A plain ``row_number() over (partition by key order by ts)`` sends a whole key to
one task, and without a key the whole table. Here the table is cut into pieces, ranges of
(key, order) of about ``PIECE_ROWS`` rows, by bounds taken from a hashed sample. Windows
run within (key, piece); one small row per (key, piece) tells where each piece starts.
The bounds are written once, so a row belongs to the same piece in every job and in every
task that has to run again; the rows themselves are shuffled once and never staged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plainloom.session import stage

#: Rows of a piece, about; the most pieces; sampled rows for each.
PIECE_ROWS, MOST_PIECES, SAMPLED = 1_000_000, 1 << 16, 16


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key; keeps the left keys.

    No broadcast hint: Spark broadcasts when the statistics or the shuffle size
    seen at run time are under its threshold, and otherwise sort-merges and
    splits skewed partitions.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for i, k in enumerate(keys):
        match = left[k].eqNullSafe(renamed[f"_r_{k}"])
        on = match if i == 0 else on & match
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def lookup(
    facts: DataFrame, derived: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Join a big table with a derived one that is probably, but not surely, small.

    The derived table is written first, so the planner knows its real size: under
    the broadcast threshold the big table is not shuffled at all, above it the
    join is a sort-merge whose skewed partitions Spark splits.
    """
    sized = stage(derived)
    return join_null_safe(facts, sized, keys, how) if null_safe else facts.join(sized, list(keys), how)


def with_pieces(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str, piece_rows: int | None = None
) -> tuple[DataFrame, int]:
    """``df`` with the number of every row's piece, and the number of pieces.

    Reads ``df`` once for its count and, if it has more rows than a piece, once for the
    bounds; stage it before if it is dear to compute. ``order`` ascends: negate numbers to
    let them fall.
    """
    rows = df.count()
    wanted = min(MOST_PIECES, -(-rows // (piece_rows or PIECE_ROWS)))
    if wanted <= 1:
        return df.withColumn(name, F.lit(0)), 1
    key = F.struct(*[F.col(c) if isinstance(c, str) else c for c in (*by, *order)])
    one_in = max(1, rows // (wanted * SAMPLED))
    sample = df.select(key.alias("key")).where(F.pmod(F.xxhash64("key"), F.lit(one_in)) == 0)
    every = sample.agg(F.sort_array(F.collect_list("key")).alias("keys"))
    step = F.greatest(F.lit(1), (F.size("keys") / wanted).cast("int"))
    bounds = stage(every.select(F.filter("keys", lambda _, i: i % step == step - 1).alias("bounds"))).scalar()
    # Binary search for the number of bounds up to the row's key: a step is taken if the bound before its end is no larger.
    placed, at = df.withColumn("_key", key).withColumn(name, F.lit(0)), F.col(name)
    for stride in (1 << bit for bit in reversed(range(wanted.bit_length() + 1))):
        reached = F.coalesce(F.get(bounds, at + F.lit(stride - 1)) <= F.col("_key"), F.lit(False))
        placed = placed.withColumn(name, F.when(reached, at + F.lit(stride)).otherwise(at))
    return placed.drop("_key"), wanted


def _starts(placed: DataFrame, by: Sequence[str], weight: Column) -> DataFrame:
    """Per (group, piece): total weight of earlier pieces and of the group."""
    per_piece = placed.groupBy(*by, "_piece").agg(weight.alias("_w"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    return per_piece.select(
        *by,
        "_piece",
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_before"),
        F.sum("_w").over(group).alias("_total"),
    )


def _summed(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    own: Column,
    weight: Column,
    name: str,
    total: str | None,
    piece_rows: int | None,
) -> DataFrame:
    """Adds ``own`` over the rows of the group so far, and the group's ``weight``."""
    placed, pieces = with_pieces(df, by, order, "_piece", piece_rows)
    group = Window.partitionBy(*by, "_piece")
    local = placed.withColumn(name, own.over(group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    if pieces == 1:
        return (local.withColumn(total, weight.over(group)) if total else local).drop("_piece")
    known = lookup(local, _starts(placed, by, weight), [*by, "_piece"], null_safe=True)
    out = known.withColumn(name, F.col(name) + F.col("_before"))
    if total:
        out = out.withColumnRenamed("_total", total)
    return out.drop("_piece", "_before", "_total")


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    name: str = "position",
    total: str | None = None,
    piece_rows: int | None = None,
) -> DataFrame:
    """1-based position of every row in its ``by`` group under a total, ascending ``order``.

    ``total`` adds the group's row count. See ``with_pieces`` for how often ``df`` is read.
    """
    return _summed(df, by, order, F.row_number(), F.count(F.lit(1)), name, total, piece_rows).withColumn(
        name, F.col(name).cast("long")
    )


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    weight: str,
    name: str = "upto",
    total: str = "total",
) -> DataFrame:
    """Cumulative ``weight`` in each ``by`` group plus the group's total weight."""
    return _summed(df, by, order, F.sum(weight), F.sum(weight), name, total, None)


def positional_slice(
    df: DataFrame, order: Sequence[str | Column], start: int, stop: int | None = None
) -> DataFrame:
    """Rows ``start`` (0-based, included) to ``stop`` (excluded) under ``order``."""
    numbered = number_rows(df, [], order, "_position")
    keep = F.col("_position") > start
    if stop is not None:
        keep = keep & (F.col("_position") <= stop)
    return numbered.where(keep).drop("_position")


def shuffle_rows(df: DataFrame, key: str) -> DataFrame:
    """Repeatable shuffle: order by the hash of a unique key."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows under ``order`` (a top-k, not a full sort)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
