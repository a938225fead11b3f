"""Column profiles, distributions, correlations and tests, as tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.operators.ordering import lookup
from plainloom.operators.quantiles import number, quantiles


def _unstack(row: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One wide row to one row per column; ``fields`` maps output name to name prefix."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{p}_{i}").alias(n) for n, p in fields.items()])
        for i, c in enumerate(columns)
    ]
    return row.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls and null ratio per column, and over all cells as column '(all)'; one pass."""
    columns = list(columns or df.columns)
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(f"m_{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    everything = sum((F.col(f"m_{i}") for i in range(len(columns))), F.lit(0))
    entries = [(c, F.col(f"m_{i}"), F.col("_rows")) for i, c in enumerate(columns)]
    entries.append(("(all)", everything, F.col("_rows") * len(columns)))
    structs = [
        F.struct(F.lit(c).alias("column"), n.alias("n_null"), (n / F.nullif(size, F.lit(0))).alias("ratio"))
        for c, n, size in entries
    ]
    return row.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min and max per column; one pass."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
    fields = {"n": "n", "mean": "mean", "std": "std", "min": "min", "max": "max"}
    return _unstack(df.agg(*aggs), columns, fields)


def describe(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Moments plus quartiles per numeric column."""
    q = quantiles(df, columns, [0.25, 0.5, 0.75], approximate=approximate)
    quartiles = q.select(
        "column", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75")
    )
    return moments(df, columns).join(quartiles, "column", "left")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column; exact counts shuffle values, sketches do not."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    row = df.agg(*[count(F.col(c)).alias(f"d_{i}") for i, c in enumerate(columns)])
    return _unstack(row, columns, {"n_distinct": "d"})


def column_roles(df: DataFrame, threshold: int = 20, approximate: bool = False) -> DataFrame:
    """numeric / ordinal (numeric with fewer distinct values than ``threshold``) / categorical."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    numbers = {"byte", "short", "integer", "long", "float", "double", "decimal"}
    columns = [c for c, t in kinds.items() if t in numbers or t == "string"]
    numeric = F.col("column").isin([c for c in columns if kinds[c] in numbers])
    role = (
        F.when(numeric & (F.col("n_distinct") < threshold), "ordinal")
        .when(numeric, "numeric")
        .otherwise("categorical")
    )
    return distinct_counts(df, columns, approximate).withColumn("role", role)


def correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows that have both numbers; null if one of them does not vary."""
    x, y = number(a), number(b)
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


#: Tasks that add up the partial matrices before the last one does.
ADDING_TASKS = 32


def gram(df: DataFrame, columns: Sequence[str]) -> dict[str, np.ndarray]:
    """Sums over the rows that have numbers in both columns i and j: ``n`` rows, ``s`` of i, ``q`` of i squared, ``p`` of i times j.

    Columns are taken less their mean. Every task makes one matrix of each kind, and
    ``ADDING_TASKS`` tasks add these before a last one does; the results, of the square of the
    number of columns, come to the driver.
    """
    numbers = [number(c) for c in columns]
    means = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(numbers)]).first()
    centred = df.select(*[(x - F.lit(m or 0.0)).alias(f"x{i}") for i, (x, m) in enumerate(zip(numbers, means))])
    size = len(columns)

    def emitted(kinds: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(range(4), pa.int32()), pa.array([k.ravel() for k in kinds], pa.list_(pa.float64()))], names=["kind", "sums"]
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = np.zeros((4, size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            known = ~np.isnan(x)
            x, mask = np.where(known, x, 0.0), known.astype(float)
            kinds += np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
        yield emitted(kinds)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = np.zeros((4, size * size))
        for batch in batches:
            for kind, sums in zip(batch.column("kind").to_pylist(), batch.column("sums")):
                kinds[kind] += sums.values.to_numpy()
        yield emitted(kinds)

    shape = "kind int, sums array<double>"
    parts = centred.mapInArrow(partial, shape).repartition(ADDING_TASKS).mapInArrow(added, shape)
    rows = parts.repartition(1).mapInArrow(added, shape).collect()
    return {name: np.array(r["sums"]).reshape(size, size) for name, r in zip("nsqp", sorted(rows, key=lambda r: r["kind"]))}


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, over the rows that have both numbers, for any number of columns.

    Null, the diagonal too, where a column does not vary.
    """
    columns = list(columns)
    sums = gram(df, columns)
    n, s, q, p = (sums[k] for k in "nsqp")
    spread = n * q - s * s
    # What is left of a constant by rounding is no variance.
    spread = np.where(spread > 1e-12 * n * q, spread, 0.0)
    below = np.sqrt(spread * spread.T)
    r = np.divide(n * p - s * s.T, below, out=np.full_like(p, np.nan), where=below > 0)
    np.fill_diagonal(r, np.where(np.isnan(np.diag(r)), np.nan, 1.0))
    rows = [(a, b, None if np.isnan(x) else float(x)) for a, line in zip(columns, r) for b, x in zip(columns, line)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


def correlation_with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation with one target, sorted falling; ``abs_corr`` is taken after the sort. Null for a constant."""
    row = df.agg(*[correlation(c, target).alias(f"r_{i}") for i, c in enumerate(columns)])
    out = _unstack(row, columns, {"corr": "r"})
    return out.withColumn("abs_corr", F.abs("corr")).orderBy(F.col("corr").desc(), "column")


def pooled_t(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two-sample t statistic with pooled variance, and its degrees of freedom; null without variance."""
    row = df.agg(
        *[
            f(c).alias(f"{n}_{i}")
            for i, c in enumerate([a, b])
            for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))
        ]
    )
    n1, n2 = F.col("n_0"), F.col("n_1")
    dof = n1 + n2 - 2
    pooled = F.try_divide((n1 - 1) * F.col("v_0") + (n2 - 1) * F.col("v_1"), dof)
    spread = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    t = F.try_divide(F.col("m_0") - F.col("m_1"), spread)
    return row.select(t.alias("t"), dof.alias("dof"))


def bin_index(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the last bin holds its upper edge; a constant goes to bin 0."""
    position = F.least(F.floor((x - low) / F.nullif(high - low, F.lit(0.0)) * F.lit(bins)), F.lit(bins - 1))
    return F.when(high > low, position).otherwise(0).cast("int")


def histogram(df: DataFrame, column: str, bins: int, hue: str | None = None) -> DataFrame:
    """Counts per equal-width bin (and hue) with common edges."""
    values = df.where(F.col(column).isNotNull()).withColumn("_x", F.col(column).cast("double"))
    edges = values.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    low, high = edges.getField("lo"), edges.getField("hi")
    by = ["bin"] + ([hue] if hue else [])
    counts = (
        values.withColumn("bin", bin_index(F.col("_x"), low, high, bins))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (high - low) / F.lit(bins)
    return counts.withColumns(
        {"left_edge": low + width * F.col("bin"), "right_edge": low + width * (F.col("bin") + 1)}
    )


def box_stats(df: DataFrame, column: str, by: Sequence[str], approximate: bool = False) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and outlier count per group; NaN is left out."""
    q = quantiles(df, [column], [0.25, 0.5, 0.75], by, approximate=approximate)
    q = q.select(
        *by, F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75")
    )
    x = F.col("_x")
    iqr = F.col("q75") - F.col("q25")
    inside = x.between(F.col("q25") - 1.5 * iqr, F.col("q75") + 1.5 * iqr)
    values = df.select(*by, number(column).alias("_x")).where("_x IS NOT NULL")
    return (
        lookup(values, q, by)
        .groupBy(*by, "q25", "median", "q75")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def outlier_cut(df: DataFrame, columns: Sequence[str], prob: float = 0.97) -> DataFrame:
    """Rows strictly below the ``prob`` quantile in every column; thresholds fixed up front."""
    q = quantiles(df, columns, [prob])
    picks = [F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in columns]
    limits = q.agg(F.struct(*picks)).scalar()
    keep = F.lit(True)
    for c in columns:
        keep = keep & (F.col(c) < limits.getField(c))
    return df.where(keep)


def column_profile(
    df: DataFrame, columns: Sequence[str], target: str, bins: int = 10, approximate: bool = False
) -> DataFrame:
    """One row per numeric column: nulls, distinct values, moments, quartiles, modal bin, target correlation.

    Nulls, moments and correlations come from one pass; the bins are counted against its row.
    """
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"m_{i}"), F.count(x).alias(f"n_{i}"), F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"), F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}"),
            correlation(c, target).alias(f"r_{i}"),
        ]
    (row,) = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs).collect()
    known = [
        (c, row[f"m_{i}"], row[f"m_{i}"] / row["_rows"] if row["_rows"] else None)
        + tuple(row[f"{k}_{i}"] for k in ("n", "mean", "std", "min", "max", "r"))
        for i, c in enumerate(columns)
    ]
    summary = df.sparkSession.createDataFrame(
        known, "column string, n_null long, ratio double, n long, mean double, std double, min double, max double, target_corr double"
    )
    places = [
        F.struct(F.lit(c).alias("column"), F.when(number(c).isNotNull(), bin_index(number(c), F.lit(k[6]), F.lit(k[7]), bins)).alias("bin"))
        for c, k in zip(columns, known)
        if k[6] is not None
    ]
    binned = df.select(F.explode(F.array(*places)).alias("_s")) if places else None
    if binned is None:
        modal = df.sparkSession.createDataFrame([], "column string, modal_bin int")
    else:
        counts = binned.where("_s.bin IS NOT NULL").groupBy("_s.column", "_s.bin").agg(F.count(F.lit(1)).alias("_n"))
        most = F.min(F.struct((-F.col("_n")).alias("r"), F.col("bin").alias("bin"))).alias("_b")
        modal = counts.groupBy("column").agg(most).select("column", F.col("_b.bin").alias("modal_bin"))
    q = quantiles(df, columns, [0.25, 0.5, 0.75], approximate=approximate)
    quartiles = q.select(
        "column", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75")
    )
    return (
        summary.join(distinct_counts(df, columns, approximate), "column")
        .join(quartiles, "column", "left")
        .join(modal, "column", "left")
    )
