"""Joins, unions, deduplication and dimension lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """Small table of literals; its size is fixed by the caller's code, so it is broadcast."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return F.broadcast(spark.range(1).select(F.explode(F.array(*structs)).alias("_r")).select("_r.*"))


def code_labels(df: DataFrame, code: str, labels: Mapping, name: str = "label") -> DataFrame:
    """Join a code column with a fixed code-to-label dimension; unknown codes give null."""
    dim = literal_table(df.sparkSession, [code, name], list(labels.items()))
    return df.join(dim, code, "left")


def join_dimension_twice(
    facts: DataFrame, dim: DataFrame, key: str, attributes: Sequence[str], roles: Mapping[str, str]
) -> DataFrame:
    """Inner-join one dimension once per role: ``roles`` maps a fact column to a name prefix."""
    out = facts
    for fact_column, prefix in roles.items():
        side = dim.select(
            F.col(key).alias(fact_column), *[F.col(a).alias(f"{prefix}_{a}") for a in attributes]
        )
        out = out.join(side, fact_column)
    return out


def union_sources(sources: Mapping[str, DataFrame], flag: str = "source") -> DataFrame:
    """Union by name with missing columns as null; ``flag`` says where a row came from."""
    out = None
    for label, df in sources.items():
        part = df.withColumn(flag, F.lit(label))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def side_by_side(left: DataFrame, right: DataFrame, key: str, how: str = "full") -> DataFrame:
    """Put two column sets of the same rows next to each other, matched on the row key."""
    return left.join(right, key, how)


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], digest_keys: bool = False
) -> DataFrame:
    """One row per key: the first under ``order``.

    A minimum over a struct combines before the shuffle, so a key that holds a
    third of the table sends one row per task. ``digest_keys`` groups wide text
    keys by their SHA-256 instead of the text.
    """
    columns = df.columns
    head = [c for c in order]
    rest = [c for c in columns if c not in head and (digest_keys or c not in keys)]
    by: list[str | Column] = list(keys)
    if digest_keys:
        lengths = [F.length(F.col(k).cast("string")) for k in keys]
        texts = [F.col(k).cast("string") for k in keys]
        by = [F.sha2(F.to_json(F.struct(*lengths, *texts)), 256).alias("_digest")]
    first = df.groupBy(*by).agg(F.min(F.struct(*head, *rest)).alias("_row"))
    kept = [] if digest_keys else [k for k in keys if k not in head]
    return first.select(*kept, "_row.*").select(*columns)


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct rows and surplus copies over ``columns`` (default all)."""
    columns = list(columns or df.columns)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("n_duplicates"),
    )


def drop_repeated_names(df: DataFrame) -> DataFrame:
    """Drop columns whose name occurs again further right (the last one stays)."""
    names = df.columns
    marked = df.toDF(*[f"_{i}" for i in range(len(names))])
    keep = [i for i, n in enumerate(names) if n not in names[i + 1 :]]
    return marked.select(*[F.col(f"_{i}").alias(names[i]) for i in keep])
