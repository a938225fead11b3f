"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.session import stage

#: Six separators between words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``df`` has (Spark compares them without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def whole(text: str | Column) -> Column:
    """A text, a null one as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def each_text(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        yield batch, batch.column(text).to_pylist()


def with_columns(batch: pa.RecordBatch, drop: str, names: Sequence[str], columns: Sequence[pa.Array]) -> pa.RecordBatch:
    """The batch without its column ``drop``, then the new columns."""
    kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != drop]
    return pa.RecordBatch.from_arrays(
        [c for _, c in kept] + list(columns), names=[n for n, _ in kept] + list(names)
    )


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column that names every row, the same in every job that reads them.

    Rows of a Parquet table are named by a hash of their file's path and their place in
    the file, so such a table is read again and not copied. Anything else is staged first.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation" or "parquet" not in plan.toString():
        docs = stage(docs)
    place = docs.metadataColumn("_metadata")
    row = F.struct(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("place"))
    return docs.select("*", row.alias(name))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` documents that have a label, with the label's columns.

    The rows are those with the smallest hash of the key, so reruns take the same
    ones. Only the keys of that bounded sample meet the documents. Labels must have
    one row per key; keys that are null have no label.
    """
    chosen = labels.where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(rows)
    return docs.join(F.broadcast(chosen), key)
