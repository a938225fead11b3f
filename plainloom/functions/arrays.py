"""Array, nested-record and vector expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.functions.text import let


def literal_list_field(text: Column, field: str = "name", separator: str = ", ") -> Column:
    """Text of a Python-style list of dicts to one field of all its entries, joined."""
    quoted = F.regexp_replace(text, r"(:\s*)None(\s*[,}])", "$1null$2")
    records = F.from_json(
        quoted, f"array<struct<`{field}`:string>>", {"allowBackslashEscapingAnyCharacter": "true"}
    )
    return F.array_join(F.transform(records, lambda r: r[field]), separator)


def _filler(values: Column, size: Column, fill: int) -> Column:
    missing = F.greatest(size - F.size(values), F.lit(0)).cast("int")
    return F.array_repeat(F.lit(fill).cast("long"), missing)


def pad_left(values: Column, length: int | Column, fill: int = 0) -> Column:
    """Exactly ``length`` elements: filled in front, or cut keeping the last ones."""
    size = F.lit(length) if isinstance(length, int) else length
    start = F.greatest(F.size(values) - size, F.lit(0)) + 1
    return F.concat(_filler(values, size, fill), F.slice(values, start.cast("int"), size.cast("int")))


def pad_right(values: Column, length: int | Column, fill: int = 0) -> Column:
    """Exactly ``length`` elements: filled behind, or cut keeping the first ones."""
    size = F.lit(length) if isinstance(length, int) else length
    return F.concat(F.slice(values, 1, size.cast("int")), _filler(values, size, fill))


def growing_prefixes(values: Column) -> Column:
    """Prefixes of length 2, 3, ... up to the whole; none for shorter arrays."""
    def prefixes(a: Column) -> Column:
        every = F.transform(F.sequence(F.lit(2), F.greatest(F.size(a), F.lit(2))), lambda i: F.slice(a, 1, i))
        return F.when(F.size(a) >= 2, every)

    return let(values, prefixes)


def prefix_rows(df: DataFrame, keys: Sequence[str], values: str, name: str = "p") -> DataFrame:
    """A row (keys..., name) for every prefix of length 2 or more; no row ever holds more than one of them."""
    size = F.size(values)
    ends = df.where(size >= 2).select(*keys, values, F.explode(F.sequence(F.lit(2), size)).alias("_end"))
    return ends.select(*keys, F.slice(values, F.lit(1), F.col("_end")).alias(name))


def split_target(values: Column) -> tuple[Column, Column]:
    """All but the last element, and the last element."""
    return F.slice(values, 1, F.greatest(F.size(values) - 1, F.lit(0))), F.try_element_at(values, F.lit(-1))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 if one of them is zero."""
    sizes = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(sizes == 0, 0.0).otherwise(dot(a, b) / F.nullif(sizes, F.lit(0.0)))


def any_nonzero(values: Column) -> Column:
    return F.exists(values, lambda x: x != 0)
