"""Cleaning expressions: tolerant casts, extraction, recoding, rounding, splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def coerce_number(text: Column, to: str = "double") -> Column:
    """Numeric value of a text, null when it is not a number or is NaN."""
    value = text.try_cast(to)
    return F.when(~F.isnan(value.cast("double")), value)


def comma_number(text: Column) -> Column:
    """'1,234' to 1234; unusable text counts as 0."""
    return F.coalesce(F.replace(text, F.lit(","), F.lit("")).try_cast("bigint"), F.lit(0))


def first_group(text: Column, pattern: str) -> Column:
    """First capture group, null when the pattern does not occur."""
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", found)


def recode(value: Column, mapping: Mapping, keep_unmapped: bool = True) -> Column:
    """Replace values by a mapping; unmapped values stay, or become null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    mapped = F.try_element_at(F.create_map(*pairs), value)
    return F.coalesce(mapped, value) if keep_unmapped else mapped


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the MD5 of a key: the same on every engine and partitioning."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
