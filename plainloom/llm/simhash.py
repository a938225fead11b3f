"""SimHash near-dedup with a pigeonring filter.

A fingerprint has 64 bits in four segments on a ring. If two fingerprints differ in at
most 3 bits, then at some segment the differences of the chains that start there stay
within their share of the budget: 0 in the first segment, 1 in two, 2 in three. The
first two conditions are a join on 32 bits, met by a segment and the 17 values within
one bit of the next; the third prunes before the full distance is counted.

Only distinct fingerprints are joined, so copies of a text cost one row whatever their
number. Components are found by star contraction, which keeps a forest of links.

Nulls count as empty texts; these have fingerprint zero and are linked like others. A
component is named by its smallest doc_id, null ones aside (null if it has no other).
Repeated rows share their component. An empty table gives no rows; other columns
are kept or not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import fresh, numbered, whole
from plainloom.session import stage

SEGMENTS, WIDTH = 4, 16
SEED = 42


def fingerprint_of(text: str, words_each: int) -> int:
    words = text.encode().lower().split()  # bytes: A to Z are lowered, six separators split
    if not words:
        return 0
    if len(words) < words_each:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(words_each))))
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, name: str, words_each: int, text: str = "text") -> DataFrame:
    """``docs`` with its fingerprints as a long column."""

    @F.pandas_udf("long")
    def fingerprints(texts):
        import pandas as pd

        return pd.Series([fingerprint_of(t, words_each) for t in texts], dtype="int64")

    return docs.withColumn(name, fingerprints(whole(text)))


def segment(value: Column, k: int) -> Column:
    return F.shiftrightunsigned(value, WIDTH * (k % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1).cast("long"))


def links(fingerprints: DataFrame, most: int) -> DataFrame:
    """(a, b), a < b: the pairs of distinct fingerprints ``fp`` at most ``most`` < 4 bits apart."""
    if not 0 <= most < SEGMENTS:
        raise ValueError("the chains are laid out for at most 3 differing bits")
    fp = F.col("fp")
    two = lambda k, change=0: F.struct(
        F.lit(k).alias("ring"),
        F.shiftleft(segment(fp, k), WIDTH).bitwiseOR(segment(fp, k + 1).bitwiseXOR(F.lit(change).cast("long"))).alias("value"),
    )
    changes = [0] + [1 << b for b in range(WIDTH)]
    stored = fingerprints.select(F.explode(F.array(*[two(k) for k in range(SEGMENTS)])).alias("key"), fp.alias("b"))
    tried = fingerprints.select(
        F.explode(F.array(*[two(k, c) for k in range(SEGMENTS) for c in changes])).alias("key"), fp.alias("a")
    )
    pairs = tried.join(stored, "key").where("a < b").select("a", "b", F.col("key.ring").alias("ring"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    # Differences of the chain of three segments that starts at the segment which met.
    beyond = F.lit(False)
    for k in range(SEGMENTS):
        chain = sum((F.bit_count(segment(apart, k + i)) for i in range(1, 3)), F.lit(0))
        beyond = beyond | ((F.col("ring") == k) & (chain > 2))
    return pairs.where(~beyond & (F.bit_count(apart) <= most)).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of (a, b): root is the smallest value that it reaches.

    Every node is linked to its smallest neighbour, first from the larger ones, then
    from the smaller ones, until nothing changes; links never grow in number.
    """
    current, before = stage(edges.select("a", "b")), None
    while True:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).union(current.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = stage(large.where("a <> b").distinct())
        # Links now lead from smaller a to larger b; seen from b, all a and b itself go to the smallest a.
        smallest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(smallest, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        current = stage(small.where("a <> b").distinct())
        state = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                current.select("a", "a").distinct()
            )
        before = state


def classes(rows: DataFrame, most: int) -> DataFrame:
    """(fp, component_id) of the distinct fingerprints of (doc_id, fp)."""
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fp"), most)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(named, "root").select("fp", "component_id")


def hex_of(fp: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, words_each: int = 3, most: int = 3) -> DataFrame:
    """doc_id, fingerprint and component_id of every row."""
    rows = stage(with_fingerprints(docs.select("doc_id", "text"), "fp", words_each).select("doc_id", "fp"))
    known = stage(classes(rows, most))
    return rows.join(known, "fp").select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words_each: int = 3, most: int = 3) -> DataFrame:
    """One row of each component, with its columns: the smallest doc_id, null ones last, one of repeated rows."""
    row, fp = fresh(docs, "simhash_row", "simhash_fp")
    kept = numbered(docs, row)
    rows = with_fingerprints(kept, fp, words_each).select("doc_id", F.col(fp).alias("fp"), F.col(row).alias("row"))
    distinct = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    distinct = stage(distinct)
    roots = components(links(distinct.select("fp"), most)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = stage(rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row)))
    # The rows that stay grow with the corpus: their numbers are never broadcast, and texts are hashed, not sorted.
    return kept.join(first.hint("shuffle_hash"), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
