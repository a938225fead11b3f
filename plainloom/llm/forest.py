"""Approximate nearest neighbours with a hash-prefix forest.

Every tree hashes a vector to a long string of bits, the sides of random hyperplanes. The
strings of all vectors are dealt by tree and prefix, so that a query goes only to the
places that hold its own prefix; prefixes that hold too many strings are split by the next
bits. There the strings stand sorted. A query descends in each tree to its longest match
and takes the rows with the longest common prefixes. All trees then ascend together:
with the shortest length at which they have no more than ``NEAR`` candidates in all,
these are scored.

The k-th score found tells how short a common prefix must be allowed so that a vector as
near would share one in some tree with the wanted certainty. If the length reached is
that short, the query is done. Otherwise it ascends to that length, where prefixes hold
so many rows that these are not dealt: blocks of rows compare their strings with the
query's, and those that share the prefix in some tree are scored. So a query with near
neighbours examines a few hundred rows; one without ends in prefixes that most rows share.

Equal vectors are one class, searched once, with its smallest ids. Scores are computed on
the original vectors. Vectors that are null, zero or of another length than most, or that
hold a null or a component that is no finite number, take no part; nor do null ids. Rows
that repeat an id and its vector are one. An id with several vectors asks with each. Ties
go to the smaller id. An empty table gives no rows; other columns are not read, whatever
their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plainloom.session import stage

#: Sorted arrays, and bits of a hash string.
TREES, BITS = 16, 48
#: A vector as near as the last one found may be missed with this chance.
MISS = 0.05
#: Candidates of a query in all trees before it ascends further.
NEAR = 128
#: Strings of a prefix before it is split, and bits of a split.
PREFIX_ROWS, SPLIT_BITS = 4_096, 6
#: Rows of a block, and queries of a part, about.
BLOCK_ROWS, PART_QUERIES = 8_192, 8_192
SEED = 20_231


def _numbers(values) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in values])


@cache
def _planes(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, TREES * BITS))


def strings_of(vectors: np.ndarray) -> np.ndarray:
    """The hash string of every vector in every tree, its first bit highest."""
    powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    out = np.empty((len(vectors), TREES), dtype=np.int64)
    for at in range(0, len(vectors), 2_048):  # bounded memory
        sides = vectors[at : at + 2_048] @ _planes(vectors.shape[1]) > 0
        out[at : at + 2_048] = sides.reshape(len(sides), TREES, BITS) @ powers
    return out


def scores_of(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines, row by row in one order of addition, so that equal vectors have equal scores."""
    sizes = np.sqrt((vectors**2).sum(axis=1)) * np.sqrt((query**2).sum(axis=-1))
    return (vectors * query).sum(axis=1) / sizes


def common_bits(strings: np.ndarray, other: int | np.ndarray) -> np.ndarray:
    """How many first bits strings have in common."""
    differing = (strings ^ other).astype(np.uint64)
    # The exponent of a number below 2 ** 53 is the place of its highest bit.
    return BITS - np.frexp(differing.astype(np.float64))[1]


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    doubles = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), doubles.alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    rows = stage(rows.dropDuplicates(["vec_id", "embedding"]))
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (length["n"] if length else 0))


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """(c, ids, embedding): every distinct vector once, with its k + 1 smallest ids; c is the smallest."""
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    first = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    return first.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("c"), "ids", "embedding"
    )


def dealt_strings(vectors: DataFrame, key: str) -> DataFrame:
    """(tree, s, key): every tree's string of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                strings = strings_of(_numbers(batch.column("embedding").to_pylist()))
                own = np.repeat(batch.column(key).to_numpy(), TREES)
                trees = np.tile(np.arange(TREES, dtype=np.int32), len(strings))
                yield pa.RecordBatch.from_arrays([pa.array(trees), pa.array(strings.ravel()), pa.array(own)], names=["tree", "s", key])

    return vectors.select(key, "embedding").mapInArrow(run, f"tree int, s long, {key} long")


def with_prefixes(strings: DataFrame, asked: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Both with (length, prefix) of the place they are dealt to; strings of prefixes that no split makes small are left out."""
    length = min(BITS, max(0, math.ceil(math.log2(max(rows, 1) / PREFIX_ROWS))))
    prefix = F.call_function("shiftright", F.col("s"), F.lit(BITS) - F.col("length")).alias("prefix")
    placed = [t.withColumn("length", F.lit(length)) for t in (strings, asked)]
    by = ["tree", "length", "prefix"]
    while True:
        placed = [t.withColumn("prefix", prefix) for t in placed]
        full = stage(placed[0].groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PREFIX_ROWS).select(*by))
        if full.isEmpty():
            return placed[0], placed[1]
        if length >= BITS:
            return placed[0].join(full, by, "left_anti"), placed[1].join(full, by, "left_anti")
        length = min(BITS, length + SPLIT_BITS)
        marked = full.withColumn("split", F.lit(length))
        placed = [t.join(marked, by, "left").withColumn("length", F.coalesce("split", "length")).drop("split") for t in placed]


def _matches(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """Per query of one place the rows with the longest common prefixes, whole lengths, at most ``NEAR`` rows."""
    out: dict[str, list] = {"q": [], "least": [], "c": [], "bits": []}
    if len(queries):
        order = np.argsort(points["s"].to_numpy(), kind="stable")
        own, ids = points["s"].to_numpy()[order], points["c"].to_numpy()[order]
        for q, s, length in zip(queries["q"], queries["s"], queries["length"]):
            for least in range(length, BITS + 1):
                rest = (1 << (BITS - least)) - 1
                low, high = np.searchsorted(own, s & ~rest, "left"), np.searchsorted(own, s | rest, "right")
                if high - low <= NEAR:
                    break
            else:
                least, low, high = BITS + 1, 0, 0
            out["q"].append(q)
            out["least"].append(least)
            out["c"].append(ids[low:high])
            out["bits"].append(common_bits(own[low:high], s).astype(np.int32))
    return pd.DataFrame(out, dtype=object)  # columns of lists, if empty too


def _ascended(found: pd.DataFrame) -> pd.DataFrame:
    """Of one query's matches in all trees: the shortest length with at most ``NEAR`` candidates, and these."""
    # A tree that left the query out has too many rows at every length.
    least = int(found["least"].max()) if len(found) == TREES else BITS + 1
    cs, bits = np.concatenate(list(found["c"])), np.concatenate(list(found["bits"]))
    while least <= BITS and (bits >= least).sum() > NEAR:
        least += 1
    cs = np.unique(cs[bits >= least]) if least <= BITS else cs[:0]
    return pd.DataFrame({"q": [found["q"].iloc[0]], "reached": [least], "c": [cs]})


def near_candidates(classes: DataFrame, asked: DataFrame, rows: int) -> DataFrame:
    """(q, reached, c): candidates of every query and the length of common prefix that all of them share."""
    strings, wanted = with_prefixes(stage(dealt_strings(classes, "c")), stage(dealt_strings(asked, "q")), rows)
    by = ["tree", "length", "prefix"]
    met = strings.groupBy(*by).cogroup(wanted.groupBy(*by)).applyInPandas(
        _matches, "q long, least int, c array<long>, bits array<int>"
    )
    return met.groupBy("q").applyInPandas(_ascended, "q long, reached int, c array<long>")


def scored(pairs: DataFrame) -> DataFrame:
    """(q, c, ids, score) of (q, c, ids, embedding, asked)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = scores_of(*(_numbers(batch.column(c).to_pylist()) for c in ("embedding", "asked")))
                columns = [batch.column("q"), batch.column("c"), batch.column("ids"), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["q", "c", "ids", "score"])

    return pairs.select("q", "c", "ids", "embedding", "asked").mapInArrow(run, "q long, c long, ids array<long>, score double")


def _in_block(points: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Of a block's classes that share a prefix of the wanted length with a query in some tree: the k + 1 nearest."""
    out: dict[str, list] = {"q": [], "c": [], "ids": [], "score": [], "examined": []}
    if not len(points) or not len(queries):
        return pd.DataFrame(out, dtype=object)
    vectors = _numbers(points["embedding"])
    strings, ids, lists = strings_of(vectors), points["c"].to_numpy(), points["ids"].to_numpy()
    unit = vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]
    for at in range(0, len(queries), 128):
        some = queries.iloc[at : at + 128]
        asked = _numbers(some["asked"])
        own, shift = strings_of(asked), (BITS - some["allowed"].to_numpy())[None, :]
        shares = np.zeros((len(points), len(some)), dtype=bool)
        for t in range(TREES):
            shares |= (strings[:, t, None] >> shift) == (own[None, :, t] >> shift)
        near = unit @ (asked / np.sqrt((asked**2).sum(axis=1))[:, None]).T
        for i, (q, floor) in enumerate(zip(some["q"], some["kth"].astype(float))):
            rows = np.flatnonzero(shares[:, i])
            examined = len(rows)
            best = near[rows, i]
            bound = np.partition(best, len(best) - k - 1)[len(best) - k - 1] if len(best) > k + 1 else -2.0
            # What rounding might have put behind a tie stays for the exact measure.
            rows = rows[best >= max(bound, -2.0 if np.isnan(floor) else floor) - 1e-9]
            score = scores_of(vectors[rows], asked[i])
            chosen = np.lexsort((ids[rows], -score))[: k + 1]
            # A row without a class counts what was examined, whether or not anything is near.
            out["q"] += [q] * (len(chosen) + 1)
            out["c"] += [None, *ids[rows][chosen].tolist()]
            out["ids"] += [None, *lists[rows][chosen]]
            out["score"] += [None, *score[chosen].tolist()]
            out["examined"] += [examined] + [0] * len(chosen)
    return pd.DataFrame(out, dtype=object)


def _ranked(found: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(q, query_id, vec_id, score, rank): the members of the classes found, the query's own id aside."""
    rows = found.join(asked.select("q", "query_id"), "q").select("q", "query_id", F.explode("ids").alias("vec_id"), "score")
    rows = rows.where("vec_id <> query_id").groupBy("q", "query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def neighbours(
    rows: DataFrame, queries: DataFrame, k: int, miss: float = MISS, block_rows: int = BLOCK_ROWS, with_examined: bool = False
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query; both tables as ``usable`` gives them.

    ``with_examined`` adds how many distinct vectors the query was compared with.
    """
    classes = stage(classes_of(rows, k))
    total = classes.count()
    asked = stage(queries.select(F.col("vec_id").alias("query_id"), "embedding").withColumn("q", F.monotonically_increasing_id()))
    near = stage(near_candidates(classes, asked, total))
    pairs = near.select("q", F.explode("c").alias("c")).join(classes, "c")
    first = stage(scored(pairs.join(asked.select("q", F.col("embedding").alias("asked")), "q")))
    kth = _ranked(first, asked, k).groupBy("q").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    # A vector as near shares a prefix of this length in some tree, but for the chance of a miss.
    agree = 1 - F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "kth"))) / math.pi
    longest = F.floor(F.lit(math.log(1 - miss ** (1 / TREES))) / F.log(F.greatest(agree, F.lit(1e-9))))
    allowed = F.when(F.col("kth").isNull(), 0).when(agree >= 1, BITS).otherwise(F.least(longest, F.lit(BITS))).cast("int")
    state = asked.join(near.select("q", "reached", F.size("c").alias("examined")), "q", "left").join(kth, "q", "left")
    state = stage(state.withColumn("allowed", allowed).withColumn("open", F.coalesce(F.col("reached") > F.col("allowed"), F.lit(True))))
    left = state.where("open").select("q", F.col("embedding").alias("asked"), "allowed", "kth")
    blocks = max(1, -(-total // block_rows))
    parts = max(1, -(-left.count() // PART_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    points = classes.withColumn("block", dealt("c", blocks)).withColumn("part", every(parts))
    visits = left.withColumn("part", dealt("q", parts)).withColumn("block", every(blocks))
    more = points.groupBy("block", "part").cogroup(visits.groupBy("block", "part")).applyInPandas(
        lambda p, q: _in_block(p, q, k), "q long, c long, ids array<long>, score double, examined long"
    )
    more = stage(more)
    best = _ranked(first.select("q", "ids", "score").union(more.where("c IS NOT NULL").select("q", "ids", "score")), asked, k)
    # Ids that ask with several vectors have one list.
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    if not with_examined:
        return out
    counts = state.select("query_id", "q", "examined").join(more.groupBy("q").agg(F.sum("examined").alias("_more")), "q", "left")
    counts = counts.groupBy("query_id").agg(F.sum(F.coalesce("_more", "examined", F.lit(0))).alias("examined"))
    return out.join(counts, "query_id")
