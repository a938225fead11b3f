"""Exact k nearest neighbours without forming all pairs.

Training rows belong to the nearest of about sqrt(n) centres, fitted on a sample of
bounded size; in large tables there are fewer, so that cells keep rows enough for the
queries that are sent to them. A query visits its nearest cells first, in rounds of growing size; the
distance of its k-th neighbour so far is carried from round to round, and a cell falls
out once its least possible distance (triangle inequality with the cell's own range of
distances) is beyond that, so nothing is lost. Cells are cut into blocks and the queries
of a cell into chunks by hash, so a cell with a third of the rows is spread over many
tasks; every (block, chunk) returns k rows per query, computed with numpy.

How many cells fall out depends on the data. In many dimensions without clusters all
distances are alike, no bound excludes a cell, and any exact search stays quadratic.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plainloom.operators.textstats import top_per_group
from plainloom.session import stage

#: The most centres; rows a cell has at least, about, if there are more than ``FEW_CENTRES``; rows that are sampled for each; how many times more cells each round visits.
MOST_CENTRES, CELL_ROWS, FEW_CENTRES, SAMPLE_EACH, GROWTH = 4_096, 8_192, 64, 8, 4
#: Numbers that are worked on at once; rows whose visits are worked out at once.
TILE, SLICE = 1 << 15, 256
_SLACK = 1e-9  # keeps rounding from cutting off a cell that ties with the bound


def distances(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed dimension by dimension so equal rows get equal values; in tiles that stay in a core's cache."""
    total = np.zeros((len(rows), len(others)))
    columns = np.ascontiguousarray(others.T)
    wide = max(1, TILE // max(1, len(others)))
    room = np.empty((min(wide, len(rows)), len(others)))
    for at in range(0, len(rows), wide):
        some = total[at : at + wide]
        diff = room[: len(some)]
        for d in range(rows.shape[1]):
            np.subtract(rows[at : at + wide, d, None], columns[d], out=diff)
            np.multiply(diff, diff, out=diff)
            some += diff
    return np.sqrt(total, out=total)


def _nearest(rows: np.ndarray, others: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, other, distance) of the ``k`` nearest others of every row, ties by place.

    A matrix product tells about how far apart rows are; the distances themselves are
    computed for those that its rounding leaves in question.
    """
    sizes, own = (others * others).sum(axis=1), (rows * rows).sum(axis=1)
    about = own[:, None] + sizes - 2.0 * (rows @ others.T)
    about[np.isnan(about)] = np.inf
    slack = 8.0 * (rows.shape[1] + 8) * np.finfo(float).eps * (own + sizes.max())
    limit = np.partition(about, k - 1, axis=1)[:, k - 1] + slack
    row, other = np.nonzero(about <= limit[:, None])
    far = np.zeros(len(row))
    for at in range(0, len(row), TILE):
        left, right = rows[row[at : at + TILE]].T, others[other[at : at + TILE]].T
        for d in range(rows.shape[1]):
            diff = left[d] - right[d]
            far[at : at + TILE] += diff * diff
    far = np.sqrt(far)
    order = np.lexsort((other, far, row))
    row, other, far = row[order], other[order], far[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], other[place < k], far[place < k]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _fitted_centres(train: DataFrame, key: str, vector: str, wanted: int, steps: int) -> np.ndarray:
    """Means of the nearest rows, started from and fitted on a sample of ``SAMPLE_EACH`` rows a centre, by hash of the key."""
    order = (F.md5(F.col(key).cast("string")), key)
    rows = train.orderBy(*order).limit(wanted * SAMPLE_EACH).select(vector).collect()
    if not rows:
        raise ValueError("no training rows")
    sample = np.array([r[0] for r in rows], dtype=np.float64)
    centres = sample[:wanted].copy()
    for _ in range(steps):
        nearest = distances(sample, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def nearest_neighbours(
    queries: DataFrame,
    train: DataFrame,
    key: str,
    vector: str,
    k: int = 5,
    n_centres: int | None = None,
    block_rows: int = 20_000,
    chunk_rows: int = 10_000,
    visited: list[int] | None = None,
) -> DataFrame:
    """(query, neighbour, distance): the k closest training rows of every query row, ties by key.

    ``key`` must be a bigint in both tables. ``visited`` collects how many (query, cell)
    visits each round had.
    """
    rows = train.count()
    wanted = n_centres or min(MOST_CENTRES, max(1, math.isqrt(rows)), max(FEW_CENTRES, rows // CELL_ROWS))
    centres = _fitted_centres(train, key, vector, wanted, steps=5)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), SLICE):
                some = pdf.iloc[at : at + SLICE]
                d = distances(_matrix(some["vec"]), centres)
                yield some.assign(cell=d.argmin(axis=1), dist=d.min(axis=1))

    train_rows = train.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    assigned = stage(train_rows.mapInPandas(assign, "id long, vec array<double>, cell int, dist double"))
    spans = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi"))
    closest = top_per_group(assigned.select("cell", "dist", "id"), ["cell"], ["dist", "id"], k)
    near = closest.groupBy("cell").agg(F.array_sort(F.collect_list("dist")).alias("near"))
    cells = {r["cell"]: r for r in spans.join(near, "cell").collect()}  # a row per centre
    order = sorted(cells)
    held = centres[order]
    low = np.array([cells[c]["lo"] for c in order])
    high = np.array([cells[c]["hi"] for c in order])
    owner = np.concatenate([[i] * len(cells[c]["near"]) for i, c in enumerate(order)]).astype(int)
    offset = np.concatenate([cells[c]["near"] for c in order])
    enough = min(k, len(offset))

    def visits_of(first: int, stop: int):
        """The cells that stand at places ``first`` to ``stop`` of a query's order and may hold a nearer row."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), SLICE):
                    some = pdf.iloc[at : at + SLICE]
                    d = distances(_matrix(some["vec"]), held)
                    # No more than k rows are as far as their cell's centre and their own distance to it.
                    bound = np.partition(d[:, owner] + offset, enough - 1, axis=1)[:, enough - 1]
                    bound = np.fmin(bound, some["kth"].to_numpy(dtype=float)) + _SLACK
                    least = np.maximum(np.maximum(d - high, low - d), 0.0)
                    ranked = np.lexsort((d, least), axis=1)[:, first:stop]
                    row, place = np.nonzero(np.take_along_axis(least, ranked, axis=1) <= bound[:, None])
                    cell = np.array(order)[ranked[row, place]]
                    yield pd.DataFrame({"query": some["id"].values[row], "qvec": some["vec"].values[row], "cell": cell})

        return run

    def per_cell(counts: dict, size: int):
        pairs = [F.lit(x) for c in order for x in (c, -(-counts.get(c, 0) // size) or 1)]
        return F.element_at(F.create_map(*pairs), F.col("cell"))

    def best(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({"query": [], "neighbour": [], "distance": []})
        t = t.sort_values("id")
        ids, targets, take = t["id"].to_numpy(), _matrix(t["vec"]), min(k, len(t))
        parts = []
        for start in range(0, len(q), SLICE):
            some = q.iloc[start : start + SLICE]
            row, other, far = _nearest(_matrix(some["qvec"]), targets, take)
            parts.append(pd.DataFrame({"query": some["query"].to_numpy()[row], "neighbour": ids[other], "distance": far}))
        return pd.concat(parts)

    query_rows = queries.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    blocks = per_cell({c: cells[c]["n"] for c in order}, block_rows)
    found, first, size = None, 0, 1
    while first < len(order):
        # The k-th distance so far; none before a query has k neighbours.
        if found is None:
            asking = query_rows.withColumn("kth", F.lit(None).cast("double"))
        else:
            kth = found.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("kth"))
            asking = query_rows.join(kth.withColumnRenamed("query", "id"), "id", "left")
        visits = stage(asking.mapInPandas(visits_of(first, first + size), "query long, qvec array<double>, cell int"))
        counts = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}
        if visited is not None:
            visited.append(sum(counts.values()))
        # Cells stand by their least distance: if no query visits one here, none will later.
        if not counts:
            break
        chunks = per_cell(counts, chunk_rows)
        left = visits.withColumns(
            {"chunk": F.pmod(F.xxhash64("query"), chunks).cast("int"), "block": F.explode(F.sequence(F.lit(0), blocks - 1))}
        )
        right = assigned.where(F.col("cell").isin(list(counts))).withColumns(
            {"block": F.pmod(F.xxhash64("id"), blocks).cast("int"), "chunk": F.explode(F.sequence(F.lit(0), chunks - 1))}
        )
        by = ["cell", "block", "chunk"]
        more = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
            best, "query long, neighbour long, distance double"
        )
        found = top_per_group(more if found is None else found.unionByName(more), ["query"], ["distance", "neighbour"], k)
        first, size = first + size, size * GROWTH
        if first < len(order):
            found = stage(found)
    return found


def knn_vote(
    queries: DataFrame, train: DataFrame, key: str, vector: str, label: str, k: int = 5, **sizes
) -> DataFrame:
    """(key, predicted): majority label of the k nearest training rows, the smallest label on ties."""
    found = nearest_neighbours(queries, train, key, vector, k, **sizes)
    labels = train.select(F.col(key).alias("neighbour"), F.col(label).alias("_l"))
    votes = found.join(labels, "neighbour").groupBy("query", "_l").agg(F.count(F.lit(1)).alias("_n"))
    winner = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_l").alias("l"))).alias("_w")
    return votes.groupBy("query").agg(winner).select(F.col("query").alias(key), F.col("_w.l").alias("predicted"))
