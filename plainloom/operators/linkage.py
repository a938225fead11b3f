"""Single-linkage trees: the minimum spanning tree of all rows, from the trees of pairs of blocks.

The rows are dealt to blocks by a hash of their key. Every pair of blocks meets in one
task, where the distances across are computed and their minimum spanning tree grown; an
edge that is not in it is the longest of a circle and in no tree of all rows. Those edges
are few, about the rows times the blocks. Boruvka rounds over them shrink the graph until
its edges fit one task by ``TASK_EDGES``; what is chosen is exactly the minimum spanning
tree, whose edges in order of length are the merges of single linkage. All pairs of rows
are looked at once, in tasks of bounded size. Rows must be unique by key; edges are in order of (distance, keys). Rows without a vector have no edges. Equal
vectors are merged at height 0 before, each copy with the smallest key, and stand for one
row after that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plainloom.operators.neighbours import distances
from plainloom.session import stage

#: Rows of a block, at most about; blocks of smaller tables, and their rows at least; rows whose distances are held at once.
BLOCK_ROWS, BLOCKS, FEWEST, TILE_ROWS = 8_000, 24, 500, 2_000
#: Edges that one task takes to the end; more are first made fewer by rounds over all tasks.
TASK_EDGES = 2_000_000


def _grown(ranks: np.ndarray, far: np.ndarray, left: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, place, distance) of the minimum spanning tree, grown from the first row.

    ``far`` has the distances between the first ``left`` rows and the others, or between all
    rows if ``left`` is their number. Ties go by the ranks of the two ends.
    """
    n, last = len(ranks), np.iinfo(np.int64).max
    back = far if left == n else np.ascontiguousarray(far.T)
    best, code, parent, free = np.full(n, np.inf), np.full(n, last), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    child, heights, at = np.empty(n - 1, dtype=np.int64), np.empty(n - 1), 0
    free[0] = False
    for step in range(n - 1):
        if left == n:
            reach, d = slice(0, n), far[at]
        elif at < left:
            reach, d = slice(left, n), far[at]
        else:
            reach, d = slice(0, left), back[at - left]
        nearer = free[reach] & (d <= best[reach])
        where = np.flatnonzero(nearer) + reach.start
        edge = np.minimum(ranks[at], ranks[where]) * n + np.maximum(ranks[at], ranks[where])
        d = d[where - reach.start]
        better = (d < best[where]) | (edge < code[where])
        where = where[better]
        best[where], code[where], parent[where] = d[better], edge[better], at
        least = best.argmin()
        ties = np.flatnonzero(best == best[least])
        at = ties[code[ties].argmin()] if len(ties) > 1 else least
        child[step], heights[step] = at, best[at]
        free[at], best[at], code[at] = False, np.inf, last
    return parent[child], child, heights


def _forest(ends: np.ndarray, others: np.ndarray, rank: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which edges the minimum spanning forest of ``n`` places has, and the component of every place; ranks are unique."""
    label, taken = np.arange(n), np.zeros(len(ends), dtype=bool)
    edge_of = np.empty(len(ends), dtype=np.int64)
    edge_of[rank] = np.arange(len(ends))
    alive = np.arange(len(ends))
    while len(alive):
        c, e = label[ends[alive]], label[others[alive]]
        crossing = c != e
        alive, c, e = alive[crossing], c[crossing], e[crossing]
        least = np.full(n, len(ends))
        np.minimum.at(least, c, rank[alive])
        np.minimum.at(least, e, rank[alive])
        own = np.flatnonzero(least < len(ends))
        chosen = edge_of[least[own]]
        taken[chosen] = True
        a, b = label[ends[chosen]], label[others[chosen]]
        parent = np.arange(n)
        parent[own] = np.where(a == own, b, a)
        mutual = (parent[parent] == np.arange(n)) & (np.arange(n) < parent)
        parent[mutual] = np.flatnonzero(mutual)
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up
        label = parent[label]
    return taken, label


def _numbered_edges(found: pa.Table, u: str, v: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys of an edge table in order, and the places of both ends among them."""
    keys = np.array(found.column(u).to_pylist() + found.column(v).to_pylist())
    every, place = np.unique(keys, return_inverse=True)
    return every, place[: len(found)], place[len(found) :]


def _ranks(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    rank = np.empty(len(d), dtype=np.int64)
    rank[np.lexsort((b, a, d))] = np.arange(len(d))
    return rank


def _finished(edges: DataFrame) -> DataFrame:
    """(a, b, d) of the tree's edges among the few between components c and e that are left."""
    plain = edges.select("c", "e", "edge.*")
    kind = {f.name: f.dataType.simpleString() for f in plain.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches) or [pa.RecordBatch.from_pylist([], schema=pa.schema([]))])
        if len(found):
            every, c, e = _numbered_edges(found, "c", "e")
            _, a, b = _numbered_edges(found, "a", "b")
            taken, _ = _forest(c, e, _ranks(a, b, found.column("d").to_numpy()), len(every))
            yield from found.select(["a", "b", "d"]).filter(pa.array(taken)).to_batches()

    return plain.coalesce(1).mapInArrow(run, f"a {kind['a']}, b {kind['b']}, d double")


def _edges(rows: DataFrame, blocks: int) -> DataFrame:
    """(a, b, d) with a < b: the edges of the trees of every block and of every pair of blocks of (u, vec)."""
    kind = rows.schema["u"].dataType.simpleString()
    placed = rows.withColumn("block", F.pmod(F.xxhash64("u"), F.lit(blocks)).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = other.select("u", "vec", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def trees(found: pa.Table) -> pa.Table:
        keys, vectors = np.array(found.column("u").to_pylist()), found.column("vec").combine_chunks()
        vectors = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1)
        block, i, j = (found.column(c).to_numpy() for c in ("block", "i", "j"))
        left, right = (list(_pieces(np.flatnonzero(block == end[0]))) for end in (i, j))
        within = i[0] == j[0]
        ends: list[tuple[np.ndarray, ...]] = []
        for x, y in ((x, y) for k, x in enumerate(left) for y in (left[k:] if within else right)):
            far = distances(vectors[x], vectors[y])
            far[np.isnan(far)] = np.inf
            places = x if x is y else np.concatenate([x, y])
            ranks = np.unique(keys[places], return_inverse=True)[1]
            a, b, d = _grown(ranks, far, len(x))
            ends.append((places[a], places[b], d))
        a, b, d = (np.concatenate(c) for c in zip(*ends)) if ends else (np.empty(0, dtype=int), np.empty(0, dtype=int), np.empty(0))
        place = np.unique(keys, return_inverse=True)[1]
        swap = place[a] > place[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        if len(ends) > 1:  # of the trees of tiles, what the tree of both blocks has
            taken, _ = _forest(a, b, _ranks(place[a], place[b], d), len(keys))
            a, b, d = a[taken], b[taken], d[taken]
        u = found.column("u")
        return pa.table({"a": u.take(pa.array(a)), "b": u.take(pa.array(b)), "d": d})

    pairs = blocks * (blocks + 1) // 2
    return met.repartition(min(pairs, 512), "i", "j").groupBy("i", "j").applyInArrow(trees, f"a {kind}, b {kind}, d double")


def _pieces(places: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, len(places), TILE_ROWS):
        yield places[at : at + TILE_ROWS]


def _roots(parents: DataFrame) -> DataFrame:
    """(c, root) of (c, parent) where every chain ends in a pair that points at each other, by halving the chains."""
    back = parents.select(F.col("c").alias("parent"), F.col("parent").alias("_back"))
    pointed = parents.join(back, "parent", "left")
    mutual = F.col("_back") == F.col("c")
    ends = (mutual & (F.col("c") < F.col("parent"))) | F.col("_back").isNull() & (F.col("c") == F.col("parent"))
    known = stage(pointed.select("c", F.when(ends, F.col("c")).otherwise(F.col("parent")).alias("root")))
    while True:
        up = known.select(F.col("c").alias("root"), F.col("root").alias("_up"))
        jumped = stage(known.join(up, "root", "left").select("c", F.coalesce("_up", "root").alias("root"), (F.coalesce("_up", "root") != F.col("root")).alias("_moved")))
        known = jumped.select("c", "root")
        if not jumped.where("_moved").limit(1).count():
            return known


def spanning_tree(
    rows: DataFrame, key: str, vector: str, block_rows: int = BLOCK_ROWS, task_edges: int = TASK_EDGES
) -> DataFrame:
    """(a, b, height): the edges of the minimum spanning tree, a < b; one fewer than rows."""
    kind = rows.schema[key].dataType.simpleString()
    none = rows.sparkSession.createDataFrame([], f"a {kind}, b {kind}, height double")
    rows = rows.where(F.col(vector).isNotNull())
    first = stage(rows.groupBy(F.col(vector).alias(vector)).agg(F.min(key).alias("_first")))
    copies = rows.join(first, vector).where(F.col(key) != F.col("_first"))
    tree = none.union(copies.select("_first", key, F.lit(0.0)))
    total = first.count()
    if total < 2:
        return tree
    blocks = max(-(-total // block_rows), min(BLOCKS, -(-total // FEWEST)))
    vectors = first.select(F.col("_first").alias("u"), F.col(vector).cast("array<double>").alias("vec"))
    # Components c and e are at first rows; of the edges between two of them only the shortest stays.
    edges = stage(_edges(vectors, blocks).select(F.col("a").alias("c"), F.col("b").alias("e"), F.struct("d", "a", "b").alias("edge")))
    while edges.count() > task_edges:
        both = edges.union(edges.select("e", "c", "edge"))
        chosen = stage(both.groupBy("c").agg(F.min(F.struct("edge", "e")).alias("best")).select("c", "best.*"))
        tree = tree.union(chosen.select("edge.a", "edge.b", "edge.d").distinct())
        roots = stage(_roots(chosen.select("c", F.col("e").alias("parent"))))
        joined = edges.join(roots, "c").select(F.col("root").alias("c"), "e", "edge")
        joined = joined.join(roots.withColumnRenamed("c", "e"), "e").select("c", F.col("root").alias("e"), "edge").where("c <> e")
        ends = joined.select(F.least("c", "e").alias("c"), F.greatest("c", "e").alias("e"), "edge")
        edges = stage(ends.groupBy("c", "e").agg(F.min("edge").alias("edge")))
    return tree.union(_finished(edges))


def _joined_ends(kept: DataFrame, kind: str) -> DataFrame:
    """(u, least): the smallest key that few edges (a, b) lead to, for every key in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches) or [pa.RecordBatch.from_pylist([], schema=pa.schema([]))])
        if len(found):
            every, a, b = _numbered_edges(found, "a", "b")
            _, label = _forest(a, b, np.arange(len(found)), len(every))
            least = np.full(len(every), len(every))
            np.minimum.at(least, label, np.arange(len(every)))
            yield pa.RecordBatch.from_pydict({"u": pa.array(every), "least": pa.array(every[least[label]])})

    return kept.coalesce(1).mapInArrow(run, f"u {kind}, least {kind}")


def cut(tree: DataFrame, rows: DataFrame, key: str, height: float, task_edges: int = TASK_EDGES) -> DataFrame:
    """(key, cluster): what single linkage has merged up to ``height``; a cluster is named by its smallest key."""
    kept = stage(tree.where(F.col("height") <= height).select("a", "b"))
    if kept.count() <= task_edges:
        found = stage(_joined_ends(kept, rows.schema[key].dataType.simpleString()))
        every = rows.select(F.col(key).alias("u")).distinct().join(found, "u", "left")
        return every.select(F.col("u").alias(key), F.coalesce("least", "u").alias("cluster"))
    label = stage(rows.select(F.col(key).alias("u"), F.col(key).alias("c")).distinct())
    while True:
        # Neighbours' labels, then the label of the label: chains halve while labels sink to the least.
        ends = kept.select(F.col("a").alias("u"), F.col("b").alias("v")).union(kept.select("b", "a"))
        theirs = ends.join(label.select(F.col("u").alias("v"), F.col("c").alias("_n")), "v").groupBy("u").agg(F.min("_n").alias("_n"))
        lower = label.join(theirs, "u", "left").select("u", "c", F.least("c", F.coalesce("_n", "c")).alias("_l"))
        jump = lower.select(F.col("u").alias("_l"), F.col("_l").alias("_j"))
        moved = stage(lower.join(jump, "_l").select("u", F.least("_l", "_j").alias("c"), (F.least("_l", "_j") != F.col("c")).alias("_moved")))
        label = moved.select("u", "c")
        if not moved.where("_moved").limit(1).count():
            return label.select(F.col("u").alias(key), F.col("c").alias("cluster"))
