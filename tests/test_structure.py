"""Linkage trees, word vectors and mergeable profiles against plain versions."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plainloom.operators import linkage, sketches, wordvectors
from plainloom.session import scratch


def heights_of(points):
    """Single linkage by growing one tree (Prim)."""
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    inside, best, out = [0], d[0].copy(), []
    for _ in range(len(points) - 1):
        best[inside] = np.inf
        j = int(best.argmin())
        out.append(float(best[j]))
        inside.append(j)
        best = np.minimum(best, d[j])
    return sorted(out)


def frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>").repartition(3)


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies"])
def test_heights_equal_single_linkage(spark, kind):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(200 if kind == "spread" else 90, 3))
    if kind == "clusters":
        points = np.concatenate([points + 50 * k for k in range(3)])
    if kind == "copies":
        points = np.concatenate([points[:60], np.repeat(points[:2], 40, axis=0)])
    rows = frame(spark, points)
    tree = linkage.spanning_tree(rows, "id", "v", 3)
    found = [r["height"] for r in tree.collect()]
    assert sorted(found) == pytest.approx(heights_of(points)) and len(found) == len(points) - 1
    height = float(np.median(found)) + 1e-9
    near = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2)) <= height
    while not (near == (wider := near @ near)).all():
        near = wider
    wanted = {i: int(np.flatnonzero(row)[0]) for i, row in enumerate(near)}
    assert {r["id"]: r["cluster"] for r in linkage.cut(tree, rows, "id", height).collect()} == wanted


def test_trees_of_one_row_and_of_none(spark):
    assert linkage.spanning_tree(frame(spark, np.zeros((1, 2))), "id", "v").collect() == []
    assert linkage.spanning_tree(frame(spark, np.zeros((1, 2))).limit(0), "id", "v").collect() == []
    assert len(linkage.spanning_tree(frame(spark, np.zeros((4, 2))), "id", "v").collect()) == 3


TEXTS = ["a b c a b", "b c d", "a a a", "x", "", "c d e f a b c d", "d d c b a"]


def plain_pairs(texts, window, least):
    words = [t.split() for t in texts]
    often = {w for w, n in Counter(w for t in words for w in t).items() if n >= least}
    pairs = Counter()
    for t in words:
        for i, a in enumerate(t):
            for j, b in enumerate(t):
                if 1 <= abs(i - j) <= window and a in often and b in often:
                    pairs[a, b] += 1
    return pairs


@pytest.mark.parametrize("window, least", [(1, 1), (2, 3), (9, 2)])
def test_cooccurrences_and_weights(spark, window, least):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    tokens = F.filter(F.split("text", " "), lambda t: t != "")
    counts = wordvectors.cooccurrences(df, tokens, window, least)
    wanted = plain_pairs(TEXTS, window, least)
    assert {(r["term"], r["context"]): r["n"] for r in counts.collect()} == dict(wanted)
    row, total = Counter(), sum(wanted.values())
    for (a, _), n in wanted.items():
        row[a] += n
    weights = {p: math.log(n * total / (row[p[0]] * row[p[1]])) for p, n in wanted.items()}
    got = {(r["term"], r["context"]): r["weight"] for r in wordvectors.ppmi(counts).collect()}
    assert got == pytest.approx({p: w for p, w in weights.items() if w > 0})


def test_vectors_span_the_leading_directions(spark):
    rng = np.random.default_rng(4)
    basis = rng.random((30, 4))
    matrix = basis @ np.diag([9.0, 5.0, 3.0, 1.0]) @ basis.T
    names = [f"w{i:02d}" for i in range(30)]
    entries = [(a, b, float(matrix[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
    weights = spark.createDataFrame(entries, "term string, context string, weight double")
    rows = {r["term"]: r["vector"] for r in wordvectors.word_vectors(weights, size=4, rounds=5).collect()}
    got = np.array([rows[n] for n in names])
    # The matrix has rank 4: inner products of its rows are those of the vectors.
    assert got @ got.T == pytest.approx(matrix @ matrix, rel=1e-6)
    more = {r["term"]: r["vector"] for r in wordvectors.word_vectors(weights, size=7, rounds=4).collect()}
    wide = np.array([more[n] for n in names])
    assert np.isfinite(wide).all() and wide @ wide.T == pytest.approx(matrix @ matrix, rel=1e-4)


def test_profiles_are_merged_from_stored_parts(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("day"), F.pmod(F.xxhash64("id"), F.lit(5_000)).alias("x"), F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.sqrt("id")).alias("y"))
    path = scratch(spark)
    sketches.sketch(df.where("day < 5"), ["x", "y"], F.col("day")).write.parquet(path)
    sketches.sketch(df.where("day >= 5"), ["x", "y"], F.col("day")).write.mode("append").parquet(path)  # what came later
    stored = spark.read.parquet(path)
    rows = {r["column"]: r for r in sketches.profile(stored, [0.1, 0.5, 0.9]).collect()}
    exact = df.toPandas()
    assert stored.count() == 14 and rows["y"]["n_null"] == 5_000 and rows["x"]["rows"] == 20_000
    for c in ("x", "y"):
        values = np.sort(exact[c].dropna().to_numpy(dtype=float))
        assert rows[c]["mean"] == pytest.approx(values.mean()) and (rows[c]["min"], rows[c]["max"]) == (values[0], values[-1])
        assert abs(rows[c]["n_distinct"] / len(np.unique(values)) - 1) < 0.08
        for p, q in zip((0.1, 0.5, 0.9), rows[c]["q"]):
            assert abs(np.searchsorted(values, q) / len(values) - p) < 0.03
    one_day = sketches.profile(stored.where("part = 1")).where("column = 'x'").first()
    assert one_day["rows"] == df.where("day = 1").count()


@pytest.mark.parametrize("task_edges", [0, 2_000_000])
def test_tree_of_many_small_blocks_and_ties(spark, task_edges):
    # whole numbers: many equal distances; the tree, edge by edge, is that of one block
    rng = np.random.default_rng(4)
    points = np.unique(rng.integers(0, 6, size=(70, 2)), axis=0).astype(float)
    rows = frame(spark, points)
    alone = linkage.spanning_tree(rows, "id", "v").collect()
    apart = linkage.spanning_tree(rows, "id", "v", 9, task_edges)
    assert sorted(apart.collect()) == sorted(alone)
    assert sorted(r["height"] for r in alone) == pytest.approx(heights_of(points))
    height = heights_of(points)[-1] - 1e-9
    found = [sorted(linkage.cut(apart, rows, "id", height, n).collect()) for n in (0, 2_000_000)]
    assert found[0] == found[1] and len({r["cluster"] for r in found[0]}) == 1 + sum(r["height"] > height for r in alone)


def test_rows_without_a_vector_stay_alone(spark):
    rows = spark.createDataFrame([(1, [0.0]), (2, None), (3, [0.5]), (4, [9.0])], "id long, v array<double>")
    tree = linkage.spanning_tree(rows, "id", "v")
    assert sorted((r["a"], r["b"], r["height"]) for r in tree.collect()) == [(1, 3, 0.5), (3, 4, 8.5)]
    assert sorted(tuple(r) for r in linkage.cut(tree, rows, "id", 1.0).collect()) == [(1, 1), (2, 2), (3, 1), (4, 4)]


def test_a_tile_of_pairs_is_grown_at_once():
    # one tree a pair of tiles, cut down to the tree of both blocks
    rng = np.random.default_rng(6)
    far = rng.uniform(size=(30, 20))
    a, b, d = linkage._grown(np.arange(50), far, 30)
    taken, label = linkage._forest(a, b, linkage._ranks(a, b, d), 50)
    assert taken.all() and len(a) == 49 and len(set(label.tolist())) == 1
