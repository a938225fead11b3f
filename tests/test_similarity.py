"""Similar items, per-series models, back-off, wide correlations, cells of neighbours, and mended edge cases."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plainloom.functions import arrays
from plainloom.operators import aggregate, neighbours, profile, recommend, series, textstats

draw = random.Random(11)


# --- similar items


def plain_similar(items, least, top_n):
    terms = {i: Counter(t.split()) for i, t in items if t and t.split()}
    df = Counter(w for c in terms.values() for w in c)
    n = len(terms)
    vectors = {}
    for i, c in terms.items():
        raw = {w: tf * (math.log((n + 1) / (df[w] + 1)) + 1) for w, tf in c.items()}
        size = math.sqrt(sum(x * x for x in raw.values()))
        vectors[i] = {w: x / size for w, x in raw.items()}
    out = {}
    for i, v in vectors.items():
        near = []
        for j, u in vectors.items():
            cosine = sum(x * u.get(w, 0.0) for w, x in v.items())
            if i != j and cosine >= least - 1e-9:
                near.append((-round(cosine, 9), j))
        out[i] = [(j, -c) for c, j in sorted(near)[:top_n]]
    return {i: v for i, v in out.items() if v}


@pytest.mark.parametrize("least", [0.3, 0.8])
def test_similar_items_equal_brute_force(spark, least):
    words = [f"w{i}" for i in range(30)]
    weights = [1 / (i + 1) for i in range(30)]
    items = [(i, " ".join(draw.choices(words, weights, k=draw.randint(1, 8)))) for i in range(250)]
    items += [(300 + i, "w0 w1 w7") for i in range(40)] + [(400, None), (401, ""), (402, "only here")]
    df = spark.createDataFrame(items, "id long, text string")
    got = defaultdict(list)
    tokens = F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda t: t != "")
    for r in recommend.similar_items(df, "id", tokens, least, 6).orderBy("id", "rank").collect():
        got[r["id"]].append((r["similar"], pytest.approx(r["similarity"], abs=1e-9)))
    wanted = plain_similar(items, least, 6)
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in wanted.items()}
    assert dict(got) == wanted


def test_copies_and_common_words_are_not_joined_with_each_other(spark):
    """500 copies of one text are one class, and a word that all hold is in no prefix."""
    items = [(i, "same text here") for i in range(500)] + [(1000 + i, f"common a{i} b{i} c{i}") for i in range(300)]
    df = spark.createDataFrame(items, "id long, text string")
    found = recommend.similar_items(df, "id", F.split("text", " "), 0.9, 3).collect()
    assert len(found) == 1500 and all(r["similarity"] == pytest.approx(1.0) for r in found)


# --- a model per series


def test_series_models_equal_least_squares(spark):
    rows, wanted = [], {}
    for key in range(6):
        n = 3 if key == 5 else 40 + key
        y = list(np.cumsum([draw.gauss(0, 1) for _ in range(n)]))
        rows += [(key, t, float(v)) for t, v in enumerate(y)]
        x = np.array([[1, y[t - 1], y[t - 2]] for t in range(2, n)])
        b = np.linalg.solve(x.T @ x + np.eye(3), x.T @ np.array(y[2:]))
        wanted[key] = (n - 2, *b, b[0] + b[1] * y[-1] + b[2] * y[-2])
    rows += [(7, 0, 1.0), (7, 1, 2.0), (8, 0, None), (None, 0, 1.0)]
    df = spark.createDataFrame(rows, "k int, t int, v double").repartition(4)
    got = {r["k"]: (r["n"], r["intercept"], r["b1"], r["b2"], r["forecast"]) for r in series.series_models(df, ["k"], ["t"], "v").collect()}
    assert got.keys() == wanted.keys()
    assert all(got[k] == pytest.approx(wanted[k]) for k in wanted)


# --- back-off


def test_backoff_takes_the_longest_known_context(spark):
    texts = [(1, "a b c d"), (2, "a b c e"), (3, "a b c e"), (4, "x b c f"), (5, "z z z")]
    df = spark.createDataFrame(texts, "id int, text string")
    table = textstats.backoff_table(df, F.split("text", " "), 3)
    asked = spark.createDataFrame([(1, "q a b c"), (2, "x b c"), (3, "y b c"), (4, "nothing known"), (5, None), (1, "q a b c")], "id int, text string")
    tokens = F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda t: t != "")
    got = sorted((r["id"], r["size"], r["next"]) for r in textstats.backoff_next(asked, ["id"], tokens, table, 3).collect())
    assert got == [(1, 3, "e"), (1, 3, "e"), (2, 3, "f"), (3, 2, "e"), (4, 0, "b"), (5, 0, "b")]


# --- correlations


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 5))
    wide = base @ rng.normal(size=(5, 120)) + 1e6
    wide[:, 7], wide[:, 8] = 3.25, np.where(np.arange(400) == 0, 1.0, 2.0)
    names = [f"c{i}" for i in range(120)]
    rows = [tuple(None if (i * 7 + j) % 41 == 0 else float("nan") if (i + j) % 53 == 0 else float(x) for j, x in enumerate(r)) for i, r in enumerate(wide)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    import pandas as pd

    frame = pd.DataFrame(rows, columns=names, dtype=float)
    want = frame.corr()
    got = {(r["a"], r["b"]): r["corr"] for r in profile.correlation_matrix(df, names).collect()}
    assert len(got) == 120 * 120 and got["c7", "c7"] is None and got["c7", "c9"] is None and got["c3", "c3"] == 1.0
    for (a, b), r in got.items():
        w = want.loc[a, b]
        assert (r is None and (math.isnan(w) or "c7" in (a, b))) or r == pytest.approx(w, abs=1e-6)
    target = {r["column"]: r["corr"] for r in profile.correlation_with_target(df, names[:10], "c0").collect()}
    assert target["c7"] is None and target["c3"] == pytest.approx(got["c3", "c0"], abs=1e-6)


def test_profile_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 3.0, None), (None, 4.0, None)], "a double, b double, c double")
    rows = {r["column"]: r for r in profile.column_profile(df, ["a", "b", "c"], "b").collect()}
    assert rows["a"]["target_corr"] is None and rows["a"]["modal_bin"] == 0 and rows["a"]["n_null"] == 1
    assert rows["b"]["target_corr"] == pytest.approx(1.0) and rows["c"]["n"] == 0 and rows["c"]["modal_bin"] is None
    t = profile.pooled_t(df, "a", "a").first()
    assert t["t"] is None and t["dof"] == 2


# --- cells of neighbours


def test_far_cells_fall_out_on_clustered_rows(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 50, (25, 6))
    rows = centres[rng.integers(0, 25, 1500)] + rng.normal(0, 1, (1500, 6))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "id long, v array<double>")
    train, test = df.where("id >= 300"), df.where("id < 300")
    visited = []
    got = neighbours.nearest_neighbours(test, train, "id", "v", 4, visited=visited).collect()
    far = np.sqrt(((rows[:300, None] - rows[None, 300:]) ** 2).sum(axis=2))
    wanted = {(i, 300 + int(j)) for i in range(300) for j in np.argsort(far[i], kind="stable")[:4]}
    assert {(r["query"], r["neighbour"]) for r in got} == wanted
    assert sum(visited) < 0.25 * 300 * math.isqrt(1200)


# --- mended edge cases


def test_arg_max_leaves_null_scores_out(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("a", 3, 7.0), ("b", 4, None)], "g string, v int, s double")
    assert {r["g"]: r["best"] for r in aggregate.arg_max(df, ["g"], "v", "s", "best").collect()} == {"a": 3, "b": None}


def test_no_row_of_others_without_others(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "c string")
    assert {r["c"]: r["n"] for r in aggregate.top_k_and_others(df, "c", 2).collect()} == {"x": 2, "y": 1}
    assert {r["c"]: r["n"] for r in aggregate.top_k_and_others(df, "c", 1).collect()} == {"x": 2, "Others": 1}


def test_rows_without_tokens_and_repeated_rows_stay(spark):
    df = spark.createDataFrame([(1, ["running", "a"]), (2, []), (3, None), (1, ["b"])], "id int, words array<string>")
    mapping = spark.createDataFrame([("running", "run")], "term string, normal string")
    got = textstats.normalise_tokens(df, ["id"], F.col("words"), mapping).collect()
    assert sorted((r["id"], r["tokens"]) for r in got) == [(1, ["b"]), (1, ["run", "a"]), (2, []), (3, [])]
    index = spark.createDataFrame([("a", 1), ("b", 2)], "term string, token_id long")
    ids = textstats.encode_tokens(df, ["id"], F.col("words"), index).collect()
    assert sorted((r["id"], r["ids"]) for r in ids) == [(1, [1]), (1, [2]), (2, []), (3, [])]


def test_zero_vectors_and_ratings_without_votes(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0], 3.0, 0), ([1.0, 0.0], [1.0, 0.0], 4.0, 0)], "a array<double>, b array<double>, r double, v int")
    assert [r[0] for r in df.select(arrays.cosine(F.col("a"), F.col("b"))).collect()] == [0.0, 1.0]
    assert [r["weighted"] for r in recommend.weighted_rating(df, "r", "v").collect()] == [None, None]


@pytest.mark.parametrize("k", [999, 1_000, 1_500])
def test_top_per_group_below_and_above_the_limit(spark, k):
    df = spark.range(5_000).select((F.col("id") % 2).alias("g"), "id").repartition(6)
    got = textstats.top_per_group(df, ["g"], ["id"], k).groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m")).collect()
    assert {r["g"]: (r["n"], r["m"]) for r in got} == {0: (k, 2 * k - 2), 1: (k, 2 * k - 1)}


def test_nearest_rows_of_copies_and_of_large_offsets():
    rng = np.random.default_rng(7)
    others = np.concatenate([np.repeat(rng.normal(size=(1, 8)), 40, axis=0), rng.normal(size=(60, 8))]) + 1e4
    rows = np.concatenate([others[:3], rng.normal(size=(20, 8)) + 1e4])
    row, other, far = neighbours._nearest(rows, others, 5)
    every = neighbours.distances(rows, others)
    wanted = np.argsort(every, axis=1, kind="stable")[:, :5]
    assert other.reshape(-1, 5).tolist() == wanted.tolist() and far.reshape(-1, 5).tolist() == np.take_along_axis(every, wanted, axis=1).tolist()


def test_cells_of_a_large_table_keep_rows_enough(spark, monkeypatch):
    # with a centre for sqrt(n) rows a query of unclustered rows is sent to as many cells
    monkeypatch.setattr(neighbours, "FEW_CENTRES", 2)
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rng.normal(size=(900, 16)))], "id long, v array<double>")
    visited = []
    got = neighbours.nearest_neighbours(df.where("id < 20"), df, "id", "v", 3, visited=visited).collect()
    assert len(got) == 60 and sum(visited) <= 40


def test_terms_of_a_row_of_its_own_are_not_shuffled(spark):
    rows = [(1, "b a b"), (2, "a"), (2, "a c"), (None, "x"), (None, "x y"), (3, ""), (4, None), (5, "z z z")]
    df = spark.createDataFrame(rows, "id int, t string")
    tf = textstats.term_frequencies(df, "id", F.filter(F.split("t", " "), lambda w: w != ""))
    wanted = {(1, "a", 1), (1, "b", 2), (2, "a", 2), (2, "c", 1), (None, "x", 2), (None, "y", 1), (5, "z", 3)}
    got = [tuple(r) for r in tf.collect()]
    assert set(got) == wanted and len(got) == len(wanted)
    alone = textstats.term_frequencies(df.where("id IN (1, 5)"), "id", F.split("t", " "))
    plan = alone._jdf.queryExecution().executedPlan().toString()
    # the only shuffle of terms is that of the rows that share a key
    assert plan.count("hashpartitioning(id") == 1 and {tuple(r) for r in alone.collect()} == {(1, "a", 1), (1, "b", 2), (5, "z", 3)}


def test_map_leaves_out_tokens_the_rule_keeps(spark):
    df = spark.createDataFrame([(["running", "a", "cars"],), (["a", "running"],)], "w array<string>")
    found = textstats.vocabulary_map(df, F.col("w"), lambda w: F.regexp_replace(w, "(ning|s)$", ""))
    assert sorted(tuple(r) for r in found.collect()) == [("cars", "car"), ("running", "run")]
