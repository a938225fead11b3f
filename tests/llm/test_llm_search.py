"""Nearest neighbours and the pipeline, against brute force."""

import numpy as np
import pytest

import corpus_pipeline
from plainloom.llm import bpe, forest, mixing, secrets, simhash
from plainloom.session import ship, table


def exact(vectors, ids, queries, k):
    out = {}
    unit = {i: v / np.linalg.norm(v) for i, v in zip(ids, vectors)}
    for q in queries:
        near = sorted(((-float(unit[q] @ unit[i]), i) for i in ids if i != q))[:k]
        out[q] = [i for _, i in near]
    return out


@pytest.mark.parametrize("block", [8_192, 90])
def test_recall_and_scores(spark, block):
    ship(spark)
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((20, 24))
    vectors = centres[draw.integers(0, 20, 600)] + 0.3 * draw.standard_normal((600, 24))
    rows = [(i, [float(x) for x in v], i) for i, v in enumerate(vectors)]
    bad = [(900, None, 0), (950, [0.0] * 24, 0), (1000, [float("nan")] * 24, 0), (1050, [None] * 24, 0), (None, rows[0][1], 0), (1100, [1.0], 0)]
    table_ = spark.createDataFrame(rows + bad + rows[:9], "vec_id long, embedding array<double>, part int")
    usable = forest.usable(table_)
    assert usable.count() == 600
    got = forest.neighbours(usable, usable.where("vec_id % 50 = 0"), k=5, block_rows=block).collect()
    wanted = exact(vectors, range(600), range(0, 600, 50), 5)
    found = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in wanted}
    assert all(len(f) == 5 for f in found.values())
    assert sum(len(set(found[q]) & set(wanted[q])) for q in wanted) >= 0.9 * 5 * len(wanted)
    for r in got:
        a, b = vectors[r["query_id"]], vectors[r["vec_id"]]
        assert abs(r["score"] - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def recall_and_share(spark, vectors, queries_each=50, k=5):
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    usable = forest.usable(rows)
    got = forest.neighbours(usable, usable.where(f"vec_id % {queries_each} = 0"), k, with_examined=True).collect()
    wanted = exact(vectors, range(len(vectors)), range(0, len(vectors), queries_each), k)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = sum(len(found[q] & set(w)) for q, w in wanted.items()) / (k * len(wanted))
    return recall, np.mean([r["examined"] for r in got]) / len(vectors)


@pytest.mark.parametrize("prefix_rows", [4_096, 64])
def test_few_rows_are_examined_where_there_are_near_ones(spark, monkeypatch, prefix_rows):
    ship(spark)
    monkeypatch.setattr(forest, "PREFIX_ROWS", prefix_rows)
    draw = np.random.default_rng(6)
    centres = draw.standard_normal((250, 32))
    vectors = centres[draw.integers(0, 250, 5_000)] + 0.15 * draw.standard_normal((5_000, 32))
    recall, share = recall_and_share(spark, vectors)
    assert recall >= 0.9 and share < 0.1


def test_rows_without_structure_are_found_too(spark):
    ship(spark)
    recall, share = recall_and_share(spark, np.random.default_rng(7).standard_normal((2_000, 32)))
    assert recall >= 0.9 and share <= 1


def test_common_bits_and_copies(spark):
    ship(spark)
    draw = np.random.default_rng(8)
    for _ in range(200):
        a, bits = int(draw.integers(0, 1 << 48)), int(draw.integers(0, 49))
        b = a ^ (int(draw.integers(0, 1 << (47 - bits))) | 1 << (47 - bits)) if bits < 48 else a
        assert forest.common_bits(np.array([b]), a)[0] == bits
    # A third of the rows is one vector; other rows are near it, and all strings of a tree may be equal.
    base = draw.standard_normal(16)
    vectors = [base] * 700 + [base + 1e-5 * draw.standard_normal(16) for _ in range(700)] + list(draw.standard_normal((700, 16)))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    usable = forest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5))
    got = forest.neighbours(usable, usable.where("vec_id % 350 = 0"), k=5).collect()
    assert len(got) == 30
    assert sorted(r["vec_id"] for r in got if r["query_id"] == 350) == [0, 1, 2, 3, 4]
    assert sorted(r["vec_id"] for r in got if r["query_id"] == 0) == [1, 2, 3, 4, 5]
    assert all(r["score"] > 0.99 for r in got if r["query_id"] < 1_400)


def test_ties_and_few_candidates(spark):
    ship(spark)
    rows = spark.createDataFrame([(i, [1.0, 2.0]) for i in (50, 3, 8, 1)], "vec_id long, embedding array<double>")
    usable = forest.usable(rows)
    got = forest.neighbours(usable, usable.where("vec_id % 50 = 0"), k=5).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 3), (3, 8)]
    nothing = forest.usable(rows.limit(0))
    assert forest.neighbours(nothing, nothing, k=5).count() == 0


def test_pipeline_stages_take_effect(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, docs
    seen = {}
    from plainloom.session import stage

    for name, function in corpus_pipeline.STAGES:
        seen[name] = after = stage(function(spark, before, sf_dir))
        if name != "tokens":
            assert after.columns == columns
        before = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "secrets", "mixing", "tokens"]
    assert seen["quality"].count() <= docs.count()
    classes = simhash.near_duplicates(seen["quality"]).select("component_id").distinct().count()
    assert seen["near_copies"].count() == classes
    left = secrets.scan(seen["secrets"]).agg({"n_assign": "sum", "n_access": "sum", "n_hex": "sum"}).first()
    assert not any(left)
    copies = mixing.plan_mix(seen["secrets"]).agg({"copies": "sum"}).first()[0]
    assert seen["mixing"].count() == copies == seen["tokens"].count()
    merges = bpe.load(open(corpus_pipeline.VOCABULARY).read())
    texts = {r["doc_id"]: r["text"] for r in seen["mixing"].collect()}
    for r in seen["tokens"].collect():
        assert list(r["ids"]) == merges.encode(texts[r["doc_id"]] or "").tolist()


def test_every_operator_has_its_query():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
