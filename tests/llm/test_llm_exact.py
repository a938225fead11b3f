"""The digest index: batches, reopening, compaction, hot texts, odd rows."""

import hashlib

import pytest

from plainloom.llm import digest_index
from plainloom.llm.digest_index import DigestIndex
from plainloom.session import scratch, stage

SCHEMA = "doc_id long, text string"


def wanted(rows):
    out = []
    for text in {r[1] or "" for r in rows}:
        ids = [r[0] for r in rows if (r[1] or "") == text]
        best = max(ids, key=lambda i: (i is not None, i or 0))
        left = 1
        for i in ids:
            kept = i == best and left == 1
            left -= kept
            out.append((i, best, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


ODD = [(3, "a"), (9, "a"), (9, "a"), (1, None), (2, ""), (None, "a"), (None, "z"), (None, "z"), (4, "é" * 300_000), (5, "é" * 300_000), (6, "A"), (7, "a ")]


@pytest.mark.parametrize("hot", [10_000, 3])
def test_one_batch(spark, monkeypatch, hot):
    monkeypatch.setattr(digest_index, "MOST_HOT", hot)
    rows = ODD + [(100 + i, "copy") for i in range(400)] + [(1000 + i, f"t{i % 150}") for i in range(400)]
    index = DigestIndex.open(spark, scratch(spark), 4)
    assert got(index.add(spark.createDataFrame(rows, SCHEMA))) == wanted(rows)
    assert index.read().count() == len({r[1] or "" for r in rows})


def test_later_batches_are_anti_joined_and_appended(spark):
    path = scratch(spark)
    index = DigestIndex.open(spark, path, 4)
    index.add(spark.createDataFrame([(5, "a"), (7, "b"), (6, "b")], SCHEMA), "one")
    index.close()
    again = DigestIndex.open(spark, path, 4)  # as a later application finds it
    second = {r["doc_id"]: r for r in again.add(spark.createDataFrame([(90, "a"), (91, "c"), (92, "c")], SCHEMA), "two").collect()}
    assert (second[90]["keep_id"], second[90]["kept"], second[90]["group_size"]) == (5, False, 1)
    assert (second[91]["keep_id"], second[91]["kept"]) == (92, False) and second[92]["kept"]
    third = again.add(spark.createDataFrame([(90, "a"), (91, "c")], SCHEMA), "two")
    assert not any(r["kept"] for r in third.collect())
    held = lambda: sorted(tuple(r) for r in again.read().select("keep_id", "batch").collect())
    assert held() == [(5, "one"), (7, "one"), (92, "two")]
    again.compact()
    assert held() == [(5, "one"), (7, "one"), (92, "two")]
    assert len(spark.read.parquet(path).inputFiles()) <= 4
    assert again.add(spark.createDataFrame([(1, "b"), (2, "new")], SCHEMA)).where("kept").count() == 1


def test_index_is_read_by_bucket(spark):
    index = DigestIndex.open(spark, scratch(spark), 4)
    index.add(spark.createDataFrame([(i, str(i)) for i in range(50)], SCHEMA))
    other = stage(index.read().select("digest"))
    plan = other.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_empty_and_clashing_columns(spark):
    index = DigestIndex.open(spark, scratch(spark), 2)
    assert index.add(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, "x", None, 2), (2, "x", "k", None)], "doc_id long, text string, digest string, row int")
    assert got(index.add(clash)) == wanted([(1, "x"), (2, "x")])
