"""Ranked search by classes of bags, against a plain scorer."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from plainloom.llm import lexical
from plainloom.llm.lexical import search

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(docs, items, k=10):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    length = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * n_docs) // max(length, 1)
            score = 0
            for t in terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("cells", [lexical.BLOCK_CELLS, 30])
def test_against_a_plain_scorer(spark, cells):
    draw = random.Random(3)
    words = ["ab", "Cd", "ef9", "É", "éx", "lo", "mi", "nu", "ox", "pi"]
    docs = [(i, " ".join(draw.choices(words, weights=range(1, 11), k=draw.randint(0, 12)))) for i in range(150)]
    docs += [(500 - i, "ab ab Cd") for i in range(40)] + [(600 + i, "cd-AB_ab") for i in range(40)]  # one class
    docs += [(3, "ab"), (3, "ab"), (None, "pi pi"), (None, None), (700, ""), (701, "§" * 5 + " ab " * 40_000)]
    items = [(1, "ab cd"), (2, "É pi pi pi"), (2, "É pi pi pi"), (3, None), (4, ""), (5, "nowhere"), (None, "LO mi"), (6, "ab ab ab ef9")]
    got = search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_cells=cells)
    assert found(got) == plain(docs, items)


def test_many_equal_scores(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK", 7)
    docs = [(1000 - i, f"alpha filler{i}") for i in range(60)] + [(2000 + i, "alpha other") for i in range(60)]
    items = [(1, "alpha"), (2, "filler3 alpha")]
    got = search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), k=4)
    assert found(got) == plain(docs, items, 4)


def test_empty_tables_and_clashing_columns(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b", 3, "x")], "doc_id long, text string, n int, bag string")
    asked = spark.createDataFrame([(7, "A", None)], "item_id long, text string, rank int")
    assert search(docs, items).collect() == [] and search(docs, asked).collect() == [] and search(some, items).collect() == []
    assert found(search(some, asked)) == plain([(1, "a b")], [(7, "A")])


def test_products_beyond_floats_are_exact():
    values, weights = np.array([[1_000_000, 999_999]]), np.array([[10**10], [10**10 + 1]])
    assert lexical.product(values, weights)[0, 0] == 10**16 + 999_999 * (10**10 + 1)
