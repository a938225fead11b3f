"""Periodic runs, against brute force over all periods and starts."""

import hashlib
import random
import time
import zlib

from plainloom.llm.runs import long_runs, runs_of, scan

SCHEMA = "doc_id long, text string"


def brute(words):
    """All runs of at least two periods."""
    n, out = len(words), set()
    for p in range(1, n // 2 + 1):
        for start in range(n - p):
            stop = start
            while stop + p < n and words[stop] == words[stop + p]:
                stop += 1
            size = stop - start + p
            leftmost = start == 0 or words[start - 1] != words[start - 1 + p]
            smaller = any(all(words[t] == words[t + q] for t in range(start, start + size - q)) for q in range(1, p))
            if size >= 2 * p and leftmost and not smaller:
                out.add((start, size, p))
    return out


def chosen(words):
    return sorted((r for r in brute(words) if r[1] >= max(6, 4 * r[2])), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    draw = random.Random(1)
    for _ in range(800):
        k = draw.randint(1, 4)
        words = [draw.randrange(k) for _ in range(draw.randint(0, 30))]
        unit = [draw.randrange(k) for _ in range(draw.randint(1, 6))]
        words = words[:8] + unit * draw.randint(0, 7) + words[8:]
        found = runs_of(words)
        assert len(found) == len(set(found)) and set(found) == brute(words)
        assert long_runs([b"%d" % w for w in words]) == chosen(words)


def row_of(doc_id, text):
    words = [w for w in (text or "").translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = chosen(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_equals_brute_force_with_odd_rows(spark):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choices("abcdefghijkl", k=draw.randint(0, 60)))) for i in range(250)]
    rows += [(1, "x x x x x x\ny y y"), (1, "x x x x x x\ny y y"), (None, "q q q q q q q"), (None, None), (7, None), (8, " \t\n"), (9, "é é é é " * 9)]
    docs = spark.createDataFrame([(*r, 5, "k") for r in rows], f"{SCHEMA}, n_runs int, words string").repartition(3)
    got = sorted((tuple(r) for r in scan(docs, planted=True).collect()), key=repr)
    assert got == sorted((row_of(*r) for r in rows), key=repr)
    assert any(r[1] for r in got) and scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_own_outputs(spark):
    row = scan(spark.createDataFrame([(1, "go " + "a b " * 4 + "end")], SCHEMA), with_text=True).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 8, 2)] and row["collapsed"] == "go a b end"


def test_long_texts_take_seconds():
    draw = random.Random(2)
    began = time.time()
    for words in ([b"a"] * 300_000, [b"%d" % draw.randrange(2) for _ in range(150_000)], [b"%d" % (i % 999) for i in range(300_000)], [b"%d" % draw.randrange(10**6) for _ in range(300_000)]):
        long_runs(words)
    assert time.time() - began < 60
