"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a longest stretch of words that repeats itself with a smallest period. Words are
appended to a suffix automaton one by one. Its suffix links form a tree, kept as a
link-cut tree whose preferred paths are the suffixes that last occurred at one end.
Access to the state of the newest prefix walks these path segments and recolours them
with the new end. A segment with previous end e and longest length l, at distance
q = end - e <= l, says that the last q + l words have smallest period q: a square. No
longer suffix recurs there, so the stretch cannot be extended to the left; it is a run if
the next word does not continue the period.

A run of at least four periods and six words holds each of its five-word windows at least
twice (a run of n words with period q does if n >= 2q + 4). Words outside every window
that recurs within its own stretch therefore lie in no such run, and only the stretches
that are left go through the automaton. Equal hashes of windows can only leave more.

Nulls and empty texts have no words, no runs and two digests of the empty string. A null
doc_id counts as one without planted period. Repeated rows are treated each. Very long
texts cost n log n steps. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import each_text, whole

LEAST_PERIODS = 4
LEAST_WORDS = 6
#: Words of the windows that must recur; at most 5 for the two limits above.
WINDOW = 5

Run = tuple[int, int, int]  # start, length, period


def runs_of(words: Sequence[int]) -> list[Run]:
    """All runs of at least two periods, by the end of the run. Words are any hashable values.

    States are numbered from 1 (the empty word); 0 stands for none. A state mostly has
    one continuation, so the first is kept in two lists and only further ones in a dict.
    """
    n = len(words)
    length, link = [0, 0], [0, 0]  # longest suffix of the state; its suffix link
    first, first_to, further = [None, None], [0, 0], {}
    left, right, up, end = [0, 0], [0, 0], [0, 0], [0, -1]  # link-cut tree; end counts at the root of a path's splay tree
    found: list[Run] = []

    def follow(state, word):
        if first_to[state] and first[state] == word:
            return first_to[state]
        more = further.get(state)
        return more.get(word, 0) if more else 0

    def point(state, word, to):
        if not first_to[state] or first[state] == word:
            first[state], first_to[state] = word, to
        else:
            further.setdefault(state, {})[word] = to

    def new(longest, suffix):
        length.append(longest)
        link.append(suffix)
        first.append(None)
        first_to.append(0)
        left.append(0)
        right.append(0)
        up.append(suffix)
        end.append(-1)
        return len(length) - 1

    def splay(x):
        """Make x the root of its path's splay tree; the end of the path goes with the root."""
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            top = not g or (left[g] != p and right[g] != p)
            if not top:
                pivot = p if (left[g] == p) == (left[p] == x) else x
                rotate(pivot)
                rotate(x)
            else:
                rotate(x)

    def rotate(x):
        p = up[x]
        g = up[p]
        if left[p] == x:
            c = left[p] = right[x]
            right[x] = p
        else:
            c = right[p] = left[x]
            left[x] = p
        if c:
            up[c] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
            else:
                end[x] = end[p]
        else:
            end[x] = end[p]

    last = 1
    for at in range(n):
        word = words[at]
        # Append the word to the automaton.
        state = new(at + 1, 1)
        p = last
        while p and not (q := follow(p, word)):
            point(p, word, state)
            p = link[p]
        if p:
            if length[q] == length[p] + 1:
                link[state] = up[state] = q
            else:
                # Split q: its shorter suffixes become a state of their own, next above it on its path.
                splay(q)
                clone = new(length[p] + 1, link[q])
                first[clone], first_to[clone] = first[q], first_to[q]
                if q in further:
                    further[clone] = dict(further[q])
                above = left[q]
                left[clone], left[q], up[clone] = above, clone, q
                if above:
                    up[above] = clone
                link[q] = link[state] = up[state] = clone
                while p and follow(p, word) == q:
                    point(p, word, clone)
                    p = link[p]
        last = state
        # Access the new state; each segment on the way up has one last end.
        below, x = state, up[state]
        while x:
            splay(x)
            period = at - end[x]
            if period <= length[x] and (at + 1 == n or words[at + 1] != words[at + 1 - period]):
                found.append((at + 1 - period - length[x], period + length[x], period))
            cut = right[x]
            if cut:
                end[cut] = end[x]
            right[x] = below
            below, x = x, up[x]
        splay(state)
        end[state] = at
    return found


def recurring(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the stretches outside which no window of ``WINDOW`` words recurs within its stretch."""
    todo = [(0, len(words))]
    while todo:
        start, stop = todo.pop()
        if stop - start < LEAST_WORDS:
            continue
        part = words[start:stop].astype(np.uint64)
        windows = np.zeros(len(part) - WINDOW + 1, dtype=np.uint64)
        for k in range(WINDOW):
            windows = windows * np.uint64(0x9E3779B97F4A7C15) + part[k : len(part) - WINDOW + 1 + k]
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[which] > 1)
        if len(twice) == len(windows):
            yield start, stop
            continue
        breaks = np.flatnonzero(np.diff(twice) > 1)
        firsts = twice[np.concatenate([[0], breaks + 1])] if len(twice) else []
        lasts = twice[np.concatenate([breaks, [len(twice) - 1]])] if len(twice) else []
        todo += [(start + int(a), start + int(b) + WINDOW) for a, b in zip(firsts, lasts)]


def long_runs(words: Sequence[bytes]) -> list[Run]:
    """The runs of at least ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods, by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    numbers: dict[bytes, int] = {}
    coded = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), dtype=np.int64, count=len(words))
    found = []
    for start, stop in recurring(coded):
        for first, length, period in runs_of(coded[start:stop].tolist()):
            if length >= max(LEAST_WORDS, LEAST_PERIODS * period):
                found.append((start + first, length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def plant(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the tail of every tenth document made periodic, by the checksum of its id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % period] for i in range(a, n)]


def highest(found: Sequence[Run]) -> Run | None:
    """The run with the greatest length / period, compared exactly; on ties the smallest start, then period."""
    best = None
    for run in found:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: Sequence[bytes], found: Sequence[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, inside in zip(words, np.cumsum(change)) if not inside]


_SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def scan(docs: DataFrame, planted: bool = False, with_text: bool = False) -> DataFrame:
    """A row per document: its runs' number and digest, its highest run, and the digest of the collapsed text.

    ``with_text`` adds the runs (array of start, length, period) and the collapsed text
    itself. ``planted`` first makes the tails of some documents periodic, see ``plant``.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in each_text(batches, "text"):
            columns: list[list] = [[] for _ in range(9)]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                words = text.encode().split()
                if planted:
                    words = plant(words, doc_id)
                found = long_runs(words)
                best = highest(found)
                left = b" ".join(collapse(words, found))
                listed = "".join(f"{s},{l},{p}\n" for s, l, p in found).encode()
                values = [len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None]
                values += [hashlib.sha256(listed).hexdigest(), hashlib.sha256(left).hexdigest(), found, left.decode()]
                for column, value in zip(columns, values):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            arrays = [batch.column("doc_id")] + [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            names = [part.split()[0] for part in _SCHEMA.split(", ")]
            if with_text:
                triple = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
                arrays.append(pa.array([[dict(zip(("start", "length", "period"), r)) for r in c] for c in columns[7]], triple))
                arrays.append(pa.array(columns[8], pa.string()))
                names += ["runs", "collapsed"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = _SCHEMA + (", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string" if with_text else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text")).mapInArrow(each, schema)
