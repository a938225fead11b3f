"""Repeated strings by a hash-compared suffix sort.

A byte goes if it lies in a string of LENGTH bytes that starts anywhere else too. All
such strings of all texts cannot be sorted in one place, so they are dealt to places
where equal ones must meet:

1. In every string of LENGTH bytes the least hash of its strings of SEED bytes marks an
   anchor (the leftmost on ties). Neighbouring strings share their anchor; together
   they are a region. Equal strings have equal anchors at the same place.
2. Anchors and regions are counted, with sums made before the shuffle. Equal regions are
   told by a digest of 128 bits of their bytes and the anchor's place; equal texts by two
   hashes of 64 bits. A region that stands twice is covered whole. One that stands once
   goes on if its anchor stands elsewhere in another region. Regions that follow each
   other and are equal, as in a text of one repeated byte, are one row with their number.
3. Those regions, one copy of each, meet by anchor, and their suffixes are sorted:
   merge sort, in which two suffixes are compared by a binary search for their common
   extension with prefix polynomial hashes. Neighbours that agree for LENGTH bytes are
   compared byte by byte; should hashes have lied, their class is sorted by its bytes.
4. Anchors in very many regions are told apart by more than SEED bytes first. Strings
   whose anchor stands ``width`` neighbouring places deep share all but ``width`` of
   their bytes: such pieces of regions meet by those bytes as regions meet by their
   anchor, and are counted as regions are. What is still crowded is cut finer once more;
   what then remains is sorted in blocks, and strings that are alone in their block are
   matched between blocks by a digest of 128 bits.

Nulls count as empty texts. Texts shorter than LENGTH bytes lose nothing. Rows that
repeat a text are texts of their own, so each copy of a long one goes whole. An empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import whole
from plainloom.session import stage

LENGTH, SEED = 200, 40
#: Bytes of a text that are looked at at once.
PIECE = 1 << 20
#: Regions of one anchor that are sorted together, and regions a task, about.
BLOCK_REGIONS, TASK_REGIONS = 1_500, 6_000
#: Places of the anchor in a piece of a crowded region, coarse cut first.
WIDTHS = 32, 4
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_PLACES = 24  # low bits that hold a place within a piece


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWER, _BACK = _powers(PIECE + 1024, _BASE), _powers(PIECE + 1024, _INVERSE)


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """G with (G[j] - G[i]) * base^-i the polynomial hash of codes[i:j], modulo 2^64."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _POWER[: len(codes)], out=out[1:])
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _least_of_each(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors_of(raw: bytes) -> tuple[np.ndarray, ...]:
    """anchor hash, two halves of the region's digest, first start, last start, anchor place and ``run`` of every region.

    ``run`` counts the starts of the equal regions that follow at once and are left out.
    """
    found: list[tuple[np.ndarray, ...]] = []
    width = LENGTH - SEED + 1
    for at in range(0, max(len(raw) - LENGTH + 1, 0), PIECE - LENGTH + 1):
        part = raw[at : at + PIECE]
        if len(part) < LENGTH:
            break
        codes = np.frombuffer(part, dtype=np.uint8)
        sums = prefix_hashes(codes)
        seeds = _mixed((sums[SEED:] - sums[:-SEED]) * _BACK[: len(codes) - SEED + 1])
        low = np.uint64((1 << _PLACES) - 1)
        marked = (seeds & ~low) | np.arange(len(seeds), dtype=np.uint64)
        place = (_least_of_each(marked, width) & low).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        last = np.concatenate([first[1:] - 1, [len(place) - 1]])
        digests = b"".join([xxhash.xxh3_128_digest(part[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())])
        region, region2 = np.frombuffer(digests, dtype=np.uint64).reshape(-1, 2).T
        place = place[first]
        # A region cut by the end of a piece is one of its own, told apart by where its anchor lies in it.
        region = region ^ _mixed((place - first).astype(np.uint64) + np.uint64(1))
        same = (region[1:] == region[:-1]) & (region2[1:] == region2[:-1])
        heads = np.flatnonzero(np.concatenate([[True], ~same]))
        tails = np.concatenate([heads[1:] - 1, [len(first) - 1]])
        run = last[tails] - last[heads]
        columns = (seeds[place].view(np.int64), region.view(np.int64), region2.view(np.int64), first + at, last + at, place + at)
        found.append((*(c[heads] for c in columns), run))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(7))
    return tuple(np.concatenate(c) for c in zip(*found))


def _pack(first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (first << 20) | ((last - first) << 10) | (place - first)


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = packed >> 20
    return first, first + ((packed >> 10) & 1023), first + (packed & 1023)


def text_key() -> list[Column]:
    """Two hashes of 64 bits that stand for a text in joins; the second starts from another seed."""
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2")]


def find_anchors(texts: DataFrame) -> DataFrame:
    """(t1, t2, anchor, region, region2, packed, run) of the regions of (text, t1, t2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = (batch.column(c).to_numpy() for c in ("t1", "t2"))
            held: list[tuple[np.ndarray, ...]] = []
            size = 0
            for row, text in enumerate(batch.column("text").to_pylist()):
                anchor, region, region2, first, last, place, run = anchors_of(text.encode())
                if len(anchor):
                    held.append((np.full(len(anchor), row), anchor, region, region2, _pack(first, last, place), run))
                    size += len(anchor)
                if size > 200_000:
                    yield emit(held, t1, t2)
                    held, size = [], 0
            if held:
                yield emit(held, t1, t2)

    def emit(held, t1, t2) -> pa.RecordBatch:
        row, *columns = (np.concatenate(c) for c in zip(*held))
        names = ["t1", "t2", "anchor", "region", "region2", "packed", "run"]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (t1[row], t2[row], *columns)], names=names)

    return texts.mapInArrow(run, "t1 long, t2 long, anchor long, region long, region2 long, packed long, run long")


def repeated_regions(anchors: DataFrame) -> DataFrame:
    """(anchor, region, region2, twice, regions) of anchors that stand twice: ``twice`` if the region does, and how many it has."""
    counts = anchors.groupBy("anchor", "region", "region2").agg(F.sum(F.when(F.col("run") > 0, 2).otherwise(1)).alias("n"))
    totals = counts.groupBy("anchor").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("regions"))
    found = counts.join(totals.where("total > 1"), "anchor")
    return found.select("anchor", "region", "region2", (F.col("n") > 1).alias("twice"), F.col("regions").cast("int").alias("regions"))


class Suffixes:
    """Suffixes of regions in one buffer, compared by prefix hashes up to LENGTH bytes."""

    def __init__(self, regions: list[bytes]):
        sizes = np.array([len(r) for r in regions])
        self.starts = np.cumsum(sizes) - sizes
        self.codes = np.frombuffer(b"".join(regions), dtype=np.uint8)
        self.local = np.arange(len(self.codes)) - np.repeat(self.starts, sizes)
        self.sums = np.zeros(len(self.codes) + 1, dtype=np.uint64)
        np.cumsum((self.codes.astype(np.uint64) + np.uint64(1)) * _POWER[self.local], out=self.sums[1:])
        self.back = _BACK[self.local]

    def hashes(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes that two suffixes have in common, at most LENGTH: a binary search."""
        low, high = np.zeros(len(x), dtype=np.int64), np.full(len(x), LENGTH, dtype=np.int64)
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            same = self.hashes(x, middle) == self.hashes(y, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def compare(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the first suffix is smaller, equal or larger."""
        common = self.extension(x, y)
        at = np.minimum(common, LENGTH - 1)
        difference = np.sign(self.codes[x + at].astype(np.int16) - self.codes[y + at].astype(np.int16))
        return np.where(common == LENGTH, 0, difference)

    def content(self, at: int) -> bytes:
        return self.codes[at : at + LENGTH].tobytes()

    def sort(self, at: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes by (group, content), and whether each equals the one before it.

        Merge sort from single suffixes up, all runs of one length at once: each suffix
        finds by binary search how many of the neighbouring run go before it.
        """
        order = np.argsort(group, kind="stable")
        grouped = group[order]
        begin = np.flatnonzero(np.concatenate([[True], grouped[1:] != grouped[:-1]]))
        sizes = np.diff(np.append(begin, len(order)))
        start, size = np.repeat(begin, sizes), np.repeat(sizes, sizes)
        length = 1
        while len(sizes) and length < sizes.max():
            place = np.arange(len(order))
            inside = place - start
            run = inside // length
            other = start + (run ^ 1) * length  # the neighbouring run
            stop = np.minimum(other + length, start + size)
            active = np.flatnonzero((size > length) & (other < start + size))
            low, high, right = other[active].copy(), stop[active], (run[active] & 1) == 1
            mine = at[order[active]]
            todo = np.flatnonzero(low < high)
            while len(todo):
                middle = (low[todo] + high[todo]) >> 1
                sign = self.compare(at[order[middle]], mine[todo])
                before = (sign < 0) | ((sign == 0) & right[todo])  # equal ones of the left run stay before
                low[todo] = np.where(before, middle + 1, low[todo])
                high[todo] = np.where(before, high[todo], middle)
                todo = todo[low[todo] < high[todo]]
            pair = start[active] + (run[active] >> 1) * 2 * length
            target = pair + inside[active] % length + (low - other[active])
            merged = order.copy()
            merged[target] = order[active]
            order = merged
            length *= 2
        same = np.zeros(len(order), dtype=bool)
        if len(order) > 1:
            pairs = np.flatnonzero(group[order[1:]] == group[order[:-1]])
            agree = self.extension(at[order[pairs]], at[order[pairs + 1]]) == LENGTH
            same[pairs[agree] + 1] = True
            self._verify(at, group, order, same)
        return order, same

    def _verify(self, at, group, order, same) -> None:
        claimed, wrong = np.flatnonzero(same), set()
        reach = np.arange(LENGTH)
        for k in range(0, len(claimed), 8192):
            some = claimed[k : k + 8192]
            left, right = at[order[some - 1]], at[order[some]]
            equal = (self.codes[left[:, None] + reach] == self.codes[right[:, None] + reach]).all(axis=1)
            wrong |= set(group[order[some[~equal]]].tolist())
        for bad in wrong:  # hashes agreed where bytes do not
            places = np.flatnonzero(group[order] == bad)
            own = sorted(order[places].tolist(), key=lambda i: self.content(at[i]))
            order[places] = own
            contents = [self.content(at[i]) for i in own]
            same[places] = [False] + [a == b for a, b in zip(contents, contents[1:])]


def _sorted_regions(frame: pd.DataFrame) -> pd.DataFrame:
    """Stretches of starts that stand twice in the regions given, and what must meet other blocks of an anchor.

    ``covered`` tells whether such a string is known to stand twice; its equals in the
    block then are too.
    """
    suffixes = Suffixes(list(frame["content"]))
    anchor, block = frame["anchor"].to_numpy(), frame["block"].to_numpy()
    first, last, place = _unpack(frame["packed"].to_numpy())
    count = last - first + 1
    row = np.repeat(np.arange(len(frame)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    before = (place - first)[row] - offset  # bytes from the start of the string to its anchor
    kinds = np.unique(np.stack([anchor, block], axis=1), axis=0, return_inverse=True)[1].ravel()
    group = kinds[row] * 1024 + before
    order, same = suffixes.sort(suffixes.starts[row] + offset, group)
    twice = same.copy()
    twice[:-1] |= same[1:]
    hit = np.zeros(len(row), dtype=bool)
    hit[order[twice]] = True
    t1, t2, single = frame["t1"].to_numpy(), frame["t2"].to_numpy(), ~frame["twice"].to_numpy()
    found = np.flatnonzero(hit & single[row])
    # One of each class of equal strings meets the other blocks of its anchor.
    leads = np.zeros(len(row), dtype=bool)
    leads[order[~same]] = True
    lone = np.flatnonzero(leads & (frame["blocks"].to_numpy() > 1)[row])
    # Neighbouring starts of one region become one stretch.
    new = np.concatenate([[True], (np.diff(found) != 1) | (np.diff(row[found]) != 0)]) if len(found) else np.empty(0, bool)
    head = found[new]
    tail = np.append(np.flatnonzero(new)[1:] - 1, len(found) - 1)
    tail = found[tail] if len(found) else head
    stretches = pd.DataFrame({
        "t1": t1[row[head]], "t2": t2[row[head]], "start": first[row[head]] + offset[head],
        "stop": first[row[tail]] + offset[tail] + LENGTH, "lone": 0, "lone2": 0, "anchor": 0, "covered": False,
    })
    digests = b"".join([xxhash.xxh3_128_digest(suffixes.content(at)) for at in (suffixes.starts[row[lone]] + offset[lone]).tolist()])
    hashes, hashes2 = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2).T
    alone = pd.DataFrame({
        "t1": t1[row[lone]], "t2": t2[row[lone]], "start": first[row[lone]] + offset[lone],
        "stop": first[row[lone]] + offset[lone] + LENGTH, "lone": hashes | 1, "lone2": hashes2, "anchor": anchor[row[lone]] * 1024 + before[lone],
        "covered": hit[lone] | ~single[row[lone]],
    })
    return pd.concat([stretches, alone])


def cut_regions(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """Content of the marked regions: (anchor, region, region2, twice, regions, packed, t1, t2, content), one row a region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, taken, content, size = [], [], [], 0
            marked = batch.column("marks").to_pylist()
            for row, (text, own) in enumerate(zip(batch.column("text").to_pylist(), marked)):
                raw = text.encode()
                for mark in own:
                    first, last = mark["packed"] >> 20, (mark["packed"] >> 20) + ((mark["packed"] >> 10) & 1023)
                    rows.append(row)
                    taken.append(mark)
                    content.append(raw[first : last + LENGTH])
            where = pa.array(rows, pa.int64())
            columns = [batch.column(c).take(where) for c in ("t1", "t2")]
            columns += [
                pa.array([m[c] for m in taken], t)
                for c, t in (("anchor", pa.int64()), ("region", pa.int64()), ("region2", pa.int64()), ("twice", pa.bool_()), ("regions", pa.int32()), ("packed", pa.int64()))
            ]
            names = ["t1", "t2", "anchor", "region", "region2", "twice", "regions", "packed", "content"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(content, pa.binary())], names=names)

    joined = texts.join(marks, ["t1", "t2"]).select("t1", "t2", "text", "marks")
    cut = joined.mapInArrow(
        run, "t1 long, t2 long, anchor long, region long, region2 long, twice boolean, regions int, packed long, content binary"
    )
    one = F.min_by(F.struct("t1", "t2", "packed", "content"), F.struct("t1", "t2", "packed"))
    single = cut.groupBy("anchor", "region", "region2", "twice", "regions").agg(one.alias("one"))
    return single.select("anchor", "region", "twice", "regions", "one.*")


def cut_pieces(regions: DataFrame, width: int) -> DataFrame:
    """Regions cut by the depth of their anchor; strings of one piece share all but ``width`` - 1 bytes, which are its new anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, anchors, digests, packed, content = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("anchor", "packed", "content"))
            for row, (anchor, region, raw) in enumerate(zip(*columns)):
                first, last, place = _unpack(region)
                for k in range((place - last) // width, (place - first) // width + 1):
                    a, b = max(first, place - (k + 1) * width + 1), min(last, place - k * width)
                    shared = raw[place - k * width - first : place - (k + 1) * width + 1 - first + LENGTH]
                    own = raw[a - first : b - first + LENGTH]
                    rows.append(row)
                    anchors.append(xxhash.xxh3_64_digest(shared + anchor.to_bytes(8, "little", signed=True) + bytes([k])))
                    digests.append(xxhash.xxh3_128_digest(own + bytes([place - a])))
                    packed.append(_pack(a, b, place))
                    content.append(own)
            where = pa.array(rows, pa.int64())
            region, region2 = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2).T
            arrays = [pa.array(c) for c in (np.frombuffer(b"".join(anchors), dtype=np.int64), region, region2)]
            arrays += [batch.column(c).take(where) for c in ("twice", "t1", "t2")]
            arrays += [pa.array(packed, pa.int64()), pa.array(content, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "region", "region2", "twice", "t1", "t2", "packed", "content"])

    read = regions.select("anchor", "twice", "t1", "t2", "packed", "content")
    return read.mapInArrow(run, "anchor long, region long, region2 long, twice boolean, t1 long, t2 long, packed long, content binary")


def thinned(regions: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Regions that are to be sorted, crowded ones in pieces, and (t1, t2, start, stop) of pieces that stand twice.

    Of equal pieces one stays. Pieces whose shared bytes stand once go.
    """
    columns = ["anchor", "region", "twice", "regions", "packed", "t1", "t2", "content"]
    parts, covered = [regions.select(*columns)], []
    for width in WIDTHS:
        crowded = parts[-1].where(F.col("regions") > BLOCK_REGIONS)
        if crowded.isEmpty():
            break
        pieces = stage(cut_pieces(crowded, width))
        same = ["anchor", "region", "region2"]
        one = F.min_by(F.struct("t1", "t2", "packed", "content"), F.struct("t1", "t2", "packed"))
        counts = stage(pieces.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice"), one.alias("one")))
        totals = counts.groupBy("anchor").agg(F.count(F.lit(1)).cast("int").alias("regions")).where("regions > 1")
        single = counts.join(totals, "anchor").select("anchor", "region", (F.col("twice") | (F.col("n") > 1)).alias("twice"), "regions", "one.*")
        start = F.shiftright("packed", 20)
        stop = start + F.shiftright("packed", 10).bitwiseAND(F.lit(1023).cast("long")) + LENGTH
        again = pieces.where("NOT twice").drop("twice", "content").join(counts.where("n > 1").select(*same), same)
        covered.append(again.select("t1", "t2", start.alias("start"), stop.alias("stop")))
        parts[-1] = parts[-1].where(F.col("regions") <= BLOCK_REGIONS)
        parts.append(stage(single))
    return reduce(DataFrame.unionByName, parts), covered


def covered_stretches(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The texts with their keys, and (t1, t2, stretches): start and stop of covered bytes, in any order."""
    texts = docs.select(F.col("doc_id"), whole(text).alias("text")).select("doc_id", "text", *text_key())
    long_texts = texts.where(F.octet_length("text") >= LENGTH).select("t1", "t2", "text")
    known = stage(repeated_regions(find_anchors(long_texts)))
    placed = find_anchors(long_texts).join(known, ["anchor", "region", "region2"])
    mark = F.struct("packed", "anchor", "region", "region2", "twice", "regions")
    lasting = F.when(F.col("twice"), F.struct("packed", "run"))
    sought = F.when(F.col("regions") > 1, mark)
    # A set: copies of a text say the same.
    marks = stage(placed.groupBy("t1", "t2").agg(F.collect_set(lasting).alias("whole"), F.collect_set(sought).alias("marks")))
    regions = cut_regions(long_texts, marks.where(F.size("marks") > 0).select("t1", "t2", "marks"))
    regions, covered = thinned(stage(regions))
    blocks = F.ceil(F.col("regions") / BLOCK_REGIONS).cast("int")
    regions = regions.withColumn("blocks", blocks).withColumn("block", F.pmod("region", F.col("blocks")).cast("int"))
    regions = regions.drop("region", "regions")
    tasks = max(1, -(-regions.count() // TASK_REGIONS))
    dealt = regions.withColumn("task", F.pmod(F.xxhash64("anchor", "block"), F.lit(tasks)))
    found = stage(
        dealt.groupBy("task").applyInPandas(
            lambda frame: _sorted_regions(frame), "t1 long, t2 long, start long, stop long, lone long, lone2 long, anchor long, covered boolean"
        )
    )
    between = found.where("lone <> 0")
    same = ["anchor", "lone", "lone2"]
    matched = between.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    more = between.where("NOT covered").join(matched, same).select("t1", "t2", "start", "stop")
    sorted_out = found.where("lone = 0").select("t1", "t2", "start", "stop")
    for part in (more, *covered):
        sorted_out = sorted_out.unionByName(part)
    sorted_out = sorted_out.groupBy("t1", "t2").agg(F.collect_set(F.struct("start", "stop")).alias("sorted"))

    def stretch(found: Column) -> Column:
        start = F.shiftright(found["packed"], 20)
        stop = start + F.shiftright(found["packed"], 10).bitwiseAND(F.lit(1023).cast("long")) + found["run"] + LENGTH
        return F.struct(start.alias("start"), stop.alias("stop"))

    none = F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)")
    joined = marks.select("t1", "t2", "whole").join(sorted_out, ["t1", "t2"], "full")
    all_of = F.concat(F.coalesce(F.transform("whole", stretch), none), F.coalesce("sorted", none))
    return texts, stage(joined.select("t1", "t2", all_of.alias("stretches")).where(F.size("stretches") > 0))


def merged(stretches: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in stretches):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, stop in spans:
        kept.append(raw[at:start])
        at = stop
    return b"".join([*kept, raw[at:]])


def remove_repeats(docs: DataFrame, text: str = "text", with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, the kept bytes and the spans, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for one, stretches in zip(batch.column("text").to_pylist(), batch.column("stretches").to_pylist()):
                raw = one.encode()
                spans = merged(stretches or [])
                kept = without(raw, spans)
                out.append((len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept, spans))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                spans = [[{"start": a, "stop": b} for a, b in s] for s in columns[5]]
                shape = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                arrays += [pa.array(columns[4], pa.binary()), pa.array(spans, shape)]
                names += ["kept", "spans"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    texts, stretches = covered_stretches(docs, text)
    joined = texts.join(stretches, ["t1", "t2"], "left").select("doc_id", "text", "stretches")
    key = joined.schema["doc_id"].dataType.simpleString()
    more = ", kept binary, spans array<struct<start: long, stop: long>>" if with_kept else ""
    return joined.mapInArrow(run, f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{more}")
