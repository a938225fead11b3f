"""Ranked lexical search by bag deduplication.

For a set of items, a document matters only by its bag: the terms it shares with the
items' vocabulary, their occurrences, and the length norm m. Documents with the same
bag and m form one class, found by hash and told apart by the whole bag. A class is
scored once for each item; of the ten best classes of an item (ties: smallest doc_id of
a member) the members are then listed by ascending doc_id. This is exact: with ten
classes before it, each with a member before its own, no member of a class is among the
ten highest documents.

Items are taken in blocks whose table of weights has at most ``BLOCK_CELLS`` cells, one item
at least, so what a task holds is bounded; a block is a pass over the documents.

A null or empty text has no terms: such a document counts nowhere and such an item has
no rows. Documents and items that occur twice are two each (results of equal items
repeat). Null doc_ids come last among equal scores. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plainloom.llm.common import each_text, whole
from plainloom.session import stage

#: Terms times items of one block.
BLOCK_CELLS = 4_000_000
#: Lists of the best are first cut within so many parts of an item.
PARTS = 64
#: Documents that are scored in one matrix product.
CHUNK = 512
# A to Z to lower case, the other letters, digits and bytes of wider characters as they are, all else to a space.
_AS_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
_PAIR = np.dtype([("term", "<u4"), ("tf", "<u4")])


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_AS_TERMS).split()


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms) and bag (pairs of term number and occurrences, by number) of every row."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in each_text(batches, "text"):
            sizes, made = [], []
            for text in texts:
                words = terms_of(text)
                sizes.append(len(words))
                pairs = sorted((vocabulary[t], c) for t, c in Counter(words).items() if t in vocabulary)
                made.append(np.array(pairs, dtype=_PAIR).tobytes())
            arrays = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "bag"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    return texts.mapInArrow(bag, "doc_id bigint, n bigint, bag binary")


def document_counts(rows: DataFrame) -> DataFrame:
    """term and df: in how many bags a term stands. One row per task and term is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column("bag").to_pylist()), dtype=_PAIR)["term"]
            here = np.bincount(held, minlength=len(total))
            here[: len(total)] += total
            total = here
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["term", "df"])

    return rows.select("bag").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def weight_of(holding: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def product(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact product of whole-numbered matrices: in floats while no sum can reach 2**53, else in 64-bit integers."""
    bound = float(np.abs(values).max(initial=0)) * float(np.abs(weights).sum(axis=0).max(initial=0))
    if bound < 2.0**53:
        return (values.astype(np.float64) @ weights.astype(np.float64)).astype(np.int64)
    return values @ weights


def score_classes(classes: DataFrame, weights: np.ndarray, k: int) -> DataFrame:
    """item, score and class (h, m, bag, least) of the k best classes of every item in each task.

    ``weights`` has a row per term and a column per item: occurrences in the item times w.
    """
    n_items = weights.shape[1]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, list[tuple]] = defaultdict(list)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h", "m", "bag", "least")]
            for first in range(0, len(columns[0]), CHUNK):
                rows = list(zip(*(c[first : first + CHUNK] for c in columns)))
                pairs = [np.frombuffer(r[2], dtype=_PAIR) for r in rows]
                row = np.repeat(np.arange(len(rows)), [len(p) for p in pairs])
                pairs = np.concatenate(pairs)
                norms = np.array([r[1] for r in rows], dtype=np.int64)[row]
                used, column = np.unique(pairs["term"], return_inverse=True)
                tf = pairs["tf"].astype(np.int64)
                values = np.zeros((len(rows), len(used)), dtype=np.int64)
                values[row, column] = 1_000_000_000 * tf // (1000 * tf + 8 * norms)
                scores = product(values, weights[used])
                for item in range(n_items):
                    held, of_item = top[item], scores[:, item]
                    # The k-th score so far bounds what can still enter; equal ones may, by a smaller doc_id.
                    floor = held[-1][0] if len(held) >= k else 1
                    able = np.flatnonzero(of_item >= floor)
                    if len(able) > k:
                        kth = np.partition(of_item[able], len(able) - k)[len(able) - k]
                        able = able[of_item[able] >= kth]
                    held += [(int(of_item[i]), *rows[i]) for i in able]
                    held.sort(key=lambda s: (-s[0], s[4] is None, s[4] or 0))
                    del held[k:]
        found = [(item, *s) for item, held in top.items() for s in held]
        names, kinds = ["item", "score", "h", "m", "bag", "least"], [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
        arrays = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return classes.mapInArrow(best, "item int, score bigint, h bigint, m bigint, bag binary, least bigint")


def first_k(rows: DataFrame, by: list[str], order: list, k: int, name: str, deal: list[str]) -> DataFrame:
    """The k first rows of every group, numbered; each group is first cut in ``PARTS`` parts."""
    part = F.pmod(F.xxhash64(*deal), F.lit(PARTS))
    within = Window.partitionBy(*by, "_part").orderBy(*order)
    cut = rows.withColumn("_part", part).withColumn("_rank", F.row_number().over(within)).where(F.col("_rank") <= k)
    over = Window.partitionBy(*by).orderBy(*order)
    return cut.drop("_part", "_rank").withColumn(name, F.row_number().over(over)).where(F.col(name) <= k)


def blocks_of(items: DataFrame, cells: int) -> Iterator[list[tuple[object, Counter]]]:
    """The items with their terms, in runs whose terms times items stay within ``cells``; streamed to the driver."""
    block: list[tuple[object, Counter]] = []
    held: set[bytes] = set()
    for item in items.select("item_id", "text").toLocalIterator():
        terms = Counter(terms_of(item["text"] or ""))
        if block and len(held | terms.keys()) * (len(block) + 1) > cells:
            yield block
            block, held = [], set()
        block.append((item["item_id"], terms))
        held |= terms.keys()
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` highest documents of every item (item_id, text)."""
    spark = docs.sparkSession
    key = items.schema["item_id"].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {key}, rank int, doc_id long, score long")
    for block in blocks_of(items, block_cells):
        ids = spark.createDataFrame([(item_id, i) for i, (item_id, _) in enumerate(block)], f"item_id {key}, item int")
        ranked = _search_block(docs, [terms for _, terms in block], k).join(F.broadcast(ids), "item")
        found = found.unionByName(ranked.select("item_id", "rank", "doc_id", "score"))
    return found


def _search_block(docs: DataFrame, items: list[Counter], k: int) -> DataFrame:
    terms = sorted(set().union(*items))
    vocabulary = {t: i for i, t in enumerate(terms)}
    rows = stage(bags(docs, vocabulary))
    documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros((len(terms), len(items)), dtype=np.int64)
    holding = dict(document_counts(rows).collect())  # no more rows than the block has terms
    for i, item in enumerate(items):
        for term, times in item.items():
            weights[vocabulary[term], i] = times * weight_of(holding.get(vocabulary[term], 0), documents)
    m = F.expr(f"25 + (75 * n * {documents}L) div {max(length, 1)}L")
    rows = rows.where("length(bag) > 0").select("doc_id", m.alias("m"), "bag", F.xxhash64("bag").alias("h"))
    classes = stage(rows.groupBy("h", "m", "bag").agg(F.min("doc_id").alias("least")))
    order = [F.desc("score"), F.asc_nulls_last("least")]
    chosen = stage(first_k(score_classes(classes, weights, k), ["item"], order, k, "place", ["h", "m"]))
    by = ["h", "m", "bag"]
    members = rows.join(chosen.select(*by).distinct(), by, "left_semi")
    members = first_k(members, by, [F.asc_nulls_last("doc_id")], k, "_nth", ["doc_id"])
    expanded = chosen.select("item", "score", *by).join(members.select("doc_id", *by), by).drop(*by)
    over = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return expanded.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= k)
