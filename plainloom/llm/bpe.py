"""Byte-pair encoding by backtracking over longest matches, and decoding by offsets.

A word is encoded left to right. The automaton gives the vocabulary entries that
start at each place; the longest is tried first and is kept if it may stand after
the token before it. If none may, the last token is taken back and its next shorter
one is tried; a place from which the rest cannot be encoded is remembered, so every
place is left at most once. Two tokens may stand side by side if the merges, applied
in their order, never join symbols across their border. An encoding in which all
neighbours may stand so is the one that the merges give.

Nulls count as empty texts; an empty text has no tokens. Texts are encoded whole, in
time proportional to their length, with or without white space. Repeated rows are encoded
each, an empty table gives no rows, and other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import each_text, whole, with_columns

#: Words held with their tokens by one worker; words beyond it are encoded each time.
KEPT_WORDS = 300_000
#: Longer words are not held.
KEPT_LENGTH = 64
_END = "\ue000"  # stands for the vocabulary's word end, as one character


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Held(dict):
    """Results of a function, the first ``KEPT_WORDS`` of short keys held."""

    def __init__(self, of: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.of = of

    def __missing__(self, key: str) -> tuple[int, ...]:
        value = self.of(key)
        if len(self) < KEPT_WORDS and len(key) <= KEPT_LENGTH:
            self[key] = value
        return value


class Merges:
    """Vocabulary, automaton, pair table and offset table of one tokenizer file."""

    def __init__(self, described: dict):
        model = described["model"]
        end = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.split = regex.compile(described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        own = lambda t: t[: -len(end)] + _END if end and t.endswith(end) else t
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            self.automaton.add_word(own(token), (i, len(own(token))))
        self.automaton.make_automaton()
        self.joins: dict[tuple[int, int], int] = {}  # two tokens -> place of their merge in the list
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> its two parts and that place
        for place, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            self.joins[a, b] = place
            self.parts.setdefault(made, (a, b, place))
        self.fits: dict[tuple[int, int], bool] = {}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        written = [f"{names.get(i, '')} ".encode() for i in range(max(names) + 1)]
        self.buffer = np.frombuffer(b"".join(written), dtype=np.uint8)
        self.offsets = np.cumsum([0, *map(len, written)])
        self.byte_symbols = byte_symbols()
        self.numerals = [str(i) for i in range(len(written))]
        self.words, self.chunks = Held(self.encode_word), Held(self.encode_chunk)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols that stand at one edge of a token while it is built, each with the merge that ends it."""
        found, ends = [], len(self.joins)
        while True:
            found.append((token, ends))
            if token not in self.parts:
                return found
            ends = self.parts[token][2]
            token = self.parts[token][side]

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            known = True
            for a, a_ends in self._edge(left, 1):
                for b, b_ends in self._edge(right, 0):
                    at = self.joins.get((a, b))
                    # The leftmost of equal pairs is joined first, hence < on the left and <= on the right.
                    if at is not None and at < a_ends and at <= b_ends:
                        known = False
            if len(self.fits) < 10 * KEPT_WORDS:
                self.fits[left, right] = known
        return known

    def encode_word(self, word: str) -> tuple[int, ...]:
        symbols = "".join([self.byte_symbols[b] for b in word.encode()]) + _END
        size = len(symbols)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        for last, found in self.automaton.iter(symbols):
            starts[last + 1 - found[1]].append(found)  # by growing length: the longest is taken from the end
        fits, chosen, at = self.fits, [-1], [0]
        while at[-1] < size:
            untried, here, before = starts[at[-1]], at[-1], chosen[-1]
            while untried:
                token, length = untried.pop()
                # A place that has been given up has nothing left to try.
                if here + length == size or starts[here + length]:
                    known = True if before < 0 else fits.get((before, token))
                    if known is None:
                        known = self.compatible(before, token)
                    if known:
                        chosen.append(token)
                        at.append(here + length)
                        break
            else:
                if before < 0:
                    raise ValueError(f"the vocabulary cannot spell {word!r}")
                at.pop()
                chosen.pop()
        return tuple(chosen[1:])

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        """A stretch of text without white space: normal form, split into words, their tokens."""
        # Letter by letter: a final capital sigma is lowered like any other one.
        lowered = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        words, ids = self.words, []
        for word in self.split.findall(lowered):
            ids.extend(words[word])
        return tuple(ids)

    def encode(self, text: str) -> np.ndarray:
        """No word, normal form or token reaches over white space, so chunks are encoded one by one."""
        pieces = self.special.split(text) if "<|" in text else [text]
        chunks, found = self.chunks, []
        for k, piece in enumerate(pieces):
            if k % 2:
                found.append((self.added[piece],))
                continue
            # str.split also parts at four control characters that are no white space here.
            plain = not any(c in piece for c in "\x1c\x1d\x1e\x1f")
            found += [chunks[c] for c in (piece.split() if plain else _SPACE.split(piece))]
        return np.fromiter(chain.from_iterable(found), dtype=np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts with a space between two, as UTF-8."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        length = self.offsets[ids + 1] - start
        place = np.repeat(start - (np.cumsum(length) - length), length)
        place += np.arange(len(place))
        return self.buffer[place][:-1].tobytes()


#: Characters with Unicode's White_Space property.
_SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_loaded: dict[str, Merges] = {}


def load(described: str) -> Merges:
    """One copy a worker process."""
    key = hashlib.md5(described.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = Merges(json.loads(described))
    return _loaded[key]


def tokenise(docs: DataFrame, vocabulary: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """The other columns that are asked for stay: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids.

    ``vocabulary`` is the path of a tokenizer file on the driver. Its content, a
    few MB whatever the corpus, goes to the workers as a broadcast value.
    """
    described = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load(described.value)
        for batch, texts in each_text(batches, "text"):
            count, ids_sha, text_sha, kept = [], [], [], []
            for one in texts:
                ids = merges.encode(one)
                count.append(len(ids))
                written = " ".join([merges.numerals[i] for i in ids.tolist()])
                ids_sha.append(hashlib.sha256(written.encode()).hexdigest())
                text_sha.append(hashlib.sha256(merges.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(ids.astype(np.int32))
            columns = [pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield with_columns(batch, "text", names, columns)

    one = docs.select("doc_id", whole(text).alias("text"))
    key = one.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return one.mapInArrow(run, shape)
