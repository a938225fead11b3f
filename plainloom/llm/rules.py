"""Quality rules: statistics of a text, and a decision list learned from labelled statistics.

The list is learned by sequential covering. A rule starts empty and grows by the
threshold that gains most on two thirds of the labelled rows; then its last
conditions are taken off while that helps on the other third. A rule that rejects
too many good rows there ends the learning. The rows a rule covers leave, and the
next one is learned. The list becomes one ordered CASE expression.

Nulls count as empty texts; an empty text has all statistics 0 and fails the base
rules. Without labels, or with labels of one kind, the list is empty and keeps what
the base rules keep. Repeated rows are judged each. An empty table gives no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import each_text, labelled_sample, whole, with_columns

#: Rows the list is learned from, at most.
SAMPLE_ROWS = 20_000
#: Words in a window that counts as repeated.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")
SHARES = {
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
}
FEATURES = ("n_words", *SHARES)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window which the text holds twice or more.

    Windows get exact numbers by doubling: a window of 2k words is a pair of windows of k.
    """
    if len(words) <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    if len(seen) == len(words):
        return 0
    step = 1
    while step < window:
        pairs = ids[:-step] * (len(words) + 1) + ids[step:]
        ids = np.unique(pairs, return_inverse=True)[1]
        step *= 2
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def statistics_of(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()  # bytes are split at the six separators only
    lines = [line for line in raw.split(b"\n") if line.strip()]
    codes = np.frombuffer(raw, dtype=np.uint8)
    capitals = int(np.count_nonzero((codes >= 65) & (codes <= 90)))
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        capitals,
        text.count("!") + text.count("?"),
    )


def text_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and STATISTICS of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in each_text(batches, "whole_text"):
            found = np.array([statistics_of(t) for t in texts], dtype=np.int64).reshape(-1, len(STATISTICS))
            yield with_columns(batch, "whole_text", STATISTICS, [pa.array(c) for c in found.T])

    chosen = docs.select(*keep, whole(text).alias("whole_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "whole_text")
    return chosen.mapInArrow(run, f"{kept}, " + ", ".join(f"{c} long" for c in STATISTICS))


def with_shares(stats: DataFrame) -> DataFrame:
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return stats.withColumns({name: share(*of) for name, of in SHARES.items()})


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        x = F.col(self.feature)
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)

    def mask(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.feature]
        return x > self.threshold if self.above else x <= self.threshold


def _covers(rule: list[Condition], table: dict[str, np.ndarray]) -> np.ndarray:
    mask = np.ones(len(next(iter(table.values()))), dtype=bool)
    for condition in rule:
        mask &= condition.mask(table)
    return mask


def _grow(table, bad, most_conditions: int, levels: int) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < most_conditions and bad[inside].sum() < inside.sum():
        p0 = bad[inside].sum()
        before = np.log2(max(p0, 1e-9) / inside.sum())
        best, gain = None, 1e-9
        for name, values in table.items():
            here = np.unique(values[inside])
            for t in np.unique(np.quantile(values[inside], np.linspace(0, 1, levels), method="lower")):
                # Midway to the next value: what lies between two seen values is not claimed by either side.
                after = here[np.searchsorted(here, t, side="right") :][:1]
                t = (t + after[0]) / 2 if len(after) else t
                for above in (False, True):
                    option = Condition(name, above, float(t))
                    mask = inside & option.mask(table)
                    p = bad[mask].sum()
                    if p and mask.sum() < inside.sum():
                        won = p * (np.log2(p / mask.sum()) - before)
                        if won > gain:
                            best, gain = option, won
        if best is None:
            break
        rule.append(best)
        inside &= best.mask(table)
    return rule


def _prune(rule: list[Condition], table, bad) -> list[Condition]:
    def worth(short):
        mask = _covers(short, table)
        p, n = bad[mask].sum(), (~bad[mask]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=[])


def learn_list(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    most_rules: int = 12,
    most_conditions: int = 4,
    levels: int = 24,
    precision: float = 0.9,
    least: int = 5,
) -> list[list[Condition]]:
    """Rules that reject, in order. Every third row prunes and judges, the others grow."""
    rules: list[list[Condition]] = []
    open_rows = np.ones(len(bad), dtype=bool)
    judge = np.arange(len(bad)) % 3 == 0
    while len(rules) < most_rules:
        grow, check = open_rows & ~judge, open_rows & judge
        if bad[grow].sum() < least or bad[check].sum() == 0:
            break
        rule = _grow({k: v[grow] for k, v in table.items()}, bad[grow], most_conditions, levels)
        held_out = {k: v[check] for k, v in table.items()}
        rule = _prune(rule, held_out, bad[check])
        mask = _covers(rule, held_out) if rule else np.zeros(check.sum(), dtype=bool)
        if not mask.any() or bad[check][mask].mean() < precision:
            break
        rules.append(rule)
        open_rows &= ~_covers(rule, table)
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """True for a row that no rule rejects; the first rule that holds decides."""
    case = None
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        case = F.when(holds, False) if case is None else case.when(holds, False)
    return F.lit(True) if case is None else case.otherwise(True)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[list[Condition]]:
    """Learn from (doc_id, quality): quality 0 is bad, a null one is no label."""
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("graded"))
    sample = labelled_sample(docs.select("doc_id", "text"), known, "doc_id", rows)
    stats = with_shares(text_statistics(sample, ["doc_id", "graded"])).where(~base_failed())
    rows_seen = stats.select("doc_id", "graded", *FEATURES).orderBy("doc_id", *FEATURES).collect()
    bad = np.array([r["graded"] == 0 for r in rows_seen], dtype=bool)
    table = {f: np.array([r[f] for r in rows_seen], dtype=float) for f in FEATURES}
    return learn_list(table, bad) if len(bad) else []


def judge(docs: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """doc_id, STATISTICS, base_failed and kept of every row."""
    stats = with_shares(text_statistics(docs, ["doc_id"]))
    return stats.select(
        "doc_id", *STATISTICS, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept")
    )
