"""Mixing sources to target weights by systematic sampling.

Each document has an expected number of copies. Within a source the expected copies
are added up in a fixed order, one random offset per source is added, and a document
is emitted once for every integer that its step of the running sum crosses. All
documents of a source have the same expectation, so the running sum at rank i is i
times it: only a rank is needed, which is counted in pieces of a source, never in a
window over a whole one. The order is by size, so the words taken differ from the
target by about one document at most.

Nulls: a null text has size 0; null sources are one source, ordered last. A source
whose documents hold no word has target 0 and gives no copies. Repeated rows count as
rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import WORD, fresh, numbered
from plainloom.operators.ordering import lookup, number_rows
from plainloom.session import stage

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words wanted, as a share of all words.
SHARE = 1.5
#: Documents of a source that are ranked in one task, about.
RANKED_ROWS = 8_192
#: The most copies a document may be expected to have.
MOST_COPIES = 2


def count_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """Target of every source from (source, size): source, source_size, target.

    A target stops at ``most`` times the source's size; what is over is dealt to the
    others by weight again, until none is above. Every round needs two sums only and
    sets at least one source to its limit.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = number_rows(totals, [], [F.col("source").isNull(), F.col("source")], "rank")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = stage(ranked.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))))
    limit = F.col("source_size") * F.lit(float(most))
    everything = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        at_limit = F.lit(level) * F.col("weight") >= limit
        full, open_weight = ranked.agg(
            F.sum(F.when(at_limit, F.col("source_size")).otherwise(0)),
            F.sum(F.when(at_limit, 0).otherwise(F.col("weight"))),
        ).first()
        if not open_weight:
            break
        raised = (share * everything - most * full) / open_weight
        if raised <= level:
            break
        level = raised
    return ranked.select("source", "source_size", F.least(limit, F.lit(level) * F.col("weight")).alias("target"))


def systematic_copies(sized: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """Adds source_size, target and copies to (doc_id, row, source, size).

    ``row`` must differ between rows; it only breaks ties between repeated rows.
    """
    order = ["size", unit_hash(F.col("doc_id"), seed), "doc_id", "row"]
    ranked = number_rows(sized, ["source"], order, "rank", piece_rows=RANKED_ROWS)
    known = lookup(ranked, targets, ["source"], null_safe=True)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit_hash(F.col("source"), seed)
    crossed = F.floor(F.col("rank") * expected + offset) - F.floor((F.col("rank") - 1) * expected + offset)
    return known.withColumn("copies", crossed.cast("int")).drop("rank")


def plan_mix(docs: DataFrame, seed: int = 0, **targets) -> DataFrame:
    """doc_id, row, source, size, source_size, target, copies of every document."""
    sized = stage(
        docs.select("doc_id", "source", count_words("text").alias("size")).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    return systematic_copies(sized, source_targets(sized, **targets), seed)


def mix(docs: DataFrame, seed: int = 0, **targets) -> DataFrame:
    """The documents of the mix, each as often as it was drawn, with the columns of ``docs``."""
    row, copies, source, size = fresh(docs, "mix_row", "mix_copies", "mix_source", "mix_size")
    kept = numbered(docs, row)
    sized = kept.select("doc_id", "source", count_words("text").alias("size"), F.col(row).alias("row"))
    sized = stage(sized)
    drawn = systematic_copies(sized, source_targets(sized, **targets), seed).where("copies > 0")
    drawn = drawn.select(F.col("row").alias(row), F.col("copies").alias(copies))
    # The draws grow with the corpus: they are never broadcast, and texts are hashed, not sorted.
    repeated = kept.join(drawn.hint("shuffle_hash"), row).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
