"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's pattern gives a Boolean trigram query. The index holds, for blocks of
texts, the posting list of every trigram that some query names; a rule's candidates
are unions and intersections of these lists. Only candidates meet the rule's regular
expression. Rules without a mandatory trigram look at every text.

Blocks are dealt by a hash of key and text, so their size does not depend on how often
a text repeats, and a posting list is no longer than its block. Nulls count as empty
texts, which hold no secrets. Repeated rows are scanned each; an empty table gives no
rows. Places count code points, the end is exclusive; spans stand by start, then in the
order of the rules. Time grows with the length of a text, however many matches it has.
Other columns are kept or not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainloom.llm.common import fresh, whole
from plainloom.llm.trigrams import ANYTHING, trigram_query, trigrams_of
from plainloom.session import stage


@dataclass(frozen=True)
class Rule:
    """A match counts if its group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, then further ones. A run of hexadecimal digits or of capitals and digits is matched
# whole or not at all, so its least length stands in the pattern; for assignments a short value still uses up its text.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE_KINDS = ("assign", "access", "hex")
#: Texts in a block of the index, about.
BLOCK_TEXTS = 4_000


#: Elements that are folded step by step; longer arrays are folded in chunks of so many.
CHUNK = 256
_FIELDS = ("start", "order", "end", "kind", "from", "to")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def folds_before(items: Column, zero: Column, kind: str, add: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array the fold of all before it; ``add`` is associative, ``zero`` its neutral element.

    An array that grows step by step is copied at each step. So it is only grown within
    chunks, and over the chunks' own folds, and time grows with the length of the array.
    """

    def within(chunk: Column) -> Column:
        begin = F.struct(zero.alias("at"), F.array().cast(f"array<{kind}>").alias("all"))
        return F.aggregate(
            chunk, begin, lambda so_far, x: F.struct(add(so_far["at"], x).alias("at"), F.concat(so_far["all"], F.array(so_far["at"])).alias("all"))
        )

    def joined(folded: Column) -> Column:
        starts = within(F.transform(folded, lambda f: f["at"]))["all"]
        return F.flatten(F.zip_with(folded, starts, lambda f, start: F.transform(f["all"], lambda x: add(start, x))))

    def chunked(known: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(known), F.lit(CHUNK))
        folded = F.transform(firsts, lambda first: within(F.slice(known, first, F.lit(CHUNK))))
        return F.when(F.size(known) > 0, let(folded, joined)).otherwise(F.array().cast(f"array<{kind}>"))

    return let(items, chunked)


def nothing() -> Column:
    return F.array().cast("array<struct<start: int, order: int, end: int, kind: string, from: int, to: int>>")


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Array of the spans of a rule's matches in a text: places in code points, and ``from`` and ``to`` in bytes.

    Splitting at the pattern gives what stands between the matches; lengths of both
    add up to the places.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    # There is one gap more than matches, so the last pair has no match.
    pairs = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("hit"), parts.alias("part"))

    def measured(pair: Column) -> Column:
        gap, hit = pair["gap"], F.coalesce(pair["hit"], F.lit(""))
        return F.struct(
            (F.length(gap) + F.length(hit)).alias("chars"),
            (F.octet_length(gap) + F.octet_length(hit)).alias("bytes"),
            F.length(hit).alias("size"),
            F.octet_length(hit).alias("wide"),
            (pair["hit"].isNotNull() & (F.length(pair["part"]) >= rule.least)).alias("counts"),
        )

    def add(a: Column, b: Column) -> Column:
        return F.struct((a["chars"] + b["chars"]).alias("chars"), (a["bytes"] + b["bytes"]).alias("bytes"))

    def span(s: Column, before: Column) -> Column:
        end, to = before["chars"] + s["chars"], before["bytes"] + s["bytes"]
        values = (end - s["size"], F.lit(order), end, F.lit(rule.kind), to - s["wide"], to)
        return F.when(s["counts"], F.struct(*[v.alias(n) for v, n in zip(values, _FIELDS)]))

    def placed(sizes: Column) -> Column:
        zero = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("bytes"))
        before = folds_before(sizes, zero, "struct<chars: int, bytes: int>", add)
        return F.when(F.size(sizes) > 1, F.array_compact(F.zip_with(sizes, before, span))).otherwise(nothing())

    return let(F.transform(pairs, measured), placed)


def build_index(texts: DataFrame, trigrams: list[str], block_texts: int = BLOCK_TEXTS) -> DataFrame:
    """Posting lists of (key, text): one row a block, one array of keys per trigram (columns t0, t1, ...)."""
    blocks = max(1, -(-texts.count() // block_texts))
    low = texts.select("key", F.lower("text").alias("low"))
    # Texts without any of the trigrams stand in no list.
    low = low.where(reduce(Column.__or__, [F.contains("low", F.lit(t)) for t in trigrams]))
    posting = lambda t: F.collect_set(F.when(F.contains("low", F.lit(t)), F.col("key")))
    lists = [posting(t).alias(f"t{i}") for i, t in enumerate(trigrams)]
    return low.groupBy(F.pmod("key", F.lit(blocks)).alias("block")).agg(*lists)


def candidates(index: DataFrame, queries: list, trigrams: list[str]) -> DataFrame:
    """(key, rules): bit r of ``rules`` is set if the text may match rule r."""
    place = {t: i for i, t in enumerate(trigrams)}

    def keys(query) -> Column:
        if isinstance(query, str):
            return F.col(f"t{place[query]}")
        join = F.array_intersect if query[0] == "all" else F.array_union
        return reduce(join, map(keys, query[1]))

    def pairs_of(r: int, query) -> Column:
        bit = F.lit(1 << r).cast("long").alias("bit")
        return F.transform(keys(query), lambda k: F.struct(k.alias("key"), bit))

    each = [pairs_of(r, q) for r, q in enumerate(queries) if q is not ANYTHING]
    pairs = index.select(F.explode(F.concat(*each)).alias("pair"))
    return pairs.groupBy("pair.key").agg(F.bit_or("pair.bit").alias("rules"))


def with_spans(docs: DataFrame, name: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the array column ``name`` of the spans of all rules, by start, then rule; at most 63 rules."""
    if len(rules) > 63:
        raise ValueError("candidates are marked in the bits of a long: at most 63 rules")
    queries = [trigram_query(rule.pattern) for rule in rules]
    trigrams = sorted(set().union(*map(trigrams_of, queries)))
    key, may = fresh(docs, "secret_key", "secret_rules")
    row_key = F.xxhash64(F.col("doc_id"), F.col(text))
    body = whole(text)
    found = F.lit(0).cast("long")
    keyed = docs
    if trigrams:
        texts = docs.select(row_key.alias("key"), body.alias("text"))
        # Written first: the planner then knows whether the candidates are few enough to broadcast.
        chosen = stage(candidates(stage(build_index(texts, trigrams)), queries, trigrams))
        chosen = chosen.select(F.col("key").alias(key), F.col("rules").alias(may))
        keyed = docs.withColumn(key, row_key).join(chosen, key, "left")
        found = F.coalesce(F.col(may), F.lit(0).cast("long"))
    spans = []
    for r, (rule, query) in enumerate(zip(rules, queries)):
        matched = spans_of(body, rule, r)
        worth = found.bitwiseAND(F.lit(1 << r).cast("long")) != 0
        spans.append(matched if query is ANYTHING else F.when(worth, matched).otherwise(nothing()))
    return keyed.withColumn(name, F.array_sort(F.concat(*spans))).drop(key, may)


def written(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, count and digest of the base spans, and all spans."""
    found = with_spans(docs.select("doc_id", "text"), "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame, mark: str = "[secret]", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by a mark; spans that overlap become one mark.

    The text is cut as bytes, where a place is found at once, and its pieces are joined in the end.
    """
    (spans,) = fresh(docs, "secret_spans")
    found = with_spans(docs, spans, text=text)
    body = whole(text).cast("binary")

    def cut(own: Column) -> Column:
        reached = folds_before(F.transform(own, lambda s: s["to"]), F.lit(0), "int", lambda a, b: F.greatest(a, b))

        def piece(s: Column, before: Column) -> Column:
            between = F.substring(body, before + 1, s["from"] - before).cast("string")
            return F.when(s["from"] < before, F.lit("")).otherwise(F.concat(between, F.lit(mark)))

        last = F.array_max(F.transform(own, lambda s: s["to"]))
        rest = F.substring(body, last + 1, F.octet_length(body)).cast("string")
        return F.concat(F.array_join(F.zip_with(own, reached, piece), ""), rest)

    clean = F.when(F.size(spans) == 0, F.col(text)).otherwise(let(F.col(spans), cut))
    out = found.withColumn(text, clean)
    if "n_chars" in docs.columns:
        changed = F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(F.length(text).cast("long"))
        out = out.withColumn("n_chars", changed)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
