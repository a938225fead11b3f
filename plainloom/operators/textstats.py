"""Token tables: counts, vocabularies, weights, sequences, sentiment, next word.

Long (document, term) tables are used throughout. Grouping by term or by
(class, term) combines before the shuffle, so frequent words send one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plainloom.functions.text import let, word_ngrams
from plainloom.operators.ordering import lookup, number_rows
from plainloom.session import stage

#: Beyond so many rows a group Spark does not cut groups before the shuffle.
GROUP_LIMIT, GROUP_PARTS = 1_000, 32


def explode_tokens(df: DataFrame, keys: Sequence[str], tokens: Column, name: str = "term") -> DataFrame:
    return df.select(*keys, F.explode(tokens).alias(name))


def token_counts(df: DataFrame, tokens: Column, by: Sequence[str] = (), name: str = "term") -> DataFrame:
    """How often every token occurs, per class when ``by`` is given."""
    exploded = explode_tokens(df, by, tokens, name)
    return exploded.groupBy(*by, name).agg(F.count(F.lit(1)).alias("n"))


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows per group under a total order.

    Spark limits each task to its own first k rows per group before the shuffle
    (WindowGroupLimit), so a hot group moves k rows per task. It does so up to
    ``GROUP_LIMIT`` rows; beyond, groups are first cut within ``GROUP_PARTS`` parts.
    """
    if k >= GROUP_LIMIT:
        part = F.pmod(F.monotonically_increasing_id(), F.lit(GROUP_PARTS))
        within = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order))
        df = df.withColumn("_part", part).withColumn("_r", within).where(F.col("_r") <= k).drop("_part", "_r")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def _counted(tokens: Column) -> Column:
    """The distinct tokens of one row with their numbers: (term, tf), by sorting the row's own tokens."""

    def runs(words: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))

        def sizes(starts: Column) -> Column:
            ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(words)))
            return F.zip_with(starts, ends, lambda a, b: F.struct(F.get(words, a).alias("term"), (b - a).cast("long").alias("tf")))

        return F.when(F.size(words) > 0, let(heads, sizes))

    return let(F.sort_array(tokens), runs)


def term_frequencies(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, term, tf).

    A row whose key stands once is counted within itself, so its terms are not shuffled.
    Only the rows that share a key are grouped. Both meet the number of rows of their key,
    a join in which a table too large to broadcast shuffles texts once, not terms.
    """
    rows = df.groupBy(key).agg((F.count(F.lit(1)) > 1).alias("_shared"))
    shared = lookup(df, rows, [key], null_safe=True)
    alone = shared.where("NOT _shared").select(key, F.explode(_counted(tokens)).alias("_c")).select(key, "_c.*")
    return alone.unionByName(
        explode_tokens(shared.where("_shared"), [key], tokens).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    )


def document_frequencies(tf: DataFrame) -> DataFrame:
    """(term, df, total) from a term-frequency table.

    ``df`` adds 1 per row out of ``tf`` itself: reading the same columns as the
    weights do lets Spark shuffle the terms of documents that share a key once for both.
    """
    return tf.groupBy("term").agg(F.sum(F.least("tf", F.lit(1))).alias("df"), F.sum("tf").alias("total"))


def vocabulary(tf: DataFrame, size: int | None = None, min_df: int = 1) -> DataFrame:
    """Terms in at least ``min_df`` documents; the ``size`` most frequent, ties by term.

    It is written, so the planner knows whether it can be broadcast.
    """
    terms = document_frequencies(tf).where(F.col("df") >= min_df)
    return stage(terms if size is None else terms.orderBy(F.col("total").desc(), "term").limit(size))


def tfidf_plain(tf: DataFrame, terms: DataFrame, n_docs: Column) -> DataFrame:
    """Weight tf * ln((n + 1) / (df + 1)): the form of ``pyspark.ml.feature.IDF``."""
    idf = F.log((n_docs + 1) / (F.col("df") + 1))
    return tf.join(terms.select("term", "df"), "term").withColumn("weight", F.col("tf") * idf).drop("df")


def tfidf_smooth(tf: DataFrame, terms: DataFrame, n_docs: Column, key: str) -> DataFrame:
    """Weight tf * (ln((1 + n) / (1 + df)) + 1), each document scaled to length one.

    The norm is a window over one document's own terms, a group no bigger than its text.
    """
    idf = F.log((n_docs + 1) / (F.col("df") + 1)) + 1
    raw = tf.join(terms.select("term", "df"), "term").withColumn("_w", F.col("tf") * idf)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.withColumn("weight", F.col("_w") / norm).drop("_w", "df")


def vocabulary_index(counts: DataFrame, name: str = "token_id") -> DataFrame:
    """Ids from 1 by falling count, ties by term."""
    return number_rows(stage(counts), [], [-F.col("n"), F.col("term")], name)


def encode_tokens(df: DataFrame, keys: Sequence[str], tokens: Column, index: DataFrame) -> DataFrame:
    """Tokens to vocabulary ids in their order; unknown tokens are left out, rows without ids and repeated rows kept."""
    rows = df.select(*keys, F.monotonically_increasing_id().alias("_row"), tokens.alias("_tokens"))
    pieces = rows.select(*keys, "_row", F.posexplode_outer("_tokens").alias("_pos", "term"))
    joined = lookup(pieces, index.select("term", "token_id"), ["term"], "left")
    pairs = F.collect_list(F.when(F.col("token_id").isNotNull(), F.struct("_pos", "token_id")))
    ids = F.transform(F.array_sort(F.col("_p")), lambda p: p["token_id"])
    return joined.groupBy(*keys, "_row").agg(pairs.alias("_p")).select(*keys, ids.alias("ids"))


def vocabulary_map(df: DataFrame, tokens: Column, rule) -> DataFrame:
    """Each distinct token that the rule changes with its normal form; the rule runs once per token, not per occurrence."""
    return explode_tokens(df, [], tokens).distinct().withColumn("normal", rule(F.col("term"))).where("normal <> term")


def normalise_tokens(df: DataFrame, keys: Sequence[str], tokens: Column, mapping: DataFrame) -> DataFrame:
    """Replace tokens by the (term, normal) map; tokens outside the map stay, rows without tokens get none."""
    rows = df.select(*keys, F.monotonically_increasing_id().alias("_row"), tokens.alias("_tokens"))
    pieces = rows.select(*keys, "_row", F.posexplode_outer("_tokens").alias("_pos", "term"))
    mapped = lookup(pieces, mapping, ["term"], "left").withColumn("_t", F.coalesce("normal", "term"))
    pairs = F.collect_list(F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_t")))
    out = mapped.groupBy(*keys, "_row").agg(F.transform(F.array_sort(pairs), lambda p: p["_t"]).alias("tokens"))
    return out.drop("_row")


def lexicon_sentiment(df: DataFrame, keys: Sequence[str], tokens: Column, lexicon: DataFrame) -> DataFrame:
    """Share of positive, negative and neutral tokens per row, from a (term, score) lexicon."""
    pieces = df.select(*keys, F.explode_outer(tokens).alias("term"))
    scored = pieces.join(lexicon, "term", "left").withColumn("_s", F.coalesce("score", F.lit(0.0)))
    n = F.count("term")

    def share(hit: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("term").isNotNull() & hit, 1.0)), F.lit(0.0)) / F.nullif(n, F.lit(0))

    return scored.groupBy(*keys).agg(
        share(F.col("_s") > 0).alias("positive"),
        share(F.col("_s") < 0).alias("negative"),
        share(F.col("_s") == 0).alias("neutral"),
    )


def sentiment_totals(shares: DataFrame) -> DataFrame:
    """Totals of the three shares over all rows, and the label of the strictly largest side."""
    totals = shares.agg(*[F.sum(c).alias(c) for c in ("positive", "negative", "neutral")])
    a, b, c = F.col("positive"), F.col("negative"), F.col("neutral")
    label = F.when((a > b) & (a > c), "Positive").when((b > a) & (b > c), "Negative").otherwise("Neutral")
    return totals.withColumn("label", label)


def next_word_table(df: DataFrame, tokens: Column, order: int = 1) -> DataFrame:
    """Most frequent follower of every ``order``-word prefix, the smallest word on ties."""
    grams = explode_tokens(df, [], word_ngrams(tokens, order + 1, order + 1), "gram")
    words = F.split("gram", " ")
    pairs = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).select(
        F.array_join(F.slice(words, 1, order), " ").alias("prefix"),
        F.element_at(words, -1).alias("next"),
        "n",
    )
    best = F.min(F.struct((-F.col("n")).alias("r"), F.col("next").alias("next"))).alias("_b")
    return pairs.groupBy("prefix").agg(best).select(
        "prefix", F.col("_b.next").alias("next"), (-F.col("_b.r")).alias("n")
    )


def backoff_table(df: DataFrame, tokens: Column, longest: int = 3) -> DataFrame:
    """(size, context, next, n): the most frequent follower of every context of up to ``longest`` words.

    All sizes are counted in one pass; size 0, with an empty context, is the most frequent
    word of all. Ties take the smallest word.
    """
    grams = explode_tokens(df, [], word_ngrams(tokens, 1, longest + 1), "gram")
    words = F.split("gram", " ")
    size = (F.size(words) - 1).alias("size")
    pairs = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).select(
        size, F.array_join(F.slice(words, 1, F.size(words) - 1), " ").alias("context"), F.element_at(words, -1).alias("next"), "n"
    )
    best = F.min(F.struct((-F.col("n")).alias("r"), F.col("next").alias("next"))).alias("_b")
    return pairs.groupBy("size", "context").agg(best).select(
        "size", "context", F.col("_b.next").alias("next"), (-F.col("_b.r")).alias("n")
    )


def backoff_next(df: DataFrame, keys: Sequence[str], tokens: Column, table: DataFrame, longest: int = 3) -> DataFrame:
    """(keys..., size, next): the follower of the longest known context at the end of every row's tokens.

    A context that was never seen falls back to the one a word shorter, at last to the
    empty one. Repeated rows are answered each.
    """
    rows = df.select(*keys, F.monotonically_increasing_id().alias("_row"), tokens.alias("_tokens"))
    sizes = F.sequence(F.lit(0), F.least(F.lit(longest), F.size("_tokens")))
    asked = rows.select(*keys, "_row", "_tokens", F.explode(sizes).alias("size"))
    start = F.size("_tokens") - F.col("size") + 1
    asked = asked.select(*keys, "_row", "size", F.array_join(F.slice("_tokens", start, F.col("size")), " ").alias("context"))
    hits = lookup(asked, table.select("size", "context", "next"), ["size", "context"], "left")
    found = F.max(F.when(F.col("next").isNotNull(), F.struct("size", "next"))).alias("_b")
    return hits.groupBy(*keys, "_row").agg(found).select(*keys, "_b.size", "_b.next")


def continue_text(seeds: DataFrame, text: str, table: DataFrame, words: int, order: int = 1) -> DataFrame:
    """Append the most likely next word ``words`` times; a seed without follower stays as it is."""
    out = seeds
    follow = stage(table.select("prefix", "next"))  # read once per word, and of known size
    for _ in range(words):
        last = F.array_join(F.slice(F.split(F.col(text), " "), -order, order), " ")
        enough = F.size(F.split(F.col(text), " ")) >= order
        out = out.withColumn("prefix", F.when(enough, last)).join(follow, "prefix", "left")
        out = out.withColumn(text, F.concat_ws(" ", F.col(text), F.col("next"))).drop("prefix", "next")
    return out
