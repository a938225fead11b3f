"""Ratings, popularity blends and content recommendation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plainloom.functions.arrays import cosine
from plainloom.operators.features import minmax_fit, minmax_scale
from plainloom.operators.quantiles import quantiles
from plainloom.operators.textstats import term_frequencies, tfidf_smooth, top_per_group, vocabulary
from plainloom.session import stage


def weighted_rating(df: DataFrame, rating: str, votes: str, prob: float = 0.8, name: str = "weighted") -> DataFrame:
    """(R v + C m) / (v + m) with m the ``prob`` quantile of votes and C the mean rating; null if v + m is 0."""
    m = quantiles(df, [votes], [prob]).select(F.col("q")[0]).scalar()
    c = df.agg(F.avg(rating)).scalar()
    r, v = F.col(rating), F.col(votes)
    return df.withColumn(name, F.try_divide(r * v + c * m, v + m))


def blend_scores(df: DataFrame, weights: Mapping[str, float], name: str = "score") -> DataFrame:
    """Weighted sum of the min-max scaled columns."""
    scaled = minmax_scale(
        df.withColumns({f"_{c}": F.col(c) for c in weights}),
        [f"_{c}" for c in weights],
        minmax_fit(df.withColumns({f"_{c}": F.col(c) for c in weights}), [f"_{c}" for c in weights]),
    )
    total = sum((F.col(f"_{c}") * w for c, w in weights.items()), F.lit(0.0))
    return scaled.withColumn(name, total).drop(*[f"_{c}" for c in weights])


def item_profile(parts: Sequence[Column]) -> Column:
    """Bag of words of an item: its cleaned texts joined by spaces."""
    return F.concat_ws(" ", *parts)


def without(tokens: Column, stop_words: Sequence[str]) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words))) if stop_words else tokens


def content_similarity(
    items: DataFrame, key: str, tokens: Column, anchor, min_df: int = 5, stop_words: Sequence[str] = ()
) -> DataFrame:
    """TF-IDF cosine of every item with one anchor item; items sharing no term give 0.

    Only postings of the anchor's own terms are read on; no item pairs are formed. The
    anchor's terms are written first, so the planner knows their size.
    """
    tf = term_frequencies(items, key, without(tokens, stop_words))
    n = items.agg(F.count(F.lit(1))).scalar()
    weights = tfidf_smooth(tf, vocabulary(tf, min_df=min_df), n, key)
    mine = weights.where(F.col(key) == F.lit(anchor)).select("term", F.col("weight").alias("_a"))
    hits = weights.join(stage(mine), "term").groupBy(key).agg(F.sum(F.col("weight") * F.col("_a")).alias("_s"))
    return items.join(hits, key, "left").withColumn("similarity", F.coalesce("_s", F.lit(0.0))).drop("_s")


def content_recommend(
    items: DataFrame,
    key: str,
    tokens: Column,
    score: str,
    anchor,
    similarity_weight: float = 0.7,
    top_n: int = 10,
    min_df: int = 5,
    include_self: bool = True,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """Top items by (1 - w) * score + w * similarity; the anchor itself is ranked too by default."""
    ranked = content_similarity(items, key, tokens, anchor, min_df, stop_words)
    if not include_self:
        ranked = ranked.where(F.col(key) != F.lit(anchor))
    final = F.col(score) * (1 - similarity_weight) + F.col("similarity") * similarity_weight
    return ranked.withColumn("final_score", final).orderBy(F.col("final_score").desc(), key).limit(top_n)


def similar_items(
    items: DataFrame,
    key: str,
    tokens: Column,
    least: float = 0.5,
    top_n: int = 10,
    min_df: int = 1,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """(key, rank, similar, similarity): for every item the ``top_n`` items with a cosine of at least ``least``.

    A prefix-filtered join. Terms stand by rarity. Of an item only the first terms are
    joined, those after which the rest of its unit vector is shorter than ``least``: two
    items as near as that share one of them. A pair goes on if the product of the two
    lengths that are left from their first common term can still reach ``least``; only then
    is its cosine added up. Items with the same terms and weights are one class, joined once,
    so copies form no pairs. Ties (to 9 digits) go to the smaller key; items without a term
    are similar to none. Keys must be unique.
    """
    tf = stage(term_frequencies(items, key, without(tokens, stop_words)))
    n = tf.agg(F.count_distinct(key)).scalar()
    terms = vocabulary(tf, min_df=min_df)
    weighted = tfidf_smooth(tf, terms, n, key).join(terms.select("term", "df"), "term")
    term = F.struct("df", "term", "weight")
    vectors = weighted.groupBy(key).agg(F.array_sort(F.collect_list(term)).alias("vec"))
    vectors = stage(vectors.withColumn("h", F.xxhash64("vec")))
    classes = stage(vectors.groupBy("h", "vec").agg(F.min(key).alias("c")))
    members = vectors.join(classes, ["h", "vec"]).select("c", F.col(key).alias("item"))
    long = classes.select("c", F.inline("vec"))
    own = Window.partitionBy("c").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.lit(1.0) - F.coalesce(F.sum(F.col("weight") * F.col("weight")).over(own), F.lit(0.0))
    slack = 1e-9
    prefix = stage(long.withColumn("rest", rest).where(F.col("rest") >= least * least - slack).select("c", "term", "rest"))
    other = prefix.select(F.col("c").alias("d"), "term", F.col("rest").alias("rest_d"))
    met = prefix.join(other, "term").where("c < d").groupBy("c", "d").agg(F.max(F.col("rest") * F.col("rest_d")).alias("bound"))
    pairs = met.where(F.col("bound") >= least * least - slack).select("c", "d")
    weights = long.select("c", "term", "weight")
    theirs = weights.select(F.col("c").alias("d"), "term", F.col("weight").alias("weight_d"))
    near = pairs.join(weights, "c").join(theirs, ["d", "term"]).groupBy("c", "d").agg(
        F.sum(F.col("weight") * F.col("weight_d")).alias("similarity")
    )
    near = stage(near.where(F.col("similarity") >= least - slack))
    same = classes.select("c", F.col("c").alias("d"), F.lit(1.0).alias("similarity"))
    every = near.union(near.select("d", "c", "similarity")).union(same)
    # One class more than wanted, and one member more of each, as the item itself falls out.
    by_nearness = [F.round("similarity", 9).desc(), F.col("d")]
    best = top_per_group(every, ["c"], by_nearness, top_n + 1)
    first = top_per_group(members.withColumnsRenamed({"c": "d", "item": "similar"}), ["d"], ["similar"], top_n + 1)
    listed = top_per_group(best.join(first, "d"), ["c"], [F.round("similarity", 9).desc(), F.col("similar")], top_n + 1)
    out = members.join(listed.select("c", "similar", "similarity"), "c").where("item <> similar")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.round("similarity", 9).desc(), "similar"))
    out = out.withColumn("rank", rank).where(F.col("rank") <= top_n)
    return out.select(F.col("item").alias(key), "rank", "similar", "similarity")


def cosine_to_anchor(df: DataFrame, key: str, vector: str, anchor, name: str = "similarity") -> DataFrame:
    """Cosine of every dense vector with the anchor's; the one anchor vector becomes a literal."""
    row = df.where(F.col(key) == F.lit(anchor)).select(vector).first()
    if row is None:
        raise ValueError(f"no row with {key} = {anchor}")
    reference = F.array(*[F.lit(float(x)) for x in row[0]])
    return df.withColumn(name, cosine(F.col(vector), reference))
