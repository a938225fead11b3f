"""Signal features, lag windows, scaling, encoding, recommendation and neighbours."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plainloom.functions import text as X
from plainloom.functions.dates import time_text
from plainloom.operators import features, neighbours, recommend, series, signal, splits
from plainloom.plans.catalog import query
from plainloom.plans.text import STOP_WORDS
from plainloom.session import stage, table


def daily_channels(spark, sf):
    k = F.from_json("props", "k double")["k"]
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("value").alias("a"), (k - 50).alias("b")
    )


CHANNEL_SQL = """c AS (SELECT strftime(ts, '%Y-%m-%d') AS day, value AS a,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) - 50 AS b FROM events)"""


def _feature_sql(c):
    return f"""round(avg(abs({c})), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std,
        round(skewness({c}), 6) AS {c}_skew, round(kurtosis({c}), 6) AS {c}_kurtosis,
        round(sqrt(sum({c} * {c}) / count(*)), 6) AS {c}_rms, max(abs({c})) AS {c}_max,
        abs(max({c})) + abs(min({c})) AS {c}_p2p"""


def _entropy_sql(c):
    return f"""{c}r AS (SELECT day, min({c}) AS lo, max({c}) AS hi FROM c GROUP BY day),
        {c}h AS (SELECT day, greatest(ceil(({c} - lo) / (hi - lo) * 500) - 1, 0) AS bin, count(*) AS n
                 FROM c JOIN {c}r USING (day) GROUP BY 1, 2),
        {c}e AS (SELECT day, round(-sum(p * ln(p)), 6) AS {c}_entropy FROM
                 (SELECT day, n / sum(n) OVER (PARTITION BY day) AS p FROM {c}h) GROUP BY 1)"""


@query(
    "signal_features",
    f"WITH {CHANNEL_SQL}, f AS (SELECT day, {_feature_sql('a')}, {_feature_sql('b')} FROM c GROUP BY day), "
    f"{_entropy_sql('a')}, {_entropy_sql('b')} SELECT * FROM f JOIN ae USING (day) JOIN be USING (day)",
)
def signal_features(spark, sf):
    out = signal.time_features(daily_channels(spark, sf), ["day"], ["a", "b"])
    exact = {"day", "a_max", "a_p2p", "b_max", "b_p2p"}
    return out.select([c if c in exact else F.round(c, 6).alias(c) for c in out.columns])


@query(
    "hist_entropy",
    f"WITH {CHANNEL_SQL}, {_entropy_sql('a')} SELECT day, a_entropy AS entropy FROM ae",
)
def hist_entropy(spark, sf):
    out = signal.histogram_entropy(daily_channels(spark, sf), ["day"], ["a"])
    return out.select("day", F.round("entropy", 6).alias("entropy"))


@query(
    "lookback_windows",
    """SELECT event_id, user_id, array_to_string(list(value) OVER w, ' ') AS features, value AS target FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
       QUALIFY count(*) OVER w = 3""",
)
def lookback_windows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = series.lookback_windows(events, ["user_id"], ["ts", "event_id"], "value", 3)
    features_text = F.array_join(F.transform("features", lambda x: x.cast("string")), " ")
    return out.select("event_id", "user_id", features_text.alias("features"), "target")


@query(
    "lookback_one_series",
    """SELECT event_id, array_to_string(list(value) OVER w, ' ') AS features, value AS target FROM events
       WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
       QUALIFY count(*) OVER w = 5""",
)
def lookback_one_series(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    out = series.lookback_windows(events, [], ["ts", "event_id"], "value", 5)
    features_text = F.array_join(F.transform("features", lambda x: x.cast("string")), " ")
    return out.select("event_id", features_text.alias("features"), "target")


@query(
    "prediction_alignment",
    """WITH p AS (SELECT user_id, ts, value, row_number() OVER w AS position,
                         CASE WHEN row_number() OVER w <= round_even(count(*) OVER (PARTITION BY user_id) * (1 - 0.33::DOUBLE), 0)
                              THEN 'train' ELSE 'test' END AS split
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       SELECT user_id, split, position, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value,
              round(avg(value) OVER w3, 6) AS predicted FROM p
       WINDOW w3 AS (PARTITION BY user_id, split ORDER BY position ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
       QUALIFY count(*) OVER w3 = 3""",
)
def prediction_alignment(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    timeline = splits.ordered_split(events, ["user_id"], ["ts", "event_id"], 0.33)
    lags = series.lookback_windows(timeline, ["user_id", "split"], ["position"], "value", 3)
    # the k-th model output of each part, as a fitted model would return it
    mean = F.aggregate("features", F.lit(0.0), lambda s, x: s + x) / 3
    part_start = F.when(F.col("split") == "test", F.col("_cut")).otherwise(F.lit(0))
    cuts = timeline.groupBy("user_id").agg(F.sum((F.col("split") == "train").cast("long")).alias("_cut"))
    outputs = lags.join(cuts, "user_id").select(
        "user_id", "split", (F.col("position") - 3 - part_start - 1).alias("k"), mean.alias("predicted")
    )
    aligned = series.align_predictions(outputs, timeline, ["user_id"], 3)
    return aligned.select(
        "user_id", "split", "position", time_text(F.col("ts")).alias("ts"), "value",
        F.round("predicted", 6).alias("predicted"),
    )


@query(
    "standard_scale",
    """SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
              / (SELECT stddev_pop(o_totalprice) FROM orders), 6) AS price FROM orders""",
)
def standard_scale(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    return features.standard_scale(orders, ["price"]).withColumn("price", F.round("price", 6))


@query(
    "minmax_scale_inverse",
    """WITH s AS (SELECT min(o_totalprice) lo, max(o_totalprice) hi FROM orders)
       SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS scaled, round(o_totalprice, 4) AS restored
       FROM orders, s""",
)
def minmax_scale_inverse(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    fitted = features.minmax_fit(orders, ["price"])
    scaled = features.minmax_scale(orders, ["price"], fitted).withColumn("scaled", F.round("price", 6))
    restored = features.minmax_inverse(scaled, ["price"], fitted)
    return restored.select("o_orderkey", "scaled", F.round("price", 4).alias("restored"))


@query(
    "minmax_per_split",
    """WITH p AS (SELECT event_id, value, ('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT % 100 < 70 AS t FROM events)
       SELECT event_id, CASE WHEN t THEN 'train' ELSE 'test' END AS split,
              round((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w), 6) AS scaled
       FROM p WINDOW w AS (PARTITION BY t)""",
)
def minmax_per_split(spark, sf):
    events = splits.hash_split(table(spark, sf, "events").select("event_id", "value"), "event_id", 70)
    out = features.minmax_by_group(events, "value", ["split"], "scaled")
    return out.select("event_id", "split", F.round("scaled", 6).alias("scaled"))


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")


@query(
    "dummies_drop_first",
    "SELECT o_orderkey, "
    + ", ".join(f"CAST(o_orderpriority = '{p}' AS INTEGER) AS \"o_orderpriority_{p}\"" for p in PRIORITIES[1:])
    + ", "
    + ", ".join(f"CASE WHEN o_orderstatus = '{s}' AND o_orderkey % 6 <> 0 THEN 1 ELSE 0 END AS o_orderstatus_{s}" for s in STATUSES[1:])
    + " FROM orders",
)
def dummies_drop_first(spark, sf):
    status = F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderstatus")).alias("o_orderstatus")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", status)
    return features.dummies(orders, ["o_orderpriority", "o_orderstatus"])


@query(
    "onehot_full",
    "SELECT o_orderkey, "
    + " || ' ' || ".join(f"CAST(CAST(o_orderpriority = '{p}' AS INTEGER) AS VARCHAR)" for p in PRIORITIES)
    + " AS onehot FROM orders",
)
def onehot_full(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    encoded = features.dummy_positions(orders, ["o_orderpriority"], drop_first=False)
    entries = F.sequence(F.lit(0).cast("long"), F.col("width") - 1)
    flags = F.transform(entries, lambda i: F.array_contains("positions", i).cast("int").cast("string"))
    return encoded.select("o_orderkey", F.array_join(flags, " ").alias("onehot"))


@query(
    "mixed_columns",
    """SELECT o_orderkey, round((o_totalprice - (SELECT avg(o_totalprice) FROM orders))
              / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS price,
              CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS priority,
              CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS BIGINT) AS hot_position FROM orders""",
)
def mixed_columns(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    estimator = features.mixed_columns(["o_totalprice"], ["o_orderpriority"], ["o_orderstatus"])
    values = estimator.fit(orders).transform(orders).select("o_orderkey", vector_to_array("features").alias("v"))
    hot = F.slice("v", 3, F.size("v") - 2)
    return values.select(
        "o_orderkey",
        F.round(F.col("v")[0], 6).alias("price"),
        F.col("v")[1].alias("priority"),
        (F.array_position(hot, 1.0) - 1).alias("hot_position"),
    )


@query(
    "label_encode",
    "SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM part",
)
def label_encode(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return features.label_encode(part, "p_brand", "code").select("p_partkey", "code")


ITEMS_SQL = """i AS (SELECT l_partkey AS id, avg(l_quantity) AS rating, count(*) AS votes, sum(l_extendedprice) AS popularity
        FROM lineitem GROUP BY 1),
    w AS (SELECT *, (rating * votes + c * m) / (votes + m) AS weighted FROM i,
          (SELECT quantile_cont(votes, 0.8) AS m, avg(rating) AS c FROM i)),
    b AS (SELECT id, weighted, (weighted - min(weighted) OVER ()) / (max(weighted) OVER () - min(weighted) OVER ()) * 0.4::DOUBLE
          + (popularity - min(popularity) OVER ()) / (max(popularity) OVER () - min(popularity) OVER ()) * 0.6::DOUBLE AS score FROM w)"""


def rated_items(spark, sf):
    items = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("id"))
        .agg(
            F.avg("l_quantity").alias("rating"),
            F.count(F.lit(1)).alias("votes"),
            F.sum("l_extendedprice").alias("popularity"),
        )
    )
    # staged: thresholds, ranges and scores each read the items, not the line items
    return recommend.weighted_rating(stage(items), "rating", "votes")


def scored_items(spark, sf):
    return recommend.blend_scores(rated_items(spark, sf), {"weighted": 0.4, "popularity": 0.6})


@query("weighted_rating", f"WITH {ITEMS_SQL} SELECT id, votes, round(weighted, 6) AS weighted FROM w")
def weighted_rating(spark, sf):
    return rated_items(spark, sf).select("id", "votes", F.round("weighted", 6).alias("weighted"))


@query(
    "popularity_blend",
    f"WITH {ITEMS_SQL} SELECT id, round(score, 6) AS score FROM b ORDER BY b.score DESC, id LIMIT 10",
)
def popularity_blend(spark, sf):
    best = scored_items(spark, sf).orderBy(F.col("score").desc(), "id").limit(10)
    return best.select("id", F.round("score", 6).alias("score"))


STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"
PROFILE_SQL = "lower(p_name) || ' ' || lower(p_type) || ' ' || regexp_replace(lower(p_brand), '[^a-z]', '', 'g') || p_size"


def part_profiles(spark, sf):
    bag = recommend.item_profile(
        [X.remove_punctuation_digits(F.col("p_name")), X.clean_comma_parts(F.col("p_type")),
         F.concat(X.clean_comma_parts(F.col("p_brand")), F.col("p_size").cast("string"))]
    )
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), bag.alias("bag"))


def profiled_items(spark, sf):
    # unsold parts have a profile too; without sales their score is 0
    every = part_profiles(spark, sf).join(scored_items(spark, sf), "id", "left")
    return stage(every.withColumn("score", F.coalesce("score", F.lit(0.0))))


@query("item_profile", f"SELECT p_partkey AS id, {PROFILE_SQL} AS bag FROM part")
def item_profile(spark, sf):
    return profiled_items(spark, sf).select("id", "bag")


@query(
    "content_recommend",
    rf"""WITH {ITEMS_SQL}, p AS (SELECT p_partkey AS id, coalesce(score, 0) AS score, {PROFILE_SQL} AS bag FROM part LEFT JOIN b ON p_partkey = b.id),
        t AS (SELECT id, unnest(regexp_extract_all(bag, '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM p),
        tf AS (SELECT id, term, count(*) AS tf FROM t WHERE term NOT IN {STOP_SQL} GROUP BY 1, 2),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 5),
        wt AS (SELECT id, term, tf * (ln((1 + (SELECT count(*) FROM p)) / (1 + df)) + 1) AS w FROM tf JOIN df USING (term)),
        nw AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM wt),
        s AS (SELECT x.id, sum(x.w * y.w) AS s FROM nw x JOIN nw y ON x.term = y.term AND y.id = 7 GROUP BY 1)
        SELECT id, round(score, 6) AS score, round(coalesce(s, 0), 6) AS similarity,
               round(score * 0.3::DOUBLE + coalesce(s, 0) * 0.7::DOUBLE, 6) AS final_score
        FROM p LEFT JOIN s USING (id) ORDER BY p.score * 0.3::DOUBLE + coalesce(s, 0) * 0.7::DOUBLE DESC, id LIMIT 10""",
)
def content_recommend(spark, sf):
    out = recommend.content_recommend(
        profiled_items(spark, sf), "id", X.word_tokens(F.col("bag")), "score", 7, stop_words=STOP_WORDS
    )
    return out.select("id", *[F.round(c, 6).alias(c) for c in ("score", "similarity", "final_score")])


@query(
    "similar_items",
    rf"""WITH p AS (SELECT p_partkey AS id, {PROFILE_SQL} AS bag FROM part),
        t AS (SELECT id, unnest(regexp_extract_all(bag, '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM p),
        tf AS (SELECT id, term, count(*) AS tf FROM t WHERE term NOT IN {STOP_SQL} GROUP BY 1, 2),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
        wt AS (SELECT id, term, tf * (ln((1 + (SELECT count(DISTINCT id) FROM tf)) / (1 + df)) + 1) AS w FROM tf JOIN df USING (term)),
        nw AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM wt),
        s AS (SELECT x.id, y.id AS similar_id, sum(x.w * y.w) AS s FROM nw x JOIN nw y ON x.term = y.term AND x.id <> y.id GROUP BY 1, 2
              HAVING sum(x.w * y.w) >= 0.7 - 1e-9)
        SELECT id, similar_id, round(s, 6) AS similarity, (row_number() OVER (PARTITION BY id ORDER BY round(s, 9) DESC, similar_id))::INT AS rank
        FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY round(s, 9) DESC, similar_id) <= 5""",
)
def similar_items(spark, sf):
    """The five items most like every item."""
    items = part_profiles(spark, sf)
    found = recommend.similar_items(items, "id", X.word_tokens(F.col("bag")), least=0.7, top_n=5, stop_words=STOP_WORDS)
    return found.select("id", "rank", F.col("similar").alias("similar_id"), F.round("similarity", 6).alias("similarity"))


@query(
    "cosine_topn",
    """SELECT e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], a.embedding::DOUBLE[]), 6) AS similarity
       FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) a
       ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], a.embedding::DOUBLE[]) DESC, e.vec_id LIMIT 20""",
)
def cosine_topn(spark, sf):
    scored = recommend.cosine_to_anchor(table(spark, sf, "embeddings"), "vec_id", "embedding", 0)
    top = scored.orderBy(F.col("similarity").desc(), "vec_id").limit(20)
    return top.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(
    "knn_vote",
    """WITH s AS (SELECT vec_id, label, embedding::DOUBLE[] AS e,
                  ('0x' || substr(md5(vec_id::VARCHAR), 1, 8))::BIGINT % 100 < 80 AS t FROM embeddings),
       d AS (SELECT q.vec_id, r.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, r.e), r.vec_id) AS k
             FROM s q, s r WHERE NOT q.t AND r.t),
       v AS (SELECT vec_id, label, count(*) AS n FROM d WHERE k <= 5 GROUP BY 1, 2)
       SELECT vec_id, label AS predicted FROM v
       QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1""",
)
def knn_vote(spark, sf):
    split = splits.hash_split(table(spark, sf, "embeddings"), "vec_id", 80)
    test, train = split.where("split = 'test'"), split.where("split = 'train'")
    return neighbours.knn_vote(test, train, "vec_id", "embedding", "label")
