"""Profiles, distributions, missing values, cleaning and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from plainloom.functions import columns as C
from plainloom.operators import aggregate, fill, ordering, profile, quantiles, splits
from plainloom.plans.catalog import query
from plainloom.session import table

PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# orders and lineitem with nulls put in by a rule, the same in both engines
GAPPY_ORDERS_SQL = """gappy AS (SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status FROM orders)"""


def gappy_orders(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(key % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(key % 11 != 0, F.col("o_orderstatus")).alias("status"),
    )


@query(
    "null_profile",
    f"""WITH {GAPPY_ORDERS_SQL},
        c AS (SELECT count(*) AS n, count(*) FILTER (price IS NULL) AS a, count(*) FILTER (priority IS NULL) AS b,
                     count(*) FILTER (status IS NULL) AS c FROM gappy)
        SELECT 'price' AS "column", a AS n_null, round(a / n, 6) AS ratio FROM c
        UNION ALL SELECT 'priority', b, round(b / n, 6) FROM c
        UNION ALL SELECT 'status', c, round(c / n, 6) FROM c
        UNION ALL SELECT 'o_orderkey', 0, 0.0::DOUBLE FROM c
        UNION ALL SELECT '(all)', a + b + c, round((a + b + c) / (4 * n), 6) FROM c""",
)
def null_profile(spark, sf):
    out = profile.null_profile(gappy_orders(spark, sf), ["o_orderkey", "price", "priority", "status"])
    return out.withColumn("ratio", F.round("ratio", 6)).orderBy(F.col("ratio").desc(), "column")


def _describe_sql(columns, source):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 6) AS std,
            min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(quantile_cont({c}, 0.25), 6) AS q25,
            round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75 FROM {source}"""
        for c in columns
    )


@query("describe", _describe_sql(PRICES, "lineitem"))
def describe(spark, sf):
    out = profile.describe(table(spark, sf, "lineitem"), PRICES)
    rounded = {c: F.round(c, 6) for c in ("std", "q25", "median", "q75")}
    return out.withColumns({"mean": F.round("mean", 8), **rounded})


@query(
    "shape_and_types",
    """SELECT count(*) AS n_rows, 6 AS n_columns, count(DISTINCT o_orderkey) AS n_keys FROM orders""",
)
def shape_and_types(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(orders.columns)).alias("n_columns"),
        F.count_distinct("o_orderkey").alias("n_keys"),
    )


ROLE_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query(
    "cardinality_roles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct, """
        + (
            "'categorical' AS role"
            if c in ("p_name", "p_brand", "p_type")
            else f"CASE WHEN count(DISTINCT {c}) < 60 THEN 'ordinal' ELSE 'numeric' END AS role"
        )
        + " FROM part"
        for c in ROLE_COLUMNS
    ),
)
def cardinality_roles(spark, sf):
    return profile.column_roles(table(spark, sf, "part"), threshold=60)


PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_null,
        round(count(*) FILTER ({c} IS NULL) / count(*), 6) AS ratio, count(DISTINCT {c}) AS n_distinct,
        count({c}) AS n, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 6) AS std,
        min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(quantile_cont({c}, 0.25), 6) AS q25,
        round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75,
        (SELECT CAST(least(9, floor(({c} - lo) / (hi - lo) * 10)) AS INTEGER)
         FROM t, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM t) WHERE {c} IS NOT NULL
         GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS modal_bin,
        round(corr({c}, l_extendedprice), 6) AS target_corr FROM t"""
    for c in ["l_quantity", "l_discount"]
)


@query(
    "column_profile",
    f"""WITH t AS (SELECT l_extendedprice, l_discount,
          CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem) {PROFILE_SQL}""",
)
def column_profile(spark, sf):
    quantity = F.when(F.col("l_orderkey") % 9 != 0, F.col("l_quantity"))
    li = table(spark, sf, "lineitem").select("l_extendedprice", "l_discount", quantity.alias("l_quantity"))
    out = profile.column_profile(li, ["l_quantity", "l_discount"], "l_extendedprice")
    rounded = {c: F.round(c, 6) for c in ("ratio", "std", "q25", "median", "q75", "target_corr")}
    return out.withColumns({"mean": F.round("mean", 8), **rounded})


@query(
    "value_shares",
    """SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 6) AS share
       FROM events GROUP BY 1""",
)
def value_shares(spark, sf):
    out = aggregate.value_shares(table(spark, sf, "events"), "event_type")
    return out.withColumn("share", F.round("share", 6))


@query(
    "top5_and_others",
    """WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1),
       r AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_brand) AS r FROM c)
       SELECT CASE WHEN r <= 5 THEN p_brand ELSE 'Others' END AS p_brand, CAST(sum(n) AS BIGINT) AS n,
              round(sum(n) / (SELECT sum(n) FROM c), 6) AS share FROM r GROUP BY 1""",
)
def top5_and_others(spark, sf):
    out = aggregate.top_k_and_others(table(spark, sf, "part"), "p_brand", 5)
    return out.withColumn("share", F.round("share", 6))


@query(
    "nested_counts",
    """SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2
       ORDER BY l_suppkey, n DESC, l_quantity""",
)
def nested_counts(spark, sf):
    counts = aggregate.value_counts(table(spark, sf, "lineitem"), ["l_suppkey", "l_quantity"])
    return counts.orderBy("l_suppkey", F.col("n").desc(), "l_quantity")


@query(
    "two_way_counts",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2",
)
def two_way_counts(spark, sf):
    return aggregate.value_counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query(
    "quantiles",
    " UNION ALL ".join(
        f"""SELECT event_type, {p}::DOUBLE AS prob, round(quantile_cont(value, {p}), 6) AS value
            FROM events GROUP BY event_type"""
        for p in (0.05, 0.25, 0.5, 0.8, 0.97)
    ),
)
def quantiles_by_type(spark, sf):
    probs = [0.05, 0.25, 0.5, 0.8, 0.97]
    out = quantiles.quantiles(table(spark, sf, "events"), ["value"], probs, ["event_type"])
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("q").alias("value"))
    return out.select("event_type", F.explode(pairs).alias("_p")).select(
        "event_type", "_p.prob", F.round("_p.value", 6).alias("value")
    )


@query(
    "outlier_cut",
    """WITH q AS (SELECT quantile_cont(l_quantity, 0.97) a, quantile_cont(l_extendedprice, 0.97) b,
                         quantile_cont(l_tax, 0.97) c FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q
       WHERE l_quantity < a AND l_extendedprice < b AND l_tax < c""",
)
def outlier_cut(spark, sf):
    kept = profile.outlier_cut(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return kept.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "box_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) a, quantile_cont(value, 0.5) m,
                         quantile_cont(value, 0.75) b FROM events GROUP BY 1),
       f AS (SELECT *, a - 1.5 * (b - a) AS lo, b + 1.5 * (b - a) AS hi FROM q)
       SELECT event_type, round(a, 6) AS q25, round(m, 6) AS median, round(b, 6) AS q75,
              min(value) FILTER (value BETWEEN lo AND hi) AS whisker_low,
              max(value) FILTER (value BETWEEN lo AND hi) AS whisker_high,
              count(*) FILTER (value NOT BETWEEN lo AND hi) AS n_outliers
       FROM events JOIN f USING (event_type) GROUP BY event_type, a, m, b""",
)
def box_stats(spark, sf):
    out = profile.box_stats(table(spark, sf, "events"), "value", ["event_type"])
    return out.withColumns({c: F.round(c, 6) for c in ("q25", "median", "q75")})


@query(
    "histogram_hue",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
       SELECT CAST(least(29, floor((value - lo) / (hi - lo) * 30)) AS INTEGER) AS bin, event_type, count(*) AS n,
              round(lo + (hi - lo) / 30 * least(29, floor((value - lo) / (hi - lo) * 30)), 6) AS left_edge,
              round(lo + (hi - lo) / 30 * (least(29, floor((value - lo) / (hi - lo) * 30)) + 1), 6) AS right_edge
       FROM events, e GROUP BY ALL""",
)
def histogram_hue(spark, sf):
    out = profile.histogram(table(spark, sf, "events"), "value", 30, "event_type")
    return out.withColumns({c: F.round(c, 6) for c in ("left_edge", "right_edge")})


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in PRICES
        for b in PRICES
    ),
)
def corr_matrix(spark, sf):
    out = profile.correlation_matrix(table(spark, sf, "lineitem"), PRICES)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    "corr_with_target",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(corr({c}, l_extendedprice), 6) AS corr,
            round(abs(corr({c}, l_extendedprice)), 6) AS abs_corr FROM lineitem"""
        for c in PRICES
    ),
)
def corr_with_target(spark, sf):
    out = profile.correlation_with_target(table(spark, sf, "lineitem"), PRICES, "l_extendedprice")
    return out.withColumns({c: F.round(c, 6) for c in ("corr", "abs_corr")})


@query(
    "ttest",
    """SELECT round((avg(l_discount) - avg(l_tax)) / sqrt(((count(l_discount) - 1) * var_samp(l_discount)
              + (count(l_tax) - 1) * var_samp(l_tax)) / (count(l_discount) + count(l_tax) - 2)
              * (1 / count(l_discount) + 1 / count(l_tax))), 4) AS t,
              count(l_discount) + count(l_tax) - 2 AS dof FROM lineitem""",
)
def ttest(spark, sf):
    out = profile.pooled_t(table(spark, sf, "lineitem"), "l_discount", "l_tax")
    return out.withColumn("t", F.round("t", 4))


@query(
    "fill_group_median",
    f"""WITH {GAPPY_ORDERS_SQL}
        SELECT o_orderkey, round(coalesce(price, median(price) OVER (PARTITION BY o_custkey)), 4) AS price
        FROM gappy""",
)
def fill_group_median(spark, sf):
    filled = fill.fill_group(gappy_orders(spark, sf), "price", ["o_custkey"], "median")
    return filled.select("o_orderkey", F.round("price", 4).alias("price"))


@query(
    "fill_group_mean",
    f"""WITH {GAPPY_ORDERS_SQL}
        SELECT o_orderkey, round(coalesce(price, CASE WHEN status IS NOT NULL THEN avg(price) OVER
               (PARTITION BY status) END), 4) AS price FROM gappy""",
)
def fill_group_mean(spark, sf):
    filled = fill.fill_group(gappy_orders(spark, sf), "price", ["status"], "mean")
    return filled.select("o_orderkey", F.round("price", 4).alias("price"))


@query(
    "fill_group_mode",
    f"""WITH {GAPPY_ORDERS_SQL},
        m AS (SELECT o_custkey, priority AS m FROM (SELECT o_custkey, priority, row_number() OVER
              (PARTITION BY o_custkey ORDER BY count(*) DESC, priority) AS r
              FROM gappy WHERE priority IS NOT NULL GROUP BY 1, 2) WHERE r = 1)
        SELECT o_orderkey, coalesce(priority, m) AS priority FROM gappy LEFT JOIN m USING (o_custkey)""",
)
def fill_group_mode(spark, sf):
    filled = fill.fill_group(gappy_orders(spark, sf), "priority", ["o_custkey"], "mode")
    return filled.select("o_orderkey", "priority")


@query(
    "fill_chain",
    f"""WITH {GAPPY_ORDERS_SQL}
        SELECT o_orderkey, round(coalesce(price, CASE WHEN status IS NOT NULL THEN median(price) OVER
               (PARTITION BY status) END, 800), 4) AS price FROM gappy""",
)
def fill_chain(spark, sf):
    filled = fill.fill_chain(gappy_orders(spark, sf), "price", ["status"], "median", 800.0)
    return filled.select("o_orderkey", F.round("price", 4).alias("price"))


@query(
    "fill_constants",
    f"""WITH {GAPPY_ORDERS_SQL}
        SELECT o_orderkey, coalesce(price, 0) AS price, coalesce(priority, 'None') AS priority,
               coalesce(status, '') AS status FROM gappy""",
)
def fill_constants(spark, sf):
    values = {"price": 0.0, "priority": "None", "status": ""}
    return fill.fill_constants(gappy_orders(spark, sf), values).drop("o_custkey")


@query(
    "fill_column_statistics",
    f"""WITH {GAPPY_ORDERS_SQL}
        SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM gappy)), 4) AS price_median,
               round(coalesce(price, (SELECT avg(price) FROM gappy)), 4) AS price_mean,
               coalesce(priority, (SELECT priority FROM gappy WHERE priority IS NOT NULL GROUP BY 1
                                   ORDER BY count(*) DESC, 1 LIMIT 1)) AS priority FROM gappy""",
)
def fill_column_statistics(spark, sf):
    gappy = gappy_orders(spark, sf).withColumns({"price_median": F.col("price"), "price_mean": F.col("price")})
    filled = fill.fill_statistic(gappy, "price_median", "median")
    filled = fill.fill_statistic(filled, "price_mean", "mean")
    filled = fill.fill_statistic(filled, "priority", "mode")
    return filled.select(
        "o_orderkey", F.round("price_median", 4).alias("price_median"),
        F.round("price_mean", 4).alias("price_mean"), "priority",
    )


@query(
    "coerce_numeric",
    """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 OR p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS price
       FROM part""",
)
def coerce_numeric(spark, sf):
    text = (
        F.when(F.col("p_partkey") % 5 == 0, "n/a")
        .when(F.col("p_partkey") % 7 == 0, "NaN")
        .otherwise(F.col("p_retailprice").cast("string"))
    )
    dirty = table(spark, sf, "part").select("p_partkey", text.alias("t"))
    return dirty.select("p_partkey", C.coerce_number(F.col("t")).alias("price"))


@query(
    "strip_commas",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS price
       FROM orders""",
)
def strip_commas(spark, sf):
    text = F.when(F.col("o_orderkey") % 11 == 0, "nan").otherwise(F.format_number(F.floor("o_totalprice"), 0))
    dirty = table(spark, sf, "orders").select("o_orderkey", text.alias("t"))
    return dirty.select("o_orderkey", C.comma_number(F.col("t")).alias("price"))


@query(
    "extract_digits",
    r"""SELECT c_custkey, CAST(nullif(regexp_extract(c_name, '(\d+)', 1), '') AS DOUBLE) AS number,
               nullif(regexp_extract(c_name, '([A-Za-z]+)#', 1), '') AS title FROM customer""",
)
def extract_digits(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        C.first_group(F.col("c_name"), r"(\d+)").cast("double").alias("number"),
        C.first_group(F.col("c_name"), "([A-Za-z]+)#").alias("title"),
    )


@query(
    "recode",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
              ELSE o_orderpriority END AS kept,
              CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 END AS nulled FROM orders""",
)
def recode(spark, sf):
    priority = F.col("o_orderpriority")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        C.recode(priority, {"1-URGENT": "high", "2-HIGH": "high"}).alias("kept"),
        C.recode(priority, {"1-URGENT": 2, "2-HIGH": 1}, keep_unmapped=False).alias("nulled"),
    )


@query(
    "conditional",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN o_totalprice / 10 ELSE o_totalprice END AS score,
              CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS flag FROM orders""",
)
def conditional(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(price > 300000, price / 10).otherwise(price).alias("score"),
        F.when(price > 250000, 1).otherwise(0).alias("flag"),
    )


@query(
    "null_row_filters",
    f"""WITH {GAPPY_ORDERS_SQL}
        SELECT 'any' AS rule, o_orderkey FROM gappy
        WHERE price IS NOT NULL AND priority IS NOT NULL AND status IS NOT NULL
        UNION ALL SELECT 'subset', o_orderkey FROM gappy WHERE price IS NOT NULL AND status IS NOT NULL
        UNION ALL SELECT 'missing', o_orderkey FROM gappy WHERE price IS NULL""",
)
def null_row_filters(spark, sf):
    # the three row sets from one scan
    gappy = gappy_orders(spark, sf)
    price, priority, status = (F.col(c).isNotNull() for c in ("price", "priority", "status"))
    rules = F.array_compact(
        F.array(
            F.when(price & priority & status, "any"),
            F.when(price & status, "subset"),
            F.when(~price, "missing"),
        )
    )
    return gappy.select(F.explode(rules).alias("rule"), "o_orderkey")


@query(
    "drop_null_rows",
    f"WITH {GAPPY_ORDERS_SQL} SELECT * FROM gappy WHERE price IS NOT NULL AND priority IS NOT NULL AND status IS NOT NULL",
)
def drop_null_rows(spark, sf):
    return gappy_orders(spark, sf).na.drop("any")


@query(
    "bad_rows",
    "SELECT CAST(p_partkey AS BIGINT) AS id, p_name FROM part WHERE p_partkey % 13 <> 0",
)
def bad_rows(spark, sf):
    text = F.when(F.col("p_partkey") % 13 == 0, "1997-08-20").otherwise(F.col("p_partkey").cast("string"))
    dirty = table(spark, sf, "part").select(text.alias("id"), "p_name")
    parsed = dirty.withColumn("id", F.col("id").try_cast("bigint"))
    return parsed.where(F.col("id").isNotNull())


@query(
    "positional_slice",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 4000 OFFSET 1000""",
)
def positional_slice(spark, sf):
    rows = ordering.positional_slice(table(spark, sf, "orders"), ["o_totalprice", "o_orderkey"], 1000, 5000)
    return rows.select("o_orderkey", "o_totalprice")


@query(
    "shuffle_rows",
    "SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS position FROM orders",
)
def shuffle_rows(spark, sf):
    hashed = table(spark, sf, "orders").select("o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("_h"))
    return ordering.number_rows(hashed, [], ["_h", "o_orderkey"]).select("o_orderkey", "position")


@query(
    "split_hash",
    """SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 100 < 80
              THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def split_hash(spark, sf):
    return splits.hash_split(table(spark, sf, "orders"), "o_orderkey", 80).select("o_orderkey", "split")


@query(
    "split_stratified",
    """SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id::VARCHAR), doc_id)
              <= count(*) OVER (PARTITION BY quality) * 0.7::DOUBLE THEN 'train' ELSE 'test' END AS split FROM labels""",
)
def split_stratified(spark, sf):
    split = splits.stratified_split(table(spark, sf, "labels"), "quality", "doc_id", 0.7)
    return split.select("doc_id", "quality", "split")


@query(
    "split_time",
    """SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS position,
              CASE WHEN row_number() OVER (ORDER BY ts, event_id)
                   <= round_even(count(*) OVER () * (1 - 0.33::DOUBLE), 0) THEN 'train' ELSE 'test' END AS split
       FROM events""",
)
def split_time(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return splits.ordered_split(events, [], ["ts", "event_id"], 0.33).select("event_id", "position", "split")
