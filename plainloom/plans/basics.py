"""Scans, projections, filters, joins, grouped sums, dates and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from plainloom.functions import columns as C
from plainloom.functions import dates as D
from plainloom.operators import aggregate, ordering, quantiles, relational
from plainloom.plans.catalog import query
from plainloom.session import table

AS_OF = "2001-09-01 12:00:00"


@query(
    "item_popularity",
    """SELECT p_brand, sum(l_quantity) AS total_quantity
       FROM lineitem JOIN part ON l_partkey = p_partkey
       GROUP BY p_brand ORDER BY total_quantity DESC, p_brand""",
)
def item_popularity(spark, sf):
    # summed per part before the join: a best-selling part sends one row per task
    per_part = aggregate.group_sum(table(spark, sf, "lineitem"), ["l_partkey"], "l_quantity", "_q")
    joined = per_part.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    totals = aggregate.group_sum(joined, ["p_brand"], "_q", "total_quantity")
    return totals.orderBy(F.col("total_quantity").desc(), "p_brand")


@query(
    "customer_spend",
    """SELECT c_custkey, c_name, round(sum(o_totalprice), 4) AS spend
       FROM orders JOIN customer ON o_custkey = c_custkey
       GROUP BY c_custkey, c_name ORDER BY spend DESC, c_custkey""",
)
def customer_spend(spark, sf):
    spend = aggregate.group_sum(table(spark, sf, "orders"), ["o_custkey"], "o_totalprice", "_s")
    named = spend.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return named.select("c_custkey", "c_name", F.round("_s", 4).alias("spend")).orderBy(
        F.col("spend").desc(), "c_custkey"
    )


@query(
    "route_counts_bottom50",
    """SELECT l_suppkey || '--->' || l_partkey AS route, sum(l_quantity) AS trips
       FROM lineitem GROUP BY l_suppkey, l_partkey ORDER BY trips, route LIMIT 50""",
)
def route_counts_bottom50(spark, sf):
    sums = aggregate.group_sum(
        table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey"], "l_quantity", "trips"
    )
    route = F.concat(F.col("l_suppkey").cast("string"), F.lit("--->"), F.col("l_partkey").cast("string"))
    return sums.select(route.alias("route"), "trips").orderBy("trips", "route").limit(50)


@query(
    "origin_dest_dimension_twice",
    """SELECT o.n_name AS origin_n_name, d.n_name AS destination_n_name, count(*) AS shipments,
              sum(l_quantity) AS quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation o ON s_nationkey = o.n_nationkey JOIN nation d ON c_nationkey = d.n_nationkey
       GROUP BY ALL""",
)
def origin_dest_dimension_twice(spark, sf):
    li, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    trips = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("shipments"), F.sum("l_quantity").alias("quantity"))
    )
    named = relational.join_dimension_twice(
        trips,
        table(spark, sf, "nation"),
        "n_nationkey",
        ["n_name"],
        {"s_nationkey": "origin", "c_nationkey": "destination"},
    )
    return named.select("origin_n_name", "destination_n_name", "shipments", "quantity")


@query(
    "weekday_totals",
    """SELECT dayname(o_orderdate) AS day_name, round(sum(o_totalprice), 3) AS total, count(*) AS n
       FROM orders GROUP BY 1""",
)
def weekday_totals(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(D.weekday_name(F.col("o_orderdate")).alias("day_name"))
        .agg(F.round(F.sum("o_totalprice"), 3).alias("total"), F.count(F.lit(1)).alias("n"))
    )


@query(
    "yearly_totals",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 3) AS total
       FROM orders GROUP BY 1 ORDER BY 1""",
)
def yearly_totals(spark, sf):
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return orders.groupBy("year").agg(F.round(F.sum("o_totalprice"), 3).alias("total")).orderBy("year")


@query(
    "monthly_mean",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, round(avg(o_totalprice), 4) AS mean_price
       FROM orders GROUP BY 1 ORDER BY 1""",
)
def monthly_mean(spark, sf):
    month = D.month_bucket(F.col("o_orderdate")).alias("month")
    return (
        table(spark, sf, "orders")
        .groupBy(month)
        .agg(F.round(F.avg("o_totalprice"), 4).alias("mean_price"))
        .orderBy("month")
    )


@query(
    "mean_by_month_year",
    """SELECT CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
              round(avg(o_totalprice), 4) AS mean_price
       FROM orders GROUP BY 1, 2""",
)
def mean_by_month_year(spark, sf):
    orders = table(spark, sf, "orders")
    parts = orders.withColumns({"month": F.month("o_orderdate"), "year": F.year("o_orderdate")})
    return parts.groupBy("month", "year").agg(F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@query(
    "day_parts",
    """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
              CAST(day(ts) AS INTEGER) AS day, count(*) AS n
       FROM events GROUP BY 1, 2, 3""",
)
def day_parts(spark, sf):
    parts = table(spark, sf, "events").select(
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day")
    )
    return aggregate.value_counts(parts, ["year", "month", "day"])


@query(
    "late_hours_total",
    """SELECT round(sum(value), 4) AS total, count(*) AS n FROM events
       WHERE hour(ts) >= 22 OR hour(ts) < 6""",
)
def late_hours_total(spark, sf):
    late = table(spark, sf, "events").where(D.wraps_midnight(F.hour("ts"), 22, 6))
    return late.agg(F.round(F.sum("value"), 4).alias("total"), F.count(F.lit(1)).alias("n"))


@query(
    "project_filter",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_quantity <= 10 AND NOT (l_returnflag = 'R')""",
)
def project_filter(spark, sf):
    rows = table(spark, sf, "lineitem").where((F.col("l_quantity") <= 10) & ~(F.col("l_returnflag") == "R"))
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "derived_columns",
    """SELECT 'catalogue' AS origin, CAST(p_partkey AS VARCHAR) AS part_text, p_brand || ' ' || p_name AS title,
              p_size * p_size * p_retailprice AS volume, 2023 - p_size AS age,
              CASE WHEN length(p_name) > 8 THEN 1 ELSE 0 END AS long_name,
              round(pow(p_retailprice, 2), 4) AS price_squared,
              round(sqrt(p_retailprice), 6) AS price_root, abs(p_size - 25) AS size_distance,
              round_even(p_size / 2.0::DOUBLE, 0) AS half_size
       FROM part""",
)
def derived_columns(spark, sf):
    part = relational.drop_repeated_names(
        table(spark, sf, "part").select("p_size", "p_partkey", "p_name", "p_brand", "p_retailprice", "p_size")
    )
    derived = part.withColumns(
        {
            "origin": F.lit("catalogue"),
            "part_text": F.col("p_partkey").cast("string"),
            "title": F.concat("p_brand", F.lit(" "), "p_name"),
            "volume": F.col("p_size") * F.col("p_size") * F.col("p_retailprice"),
            "age": F.lit(2023) - F.col("p_size"),
            "long_name": F.when(F.length("p_name") > 8, 1).otherwise(0),
            "price_squared": F.round(F.pow("p_retailprice", F.lit(2)), 4),
            "price_root": F.round(F.sqrt("p_retailprice"), 6),
            "size_distance": F.abs(F.col("p_size") - 25),
            "half_size": C.half_even(F.col("p_size") / 2.0),
        }
    )
    return derived.drop(*part.columns)


@query(
    "columns_by_type",
    """SELECT l_extendedprice AS price, l_quantity AS quantity, l_discount AS discount, l_tax AS tax
       FROM lineitem""",
)
def columns_by_type(spark, sf):
    li = table(spark, sf, "lineitem")
    doubles = [f.name for f in li.schema.fields if f.dataType.typeName() == "double"]
    renamed = li.select(*doubles).toDF(*[n.removeprefix("l_") for n in doubles])
    return renamed.withColumnRenamed("extendedprice", "price").select("price", "quantity", "discount", "tax")


@query(
    "preview_head_tail",
    """SELECT 'head' AS part, o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 5)
       UNION ALL
       SELECT 'tail', o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 5)""",
)
def preview_head_tail(spark, sf):
    keys = table(spark, sf, "orders").select("o_orderkey")
    head = keys.orderBy("o_orderkey").limit(5).select(F.lit("head").alias("part"), "o_orderkey")
    return head.union(ordering.tail(keys, ["o_orderkey"], 5).select(F.lit("tail"), "o_orderkey"))


@query(
    "code_to_label",
    """SELECT label, count(*) AS n FROM orders LEFT JOIN
       (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) AS d(code, label)
       ON o_orderstatus = code GROUP BY label""",
)
def code_to_label(spark, sf):
    counts = aggregate.value_counts(table(spark, sf, "orders"), ["o_orderstatus"])
    labels = {"F": "finished", "O": "open", "P": "partial"}
    return relational.code_labels(counts, "o_orderstatus", labels).select("label", "n")


@query(
    "global_aggregates",
    """SELECT count(*) AS n, round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 6) AS mean,
              min(l_extendedprice) AS low, max(l_extendedprice) AS high,
              round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
              (SELECT l_shipdate::DATE::VARCHAR FROM lineitem GROUP BY l_shipdate
               ORDER BY count(*) DESC, l_shipdate LIMIT 1) AS busiest_day
       FROM lineitem""",
)
def global_aggregates(spark, sf):
    li = table(spark, sf, "lineitem")
    median = quantiles.medians(li, "l_extendedprice", [], "median")
    busiest = quantiles.modes(li, "l_shipdate")
    totals = li.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"),
        F.round(F.avg("l_extendedprice"), 6).alias("mean"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
    )
    return totals.withColumns(
        {
            "median": F.round(median.scalar(), 6),
            "busiest_day": busiest.select(F.date_format("mode", "yyyy-MM-dd")).scalar(),
        }
    )


@query(
    "group_max_count",
    """SELECT o_custkey, CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_order, count(o_orderdate) AS n_orders
       FROM orders GROUP BY o_custkey""",
)
def group_max_count(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_order"),
            F.count("o_orderdate").alias("n_orders"),
        )
    )


@query(
    "group_mode",
    """SELECT o_custkey, o_orderpriority AS usual_priority FROM (
         SELECT o_custkey, o_orderpriority, row_number() OVER
           (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS r
         FROM orders GROUP BY 1, 2) WHERE r = 1""",
)
def group_mode(spark, sf):
    return quantiles.modes(table(spark, sf, "orders"), "o_orderpriority", ["o_custkey"], "usual_priority")


@query(
    "group_median",
    """SELECT o_custkey, round(quantile_cont(o_totalprice, 0.5), 6) AS median_price
       FROM orders GROUP BY o_custkey""",
)
def group_median(spark, sf):
    out = quantiles.medians(table(spark, sf, "orders"), "o_totalprice", ["o_custkey"], "m")
    return out.select("o_custkey", F.round("m", 6).alias("median_price"))


@query(
    "arg_max_priority",
    """SELECT o_orderstatus, o_orderpriority AS top_priority FROM (
         SELECT o_orderstatus, o_orderpriority, row_number() OVER
           (PARTITION BY o_orderstatus ORDER BY max(o_totalprice) DESC, o_orderpriority) AS r
         FROM orders GROUP BY 1, 2) WHERE r = 1""",
)
def arg_max_priority(spark, sf):
    return aggregate.arg_max(
        table(spark, sf, "orders"), ["o_orderstatus"], "o_orderpriority", "o_totalprice", "top_priority"
    )


@query(
    "parse_dates",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS iso,
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS compact, CAST(NULL AS VARCHAR) AS broken
       FROM orders""",
)
def parse_dates(spark, sf):
    day = F.col("o_orderdate")
    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(day, "dd/MM/yyyy").alias("a"),
        F.date_format(day, "yyyyMMddHHmmss").alias("b"),
        F.concat(F.lit("not "), F.date_format(day, "yyyy")).alias("c"),
    )
    out = "yyyy-MM-dd HH:mm:ss"
    return texts.select(
        "o_orderkey",
        F.date_format(D.parse_time(F.col("a"), "dd/MM/yyyy"), out).alias("iso"),
        F.date_format(D.parse_time(F.col("b"), "yyyyMMddHHmmss"), out).alias("compact"),
        F.date_format(D.parse_time(F.col("c"), "dd/MM/yyyy"), out).alias("broken"),
    )


@query(
    "sort_by_time",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey, o_totalprice
       FROM orders ORDER BY o_orderdate, o_orderkey""",
)
def sort_by_time(spark, sf):
    sorted_orders = table(spark, sf, "orders").orderBy("o_orderdate", "o_orderkey")
    return sorted_orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", "o_totalprice"
    )


@query(
    "top_orders",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def top_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(
    "union_positional",
    """SELECT n_nationkey AS key, n_name AS name FROM nation
       UNION ALL SELECT r_regionkey, r_name FROM region""",
)
def union_positional(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return nation.union(table(spark, sf, "region")).toDF("key", "name")


@query(
    "side_by_side",
    """SELECT coalesce(a.o_custkey, b.c_custkey) AS custkey, c_acctbal, n_orders
       FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) a
       FULL JOIN customer b ON a.o_custkey = b.c_custkey""",
)
def side_by_side(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "custkey")
    counts = aggregate.value_counts(orders, ["custkey"], "n_orders")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_acctbal")
    return relational.side_by_side(customers, counts, "custkey").select("custkey", "c_acctbal", "n_orders")


@query(
    "labels_by_name",
    """SELECT lang, quality, toxic, count(*) AS n FROM documents JOIN labels USING (doc_id)
       GROUP BY ALL""",
)
def labels_by_name(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id")
    return joined.groupBy("lang", "quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_values", "SELECT DISTINCT p_type, p_size FROM part")
def distinct_values(spark, sf):
    return table(spark, sf, "part").select("p_type", "p_size").distinct()


@query(
    "rfm",
    f"""SELECT o_custkey, CAST(floor(epoch(TIMESTAMP '{AS_OF}' - max(o_orderdate)) / 86400) AS INTEGER) AS recency,
              count(o_orderdate) AS frequency, round(sum(o_totalprice), 4) AS monetary
        FROM orders GROUP BY o_custkey""",
)
def rfm(spark, sf):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    out = aggregate.rfm(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice", as_of)
    return out.withColumn("monetary", F.round("monetary", 4))


@query(
    "union_sources",
    """SELECT 'customer' AS source, c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
       FROM customer UNION ALL
       SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def union_sources(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")
    )
    return relational.union_sources({"customer": customers, "supplier": suppliers})


@query(
    "left_join_keep",
    """SELECT p_partkey, p_name, sold FROM part LEFT JOIN
       (SELECT l_partkey, sum(l_quantity) AS sold FROM lineitem WHERE l_quantity >= 45 GROUP BY 1)
       ON p_partkey = l_partkey""",
)
def left_join_keep(spark, sf):
    big = table(spark, sf, "lineitem").where("l_quantity >= 45")
    sold = aggregate.group_sum(big, ["l_partkey"], "l_quantity", "sold")
    part = table(spark, sf, "part")
    return part.join(sold, part.p_partkey == sold.l_partkey, "left").select("p_partkey", "p_name", "sold")


@query(
    "dedup_keep_first",
    """SELECT doc_id, lang, source, n_chars FROM (
         SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1""",
)
def dedup_keep_first(spark, sf):
    docs = table(spark, sf, "documents").withColumn("text", F.sha2("text", 256))
    return relational.keep_first(docs, ["text"], ["doc_id"]).drop("text")


@query("distinct_rows", "SELECT DISTINCT lang, source, n_chars, md5(text) AS text_md5 FROM documents")
def distinct_rows(spark, sf):
    return table(spark, sf, "documents").select("lang", "source", "n_chars", F.md5("text").alias("text_md5")).distinct()


@query(
    "duplicate_count",
    """SELECT count(*) AS n_rows, count(DISTINCT text) AS n_distinct,
              count(*) - count(DISTINCT text) AS n_duplicates FROM documents""",
)
def duplicate_count(spark, sf):
    return relational.duplicate_count(table(spark, sf, "documents").select(F.sha2("text", 256).alias("text")))


@query(
    "top_repeated",
    """SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first_doc
       FROM documents GROUP BY text ORDER BY n DESC, digest LIMIT 10""",
)
def top_repeated(spark, sf):
    docs = table(spark, sf, "documents").select(F.sha2("text", 256).alias("digest"), "doc_id")
    counts = docs.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))
    return counts.orderBy(F.col("n").desc(), "digest").limit(10)
