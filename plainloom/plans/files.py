"""Files as sources and sinks: tables written in each format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from plainloom.operators import models
from plainloom.plans.catalog import query
from plainloom.session import scratch, table
from plainloom.sources import readers, writers


def written(spark, df, **options) -> str:
    path = scratch(spark)
    writers.write_csv(df, path, **options)
    return path


@query("csv_read", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_read(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return readers.read_csv(spark, written(spark, orders), orders.schema)


@query("tsv_read", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def tsv_read(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return readers.read_tsv(spark, written(spark, suppliers, header=False, sep="\t"), suppliers.schema)


@query(
    "snapshot_files",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 4) AS total, max(user_id)::DOUBLE AS last_user
       FROM events GROUP BY 1""",
)
def snapshot_files(spark, sf):
    stamp = F.date_format(F.date_trunc("day", "ts"), "yyyy.MM.dd.HH.mm.ss")
    events = table(spark, sf, "events").select(stamp.alias("stamp"), "value", F.col("user_id").cast("double").alias("user"))
    path = written(spark, events, header=False, sep="\t", partition_by=["stamp"])
    rows = readers.read_snapshots(spark, path, ["value", "user"], stamp="folder")
    sums = F.round(F.sum("value"), 4).alias("total")
    rows = rows.groupBy(F.date_format("file_ts", "yyyy-MM-dd").alias("day"))
    return rows.agg(F.count(F.lit(1)).alias("n"), sums, F.max("user").alias("last_user"))


@query("csv_encoding", "SELECT c_custkey, 'ä' || c_name || 'é' AS name FROM customer")
def csv_encoding(spark, sf):
    name = F.concat(F.lit("ä"), "c_name", F.lit("é")).alias("name")
    customers = table(spark, sf, "customer").select("c_custkey", name)
    path = written(spark, customers, encoding="ISO-8859-1")
    return readers.read_csv(spark, path, customers.schema, encoding="ISO-8859-1")


@query(
    "csv_malformed",
    """SELECT 'kept' AS side, count(*) AS n, sum(p_partkey)::BIGINT AS keys FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 7 <> 0
       UNION ALL SELECT 'rejected', count(*), sum(p_partkey)::BIGINT FROM part WHERE p_partkey % 10 = 0 OR p_partkey % 7 = 0""",
)
def csv_malformed(spark, sf):
    """Every tenth line has a field too many, every seventh one that is no number."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    line = F.concat_ws(",", key, F.when(F.col("p_partkey") % 7 == 0, "bad").otherwise(size))
    line = F.when(F.col("p_partkey") % 10 == 0, F.concat(line, F.lit(",1,2"))).otherwise(line)
    path = scratch(spark)
    table(spark, sf, "part").select(line.alias("value")).write.text(path)
    good, bad = readers.read_csv_with_rejects(spark, path, "key long, size int", header=False)
    n = F.count(F.lit(1)).alias("n")
    kept = good.agg(F.lit("kept").alias("side"), n, F.sum("key").alias("keys"))
    rejected = F.split(bad.columns[0], ",")[0].cast("long")
    return kept.unionByName(bad.agg(F.lit("rejected").alias("side"), n, F.sum(rejected).alias("keys")))


@query(
    "yearly_files",
    """SELECT year(o_orderdate)::INT AS year, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders
       WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY 1""",
)
def yearly_files(spark, sf):
    """A folder per year; only those of three years are read."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_orderdate"))
    folder = written(spark, orders, partition_by=["year"])
    rows = readers.read_csv(spark, [f"{folder}/year={y}" for y in (1995, 1996, 1997)], "o_orderkey long, o_orderdate timestamp_ntz")
    return rows.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
    )


@query(
    "dimension_files",
    """SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
       JOIN region ON r_regionkey = n_regionkey""",
)
def dimension_files(spark, sf):
    nations, regions = (table(spark, sf, name) for name in ("nation", "region"))
    nations = readers.read_csv(spark, written(spark, nations), nations.schema)
    regions = readers.read_csv(spark, written(spark, regions), regions.schema)
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    joined = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "n_name", "r_name")


@query("promoted_header", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def promoted_header(spark, sf):
    """Two sets of files with their columns in different order."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    odd = F.col("c_custkey") % 2 == 1
    paths = [written(spark, customers.where(odd)), written(spark, customers.where(~odd).select("c_acctbal", "c_custkey", "c_name"))]
    return readers.read_promoted(spark, paths, customers.schema)


@query("text_lines", "SELECT p_name AS value FROM part")
def text_lines(spark, sf):
    path = scratch(spark)
    table(spark, sf, "part").select(F.col("p_name").alias("value")).write.text(path)
    return readers.read_lines(spark, path)


@query(
    "json_nested",
    """SELECT r_name AS tag, n_name AS pattern FROM nation JOIN region ON r_regionkey = n_regionkey""",
)
def json_nested(spark, sf):
    """One document a region, with the region's nations nested in it."""
    nations = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("patterns"))
    joined = table(spark, sf, "region").join(nations, F.col("n_regionkey") == F.col("r_regionkey"))
    none = F.array().cast("array<string>").alias("responses")
    intent = F.struct(F.col("r_name").alias("tag"), "patterns", none)
    documents = joined.select("r_regionkey", F.array(intent).alias("intents"))
    path = scratch(spark)
    documents.write.partitionBy("r_regionkey").json(path)
    return readers.read_intents(spark, f"{path}/*/*.json").select("tag", F.explode("patterns").alias("pattern"))


@query(
    "file_catalogue",
    """SELECT 'class ' || label AS label, 1::BIGINT AS files, sum(length(vec_id::VARCHAR) + 1)::BIGINT AS bytes
       FROM embeddings GROUP BY 1, embeddings.label""",
)
def file_catalogue(spark, sf):
    """Files in a folder per class: listed, not read."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("value"), "label")
    path = scratch(spark)
    rows.repartition("label").write.partitionBy("label").text(path)
    labels = {f"label={i}": f"class {i}" for i in range(100)}
    files = readers.read_images(spark, path, labels).where(F.col("file_name").startswith("part-"))
    return files.groupBy("label").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


@query("csv_sink", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def csv_sink(spark, sf):
    """Written in a folder per status; only one folder is read again."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = written(spark, orders, partition_by=["o_orderstatus"])
    return readers.read_csv(spark, path, orders.schema).where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query("index_column", "SELECT c_custkey AS time, c_acctbal FROM customer")
def index_column(spark, sf):
    """A table written with its row index in an unnamed column, read again and the column named."""
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("Unnamed: 0"), "c_acctbal")
    again = readers.infer_csv(spark, written(spark, customers))
    named = readers.rename_index_column(again, "time")
    return named.select(F.col("time").cast("long").alias("time"), F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query(
    "model_files",
    """SELECT c_custkey, round((SELECT regr_intercept(o_totalprice, o_custkey) FROM orders)
              + (SELECT regr_slope(o_totalprice, o_custkey) FROM orders) * c_custkey, 2) AS expected FROM customer""",
)
def model_files(spark, sf):
    """A fitted model saved, loaded and applied to other rows."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").cast("double").alias("key"), "o_totalprice")
    path = scratch(spark)
    writers.save_model(models.linear_regression("o_totalprice").fit(models.assemble(orders, ["key"])), path)
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").cast("double").alias("key"))
    scored = writers.load_model(path).transform(models.assemble(customers, ["key"]))
    return scored.select("c_custkey", F.round("prediction", 2).alias("expected"))
