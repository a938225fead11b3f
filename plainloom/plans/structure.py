"""Linkage, word vectors and profiles that can be added to."""

from __future__ import annotations

from pyspark.sql import functions as F

from plainloom.functions import text as X
from plainloom.operators import linkage, profile, sketches, wordvectors
from plainloom.operators.quantiles import quantiles
from plainloom.plans.catalog import query
from plainloom.session import scratch, table

CUT = 1.12


@query(
    "linkage_clusters",
    f"""WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        near AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id <> y.vec_id AND list_distance(x.e, y.e) <= {CUT}),
        reach(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT reach.a, near.b FROM reach JOIN near ON near.a = reach.b)
        SELECT a AS vec_id, min(b) AS cluster FROM reach GROUP BY 1""",
)
def linkage_clusters(spark, sf):
    """The single-linkage tree of all vectors, cut at a height."""
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return linkage.cut(linkage.spanning_tree(rows, "vec_id", "v"), rows, "vec_id", CUT)


_WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"


def conversation_weights(spark, sf):
    counts = wordvectors.cooccurrences(table(spark, sf, "conversations"), X.word_tokens(F.col("text")), window=4, min_count=5)
    return wordvectors.ppmi(counts)


@query(
    "ppmi_synonyms",
    f"""WITH t AS (SELECT row_number() OVER () AS r, {_WORDS_SQL} AS w FROM conversations),
        p AS (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS i FROM t),
        often AS (SELECT term FROM p GROUP BY 1 HAVING count(*) >= 5),
        c AS (SELECT x.term, y.term AS context, count(*) AS n FROM p x JOIN p y ON x.r = y.r AND abs(x.i - y.i) BETWEEN 1 AND 4
              WHERE x.term IN (SELECT term FROM often) AND y.term IN (SELECT term FROM often) GROUP BY 1, 2),
        s AS (SELECT term, sum(n) AS n FROM c GROUP BY 1),
        m AS (SELECT c.term, context, ln(c.n * (SELECT sum(n) FROM c) / (a.n * b.n)) AS w FROM c JOIN s a ON a.term = c.term
              JOIN s b ON b.term = c.context WHERE ln(c.n * (SELECT sum(n) FROM c) / (a.n * b.n)) > 0),
        z AS (SELECT term, sqrt(sum(w * w)) AS size FROM m GROUP BY 1),
        word AS (SELECT term FROM p WHERE term IN (SELECT term FROM m) GROUP BY 1 ORDER BY count(*) DESC, term LIMIT 1),
        d AS (SELECT m.term, sum(m.w * o.w) AS dot FROM m JOIN m o ON o.context = m.context AND o.term = (FROM word)
              WHERE m.term <> (FROM word) GROUP BY 1)
        SELECT term, round(dot / (size * (SELECT size FROM z WHERE term = (FROM word))), 6) AS similarity FROM d JOIN z USING (term)
        ORDER BY round(dot / (size * (SELECT size FROM z WHERE term = (FROM word))), 9) DESC, term LIMIT 10""",
)
def ppmi_synonyms(spark, sf):
    """The words used most like the most frequent one."""
    weights = conversation_weights(spark, sf)
    words = table(spark, sf, "conversations").select(F.explode(X.word_tokens(F.col("text"))).alias("term"))
    counts = words.join(weights.select("term").distinct(), "term").groupBy("term").count()
    word = counts.orderBy(F.col("count").desc(), "term").first()
    near = wordvectors.synonyms(weights, word["term"] if word else "", 10)
    return near.withColumn("similarity", F.round("similarity", 6))


@query(
    "profile_sketches",
    """SELECT 'value' AS "column", count(*) AS n_rows, count(value) AS n, count(*) - count(value) AS n_null, round(avg(value), 6) AS mean,
              min(value) AS min, max(value) AS max, true AS near FROM events
       UNION ALL SELECT 'user_id', count(*), count(user_id), count(*) - count(user_id), round(avg(user_id), 6), min(user_id)::DOUBLE,
              max(user_id)::DOUBLE, true FROM events""",
)
def profile_sketches(spark, sf):
    """Sketches of every day, stored, merged to a profile; ``near``: its estimates are within their bounds."""
    events, columns = table(spark, sf, "events"), ["value", "user_id"]
    path = scratch(spark)
    sketches.sketch(events, columns, F.to_date("ts")).write.parquet(path)
    found = sketches.profile(spark.read.parquet(path), [0.5])
    exact = profile.distinct_counts(events, columns).withColumnRenamed("n_distinct", "exact")
    # A rank error of 1.3 % lies between the exact quantiles a little further apart.
    bounds = quantiles(events, columns, [0.48, 0.52])
    joined = found.join(exact, "column").join(bounds.withColumnRenamed("q", "bounds"), "column")
    near = (F.abs(F.col("n_distinct") - F.col("exact")) <= F.col("exact") * 0.08) & F.col("q")[0].between(F.col("bounds")[0], F.col("bounds")[1])
    return joined.select("column", F.col("rows").alias("n_rows"), "n", "n_null", F.round("mean", 6).alias("mean"), "min", "max", near.alias("near"))
