"""Models on data whose fit has a closed form or a known optimum, so that SQL can say it."""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from plainloom.operators import cluster, models, series
from plainloom.plans.catalog import query
from plainloom.plans.modelling import VECTORS_SQL, vector_split
from plainloom.session import dealt, scratch, stage, table
from plainloom.sources import readers, writers


def binary_orders(spark, sf):
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double").alias("urgent")
    label = (F.col("o_orderstatus") == "F").cast("double").alias("label")
    return models.assemble(table(spark, sf, "orders").select(urgent, label), ["urgent"])


@query(
    "logistic_closed",
    """WITH o AS (SELECT (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS x, (o_orderstatus = 'F')::INT AS y FROM orders),
        k AS (SELECT ln(count(*) FILTER (x = 0 AND y = 1) / count(*) FILTER (x = 0 AND y = 0)) AS at0,
                     ln(count(*) FILTER (x = 1 AND y = 1) / count(*) FILTER (x = 1 AND y = 0)) AS at1 FROM o)
        SELECT round(at0, 4) AS intercept, round(at1 - at0, 4) AS urgent FROM k""",
)
def logistic_closed(spark, sf):
    """With one two-valued feature the coefficients are log odds."""
    rows = binary_orders(spark, sf)
    model = models.fit(LogisticRegression(maxIter=200, tol=1e-12, standardization=False), rows)
    found = [(round(model.intercept, 4), round(float(model.coefficients[0]), 4))]
    return spark.createDataFrame(found, "intercept double, urgent double")


def stump_rows(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_linenumber", "l_extendedprice")
    label = (F.col("l_extendedprice") / 1000 + F.col("l_quantity") > 75).cast("double")
    return models.assemble(li, ["l_quantity", "l_linenumber"]).withColumn("label", label)


# Every split of either feature midway between two of its values, with what stands on its left and right.
STUMP_SQL = """r AS (SELECT l_quantity::DOUBLE AS q, l_linenumber::DOUBLE AS n, (l_extendedprice / 1000 + l_quantity > 75)::INT AS y,
                     l_extendedprice AS price FROM lineitem),
    f AS (SELECT 'l_quantity' AS feature, q AS x, y, price FROM r UNION ALL SELECT 'l_linenumber', n, y, price FROM r),
    v AS (SELECT feature, x, count(*) AS n, sum(y) AS p, sum(price) AS s, sum(price * price) AS ss FROM f GROUP BY 1, 2),
    c AS (SELECT feature, (x + lead(x) OVER w) / 2 AS cut,
                 sum(n) OVER w AS ln, sum(p) OVER w AS lp, sum(s) OVER w AS ls, sum(ss) OVER w AS lss,
                 sum(n) OVER t AS an, sum(p) OVER t AS ap, sum(s) OVER t AS asum, sum(ss) OVER t AS ass
          FROM v WINDOW w AS (PARTITION BY feature ORDER BY x), t AS (PARTITION BY feature)),
    d AS (SELECT feature, cut, ln, an - ln AS rn, lp / ln AS lshare, (ap - lp) / (an - ln) AS rshare,
                 ls / ln AS lmean, (asum - ls) / (an - ln) AS rmean, lss, ass FROM c WHERE cut IS NOT NULL),
    gini AS (SELECT * FROM d ORDER BY ln * 2 * lshare * (1 - lshare) + rn * 2 * rshare * (1 - rshare) LIMIT 1),
    sse AS (SELECT * FROM d ORDER BY ass - ln * lmean * lmean - rn * rmean * rmean LIMIT 1)"""


@query(
    "stump_classify",
    f"""WITH {STUMP_SQL} SELECT DISTINCT q AS l_quantity, n AS l_linenumber,
        round(CASE WHEN CASE feature WHEN 'l_quantity' THEN q ELSE n END <= cut THEN lshare ELSE rshare END, 6) AS chance FROM r, gini""",
)
def stump_classify(spark, sf):
    """A tree of one split: of all splits that of least impurity, and the share of ones on its sides."""
    rows = stump_rows(spark, sf)
    model = models.fit(DecisionTreeClassifier(maxDepth=1, maxBins=64, seed=1), rows, ["features", "label"])
    scored = model.transform(rows.select("features").distinct())
    chance = F.round(vector_to_array("probability")[1], 6).alias("chance")
    x = vector_to_array("features")
    return scored.select(x[0].alias("l_quantity"), x[1].alias("l_linenumber"), chance)


@query("stump_importance", f"""WITH {STUMP_SQL} SELECT f.feature, (f.feature = gini.feature)::INT::DOUBLE AS importance
        FROM (SELECT DISTINCT feature FROM d) f, gini""")
def stump_importance(spark, sf):
    """The only split gives its feature all importance."""
    rows = stump_rows(spark, sf)
    model = models.fit(DecisionTreeClassifier(maxDepth=1, maxBins=64, seed=1), rows, ["features", "label"])
    return models.importance_table(model, ["l_quantity", "l_linenumber"], rows)


@query(
    "stump_regress",
    f"""WITH {STUMP_SQL} SELECT DISTINCT q AS l_quantity, n AS l_linenumber,
        round(CASE WHEN CASE feature WHEN 'l_quantity' THEN q ELSE n END <= cut THEN lmean ELSE rmean END, 3) AS expected FROM r, sse""",
)
def stump_regress(spark, sf):
    """A regression tree of one split: that of least squared error, and the means of its sides."""
    rows = stump_rows(spark, sf)
    tree = DecisionTreeRegressor(labelCol="l_extendedprice", maxDepth=1, maxBins=64, seed=1)
    scored = models.fit(tree, rows, ["features", "l_extendedprice"]).transform(rows.select("features").distinct())
    x = vector_to_array("features")
    return scored.select(x[0].alias("l_quantity"), x[1].alias("l_linenumber"), F.round("prediction", 3).alias("expected"))


@query(
    "boosting_one_round",
    f"""WITH {STUMP_SQL} SELECT DISTINCT q AS l_quantity, n AS l_linenumber,
        round(1 / (1 + exp(-2 * (2 * CASE WHEN CASE feature WHEN 'l_quantity' THEN q ELSE n END <= cut THEN lshare ELSE rshare END - 1))), 6) AS chance
        FROM r, gini""",
)
def boosting_one_round(spark, sf):
    """One round of boosting fits a stump to labels of -1 and 1; the chance is the logistic function of twice its value."""
    rows = stump_rows(spark, sf)
    trees = GBTClassifier(maxIter=1, maxDepth=1, maxBins=64, seed=1)
    scored = models.fit(trees, rows, ["features", "label"]).transform(rows.select("features").distinct())
    x = vector_to_array("features")
    chance = F.round(vector_to_array("probability")[1], 6).alias("chance")
    return scored.select(x[0].alias("l_quantity"), x[1].alias("l_linenumber"), chance)


@query(
    "adaboost_one_round",
    f"""WITH {STUMP_SQL}, e AS (SELECT *, (ln * least(lshare, 1 - lshare) + rn * least(rshare, 1 - rshare)) / (ln + rn) AS missed FROM gini)
        SELECT DISTINCT q AS l_quantity, n AS l_linenumber, round(ln((1 - missed) / missed)
               * CASE WHEN CASE feature WHEN 'l_quantity' THEN q ELSE n END <= cut THEN sign(lshare - 0.5) ELSE sign(rshare - 0.5) END, 6) AS score
        FROM r, e""",
)
def adaboost_one_round(spark, sf):
    """The first round's stump votes with the log odds of its being right."""
    rows = stump_rows(spark, sf)
    with models.reused(rows.select("features", "label")) as data:
        model = models.AdaBoost(rounds=1, bins=64).fit(data)
    scored = model.transform(rows.select("features").distinct())
    x = vector_to_array("features")
    return scored.select(x[0].alias("l_quantity"), x[1].alias("l_linenumber"), F.round("score", 6).alias("score"))


SEPARABLE_SQL = """SELECT DISTINCT l_quantity::INT AS l_quantity, (l_quantity > 25)::INT AS predicted FROM lineitem
    WHERE l_quantity NOT BETWEEN 18 AND 32"""


def separable(spark, sf, estimator):
    """Classes with a gap between them: a sound fit makes no mistake."""
    li = table(spark, sf, "lineitem").where("l_quantity NOT BETWEEN 18 AND 32")
    rows = models.assemble(li.select("l_quantity", (F.col("l_quantity") / 50).alias("q")), ["q"])
    rows = rows.withColumn("label", (F.col("l_quantity") > 25).cast("double"))
    model = models.fit(estimator, rows, ["features", "label"])
    scored = model.transform(rows.select("l_quantity", "features").distinct())
    return scored.select(F.col("l_quantity").cast("int").alias("l_quantity"), F.col("prediction").cast("int").alias("predicted"))


@query("svm_separable", SEPARABLE_SQL)
def svm_separable(spark, sf):
    return separable(spark, sf, models.linear_svm(maxIter=50))


@query("forest_separable", SEPARABLE_SQL)
def forest_separable(spark, sf):
    return separable(spark, sf, RandomForestClassifier(numTrees=10, maxDepth=3, maxBins=64, seed=1))


@query("bagging_separable", SEPARABLE_SQL)
def bagging_separable(spark, sf):
    return separable(spark, sf, models.bagged_trees(10))


@query("mlp_separable", SEPARABLE_SQL)
def mlp_separable(spark, sf):
    return separable(spark, sf, MultilayerPerceptronClassifier(layers=[1, 4, 2], maxIter=200, seed=3))


def grouped_points(spark, sf):
    """Balances of three groups of customers, far apart."""
    value = (F.col("c_acctbal") / 1000 + 100 * (F.col("c_nationkey") % 3)).alias("x")
    return models.assemble(table(spark, sf, "customer").select("c_custkey", value), ["x"])


POINTS_SQL = """p AS (SELECT c_custkey, c_acctbal / 1000 + 100 * (c_nationkey % 3) AS x, c_nationkey % 3 AS g FROM customer),
    s AS (SELECT g, count(*) AS n, avg(x) AS m, sum(x) AS sx, sum(x * x) AS sxx, min(c_custkey) AS least FROM p GROUP BY 1)"""


@query(
    "kmeans_separated",
    f"""WITH {POINTS_SQL} SELECT c_custkey, least AS cluster_of, round(m, 4) AS centre FROM p, s
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY abs(x - m)) = 1""",
)
def kmeans_separated(spark, sf):
    """Far groups: the best centres are their means. A cluster is named by its smallest key."""
    rows = grouped_points(spark, sf)
    model = models.fit(cluster.estimator(3, max_iter=50, tol=1e-9), rows, ["features"])
    assigned = model.transform(rows)
    names = assigned.groupBy("cluster").agg(F.min("c_custkey").alias("cluster_of"))
    centres = spark.createDataFrame([(i, round(float(c[0]), 4)) for i, c in enumerate(model.clusterCenters())], "cluster int, centre double")
    return assigned.join(names, "cluster").join(centres, "cluster").select("c_custkey", "cluster_of", "centre")


@query(
    "bisecting_separated",
    f"""WITH {POINTS_SQL} SELECT c_custkey, least AS cluster_of FROM p, s
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY abs(x - m)) = 1""",
)
def bisecting_separated(spark, sf):
    """The larger part is cut again, between the far groups."""
    rows = grouped_points(spark, sf)
    with models.reused(rows) as data:
        assigned = cluster.bisecting(data, 3).transform(data).select("c_custkey", "cluster")
        names = assigned.groupBy("cluster").agg(F.min("c_custkey").alias("cluster_of"))
        return stage(assigned.join(names, "cluster").select("c_custkey", "cluster_of"))


@query(
    "topics_separated",
    """SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_nationkey % 2) AS topic_of FROM customer""",
)
def topics_separated(spark, sf):
    """Two kinds of documents without a common word: each has its topic, named by its smallest key."""
    kind = F.col("c_nationkey") % 2
    picked = [((F.col("c_custkey") * (7 * i + 3) + i * i) % 10 + 10 * kind).cast("int") for i in range(12)]
    docs = table(spark, sf, "customer").select("c_custkey", F.array(*picked).alias("words"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda w: F.size(F.filter("words", lambda x: x == w)).cast("double"))
    rows = dealt(docs.select("c_custkey", array_to_vector(counts).alias("features")), "c_custkey")
    with models.reused(rows) as data:
        labelled = stage(cluster.label_topics(cluster.topics(data, 2, max_iter=40), data).select("c_custkey", "topic"))
    names = labelled.groupBy("topic").agg(F.min("c_custkey").alias("topic_of"))
    return labelled.join(names, "topic").select("c_custkey", "topic_of")


@query("elbow_separated", f"WITH {POINTS_SQL} SELECT 3 AS k, round(sum((x - m) ** 2), 2) AS sse FROM p JOIN s USING (g)")
def elbow_separated(spark, sf):
    curve = cluster.elbow(grouped_points(spark, sf), [3], max_iter=50, tol=1e-9)
    return curve.withColumn("sse", F.round("sse", 2))


@query(
    "silhouette_separated",
    f"""WITH {POINTS_SQL}, d AS (SELECT c_custkey, p.g AS own, s.g, s.n, x * x + sxx / n - 2 * x * sx / n AS far FROM p, s),
        ab AS (SELECT c_custkey, max(CASE WHEN own = g THEN far * n / (n - 1) END) AS a, min(CASE WHEN own <> g THEN far END) AS b
               FROM d GROUP BY 1)
        SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette, count(*) AS n FROM ab""",
)
def silhouette_separated(spark, sf):
    rows = grouped_points(spark, sf)
    model = models.fit(cluster.estimator(3, max_iter=50, tol=1e-9), rows, ["features"])
    value = cluster.silhouette(model.transform(rows))
    return rows.agg(F.lit(round(value, 6)).alias("silhouette"), F.count(F.lit(1)).alias("n"))


PRIORITY_NAMES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_COUNTS_SQL = ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS p{i}" for i, p in enumerate(PRIORITY_NAMES))
_LOGS_SQL = " + ".join(f"c.p{i} * ln((s.p{i} + 1) / (s.p0 + s.p1 + s.p2 + s.p3 + s.p4 + 5))" for i in range(5))


@query(
    "nb_multinomial_closed",
    f"""WITH c AS (SELECT o_custkey, any_value(c_nationkey) % 2 AS y, {_COUNTS_SQL} FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
        s AS (SELECT y, count(*) AS n, {", ".join(f"sum(p{i}) AS p{i}" for i in range(5))} FROM c GROUP BY 1),
        l AS (SELECT o_custkey, s.y, ln((s.n + 1) / ((SELECT count(*) FROM c) + 2)) + {_LOGS_SQL} AS ll FROM c, s)
        SELECT o_custkey, round(1 / (1 + exp(max(CASE WHEN y = 0 THEN ll END) - max(CASE WHEN y = 1 THEN ll END))), 6) AS chance
        FROM l GROUP BY 1""",
)
def nb_multinomial_closed(spark, sf):
    """Chance of an odd nation by how often a customer used each order priority."""
    used = [F.count_if(F.col("o_orderpriority") == p).cast("double") for p in PRIORITY_NAMES]
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.array(*used).alias("used"))
    customers = table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") % 2).cast("double").alias("label"))
    rows = counts.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select("o_custkey", "label", array_to_vector("used").alias("features"))
    model = models.fit(NaiveBayes(modelType="multinomial", smoothing=1.0), rows, ["features", "label"])
    return model.transform(rows).select("o_custkey", F.round(vector_to_array("probability")[1], 6).alias("chance"))


_GAUSSIAN = """ll AS (SELECT vec_id, label, y, ln(any_value(n) / any_value(total)) - 0.5 * sum(ln(2 * pi() * v) + (x - m) ** 2 / v) AS ll
    FROM x JOIN (SELECT label AS y, j, avg(x) AS m, var_pop(x) AS v FROM x WHERE t GROUP BY 1, 2) USING (j) JOIN c USING (y)
    WHERE NOT t GROUP BY 1, 2, 3),
    b AS (SELECT label, y FROM ll QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY ll DESC, y) = 1)"""


@query(
    "model_reports",
    f"""WITH {VECTORS_SQL}, {_GAUSSIAN}, k AS (SELECT DISTINCT label AS class FROM b UNION SELECT DISTINCT y FROM b),
        h AS (SELECT class, count(*) FILTER (label = class AND y = class) AS hit, count(*) FILTER (label = class) AS support,
              count(*) FILTER (y = class) AS named FROM k, b GROUP BY 1)
        SELECT 'gaussian' AS model, class::DOUBLE AS class, round(coalesce(hit / nullif(named, 0), 0), 6) AS precision,
               round(coalesce(hit / nullif(support, 0), 0), 6) AS recall, round(coalesce(2 * hit / nullif(named + support, 0), 0), 6) AS f1,
               support FROM h""",
)
def model_reports(spark, sf):
    """Precision, recall and F1 of every class for each model that is compared."""
    train, test = vector_split(spark, sf)
    reports, _ = models.compare_reports({"gaussian": NaiveBayes(modelType="gaussian")}, train, test)
    return reports.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "model_confusion",
    f"""WITH {VECTORS_SQL}, {_GAUSSIAN} SELECT 'gaussian' AS model, label::DOUBLE AS truth, y::DOUBLE AS predicted, count(*) AS n,
        round(count(*) / sum(count(*)) OVER (PARTITION BY label), 6) AS share FROM b GROUP BY label, y""",
)
def model_confusion(spark, sf):
    """Confusion of classes for each model that is compared."""
    train, test = vector_split(spark, sf)
    _, cells = models.compare_reports({"gaussian": NaiveBayes(modelType="gaussian")}, train, test)
    return cells.withColumn("share", F.round("share", 6))


@query(
    "lag_vectors",
    """SELECT event_id, l3, l2, l1 FROM (SELECT event_id, lag(value, 3) OVER s AS l3, lag(value, 2) OVER s AS l2, lag(value, 1) OVER s AS l1
       FROM events WINDOW s AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE l3 IS NOT NULL""",
)
def lag_vectors(spark, sf):
    lags = series.lookback_windows(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value", 3)
    entries = vector_to_array(array_to_vector("features"))
    return lags.select("event_id", *[entries[i].alias(f"l{3 - i}") for i in range(3)])


@query(
    "submission_file",
    """SELECT o_orderkey, ((SELECT regr_intercept(l_extendedprice, l_quantity) FROM lineitem)
              + (SELECT regr_slope(l_extendedprice, l_quantity) FROM lineitem) * (o_orderkey % 50))::DECIMAL(18, 0)::BIGINT AS price FROM orders""",
)
def submission_file(spark, sf):
    """New rows scored, written as a file of key and whole-numbered prediction, and read again."""
    li = models.assemble(table(spark, sf, "lineitem").select(F.col("l_quantity").alias("q"), "l_extendedprice"), ["q"])
    model = models.linear_regression("l_extendedprice").fit(li)
    new = models.assemble(table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 50).cast("double").alias("q")), ["q"])
    rounded = model.transform(new).select("o_orderkey", F.round("prediction").cast("long").alias("price"))
    path = scratch(spark)
    writers.write_csv(rounded, path)
    return readers.read_csv(spark, path, rounded.schema)
