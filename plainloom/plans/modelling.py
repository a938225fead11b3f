"""Model fitting, scoring, evaluation, clustering and topics."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from plainloom.functions import arrays as A
from plainloom.functions import text as X
from plainloom.functions.dates import elapsed_days
from plainloom.operators import cluster, metrics, models, series, splits, textstats, word2vec
from plainloom.operators.features import label_encode, minmax_by_group
from plainloom.plans.catalog import query
from plainloom.session import FIT_PARTS, dealt, stage, table

CUTOFF = "2001-01-01 00:00:00"
HASH_SQL = "('0x' || substr(md5({k}::VARCHAR), 1, 8))::BIGINT % 100"
CHURN_COLUMNS = ["n_orders", "spend", "mean_spend", "recency", "balance"]


def churn_rows(spark, sf):
    """Customers described by their orders before the cut-off; churned = no order after it."""
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    before = F.col("o_orderdate") < cut
    per = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.sum(before.cast("double")).alias("n_orders"),
            F.sum(F.when(before, F.col("o_totalprice")).otherwise(0.0)).alias("spend"),
            F.max(F.when(before, F.col("o_orderdate"))).alias("last"),
            F.max((~before).cast("int")).alias("later"),
        )
        .where("n_orders > 0")
    )
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    return per.join(customers, per.o_custkey == customers.c_custkey).select(
        "c_custkey",
        "n_orders",
        "spend",
        (F.col("spend") / F.col("n_orders")).alias("mean_spend"),
        elapsed_days(cut, F.col("last")).cast("double").alias("recency"),
        "balance",
        (1.0 - F.col("later")).alias("label"),
    )


def churn_split(spark, sf):
    rows = splits.hash_split(models.assemble(churn_rows(spark, sf), CHURN_COLUMNS), "c_custkey", 80)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def vectors(spark, sf):
    features = array_to_vector(F.col("embedding").cast("array<double>"))
    return table(spark, sf, "embeddings").select(
        "vec_id", features.alias("features"), F.col("label").cast("double").alias("label")
    )


def vector_split(spark, sf, binary: bool = False):
    rows = vectors(spark, sf)
    if binary:
        rows = rows.withColumn("label", (F.col("label") >= 5).cast("double"))
    rows = splits.hash_split(rows, "vec_id", 80)
    return rows.where("split = 'train'"), rows.where("split = 'test'")


def token_rows(spark, sf):
    docs = dealt(table(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id")
    return docs.select(
        "doc_id", "lang", X.word_tokens(F.col("text")).alias("tokens")
    )


def quality_split(spark, sf):
    """Labelled documents as term counts."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    rows = splits.hash_split(token_rows(spark, sf).join(labels, "doc_id"), "doc_id", 80)
    train = rows.where("split = 'train'")
    counter = CountVectorizer(inputCol="tokens", outputCol="features", vocabSize=1000, minDF=5).fit(train)
    test = rows.where("split = 'test'")
    return tuple(counter.transform(part).select("label", "features") for part in (train, test))


def _scores(name, estimator, train, test):
    return models.classification_scores(models.fit(estimator, train, ["features", "label"]).transform(test), "label", name)


def _total(vector):
    return F.aggregate(models.stored_values(vector), F.lit(0.0), lambda s, x: s + x)


@query("gbt_churn")
def gbt_churn(spark, sf):
    train, test = churn_split(spark, sf)
    model = models.fit(models.boosted_trees(maxIter=10, maxDepth=4, seed=123), train)
    scored = model.transform(test).withColumn("p", vector_to_array("probability")[1])
    auc = metrics.auc(scored, "label", "p")
    return models.classification_scores(scored, "label", "gbt").withColumn("auc", auc.scalar())


@query("logistic_regression")
def logistic_regression(spark, sf):
    return _scores("logistic", LogisticRegression(maxIter=50), *vector_split(spark, sf))


VECTORS_SQL = f"""e AS (SELECT vec_id, label, embedding, {HASH_SQL.format(k='vec_id')} < 80 AS t FROM embeddings),
    x AS (SELECT vec_id, label, t, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS j FROM e),
    c AS (SELECT label AS y, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k FROM e WHERE t GROUP BY 1)"""
VOTE_SQL = """b AS (SELECT vec_id, label, y FROM ll QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY ll DESC, y) = 1)
    SELECT '{name}' AS model, avg(CASE WHEN y = label THEN 1.0::DOUBLE ELSE 0 END) AS accuracy, count(*) AS n,
           (SELECT max(n) FROM (SELECT count(*) AS n FROM b GROUP BY label)) / count(*) AS majority FROM b"""


@query(
    "nb_gaussian",
    f"""WITH {VECTORS_SQL}, s AS (SELECT label AS y, j, avg(x) AS m, var_pop(x) AS v FROM x WHERE t GROUP BY 1, 2),
        ll AS (SELECT vec_id, label, y, ln(any_value(n) / any_value(total)) - 0.5 * sum(ln(2 * pi() * v) + (x - m) ** 2 / v) AS ll
               FROM x JOIN s USING (j) JOIN c USING (y) WHERE NOT t GROUP BY 1, 2, 3),
        {VOTE_SQL.format(name='gaussian')}""",
)
def nb_gaussian(spark, sf):
    return _scores("gaussian", NaiveBayes(modelType="gaussian"), *vector_split(spark, sf))


@query(
    "nb_bernoulli",
    f"""WITH {VECTORS_SQL}, s AS (SELECT label AS y, j, (count(*) FILTER (x > 0) + 1) / (count(*) + 2) AS p FROM x WHERE t GROUP BY 1, 2),
        ll AS (SELECT vec_id, label, y, ln((any_value(n) + 1) / (any_value(total) + any_value(k)))
                      + sum(ln(CASE WHEN x > 0 THEN p ELSE 1 - p END)) AS ll
               FROM x JOIN s USING (j) JOIN c USING (y) WHERE NOT t GROUP BY 1, 2, 3),
        {VOTE_SQL.format(name='bernoulli')}""",
)
def nb_bernoulli(spark, sf):
    return _scores("bernoulli", models.bernoulli_bayes(), *vector_split(spark, sf))


@query("nb_multinomial")
def nb_multinomial(spark, sf):
    return _scores("multinomial", NaiveBayes(modelType="multinomial"), *quality_split(spark, sf))


@query("decision_tree")
def decision_tree(spark, sf):
    return _scores("tree", DecisionTreeClassifier(seed=1), *vector_split(spark, sf))


@query("random_forest")
def random_forest(spark, sf):
    return _scores("forest", RandomForestClassifier(numTrees=50, maxDepth=8, seed=1), *vector_split(spark, sf))


@query("bagged_trees")
def bagged_trees(spark, sf):
    return _scores("bagging", models.bagged_trees(10), *vector_split(spark, sf))


@query("adaboost")
def adaboost(spark, sf):
    train, test = vector_split(spark, sf, binary=True)
    with models.reused(train) as data:
        model = models.AdaBoost(rounds=8).fit(data)
    return models.classification_scores(model.transform(test), "label", "adaboost")


@query("linear_svm")
def linear_svm(spark, sf):
    rows = token_rows(spark, sf)
    rows = label_encode(rows.where(F.col("lang").isNotNull()), "lang", "code")
    rows = rows.withColumn("label", F.col("code").cast("double"))
    rows = splits.hash_split(rows, "doc_id", 80)
    weights = Pipeline(
        stages=[
            CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=2000, minDF=5),
            IDF(inputCol="counts", outputCol="features"),
        ]
    )
    train = rows.where("split = 'train'")
    fitted = models.fit(weights, train)
    train, test = (
        fitted.transform(part).select("label", "features") for part in (train, rows.where("split = 'test'"))
    )
    return _scores("svm", models.linear_svm(maxIter=10), train, test)


@query("mlp")
def mlp(spark, sf):
    net = MultilayerPerceptronClassifier(layers=[64, 32, 10], maxIter=60, seed=1, blockSize=128)
    return _scores("mlp", net, *vector_split(spark, sf))


def line_features(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_extendedprice")
    return models.assemble(li, ["l_quantity", "l_discount"])


@query(
    "linreg_coeffs",
    """WITH s AS (SELECT covar_pop(l_quantity, l_extendedprice) s1y, covar_pop(l_discount, l_extendedprice) s2y,
           var_pop(l_quantity) s11, var_pop(l_discount) s22, covar_pop(l_quantity, l_discount) s12,
           avg(l_quantity) m1, avg(l_discount) m2, avg(l_extendedprice) my FROM lineitem),
       b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
           (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM s)
       SELECT 'l_quantity' AS term, round(b1, 3) AS coefficient FROM b
       UNION ALL SELECT 'l_discount', round(b2, 3) FROM b
       UNION ALL SELECT '(intercept)', round(my - b1 * m1 - b2 * m2, 3) FROM b""",
)
def linreg_coeffs(spark, sf):
    rows = line_features(spark, sf)
    model = models.linear_regression("l_extendedprice").fit(rows)
    out = models.coefficient_table(model, ["l_quantity", "l_discount"], rows)
    return out.withColumn("coefficient", F.round("coefficient", 3))


@query(
    "linreg_single",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
              round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""",
)
def linreg_single(spark, sf):
    y, x = "l_extendedprice", "l_quantity"
    return table(spark, sf, "lineitem").agg(
        F.round(F.regr_slope(y, x), 4).alias("slope"),
        F.round(F.regr_intercept(y, x), 4).alias("intercept"),
        F.round(F.regr_r2(y, x), 6).alias("r2"),
    )


@query(
    "ridge",
    """WITH s AS (SELECT count(*) * covar_pop(l_quantity, l_extendedprice) sxy, count(*) * var_pop(l_quantity) sxx,
           avg(l_quantity) mx, avg(l_extendedprice) my FROM lineitem), b AS (SELECT *, sxy / (sxx + 1000) AS b FROM s)
       SELECT 'l_quantity' AS term, round(b, 3) AS coefficient FROM b
       UNION ALL SELECT '(intercept)', round(my - b * mx, 3) FROM b""",
)
def ridge(spark, sf):
    rows = models.assemble(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity"])
    model = models.ridge(rows, "l_extendedprice", 1000.0)
    out = models.coefficient_table(model, ["l_quantity"], rows)
    return out.withColumn("coefficient", F.round("coefficient", 3))


@query(
    "lasso",
    """WITH s AS (SELECT covar_pop(l_quantity, l_extendedprice) sxy, var_pop(l_quantity) sxx,
           avg(l_quantity) mx, avg(l_extendedprice) my FROM lineitem),
       b AS (SELECT *, sign(sxy) * greatest(abs(sxy) - 500, 0) / sxx AS b FROM s)
       SELECT 'l_quantity' AS term, round(b, 2) AS coefficient FROM b
       UNION ALL SELECT '(intercept)', round(my - b * mx, 2) FROM b""",
)
def lasso(spark, sf):
    rows = models.assemble(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity"])
    model = models.lasso(rows, "l_extendedprice", 500.0)
    out = models.coefficient_table(model, ["l_quantity"], rows)
    return out.withColumn("coefficient", F.round("coefficient", 2))


@query(
    "reg_metrics",
    """WITH p AS (SELECT l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem)
       SELECT round(avg((y - p) ** 2), 1) AS mse, round(sqrt(avg((y - p) ** 2)), 4) AS rmse,
              round(avg(abs(y - p)), 4) AS mae, round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS r2 FROM p""",
)
def reg_metrics(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 2000).alias("p"))
    out = metrics.regression_metrics(rows, "l_extendedprice", "p")
    return out.select(
        F.round("mse", 1).alias("mse"), F.round("rmse", 4).alias("rmse"),
        F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
    )


def rule_scores(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    p = F.col("n_chars") / (F.col("n_chars") + 600)
    scored = docs.join(table(spark, sf, "labels"), "doc_id").withColumn("p", p)
    return scored.withColumn("predicted", (F.col("p") >= 0.5).cast("int"))


RULE_SQL = """s AS (SELECT quality, n_chars / (n_chars + 600) AS p,
    CASE WHEN n_chars / (n_chars + 600) >= 0.5 THEN 1 ELSE 0 END AS predicted FROM documents JOIN labels USING (doc_id))"""


@query(
    "accuracy",
    f"WITH {RULE_SQL} SELECT round(avg(CASE WHEN quality = predicted THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy, count(*) AS n FROM s",
)
def accuracy(spark, sf):
    out = metrics.accuracy(rule_scores(spark, sf), "quality", "predicted")
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "confusion",
    f"""WITH {RULE_SQL} SELECT quality AS truth, predicted, count(*) AS n,
        round(count(*) / sum(count(*)) OVER (PARTITION BY quality), 6) AS share FROM s GROUP BY 1, 2""",
)
def confusion(spark, sf):
    out = metrics.confusion(rule_scores(spark, sf), "quality", "predicted")
    return out.withColumn("share", F.round("share", 6))


@query(
    "class_report",
    f"""WITH {RULE_SQL}, c AS (SELECT unnest([0, 1]) AS class),
        k AS (SELECT class, count(*) FILTER (quality = class AND predicted = class) AS hit,
              count(*) FILTER (quality = class) AS support, count(*) FILTER (predicted = class) AS named FROM c, s GROUP BY 1)
        SELECT class, round(coalesce(hit / nullif(named, 0), 0), 6) AS precision, round(hit / support, 6) AS recall,
               round(2 * hit / (named + support), 6) AS f1, support FROM k""",
)
def class_report(spark, sf):
    out = metrics.class_report(rule_scores(spark, sf), "quality", "predicted")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "logloss",
    f"WITH {RULE_SQL} SELECT round(-avg(ln(CASE WHEN quality = 1 THEN p ELSE 1 - p END)), 6) AS log_loss FROM s",
)
def logloss(spark, sf):
    out = metrics.log_loss(rule_scores(spark, sf), "quality", "p")
    return out.withColumn("log_loss", F.round("log_loss", 6))


@query(
    "auc_rank",
    f"""WITH {RULE_SQL}, g AS (SELECT p, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg FROM s GROUP BY p),
        c AS (SELECT *, sum(neg) OVER (ORDER BY p) - neg / 2 AS below FROM g)
        SELECT round(sum(pos * below) / (sum(pos) * sum(neg)), 6) AS auc FROM c""",
)
def auc_rank(spark, sf):
    return metrics.auc(rule_scores(spark, sf), "quality", "p").select(F.round("auc", 6).alias("auc"))


@query(
    "masked_accuracy",
    r"""WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS w FROM conversations)
        SELECT round(avg(CASE WHEN length(w) % 3 = strpos(w, 'e') % 3 THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy,
               count(*) AS n FROM t""",
)
def masked_accuracy(spark, sf):
    words = X.word_tokens(F.col("text"))
    truth = F.transform(words, lambda w: (F.length(w) % 3 + 1).cast("long"))
    guess = F.transform(words, lambda w: (F.instr(w, "e") % 3 + 1).cast("long"))
    texts = table(spark, sf, "conversations")
    # every row is padded, to the next multiple of 8: what is masked out does not grow with the longest row
    length = (F.size(words) + 8 - F.size(words) % 8).cast("int")
    padded = texts.select(A.pad_right(truth, length).alias("truth"), A.pad_right(guess, length).alias("guess"))
    out = metrics.masked_accuracy(padded, F.col("truth"), F.col("guess"))
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query("cluster_sizes", "SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def cluster_sizes(spark, sf):
    return metrics.cluster_sizes(table(spark, sf, "embeddings"), "label")


@query(
    "cluster_samples",
    "SELECT label, vec_id FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= 10",
)
def cluster_samples(spark, sf):
    return metrics.cluster_samples(table(spark, sf, "embeddings").select("label", "vec_id"), "label", ["vec_id"])


@query("tree_regress")
def tree_regress(spark, sf):
    rows = splits.hash_split(line_features(spark, sf), "l_orderkey", 80)
    trees = {
        "tree": DecisionTreeRegressor(labelCol="l_extendedprice", maxDepth=5, seed=1),
        "forest": RandomForestRegressor(labelCol="l_extendedprice", maxDepth=5, numTrees=20, seed=1),
        "linear": models.linear_regression("l_extendedprice"),
    }
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    return models.compare_regressors(trees, train, test, "l_extendedprice")


@query(
    "hashed_tf",
    r"""SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS DOUBLE) AS total_tf FROM documents
        WHERE len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) > 0""",
)
def hashed_tf(spark, sf):
    hashed = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=1 << 18).transform(token_rows(spark, sf))
    return models.nonzero_vectors(hashed, "tf").select("doc_id", _total("tf").alias("total_tf"))


@query(
    "count_vector_tfidf",
    r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 10)
        SELECT doc_id, round(sum(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1))), 6) AS weight
        FROM tf JOIN df USING (term) GROUP BY 1""",
)
def count_vector_tfidf(spark, sf):
    # long form: no vocabulary on the driver, hence no limit to it
    rows = token_rows(spark, sf)
    tf = textstats.term_frequencies(rows, "doc_id", F.col("tokens"))
    n = rows.agg(F.count(F.lit(1))).scalar()
    weights = textstats.tfidf_plain(tf, textstats.vocabulary(tf, min_df=10), n)
    return weights.groupBy("doc_id").agg(F.round(F.sum("weight"), 6).alias("weight"))


@query("kmeans_assign")
def kmeans_assign(spark, sf):
    rows = vectors(spark, sf)
    with models.reused(rows) as data:
        model = cluster.kmeans(data, 10)
    return model.transform(rows).select("vec_id", "cluster")


@query("elbow")
def elbow(spark, sf):
    return cluster.elbow(vectors(spark, sf), range(2, 17, 2))


@query("silhouette")
def silhouette(spark, sf):
    rows = vectors(spark, sf)
    with models.reused(rows) as data:
        value = cluster.silhouette(cluster.kmeans(data, 10).transform(data))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.lit(value).alias("silhouette"))


@query("bisecting_kmeans")
def bisecting_kmeans(spark, sf):
    rows = vectors(spark, sf)
    with models.reused(rows) as data:
        model = cluster.bisecting(data, 10)
    return metrics.cluster_sizes(model.transform(rows), "cluster")


@query("lda_topics")
def lda_topics(spark, sf):
    counter = CountVectorizer(inputCol="tokens", outputCol="features", vocabSize=1000, minDF=5)
    rows = token_rows(spark, sf)
    counts = models.fit(counter, rows).transform(rows).select("doc_id", "features")
    with models.reused(counts) as data:
        model = cluster.topics(data, 5, max_iter=10)
    return cluster.label_topics(model, counts).select("doc_id", "topic")


def word_vectors(spark, sf):
    # trains one copy per partition, each on its own share of the chunks of text
    return word2vec.fit(token_rows(spark, sf), "doc_id", "tokens", size=32, min_count=5, parts=FIT_PARTS, seed=1)


@query("word2vec_synonyms")
def word2vec_synonyms(spark, sf):
    found = stage(word2vec.vectors(word_vectors(spark, sf)))
    return word2vec.synonyms(found, found.agg(F.min("word")).first()[0], 10)


@query("word2vec_documents")
def word2vec_documents(spark, sf):
    # tokens are made once; vectors are kept until the clusters stand on disk
    means = word2vec.documents(word_vectors(spark, sf))
    vectors_ = means.select(F.col("key").alias("doc_id"), array_to_vector("vector").alias("features"))
    with models.reused(vectors_) as data:
        found = stage(cluster.kmeans(data, 8).transform(data).select("cluster"))
    return metrics.cluster_sizes(found, "cluster")


@query("lag_forecast")
def lag_forecast(spark, sf):
    """Next value of every user's series from its three values before, scaled per part."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    timeline = splits.ordered_split(events, ["user_id"], ["ts", "event_id"], 0.33)
    scaled = minmax_by_group(timeline, "value", ["split"], "scaled")
    lags = series.lookback_windows(scaled, ["user_id", "split"], ["position"], "scaled", 3)
    rows = stage(lags.withColumn("lags", array_to_vector("features")).drop("features"))
    train = rows.where("split = 'train'")
    regressors = {
        "linear": LinearRegression(featuresCol="lags", labelCol="target"),
        "gbt": GBTRegressor(featuresCol="lags", labelCol="target", maxIter=5, maxDepth=3, seed=1),
    }
    return models.compare_regressors(regressors, train, rows.where("split = 'test'"), "target")


def _det(a, b, c, d, e, f, g, h, i):
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


_ROWS = (("n1", "sx", "sz"), ("sx", "xx", "xz"), ("sz", "xz", "zz"))
_RIGHT = ("sy", "xy", "zy")
_CRAMER = [
    _det(*[_RIGHT[r] if c == k else _ROWS[r][c] for r in range(3) for c in range(3)]) + " / " + _det(*sum(_ROWS, ()))
    for k in range(3)
]


@query(
    "series_models",
    f"""WITH l AS (SELECT user_id, ts, event_id, value AS y, lag(value, 1) OVER s AS x, lag(value, 2) OVER s AS z FROM events
                  WINDOW s AS (PARTITION BY user_id ORDER BY ts, event_id)),
        m AS (SELECT user_id, count(*) AS n, count(*) + 1 AS n1, sum(x) AS sx, sum(z) AS sz, sum(y) AS sy, sum(x * x) + 1 AS xx,
                     sum(x * z) AS xz, sum(z * z) + 1 AS zz, sum(x * y) AS xy, sum(z * y) AS zy,
                     arg_max(y, (ts, event_id)) AS y1, arg_max(x, (ts, event_id)) AS y2
              FROM l WHERE z IS NOT NULL GROUP BY 1),
        b AS (SELECT user_id, n, y1, y2, {_CRAMER[0]} AS intercept, {_CRAMER[1]} AS b1, {_CRAMER[2]} AS b2 FROM m)
        SELECT user_id, n, round(intercept, 4) AS intercept, round(b1, 6) AS b1, round(b2, 6) AS b2,
               round(intercept + b1 * y1 + b2 * y2, 4) AS forecast FROM b""",
)
def series_models(spark, sf):
    """A model of its own for every user's series, and its next value."""
    found = series.series_models(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value", lags=2)
    places = {"intercept": 4, "b1": 6, "b2": 6, "forecast": 4}
    return found.withColumns({c: F.round(c, p) for c, p in places.items()})


@query("model_compare")
def model_compare(spark, sf):
    train, test = vector_split(spark, sf)
    candidates = {
        "logistic": LogisticRegression(maxIter=30),
        "gaussian": NaiveBayes(modelType="gaussian"),
        "tree": DecisionTreeClassifier(seed=1),
        "forest": RandomForestClassifier(numTrees=20, seed=1),
    }
    return models.compare_classifiers(candidates, train, test)


@query("feature_importance")
def feature_importance(spark, sf):
    train, _ = churn_split(spark, sf)
    model = models.fit(RandomForestClassifier(numTrees=20, seed=1), train)
    return models.importance_table(model, CHURN_COLUMNS, train)


@query("score_submission")
def score_submission(spark, sf):
    train, test = churn_split(spark, sf)
    model = models.fit(RandomForestClassifier(numTrees=20, seed=1), train)
    return models.submission(model, test.drop("label"), "c_custkey", "churned")
