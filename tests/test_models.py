"""Closed forms, brute force and sanity of fitted models."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from plainloom.operators import cluster, metrics, models, neighbours, recommend, textstats
from plainloom.plans import modelling


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = 3 + x @ np.array([2.0, -1.0]) + rng.normal(size=200) * 0.1
    rows = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)]
    return models.assemble(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"]).cache(), x, y


def test_ridge_equals_normal_equations(line):
    df, x, y = line
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(2), xc.T @ yc)
    assert models.ridge(df, "y", 5.0).coefficients.toArray() == pytest.approx(want, abs=1e-6)


def test_lasso_zeroes_a_weak_feature(line):
    df, x, y = line
    model = models.lasso(df, "y", 1.5)
    assert model.coefficients[1] == pytest.approx(0.0, abs=1e-6) and 0 < model.coefficients[0] < 2


def test_classifier_metrics_agree_with_spark(spark):
    rows = [(float(t), float(p), s) for t, p, s in [(0, 0, 0.1), (0, 1, 0.6), (1, 1, 0.6), (1, 1, 0.9), (1, 0, 0.2), (2, 2, 0.5)]]
    df = spark.createDataFrame(rows, "label double, prediction double, s double")
    report = {r["class"]: r for r in metrics.class_report(df, "label", "prediction").collect()}
    for c in (0.0, 1.0, 2.0):
        for name, key in (("precisionByLabel", "precision"), ("recallByLabel", "recall"), ("fMeasureByLabel", "f1")):
            ev = MulticlassClassificationEvaluator(metricName=name, metricLabel=c)
            assert report[c][key] == pytest.approx(ev.evaluate(df))
    binary = df.where("label < 2")
    want = BinaryClassificationEvaluator(rawPredictionCol="s").evaluate(binary)
    assert metrics.auc(binary, "label", "s").first()[0] == pytest.approx(want)


def test_log_loss_is_clipped(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.5)], "y int, p double")
    assert metrics.log_loss(df, "y", "p").first()[0] == pytest.approx((-np.log(1e-15) - np.log(0.5)) / 2)


def test_adaboost_beats_one_stump(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, size=(400, 2))
    rows = [(float(a), float(b), float(a + b > 0)) for a, b in x]
    df = models.assemble(spark.createDataFrame(rows, "a double, b double, label double"), ["a", "b"]).cache()
    score = lambda rounds: metrics.accuracy(
        models.AdaBoost(rounds=rounds, stage_every=3).fit(df).transform(df), "label", "prediction"
    ).first()["accuracy"]
    assert score(8) > score(1) + 0.05


@pytest.mark.parametrize("sizes", [{}, {"n_centres": 3, "block_rows": 20, "chunk_rows": 7}])
def test_nearest_neighbours_against_brute_force(spark, sizes):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(300, 4))
    points[:100] = points[0]  # a third of the training rows are copies of one row
    queries = rng.normal(size=(40, 4))
    queries[0] = points[0]
    make = lambda m, start: spark.createDataFrame(
        [(start + i, [float(v) for v in row], i % 3) for i, row in enumerate(m)], "id bigint, v array<double>, label int"
    )
    train, test = make(points, 0), make(queries, 1000)
    got = neighbours.nearest_neighbours(test, train, "id", "v", 5, **sizes).collect()
    assert len(got) == 200
    found = {}
    for r in got:
        found.setdefault(r["query"] - 1000, []).append((r["distance"], r["neighbour"]))
    for i, q in enumerate(queries):
        d = np.zeros(len(points))
        for k in range(4):
            d += (q[k] - points[:, k]) ** 2
        want = sorted((v, j) for j, v in enumerate(np.sqrt(d)))[:5]
        assert [j for _, j in sorted(found[i])] == [j for _, j in want]
    votes = neighbours.knn_vote(test, train, "id", "v", "label", 5, **sizes)
    assert votes.count() == 40


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id bigint, v array<double>")
    assert neighbours.nearest_neighbours(df, df, "id", "v", 5).count() == 4


def test_tfidf_forms(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["c"])], "id int, t array<string>")
    tf = textstats.term_frequencies(docs, "id", F.col("t"))
    n = docs.agg(F.count(F.lit(1))).scalar()
    plain = {(r["id"], r["term"]): r["weight"] for r in textstats.tfidf_plain(tf, textstats.document_frequencies(tf), n).collect()}
    cv = CountVectorizer(inputCol="t", outputCol="c").fit(docs)
    idf = IDF(inputCol="c", outputCol="w").fit(cv.transform(docs))
    for r in idf.transform(cv.transform(docs)).collect():
        for i, term in enumerate(cv.vocabulary):
            assert plain.get((r["id"], term), 0.0) == pytest.approx(r["w"][i])
    smooth = textstats.tfidf_smooth(tf, textstats.document_frequencies(tf), n, "id")
    norms = smooth.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(r["n"] == pytest.approx(1.0) for r in norms)


def test_term_table_shuffles_once(spark, small):
    docs = small("documents")
    tf = textstats.term_frequencies(docs, "doc_id", F.split("text", " "))
    out = textstats.tfidf_plain(tf, textstats.document_frequencies(tf), docs.agg(F.count(F.lit(1))).scalar())
    assert out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_recommender_options(spark):
    items = spark.createDataFrame(
        [(1, "space ship laser", 0.1), (2, "space ship crew", 0.2), (3, "love story", 0.9)], "id int, bag string, score double"
    )
    tokens = F.split("bag", " ")
    out = recommend.content_recommend(items, "id", tokens, "score", 1, top_n=3, min_df=1).collect()
    assert [r["id"] for r in out] == [1, 2, 3] and out[0]["similarity"] == pytest.approx(1.0)
    other = recommend.content_recommend(items, "id", tokens, "score", 1, top_n=3, min_df=1, include_self=False)
    assert [r["id"] for r in other.collect()] == [2, 3]


def test_clusters(spark):
    rng = np.random.default_rng(4)
    rows = [([float(v) for v in rng.normal(c * 10, 0.5, size=2)], c) for c in range(3) for _ in range(40)]
    df = spark.createDataFrame(rows, "v array<double>, c int").select("c", array_to_vector("v").alias("features")).cache()
    assigned = cluster.kmeans(df, 3).transform(df)
    assert assigned.select("c", "cluster").distinct().count() == 3
    assert cluster.silhouette(assigned) > 0.9
    curve = [(r["k"], r["sse"]) for r in cluster.elbow(df, [2, 3, 4, 5, 6]).collect()]
    assert cluster.knee(curve) == 3
    assert metrics.cluster_samples(assigned.withColumn("i", F.monotonically_increasing_id()), "cluster", ["i"], 5).count() == 15


def test_boosted_trees_for_three_classes(spark):
    df = models.assemble(spark.range(90).select((F.col("id") / 1.0).alias("x"), F.floor(F.col("id") / 30).cast("double").alias("label")), ["x"])
    fitted = models.fit(models.boosted_trees(3, maxIter=3, maxDepth=2, seed=1), df)
    assert metrics.accuracy(fitted.transform(df), "label", "prediction").first()["accuracy"] > 0.9


def test_comparison_beats_majority(spark):
    from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression

    df = models.assemble(spark.range(200).select((F.col("id") / 10.0).alias("x"), (F.col("id") > 120).cast("double").alias("label")), ["x"])
    out = models.compare_classifiers({"logistic": LogisticRegression(), "tree": DecisionTreeClassifier()}, df, df).collect()
    assert {r["model"] for r in out} == {"logistic", "tree"} and all(r["accuracy"] > r["majority"] for r in out)


def test_word2vec_documents_tokenises_each_row_once(spark, tmp_path, monkeypatch):
    words = [f"w{i}" for i in range(30)]
    rows = [(i, "en", " ".join(words[(i * j) % 30] for j in range(1, 20))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    seen = spark.sparkContext.accumulator(0)
    token_rows = modelling.token_rows

    @F.udf("array<string>")
    def counted(tokens):
        seen.add(1)
        return tokens

    monkeypatch.setattr(modelling, "token_rows", lambda s, sf: token_rows(s, sf).withColumn("tokens", counted("tokens")))
    out = modelling.word2vec_documents(spark, str(tmp_path)).collect()
    assert sum(r["n"] for r in out) == len(rows) and len({r["cluster"] for r in out}) == len(out)
    assert seen.value == len(rows)
