"""Readers and writers on temporary files, and the streaming form of the signal features."""

import json

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainloom.operators import models, signal
from plainloom.sources import readers, writers
from plainloom.streaming import signal_stream

TRIPS = "day string, hour int, origin string, destination string, trips int"


def test_csv_round_trip_and_partition_pruning(spark, small, tmp_path):
    nation = small("nation")
    writers.write_csv(nation, str(tmp_path / "n"))
    back = readers.read_csv(spark, str(tmp_path / "n"), nation.schema)
    assert back.exceptAll(nation).count() == 0 and back.count() == 25
    writers.write_csv(nation, str(tmp_path / "p"), partition_by=["n_regionkey"])
    pruned = spark.read.option("header", True).csv(str(tmp_path / "p")).where("n_regionkey = 1")
    assert pruned.count() == 5 and len(pruned.inputFiles()) >= 1


def test_yearly_files_as_one_table(spark, tmp_path):
    for year in (2011, 2012):
        (tmp_path / f"trips-{year}.csv").write_text(
            f"Date,Hour,Origin,Destination,Trips\n{year}-01-01,5,A,B,3\n{year}-01-02,23,B,A,4\n"
        )
    glob = readers.read_csv(spark, str(tmp_path / "trips-*.csv"), TRIPS)
    listed = readers.read_csv(spark, [str(tmp_path / f"trips-{y}.csv") for y in (2011, 2012)], TRIPS)
    assert glob.agg(F.sum("trips")).first()[0] == 14 and listed.exceptAll(glob).count() == 0


def test_declared_encoding(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes("name\ncafé\n".encode("iso-8859-1"))
    assert readers.read_csv(spark, str(tmp_path / "e.csv"), "name string", encoding="ISO-8859-1").first()[0] == "café"


def test_malformed_lines_are_skipped_and_counted(spark, tmp_path):
    (tmp_path / "p.csv").write_text("password,strength\nabc,1\ndef,2,9,9\nghi,0\nxyz,bad\n")
    schema = T.StructType([T.StructField("password", T.StringType()), T.StructField("strength", T.IntegerType())])
    good, bad = readers.read_csv_with_rejects(spark, str(tmp_path / "p.csv"), schema)
    assert sorted(r["password"] for r in good.collect()) == ["abc", "ghi"]
    assert sorted(r[0] for r in bad.collect()) == ["def,2,9,9", "xyz,bad"]
    assert bad.count() == 2 and good.select("password").count() == 2
    dropped = readers.read_csv(spark, str(tmp_path / "p.csv"), schema, drop_malformed=True)
    assert sorted(r["password"] for r in dropped.collect()) == ["abc", "ghi"] and dropped.count() == 2


def _snapshots(folder, days=3):
    for d in range(1, days + 1):
        lines = [f"{d * 0.1 + i * 0.01:.3f}\t{-i * 0.02:.3f}" for i in range(20)]
        (folder / f"2004.02.{d:02d}.10.32.39").write_text("\n".join(lines) + "\n")


def test_snapshot_directory_is_one_scan(spark, tmp_path):
    _snapshots(tmp_path)
    rows = readers.read_snapshots(spark, str(tmp_path), ["b1", "b2"])
    assert rows.count() == 60
    features = signal.time_features(rows, ["file_ts"], ["b1", "b2"]).orderBy("file_ts").collect()
    assert [str(r["file_ts"]) for r in features] == [f"2004-02-0{d} 10:32:39" for d in (1, 2, 3)]
    first = features[0]
    assert first["b1_max"] == pytest.approx(0.29) and first["b2_p2p"] == pytest.approx(0.38)


def test_streamed_features_equal_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _snapshots(tmp_path / "in")
    stream = signal_stream.snapshot_stream(spark, str(tmp_path / "in"), ["b1", "b2"], files_per_batch=1)
    windows = signal_stream.windowed_features(stream, "file_ts", ["b1", "b2"], "1 day", "1 hour")
    signal_stream.write_features(windows, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    batch = readers.read_snapshots(spark, str(tmp_path / "in"), ["b1", "b2"])
    want = signal.time_features(batch, ["file_ts"], ["b1", "b2"]).orderBy("file_ts").collect()
    # the last day stays open until a later file moves the watermark on
    assert len(got) >= 2
    for g, w in zip(got, want):
        for name in ("b1_mean", "b1_std", "b1_skew", "b2_kurtosis", "b2_rms", "b2_p2p"):
            assert g[name] == pytest.approx(w[name])


def test_lines_and_nested_json(spark, tmp_path):
    (tmp_path / "t.txt").write_text("one two\nthree\n")
    assert sorted(r[0] for r in readers.read_lines(spark, str(tmp_path / "t.txt")).collect()) == ["one two", "three"]
    doc = {"intents": [
        {"tag": "hi", "patterns": ["hello", "hey"], "responses": ["yo"], "context_set": ""},
        {"tag": "bye", "patterns": ["later"], "responses": ["so long", "bye"]},
    ]}
    (tmp_path / "i.json").write_text(json.dumps(doc, indent=1))
    intents = readers.read_intents(spark, str(tmp_path / "i.json"))
    pairs = intents.select("tag", F.explode("patterns").alias("p"))
    assert sorted(map(tuple, pairs.collect())) == [("bye", "later"), ("hi", "hello"), ("hi", "hey")]
    assert intents.where("context_set is null").count() == 1


def test_image_catalogue_labels_by_folder(spark, tmp_path):
    for folder, n in (("glass", 2), ("paper", 3)):
        (tmp_path / folder).mkdir()
        for i in range(n):
            (tmp_path / folder / f"{i}.jpg").write_bytes(b"x" * (i + 1))
    images = readers.read_images(spark, str(tmp_path), {"glass": "Glass"})
    assert {r["label"]: r["count"] for r in images.groupBy("label").count().collect()} == {"Glass": 2, "paper": 3}
    assert images.where("file_name = '2.jpg'").first()["bytes"] == 3
    assert "content" not in images._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_index_column(spark):
    df = spark.createDataFrame([(0, 1.5)], ["_c0", "x"])
    assert readers.drop_index_column(df).columns == ["x"]
    assert readers.rename_index_column(df, "time").columns == ["time", "x"]


def test_model_save_and_load(spark, tmp_path):
    df = models.assemble(spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (5.0, 1.0), (6.0, 1.0)], "x double, label double"), ["x"])
    model = models.fit(LogisticRegression(maxIter=20), df)
    writers.save_model(model, str(tmp_path / "m"))
    loaded = writers.load_model(str(tmp_path / "m"))
    a, b = ([r[0] for r in m.transform(df).select("prediction").collect()] for m in (model, loaded))
    assert a == b == [0.0, 0.0, 1.0, 1.0]


def test_promoted_headers_in_any_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,rate\n1,"x, y",0.5\n2,,bad\n')
    (tmp_path / "b.csv").write_text("rate,id,more\n1.5,3,z\nrate,id,more\n")
    (tmp_path / "c.csv").write_text("id,name,rate\n")
    rows = readers.read_promoted(spark, str(tmp_path), "id int, name string, rate double").collect()
    key = lambda r: (r[0] is None, r[0])
    assert sorted(map(tuple, rows), key=key) == [(1, "x, y", 0.5), (2, None, None), (3, None, 1.5), (None, None, None)]


def test_nan_is_read_as_null(spark, tmp_path):
    (tmp_path / "n.csv").write_text("a,b\n1.5,NaN\nNaN,2\n")
    rows = readers.read_csv(spark, str(tmp_path / "n.csv"), "a double, b float").collect()
    assert sorted(map(tuple, rows), key=repr) == [(1.5, None), (None, 2.0)]
