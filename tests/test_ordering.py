"""Ranged positions and totals agree with plain windows, hot groups included."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plainloom import session
from plainloom.operators import ordering, profile, quantiles, series, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """10,000 rows; a third belongs to one key, some keys have one row, one key is null."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(0))
        .when(F.col("id") % 1000 == 1, F.lit(None))
        .otherwise((F.col("id") % 97 + 1).cast("int"))
    )
    value = (F.pmod(F.xxhash64("id"), F.lit(50))).cast("double")
    return spark.range(10_000).select("id", key.alias("k"), value.alias("v")).repartition(7, "id").cache()


@pytest.fixture(params=[1_000_000, 700, 7])
def pieces(request, monkeypatch):
    """One piece, some, and more than there are rows in a group."""
    monkeypatch.setattr(ordering, "PIECE_ROWS", request.param)


@pytest.mark.parametrize("by", [["k"], []])
def test_number_rows(skewed, by, pieces):
    got = ordering.number_rows(skewed, by, ["v", "id"], total="n")
    w = Window.partitionBy(*by).orderBy("v", "id")
    want = skewed.withColumn("position", F.row_number().over(w).cast("long")).withColumn(
        "n", F.count(F.lit(1)).over(Window.partitionBy(*by))
    )
    assert got.select("id", "k", "v", "position", "n").exceptAll(want.select("id", "k", "v", "position", "n")).count() == 0
    assert got.count() == 10_000


def test_number_rows_descending(skewed, pieces):
    got = ordering.number_rows(skewed, ["k"], [-F.col("v"), "id"])
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), "id")
    want = skewed.withColumn("position", F.row_number().over(w).cast("long"))
    assert got.select("id", "position").exceptAll(want.select("id", "position")).count() == 0


def test_pieces_are_even_ranges_and_rows_are_not_staged(skewed, monkeypatch):
    placed, wanted = ordering.with_pieces(skewed, [], ["v", "id"], "piece", 500)
    sizes = placed.groupBy("piece").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    sizes = sizes.orderBy("piece").collect()
    assert wanted == 20 and len(sizes) >= 15 and max(r["n"] for r in sizes) < 1_500
    assert all(a["hi"] <= b["lo"] for a, b in zip(sizes, sizes[1:]))
    staged = []
    monkeypatch.setattr(ordering, "PIECE_ROWS", 500)
    monkeypatch.setattr(ordering, "stage", lambda df: staged.append(df.count()) or session.stage(df))
    out = ordering.number_rows(skewed, [], ["v", "id"])
    assert max(staged) <= 25 and out.count() == 10_000
    plan = out._jdf.queryExecution().toString()
    assert all("_piece" in line for line in plan.splitlines() if "row_number" in line and "windowspec" in line)


def test_running_total(skewed, pieces):
    counts = skewed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = ordering.running_total(counts, ["k"], ["v"], "n")
    w = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    want = counts.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy("k")))
    cols = ["k", "v", "n", "upto", "total"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_positional_slice_and_tail(spark, pieces):
    df = spark.range(100)
    assert sorted(r[0] for r in ordering.positional_slice(df, ["id"], 10, 13).collect()) == [10, 11, 12]
    assert sorted(r[0] for r in ordering.positional_slice(df, ["id"], 97).collect()) == [97, 98, 99]
    assert sorted(r[0] for r in ordering.tail(df, ["id"], 2).collect()) == [98, 99]


def test_shuffle_rows_is_repeatable(spark):
    a = [r[0] for r in ordering.shuffle_rows(spark.range(50), "id").collect()]
    b = [r[0] for r in ordering.shuffle_rows(spark.range(50).repartition(5), "id").collect()]
    assert a == b and sorted(a) == list(range(50)) and a != list(range(50))


@pytest.mark.parametrize("leaf, bins", [(4_096, 4_096), (50, 16), (2, 3)])
def test_quantiles_of_groups(skewed, monkeypatch, leaf, bins):
    import numpy as np

    monkeypatch.setattr(quantiles, "LEAF", leaf)
    monkeypatch.setattr(quantiles, "BINS", bins)

    probs = [0.0, 0.1, 0.5, 0.97, 1.0]
    rows = skewed.where("k is not null")
    got = {(r["k"], r["column"]): r["q"] for r in quantiles.quantiles(rows, ["v", "id"], probs, ["k"]).collect()}
    frame = rows.toPandas()
    want = {(k, c): list(np.quantile(g[c], probs)) for k, g in frame.groupby("k") for c in ("v", "id")}
    assert got.keys() == want.keys()
    for key in got:
        assert got[key] == pytest.approx(want[key])


def test_quantiles_of_whole_table_and_approximate(skewed):
    import numpy as np

    v = [r[0] for r in skewed.select("id").collect()]
    (row,) = quantiles.quantiles(skewed, ["id"], [0.33, 0.8]).collect()
    assert row["q"] == pytest.approx(list(np.quantile(v, [0.33, 0.8])))
    (row,) = quantiles.quantiles(skewed, ["id"], [0.5], approximate=True).collect()
    assert abs(row["q"][0] - 5000) <= 2


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("a", None)], "g string, v string")
    assert {r["g"]: r["mode"] for r in quantiles.modes(df, "v", ["g"]).collect()} == {"a": "x"}


def test_lookback_beyond_the_piece_gives_the_same_rows(spark):
    df = spark.range(30).select(F.lit("a").alias("k"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    few = series.lookback_windows(df, ["k"], ["t"], "v", 12, piece_rows=10)
    many = series.lookback_windows(df, ["k"], ["t"], "v", 12, piece_rows=100)
    assert few.count() == many.count() == 18
    assert few.select("t", "features").exceptAll(many.select("t", "features")).count() == 0


@pytest.mark.parametrize("piece_rows", [50, 2])
@pytest.mark.parametrize("by", [["k"], []])
def test_lookback_windows_carry_edges(skewed, by, piece_rows):
    present = skewed.where("k is not null")
    got = series.lookback_windows(present, by, ["v", "id"], "v", 3, piece_rows=piece_rows)
    w = Window.partitionBy(*by).orderBy("v", "id").rowsBetween(-3, -1)
    want = present.withColumn("features", F.collect_list("v").over(w)).where(F.size("features") == 3)
    assert got.select("id", "features").exceptAll(want.select("id", "features")).count() == 0
    assert got.count() == want.count()


def test_lookback_needs_full_history(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 5.0)], "k string, t int, v double")
    out = series.lookback_windows(df, ["k"], ["t"], "v", 1).collect()
    assert [(r["k"], r["features"], r["target"]) for r in out] == [("a", [1.0], 2.0)]


def test_splits_cover_and_are_disjoint(skewed):
    split = splits.hash_split(skewed, "id", 80)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(counts.values()) == 10_000 and 0.75 < counts["train"] / 10_000 < 0.85
    strata = splits.stratified_split(skewed.where("k is not null"), "k", "id", 0.7)
    for r in strata.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "train").alias("t")).collect():
        assert r["t"] == int(r["n"] * 0.7 + 1e-9)


def test_ordered_split_rounds_half_even(spark):
    df = spark.range(5)  # 5 * 0.5 = 2.5 -> 2
    out = splits.ordered_split(df, [], ["id"], 0.5)
    assert sorted(r["id"] for r in out.where("split = 'train'").collect()) == [0, 1]


def test_box_stats_by_hand(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [1, 2, 3, 4, 100]], "g string, x double")
    (r,) = profile.box_stats(df, "x", ["g"]).collect()
    assert (r["q25"], r["median"], r["q75"]) == (2.0, 3.0, 4.0)
    assert (r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (1.0, 4.0, 1)


def test_quantiles_of_odd_values(spark, monkeypatch):
    inf, nan = float("inf"), float("nan")
    values = [inf, -inf, nan, None, 5e-324, 0.0, -0.0, 1e308, -1e308, 7.0, 7.0, 7.0, 1e-9, 2.0, -3.5]
    df = spark.createDataFrame([(1, v, None) for v in values] + [(2, None, None)], "g int, v double, w double")
    known = sorted(v for v in values if v is not None and v == v)
    probs = [0.0, 1 / 6, 0.5, 5 / 6, 1.0]
    for leaf in (100, 1):
        monkeypatch.setattr(quantiles, "LEAF", leaf)
        (row,) = quantiles.quantiles(df, ["v", "w"], probs, ["g"]).collect()
        assert (row["g"], row["column"]) == (1, "v") and row["q"] == [known[round(p * 12)] for p in probs]
    assert quantiles.quantiles(df.where("false"), ["v"], [0.5]).collect() == []


def test_box_stats_leave_nan_out(spark):
    df = spark.createDataFrame([("a", x) for x in [1.0, 2.0, 3.0, float("nan"), None]], "g string, x double")
    (r,) = profile.box_stats(df, "x", ["g"]).collect()
    assert (r["median"], r["n_outliers"]) == (2.0, 0)


def test_quantile_groups_may_have_any_name(spark):
    df = spark.createDataFrame([(i % 3, float(i), float(-i)) for i in range(90)], "size int, x double, n double")
    got = {(r["size"], r["column"]): r["q"][0] for r in quantiles.quantiles(df, ["x", "n"], [0.5], ["size"]).collect()}
    assert got[1, "x"] == 44.5 and got[1, "n"] == -got[1, "x"] and len(got) == 6
