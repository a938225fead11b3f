"""Relational, cleaning, fill and text edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plainloom.functions import arrays as A
from plainloom.functions import columns as C
from plainloom.functions import dates as D
from plainloom.functions import text as X
from plainloom.operators import aggregate, features, fill, profile, relational, signal, textstats


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column).first()[0]


def test_keep_first_with_hot_key(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.lit("x").alias("v")
    )
    for digest in (False, True):
        out = relational.keep_first(df.orderBy(F.rand(1)), ["k"], ["id"], digest_keys=digest)
        assert out.columns == df.columns and out.count() == 2001
        assert out.where("k = 'hot'").first()["id"] == 0


def test_keep_first_treats_null_and_empty_apart(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, None)], "id int, k string")
    for digest in (False, True):
        assert sorted(r["id"] for r in relational.keep_first(df, ["k"], ["id"], digest).collect()) == [1, 2]


def test_duplicates_and_repeated_names(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    assert tuple(relational.duplicate_count(df).first()) == (3, 2, 1)
    twice = df.select("a", F.lit(5).alias("b"), F.lit(9).alias("a"))
    assert relational.drop_repeated_names(twice).columns == ["b", "a"]
    assert relational.drop_repeated_names(twice).first()["a"] == 9


def test_group_sum_drops_null_keys_and_zeroes_empty_sums(spark):
    df = spark.createDataFrame([("a", None), (None, 1.0), ("b", 2.0)], "k string, v double")
    assert {r["k"]: r["s"] for r in aggregate.group_sum(df, ["k"], "v", "s").collect()} == {"a": 0.0, "b": 2.0}


def test_top_k_and_others_loses_nothing(spark):
    df = spark.createDataFrame([(c,) for c in "aaaabbbccdef"], "c string")
    out = {r["c"]: r["n"] for r in aggregate.top_k_and_others(df, "c", 2).collect()}
    assert out == {"a": 4, "b": 3, "Others": 5}


def test_elapsed_days_are_24_hour_units(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 3, 0, 30), dt.datetime(2024, 1, 1, 23, 30)), (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(D.elapsed_days(F.col("a"), F.col("b"))).collect()] == [1, 1]


@pytest.mark.parametrize(
    "text,number,commas,digits",
    [("1,234", None, 1234, "1"), ("nan", None, 0, None), ("abc", None, 0, None), ("", None, 0, None),
     ("10+ years", None, 0, "10"), ("$584.03", None, 0, "584"), ("12", 12.0, 12, "12"), (None, None, 0, None)],
)
def test_dirty_numbers(spark, text, number, commas, digits):
    assert one(spark, C.coerce_number(F.col("c")), text) == number
    assert one(spark, C.comma_number(F.col("c")), text) == commas
    assert one(spark, C.first_group(F.col("c"), r"(\d+)"), text) == digits


def test_rounding_and_recode(spark):
    assert [one(spark, C.half_even(F.col("c")), v, "double") for v in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]
    assert one(spark, C.recode(F.col("c"), {"Ms": "Miss"}), "Mr") == "Mr"
    assert one(spark, C.recode(F.col("c"), {"Ms": "Miss"}, keep_unmapped=False), "Mr") is None
    assert one(spark, C.nan_to_null(F.col("c")), float("nan"), "double") is None


def test_group_fills(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, None), (None, 7.0)], "g string, x double"
    )
    for stat, value in (("median", 2.0), ("mean", 2.0), ("mode", 1.0)):
        out = sorted(map(tuple, fill.fill_group(df, "x", ["g"], stat).collect()), key=repr)
        assert out == sorted([("a", 1.0), ("a", 3.0), ("a", value), ("b", None), (None, None), (None, 7.0)], key=repr)
    chained = fill.fill_chain(df, "x", ["g"], "mean", 0.0)
    assert chained.where("x is null").count() == 0


def test_null_profile_and_roles(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "n int, s string")
    out = {r["column"]: (r["n_null"], r["ratio"]) for r in profile.null_profile(df).collect()}
    assert out == {"n": (0, 0.0), "s": (1, 0.5), "(all)": (1, 0.25)}
    assert {r["column"]: r["role"] for r in profile.column_roles(df).collect()} == {"n": "ordinal", "s": "categorical"}


def test_histogram_covers_all_rows_and_constant_column(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("x"), F.lit(4.0).alias("c"))
    assert profile.histogram(df, "x", 10).agg(F.sum("n"), F.max("bin")).first() == (101, 9)
    assert [(r["bin"], r["n"]) for r in profile.histogram(df, "c", 10).collect()] == [(0, 101)]


def test_unicode_text(spark):
    assert one(spark, X.clean_review(F.col("c")), "Über_größe 42!\r\nna") == "über_größe na"
    assert one(spark, X.clean_post(F.col("c")), "See [ref] https://a.b/c <b>Bold</b>, w0rd ok!") == "see   bold  ok"
    assert one(spark, X.clean_social(F.col("c")), "Hi @you #tag x#y http://t.co b good") == "hi y good"
    assert one(spark, X.clean_comma_parts(F.col("c")), "Walt Disney (US), Pixar 3!") == "waltdisney pixar"
    assert one(spark, X.clean_headline(F.col("c")), "  A  b2b, c  ") == "a bb c"


def test_ngrams_short_inputs(spark):
    assert one(spark, X.char_ngrams(F.col("c"), 3), "abcd") == ["abc", "bcd", "cd", "d"]
    assert one(spark, X.char_ngrams(F.col("c"), 3), "") == []
    for tokens, want in ((["a", "b", "c"], ["a", "b", "c", "a b", "b c"]), (["a"], ["a"]), ([], [])):
        assert one(spark, X.word_ngrams(F.col("c"), 1, 2), tokens, "array<string>") == want


def test_arrays(spark):
    def arr(column, value):
        return one(spark, column, value, "array<bigint>")

    assert arr(A.growing_prefixes(F.col("c")), [1, 2, 3]) == [[1, 2], [1, 2, 3]]
    assert arr(A.growing_prefixes(F.col("c")), [1]) is None and arr(A.growing_prefixes(F.col("c")), []) is None
    assert arr(A.pad_left(F.col("c"), 3), [1]) == [0, 0, 1] and arr(A.pad_left(F.col("c"), 2), [1, 2, 3]) == [2, 3]
    assert arr(A.pad_right(F.col("c"), 3), [1]) == [1, 0, 0] and arr(A.pad_right(F.col("c"), 2), [1, 2, 3]) == [1, 2]
    assert arr(A.split_target(F.col("c"))[0], [1, 2, 3]) == [1, 2] and arr(A.split_target(F.col("c"))[1], [1, 2, 3]) == 3
    assert arr(A.any_nonzero(F.col("c")), [0, 0]) is False


def test_literal_lists(spark):
    column = A.literal_list_field(F.col("c"))
    assert one(spark, column, "[{'id': 1, 'name': \"O'Brien\"}, {'id': None, 'name': 'B'}]") == "O'Brien, B"
    assert one(spark, column, "[]") == ""


def test_encode_keeps_rows_without_tokens(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "zz"]), (2, [])], "k int, t array<string>")
    index = spark.createDataFrame([("a", 1), ("b", 2)], "term string, token_id bigint")
    assert {r["k"]: r["ids"] for r in textstats.encode_tokens(df, ["k"], F.col("t"), index).collect()} == {1: [1, 2, 1], 2: []}


def test_continue_text_with_longer_prefix(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["x", "b", "c", "e"],)], "t array<string>")
    table = textstats.next_word_table(df, F.col("t"), order=2)
    seeds = spark.createDataFrame([("a b",), ("q",)], "s string")
    assert sorted(r[0] for r in textstats.continue_text(seeds, "s", table, 2, order=2).collect()) == ["a b c d", "q"]


def test_sentiment_of_empty_text(spark):
    df = spark.createDataFrame([(1, ["good", "bad", "x", "good"]), (2, [])], "k int, t array<string>")
    lexicon = relational.literal_table(spark, ["term", "score"], [("good", 1.0), ("bad", -1.0)])
    out = {r["k"]: tuple(r)[1:] for r in textstats.lexicon_sentiment(df, ["k"], F.col("t"), lexicon).collect()}
    assert out == {1: (0.5, 0.25, 0.25), 2: (None, None, None)}


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    assert [tuple(r) for r in features.standard_scale(df, ["a", "c"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    fitted = features.minmax_fit(df, ["a", "c"])
    scaled = features.minmax_scale(df, ["a", "c"], fitted)
    assert [tuple(r) for r in scaled.collect()] == [(0.0, 0.0), (1.0, 0.0)]
    assert [tuple(r) for r in features.minmax_inverse(scaled, ["a", "c"], fitted).collect()] == [(1.0, 5.0), (3.0, 5.0)]


def test_encoders(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    assert features.dummies(df, ["c"]).columns == ["c_b"]
    assert [r[0] for r in features.dummies(df, ["c"]).collect()] == [1, 0, 0]
    assert {r["c"]: r["code"] for r in features.label_encode(df, "c", "code").collect()} == {"b": 1, "a": 0, None: None}


@pytest.mark.parametrize("n", [3, 1500])
def test_dummy_positions_for_few_and_many_categories(spark, n):
    df = spark.range(n).select("id", F.format_string("c%05d", "id").alias("c"), F.when(F.col("id") > 0, "x").alias("d"))
    rows = {r["id"]: r for r in features.dummy_positions(df, ["c", "d"], drop_first=False).collect()}
    assert len(rows) == n and {r["width"] for r in rows.values()} == {n + 1}
    assert all(r["positions"] == ([i, n] if i else [0]) for i, r in rows.items())
    dropped = {r["id"]: r["positions"] for r in features.dummy_positions(df, ["c", "d"]).collect()}
    assert dropped[0] == [] and dropped[2] == [1]
    assert len(features.dummies(df.limit(2), ["c"], drop_first=False).columns) == 4


def test_signal_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0), ("b", 2.0), ("b", 2.0)], "g string, x double")
    out = {r["g"]: r for r in signal.time_features(df, ["g"], ["x"]).collect()}
    assert out["a"]["x_std"] is None and out["a"]["x_skew"] is None and out["a"]["x_entropy"] == 0.0
    assert out["b"]["x_skew"] == 0.0 and out["b"]["x_kurtosis"] == 0.0 and out["b"]["x_p2p"] == 4.0


def test_nan_is_filled(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", None)], "g string, x double")
    assert sorted(r["x"] for r in fill.fill_statistic(df, "x", "mean").collect()) == [1.0, 2.0, 2.0, 3.0]
    got = fill.fill_chain(df, "x", ["g"], "median", 0.0).collect()
    assert sorted((r["g"], r["x"]) for r in got) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 0.0)]


def test_prefix_rows(spark):
    df = spark.createDataFrame([(1, [5, 6, 7]), (2, [1]), (3, [])], "k int, v array<int>")
    assert sorted((r["k"], r["p"]) for r in A.prefix_rows(df, ["k"], "v").collect()) == [(1, [5, 6]), (1, [5, 6, 7])]
