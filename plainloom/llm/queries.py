"""The registered queries of the operators, with production parameters, and their SQL twins."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from plainloom.llm import (
    bpe,
    digest_index,
    forest,
    lexical,
    licenses,
    mixing,
    quality,
    repeats,
    rules,
    runs,
    secrets,
    simhash,
    sql,
    toxicity,
)
from plainloom.session import scratch, ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op5_mixing", sql.MIXING)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.plan_mix(table(spark, sf_dir, "documents"))
    taken = mixing.F.col("copies") * mixing.F.col("size")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


@query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenise(table(spark, sf_dir, "documents"), VOCABULARY)


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.rate(docs, quality.fit(docs, quality.grades_of(table(spark, sf_dir, "labels"))))


@query("op4_licenses")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op7_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = rules.fit(docs, table(spark, sf_dir, "labels"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.judge(docs, learned).select(*columns)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.fit(docs, table(spark, sf_dir, "labels")).score(docs)
    predicted = (scored["score"] >= 0.5).cast("int")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted.alias("predicted"))


@query("op2_secrets", sql.SECRETS)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=3, most=3)


@query("op10_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = forest.usable(table(spark, sf_dir, "embeddings"))
    return forest.neighbours(rows, rows.where("vec_id % 50 = 0"), k=5)


@query("op3_repeats")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query("op11_exact", sql.EXACT)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = digest_index.DigestIndex.open(spark, scratch(spark), digest_index.buckets_for(docs))
    found = index.add(docs)
    index.close()  # the result no longer reads the index
    return found


@query("op12_lexical", sql.LEXICAL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query("op13_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.scan(table(spark, sf_dir, "documents"), planted=True)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
