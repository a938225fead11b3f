"""From raw documents to tokens: five stages, each written as Parquet and read again.

Documents that the quality classifier rejects go; of near copies one stays; secrets are
replaced by a mark; sources are mixed to their targets, a document drawn twice standing
twice; what is left is encoded. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plainloom.llm import bpe, mixing, quality, secrets, simhash
from plainloom.session import ship, stage, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = quality.fit(docs, quality.grades_of(table(spark, sf_dir, "labels")))
    return quality.select(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_one(docs, words_each=3, most=3)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.tokenise(docs, VOCABULARY, with_ids=True)


STAGES = [
    ("quality", select_quality),
    ("near_copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: Fitting a model, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
