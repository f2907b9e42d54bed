"""Documents made ready for training, in stages.

Each stage is written as Parquet to the cluster's shared folder and read again by the next; all but the last
return the columns of `documents`.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import exact_dedup, langid, pfair, queries, simhash
from txrisk.session import shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text fits a language of the corpus; what the models reject goes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", queries.ROWS_AT_ONCE)
    return langid.drop_rejected(docs, langid.training_lang())


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.deduplicate(docs, keep="largest")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by fingerprints of three-word shingles at two or fewer bits, the document with the least id stays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", queries.ROWS_AT_ONCE)
    return simhash.keep_representatives(docs, simhash.near_duplicates(docs, shingle_words=3))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the files and their rows follow the schedule."""
    return pfair.in_order(pfair.mix(docs))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of ids and of the decoded text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", queries.ROWS_AT_ONCE)
    return queries.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("pfair_mix", mix_sources),
    ("bpe", bpe_tokens),
]

# Language models and byte-pair merges can't be expressed in SQL; the tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = shared_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = os.path.join(base, f"{number}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
