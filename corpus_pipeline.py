"""From raw documents to packed training sequences: the stages, in order, over the table `documents`.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sparkseries
from sparkseries.llm import language_id, packing, secret_scan, simhash_dedup, substring_dedup
from sparkseries.session import ensure_utc, scratch_path

# Task functions travel by value, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sparkseries)


def _recounted(docs: DataFrame) -> DataFrame:
    """The rows with `n_chars` of the text they have now, if there is such a column."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null texts and texts without a letter. `lang` tells the language found, where there was none or
    a wrong one."""
    model = language_id.learn(docs, ~language_id.held_out_rows(docs["doc_id"]))
    return language_id.keep_identified(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with near SimHash fingerprints the one with the smallest id stays."""
    return simhash_dedup.keep_one_of_each(docs).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that a document with a smaller id also has are cut out; other texts stay as they are."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = substring_dedup.drop_repeats(docs, carry=others, keep_spacing=True)
    texts = found.select("doc_id", F.col("kept").alias("text"), *([F.col("rest")[c].alias(c) for c in others]))
    return _recounted(texts).select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mask; all documents stay."""
    return _recounted(secret_scan.redact_secrets(docs)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Tokenizing and learned models are beyond SQL; the stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
