"""Corpus pipeline: documents in, token ids of the kept documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``.  All but the last return
the columns of ``docs``:

quality        drops documents that the quality model rejects
near_duplicates keeps one document of each group of near copies
decontaminate  drops documents in which a benchmark window occurs
secrets        replaces secrets in the texts (documents stay)
encode         byte-level BPE ids, checked by decoding them

Nulls, empty texts, repeated rows, empty tables and further columns are
treated as the operators' docstrings say; further columns pass through all
stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargepulse.llm import bpe_fold, decontaminate, quality, secrets_scan, simhash
from chargepulse.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets_scan.redact(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe_fold.bpe(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("encode", encode_stage),
]

#: The stages are not expressible in SQL; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
