"""The training-data pipeline: documents in, packed sequences out.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next stage's docs. All but the last return the columns of
documents. A stage works on whatever its predecessor kept, whole tables and whole texts.

Defined results, beside those of the operators: an empty table runs through to an empty result; a document whose
words all went with duplicate lines goes too; n_chars follows the text; a document that the mix
takes twice is packed twice.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from panelforge.llm.common import scratch_path, table
from panelforge.llm.production import MIX_WEIGHTS, mixing_tree

#: SQL can't express a stage (MinHash, tokenizer); tests/llm/test_pipeline.py holds stages and run() against brute force
ORACLE_SQL = None
BUDGET_SHARE, EPOCHS = 0.8, 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.remove_lines(docs)
    changed = F.size(left.columns[-1]) > 0  # the removed lines
    gone = changed & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return left.where(~gone).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs, mixing_tree(), BUDGET_SHARE, MIX_WEIGHTS, EPOCHS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
