"""Corpus pipeline: from raw documents to token ids, in five stages over whole tables.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all
but the last return the columns of ``documents``.  Rows with a null id pass the
deduplicating stages as documents that equal nothing; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm import bpe, decontaminate, near, quality, substring
from genoframe.llm.common import settled, text_key

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    return quality.judge(docs, keep=COLUMNS[1:]).filter("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    gone = near.near_duplicates(docs).filter(~F.col("kept")).select("doc_id", "same").distinct()
    return docs.withColumn("same", text_key(F.col("text"))).join(gone, ["doc_id", "same"], "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur earlier in the corpus; a text may end up empty."""
    kept = substring.dedup_substrings(docs, keep=("lang", "source"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.filter("contaminated").select(F.col("doc_id").alias("gone_id"), F.col("same").alias("gone_same"))
    here = (F.col("doc_id").eqNullSafe(F.col("gone_id"))) & (text_key(F.col("text")) == F.col("gone_same"))
    return docs.join(gone, here, "left_anti").select(*COLUMNS)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to."""
    return bpe.encode(docs, keep=("lang", "source"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Token ids are beyond SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
