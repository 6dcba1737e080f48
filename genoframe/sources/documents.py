"""Small configuration documents (JSON, YAML), summaries and coverage with given names, lines and views as text."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .genomic import tsv

# Columns of a purity summary, in their order, and of coverage without a header.
PURITY_COLUMNS = ("Purity", "Ploidy", "Sex", "Contamination", "Flagged", "Failed", "Comment")
COVERAGE_COLUMNS = "chromosome string, start string, end string, gene string, depth string, log2 string"

#: Bytes of a configuration document; a larger one is data and belongs in a table.
MOST_BYTES = 16 << 20


def _whole(spark: SparkSession, path: str) -> str:
    try:
        sizes = spark.read.format("binaryFile").load(path).select("length").limit(2).collect()
    except AnalysisException as error:
        raise FileNotFoundError(f"No document at {path}") from error
    if len(sizes) != 1 or sizes[0].length > MOST_BYTES:  # empty files give no row
        raise ValueError(f"{path} must hold one file with content of at most {MOST_BYTES} bytes")
    return spark.read.text(path, wholetext=True).first().value


def read_json(spark: SparkSession, path: str) -> Any:
    """A configuration document, a file or a folder with one; it is an error if it doesn't exist, is empty or is large."""
    return json.loads(_whole(spark, path))


def read_yaml(spark: SparkSession, path: str) -> Any:
    """The same in YAML, with plain values only."""
    import yaml

    return yaml.safe_load(_whole(spark, path))


def write_json(spark: SparkSession, data: Any, path: str) -> None:
    """K4: a folder with one part, indented by four."""
    write_lines(spark.createDataFrame([(json.dumps(data, indent=4),)], "value string").coalesce(1), path)


def write_yaml(spark: SparkSession, data: Any, path: str) -> None:
    """K4: keys in their own order."""
    import yaml

    write_lines(spark.createDataFrame([(yaml.safe_dump(data, sort_keys=False).rstrip("\n"),)], "value string").coalesce(1), path)


def write_lines(rows: DataFrame, path: str, mode: str = "error") -> None:
    """K7: the column ``value`` as text; ``append`` adds parts beside those of earlier runs."""
    rows.select("value").write.mode(mode).text(path)


def write_tsv(view: DataFrame, path: str) -> None:
    """A view as tab-separated text with a header in each part."""
    view.write.option("sep", "\t").option("header", True).csv(path)


def named_coverage(spark: SparkSession, path: str, chroms: Sequence[str] = ("X", "Y"), least: int = 5) -> DataFrame:
    """``key chromosome depth`` of some chromosomes of coverage whose columns have given names.

    A header is a row like others, which no chromosome matches.  If one of the
    chromosomes has fewer than ``least`` rows there is too little to tell, and no row.
    """
    rows = tsv(spark, path, COVERAGE_COLUMNS, header=False).filter(F.col("chromosome").isin(*chroms))
    counts = rows.groupBy("chromosome").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    enough = counts.agg((F.count("*") == len(set(chroms))).alias("_enough"))  # one row
    told = rows.select(F.concat_ws("_", "chromosome", "start", "end").alias("key"), "chromosome", F.col("depth").try_cast("double").alias("depth"), F.lit(True).alias("_here"))
    return told.join(F.broadcast(enough), F.col("_here") == F.col("_enough"), "left_semi").drop("_here")


def purity_summary(df: DataFrame) -> DataFrame:
    """The wanted columns that exist, in their order; all columns if none does."""
    wanted = [c for c in PURITY_COLUMNS if c in df.columns]
    return df.select(*wanted) if wanted else df
