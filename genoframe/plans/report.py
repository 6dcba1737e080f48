"""What reports show: genes to highlight, LOH segments, chromosomes with calls, skipped rows, job status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import info as N
from ..functions import scalars as S

# Calls that are not neutral, notes of a failed estimation, headings of the job status.
CALLS = ("AMPLIFICATION", "DELETION")
PURITY_NOTES = {"Purity": "default fallback 20% purity", "Ploidy": "default fallback 2 ploidy"}
JOB_HEADINGS = {
    "failed": ("FAILED JOBS (no successful retry):",),
    "cancelled": ("CANCELLED JOBS (no successful retry):",),
    "resolved": ("", "NOTE:", "Some jobs failed but succeeded on retry:"),
    "unknown": ("Unknown status jobs:",),
}


def _upper(value: Column) -> Column:
    return F.upper(F.trim(F.coalesce(value.cast("string"), F.lit(""))))


def is_call(value: Column) -> Column:
    """An amplification or a deletion; a missing value is none."""
    return _upper(value).isin(*CALLS)


def is_loh(value: Column) -> Column:
    """A type that mentions LOH; a missing value doesn't."""
    return _upper(value).contains("LOH")


# ---------------------------------------------------------------- highlights


def gene_highlights(regions: DataFrame, calls: Sequence[str], loh: str, least: int, least_cancer: int, cancer_only: bool = False, chrom: str = "chr", gene: str = "gene", targets: str = "n_targets", cancer: str = "is_cancer_gene") -> DataFrame:
    """One row for each gene of a chromosome with its targets, evidence and whether to highlight it.

    A cancer gene needs ``least_cancer`` targets; another one a call or LOH and ``least``
    targets, unless only cancer genes are asked for.  The backbone and rows without a gene
    are left out; missing targets count as 0.
    """
    rows = regions.filter(F.col(gene).isNotNull() & (F.col(gene) != "backbone"))
    has_cnv = reduce(lambda a, b: a | b, [is_call(F.col(c)) for c in calls], F.lit(False))
    genes = rows.groupBy(chrom, gene).agg(
        F.coalesce(F.sum(targets), F.lit(0)).alias("total_targets"), F.bool_or(F.coalesce(F.col(cancer), F.lit(False))).alias("is_cancer_gene"),
        F.bool_or(has_cnv).alias("has_cnv"), F.bool_or(is_loh(F.col(loh))).alias("has_loh"),
    )
    chosen = F.col("is_cancer_gene") & (F.col("total_targets") >= least_cancer)
    other = ~F.col("is_cancer_gene") & (F.col("has_cnv") | F.col("has_loh")) & (F.col("total_targets") >= least)
    return genes.withColumn("highlight", chosen if cancer_only else chosen | other)


def loh_segments(segments: DataFrame, caller: str = "purecn", chrom: str | None = None) -> DataFrame:
    """Reliable LOH segments of a caller: ``chr start end``; input ``chr start end caller`` and, if known, ``purecn_type``."""
    if "purecn_type" not in segments.columns:
        return segments.select("chr", "start", "end").limit(0)
    kind = _upper(F.col("purecn_type"))
    keep = (_upper(F.col("caller")) == caller.upper()) & kind.contains("LOH") & ~kind.contains("UNRELIABLE")
    keep = keep if chrom is None else keep & (F.col("chr") == chrom)
    return segments.filter(keep).select("chr", "start", "end").orderBy("chr", "start", "end")


def chromosomes_with_calls(segments: DataFrame, chrom: str = "chr") -> DataFrame:
    """Chromosomes with a call or with any LOH type at all, as far as these columns exist."""
    marks = [is_call(F.col("cnv_call"))] if "cnv_call" in segments.columns else []
    marks += [F.col("purecn_type").isNotNull()] if "purecn_type" in segments.columns else []
    return segments.filter(reduce(lambda a, b: a | b, marks, F.lit(False))).select(F.col(chrom).cast("string").alias("chr")).distinct()


# ---------------------------------------------------------------- tables of a report


def purity_display(summary: DataFrame) -> DataFrame:
    """Purity and ploidy say where they are a fallback."""
    if "Comment" not in summary.columns:
        return summary
    return summary.withColumns({c: N.fallback_note(F.col(c), F.col("Comment"), note) for c, note in PURITY_NOTES.items() if c in summary.columns})


def skipped_variants(variants: DataFrame, valid: Column, chroms: Sequence[str], chrom: str = "chrom") -> DataFrame:
    """How many rows are invalid, and how many valid ones lie on each chromosome that isn't allowed."""
    ok = F.coalesce(valid, F.lit(False))
    rows = variants.select(F.when(~ok, "invalid").otherwise("illegal").alias("reason"), F.when(ok, F.col(chrom)).alias("chrom"), (~ok | ~F.coalesce(F.col(chrom).isin(*chroms), F.lit(False))).alias("_out"))
    return rows.filter("_out").groupBy("reason", "chrom").agg(F.count("*").alias("n"))


def visible_view(rows: DataFrame, visible: Column, columns: Sequence[str]) -> DataFrame:
    """Visible rows and columns as the text that is shown; write it with ``write_tsv``."""
    return rows.filter(visible).select(*[S.shown(F.col(c)).alias(c) for c in columns])


def with_metadata(df: DataFrame, key: str, metadata: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Static metadata of each key beside its row, null where there is none; the catalog is a literal of the caller."""
    names = sorted({n for entry in metadata.values() for n in entry})
    if not names:
        return df
    rows = [(k, *[entry.get(n) for n in names]) for k, entry in metadata.items()]
    known = df.sparkSession.createDataFrame(rows, ", ".join(["_key string", *[f"`{n}` string" for n in names]]))
    return df.join(F.broadcast(known), F.col(key) == F.col("_key"), "left").drop("_key")


def expanded(spark: SparkSession, pattern: str, **values: Sequence[str]) -> DataFrame:
    """A pattern with ``{name}`` marks for every combination of the values: their columns and ``path``."""
    out = spark.range(1).select(F.lit(pattern).alias("path"))
    for name, some in values.items():
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, some)).cast("array<string>"))).withColumn("path", F.replace("path", F.lit(f"{{{name}}}"), F.col(name)))
    return out


# ---------------------------------------------------------------- job status


def job_status_lines(jobs: DataFrame, at: str) -> DataFrame:
    """K7: the status of a run as ordered lines: ``section``, ``place``, ``value``.

    Input: ``kind`` (a key of ``JOB_HEADINGS``), ``job_id``, ``path``, ``state``.  A run
    without failed or cancelled jobs was successful.  Append a run with
    ``write_lines(..., mode="append")``.
    """
    spark = jobs.sparkSession
    sections = {kind: i + 2 for i, kind in enumerate(JOB_HEADINGS)}
    heads = [(kind, sections[kind], i - len(texts), text) for kind, texts in JOB_HEADINGS.items() for i, text in enumerate(texts)]
    frames = [(kind, section, 1, "") for kind, section in sections.items()]
    kinds = jobs.select("kind").distinct()
    framed = spark.createDataFrame(heads + frames, "kind string, section int, place int, value string").join(kinds, "kind", "left_semi").drop("kind")
    title = spark.createDataFrame([(0, 0, f"=== Job status check at {at} ==="), (0, 1, "")], "section int, place int, value string")
    good = spark.createDataFrame([(1, 0, "SUCCESSFUL", True), (1, 1, "", True)], "section int, place int, value string, _one boolean")
    bad = kinds.filter(F.col("kind").isin("failed", "cancelled")).select(F.lit(True).alias("_bad")).distinct()
    good = good.join(bad, F.col("_one") == F.col("_bad"), "left_anti").drop("_one")
    number = reduce(lambda acc, k: acc.when(F.col("kind") == k, sections[k]), sections, F.when(F.lit(False), 0))
    line = F.when(F.col("kind") == "unknown", F.concat_ws("\t", "job_id", F.lit("NA"))).when(F.col("kind") == "resolved", F.concat_ws("\t", "job_id", "path", "state")).otherwise(F.concat_ws("\t", "job_id", "path"))
    rows = jobs.filter(F.col("kind").isin(*sections)).select(number.cast("int").alias("section"), F.lit(0).alias("place"), line.alias("value"))
    return title.unionByName(good).unionByName(framed).unionByName(rows).orderBy("section", "place", "value")
