"""Copy-number report: gene regions against a baseline, segments, noise, chromosome views, row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import intervals as I
from ..operators import joins as J
from ..operators import sets as T
from ..operators import windows as W

BIN = ["chr", "start", "end", "gene"]
#: Bins of a gene and of a run, weak z, z of a run, bins of a bridge, targets of a region.
LEAST_GENE, LEAST_RUN, WEAK_Z, RUN_Z, BRIDGE, LEAST_TARGETS = 8, 4, 1.5, 3.0, 2, 5


def baseline_joined(bins: DataFrame, baseline: DataFrame, check: bool = True) -> DataFrame:
    """D3: bins with the baseline's ``pon_log2`` and ``pon_spread``; the backbone goes on both sides."""
    real = lambda df: df.filter(F.col("gene") != "backbone")
    other = real(baseline).select(*BIN, F.col("log2").alias("pon_log2"), F.col("spread").alias("pon_spread"))
    return J.left_unique(real(bins), other, BIN, check=check)


def gene_regions(bins: DataFrame) -> DataFrame:
    """H8: runs of like deviation inside genes, joined over short bridges and scored.

    Input: ``baseline_joined``.  Genes with fewer than LEAST_GENE bins are one region.
    """
    z = S.bin_z(F.col("log2"), F.col("pon_log2"), F.col("pon_spread"))
    smooth = W.centered_median(bins.withColumn("_z", z), ["chr", "gene"], ["start", "end"], "_z", 3, out="z")
    labelled = smooth.withColumn("sign", W.sign_label(F.col("z"), WEAK_Z)).withColumn("n_gene", F.count("*").over(Window.partitionBy("chr", "gene")))
    runs = W.islands(labelled, ["chr", "gene"], ["start", "end"], F.when(F.col("n_gene") >= LEAST_GENE, F.col("sign")).otherwise(0))
    good = W.accepted_runs(runs.filter("sign <> 0"), ["chr", "gene"], "run", "log2", "pon_log2", "pon_spread", LEAST_RUN, RUN_Z).select("chr", "gene", "run", F.lit(True).alias("good"))
    joined = runs.join(good, ["chr", "gene", "run"], "left")
    label = F.when(F.col("good"), F.col("run")).otherwise(-1)
    again = W.islands(joined.withColumn("_label", label), ["chr", "gene"], ["start", "end"], F.col("_label"), "piece")
    pieces = again.groupBy("chr", "gene", "piece").agg(F.first(F.when(F.col("good"), F.col("sign")).otherwise(0)).alias("sign"), F.count("*").alias("n"))
    clean = W.bridge_merge(pieces, ["chr", "gene"], "piece", "sign", "n", BRIDGE)
    inside = again.join(clean.drop("sign"), ["chr", "gene"]).filter(F.col("piece").between(F.col("first"), F.col("last")))
    rolled = A.rollup(inside, ["chr", "gene", "clean"], "start", "end", "log2", ["pon_log2", "pon_spread"])
    delta = F.col("mean_log2") - F.col("mean_pon_log2")
    scored = rolled.withColumn("delta", delta).withColumn("abs_z", S.abs_z(delta, F.col("mean_pon_spread"), F.col("n"), LEAST_TARGETS))
    enough = lambda c: F.when(F.col("n") >= LEAST_TARGETS, c).otherwise("")
    signal = P.baseline_signal(F.col("abs_z"))
    return scored.withColumns(
        {"region": F.concat(F.lit("generegion_clean_"), F.col("clean").cast("string")), "direction": enough(P.baseline_direction(F.col("delta"))), "signal": enough(signal), "call": enough(P.baseline_call(F.col("delta"), signal))}
    ).drop("clean")


def genes(bins: DataFrame) -> DataFrame:
    """H9: one row for each gene."""
    return A.rollup(bins.filter(F.col("gene") != "backbone"), ["chr", "gene"], "start", "end", "log2")


def with_segments(regions: DataFrame, segments: DataFrame, sex: str, keys: Sequence[str], copies: str = "cn", width: float = 1e6) -> DataFrame:
    """D8 + B17: the segment that overlaps a region most, and what its copies mean for the sex."""
    own = [c for c in segments.columns if c != "chr"]
    named = segments.select("chr", *[F.col(c).alias(f"seg_{c}") for c in own])
    out = I.best_overlap(regions, named, ["chr"], ("start", "end"), ("seg_start", "seg_end"), keys, width)
    return out.withColumn("segment_call", P.copy_class(F.col(f"seg_{copies}"), F.col("chr"), F.lit(sex)))


def segment_table(segments: Sequence[DataFrame], callers: Sequence[str], bins: DataFrame, bands: DataFrame, sex: str, copies: str = "cn", least: int = 2) -> DataFrame:
    """Segments of all callers with their genes, bands, size and call."""
    rows = T.union_all(segments, callers, "caller")
    keys = ["caller", "chr", "start", "end"]
    targets = bins.select("chr", F.col("start").alias("_bs"), F.col("end").alias("_be"), "gene")
    counted = I.overlap_counts(rows, targets, ["chr"], ("start", "end"), ("_bs", "_be"), keys, "gene", least, 1e6)
    banded = I.band_range(counted, bands, ["chr"], ("start", "end"), ("band_start", "band_end"), keys, "band", 1e7)
    label = F.when(F.col("first_band").isNotNull(), S.band_label(F.concat(F.lit("chr"), "chr"), F.col("first_band"), F.col("last_band"))).otherwise("")
    out = banded.withColumns({"cytoband": label, "size_kb": S.kilobases(F.col("start"), F.col("end")), "call": P.copy_class(F.col(copies), F.col("chr"), F.lit(sex))})
    return T.to_spec(out, {"labels": "genes"}, ["caller", "chr", "start", "end", "size_kb", "cytoband", "call", "n_targets", "genes"], drop=("first_band", "last_band"))


def quality_summary(bins: DataFrame, baseline: DataFrame) -> DataFrame:
    """Noise of neighbouring bins over all chromosomes, and the share of baseline bins that are missing."""
    one = A.one_per_key(bins, ["chr", "start", "end"], ["log2"])
    spread = A.noise(W.lag_diff(one, ["chr"], ["start", "end"], "log2"), [], "diff")
    gone = J.missing_stats(baseline, bins, ["chr", "start", "end"])
    return spread.join(gone)  # one row each


def chromosome_view(bins: DataFrame, most: float = 2.0) -> DataFrame:
    """One row for each bin with its genes, centre on the axis, clipped value and median of five."""
    one = bins.groupBy("chr", "start", "end").agg(F.array_join(F.array_sort(F.collect_set("gene")), ",").alias("genes"), F.min("log2").alias("log2"))
    laid = W.cumulative_center(one.withColumn("_w", F.col("end") - F.col("start")), ["chr"], ["start", "end"], "_w", "x")
    smooth = W.centered_median(laid, ["chr"], ["start", "end"], "log2", 5, full=True, out="smooth")
    return smooth.withColumn("y", S.clipped(F.col("log2"), most)).drop("_w")


def report_filter(table: DataFrame, chrom: str | None = None, lo: float | None = None, hi: float | None = None, signals: Sequence[Column] = (), genes: Sequence[str] = (), least: int = 0, cancer_only: bool = False, gene: str = "genes", targets: str = "n_targets") -> DataFrame:
    """Rows in range with a signal, enough targets and a wanted gene."""
    keep = P.in_range(F.col("chr"), F.col("start"), F.col("end"), chrom, lo, hi) & P.any_signal(*signals)
    if genes:
        keep &= P.any_of_list(F.col(gene), genes)
    if targets in table.columns:
        keep &= P.min_targets(F.col(targets), least)
    if cancer_only:
        keep &= F.lower(F.col("is_cancer_gene").cast("string")).isin("true", "1", "yes")
    return table.filter(keep)


def column_groups(table: DataFrame, groups: Sequence[str], base: Sequence[str]) -> DataFrame:
    """Base columns and those of the chosen groups, which are prefixes."""
    return table.select(*[c for c in table.columns if c in base or any(c.startswith(f"{g}_") for g in groups)])
