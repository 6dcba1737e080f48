"""Structural variants: callers to one table, frequencies, tumour and normal evidence, breakend pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import intervals as I
from ..operators import joins as J
from ..operators import windows as W
from ..sources.tables import settled
from .catalogs import SV_FILTERS

PRIORITY = ("manta", "delly", "ascat", "tiddit", "cnvpytor", "cnvkit", "dellycnv")


def merged(calls: DataFrame, priority: Sequence[str] = PRIORITY, ratio: float = 0.8, distance: float = 5000, passed: bool = True) -> DataFrame:
    """H6: passing calls of all callers in clusters; columns ``chrom start end svtype key caller filter``."""
    rows = calls.filter(P.is_pass(missing=True)) if passed else calls
    return I.merge_callers(rows, ["chrom", "svtype"], ("start", "end"), "key", "caller", priority, lambda df: settled(df, "clusters"), ratio, distance)


def paired(calls: DataFrame, ratio: float = 0.6, distance: float = 500) -> DataFrame:
    """Passing calls of tumour and normal (``caller``) in clusters of whatever like calls connect."""
    rows = calls.filter(P.is_pass(missing=False))
    return I.merge_callers(rows, ["chrom", "svtype"], ("start", "end"), "key", "caller", ("tumor", "normal"), lambda df: settled(df, "clusters"), ratio, distance, intra=True)


def frequency_filtered(calls: DataFrame, databases: dict[str, tuple[DataFrame, str, float]], stage: str) -> tuple[DataFrame, DataFrame]:
    """H6: the frequency of like variants in each database (table, column, distance), soft filters on them, and what passes."""
    out = calls
    for name, (table, column, distance) in databases.items():
        db = table.select("chrom", "svtype", F.col("start").alias("_ds"), F.col("end").alias("_de"), F.col(column).alias("_f"))
        out = I.frequency_annotation(out, db, ["chrom", "svtype"], ("start", "end"), ("_ds", "_de"), ["key"], {f"freq_{name}": "_f"}, ratio=0.8, distance=distance)
    entries = [f for f in SV_FILTERS[stage] if f.name in databases]
    soft = P.soft_filters(out, [P.SoftFilter(f.name, P.or_missing(F.col(f"freq_{f.name}") <= f.value, F.col(f"freq_{f.name}"))) for f in entries])
    return soft, soft.filter(P.is_pass(missing=True))


def support_filtered(calls: DataFrame, least: int = 4) -> DataFrame:
    """``pr_alt`` paired and ``sr_alt`` split reads for the variant."""
    return P.soft_filters(calls, [P.SoftFilter("low_pr_sr_count", F.coalesce("pr_alt", F.lit(0)) + F.coalesce("sr_alt", F.lit(0)) < least, "exclude")])


def evidence(calls: DataFrame) -> DataFrame:
    """H7: greatest allele fraction of tumour and normal, contigs, and the filters that follow.

    ``tumor`` and ``normal`` are arrays of ``detail|...`` texts, one for each merged call:
    the coverage detail first, other fields behind it.
    """
    out = calls
    for side, short in (("tumor", "t"), ("normal", "n")):
        info = F.coalesce(F.col(side), F.array().cast("array<string>"))
        best = W.argmax_index(F.transform(info, lambda x: S.coverage_fraction(F.substring_index(x, "|", 1))))
        at = F.when(best["value"] == 0, F.get(info, F.lit(0))).otherwise(F.get(info, best["index"]))
        out = out.withColumns({f"_af_{short}": best["value"], f"ctg_{short}": S.has_contig(at)})
    names = P.tumor_normal_evidence(F.col("_af_t"), F.col("_af_n"), F.col("ctg_t"), F.col("ctg_n"))
    old = F.array_except(F.coalesce("filter", F.array().cast("array<string>")), F.array(F.lit("PASS")))
    all_ = F.array_union(old, names)
    out = out.withColumn("filter", F.when(F.size(all_) > 0, all_).otherwise(F.array(F.lit("PASS"))))
    return out.withColumns({"af_t_max": F.bround("_af_t", 4), "af_n_max": F.bround("_af_n", 4)}).drop("_af_t", "_af_n")


def rescued_breakends(calls: DataFrame, name: str = "name", region: str = "region") -> DataFrame:
    """H7: both ends of a breakend pass if either does; ``name`` holds the mate's number, ``region`` two positions."""
    keyed = calls.withColumns({"_pair": S.pair_id(F.col(name), F.col(region)), "_mate": S.mate_number(F.col(name))})
    promoted = J.promote_mates(keyed, "_pair", "_mate", lambda: P.is_pass(), "_up", ["start"])
    return promoted.withColumn("filter", F.when(F.col("_up"), F.array(F.lit("PASS"))).otherwise(F.col("filter"))).drop("_pair", "_mate", "_up")


def copy_calls(calls: DataFrame) -> DataFrame:
    """Kind of each copy-number segment, from total and minor copies; what differs in neither is germline."""
    kind = P.copy_call_two(F.col("tcn_t"), F.col("tcn_n"), F.col("mcn_t"), F.col("mcn_n"))
    return calls.withColumns({"svtype": kind, "germline": kind == "CNV"})
