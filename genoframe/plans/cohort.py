"""Sex prediction, viewer tracks, quality metrics, job outcomes and panel intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import intervals as I
from ..operators import joins as J
from ..operators import sets as T
from ..operators import windows as W
from ..operators.medians import medians
from ..operators.regions import region_accumulator
from .catalogs import CASE_METRICS, REGION_SIZES, ZOOM

# States of finished jobs.
FAILED_STATES = ("FAILED", "CANCELLED", "TIMEOUT", "OUT_OF_MEMORY")
DONE_STATES = ("COMPLETED",)


# ---------------------------------------------------------------- sex


def rated_sex(coverage: DataFrame, value: str = "depth") -> DataFrame:
    """A prediction for each sample and kind of coverage, with its score; what can't be told is unknown."""
    rows = coverage.filter(F.col("chrom").isin("X", "Y"))
    wide = A.flat_stats(rows, "chrom", value, ["X", "Y"], ["sample", "kind"])
    told = P.sex_by_ratio(F.try_divide("Y_median", "X_median"))
    known = F.col("X_median").isNotNull() & F.col("Y_median").isNotNull() & (F.col("X_median") != 0)
    rated = wide.withColumns({"sex": F.when(known, told["sex"]).otherwise("unknown"), "fraction": F.when(known, told["confidence"]).otherwise("NA"), "amount": F.when(known, P.data_amount(F.col("X_count"), F.col("Y_count"))).otherwise("NA")})
    return rated.withColumn("score", S.confidence(F.col("fraction"), F.col("amount"), F.col("kind") == "target"))


def panel_sex(coverage: DataFrame, value: str = "depth") -> DataFrame:
    """Per sample, the prediction with the highest score of its target and antitarget coverage.

    Input: ``sample``, ``kind`` (target or antitarget), ``chrom`` and the value.  A
    prediction that can't be made still takes part, with the score of its kind.
    """
    return J.choose_by_score(rated_sex(coverage, value), ["sample"], [F.col("score").desc(), (F.col("kind") == "target").desc()])


def genome_sex(x: DataFrame, y: DataFrame) -> DataFrame:
    """From the medians of two lists of per-position coverage."""
    both = medians(x, [], "value", "x").join(medians(y, [], "value", "y"))  # one row each
    return both.withColumn("sex", P.sex_by_median(F.try_divide("y", "x")))


def case_sex(samples: DataFrame, by: Sequence[str] = ("case",)) -> DataFrame:
    """G20."""
    return A.agreement(samples, by, "sex", "case_sex")


# ---------------------------------------------------------------- viewer tracks


def allele_track(variants: DataFrame, chroms: Sequence[str], sequencing: str = "wgs") -> DataFrame:
    """Allele fractions of valid variants at every zoom level, as ``name start end value``.

    Input: ``chrom pos gt ad_alt dp``; a missing genotype or depth, a depth of 0 and
    other chromosomes are left out.  Numbers run over the whole genome.
    """
    ok = (F.col("gt") != "./.") & F.col("ad_alt").isNotNull() & (F.col("dp") > 0) & F.col("chrom").isin(*chroms)
    rows = variants.filter(F.coalesce(ok, F.lit(False))).withColumns({"o": S.vcf_order(F.col("chrom")), "value": S.allele_fraction(F.col("ad_alt"), F.col("dp"))})
    out = W.every_nth(rows, ["o", "pos"], ZOOM[sequencing])
    return out.select(F.concat_ws("_", "level", "chrom").alias("name"), F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), "value")


def coverage_track(coverage: DataFrame, sizes: Mapping[str, int] = REGION_SIZES, by: Sequence[str] = ()) -> DataFrame:
    """Mean coverage of regions of each zoom level's size; input ``chrom start end value``, and ``by`` where there are several tracks.

    Chromosomes are read in their order, as one track; see ``region_accumulator`` for
    what happens at their ends and at gaps.
    """
    out = region_accumulator(coverage, by, sizes, min(sizes.values()), [S.vcf_order(F.col("chrom"))])
    mid = S.midpoint(F.col("start"), F.col("end"))
    return out.select(*by, F.concat_ws("_", "level", "chrom").alias("name"), mid["start"].alias("start"), mid["end"].alias("end"), "value")


def panel_track(bins: DataFrame, levels: Sequence[str] = tuple(ZOOM["targeted"])) -> DataFrame:
    """One point in the middle of each bin at every level; input ``chr start end gene log2``."""
    rows = bins.filter(F.col("gene") != "Antitarget").withColumn("level", F.explode(F.array(*map(F.lit, levels))))
    mid = F.col("start") + F.floor((F.col("end") - F.col("start")) / 2).cast("long")
    return rows.select(F.concat_ws("_", "level", "chr").alias("name"), mid.alias("start"), (mid + 1).alias("end"), F.col("log2").alias("value"))


# ---------------------------------------------------------------- metrics


def metrics(multiqc: DataFrame, data: str, wanted: Mapping[str, tuple[str, float] | None], analysis: str, types: DataFrame | None = None) -> DataFrame:
    """Requested metrics of all steps with their conditions.

    ``types`` (sample, type) makes conditions depend on tumour or normal: whole-genome
    PCT_60X holds for the tumour only, MEDIAN_TARGET_COVERAGE for the normal only.
    """
    rows = T.unpivot_metrics(multiqc, data, list(wanted))
    spark = multiqc.sparkSession
    conditions = spark.createDataFrame([(k, *(v or (None, None))) for k, v in wanted.items()], "name string, norm string, threshold double")
    out = rows.join(F.broadcast(conditions), "name", "left").withColumn("sample", S.sample_of_key(F.col("sample")))
    if types is not None and analysis == "wgs":
        out = out.join(types, "sample", "left")
        off = ((F.col("name") == "PCT_60X") & (F.col("type") != "tumor")) | ((F.col("name") == "MEDIAN_TARGET_COVERAGE") & (F.col("type") != "normal"))
        off = F.coalesce(off, F.lit(False))
        out = out.withColumns({"norm": F.when(~off, F.col("norm")), "threshold": F.when(~off, F.col("threshold"))}).drop("type")
    gc = F.col("name").isin("GC_DROPOUT", "AT_DROPOUT") & (F.col("step") == "multiqc_picard_gcbias")
    return out.filter(~gc).withColumn("value", F.col("value").try_cast("double"))


def case_metrics(name: str, values: DataFrame) -> DataFrame:
    """Metric rows of another source (``sample``, ``value``) with the case's condition."""
    norm, threshold = CASE_METRICS[name]
    return values.select(F.lit(name).alias("name"), F.lit("case").alias("step"), "sample", F.col("value").cast("double").alias("value"), F.lit(norm).alias("norm"), F.lit(float(threshold)).alias("threshold"))


def validated(rows: DataFrame, warn_only: Sequence[str] = ()) -> DataFrame:
    """Each metric with ``status``; failures of warn-only metrics are warnings."""
    status = P.metric_status(F.col("norm"), F.col("value"), F.col("threshold"))
    return rows.withColumn("status", F.when((status == "fail") & F.col("name").isin(*warn_only), "warning").otherwise(status) if warn_only else status)


# ---------------------------------------------------------------- jobs


def job_outcomes(jobs: DataFrame) -> DataFrame:
    """The last failed attempt of each rule that never completed; input ``rule job_id state path``.

    States other than the fixed ones below are set aside.
    """
    rows = jobs.withColumn("state", S.job_state(F.col("state")))
    return W.latest_of_group(rows, ["rule"], [F.col("job_id").cast("long").desc()], keep=F.col("state").isin(*FAILED_STATES), unless=F.col("state").isin(*DONE_STATES))


# ---------------------------------------------------------------- panels


def panel_regions(regions: DataFrame, least: int = 100, pad: int = 0) -> DataFrame:
    """Intervals widened to a least size and merged."""
    x = S.extended(F.col("start"), F.col("end"), least)
    wide = regions.select("chrom", x["start"].alias("start"), x["end"].alias("end"))
    return I.interval_union(wide, ["chrom"], "start", "end", pad).withColumn("start", F.greatest("start", F.lit(0)))


def tagged_files(files: DataFrame, samples: DataFrame, tags: str = "tags") -> DataFrame:
    """Tags that are a sample's id become its name, and its type joins them; input ``path``, ``tags``."""
    one = samples.select(F.col("id").alias("_id"), F.col("name").alias("_name"), F.col("type").alias("_type"))
    each = files.select("path", F.posexplode(tags).alias("_i", "_tag")).join(one, F.col("_tag") == F.col("_id"), "left")
    both = F.array_compact(F.array(F.coalesce("_name", "_tag"), F.col("_type")))
    sorted_ = F.array_sort(F.collect_list(F.struct("_i", both.alias("t"))))
    return each.groupBy("path").agg(sorted_.alias("_x")).select("path", F.array_distinct(F.flatten(F.transform("_x", lambda x: x["t"]))).alias(tags))
