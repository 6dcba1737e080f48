"""Small variants: merge of callers, quality and clinical filters, phased merge, burden."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import intervals as I
from ..operators import joins as J
from ..operators import sequences as Q
from ..operators import sets as T
from ..operators import windows as W
from ..sources.tables import settled
from .catalogs import GENOME_MB, NORMAL_FILTERS, SNV_FILTERS, Filter, choose, full_name, hard_names, unique

KEY = ["chrom", "pos", "ref", "alt"]


def merge_callers(a: DataFrame, b: DataFrame) -> DataFrame:
    """H1: one row for each variant of either caller; ``genomic_sort`` orders them where they are written.

    Inputs have KEY (``alt`` as text), ``id``, ``qual``, ``filter`` and ``info`` as text
    and any other columns, which come from the first caller where it has the variant.
    """
    info = lambda x, y: S.merged_info(F.flatten(F.array(_items(x), _items(y))))
    rules = {"id": J.prefer_left(), "qual": J.prefer_left(), "filter": S.merged_filter, "info": info}
    return J.merge_full_outer(a, b, KEY, {k: r for k, r in rules.items() if k in a.columns})


def _items(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: (x != "") & (x != "."))


def quality_filters(kind: str, analysis: str, caller: str, exome: bool = False) -> list[P.SoftFilter]:
    """H3/F2: the soft filters of one branch, with the comparisons that branch uses.

    Columns: ``ad_t``, ``ad_n`` arrays of allele depths (reference first), ``af_t``,
    ``af_n``, ``qss`` array, ``alt_f1r2``, ``alt_f2r1``, ``sor``, ``rpa`` array, ``dp``,
    ``vd``, ``af``, ``mq``.
    """
    entries = choose(SNV_FILTERS[kind]["quality"], analysis, caller, exome)
    names = {f.name for f in entries}
    at = lambda n: unique(entries, n).value
    c, total = F.col, lambda a: F.get(F.col(a), F.lit(0)) + F.get(F.col(a), F.lit(1))
    alt = F.get("ad_t", F.lit(1))
    strict = kind == "wgs" and analysis == "single"
    out = []
    if "in_normal" in names:
        out.append(P.SoftFilter("in_normal", F.try_divide(c("af_n"), c("af_t")) > at("in_normal"), "exclude"))
    if kind == "umi":
        return out
    if caller == "vardict":
        checks = {"low_tumor_dp": c("dp") >= at("low_tumor_dp"), "low_tumor_ad": c("vd") >= at("low_tumor_ad"), "low_af": c("af") >= at("low_af"), "low_mq": c("mq") >= at("low_mq")}
        return out + [P.SoftFilter(n, e) for n, e in checks.items()]
    depth = total("ad_t") >= at("low_tumor_dp")
    if analysis == "paired":
        depth = F.coalesce(depth, F.lit(False)) | F.coalesce(total("ad_n") >= at("low_tumor_dp"), F.lit(False))
    out += [
        P.SoftFilter("low_tumor_dp", depth),
        P.SoftFilter("low_tumor_ad", alt > at("low_tumor_ad") if strict else alt >= at("low_tumor_ad")),
        P.SoftFilter("low_af", c("af_t") > at("low_af") if strict else c("af_t") >= at("low_af")),
    ]
    if "low_quality_scores" in names:
        out.append(P.SoftFilter("low_quality_scores", F.try_divide(S.depth_of(c("qss")), S.depth_of(c("ad_t"))) >= at("low_quality_scores")))
    if "low_strand_read_counts" in names:
        out.append(P.SoftFilter("low_strand_read_counts", (c("alt_f1r2") > at("low_strand_read_counts")) & (c("alt_f2r1") > at("low_strand_read_counts"))))
    out.append(P.SoftFilter("high_strand_oddsratio", c("sor") < at("high_strand_oddsratio")))
    if "high_tnscope_rpa" in names:
        out.append(P.SoftFilter("high_tnscope_rpa", F.exists("rpa", lambda x: x > at("high_tnscope_rpa")), "exclude"))
    return out


def quality_filtered(df: DataFrame, kind: str, analysis: str, caller: str, exome: bool = False, soft_normals: bool = False, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """H3: rows with their soft filters, and those that no hard filter drops; some names begin with ``prefix``."""
    start = df.filter(P.is_pass()) if (kind, analysis, caller) == ("tga", "single", "vardict") else df
    dropped = {"wgs": "alt_allele_in_normal", "tga": "MAF0.05" if caller == "vardict" else "alt_allele_in_normal", "umi": "alt_allele_in_normal"}[kind] if analysis == "paired" else None
    start = P.without_filter(start, dropped) if dropped else start
    soft = P.soft_filters(start, _prefixed(quality_filters(kind, analysis, caller, exome), prefix))
    names = hard_names(choose(SNV_FILTERS[kind]["quality"], analysis, caller, exome), soft_normals)
    return soft, P.hard_filter(soft, [full_name(n, prefix) for n in names])


def _prefixed(filters: Sequence[P.SoftFilter], prefix: str) -> list[P.SoftFilter]:
    return [replace(f, name=full_name(f.name, prefix)) for f in filters]


def _frequency_filters(entries: Sequence[Filter]) -> list[P.SoftFilter]:
    """A frequency at most the entry's value, or none."""
    return [P.SoftFilter(f.name, P.or_missing(F.col(f"freq_{f.name}") <= f.value, F.col(f"freq_{f.name}"))) for f in entries if f.value is not None]


def research_filtered(df: DataFrame, sources: dict[str, DataFrame], kind: str, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """H4: population frequencies joined on exact keys, soft filters on them (some names begin with ``prefix``), and what passes."""
    entries = SNV_FILTERS[kind]["research"]
    joined = J.annotate(df, [(table, KEY, {f"freq_{name}": ("freq", "self")}) for name, table in sources.items()])
    soft = P.soft_filters(joined, _prefixed(_frequency_filters([f for f in entries if f.name in sources]), prefix))
    return soft, P.hard_filter(soft, [full_name(n, prefix) for n in hard_names(entries, callers=False)])


def clinical_filtered(df: DataFrame, sources: dict[str, DataFrame], rescue: DataFrame, kind: str, classification: str = "onc") -> tuple[DataFrame, DataFrame]:
    """H5: in-house frequencies, rescue of listed and oncogenic variants, and what passes then."""
    entries = SNV_FILTERS[kind]["clinical"]
    joined = J.annotate(df, [(table, KEY, {f"freq_{name}": ("freq", "self")}) for name, table in sources.items()])
    soft = P.soft_filters(joined, _frequency_filters([f for f in entries if f.name in sources]))
    flagged = J.flag_join(soft, rescue, KEY, "listed")
    reasons = F.array_compact(F.array(F.when(F.col("listed"), F.lit("RescueList")), F.when(P.names_oncogenic(F.col(classification)), F.lit("ClinvarOnc"))))
    saved = P.rescued(flagged, reasons).drop("listed")
    return saved, P.hard_filter(saved, hard_names(entries, callers=False))


# Annotations whose presence takes a variant out of the burden.
KNOWN = ("existing_variation", "cosmic")
CONSEQUENCES = ("non_coding_transcript_exon_variant", "non_coding_transcript_variant", "feature_truncation")


def mutational_burden(df: DataFrame, regions: DataFrame | None = None, least_af: float = 0.05) -> DataFrame:
    """Passing, unknown SNPs and indels above the least allele fraction, for each megabase.

    A missing FILTER doesn't pass.  Columns ``existing_variation`` and ``cosmic`` (texts)
    and ``consequence`` (array) are looked at where they are there: a variant known to
    either, or with one of CONSEQUENCES, isn't counted.
    """
    small = (F.length("ref") != F.length("alt")) | (F.length("ref") == 1)
    keep = P.is_pass() & (F.col("af_t") >= least_af) & small
    for name in KNOWN:
        if name in df.columns:
            keep &= F.coalesce(F.col(name), F.lit("")) == ""
    if "consequence" in df.columns:
        keep &= ~F.coalesce(F.arrays_overlap("consequence", F.array(*map(F.lit, CONSEQUENCES))), F.lit(False))
    kept = df.filter(keep)
    if regions is None:
        return kept.agg(F.count("*").alias("n")).withColumn("units", F.lit(GENOME_MB)).withColumn("rate", F.col("n") / F.col("units"))
    return A.rate_per_unit(kept, regions, F.col("end") - F.col("start"), 1e6, GENOME_MB)


def normalised(df: DataFrame, reference: DataFrame, per_allele: Sequence[str] = (), with_ref: Sequence[str] = (), order: Sequence[str] = (), width: int = Q.WIDTH) -> DataFrame:
    """One row for each alternate allele, REF checked against the reference, left-aligned, of equal variants one (the first by ``order``, then the least).

    ``alt`` is an array; ``reference`` has blocks of ``width`` bases.
    """
    split = Q.checked_reference(T.split_alleles(df, "alt", per_allele, with_ref), reference, width=width)
    aligned = Q.left_align(split, reference, width=width)
    others = [c for c in aligned.columns if c not in KEY]
    first = F.min_by(F.struct(*others), F.struct(*order, *[c for c in others if c not in order])) if others else F.lit(None)
    return aligned.groupBy(*KEY).agg(first.alias("_x")).select(*[F.col(c) if c in KEY else F.col(f"_x.{c}").alias(c) for c in aligned.columns])


def phased_merge(df: DataFrame, reference: DataFrame | None = None, distance: int = 5, preserved: Sequence[str] = NORMAL_FILTERS, width: int = Q.WIDTH) -> DataFrame:
    """Neighbouring variants of one phase set joined to one multi-base variant; its parts stay, marked MERGED.

    Input: KEY, ``phase`` (null: none), ``qual``, ``af``, ``ad`` array, ``filter`` array,
    and where they are there ``info`` (map of numbers) and ``af_n``, ``ad_n`` of a normal
    sample.  Bases between parts come from the blocks of ``reference``, or without it
    from a column ``gap`` (the bases behind each variant).  Parts that overlap are not
    joined.  Beginnings that both alleles share are taken off, one base stays.  ``qual``
    and each field of the first part's ``info`` become the mean to four places, or null
    unless all parts have it.  ``parts`` lists filters, fractions, depths and keys of the
    parts, in order.  All filters stay if each part has one of ``preserved``; else parts
    that don't share one single filter are in conflict.
    """
    phased, rest = P.split_by(df, F.col("phase").isNotNull() & (F.length("ref") > 0))
    stacked = settled(W.stacks(phased, ["chrom", "phase"], "pos", "ref", distance), "stacks")
    behind = Q.with_bases(stacked, reference, "gap", F.col("pos") + F.length("ref"), F.lit(distance), width=width) if reference is not None else stacked
    optional = [c for c in ("info", "af_n", "ad_n") if c in df.columns]
    fields = ["pos", "ref", "alt", "qual", "af", "ad", "filter", "gap", *optional]
    entries = {"info": F.array_sort(F.map_entries(F.coalesce("info", F.create_map().cast("map<string,double>")))).alias("info")} if "info" in optional else {}  # maps have no order
    ordered = F.array_sort(F.collect_list(F.struct(*[entries.get(c, c) for c in fields])))
    groups = behind.groupBy("chrom", "phase", "stack").agg(ordered.alias("v")).filter(F.size("v") > 1)
    apart = F.forall(F.sequence(F.lit(1), F.size("v") - 1), lambda i: F.get("v", i)["pos"] - F.get("v", i - 1)["pos"] >= F.length(F.get("v", i - 1)["ref"]))
    groups = settled(groups.filter(apart), "phased")
    fill = lambda field: F.aggregate(
        F.sequence(F.lit(1), F.size("v") - 1), F.element_at("v", 1)[field],
        lambda text, i: F.concat(text, _between(F.get("v", i - 1), F.get("v", i)), F.get("v", i)[field]),
    )
    n = F.size("v")
    values = lambda f: F.transform("v", lambda x: x[f].cast("double"))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    mean = lambda xs: F.when(F.forall(xs, lambda x: x.isNotNull()), total(xs) / n)
    depths = lambda f: F.transform(F.sequence(F.lit(0), F.lit(1)), lambda i: F.floor(total(F.transform("v", lambda x: F.get(x[f], i).cast("double"))) / n).cast("int"))
    names = F.array_sort(F.array_distinct(F.flatten(F.transform("v", lambda x: x["filter"]))))
    kept = F.array(*map(F.lit, preserved))
    reduced = F.when(F.forall("v", lambda x: F.arrays_overlap(x["filter"], kept)) | (F.size(names) <= 1), names).otherwise(F.array(F.lit("MNV_CONFLICTING_FILTERS")))
    joined = lambda f: F.array_join(F.transform("v", f), ",")
    pair = lambda a: F.concat_ws("|", F.get(a, F.lit(0)).cast("string"), F.get(a, F.lit(1)).cast("string"))
    parts = {"filters": joined(lambda x: F.array_join(x["filter"], "|")), "tumor_afs": joined(lambda x: x["af"].cast("string")), "tumor_ads": joined(lambda x: pair(x["ad"]))}
    if "af_n" in optional:
        parts |= {"normal_afs": joined(lambda x: x["af_n"].cast("string"))}
    if "ad_n" in optional:
        parts |= {"normal_ads": joined(lambda x: pair(x["ad_n"]))}
    parts["vars"] = joined(lambda x: F.concat_ws("_", "chrom", x["pos"].cast("string"), x["ref"], x["alt"]))
    more = {"info": F.transform_values(F.map_from_entries(F.element_at("v", 1)["info"]), lambda k, _: F.bround(mean(F.transform("v", lambda x: F.try_element_at(F.map_from_entries(x["info"]), k).cast("double"))), 4))} if "info" in optional else {}
    more |= {c: f for c, f in {"af_n": mean(values("af_n")) if "af_n" in optional else None, "ad_n": depths("ad_n") if "ad_n" in optional else None}.items() if f is not None}
    whole = groups.select(
        "chrom", F.element_at("v", 1)["pos"].alias("pos"), fill("ref").alias("ref"), fill("alt").alias("alt"), "phase", F.bround(mean(values("qual")), 4).alias("qual"), mean(values("af")).alias("af"), depths("ad").alias("ad"),
        reduced.alias("filter"), *[c.alias(name) for name, c in more.items()], F.struct(*[c.alias(name) for name, c in parts.items()]).alias("parts"),
    ).withColumn("_same", Q.common_prefix(F.col("ref"), F.col("alt"), spare=1))
    merged = whole.withColumns({"pos": F.col("pos") + F.col("_same"), "ref": F.expr("substring(ref, _same + 1)"), "alt": F.expr("substring(alt, _same + 1)")}).drop("_same")
    inside = groups.select("chrom", "phase", "stack", F.lit(True).alias("merged"))
    marked = stacked.join(inside, ["chrom", "phase", "stack"], "left")
    marked = marked.withColumn("filter", F.when(F.col("merged"), F.array_union(F.array_remove("filter", "PASS"), F.array(F.lit("MERGED")))).otherwise(F.col("filter"))).drop("merged", "stack")
    return marked.unionByName(rest).unionByName(merged, allowMissingColumns=True)


def _between(a: Column, b: Column) -> Column:
    """Reference bases between two parts."""
    n = F.greatest(b["pos"] - a["pos"] - F.length(a["ref"]), F.lit(0))
    return F.coalesce(F.substring(a["gap"], F.lit(1), n.cast("int")), F.lit(""))


def umi_fractions(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Key, fraction and depth of variants inside regions."""
    inside = I.overlap_join(df.withColumn("_s", F.col("pos") - 1).withColumn("_e", F.col("pos")), regions, ["chrom"], ("_s", "_e"), ("start", "end"), 10_000, how="left_semi")
    return inside.select("chrom", "pos", S.variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")).alias("variant"), "af")
