"""Scalar functions over variant fields, intervals, identifiers and quality values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def info_pair(item: Column) -> Column:
    """Key and value of ``key=value``; a flag has no value."""
    at = F.instr(item, "=")
    return F.struct(F.when(at > 0, F.substring_index(item, "=", 1)).otherwise(item).alias("key"), F.when(at > 0, item.substr(at + 1, F.length(item))).alias("value"))


def merged_info(items: Column, lists: tuple[str, ...] = ("AF", "DP")) -> Column:
    """``key=value`` items of several records as one text.

    Keys keep the order of their first arrival; values are joined by commas in order;
    flags stay flags, and a value beside a flag wins.  Keys in ``lists`` keep the first
    value and gain a ``<key>_LIST`` at the end if there are several.
    """
    pairs = F.transform(items, info_pair)
    keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
    values = lambda k: F.transform(F.filter(pairs, lambda p: (p["key"] == k) & p["value"].isNotNull()), lambda p: p["value"])
    listed = lambda k: k.isin(*lists)
    one = lambda k: F.when(F.size(values(k)) == 0, k).when(listed(k), F.concat(k, F.lit("="), F.element_at(values(k), 1))).otherwise(F.concat(k, F.lit("="), F.array_join(values(k), ",")))
    extra = [F.when(F.size(values(F.lit(k))) > 1, F.concat(F.lit(f"{k}_LIST="), F.array_join(values(F.lit(k)), ","))) for k in lists]
    return F.array_join(F.concat(F.transform(keys, one), F.array_compact(F.array(*extra))), ";")


def merged_filter(a: Column, b: Column) -> Column:
    """Sorted union of two FILTER texts; PASS only if nothing else is there, a dot if nothing is."""
    parts = lambda x: F.split(F.coalesce(F.when(x == ".", "").otherwise(x), F.lit("")), ";")
    every = F.filter(F.array_union(parts(a), parts(b)), lambda x: x != "")
    named = F.filter(every, lambda x: x != "PASS")
    text = F.array_join(F.array_sort(F.when(F.size(named) > 0, named).otherwise(every)), ";")
    return F.when(text == "", ".").otherwise(text)


def vcf_order(chrom: Column) -> Column:
    """Sort key of variant files; any other name comes last, by name."""
    special = F.create_map(*[x for k, v in (("X", 23), ("Y", 24), ("M", 25)) for x in (F.lit(k), F.lit(v))])
    n = F.coalesce(F.when(chrom.rlike(r"^\d+$"), chrom.try_cast("int")), F.try_element_at(special, chrom), F.lit(99))
    return F.struct(n.alias("n"), F.when(n == 99, chrom).otherwise("").alias("name"))


def report_order(chrom: Column) -> Column:
    """Sort key of reports: numbers, X, Y, then names."""
    digits = chrom.rlike(r"^\d+$")
    group = F.when(digits, 0).when(chrom.isin("X", "Y"), 1).otherwise(2)
    n = F.when(digits, chrom.try_cast("int")).when(chrom == "X", 23).when(chrom == "Y", 24).otherwise(0)
    return F.struct(group.alias("group"), n.alias("n"), F.when(group == 2, chrom).otherwise("").alias("name"))


def coverage_fraction(detail: Column) -> Column:
    """Allele fraction of ``DV:b1:RV:b2`` evidence, 0 where nothing covers it."""
    p = F.split(detail, ":")
    at = lambda i: F.coalesce(F.get(p, F.lit(i)).try_cast("double"), F.lit(0.0))
    return F.coalesce(F.try_divide(at(0) + at(2), at(1) + at(3)), F.lit(0.0))


def has_contig(fields: Column) -> Column:
    """A ``CTG:value`` field other than a dot."""
    return F.coalesce(F.exists(F.split(fields, r"\|"), lambda f: f.startswith("CTG:") & (f != "CTG:.")), F.lit(False))


def pair_id(name: Column, region: Column) -> Column:
    """What the two ends of a breakend have in common: two tokens of the id and the region's two."""
    return F.concat_ws("_", F.slice(F.split(name, "_"), 1, 2), F.slice(region, 1, 2))


def mate_number(name: Column) -> Column:
    return F.get(F.split(name, "_"), F.lit(2))


def depth_of(ad: Column) -> Column:
    """Sum of allele depths, missing ones as 0."""
    return F.aggregate(F.coalesce(ad, F.array().cast("array<int>")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def extended(start: Column, end: Column, least: int) -> Column:
    """C11: an interval widened around its centre to at least ``least``; wide ones stay."""
    mid, half = F.floor((start + end) / 2), least // 2
    wide = F.struct(F.greatest(F.lit(0), mid - half).cast("long").alias("start"), (mid + half + least % 2).cast("long").alias("end"))
    return F.when(end - start < least, wide).otherwise(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))


def midpoint(start: Column, end: Column) -> Column:
    """One base in the middle, half open."""
    mid = (start + F.floor((end - start) / 2)).cast("long")
    return F.struct((mid - 1).alias("start"), mid.alias("end"))


def purity_adjusted(log2: Column, purity: float, ploidy: float = 2.0) -> Column:
    """C14: log2 ratio of the tumour's own copies."""
    if not 0 < purity <= 1:
        raise ValueError("purity is a fraction above 0")
    copies = (F.pow(F.lit(2.0), log2) * ((1 - purity) * 2 + purity * ploidy) - (1 - purity) * 2) / purity
    return F.log2(F.greatest(copies, F.lit(1e-6)) / ploidy)


def allele_fraction(alt: Column, depth: Column) -> Column:
    """C15."""
    return F.round(F.try_divide(alt, depth), 6)


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared length of two intervals, not above 0 if they don't overlap."""
    return F.least(e1, e2) - F.greatest(s1, s2)


def abs_z(delta: Column, spread: Column, n: Column, least: int = 1) -> Column:
    """C17: missing without a spread, or with too few targets."""
    return F.when((spread > 0) & (n >= least), F.abs(delta) / (spread / F.sqrt(n)))


def bin_z(log2: Column, baseline: Column, spread: Column) -> Column:
    """Missing where the spread is 0."""
    return F.try_divide(log2 - F.coalesce(baseline, F.lit(0.0)), spread)


def clipped(x: Column, most: float) -> Column:
    """C19."""
    return F.greatest(F.least(x, F.lit(most)), F.lit(-most))


def kilobases(start: Column, end: Column) -> Column:
    """C20."""
    return F.bround((end - start) / 1000).cast("long")


def band_label(chrom: Column, first: Column, last: Column) -> Column:
    """C21."""
    one = F.concat(chrom, first)
    return F.when(first == last, one).otherwise(F.concat(one, F.lit("-"), last))


def confidence(fraction: Column, amount: Column, is_target: Column) -> Column:
    """Score of a sex prediction."""
    levels = lambda c, high, medium: F.when(c == "high", high).when(c == "medium", medium).when(c == "low", 1).otherwise(0)
    return levels(fraction, 4, 3) + levels(amount, 6, 5) + is_target.cast("int")


def capped(values: Column, most: float) -> Column:
    """C23."""
    return F.transform(values, lambda q: F.least(q, F.lit(most)))


def repaired_flag(flag: Column, mate_chrom: Column) -> Column:
    """Pairing bits imply bit 1; a missing mate sets bit 8."""
    paired = flag.bitwiseAND(2 + 8 + 32 + 64 + 128) != 0
    unmapped = (mate_chrom == "*") | (flag.bitwiseAND(8) != 0)
    return F.when(paired, F.when(unmapped, flag.bitwiseOR(8)).otherwise(flag).bitwiseOR(1)).otherwise(flag)


def repaired_tags(tags: Column, flag: Column) -> Column:
    """A mate's CIGAR goes with the mate."""
    return F.when(flag.bitwiseAND(8) != 0, F.filter(tags, lambda t: ~t.startswith("MC:Z:"))).otherwise(tags)


def sample_of_key(key: Column) -> Column:
    """C25."""
    inner = F.get(F.split(F.get(F.split(key, r"\."), F.lit(1)), "_"), F.lit(0))
    return F.when(key.contains("_align_sort_"), F.get(F.split(key, "_align_sort_"), F.lit(0))).otherwise(inner)


def case_of_sample(name: Column) -> Column:
    """C27."""
    return F.regexp_replace(name, "_NORMAL.*|_TUMOR.*", "")


def job_state(text: Column) -> Column:
    """C28."""
    return F.regexp_replace(F.get(F.split(F.trim(text), r"\s+"), F.lit(0)), r"\++$", "")


def known_extension(name: Column, extensions: tuple[str, ...]) -> Column:
    """The first known extension that a name ends with."""
    return F.coalesce(*[F.when(name.endswith(f".{e}"), F.lit(e)) for e in extensions])


def stem_tags(stem: Column) -> Column:
    """C30."""
    return F.split(F.lower(stem), "_")


def variant_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """C31."""
    return F.concat(chrom, F.lit(":"), pos.cast("string"), F.lit("_"), ref, F.lit("->"), alt)


def plain_chrom(chrom: Column, everywhere: bool = False) -> Column:
    """C33."""
    return F.replace(chrom, F.lit("chr"), F.lit("")) if everywhere else F.regexp_replace(chrom, "^chr", "")


def collapsed_space(text: Column) -> Column:
    """C34."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def data_uri(content: Column, kind: str) -> Column:
    """C35."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(content))


def flat_calls(samples: Column) -> Column:
    """Arrays of values of each sample, joined by colons, samples by tabs."""
    return F.array_join(F.transform(samples, lambda s: F.array_join(s, ":", ".")), "\t")


def shown(value: Column) -> Column:
    """Missing values as empty text."""
    text = value.cast("string")
    return F.when(text.isNull() | text.isin("<NA>", "nan", "NaN"), "").otherwise(text)
