"""Filters that mark or drop rows, and predicates that classify them.

A soft filter never drops a row: it adds its name to the row's array of filter names.
Whether a missing value passes is part of each filter, not left to three-valued logic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SoftFilter:
    """Rows get ``name`` where ``expr`` isn't true (mode include, B1) or is true (mode exclude, B2)."""

    name: str
    expr: Column
    mode: str = "include"

    def fails(self) -> Column:
        if self.mode not in ("include", "exclude"):
            raise ValueError(f"no such mode: {self.mode}")
        holds = F.coalesce(self.expr, F.lit(False))
        return holds if self.mode == "exclude" else ~holds


def or_missing(expr: Column, *values: Column) -> Column:
    """The predicate, or true where one of its values is missing."""
    return reduce(lambda a, b: a | b, [v.isNull() for v in values], F.coalesce(expr, F.lit(False)))


def soft_filters(df: DataFrame, filters: Sequence[SoftFilter], into: str = "filter") -> DataFrame:
    """Adds the names of all failed filters, in order, by one projection; PASS goes once a name is there."""
    failed = F.array_compact(F.array(*[F.when(f.fails(), F.lit(f.name)) for f in filters])) if filters else F.array().cast("array<string>")
    old = F.coalesce(F.col(into), F.array().cast("array<string>")) if into in df.columns else F.array().cast("array<string>")
    named = F.array_union(F.array_except(old, F.array(F.lit("PASS"), F.lit("."))), failed)
    return df.withColumn(into, F.when(F.size(named) > 0, named).otherwise(old))


def lacks_filters(names: Sequence[str], of: str = "filter") -> Column:
    """True for rows that have none of the names (whole names, not substrings)."""
    return ~F.arrays_overlap(F.coalesce(F.col(of), F.array().cast("array<string>")), F.array(*map(F.lit, names))) if names else F.lit(True)


def hard_filter(df: DataFrame, names: Sequence[str], of: str = "filter") -> DataFrame:
    return df.filter(lacks_filters(names, of))


def is_pass(of: str = "filter", missing: bool = False) -> Column:
    """FILTER is exactly PASS, or also missing."""
    only = F.coalesce(F.col(of) == F.array(F.lit("PASS")), F.lit(False))
    return only | F.col(of).isNull() | (F.size(of) == 0) | (F.col(of) == F.array(F.lit("."))) if missing else only


def mentions_pass(line: str = "value") -> Column:
    """A header line, or a line with PASS anywhere in it."""
    return F.col(line).contains("#") | F.col(line).contains("PASS")


def without_filter(df: DataFrame, name: str, of: str = "filter") -> DataFrame:
    """One filter name taken away."""
    return df.withColumn(of, F.array_remove(of, name))


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which the predicate is true, and all others."""
    holds = F.coalesce(predicate, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def source_dependent(source: Column, strict_source: str, amount: Column, least: float) -> Column:
    """Rows of other sources, or rows of the strict one with at least so much (not a number: 0)."""
    return (F.upper(F.trim(source)) != strict_source.upper()) | (F.coalesce(amount.cast("string").try_cast("double"), F.lit(0.0)) >= least)


def is_indel(ref: str = "ref", alt: str = "alt") -> Column:
    """B10."""
    return F.length(ref) != F.length(alt)


def names_oncogenic(values: Column) -> Column:
    """A classification text that mentions oncogenic, tier or uncertain, whatever else it says."""
    return F.coalesce(F.lower(F.array_join(values, "|")).rlike("oncogenic|tier|uncertain"), F.lit(False))


def rescued(df: DataFrame, reasons: Column, of: str = "filter") -> DataFrame:
    """Rows with reasons and a filter other than PASS become PASS; their filters and reasons are kept beside."""
    open_ = ~is_pass(of, missing=True) & (F.size(reasons) > 0)
    return df.withColumns(
        {
            "rescue_filters": F.when(open_, F.array_join(of, "|")),
            "rescue_status": F.when(open_, F.array_join(reasons, "|")),
            of: F.when(open_, F.array(F.lit("PASS"))).otherwise(F.col(of)),
        }
    )


def tumor_normal_evidence(af_t: Column, af_n: Column, ctg_t: Column, ctg_n: Column, most: float = 0.25) -> Column:
    """Filter names of a structural variant; no tumour evidence stops the rest."""
    ratio = F.when(af_t == 0, F.lit(0.0)).otherwise(af_n / af_t)
    later = F.array_compact(
        F.array(
            F.when(ratio > most, F.lit("high_normal_af_fraction")), F.when(af_n > most, F.lit("high_normal_af")),
            F.when(ctg_n & (af_n == 0) & (af_t <= most), F.lit("in_normal")),
        )
    )
    return F.when((af_t == 0) & ~ctg_t, F.array(F.lit("normal_variant"))).otherwise(later)


def copy_call_two(total_t: Column, total_n: Column, minor_t: Column, minor_n: Column) -> Column:
    """DUP wins where total and minor copies disagree."""
    return F.when((total_t > total_n) | (minor_t > minor_n), "DUP").when((total_t < total_n) | (minor_t < minor_n), "DEL").otherwise("CNV")


def copy_call_depth(tumor: Column, normal: Column | None = None) -> Column:
    """Against the normal, or against two copies; no change is an empty string."""
    base = F.lit(2) if normal is None else normal
    return F.when(tumor > base, "DUP").when(tumor < base, "DEL").otherwise("")


def expected_copies(chrom: Column, sex: Column) -> Column:
    """Copies to expect of a chromosome."""
    plain = F.upper(F.regexp_replace(chrom, "^chr", ""))
    return F.when(plain == "X", F.when(sex == "female", 2).otherwise(1)).when(plain == "Y", F.when(sex == "male", 1).otherwise(0)).otherwise(2)


def copy_class(copies: Column, chrom: Column, sex: Column, words: tuple[str, str, str] = ("AMPLIFICATION", "DELETION", "NEUTRAL")) -> Column:
    """Missing copies give an empty string."""
    more, less, same = words
    expected = expected_copies(chrom, sex)
    return F.when(copies.isNull(), "").when(copies > expected, more).when(copies < expected, less).otherwise(same)


def baseline_direction(delta: Column) -> Column:
    """B19."""
    return F.when(delta.isNull(), "").when(delta > 0, "gain").when(delta < 0, "loss").otherwise("")


def baseline_signal(abs_z: Column, noise: float = 2, strong: float = 5) -> Column:
    """B19."""
    return F.when(abs_z.isNull(), "").when(abs_z < noise, "noise").when(abs_z < strong, "borderline").otherwise("strong")


def baseline_call(delta: Column, signal: Column, cut: float = 0.07) -> Column:
    """Only strong signals are called."""
    return F.when((signal != "strong") | delta.isNull(), "").when(delta > cut, "GAIN").when(delta < -cut, "LOSS").otherwise("NEUTRAL")


def sex_by_ratio(y_x: Column) -> Column:
    """Predicted sex and confidence from the Y/X ratio of panel coverage."""
    of = lambda sex, sure: F.struct(F.lit(sex).alias("sex"), sure.alias("confidence"))
    male = F.when(y_x >= 0.9, "high").when(y_x >= 0.7, "medium").otherwise("low")
    female = F.when(y_x >= 0.05, "medium").when(y_x >= 1e-5, "high").otherwise("low")
    return F.when(y_x > 0.2, of("male", male)).when(y_x <= 0.15, of("female", female)).otherwise(of("unknown", F.lit("low")))


def sex_by_median(y_x: Column) -> Column:
    """B21."""
    return F.when(y_x > 0.1, "male").when(y_x < 0.08, "female").otherwise("unknown")


def data_amount(x: Column, y: Column) -> Column:
    """B22."""
    n = F.least(x, y)
    return F.when(n < 10, "low").when(n < 50, "medium").otherwise("high")


def duplex_support(tag: Column, least: tuple[int, int, int] = (3, 1, 1)) -> Column:
    """Read pairs of both strands in a tag ``XZ:Z:a,b``; a missing tag is rejected."""
    a = F.regexp_extract(tag, r"XZ:Z:(\d+),(\d+)", 1).try_cast("int")
    b = F.regexp_extract(tag, r"XZ:Z:(\d+),(\d+)", 2).try_cast("int")
    low, high = sorted(least[1:])
    return F.coalesce((a + b >= least[0]) & (F.least(a, b) >= low) & (F.greatest(a, b) >= high), F.lit(False))


def supporting_read(flag: Column, chrom: Column, pos: Column, mate: Column, mate_pos: Column, tags: Column, here: tuple[str, int, int], there: tuple[str, int, int]) -> Column:
    """No duplicate, in one locus, with its mate or a split alignment in the other."""
    inside = (chrom == here[0]) & pos.between(here[1], here[2])
    other = (mate == there[0]) & mate_pos.between(there[1], there[2])
    return (flag.bitwiseAND(1024) == 0) & inside & (other | F.coalesce(tags.rlike(rf"SA:Z:{there[0]},"), F.lit(False)))


def metric_status(norm: Column, value: Column, threshold: Column) -> Column:
    """Pass or fail by a comparison's name, no_condition without one; an unknown name is an error."""
    ops = {"lt": value < threshold, "le": value <= threshold, "eq": value == threshold, "ne": value != threshold, "ge": value >= threshold, "gt": value > threshold}
    held = reduce(lambda chain, x: chain.when(norm == x[0], x[1]), list(ops.items())[1:], F.when(norm == "lt", ops["lt"]))
    known = norm.isin(*ops)
    return F.when(norm.isNull(), "no_condition").when(~known, F.raise_error(F.concat(F.lit("unknown comparison: "), norm)).cast("string")).when(F.coalesce(held, F.lit(False)), "pass").otherwise("fail")


def catalog_match(column: Column, wanted: Column) -> Column:
    """A missing entry of the catalog matches everything, and so does a missing wish."""
    return column.isNull() | wanted.isNull() | (column == wanted)


def resolved_sex(given: Column, normal: Column, tumor: Column) -> Column:
    """B35."""
    known = lambda c: F.when(c.isNotNull() & (c != "unknown"), c)
    return F.coalesce(known(given), known(normal), known(tumor), F.lit("female"))


def present_text(value: Column) -> Column:
    """Text that says something."""
    return ~F.lower(F.trim(F.coalesce(value.cast("string"), F.lit("")))).isin("", "na", "nan", ".")


def non_neutral(value: Column) -> Column:
    return present_text(value) & (F.lower(F.trim(value)) != "neutral")


def in_range(chrom: Column, start: Column, end: Column, want_chrom: str | None = None, lo: float | None = None, hi: float | None = None) -> Column:
    """Inclusive overlap with open ends; rows without coordinates pass."""
    strip = lambda c: F.lower(F.regexp_replace(c, "^[cC][hH][rR]", ""))
    same = strip(chrom) == strip(F.lit(want_chrom)) if want_chrom else F.lit(True)
    right = F.coalesce(end >= lo, F.lit(True)) if lo is not None else F.lit(True)
    left = F.coalesce(start <= hi, F.lit(True)) if hi is not None else F.lit(True)
    return F.coalesce(same, F.lit(True)) & right & left


def min_targets(n: Column, least: int) -> Column:
    """Enough targets; 0 asked for, missing and non-numeric pass."""
    return F.coalesce(n.cast("string").try_cast("double") >= least, F.lit(True)) if least else F.lit(True)


def any_of_list(cell: Column, wanted: Sequence[str], separator: str = ",") -> Column:
    """Lists that share an entry, whatever the case; an empty wish passes, an empty cell fails."""
    names = [w.strip().lower() for w in wanted if w.strip()]
    if not names:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(F.transform(F.split(F.lower(cell), separator), lambda x: F.trim(x)), F.array(*map(F.lit, names))), F.lit(False))


def any_signal(*active: Column) -> Column:
    """Signals that are switched on, combined by OR; none switched on passes."""
    return reduce(lambda a, b: a | b, active) if active else F.lit(True)
