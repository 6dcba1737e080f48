"""Aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .medians import medians


def rollup(df: DataFrame, by: Sequence[str], start: str, end: str, value: str, means: Sequence[str] = ()) -> DataFrame:
    """Span, count and mean, least and greatest value of each group, and means of further columns."""
    return df.groupBy(*by).agg(
        F.min(start).alias("start"), F.max(end).alias("end"), F.count(value).alias("n"), F.avg(value).alias(f"mean_{value}"), F.min(value).alias(f"min_{value}"), F.max(value).alias(f"max_{value}"),
        *[F.avg(c).alias(f"mean_{c}") for c in means],
    )


def stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean, median, least, greatest, sample standard deviation and count."""
    rest = df.groupBy(*by).agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.stddev_samp(value).alias("std"), F.count(value).alias("count"))
    return _beside(rest, medians(df, by, value), by).select(*by, "mean", "median", "min", "max", "std", "count")


def _beside(rest: DataFrame, told: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row for each key on both sides, which may be null."""
    a, b = rest.alias("a"), told.alias("b")
    same = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in by]
    return a.join(b, same or F.lit(True), "left").select("a.*", *[F.col(f"b.`{c}`") for c in told.columns if c not in by])


def flat_stats(df: DataFrame, key: str, value: str, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row with ``<name>_<statistic>`` for each listed value of the key."""
    of = lambda f, n: f(F.when(F.col(key) == n, F.col(value)))
    kinds = {"mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp, "count": F.count}
    rest = df.groupBy(*by).agg(*[of(f, n).alias(f"{n}_{k}") for n in names for k, f in kinds.items()])
    told = medians(df.filter(F.col(key).isin(*names)), [*by, key], value, "_m")
    wide = told.groupBy(*by).agg(*[F.max(F.when(F.col(key) == n, F.col("_m"))).alias(f"{n}_median") for n in names])
    order = [f"{n}_{k}" for n in names for k in ("mean", "median", "min", "max", "std", "count")]
    return _beside(rest, wide, by).select(*by, *order)


def noise(df: DataFrame, by: Sequence[str], diff: str) -> DataFrame:
    """Population standard deviation of differences over the root of two."""
    return df.groupBy(*by).agg((F.stddev_pop(diff) / F.sqrt(F.lit(2.0))).alias("noise"))


def one_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row for each key; of differing values the least, so the result doesn't depend on order."""
    return df.groupBy(*keys).agg(*[F.min(v).alias(v) for v in values])


def distinct_list(df: DataFrame, by: Sequence[str], item: str, out: str, separator: str = ",") -> DataFrame:
    """Sorted distinct items of each group as text."""
    return df.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(item)), separator).alias(out))


def counts_at_least(df: DataFrame, by: Sequence[str], least: int) -> DataFrame:
    """G10."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def rate_per_unit(rows: DataFrame, regions: DataFrame, size: Column, unit: float, default: float | None = None) -> DataFrame:
    """Number of rows for each unit of the regions' total size (or of the default size)."""
    total = regions.agg((F.sum(size) / unit).alias("units"))
    return rows.agg(F.count("*").alias("n")).join(total).select("n", F.coalesce("units", F.lit(default)).alias("units")).withColumn("rate", F.try_divide(F.col("n"), F.col("units")))


def variant_types(df: DataFrame, ref: str = "ref", alt: str = "alt", by: Sequence[str] = ()) -> DataFrame:
    """Numbers of sites by the kind of variant."""
    lr, la = F.length(ref), F.length(alt)
    named = F.col(alt).startswith("<") | F.col(alt).contains("[") | F.col(alt).contains("]")
    return df.groupBy(*by).agg(
        F.count("*").alias("sites"), F.count_if(~named & (lr == 1) & (la == 1)).alias("snps"), F.count_if(~named & (lr != la)).alias("indels"),
        F.count_if(~named & (lr == la) & (lr > 1)).alias("mnps"), F.count_if(named).alias("others"),
    )


def two_level_mean(df: DataFrame, by: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Mean number of rows of a key."""
    return df.groupBy(*group, *by).count().groupBy(*group).agg(F.avg("count").alias("mean_count"), F.count("*").alias("keys"))


def agreement(df: DataFrame, by: Sequence[str], value: str, out: str, otherwise: str = "conflicting") -> DataFrame:
    """The value that all rows of a group share, or a word for disagreement."""
    return df.groupBy(*by).agg(F.when(F.count_distinct(value) == 1, F.min(value)).otherwise(otherwise).alias(out))


def any_rollup(df: DataFrame, by: Sequence[str], total: str, flags: Sequence[str]) -> DataFrame:
    """A sum, and whether any row has each flag."""
    return df.groupBy(*by).agg(F.sum(total).alias(total), *[F.bool_or(F.coalesce(f, F.lit(False))).alias(f) for f in flags])


def ordered_jobs(df: DataFrame, by: Sequence[str], job: str, fields: Sequence[str], most: int = 100_000) -> DataFrame:
    """Each group's jobs in ascending order; one rule has far fewer than ``most`` attempts, else it is an error."""
    seq = F.array_sort(F.collect_list(F.struct(F.col(job).cast("long").alias(job), *fields)))
    out = df.groupBy(*by).agg(F.count("*").alias("n"), seq.alias("jobs"))
    return out.withColumn("jobs", F.when(F.col("n") <= most, F.col("jobs")).otherwise(F.raise_error(F.lit("too many jobs in one group"))))
