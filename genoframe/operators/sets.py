"""Sorts, unions, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import report_order, vcf_order


def genomic_sort(df: DataFrame, chrom: str = "chrom", pos: str = "pos", ties: Sequence[str] = ("ref", "alt"), report: bool = False) -> DataFrame:
    """Rows in genomic order; ties are broken by further columns where there are."""
    key = (report_order if report else vcf_order)(F.col(chrom))
    return df.orderBy(key, F.col(pos).cast("long"), *[t for t in ties if t in df.columns])


def union_all(frames: Sequence[DataFrame], tags: Sequence[str] | None = None, tag: str = "source") -> DataFrame:
    """Rows of all tables by name, missing columns null, tagged if asked for."""
    tagged = frames if tags is None else [f.withColumn(tag, F.lit(t)) for f, t in zip(frames, tags, strict=True)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def minus(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of one table that the other lacks."""
    return a.select(*keys).subtract(b.select(*keys))


def common(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of both tables."""
    return a.select(*keys).intersect(b.select(*keys))


def explode_list(df: DataFrame, cell: str, out: str, separator: str = r"\s*,\s*") -> DataFrame:
    """One row for each entry of a text list."""
    return df.withColumn(out, F.explode(F.split(F.trim(cell), separator)))


def zip_expand(df: DataFrame, arrays: Mapping[str, Column]) -> DataFrame:
    """One row for each place of several arrays taken together; shorter ones give nulls."""
    zipped = F.explode(F.arrays_zip(*[c.alias(n) for n, c in arrays.items()]))
    return df.withColumn("_z", zipped).withColumns({n: F.col(f"_z.{n}") for n in arrays}).drop("_z")


def split_alleles(df: DataFrame, alt: str = "alt", per_allele: Sequence[str] = (), with_ref: Sequence[str] = ()) -> DataFrame:
    """One row for each alternate allele; fields with a value per allele keep theirs, those with the reference keep two."""
    rows = df.select("*", F.posexplode(alt).alias("_i", "_alt"))
    taken = {c: F.get(F.col(c), F.col("_i")) for c in per_allele} | {c: F.array(F.get(F.col(c), F.lit(0)), F.get(F.col(c), F.col("_i") + 1)) for c in with_ref}
    return rows.withColumns(taken | {alt: F.col("_alt")}).drop("_i", "_alt")


def to_spec(df: DataFrame, rename: Mapping[str, str], first: Sequence[str], drop: Sequence[str] = (), drop_prefix: str | None = None) -> DataFrame:
    """Renamed columns, the preferred ones first, others kept behind; unwanted ones dropped if they are there."""
    left = [c for c in df.columns if c not in drop and not (drop_prefix and c.startswith(drop_prefix))]
    out = df.select(*left).withColumnsRenamed(dict(rename))
    return out.select(*[c for c in first if c in out.columns], *[c for c in out.columns if c not in first])


def unpivot_metrics(df: DataFrame, data: str, wanted: Sequence[str], skip: str = "umi") -> DataFrame:
    """Metric rows of a ``map<step, map<sample, map<metric, value>>>``, for wanted metrics, without keys that mention ``skip``."""
    steps = df.select(F.explode(data).alias("step", "_samples")).select("step", F.explode("_samples").alias("sample", "_metrics"))
    rows = steps.select("step", "sample", F.explode("_metrics").alias("name", "value"))
    clean = reduce(lambda a, b: a & b, [~F.lower(c).contains(skip) for c in ("step", "sample", "name")])
    return rows.filter(F.col("name").isin(*wanted) & clean)
