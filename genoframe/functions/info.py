"""Column functions over the text forms of INFO, FILTER, sample and contig names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _items(info: Column) -> Column:
    return F.filter(F.split(F.coalesce(info, F.lit("")), ";"), lambda x: (x != "") & (x != "."))


def _text(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.array_join(items, ";")).otherwise(".")


def with_info(info: Column, key: str, value: Column) -> Column:
    """An INFO text with the key set; a key that is there keeps its place, a null value changes nothing."""
    items = _items(info)
    named = lambda x: F.substring_index(x, "=", 1) == key
    item = F.concat(F.lit(f"{key}="), value.cast("string"))
    there = F.exists(items, named)
    out = F.when(there, F.transform(items, lambda x: F.when(named(x), item).otherwise(x))).otherwise(F.concat(items, F.array(item)))
    return F.when(value.isNull(), info).otherwise(_text(out))


def with_id_info(info: Column, variant_id: Column, key: str) -> Column:
    """The record's id under a key, unless the id is missing or the text names the key already."""
    empty = info.isNull() | info.isin("", ".")
    add = variant_id.isNotNull() & (variant_id != ".")
    item = F.concat(F.lit(f"{key}="), variant_id)
    return F.when(add & empty, item).when(add & ~info.contains(f"{key}="), F.concat(info, F.lit(";"), item)).otherwise(info)


def with_sample_info(info: Column, depths: Column, fraction: Column) -> Column:
    """DP from the allele depths of a sample and AF from its fraction; without depths DP stays, without a fraction AF is 0.0."""
    depth = F.aggregate(depths, F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(x.cast("long"), F.lit(0)))
    return with_info(with_info(info, "DP", depth), "AF", F.coalesce(fraction.cast("string"), F.lit("0.0")))


def with_svtype(info: Column, svtype: Column) -> Column:
    """The type of a structural variant, without ``<``, ``,`` and ``>``, where the text has a type and a new one is given."""
    plain = F.regexp_replace(svtype, "[<,>]", "")
    items = _items(info)
    new = F.transform(items, lambda x: F.when(x.startswith("SVTYPE="), F.concat(F.lit("SVTYPE="), plain)).otherwise(x))
    return F.when(svtype.isNull() | (svtype == ""), info).otherwise(_text(new))


def first_filter(filters: Column) -> Column:
    """The first of a record's filters; PASS if there is none."""
    return F.coalesce(F.get(filters, F.lit(0)), F.lit("PASS"))


def renamed(names: Column, to: Mapping[str, str]) -> Column:
    """Names of an array under a map; others stay."""
    known = F.create_map(*[F.lit(x) for pair in to.items() for x in pair]) if to else None
    return names if known is None else F.transform(names, lambda x: F.coalesce(F.try_element_at(known, x), x))


def version_key(name: Column) -> Column:
    """S3: what to sort names by so that runs of digits count as numbers (chr2 before chr10).

    Up to twenty digits, leading zeros apart; names that differ in leading zeros alone
    are in the order of their texts.
    """
    runs = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), 1)
    digits = lambda x: F.regexp_replace(x, "^0+(?=.)", "")
    return F.struct(F.transform(runs, lambda x: F.when(x.rlike(r"^\d"), F.lpad(digits(x), 20, "0")).otherwise(x)).alias("runs"), name.alias("name"))


def fallback_note(value: Column, comment: Column, note: str) -> Column:
    """A value with a note where the comment says that the estimation failed."""
    failed = F.coalesce(F.upper(comment.cast("string")).contains("FAILED PURITY ESTIMATION"), F.lit(False))
    return F.when(failed, F.concat(F.coalesce(value.cast("string"), F.lit("nan")), F.lit(f" ({note})"))).otherwise(value.cast("string"))
