"""INFO fields with the types that the header gives them, and the rules that follow from its Number."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Column types of the header's types; any other is text.
TYPES = {"Integer": "long", "Float": "double"}

#: A header may not declare more fields than this; the driver builds a column for each.
MOST_FIELDS = 10_000


class Field(NamedTuple):
    """A declared field: its id, Number and Type."""

    id: str
    number: str
    type: str

    @property
    def flag(self) -> bool:
        return self.type == "Flag" or self.number == "0"

    @property
    def single(self) -> bool:
        return self.number == "1" and not self.flag


def declared(header: DataFrame, category: str = "INFO") -> list[Field]:
    """The fields of a parsed header by id; of repeated ids the least line counts, more than ``MOST_FIELDS`` are an error."""
    one = header.filter((F.col("category") == category) & (F.coalesce("id", F.lit("")) != "")).groupBy("id").agg(F.min(F.struct("number", "type")).alias("f"))
    found = one.select("id", "f.*").orderBy("id").limit(MOST_FIELDS + 1).collect()
    if len(found) > MOST_FIELDS:
        raise ValueError(f"a header declares more than {MOST_FIELDS} fields")
    return [Field(r["id"], r["number"] or ".", r["type"] or "String") for r in found]


def wider_type(a: Column, b: Column) -> Column:
    """The type that holds values of both: text, but for a whole and a broken number; the one that is there if the other is missing."""
    numbers = a.isin(*TYPES) & b.isin(*TYPES)
    return F.when(a.isNull() | b.isNull() | (a == b), F.coalesce(a, b)).when(numbers, "Float").otherwise("String")


def typed_info(records: DataFrame, fields: Sequence[Field], info: str = "info", out: str = "fields") -> DataFrame:
    """Records with a struct of the declared fields, made from the map of texts.

    A flag is true where its key is there, else false; a field of Number 1 is a single
    value, any other an array with a null for each ``.``.  A missing key or a lone ``.``
    is null, as is what doesn't parse; keys that the header doesn't declare are left in
    the map only.
    """

    def value(f: Field) -> Column:
        here, kind = F.try_element_at(F.col(info), F.lit(f.id)), TYPES.get(f.type, "string")
        parsed = lambda x: F.when(x != ".", x).try_cast(kind)
        if f.flag:
            return F.coalesce(F.map_contains_key(info, F.lit(f.id)), F.lit(False))
        return parsed(here) if f.single else F.when(here != ".", F.transform(F.split(here, ","), parsed))

    return records.withColumn(out, F.struct(*[value(f).alias(f.id) for f in fields]))


def _of_allele(f: Field, values: Column, i: Column) -> Column:
    """What an array field keeps for the alternate allele of index ``i`` (from 0)."""
    k = i + 1
    corner = (k * (k + 1) / 2).cast("int")  # genotype of the reference and allele k; that of two alleles k lies k behind it
    picks = {"A": [i], "R": [F.lit(0), k], "G": [F.lit(0), corner, corner + k]}.get(f.number)
    return values if picks is None or f.flag or f.single else F.when(values.isNotNull(), F.array(*[F.get(values, p) for p in picks]))


def split_by_header(typed: DataFrame, fields: Sequence[Field], alt: str = "alt", at: str = "fields") -> DataFrame:
    """One row for each alternate allele; what each field keeps follows from its Number (A, R, G), others stay whole.

    Arrays too short for an allele give null there; a record without alleles gives no row.
    Genotypes of Number G are those of two chromosomes.
    """
    rows = typed.select("*", F.posexplode(alt).alias("_i", "_alt"))
    kept = F.struct(*[_of_allele(f, F.col(at)[f.id], F.col("_i")).alias(f.id) for f in fields])
    return rows.withColumns({at: kept, alt: F.col("_alt")}).drop("_i", "_alt")


def merged_fields(a: Column, b: Column, fields: Sequence[Field], rules: Mapping[str, Callable[[Column, Column], Column]] | None = None) -> Column:
    """The fields of two records of one variant: flags of either, arrays one behind the other, of single values the first that is there; ``rules`` by id go before."""

    def both(f: Field) -> Column:
        x, y = a[f.id], b[f.id]
        if rules and f.id in rules:
            return rules[f.id](x, y)
        if f.flag:
            return F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False))
        return F.coalesce(x, y) if f.single else F.coalesce(F.concat(x, y), x, y)

    return F.struct(*[both(f).alias(f.id) for f in fields])
