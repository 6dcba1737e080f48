"""Equi-joins with merge rules, flags and checks of key uniqueness."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settled


class DuplicateKeys(ValueError):
    """A side that must have unique keys has not."""


#: Letters by which names are looked up in keys.
GRAM = 3


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``count``."""
    return df.groupBy(*keys).count().filter("count > 1")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raises DuplicateKeys naming some of the keys that occur twice; returns the input."""
    twice = duplicate_keys(df, keys).limit(5).collect()
    if twice:
        raise DuplicateKeys(", ".join(str(tuple(r[k] for k in keys)) for r in twice))
    return df


def merge_full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], merged: Mapping[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """Full outer join; each other column is the left value, else the right one, or what its rule makes of both.

    A rule sees nulls for a side without the row.
    """
    rules = merged or {}
    others = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c not in keys]
    l, r = left.alias("l"), right.alias("r")
    here = lambda df, side, c: F.col(f"{side}.`{c}`") if c in df.columns else F.lit(None)
    joined = l.join(r, [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys], "full_outer")
    both = [(rules[c](here(left, "l", c), here(right, "r", c)) if c in rules else F.coalesce(here(left, "l", c), here(right, "r", c))).alias(c) for c in others]
    return joined.select(*[F.coalesce(f"l.`{k}`", f"r.`{k}`").alias(k) for k in keys], *both)


def prefer_left(missing: str = ".") -> Callable[[Column, Column], Column]:
    """The left value unless it is the mark for missing."""
    return lambda a, b: F.coalesce(F.when(a.cast("string") != missing, a), b, a)


def flag_join(df: DataFrame, keys_of: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Every row, with whether its key is in the other table."""
    known = keys_of.select(*keys).distinct().withColumn(flag, F.lit(True))
    return df.join(known, list(keys), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def left_unique(df: DataFrame, lookup: DataFrame, keys: Sequence[str], one_to_one: bool = False, check: bool = True) -> DataFrame:
    """Left join to unique keys; duplicate keys of the lookup (or of both sides) are an error."""
    if check:
        check_unique(lookup, keys)
        if one_to_one:
            check_unique(df, keys)
    return df.join(lookup, list(keys), "left")


def missing_stats(baseline: DataFrame, seen: DataFrame, keys: Sequence[str], prefix: str = "filtered_out") -> DataFrame:
    """One row: keys of the baseline, how many were not seen, and their per cent."""
    base = baseline.select(*keys).distinct()
    flagged = base.join(seen.select(*keys).distinct().withColumn("_seen", F.lit(True)), list(keys), "left")
    total, gone = F.count("*"), F.count_if(F.col("_seen").isNull())
    return flagged.agg(total.alias("total"), gone.alias(prefix), F.round(F.try_divide(gone * 100.0, total), 3).alias(f"{prefix}_pct"))


def annotate(df: DataFrame, sources: Sequence[tuple[DataFrame, Sequence[str], Mapping[str, tuple[str, str]]]]) -> DataFrame:
    """Left joins of several databases on exact keys.

    Each source is (table, keys, {new column: (column, op)}) with op ``self`` (the least
    of a key's values, usually its only one) or ``mean``; tables are made unique first.
    """
    for table, keys, fields in sources:
        aggs = [(F.avg(c) if op == "mean" else F.min(c)).alias(new) for new, (c, op) in fields.items()]
        df = df.join(table.groupBy(*keys).agg(*aggs), list(keys), "left")
    return df


def promote_mates(df: DataFrame, pair: str, mate: str, status: Callable[[], Column], out: str = "promoted", order: Sequence[str] = ()) -> DataFrame:
    """Rows of a pair whose two mates are both present are promoted if either passes.

    Of rows with the same mate only the first by ``order`` has a say.
    """
    nth = F.row_number().over(Window.partitionBy(pair, mate).orderBy(*(order or [mate])))
    whole = Window.partitionBy(pair)
    ranked = df.withColumn("_nth", nth)
    has_say = F.col("_nth") == 1
    mates = F.count(F.when(has_say, F.lit(1))).over(whole)
    either = F.max(F.when(has_say, status().cast("int"))).over(whole)
    return ranked.withColumn(out, (mates >= 2) & (either == 1)).drop("_nth")


def first_source(requests: DataFrame, sources: DataFrame, tool: str, key: str, order: str) -> DataFrame:
    """For each request the first source whose key contains it, ignoring case.

    A name may lie anywhere in a key, so names are joined by their first GRAM letters
    (all letters of a shorter one) with the runs of that many letters in the keys, and
    the pairs that meet are compared whole.  Runs are made only of the lengths that names
    have.  Names are written first, so that their size is known and few of them are sent
    to the keys rather than all runs shuffled; keys are dealt over all tasks, as one file
    may hold them.  An empty name lies in every key, a null one in none.
    """
    name = requests.select(F.lower(requests[tool]).alias("_name")).filter("_name is not null").distinct()
    names = settled(name.withColumn("_gram", F.left("_name", F.lit(GRAM))), "names")
    lengths = [r[0] for r in names.select(F.length("_gram")).distinct().collect()]  # GRAM + 1 at most
    low = F.col("_low")
    runs = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - n + 1, F.lit(1))), lambda i: F.substring(low, i, F.lit(n))) if n else F.array(F.lit(""))
    grams = F.array_distinct(F.concat(F.array().cast("array<string>"), *map(runs, lengths)))
    parts = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = sources.filter(F.col(key).isNotNull()).repartition(parts).withColumn("_low", F.lower(F.col(key)))
    found = keys.withColumn("_gram", F.explode(grams)).join(names, "_gram").filter(low.contains(F.col("_name"))).drop("_gram", "_low")
    first = found.groupBy("_name").agg(F.min(F.struct(order, *[c for c in sources.columns if c != order])).alias("_x"))
    best = first.select("_name", *[F.col(f"_x.{c}").alias(c) for c in sources.columns])
    return requests.join(best, F.lower(requests[tool]) == F.col("_name"), "left").drop("_name")


def choose_by_score(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The winning row of each group by a composite order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter("_n = 1").drop("_n")
