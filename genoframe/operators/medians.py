"""Exact medians of groups of any size, by counted ranges of values instead of a buffer for each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import release, settled

#: A group's rows are sorted in one task only when no more than this many can hold its middle.
FEW = 50_000

#: Equal parts of a range of values in each further round.
PARTS = 4096


def _octave(v: Column) -> Column:
    """Eighths of octaves, growing with the value: numbers of every size have at most some 35,000 of them."""
    size = F.floor(F.least(F.log2(F.abs(v)), F.lit(1100.0)) * 8).cast("long") + 8 * 1100
    return F.when(F.isnan(v), 1_000_000).when(v == 0, 0).otherwise(F.signum(v).cast("long") * size)


def _part(v: Column) -> Column:
    """Where a value lies between its range's ends; a range that spans more than an octave is cut by octaves instead."""
    lo, hi = F.col("_lo"), F.col("_hi")
    near = ((lo > 0) & (hi - lo <= lo)) | ((hi < 0) & (hi - lo <= -hi))
    return F.when(near, F.floor((v - lo) / (hi - lo) * PARTS).cast("long")).otherwise(_octave(v))


def _between(a: Column, b: Column) -> Column:
    return F.when(a.eqNullSafe(b), a).otherwise(a / 2 + b / 2)


def medians(df: DataFrame, by: Sequence[str], value: str, out: str = "median", few: int = FEW) -> DataFrame:
    """The keys and the median of each group; the mean of the two middle values of an even number.

    A round counts each group's values by ranges, keeps the range that holds the middle
    and cuts it again, until few rows are left in it or all of them are equal.  The cuts
    grow with the value, so what is chosen is exact.  The first round leaves an eighth of
    an octave and each further one a 4,096th part, so six rounds do for any doubles.
    Counts are made before the shuffle and a task holds at most ``few`` values of a group,
    whatever its size.  Nulls in the value are left out, a group of nothing else has the
    median null, NaN counts as greater than all numbers, null keys are a group, an empty
    table gives no group (without ``by``: one row), and other columns are dropped.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(value).cast("double").alias("_v"))
    first = rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    middle = {"_r1": F.floor((F.col("_n") - 1) / 2), "_r2": F.floor(F.col("_n") / 2)}
    open_ = (F.col("_n") > max(few, 2)) & ~F.col("_lo").eqNullSafe(F.col("_hi"))
    state = settled(first.withColumns({k: c.cast("long") for k, c in middle.items()}), "medians")
    while not state.filter(open_).isEmpty():
        now = _held(rows, state.filter(open_), keys).groupBy(*keys, "_r1", "_r2", _part(F.col("_v")).alias("_b")).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        here = now.withColumn("_before", before)
        low, high = ((F.col(r) >= F.col("_before")) & (F.col(r) < F.col("_before") + F.col("_n")) for r in ("_r1", "_r2"))
        found = here.groupBy(*keys).agg(*[F.max(F.when(low, F.struct("_n", "_lo", "_hi", (F.col("_r1") - F.col("_before")).alias("_r1"), (F.col("_r2") - F.col("_before")).alias("_r2")))).alias("_a"), F.max(F.when(high, F.col("_lo"))).alias("_up")])
        parted = F.col("_a._r2") >= F.col("_a._n")  # the middle two are the greatest of one part and the least of another
        ends = F.struct(F.lit(2).cast("long").alias("_n"), F.col("_a._hi").alias("_lo"), F.col("_up").alias("_hi"), F.lit(0).cast("long").alias("_r1"), F.lit(1).cast("long").alias("_r2"))
        cut = found.select(*keys, F.when(parted, ends).otherwise(F.col("_a")).alias("_a")).select(*keys, "_a.*")
        state, old = settled(state.filter(~open_).unionByName(cut), "medians"), state
        release(old)
    told = F.col("_lo").eqNullSafe(F.col("_hi")) | ((F.col("_n") == 2) & (F.col("_r2") == 1))
    ends = state.filter(told).select(*keys, _between(F.col("_lo"), F.col("_hi")).alias("_m"))
    there = _held(rows, state.filter(~told), keys).groupBy(*keys, "_r1", "_r2").agg(F.sort_array(F.collect_list("_v")).alias("_all"))
    listed = there.select(*keys, _between(*[F.get("_all", F.col(r).cast("int")) for r in ("_r1", "_r2")]).alias("_m"))
    return ends.unionByName(listed).withColumnsRenamed(dict(zip([*keys, "_m"], [*by, out])))


def _held(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows within their group's range, with the range and the ranks to find."""
    ranges = state.select(*[F.col(k).alias(f"{k}s") for k in keys], "_lo", "_hi", "_r1", "_r2")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}s"))
    return rows.join(ranges, same & (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))).drop(*[f"{k}s" for k in keys])
