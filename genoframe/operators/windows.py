"""Ordered operators: differences, framed medians, islands, sampling, bridges, stacks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settled
from . import ordered as O


def lag_diff(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str = "diff") -> DataFrame:
    """Difference to the row before."""
    near = O.neighbours(O.ranged(df, by, order), by, order, F.col(value), 1, 0, "_near")
    return near.withColumn(out, F.col(value) - F.get("_near", F.lit(0))["v"]).drop("_near", "_p")


def centered_median(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, size: int, full: bool = False, out: str = "median") -> DataFrame:
    """Median of the rows around each; ``full`` asks for a whole frame, else any row will do."""
    half = size // 2
    near = O.neighbours(O.ranged(df, by, order), by, order, F.col(value).cast("double"), half, half, "_near")
    there = F.array_sort(F.filter(F.transform("_near", lambda x: x["v"]), lambda v: v.isNotNull()))
    n = F.size("_there")
    middle = (F.get("_there", F.floor((n - 1) / 2).cast("int")) + F.get("_there", F.floor(n / 2).cast("int"))) / 2
    return near.withColumn("_there", there).withColumn(out, F.when(n >= (size if full else 1), middle)).drop("_near", "_there", "_p")


def islands(df: DataFrame, by: Sequence[str], order: Sequence[str], label: Column, out: str = "run") -> DataFrame:
    """Numbers the runs of equal labels; a null label equals a null."""
    return O.numbered(O.ranged(df, by, order), by, order, label, lambda a, b: ~a.eqNullSafe(b), out).drop("_p")


def sign_label(z: Column, weak: float) -> Column:
    """0 for weak values, else the sign; a missing value counts as negative."""
    return F.when(z.isNull() | F.isnan(z), -1).when(F.abs(z) < weak, 0).otherwise(F.signum(z).cast("int"))


def accepted_runs(df: DataFrame, by: Sequence[str], run: str, value: str, baseline: str, spread: str, length: int, least_z: float) -> DataFrame:
    """Runs of enough rows whose mean differs enough from the baseline: keys, ``n``, ``delta`` and ``z``."""
    delta = F.avg(F.col(value) - F.col(baseline))
    n = F.count("*")
    z = F.abs(delta) / (F.avg(spread) / F.sqrt(n))
    runs = df.groupBy(*by, run).agg(n.alias("n"), delta.alias("delta"), z.alias("z"))
    return runs.filter((F.col("n") >= length) & (F.col("z") >= least_z))


def bridge_merge(runs: DataFrame, by: Sequence[str], order: str, sign: str, size: str, most: int) -> DataFrame:
    """From left to right, a short run between two of one sign joins them; a joined run isn't looked at again.

    ``sign`` is 0 for a bridge.  The rule is an automaton of three states, the number of
    runs that an earlier one has still to take: state 0 takes the next two where they can
    be joined, the others count down.  Gives the keys, ``clean`` (number of the merged
    run), its ``sign`` and the first and last ``order`` it spans.
    """
    rows = O.ranged(runs.select(*by, order, sign, size), by, [order])
    near = O.neighbours(rows, by, [order], F.struct(F.col(sign).alias("s"), F.col(size).alias("n")), 0, 2, "_near")
    a, b, c = (F.get("_near", F.lit(i))["v"] for i in range(3))
    joins = (a["s"] != 0) & (c["s"] == a["s"]) & (b["s"] == 0) & (b["n"] <= most)
    marked = near.withColumn("_joins", F.coalesce(joins, F.lit(False)).cast("int")).drop("_near")
    met = settled(O.walk(marked, by, [order], "_joins", BRIDGE_MOVES, "_taken"), "bridges")
    clean = O.running(met, by, [order], (F.col("_taken") == 0).cast("long"), "clean").withColumn("clean", F.col("clean") - 1)
    return clean.groupBy(*by, "clean").agg(F.min(order).cast("long").alias("first"), F.max(order).cast("long").alias("last"), F.min_by(sign, order).cast("int").alias("sign"))


#: States of ``bridge_merge`` by what follows a run: that it can't, or can, be joined with the next two.
BRIDGE_MOVES = [[0, 2], [0, 0], [1, 1]]


def cumulative_center(df: DataFrame, by: Sequence[str], order: Sequence[str], width: str, out: str = "center") -> DataFrame:
    """Position of each row's middle when rows are laid side by side."""
    total = O.running(O.ranged(df, by, order), by, order, F.col(width), out)
    return total.withColumn(out, F.col(out) - F.col(width) / 2).drop("_p")


def every_nth(df: DataFrame, order: Sequence[str], levels: dict[str, int], by: Sequence[str] = (), level: str = "level") -> DataFrame:
    """For each level every (n+1)th row from the first on, counted within ``by``.

    Rows are numbered in two steps, counts of ranges first, so no task holds all rows of a key.
    """
    numbered = O.running(O.ranged(df, by, order), by, order, F.lit(1).cast("long"), "_i").withColumn("_i", F.col("_i") - 1).drop("_p")
    steps = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(n + 1).alias("step")) for k, n in levels.items()])
    out = numbered.withColumn("_l", F.explode(steps)).filter(F.col("_i") % F.col("_l.step") == 0)
    return out.withColumn(level, F.col("_l.name")).drop("_i", "_l")


def global_index(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """0, 1, 2, ... over the whole table in order: range partitions are numbered inside, and their sizes added up."""
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = settled(df.repartitionByRange(int(parts), *[F.col(c) for c in order]).withColumn("_p", F.spark_partition_id()), "ordered")  # both uses must see the same ranges
    inside = ordered.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1)
    sizes = ordered.groupBy("_p").count()
    before = sizes.withColumn("_before", F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))  # one row for each partition
    return inside.join(F.broadcast(before.select("_p", F.coalesce("_before", F.lit(0)).alias("_before"))), "_p").withColumn(out, F.col("_n") + F.col("_before")).drop("_p", "_n", "_before")


def latest_of_group(df: DataFrame, by: Sequence[str], latest: Sequence[Column], keep: Column | None = None, unless: Column | None = None) -> DataFrame:
    """The last row of each group among those to keep, of groups where nothing speaks against it."""
    w = Window.partitionBy(*by)
    rows = df if unless is None else df.withColumn("_done", F.max(unless.cast("int")).over(w)).filter("_done = 0").drop("_done")
    rows = rows if keep is None else rows.filter(keep)
    return rows.withColumn("_n", F.row_number().over(w.orderBy(*latest))).filter("_n = 1").drop("_n")


def argmax_index(values: Column) -> Column:
    """Greatest value of an array and its index; the first of equals, 0 if all are 0."""
    top = F.coalesce(F.array_max(values), F.lit(0.0))
    return F.struct(top.alias("value"), F.greatest(F.array_position(values, top) - 1, F.lit(0)).cast("int").alias("index"))


def stacks(df: DataFrame, by: Sequence[str], pos: str, ref: str, distance: int, out: str = "stack") -> DataFrame:
    """Rows no further than ``distance`` behind the end of the one before form a stack."""
    far = lambda a, b: b["pos"] - (a["pos"] + a["n"]) + 1 > distance
    fields = F.struct(F.col(pos).alias("pos"), F.length(ref).alias("n"))
    return O.numbered(O.ranged(df, by, [pos, ref]), by, [pos, ref], fields, far, out).drop("_p")
