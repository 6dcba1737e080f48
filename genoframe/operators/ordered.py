"""Ordered state over ranges: what depends on the rows before or behind, without a task that holds a whole key.

Rows are dealt by ranges of key and order (``ranged``), so one key may fill any number of
ranges.  Each range says what it does to a carried state (a sum, a maximum, its first and
last rows, a map of an automaton's states); these summaries, one row for each range and
key, are combined in order, and each range gets one row back for the key that goes on
into it.  Inside a range ordinary windows do the rest, over rows of that range only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settled


def ranged(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_p``, the number of each row's range; ranges follow ``by`` and ``order``, nulls first, and equal rows share one."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(df.repartitionByRange(parts, *map(F.col, [*by, *order])).withColumn("_p", F.spark_partition_id()), "ranged")


def _key(by: Sequence[str]) -> Column:
    return F.struct(*map(F.col, by)) if by else F.struct(F.lit(0).alias("all"))


def _inside(by: Sequence[str], order: Sequence[str]):
    return Window.partitionBy("_p", *by).orderBy(*order)


def carry(rows: DataFrame, by: Sequence[str], parts: Mapping[str, Column], into: Callable, back: bool = False) -> DataFrame:
    """Rows with the columns that ``into`` makes of the ranges' summaries, for the key that enters a range (``back``: that leaves it); null for others.

    ``parts`` are aggregates of a range and key; ``into`` gets their table and the window
    over a key's ranges in order, and returns the table with new columns by name.
    """
    ends = rows.groupBy("_p", *by).agg(*[c.alias(name) for name, c in parts.items()])
    made, names = into(ends, Window.partitionBy(*by).orderBy("_p"))
    at = F.max_by if back else F.min_by
    one = made.groupBy("_p").agg(at(F.struct(_key(by).alias("_key"), *names), _key(by)).alias("_c"))  # one row for each range
    joined = rows.join(F.broadcast(one), "_p")
    here = _key(by).eqNullSafe(F.col("_c._key"))
    return joined.withColumns({n: F.when(here, F.col(f"_c.{n}")) for n in names}).drop("_c")


def running(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, out: str, how: str = "sum", inclusive: bool = True) -> DataFrame:
    """The sum or the maximum (``how``) of a value up to each row, or up to the row before it; null if there is none yet."""
    total = {"sum": F.sum, "max": F.max}[how]
    rows = rows.withColumn("_v", value)
    into = lambda ends, w: (ends.withColumn("_base", total("_t").over(w.rowsBetween(Window.unboundedPreceding, -1))), ["_base"])
    carried = carry(rows, by, {"_t": total("_v")}, into)
    here = total("_v").over(_inside(by, order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    both = F.coalesce(here + F.col("_base"), here, F.col("_base")) if how == "sum" else F.greatest(here, F.col("_base"))
    return carried.withColumn(out, both).drop("_v", "_base")


def neighbours(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, before: int, after: int, out: str) -> DataFrame:
    """An array of the values from ``before`` rows back to ``after`` rows ahead, each as ``struct<v>``, null beyond the key's ends."""
    w = _inside(by, order)
    rows = rows.withColumns({"_v": F.struct(value.alias("v")), "_up": F.row_number().over(w)})
    rows = rows.withColumn("_down", F.count("*").over(Window.partitionBy("_p", *by)) - F.col("_up") + 1)
    listed = lambda near, at: F.transform(F.array_sort(F.collect_list(F.when(near, F.struct(at.alias("i"), F.col("_v").alias("x"))))), lambda s: s.x)
    heads, tails = listed(F.col("_up") <= after, F.col("_up")), listed(F.col("_down") <= before, -F.col("_down"))
    none = F.array().cast("array<struct<v:" + rows.schema["_v"].dataType["v"].dataType.simpleString() + ">>")
    if before:
        into = lambda ends, k: (ends.withColumn("_prev", F.flatten(F.collect_list("_tails").over(k.rowsBetween(-before, -1)))), ["_prev"])
        rows = carry(rows, by, {"_tails": tails}, into)
    if after:
        into = lambda ends, k: (ends.withColumn("_next", F.flatten(F.collect_list("_heads").over(k.rowsBetween(1, after)))), ["_next"])
        rows = carry(rows, by, {"_heads": heads}, into, back=True)
    lag = lambda j: F.when(F.col("_up") > j, F.lag("_v", j).over(w)).otherwise(F.try_element_at(F.coalesce("_prev", none), (F.col("_up") - j - 1).cast("int")))
    lead = lambda j: F.when(F.col("_down") > j, F.lead("_v", j).over(w)).otherwise(F.try_element_at(F.coalesce("_next", none), (j - F.col("_down") + 1).cast("int")))
    near = F.array(*[lag(j) for j in range(before, 0, -1)], F.col("_v"), *[lead(j) for j in range(1, after + 1)])
    return rows.withColumn(out, near).drop("_v", "_up", "_down", "_prev", "_next")


def numbered(rows: DataFrame, by: Sequence[str], order: Sequence[str], fields: Column, breaks: Callable[[Column, Column], Column], out: str) -> DataFrame:
    """Numbers the runs of a key from 0: a row begins a new one where ``breaks(fields of the row before, its own)`` is true."""
    w, place = _inside(by, order), F.struct(*map(F.col, order), "_up")
    rows = rows.withColumns({"_f": F.struct(fields.alias("f")), "_up": F.row_number().over(w)})
    rows = rows.withColumn("_before", F.lag("_f").over(w))
    cut = lambda a, b: (a.isNotNull() & F.coalesce(breaks(a["f"], b["f"]), F.lit(False))).cast("long")
    rows = rows.withColumn("_new", cut(F.col("_before"), F.col("_f"))).drop("_before")

    def into(ends: DataFrame, k) -> tuple[DataFrame, list[str]]:
        ends = ends.withColumn("_edge", cut(F.lag("_lastf").over(k), F.col("_firstf")))
        own = F.sum("_edge").over(k.rowsBetween(Window.unboundedPreceding, 0))
        return ends.withColumn("_base", own + F.coalesce(F.sum("_news").over(k.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), ["_base"]

    carried = carry(rows, by, {"_firstf": F.min_by("_f", place), "_lastf": F.max_by("_f", place), "_news": F.sum("_new")}, into)
    total = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("_base", F.lit(0))
    return carried.withColumn(out, total).drop("_f", "_up", "_new", "_base")


def walk(rows: DataFrame, by: Sequence[str], order: Sequence[str], symbol: str, moves: Sequence[Sequence[int]], state: str) -> DataFrame:
    """The state in which a finite automaton meets each row; it begins every key in state 0 and goes on to ``moves[state][symbol]``.

    What a range does to the automaton is a map of states to states, which the range's
    rows compose and the ranges again; the first row of a key maps all states to what
    follows state 0.  A null symbol is an error.
    """
    table, names = np.asarray(moves, np.int64), rows.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    first = F.row_number().over(_inside(by, order)) == 1
    opened = carry(rows.withColumn("_own", first), by, {"_n": F.count("*")}, lambda ends, k: (ends.withColumn("_goes_on", F.lag("_n").over(k).isNotNull()), ["_goes_on"]))
    marked = opened.withColumn("_own", F.col("_own") & ~F.coalesce("_goes_on", F.lit(False))).drop("_goes_on")

    def maps(batch: pa.RecordBatch, came: np.ndarray | None) -> np.ndarray:
        """For each row the map from the states before the range to those behind the row."""
        number = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
        here = table[:, number(symbol).astype(np.int64)].T.copy()
        own = number("_own").astype(bool)
        here[own] = here[own][:, :1]
        if came is not None and len(here):
            here[0] = here[0][came]
        step = 1
        while step < len(here):
            here[step:] = np.take_along_axis(here[step:], here[:-step], axis=1)
            step *= 2
        return here

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
        """Batches of one range each, in order, with its number and whether it is the range's first."""
        last = None
        for batch in batches:
            p = batch.column(batch.schema.get_field_index("_p")).to_numpy()
            for part in np.split(np.arange(len(p)), np.flatnonzero(np.diff(p)) + 1):
                if len(part):
                    yield int(p[part[0]]), p[part[0]] != last, batch.slice(int(part[0]), len(part))
                    last = p[part[0]]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[int, np.ndarray] = {}
        for p, _, batch in by_range(batches):
            ends[p] = maps(batch, ends.get(p))[-1]
        yield pa.RecordBatch.from_arrays([pa.array(list(ends), pa.int32()), pa.array([e.tolist() for e in ends.values()], pa.list_(pa.int64()))], names=["_p", "_map"])

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for _, fresh, batch in by_range(batches):
            if fresh:
                now = batch.column(batch.schema.get_field_index("_enters"))[0].as_py()
            after = maps(batch, None)[:, now]
            own = batch.column(batch.schema.get_field_index("_own")).to_numpy(zero_copy_only=False).astype(bool)
            met = np.where(own, 0, np.concatenate([[now], after[:-1]]))
            now = int(after[-1])
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(name)) for name in names], pa.array(met, pa.int32())], names=[*names, state])

    dealt = marked.repartition("_p").sortWithinPartitions("_p", *by, *order)
    ends = settled(dealt.mapInArrow(summed, "_p int, _map array<long>"), "maps").orderBy("_p").collect()  # one row for each range
    enters, now = [], 0
    for p, move in ends:
        enters.append((p, now))
        now = move[now]
    begin = rows.sparkSession.createDataFrame(enters, "_p int, _enters int")
    again = marked.join(F.broadcast(begin), "_p").repartition("_p").sortWithinPartitions("_p", *by, *order)
    return again.mapInArrow(applied, f"{fields}, `{state}` int")
