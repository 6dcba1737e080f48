"""Regions of a requested size gathered along a track, with every range of rows worked on by itself.

Where a region ends depends on where it began, so a track is one chain of begins.  Each
range of rows finds, for every row at which a chain may enter it, the row at which that
chain leaves it again.  Those jumps, a few for each range, are doubled until they span the
table, which tells the one row at which each range is really entered; then every range
writes its own regions.  A range also sees the rows behind it that can end its regions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import release, settled
from . import ordered as O


def region_accumulator(df: DataFrame, by: Sequence[str], sizes: Mapping[str, int], least: int, order: Sequence[Column], chrom: str = "chrom", start: str = "start", end: str = "end", value: str = "value", level: str = "level") -> DataFrame:
    """Consecutive rows gathered into regions of each level's size, with the mean of their values.

    One track (``by``) is read in ``order``, then by chromosome, begin, end and value, and
    regions go on over it as follows.  A row whose end gives the region exactly its size
    ends it.  A row that would make it larger, or that lies on another chromosome, ends
    the region before itself, once for each of the two reasons, and is not part of the
    next one, which begins at the row behind it; as the last of a track it is a region of
    its own.  A level of the ``least`` size has a region for each row.  What is open at
    the end of a track is written too; a last region that was written already is written
    again, up to the end it had before the row that filled it.  Nulls and NaN in the value
    count as no value, a region without any has the mean null.  A row that lacks its
    begin or end, or ends before it begins, is an error.  Extra columns are dropped and an
    empty table gives no region.  A task holds a range of rows and those behind it up to
    the greatest size, so one track may hold all rows.
    """
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    keys, ranks = [f"_k{i}" for i in range(len(by))], [f"_o{i}" for i in range(len(order))]
    right = F.coalesce(F.col(end).cast("long") >= F.col(start).cast("long"), F.lit(False))
    stop = F.when(right, F.col(end).cast("long")).otherwise(F.raise_error(F.lit("a row lacks its begin or end, or ends before it begins")).cast("long"))
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], *[o.alias(r) for o, r in zip(order, ranks)], F.col(chrom).alias("_chrom"), F.col(start).cast("long").alias("_from"), stop.alias("_till"), F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double")).alias("_value"))
    places = [*ranks, "_chrom", "_from", "_till", "_value"]
    ranged = O.ranged(rows, keys, places)
    numbered = settled(O.running(ranged, [], [*keys, *places], F.lit(1).cast("long"), "_g").drop(*ranks), "numbered")
    release(ranged)
    inside = Window.partitionBy("_p", *keys).orderBy("_g")
    edged = O.carry(numbered, keys, {"_n": F.count("*")}, lambda ends, k: (ends.withColumn("_goes_on", F.lag("_n").over(k)), ["_goes_on"]))
    edged = O.carry(edged, keys, {"_n": F.count("*")}, lambda ends, k: (ends.withColumn("_more", F.lead("_n").over(k)), ["_more"]), back=True)
    edged = edged.withColumns({"_new": F.lag("_g").over(inside).isNull() & F.col("_goes_on").isNull(), "_last": F.lead("_g").over(inside).isNull() & F.col("_more").isNull()})
    placed = settled(edged.drop("_goes_on", "_more"), "placed")
    release(numbered)
    reach = max((n for n in sizes.values() if n != least), default=0)
    home = settled(_with_rows_behind(placed, reach), "regions")
    jumps = settled(home.groupBy("_home").applyInArrow(_jumps({k: n for k, n in sizes.items() if n != least}), "level string, _home int, _g long, _to long, _open boolean"), "jumps")
    entered = _entered(jumps)
    release(placed, jumps)
    marks = entered.groupBy("_g").agg(F.collect_list("level").alias("_enters"))  # at most one row for each range and level
    marked = home.join(F.broadcast(marks), "_g", "left")
    schema = ", ".join([*[f"{k} {fields[c]}" for c, k in zip(by, keys)], f"level string, _chrom {fields[chrom]}, _from long, _till long, _value double"])
    found = marked.groupBy("_home").applyInArrow(_regions(dict(sizes), least, keys), schema)
    return found.withColumnsRenamed(dict(zip([*keys, "level", "_chrom", "_from", "_till", "_value"], [*by, level, chrom, start, end, value])))


def _with_rows_behind(placed: DataFrame, reach: int) -> DataFrame:
    """Each range's rows (``_home``, ``_own``) with copies of those behind it that may end its regions, up to the first that must."""
    spark = placed.sparkSession
    at = F.struct("_chrom", "_from", "_last")
    ends = placed.groupBy("_p").agg(F.max_by(at, "_g").alias("tail"), F.bool_or("_last").alias("closes"))
    told = ends.orderBy("_p").collect()  # one row for each range
    pairs = []
    for i, p in enumerate(told):
        if p.tail["_last"] or not reach:
            continue
        for q in told[i + 1 :]:
            pairs.append((q["_p"], p["_p"], p.tail["_chrom"], p.tail["_from"] + reach))
            if q.closes or q.tail["_chrom"] != p.tail["_chrom"] or q.tail["_from"] > p.tail["_from"] + reach:
                break
    asked = spark.createDataFrame(pairs, f"_p int, _to int, _c0 {placed.schema['_chrom'].dataType.simpleString()}, _x long")
    w = Window.partitionBy("_p").orderBy("_g")
    rows = placed.withColumns({"_before": F.lag(F.struct("_chrom", "_from")).over(w), "_track": F.coalesce(F.sum(F.col("_new").cast("long")).over(w), F.lit(0))})
    near = lambda c, s: c.eqNullSafe(F.col("_c0")) & (s <= F.col("_x"))
    copies = rows.join(F.broadcast(asked), "_p").filter((F.col("_track") == 0) & (F.col("_before").isNull() | near(F.col("_before._chrom"), F.col("_before._from"))))
    # a chain may enter at a range's first row, or behind a row that some range before sees
    widest = asked.groupBy("_p").agg(F.collect_list(F.struct("_c0", "_x")).alias("_asked"))
    seen = F.exists("_asked", lambda a: F.col("_back").isNull() | (F.col("_back._chrom").eqNullSafe(a["_c0"]) & (F.col("_back._from") <= a["_x"])))
    own = rows.withColumn("_back", F.lag("_before").over(w)).join(F.broadcast(widest), "_p", "left")
    own = own.withColumns({"_home": F.col("_p"), "_own": F.lit(True), "_entry": F.col("_before").isNull() | F.coalesce(seen, F.lit(False))})
    halo = copies.withColumns({"_home": F.col("_to"), "_own": F.lit(False), "_entry": F.lit(False)})
    kept = [c for c in placed.columns if c != "_p"] + ["_home", "_own", "_entry"]
    return own.select(*kept).unionByName(halo.select(*kept))


def _entered(jumps: DataFrame) -> DataFrame:
    """The rows at which the chains that come from the tracks' begins enter further ranges, by pointer doubling."""
    ranges = jumps.select("_home").distinct().count()
    step = first = jumps.filter("_to IS NOT NULL").select("level", "_g", "_to")
    reached = settled(jumps.filter("_open AND _to IS NOT NULL").select("level", F.col("_to").alias("_g")).distinct(), "reached")
    for _ in range(max(ranges - 1, 0).bit_length()):
        onward = reached.join(step, ["level", "_g"]).select("level", F.col("_to").alias("_g"))
        grown = settled(reached.unionByName(onward).distinct(), "reached")
        twice = step.alias("a").join(step.alias("b"), (F.col("a.level") == F.col("b.level")) & (F.col("a._to") == F.col("b._g"))).select("a.level", "a._g", "b._to")
        further = settled(twice, "jumps")
        release(reached, *([step] if step is not first else []))
        reached, step = grown, further
    if step is not first:
        release(step)
    return reached


class _Track:
    """A range's rows and those behind it, in order; finds the row that ends a region."""

    def __init__(self, table: pa.Table):
        at = lambda name: table.column(name).to_numpy(zero_copy_only=False)
        self.g, self.own, self.new, self.last = at("_g"), at("_own").astype(bool), at("_new").astype(bool), at("_last").astype(bool)
        self.s, self.e = at("_from"), at("_till")
        names = table.column("_chrom").combine_chunks().dictionary_encode()
        self.codes = codes = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        n = len(codes)
        cut = np.flatnonzero(self.new[1:] | (codes[1:] != codes[:-1])) + 1
        bounds = np.concatenate([[0], cut, [n]])
        self.stretch = np.repeat(bounds[1:], np.diff(bounds))  # where each row's stretch of one chromosome ends
        self.top = np.concatenate([np.maximum.accumulate(self.e[a:b]) for a, b in zip(bounds, bounds[1:])]) if n else self.e
        self.owned = int(self.own.sum())

    def end(self, i: int, size: int) -> int | None:
        """The first row behind ``i`` that ends its region; none if the track ends before."""
        if self.last[i]:
            return None
        stop, want = int(self.stretch[i]), self.s[i] + size - 1
        if self.top[i] < want:
            j = i + 1 + int(np.searchsorted(self.top[i + 1 : stop], want))
        else:  # a row before reaches as far, so the greatest end says nothing
            j, block = i + 1, 256
            while j < stop:
                far = np.flatnonzero(self.e[j : min(j + block, stop)] >= want)
                if len(far):
                    j += int(far[0])
                    break
                j, block = min(j + block, stop), block * 2
        if j < stop:
            return j
        return None if self.last[stop - 1] else stop


def _jumps(sizes: Mapping[str, int]):
    """For each row at which a chain may enter, and the last track's begin, the row at which it leaves the range; null where the track ends."""

    def of(table: pa.Table) -> pa.Table:
        table = table.sort_by("_g")
        home, track, out = table.column("_home")[0].as_py(), _Track(table), []
        entry = table.column("_entry").to_numpy(zero_copy_only=False).astype(bool)
        for name, size in sizes.items():
            leaves: dict[int, int | None] = {}
            for begin in np.flatnonzero(track.own & (entry | track.new)).tolist():
                path, i = [], begin
                while i is not None and i < track.owned and i not in leaves:
                    path.append(i)
                    j = track.end(i, size)
                    i = None if j is None or track.last[j] else j + 1
                to = leaves[i] if i is not None and i < track.owned else None if i is None else int(track.g[0]) + i
                leaves.update(dict.fromkeys(path, to))
                out.append((name, home, int(track.g[begin]), to, bool(track.new[begin])))
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()])], names=["level", "_home", "_g", "_to", "_open"])

    return of


def _regions(sizes: Mapping[str, int], least: int, keys: Sequence[str]):
    """The regions that begin in a range."""

    def of(table: pa.Table) -> pa.Table:
        table = table.sort_by("_g")
        track, value = _Track(table), table.column("_value").to_numpy(zero_copy_only=False).astype(float)
        there = ~np.isnan(value)
        entered: dict[str, list[int]] = {}
        for i, names in enumerate(table.column("_enters").to_pylist()):
            for name in names or ():
                entered.setdefault(name, []).append(i)
        took: list[int] = []  # the row that names the track and chromosome
        levels, starts, stops, means = [], [], [], []

        def write(name: str, i: int, stop: int, a: int, b: int, times: int = 1) -> None:
            held = value[a:b][there[a:b]]
            for _ in range(times):
                took.append(i), levels.append(name), starts.append(int(track.s[i])), stops.append(int(track.e[stop])), means.append(float(held.sum() / len(held)) if len(held) else None)

        for name, size in sizes.items():
            if size == least:
                for i in np.flatnonzero(track.own).tolist():
                    write(name, i, i, i, i + 1, 2 if track.last[i] else 1)
                continue
            for i in sorted({*np.flatnonzero(track.own & track.new).tolist(), *(x for x in entered.get(name, ()) if track.own[x])}):
                while i < track.owned:
                    j = track.end(i, size)
                    if j is None:
                        over = np.flatnonzero(track.last[i:])
                        stop = i + int(over[0])
                        write(name, i, stop, i, stop + 1)
                        break
                    length = track.e[j] - track.s[i] + 1
                    if length == size:
                        write(name, i, j, i, j + 1)
                        if track.last[j]:
                            write(name, i, j - 1, i, j + 1)
                    else:
                        write(name, i, j - 1, i, j, int(length > size) + int(track.codes[j] != track.codes[i]))
                        if track.last[j]:
                            write(name, j, j, j, j + 1)
                    if track.last[j]:
                        break
                    i = j + 1
        rows = pa.array(took, pa.int64())
        return pa.Table.from_arrays([*[table.column(k).take(rows) for k in keys], pa.array(levels, pa.string()), table.column("_chrom").take(rows), pa.array(starts, pa.int64()), pa.array(stops, pa.int64()), pa.array(means, pa.float64())], names=[*keys, "level", "_chrom", "_from", "_till", "_value"])

    return of
