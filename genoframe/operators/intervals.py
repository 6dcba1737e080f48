"""Interval joins without nested loops.

An interval lies in bins of the level that fits it: level k has bins of ``width * FAN**k``,
and an interval goes to the lowest level at which it touches two bins at most.  Pairs are
looked for level by level: for each pair of levels, the shorter interval names its bins
at the longer one's level, so an interval of any length gives a few rows and no more.
The levels that occur are counted first; there are about as many as the logarithm of the
longest interval.  A pair that shares several bins is kept in its first shared one only,
so no duplicate removal follows.  Bins that hold many intervals are split by salting.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import release, settled
from . import ordered as O


#: Each level's bins are so many times as wide as those of the level before.
FAN = 8
#: Intervals of one bin on the right side that are joined in one task, about; fuller bins are split.
FULL_BIN = 20_000
#: Bands of score in which spans are matched at most, and pairs that are compared in one, about: for each span and for all.
BANDS, BAND_PAIRS, LEAST_PAIRS = 9, 64, 1_000_000
#: Left intervals of one square of like ones that are joined in one task, about.
FULL_SQUARE = 1024
#: Rows of one interval that stand in one list while intervals are compared, about.
LISTED = 256


def _shuffled(df: DataFrame) -> DataFrame:
    """Never broadcast: the files of a settled table, by which Spark would choose, are far smaller than its rows in the driver's memory, still more once they are exploded."""
    return df.hint("merge")


def _levelled(df: DataFrame, start: Column, last: Column, width: float) -> DataFrame:
    """``_level`` of each interval (0 for the shortest): the lowest one whose bins are as wide as the interval."""
    wide = F.greatest((last - start).cast("double") / width, F.lit(1.0))
    return df.withColumn("_level", F.ceil(F.round(F.log(float(FAN), wide), 9)).cast("int"))


def _bins(level: Column, start: Column, last: Column, width: float) -> tuple[Column, Column]:
    """First and last bin of an interval at a level."""
    size = F.pow(F.lit(float(FAN)), level) * width
    first = F.floor(start / size)
    return first, F.greatest(first, F.floor(last / size))


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[str], l: tuple[str, str], r: tuple[str, str], width: float, inclusive: bool = False, how: str = "inner", slack: float = 0) -> DataFrame:
    """Pairs of intervals that overlap, half open (strict) or inclusive.

    ``on`` are columns of both sides; other column names must differ.  ``slack`` widens
    the left side before the comparison.  ``how`` may be inner or left_semi.  ``width`` is
    the width of the finest bins; any value gives the same pairs.  An interval with a
    null end meets nothing.
    """
    (ls, le), (rs, re) = l, r
    semi = how == "left_semi"
    if semi:  # equal rows once, with their number
        left_columns = left.columns
        left = left.groupBy(*left_columns).agg(F.count("*").alias("_n"))
    a = left.withColumn("_ls", F.col(ls) - slack).withColumn("_le", F.col(le) + slack)
    a = _levelled(a, F.col("_ls"), F.col("_le"), width).withColumnRenamed("_level", "_la").filter("_la IS NOT NULL")
    b = _levelled(right if not semi else right.select(*on, rs, re), F.col(rs), F.col(re), width).withColumnRenamed("_level", "_lb").filter("_lb IS NOT NULL")
    levels = lambda df, c: F.array_sort(F.collect_set(c))
    at_a, at_b = a.agg(levels(a, "_la")).first()[0], b.agg(levels(b, "_lb")).first()[0]  # a few numbers
    met = F.array(*[F.lit(x) for x in sorted({*at_a, *at_b})]).cast("array<int>")

    def spread(df: DataFrame, own: str, others: list[int], start: str, last: str, name: str) -> DataFrame:
        """A row for each level to look at (the own one and those above it where the other side has intervals) and each of its bins there."""
        above = F.array(*map(F.lit, others)).cast("array<int>")
        df = df.withColumn("_level", F.explode(F.array_distinct(F.filter(met, lambda x: (x == F.col(own)) | ((x > F.col(own)) & F.array_contains(above, x))))))
        first, end = _bins(F.col("_level"), F.col(start), F.col(last), width)
        return df.withColumn(f"_{name}_first", first).withColumn("_bin", F.explode(F.sequence(first, end)))

    keys = [*on, "_level", "_bin"]
    x, y = spread(a, "_la", at_b, "_ls", "_le", "l"), spread(b, "_lb", at_a, rs, re, "r")
    meets = (F.col("_le") >= F.col(rs)) & (F.col("_ls") <= F.col(re)) if inclusive else (F.col("_le") > F.col(rs)) & (F.col("_ls") < F.col(re))
    full = y.groupBy(*keys).count().filter(F.col("count") > FULL_BIN).select(*keys, F.ceil(F.col("count") / FULL_BIN).cast("int").alias("_parts"))
    # a full bin's right rows are dealt over its parts, and its left rows go to each of them
    y = y.join(full, keys, "left").withColumn("_salt", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(rs, re, *[c for c in right.columns if c in y.columns and c not in on][:4]), F.col("_parts")).cast("int"))).drop("_parts")
    x = x.join(full, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    pairs = x.join(y, [*keys, "_salt"]).filter(meets & (F.col("_level") == F.greatest("_la", "_lb")) & (F.col("_bin") == F.greatest("_l_first", "_r_first")))
    helpers = ["_salt", "_level", "_bin", "_ls", "_le", "_la", "_lb", "_l_first", "_r_first"]
    if semi:
        found = pairs.select(*left_columns, "_n").distinct()
        return found.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int")))).drop("_n")
    return pairs.drop(*helpers)


def best_overlap(left: DataFrame, right: DataFrame, on: Sequence[str], l: tuple[str, str], r: tuple[str, str], keys: Sequence[str], width: float, order: Sequence[str] = ()) -> DataFrame:
    """Each left row with the right row of the largest overlap, the first by start (and ``order``) on ties, or nulls.

    ``keys`` identify a left row; the shared length is added as ``overlap``.
    """
    (ls, le), (rs, re) = l, r
    shared = F.least(le, re) - F.greatest(ls, rs)
    pairs = overlap_join(left.select(*dict.fromkeys([*keys, *on, ls, le])), right, on, l, r, width).withColumn("overlap", shared)
    best = Window.partitionBy(*keys).orderBy(F.col("overlap").desc(), rs, *order)
    chosen = pairs.withColumn("_n", F.row_number().over(best)).filter("_n = 1")
    taken = [c for c in right.columns if c not in on]
    return left.join(chosen.select(*keys, *taken, "overlap"), list(keys), "left")


def overlap_counts(segments: DataFrame, rows: DataFrame, on: Sequence[str], s: tuple[str, str], r: tuple[str, str], keys: Sequence[str], label: str, least: int, width: float, unwanted: Sequence[str] = ("", "backbone")) -> DataFrame:
    """Per segment the number of distinct overlapping intervals and the sorted labels with at least ``least`` rows."""
    pairs = overlap_join(segments.select(*dict.fromkeys([*keys, *on, *s])), rows, on, s, r, width)
    n = pairs.groupBy(*keys).agg(F.count_distinct(F.struct(*r)).alias("n_targets"))
    wanted = pairs.filter(F.col(label).isNotNull() & ~F.col(label).isin(*unwanted)).groupBy(*keys, label).count().filter(F.col("count") >= least)
    labels = wanted.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(label)), ",").alias("labels"))
    joined = segments.join(n, list(keys), "left").join(labels, list(keys), "left")
    return joined.withColumns({"n_targets": F.coalesce("n_targets", F.lit(0).cast("long")), "labels": F.coalesce("labels", F.lit(""))})


def band_range(segments: DataFrame, bands: DataFrame, on: Sequence[str], s: tuple[str, str], b: tuple[str, str], keys: Sequence[str], name: str, width: float) -> DataFrame:
    """First and last band that a segment touches, ends included: ``first_band``, ``last_band``."""
    pairs = overlap_join(segments.select(*dict.fromkeys([*keys, *on, *s])), bands, on, s, b, width, inclusive=True)
    found = pairs.groupBy(*keys).agg(F.min_by(name, F.struct(b[0], name)).alias("first_band"), F.max_by(name, F.struct(b[0], name)).alias("last_band"))
    return segments.join(found, list(keys), "left")


def asof_backward(left: DataFrame, right: DataFrame, on: Sequence[str], at: str, r_at: str, value: str, out: str, clamp: bool = True) -> DataFrame:
    """The value at the greatest right position up to each left one; below the first position the first value if ``clamp``.

    Both sides together are dealt by ranges of key and position, so that one key for all
    rows is spread over all tasks, too.  What a range's first key had last in the ranges
    before comes from a table of one row for each range.  Of equal right positions the
    greatest value is taken; a null key equals a null, a null position finds nothing
    below it.
    """
    keys = [f"_k{i}" for i in range(max(1, len(on)))]
    named = [F.col(c).alias(k) for c, k in zip(on, keys)] or [F.lit(0).alias(keys[0])]
    r = right.groupBy(*on, r_at).agg(F.max(value).alias("_v")).select(*named, F.col(r_at).alias("_at"), "_v", F.lit(0).alias("_side"))
    l = left.select(*named, F.col(at).alias("_at"), F.struct(*left.columns).alias("_row"), F.lit(1).alias("_side"))
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = settled(r.unionByName(l, allowMissingColumns=True).repartitionByRange(parts, *keys, "_at", "_side").withColumn("_p", F.spark_partition_id()), "asof")
    key = F.struct(*keys)
    ends = both.groupBy("_p", *keys).agg(F.max(F.when(F.col("_v").isNotNull(), F.struct("_at", "_v")))["_v"].alias("_last"))
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.withColumn("_before", before).groupBy("_p").agg(F.min(F.struct(key.alias("_key"), "_before")).alias("_x")).select("_p", F.col("_x._key").alias("_key"), F.col("_x._before").alias("_before"))  # one row for each range
    upto = Window.partitionBy("_p", *keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_found", F.last("_v", ignorenulls=True).over(upto)).filter("_side = 1")
    found = inside.join(F.broadcast(carried), "_p").withColumn("_found", F.coalesce("_found", F.when(key.eqNullSafe(F.col("_key")), F.col("_before"))))
    if not clamp:
        return found.select("_row.*", F.col("_found").alias(out))
    first = both.filter("_side = 0 and _v is not null").groupBy(*keys).agg(F.min(F.struct("_at", "_v"))["_v"].alias("_first")).withColumnsRenamed({k: f"_f{k}" for k in keys})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_f{k}")) for k in keys])
    return found.join(first, same, "left").select("_row.*", F.coalesce("_found", "_first").alias(out))


def _near(a: tuple[str, str], b: tuple[str, str], ratio: float, distance: float | None) -> Column:
    shared = F.least(a[1], b[1]) - F.greatest(a[0], b[0])
    longest = F.greatest(F.col(a[1]) - F.col(a[0]), F.col(b[1]) - F.col(b[0]))
    like = (shared > 0) & (shared >= ratio * longest)
    if distance is None:
        return like
    return like | ((F.abs(F.col(a[0]) - F.col(b[0])) <= distance) & (F.abs(F.col(a[1]) - F.col(b[1])) <= distance))


def _alike(left: DataFrame, right: DataFrame, on: Sequence[str], l: tuple[str, str], r: tuple[str, str], ratio: float, distance: float | None, deal: bool = False) -> DataFrame:
    """Pairs of ``_near`` intervals by squares of start and end that are as wide as like intervals may lie apart.

    Of intervals whose common part is ``ratio`` of the longer one, starts and ends differ
    by the rest of that one at most.  The left interval lies in one square of the size
    that belongs to its length (a power of two), the right one looks into the nine squares
    around it, for each length it may be like.  What only ``distance`` finds comes from
    squares of that width.  Both parts have no pair in common.  ``deal`` spreads a square
    with more than ``FULL_SQUARE`` left intervals over several tasks.
    """
    if not 0 < ratio <= 1:
        raise ValueError("ratio must be above 0, and 1 at most")
    length = lambda x: (F.col(x[1]) - F.col(x[0])).cast("double")
    square = lambda c, w, by=0: F.floor(F.col(c) / w) + by
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("x"), F.lit(j).alias("y")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))

    def squares(x: DataFrame, y: DataFrame, width: Column, keys: Sequence[str]) -> DataFrame:
        x = x.withColumns({"_x": square(l[0], width), "_y": square(l[1], width)})
        y = y.withColumn("_by", around).withColumns({"_x": square(r[0], width, F.col("_by.x")), "_y": square(r[1], width, F.col("_by.y"))}).drop("_by")
        at = [*on, *keys, "_x", "_y"]
        if not deal:
            return x.join(_shuffled(y), at).drop(*keys, "_x", "_y")
        full = x.groupBy(*at).count().filter(F.col("count") > FULL_SQUARE).select(*at, F.ceil(F.col("count") / FULL_SQUARE).cast("int").alias("_deal"))
        x = x.join(_shuffled(full), at, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*l), F.col("_deal")).cast("int"), F.lit(0))).drop("_deal")
        y = y.join(_shuffled(full), at, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_deal", F.lit(1)) - 1))).drop("_deal")
        return x.join(_shuffled(y), [*at, "_salt"]).drop(*keys, "_x", "_y", "_salt")

    size = lambda n: F.floor(F.log2(n))
    x = left.filter(length(l) > 0).withColumn("_size", size(length(l)))
    y = right.filter(length(r) > 0).withColumn("_size", F.explode(F.sequence(size(length(r) * (ratio * (1 - 1e-9))), size(length(r) / (ratio * (1 - 1e-9))))))
    like = _near(l, r, ratio, None)
    found = squares(x, y, F.pow(F.lit(2.0), F.col("_size") + 1) * ((1 - ratio) / ratio * 1.001 + 1e-9), ["_size"]).filter(like)
    if distance is None:
        return found
    whole = lambda df, n: df.filter(F.col(n[0]).isNotNull() & F.col(n[1]).isNotNull())
    close = squares(whole(left, l), whole(right, r), F.lit(distance * 1.001 if distance > 0 else 1.0), []).filter(_near(l, r, ratio, distance) & ~like)
    return found.unionByName(close)


def fuzzy_join(left: DataFrame, right: DataFrame, on: Sequence[str], l: tuple[str, str], r: tuple[str, str], ratio: float = 0.8, distance: float | None = None, width: float = 10_000) -> DataFrame:
    """Pairs with a reciprocal overlap of at least ``ratio`` (above 0), or both ends within ``distance``.

    Intervals are compared, not rows: those that share one come in lists of about
    ``LISTED`` rows, which are unfolded where a pair is found, so pairs are never
    shuffled.  ``width`` has no effect: the intervals' lengths choose the bins.
    """

    def listed(df: DataFrame, span: tuple[str, str], name: str) -> DataFrame:
        row = F.struct(*[c for c in df.columns if c not in (*on, *span)], F.lit(0).alias("_0"))
        many = df.groupBy(*on, *span).agg(F.ceil(F.count("*") / LISTED).alias("_parts"))
        parts = df.select(*on, *span, row.alias("_row")).join(_shuffled(many), [*on, *span]).withColumn("_part", F.pmod(F.xxhash64("_row"), "_parts"))
        return parts.groupBy(*on, *span, "_part").agg(F.collect_list("_row").alias(name)).drop("_part")

    pairs = _alike(listed(left, l, "_rows_l"), listed(right, r, "_rows_r"), on, l, r, ratio, distance, deal=True)
    out = pairs.withColumn("_l", F.explode("_rows_l")).withColumn("_r", F.explode("_rows_r"))
    own = lambda df, span, n: [F.col(f"_{n}.{c}") for c in df.columns if c not in (*on, *span)]
    return out.select(*on, *l, *r, *own(left, l, "l"), *own(right, r, "r"))


def frequency_annotation(df: DataFrame, database: DataFrame, on: Sequence[str], l: tuple[str, str], r: tuple[str, str], keys: Sequence[str], fields: dict[str, str], **how) -> DataFrame:
    """The most frequent match of each row; ``fields`` maps new columns to those of the database."""
    pairs = fuzzy_join(df.select(*dict.fromkeys([*keys, *on, *l])), database, on, l, r, **how)
    best = pairs.groupBy(*keys).agg(*[F.max(c).alias(new) for new, c in fields.items()])
    return df.join(best, list(keys), "left")


def components(edges: DataFrame, a: str, b: str, settle) -> DataFrame:
    """Least vertex that each end of an edge can reach, as ``v`` and ``c``; ``settle`` writes a step's labels reliably."""
    once = settle(edges.select(F.col(a).alias("v"), F.col(b).alias("w")))  # what gives the edges is computed once
    both = settle(once.union(once.select("w", "v")).distinct())
    labels, last = settle(both.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("c"))), None
    while True:
        near = both.join(_shuffled(labels.select(F.col("v").alias("w"), "c")), "w").groupBy("v").agg(F.min("c").alias("m"))
        lower = labels.join(_shuffled(near), "v").select("v", F.least("c", "m").alias("d"), (F.col("m") < F.col("c")).alias("moved"))
        jump = labels.select(F.col("v").alias("d"), F.col("c").alias("e"))
        after = settle(lower.join(_shuffled(jump), "d", "left").select("v", F.least("d", F.coalesce("e", "d")).alias("c"), "moved"))
        if last is not None:
            release(last)
        labels, last = after.select("v", "c"), after
        if not after.filter("moved").take(1):
            release(once, both)
            return labels


def like_components(df: DataFrame, on: Sequence[str], span: tuple[str, str], key: str, settle, ratio: float = 0.8, distance: float | None = None) -> DataFrame:
    """Each ``key`` with ``c``, the least key that a chain of like intervals (``fuzzy_join``) connects it with, itself if none.

    Intervals lie in squares of start and end so small that all of a square are alike;
    such a square is one vertex, named by its least key, and of all links between two
    squares one is kept.  So copies and crowded places add no edges.  A repeated key is
    one vertex, too; null keys are left out.
    """
    s, e = span
    length = (F.col(e) - F.col(s)).cast("double")
    size = F.floor(F.log2(F.when(length > 0, length)))
    by_ratio, by_distance = F.coalesce(F.pow(F.lit(2.0), size) * (0.49 * (1 - ratio)), F.lit(0.0)), F.lit(0.999 * (distance or 0))
    width = F.greatest(by_ratio, by_distance)
    square = lambda c: F.when(width > 0, F.floor(F.col(c) / width).cast("double")).otherwise(F.col(c).cast("double"))
    meets = F.col(s).isNotNull() & F.col(e).isNotNull() & reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in on], F.lit(True))
    if distance is None:
        meets &= length > 0
    rows = df.filter(F.col(key).isNotNull()).select(*on, s, e, F.col(key).alias("_key"), F.coalesce(meets, F.lit(False)).alias("_meets"))
    place = ["_size", "_x", "_y"]
    rows = settle(rows.withColumns({"_size": F.when(by_ratio >= by_distance, F.coalesce(size, F.lit(-5001))).otherwise(-5000), "_x": square(s), "_y": square(e)}))
    inside = rows.filter("_meets")
    heads = inside.groupBy(*on, *place).agg(F.min("_key").alias("_head"))
    named = settle(inside.join(_shuffled(heads), [*on, *place]).unionByName(rows.filter("not _meets").withColumn("_head", F.col("_key"))).drop(*place))
    points = settle(named.filter("_meets").select(*on, s, e, "_head").distinct())
    side = lambda n: points.select(*on, F.col(s).alias(f"_s{n}"), F.col(e).alias(f"_e{n}"), F.col("_head").alias(f"_h{n}"))
    links = _alike(side(1), side(2), on, ("_s1", "_e1"), ("_s2", "_e2"), ratio, distance).filter("_h1 < _h2").select("_h1", "_h2")
    again = named.groupBy("_key").agg(F.collect_set("_head").alias("_h")).filter(F.size("_h") > 1).select(F.array_min("_h").alias("_h1"), F.explode("_h").alias("_h2"))
    labels = components(links.unionByName(again).distinct(), "_h1", "_h2", settle).toDF("_v", "_c")
    out = named.select(F.col("_key").alias(key), "_head").distinct()
    return out.join(_shuffled(labels), F.col("_head") == F.col("_v"), "left").groupBy(key).agg(F.min(F.coalesce("_c", "_head")).alias("c"))


def _numbered(rows: DataFrame, on: Sequence[str], span: Sequence[str], key: str, name: str, settle) -> tuple[DataFrame, DataFrame]:
    """The different spans with a number ``name`` and how many keys they have (``_n`` and it), and each span's keys, numbered from 1 in order."""
    spans = settle(rows.select(*on, *span).distinct().withColumn(name, F.monotonically_increasing_id()))
    same = reduce(lambda x, y: x & y, [rows[c].eqNullSafe(spans[c]) for c in [*on, *span]])
    keys = rows.join(_shuffled(spans), same).select(name, F.col(key).alias("_key")).distinct()
    keys = settle(O.running(O.ranged(keys, [name], ["_key"]), [name], ["_key"], F.lit(1).cast("long"), "_i").select(name, "_key", "_i"))
    return spans.join(_shuffled(keys.groupBy(name).agg(F.count("*").alias(f"_n{name}"))), name), keys


def _crowd(x: DataFrame, y: DataFrame, on: Sequence[str], ratio: float, distance: float | None) -> list[float]:
    """About how many pairs ``_alike`` compares: for the whole of it, then for each narrower ratio of ``_narrowed``, by how many intervals lie in the same square."""
    length = (F.col("_e") - F.col("_s")).cast("double")
    size = F.floor(F.log2(F.when(length > 0, length)))
    widths = [F.pow(F.lit(2.0), size + 1) * ((1 - r) / r + 1e-9) for r in map(lambda k: _narrowed(ratio, k), range(BANDS))]
    widths += [] if distance is None else [F.lit(float(distance) or 1.0)]
    square = lambda w: F.xxhash64(*on, size, F.floor(F.col("_s") / w), F.floor(F.col("_e") / w))
    squares = F.explode(F.array(*[F.when(w.isNotNull(), F.struct(F.lit(i).alias("i"), square(w).alias("at"))) for i, w in enumerate(widths)]))
    ends = lambda df, n, a, b: df.select(*on, F.col(f"_s{n}").alias("_s"), F.col(f"_e{n}").alias("_e"), F.lit(a).alias("_x"), F.lit(b).alias("_y"))
    places = ends(x, 1, 1, 0).unionByName(ends(y, 2, 0, 1)).select(squares.alias("q"), "_x", "_y").groupBy("q.i", "q.at").agg(F.sum("_x").alias("_x"), F.sum("_y").alias("_y"))
    found = {r[0]: r[1] for r in places.groupBy("i").agg(F.sum(F.col("_x").cast("double") * F.col("_y")) * 9).collect()}  # a few numbers
    pairs = [found.get(i, 0.0) for i in range(len(widths))]
    return [pairs[0] + sum(pairs[BANDS:]), *pairs[1:BANDS]]


def _narrowed(ratio: float, k: int) -> float:
    return 1 - (1 - ratio) / 4**k


def matched(left: DataFrame, right: DataFrame, on: Sequence[str], span: tuple[str, str], key: str, settle, ratio: float, distance: float | None) -> DataFrame:
    """One-to-one pairs ``_k1``, ``_k2`` of like rows, as if the best pair were taken again and again: by score, then by the left and the right key.

    The score is the common part's share of the longer interval.  Pairs come in bands of
    falling score, so wide that about ``BAND_PAIRS`` for each span are compared: no pair
    of a lower band can be taken before those of a higher one, whose spans are used up by
    then, so the table of pairs grows with the spans and not with their square.

    Rows that share a span have the same scores, so spans are matched, and a span gives
    its keys in order.  In a round, two spans that are each other's only best pair
    off as many keys as both have left; a span that is the only best of several spans of
    equal score pairs off with their keys in common order; of spans with equal scores on
    both sides those keys are paired that are each other's best.  The best of all is
    always among these, so the rounds end.  A key names one row.
    """
    s, e = span
    x, kx = _numbered(left, on, span, key, "_a", settle)
    y, ky = _numbered(right, on, span, key, "_b", settle)
    zero = F.lit(0).cast("long")
    side = lambda df, n, c: settle(df.filter(F.col(s).isNotNull() & F.col(e).isNotNull()).select(*on, F.col(s).alias(f"_s{n}"), F.col(e).alias(f"_e{n}"), f"_{c}", F.col(f"_n_{c}").alias(f"_n{c}"), zero.alias(f"_o{c}")))
    x, y = side(x, 1, "a"), side(y, 2, "b")
    shared = F.least("_e1", "_e2") - F.greatest("_s1", "_s2")
    longest = F.greatest(F.col("_e1") - F.col("_s1"), F.col("_e2") - F.col("_s2"))
    score = F.coalesce(F.try_divide(shared, longest), F.lit(0.0))
    ends = ("_s1", "_e1"), ("_s2", "_e2")
    taken, band = [], BANDS
    while band:
        nx, ny = x.count(), y.count()
        most = BAND_PAIRS * (nx + ny) + LEAST_PAIRS
        crowd = [0.0] if nx * ny <= most else _crowd(x, y, on, ratio, distance)
        band = min([band - 1, *[k for k, n in enumerate(crowd) if n <= most]])
        if band:
            least = _narrowed(ratio, band)
            pairs = _alike(x, y, on, *ends, least * (1 - 1e-9), None).withColumn("_score", score).filter(F.col("_score") >= least)
        else:
            pairs = _alike(x, y, on, *ends, ratio, distance).withColumn("_score", score)
        now = _rounds(settle(pairs.select("_a", "_b", "_score", "_na", "_nb", "_oa", "_ob")), kx, ky, settle)
        taken += now
        if band and now:
            left_over = lambda df, c: settle(_less(df, reduce(DataFrame.unionByName, now), c).filter(f"_n{c} > 0"))
            before, x, y = (x, y), left_over(x, "a"), left_over(y, "b")
            release(*before)
    release(x, y)
    if not taken:
        return kx.select(F.col("_key").alias("_k1"), F.col("_key").alias("_k2")).limit(0)
    each = reduce(DataFrame.unionByName, taken).withColumn("_t", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m"))))
    each = each.select("_a", "_b", (F.col("_oa") + F.col("_t")).alias("_i"), (F.col("_ob") + F.col("_t")).alias("_j"))
    return each.join(_shuffled(kx.withColumnRenamed("_key", "_k1")), ["_a", "_i"]).join(_shuffled(ky.select("_b", F.col("_i").alias("_j"), F.col("_key").alias("_k2"))), ["_b", "_j"]).select("_k1", "_k2")


def _less(df: DataFrame, taken: DataFrame, c: str) -> DataFrame:
    """``df`` with as many keys less, and as many passed, as ``taken`` has of each span ``c``."""
    used = taken.groupBy(f"_{c}").agg(F.sum("_m").alias("_used"))
    after = df.join(_shuffled(used), f"_{c}", "left").fillna(0, ["_used"])
    return after.withColumns({f"_n{c}": F.col(f"_n{c}") - F.col("_used"), f"_o{c}": F.col(f"_o{c}") + F.col("_used")}).select(*df.columns)


def _rounds(live: DataFrame, kx: DataFrame, ky: DataFrame, settle) -> list[DataFrame]:
    """The rounds of ``matched`` over a settled table of scored pairs of spans."""
    taken = []
    record = ["_a", "_oa", "_b", "_ob", "_m"]
    while True:
        wa, wb = Window.partitionBy("_a"), Window.partitionBy("_b")
        rated = live.withColumns({"_sa": F.max("_score").over(wa), "_sb": F.max("_score").over(wb)})
        rated = rated.withColumns({"_ta": F.sum((F.col("_score") == F.col("_sa")).cast("int")).over(wa), "_tb": F.sum((F.col("_score") == F.col("_sb")).cast("int")).over(wb)})
        mutual = (F.col("_score") == F.col("_sa")) & (F.col("_score") == F.col("_sb"))
        only = lambda t, w: F.sum((mutual & (F.col(t) == 1)).cast("int")).over(w)
        best = settle(rated.withColumns({"_xa": only("_tb", wa), "_xb": only("_ta", wb)}).filter("_score = _sa or _score = _sb"))
        kind = F.when(~mutual, "wait").when((F.col("_ta") == 1) & (F.col("_tb") == 1), "one").when(F.col("_xa") == F.col("_ta"), "a").when(F.col("_xb") == F.col("_tb"), "b").otherwise("tied")
        top = best.withColumn("_kind", kind)
        kinds = {r[0] for r in top.select("_kind").distinct().collect()}  # five at most
        if not kinds:
            release(live, best)
            return taken
        parts = [top.filter("_kind = 'one'").withColumn("_m", F.least("_na", "_nb")).select(*record)]
        for c, d, kc, kd in (("a", "b", kx, ky), ("b", "a", ky, kx)):
            if c in kinds:  # the middle span's keys against those of all its spans, in order
                keys = kd.join(_shuffled(top.filter(F.col("_kind") == c)), f"_{d}").filter(F.col("_i") > F.col(f"_o{d}"))
                nth = keys.withColumn("_r", F.row_number().over(Window.partitionBy(f"_{c}").orderBy("_key"))).filter(F.col("_r") <= F.col(f"_n{c}"))
                at = {f"_o{c}": F.col(f"_o{c}") + F.col("_r") - 1, f"_o{d}": F.col("_i") - 1, "_m": F.lit(1).cast("long")}
                parts.append(nth.withColumns(at).select(*record))
        if "tied" in kinds:
            first = lambda k, c: k.select(f"_{c}", (F.col("_i") - 1).alias(f"_o{c}"), F.col("_key").alias(f"_k{c}"))
            named = top.filter("_kind in ('tied', 'wait')").join(_shuffled(first(kx, "a")), ["_a", "_oa"]).join(_shuffled(first(ky, "b")), ["_b", "_ob"])
            named = named.withColumns({"_fa": F.min(F.when(F.col("_score") == F.col("_sa"), F.col("_kb"))).over(wa), "_fb": F.min(F.when(F.col("_score") == F.col("_sb"), F.col("_ka"))).over(wb)})
            parts.append(named.filter("_kind = 'tied' and _kb = _fa and _ka = _fb").withColumn("_m", F.lit(1).cast("long")).select(*record))
        now = settle(reduce(DataFrame.unionByName, parts))
        taken.append(now)
        before, live = live, settle(_less(_less(live, now, "a"), now, "b").filter("_na > 0 and _nb > 0"))
        release(before, best)


def merge_callers(calls: DataFrame, on: Sequence[str], span: tuple[str, str], key: str, caller: str, priority: Sequence[str], settle, ratio: float = 0.8, distance: float | None = None, width: float = 10_000, intra: bool = False) -> DataFrame:
    """Clusters of like intervals, each with its representative by the callers' order.

    Without ``intra`` two calls of one caller never share a cluster: callers come in
    order of ``priority``, then by name, and each one's calls are matched one to one with
    the representatives there are, the larger common part (then the lesser key) first;
    calls that find none become representatives.  With ``intra`` a cluster is whatever
    like calls connect.  Adds ``cluster`` (its least key), ``callers`` (sorted) and
    ``chosen``.
    """
    s, e = span
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(caller))
    calls = calls.withColumn("_rank", F.when(rank > 0, rank).otherwise(len(priority) + 1))
    calls = settle(calls)
    if intra:
        of = like_components(calls, on, span, key, settle, ratio, distance).toDF("_m", "_r")
    else:
        order = [r[0] for r in calls.select(caller, "_rank").distinct().orderBy("_rank", caller).collect()]  # callers are few
        heads, of = None, None
        for name in order:
            mine = settle(calls.filter(F.col(caller).eqNullSafe(F.lit(name))).select(*on, key, s, e))
            if heads is None:
                heads = mine
                continue
            pairs = settle(matched(heads, mine, on, span, key, settle, ratio, distance))
            of = pairs if of is None else of.unionByName(pairs)
            heads = settle(heads.unionByName(mine.join(_shuffled(pairs.select(F.col("_k2").alias(key))), key, "left_anti").select(*heads.columns)))
        of = calls.select(F.col(key).alias("_m"), F.col(key).alias("_r")).limit(0) if of is None else of.select(F.col("_k2").alias("_m"), F.col("_k1").alias("_r"))
    joined = calls.join(_shuffled(of), F.col(key) == F.col("_m"), "left").withColumn("_r", F.coalesce("_r", key)).drop("_m")
    about = joined.groupBy("_r").agg(F.min(key).alias("cluster"), F.array_join(F.array_sort(F.collect_set(caller)), ",").alias("callers"), F.min_by(key, F.struct("_rank", key)).alias("_first"))
    return joined.join(_shuffled(about), "_r").withColumn("chosen", F.col(key) == F.col("_first")).drop("_r", "_rank", "_first")


def interval_union(df: DataFrame, on: Sequence[str], start: str, end: str, pad: float = 0) -> DataFrame:
    """Merged intervals per key; intervals that touch are merged."""
    rows = O.ranged(df.select(*on, (F.col(start) - pad).alias(start), (F.col(end) + pad).alias(end)), on, [start, end])
    reach = O.running(rows, on, [start, end], F.col(end), "_reach", "max", inclusive=False)
    fresh = F.coalesce(F.col(start) > F.col("_reach"), F.lit(True)).cast("long")
    return O.running(reach, on, [start, end], fresh, "_island").groupBy(*on, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def coverage_by_region(reads: DataFrame, regions: DataFrame, on: Sequence[str], span: tuple[str, str], region: tuple[str, str], keys: Sequence[str], cuts: Sequence[int], width: float) -> DataFrame:
    """Mean depth of each region and the share of its length with at least each depth.

    Depth is a sweep over the ends of the reads inside a region, not a row per base.
    """
    (s, e), (a, b) = span, region
    pairs = overlap_join(regions.select(*dict.fromkeys([*keys, *on, *region])), reads.select(*on, *span), on, region, span, width)
    ends = pairs.select(*keys, a, b, F.explode(F.array(F.struct(F.greatest(s, a).alias("at"), F.lit(1).alias("step")), F.struct(F.least(e, b).alias("at"), F.lit(-1).alias("step")))).alias("x"))
    steps = ends.groupBy(*keys, a, b, "x.at").agg(F.sum("x.step").alias("step"))
    order = Window.partitionBy(*keys).orderBy("at")
    runs = steps.withColumn("depth", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("len", F.lead("at").over(order) - F.col("at"))
    shares = [(F.sum(F.when(F.col("depth") >= c, F.col("len")).otherwise(0)) / F.first(F.col(b) - F.col(a))).alias(f"share_{c}") for c in cuts]
    out = runs.groupBy(*keys).agg((F.sum(F.col("depth") * F.col("len")) / F.first(F.col(b) - F.col(a))).alias("mean_depth"), *shares)
    return regions.join(out, list(keys), "left").fillna(0.0, ["mean_depth", *[f"share_{c}" for c in cuts]])
