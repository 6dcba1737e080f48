"""Ordered state over ranges against plain loops: one key for all rows, many ranges, ties of keys, nulls."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from genoframe.operators import intervals as I
from genoframe.operators import ordered as O
from genoframe.operators import windows as W


@pytest.fixture(params=[1, 23])
def parts(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows(n=300, keys=("a",), seed=1):
    r = random.Random(seed)
    return [(r.choice(keys), i, r.choice([None, 1.0, -1.0, 0.0, 2.5]), r.choice([-1, 0, 0, 1]), r.randrange(1, 4)) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "k string, i int, v double, s int, n int")


def by_key(data):
    out = {}
    for row in data:
        out.setdefault(row[0], []).append(row)
    return out.values()


KEYS = [("a",), ("a", "b", None, *"cdefghijklm")]


@pytest.mark.parametrize("keys", KEYS)
def test_neighbours_and_sums(spark, parts, keys):
    data = rows(keys=keys)
    df = frame(spark, data)
    ranged = O.ranged(df, ["k"], ["i"])
    near = {x.i: [None if y is None else (y.v,) for y in x.near] for x in O.neighbours(ranged, ["k"], ["i"], F.col("v"), 3, 2, "near").collect()}
    total = {x.i: x.t for x in O.running(ranged, ["k"], ["i"], F.col("v"), "t").collect()}
    most = {x.i: x.t for x in O.running(ranged, ["k"], ["i"], F.col("v"), "t", "max", inclusive=False).collect()}
    middle = {x.i: x.median for x in W.centered_median(df, ["k"], ["i"], "v", 5).collect()}
    diff = {x.i: x["diff"] for x in W.lag_diff(df, ["k"], ["i"], "v").collect()}
    for group in by_key(data):
        for j, (_, i, v, *_) in enumerate(group):
            want = [(group[j + o][2],) if 0 <= j + o < len(group) else None for o in range(-3, 3)]
            assert near[i] == want
            upto = [x[2] for x in group[: j + 1] if x[2] is not None]
            assert total[i] == (sum(upto) if upto else None)
            past = [x[2] for x in group[:j] if x[2] is not None]
            assert most[i] == (max(past) if past else None)
            around = [x[2] for x in group[max(0, j - 2) : j + 3] if x[2] is not None]
            assert middle[i] == (median(around) if around else None)
            last = group[j - 1][2] if j else None
            assert diff[i] == (v - last if v is not None and last is not None else None)


@pytest.mark.parametrize("keys", KEYS)
def test_islands_and_bridges(spark, parts, keys):
    data = rows(keys=keys, seed=2)
    df = frame(spark, data)
    run = {x.i: x.run for x in W.islands(df, ["k"], ["i"], F.col("v")).collect()}
    bridged = {}
    for x in W.bridge_merge(df, ["k"], "i", "s", "n", 2).collect():
        bridged.setdefault(x.k, []).append((x.clean, x.first, x.last, x.sign))
    for group in by_key(data):
        number = 0
        for j, row in enumerate(group):
            number += j > 0 and row[2] != group[j - 1][2]
            assert run[row[1]] == number
        want, j = [], 0
        while j < len(group):
            a, b, c = (group[j : j + 3] + [None] * 3)[:3]
            join = c is not None and a[3] != 0 and c[3] == a[3] and b[3] == 0 and b[4] <= 2
            want.append((len(want), a[1], c[1] if join else a[1], a[3]))
            j += 3 if join else 1
        assert sorted(bridged[group[0][0]]) == want


def test_walk(spark, parts):
    """An automaton that forgets nothing: parity of ones since the last two."""
    r = random.Random(3)
    data = [(r.choice("ab"), i, 0.0, r.choice([0, 1, 2]), 1) for i in range(200)]
    moves = [[0, 1, 0], [1, 0, 0]]
    got = {x.i: x.met for x in O.walk(O.ranged(frame(spark, data), ["k"], ["i"]), ["k"], ["i"], "s", moves, "met").collect()}
    for group in by_key(data):
        state = 0
        for _, i, _, s, _ in group:
            assert got[i] == state
            state = moves[state][s]


def test_no_window_over_a_key(spark, parts):
    """Rows are windowed by range; what is windowed by key alone has a row for each range."""
    df = spark.range(20_000).select(F.lit("a").alias("k"), F.col("id").alias("i"), (F.col("id") % 7).alias("v"))
    plan = W.islands(df, ["k"], ["i"], F.col("v"))._jdf.queryExecution().optimizedPlan().toString()
    scanned = [x for x in plan.splitlines() if "Window [" in x and "_edge" not in x and "_base" not in x and "lag(_lastf" not in x]
    assert scanned and all("[_p#" in x for x in scanned)
    assert W.islands(df, ["k"], ["i"], F.col("v")).agg(F.max("run")).first()[0] == 19_999


def test_empty_and_no_key(spark, parts):
    e = frame(spark, [])
    assert W.islands(e, ["k"], ["i"], F.col("v")).count() == W.bridge_merge(e, ["k"], "i", "s", "n", 2).count() == W.lag_diff(e, [], ["i"], "v").count() == 0
    data = rows()
    df = frame(spark, data)
    assert [x.t for x in W.cumulative_center(df.fillna(0.0, ["v"]), [], ["i"], "v", "t").orderBy("i").collect()][-1] == sum(x[2] or 0 for x in data) - (data[-1][2] or 0) / 2
    assert sorted(x.i for x in W.every_nth(df, ["i"], {"a": 6}, by=["k"]).collect()) == list(range(0, 300, 7))


def test_union_over_ranges(spark, parts):
    """An interval that spans all others, whatever range they are in, and touching ones."""
    data = [("a", 0, 10_000)] + [("a", i * 10, i * 10 + 5) for i in range(1, 300)] + [("b", i * 10, i * 10 + 10) for i in range(100)] + [("b", 2000, 2001)]
    df = spark.createDataFrame(data, "k string, s long, e long")
    assert sorted(map(tuple, I.interval_union(df, ["k"], "s", "e").collect())) == [("a", 0, 10_000), ("b", 0, 1000), ("b", 2000, 2001)]
    assert sorted(x.stack for x in W.stacks(spark.createDataFrame([("a", p, "A") for p in (1, 2, 8, 9, 30)], "k string, pos long, ref string"), ["k"], "pos", "ref", 5).collect()) == [0, 0, 1, 1, 2]
