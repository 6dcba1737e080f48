"""Small cases of the operators: ties, nulls, empty tables, touching intervals."""

import random

import pytest
from pyspark.sql import functions as F

from genoframe.operators import aggregates as A
from genoframe.operators import intervals as I
from genoframe.operators import joins as J
from genoframe.operators import regions as R
from genoframe.operators import sets as T
from genoframe.operators import windows as W
from genoframe.sources import genomic as G
from genoframe.sources.tables import settled


def test_merge_count(spark):
    a = spark.createDataFrame([("1", 100, "A", "T"), ("1", 150, "A", "T")], "chrom string, pos long, ref string, alt string")
    b = spark.createDataFrame([("1", 100, "A", "T"), ("X", 5, "A", "T")], "chrom string, pos long, ref string, alt string")
    out = J.merge_full_outer(a, b, a.columns)
    assert out.count() == 3
    assert [r.pos for r in T.genomic_sort(out).collect()] == [100, 150, 5]


def test_duplicate_keys(spark):
    a = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(J.DuplicateKeys):
        J.left_unique(a, a, ["k"])


def test_overlaps(spark):
    left = spark.createDataFrame([(1, "1", 0, 10), (2, "1", 10, 35), (3, "2", 5, 6)], "id int, c string, s long, e long")
    right = spark.createDataFrame([("a", "1", 0, 10), ("b", "1", 10, 20), ("c", "1", 20, 30)], "n string, c string, a long, b long")
    strict = {(r.id, r.n) for r in I.overlap_join(left, right, ["c"], ("s", "e"), ("a", "b"), 7).collect()}
    assert strict == {(1, "a"), (2, "b"), (2, "c")}
    touching = {(r.id, r.n) for r in I.overlap_join(left, right, ["c"], ("s", "e"), ("a", "b"), 7, inclusive=True).collect()}
    assert touching == strict | {(1, "b"), (2, "a")}
    best = {r.id: r.n for r in I.best_overlap(left, right, ["c"], ("s", "e"), ("a", "b"), ["id"], 7).collect()}
    assert best == {1: "a", 2: "b", 3: None}  # of equals the first
    kept = I.overlap_join(left.union(left), right, ["c"], ("s", "e"), ("a", "b"), 7, how="left_semi")
    assert sorted(r.id for r in kept.collect()) == [1, 1, 2, 2] and kept.columns == left.columns
    empty = right.filter("false")
    assert I.best_overlap(left, empty, ["c"], ("s", "e"), ("a", "b"), ["id"], 7).count() == 3
    assert I.overlap_counts(left, empty, ["c"], ("s", "e"), ("a", "b"), ["id"], "n", 1, 7).filter("n_targets = 0 and labels = ''").count() == 3


def test_union_touching(spark):
    df = spark.createDataFrame([("1", 0, 10), ("1", 10, 20), ("1", 21, 30), ("1", 22, 25), ("2", 1, 2)], "c string, s long, e long")
    assert sorted(tuple(r) for r in I.interval_union(df, ["c"], "s", "e").collect()) == [("1", 0, 20), ("1", 21, 30), ("2", 1, 2)]


def test_asof_of_one_key(spark):
    """One key for all rows lies in many ranges; values are carried over those without any."""
    l = spark.range(0, 4000).select(F.lit("a").alias("k"), (F.col("id") % 2000).alias("p"), "id").unionByName(spark.createDataFrame([(None, 5, -1), ("b", 1, -2), ("c", 9, -3)], "k string, p long, id long"))
    r = spark.createDataFrame([("a", 3, 30), ("a", 3, 31), ("a", 1900, 19000), (None, 4, 7), ("b", 2, 2), ("b", 1, None)], "k string, q long, v long")
    want = {i: 31 if i % 2000 < 1900 else 19000 for i in range(4000)} | {-1: 7, -2: 2, -3: None}
    assert {x.id: x.o for x in I.asof_backward(l, r, ["k"], "p", "q", "v", "o").collect()} == want
    want |= {-2: None} | {i + j: None for i in range(3) for j in (0, 2000)}
    assert {x.id: x.o for x in I.asof_backward(l, r, ["k"], "p", "q", "v", "o", clamp=False).collect()} == want
    got = I.asof_backward(l.filter("k = 'a'"), r.filter("k = 'a'"), [], "p", "q", "v", "o").filter("o = 31").count()
    assert got == 3800


def test_asof(spark):
    l = spark.createDataFrame([(1, "a", 5), (2, "a", 20), (3, "b", 1)], "id int, k string, p long")
    r = spark.createDataFrame([("a", 10, "x"), ("a", 20, "y")], "k string, q long, v string")
    assert {x.id: x.o for x in I.asof_backward(l, r, ["k"], "p", "q", "v", "o").collect()} == {1: "x", 2: "y", 3: None}
    assert {x.id: x.o for x in I.asof_backward(l, r, ["k"], "p", "q", "v", "o", clamp=False).collect()} == {1: None, 2: "y", 3: None}


def test_merge_callers(spark):
    rows = [("k1", "manta", "1", "DEL", 100, 1100), ("k2", "delly", "1", "DEL", 120, 1090), ("k3", "delly", "1", "DEL", 5000, 9000), ("k4", "tiddit", "1", "DUP", 100, 1100)]
    df = spark.createDataFrame(rows, "key string, caller string, c string, t string, s long, e long")
    out = {r.key: r for r in I.merge_callers(df, ["c", "t"], ("s", "e"), "key", "caller", ["delly", "manta"], lambda x: settled(x)).collect()}
    assert out["k1"].cluster == out["k2"].cluster == "k1" and out["k2"].chosen and not out["k1"].chosen
    assert out["k1"].callers == "delly,manta" and out["k3"].chosen and out["k4"].chosen


def test_callers_stay_apart(spark):
    """Two calls of one caller that both resemble one of another: the better one joins it, the other stays alone; a third caller joins in."""
    rows = [("m1", "manta", 100, 1100), ("d1", "delly", 100, 1090), ("d2", "delly", 110, 1080), ("t1", "tiddit", 105, 1085), ("t2", "tiddit", 112, 1080), ("x1", "other", 5000, 9000), ("x2", "other", 5001, 9000)]
    df = spark.createDataFrame([(k, c, "1", "DEL", s, e) for k, c, s, e in rows], "key string, caller string, c string, t string, s long, e long")
    out = {r.key: (r.cluster, r.callers, r.chosen) for r in I.merge_callers(df, ["c", "t"], ("s", "e"), "key", "caller", ["manta", "delly"], lambda x: settled(x), 0.8, 500, 50).collect()}
    assert out["d1"][0] == out["m1"][0] == "d1" and out["d2"][0] == out["t2"][0] == "d2" and out["t1"][0] == "d1" and out["x1"] == ("x1", "other", True) and out["x2"] == ("x2", "other", True)
    by = {k: c for k, c, *_ in rows}
    assert len({(cluster, by[k]) for k, (cluster, *_) in out.items()}) == len(rows)
    linked = {r.key: r.cluster for r in I.merge_callers(df, ["c", "t"], ("s", "e"), "key", "caller", ["manta"], lambda x: settled(x), 0.8, 500, 50, intra=True).collect()}
    assert set(linked.values()) == {"d1", "x1"}
    assert I.merge_callers(df.filter("false"), ["c", "t"], ("s", "e"), "key", "caller", ["manta"], lambda x: settled(x)).count() == 0


@pytest.mark.parametrize("width", [1, 10, 5000])
def test_overlaps_of_all_lengths(spark, width, monkeypatch):
    """Lengths from 0 to the whole range, one interval over everything, and bins that are split."""
    monkeypatch.setattr(I, "FULL_BIN", 7)
    r = random.Random(width)
    one = lambda n: [(i, r.choice("ab"), s, s + int(r.paretovariate(0.4)) % 3000) for i, s in enumerate(r.choices(range(-500, 2000), k=n))]
    left, right = one(120) + [(900, "a", -10_000, 10_000), (901, "a", None, 5)], one(120) + [(900, "b", -10_000, 10_000)]
    a = spark.createDataFrame(left, "i int, k string, s long, e long")
    b = spark.createDataFrame(right, "j int, k string, x long, y long")
    for inclusive in (False, True):
        meets = lambda s, e, x, y: e >= x and s <= y if inclusive else e > x and s < y  # noqa: B023, E731
        want = sorted((i, j) for i, k, s, e in left for j, m, x, y in right if s is not None and k == m and meets(s, e, x, y))
        assert sorted((p.i, p.j) for p in I.overlap_join(a, b, ["k"], ("s", "e"), ("x", "y"), width, inclusive).collect()) == want
        assert sorted(p.i for p in I.overlap_join(a, b, ["k"], ("s", "e"), ("x", "y"), width, inclusive, how="left_semi").collect()) == sorted({i for i, _ in want})
    assert I.overlap_join(a.filter("i = 900"), b, ["k"], ("s", "e"), ("x", "y"), width).count() == sum(m == "a" for _, m, _, _ in right)


def test_coverage(spark):
    reads = spark.createDataFrame([("1", 0, 10), ("1", 5, 15)], "c string, s long, e long")
    regions = spark.createDataFrame([(1, "1", 0, 20), (2, "2", 0, 5)], "id int, c string, a long, b long")
    out = {r.id: r for r in I.coverage_by_region(reads, regions, ["c"], ("s", "e"), ("a", "b"), ["id"], [1, 2], 8).collect()}
    assert out[1].mean_depth == 1.0 and out[1].share_1 == 0.75 and out[1].share_2 == 0.25 and out[2].mean_depth == 0.0


def test_bridge(spark):
    rows = [(i, s, n) for i, (s, n) in enumerate([(1, 5), (0, 2), (1, 6), (0, 1), (1, 4), (-1, 4)])]
    df = spark.createDataFrame([("g", *r) for r in rows], "g string, i int, s int, n int")
    got = [(r.clean, r.first, r.last) for r in W.bridge_merge(df, ["g"], "i", "s", "n", 2).orderBy("clean").collect()]
    assert got == [(0, 0, 2), (1, 3, 3), (2, 4, 4), (3, 5, 5)]  # a joined run isn't looked at again


def test_islands_and_medians(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, 5.0, 2.0, None, 9.0])], "k string, i int, v double")
    assert [r.median for r in W.centered_median(df, ["k"], ["i"], "v", 3).orderBy("i").collect()] == [3.0, 2.0, 3.5, 5.5, 9.0]
    assert [r.median for r in W.centered_median(df, ["k"], ["i"], "v", 5, full=True).collect()] == [None] * 5
    assert [r.run for r in W.islands(df, ["k"], ["i"], F.col("v") > 3).orderBy("i").collect()] == [0, 1, 2, 3, 4]


def test_every_nth(spark):
    df = spark.range(100)
    assert [r.id for r in W.every_nth(df, ["id"], {"a": 29}).orderBy("id").collect()] == [0, 30, 60, 90]


def test_regions(spark):
    """Rows that fill a region, overshoot it, change the chromosome, and the rest at the end, for two tracks and two levels."""
    rows = [("1", 1, 100, 1.0), ("1", 101, 200, 3.0), ("1", 201, 300, 5.0), ("1", 901, 1000, 9.0), ("1", 1001, 1100, 2.0), ("1", 1101, 1150, 4.0), ("2", 1, 100, 7.0), ("2", 101, 200, 8.0), ("2", 201, 300, None)]
    df = spark.createDataFrame([(t, *r) for t in ("a", "b") for r in rows], "track string, chrom string, start long, end long, value double").withColumn("extra", F.lit(1))
    out = R.region_accumulator(df, ["track"], {"o": 200, "d": 100}, 100, [F.col("chrom")]).collect()
    coarse = [("1", 1, 200, 2.0), ("1", 201, 300, 5.0), ("1", 1001, 1150, 3.0), ("2", 101, 300, 8.0)]
    fine = [*rows, rows[-1]]
    for t in ("a", "b"):
        got = {k: [(r.chrom, r.start, r.end, r.value) for r in out if (r.track, r.level) == (t, k)] for k in ("o", "d")}
        assert got["o"] == [*coarse, ("2", 101, 200, 8.0)] and got["d"] == fine
    assert R.region_accumulator(df.filter("false"), ["track"], {"o": 200}, 100, [F.col("chrom")]).count() == 0


def _spans_for(n, seed=3):
    """Intervals in crowds, with copies, nulls, empty ones and one that a key has twice."""
    rnd = random.Random(seed)
    rows = [("1" if i % 3 else "2", f"k{i:04}", float(s), float(s + rnd.choice([0, 1, 40, 90, 100, 105, 1000]) + rnd.randrange(12))) for i in range(n) for s in [rnd.randrange(900)]]
    return rows + [(c, k + "c", s, e) for c, k, s, e in rows[: n // 3]] + [("1", "z", None, 5.0), (None, "y", 0.0, 100.0), ("1", "k0000", 5000.0, 5100.0)]


@pytest.mark.parametrize("ratio, distance", [(0.95, None), (0.3, 0), (0.9, 20)])
def test_like_intervals(spark, ratio, distance):
    """Pairs and components of like intervals against all pairs."""
    rows = _spans_for(150)

    def like(a, b):
        if None in (*a, *b) or a[0] != b[0]:
            return False
        shared = min(a[3], b[3]) - max(a[2], b[2])
        return (shared > 0 and shared >= ratio * max(a[3] - a[2], b[3] - b[2])) or (distance is not None and abs(a[2] - b[2]) <= distance and abs(a[3] - b[3]) <= distance)

    df = spark.createDataFrame(rows, "c string, k string, s double, e double")
    side = lambda n: df.select("c", F.col("k").alias(f"k{n}"), F.col("s").alias(f"s{n}"), F.col("e").alias(f"e{n}"))
    got = sorted((r.k1, r.k2) for r in I.fuzzy_join(side(1), side(2), ["c"], ("s1", "e1"), ("s2", "e2"), ratio, distance).collect())
    pairs = sorted((a[1], b[1]) for a in rows for b in rows if like(a, b))
    assert got == pairs
    least = {r[1]: r[1] for r in rows}
    while any(least[a] < least[b] and not least.update({b: least[a]}) for a, b in pairs):
        pass
    found = I.like_components(df, ["c"], ("s", "e"), "k", lambda x: settled(x), ratio, distance)
    assert {r.k: r.c for r in found.collect()} == least


@pytest.mark.parametrize("wide, distance", [(4, 3), (40, None)])
def test_callers_by_spans(spark, wide, distance):
    """Calls of few spans with copies and many equal scores, matched as one pair after the other would be."""
    rnd = random.Random(wide)
    rows = [(f"{rnd.randrange(10**6):06}{c}", c, s, s + 100 + rnd.randrange(wide)) for c in "xyz" for _ in range(24) for s in [rnd.randrange(wide)]]
    df = spark.createDataFrame([(k, c, "1", s, e) for k, c, s, e in rows], "key string, caller string, c string, s long, e long")
    heads, of = [r for r in rows if r[1] == "x"], {}
    for c in "yz":
        mine = [r for r in rows if r[1] == c]
        near = []
        for h in heads:
            for m in mine:
                shared, longest = min(h[3], m[3]) - max(h[2], m[2]), max(h[3] - h[2], m[3] - m[2])
                if shared >= 0.9 * longest or (distance is not None and abs(h[2] - m[2]) <= distance and abs(h[3] - m[3]) <= distance):
                    near.append((-shared / longest, h[0], m[0]))
        gone = set()
        for _, h, m in sorted(near):
            if not {h, m} & gone:
                gone |= {h, m}
                of[m] = h
        heads = heads + [m for m in mine if m[0] not in gone]
    groups = {}
    for k, *_ in rows:
        groups.setdefault(of.get(k, k), []).append(k)
    want = {k: min(g) for g in groups.values() for k in g}
    sizes = []

    def settle(x):
        out = settled(x)
        sizes.append(out.count())
        return out

    out = I.merge_callers(df, ["c"], ("s", "e"), "key", "caller", ["x", "y"], settle, 0.9, distance)
    assert {r.key: r.cluster for r in out.collect()} == want
    many = df.filter("caller = 'x'").limit(1).select(F.explode(F.sequence(F.lit(0), F.lit(3999))).alias("i"), "c", "s", "e")
    many = many.select(F.format_string("k%05d", "i").alias("key"), F.when(F.col("i") % 2 == 0, "x").otherwise("y").alias("caller"), "c", "s", "e")
    sizes.clear()
    assert I.merge_callers(many, ["c"], ("s", "e"), "key", "caller", ["x"], settle, 0.9, distance).select("cluster").distinct().count() == 2000
    assert max(sizes) <= 4000


def test_linked_calls_without_broadcast(spark):
    """Small tables, too, are joined by shuffles: by their files a table of a few MB may be millions of rows in the driver."""
    rows = [("k1", "a", "1", 0, 1000), ("k2", "b", "1", 10, 1000), ("k3", "a", "1", 5000, 9000)]
    plans = []

    def settle(x):
        plans.append(x._jdf.queryExecution().executedPlan().toString())
        return settled(x)

    out = I.merge_callers(spark.createDataFrame(rows, "key string, caller string, c string, s long, e long"), ["c"], ("s", "e"), "key", "caller", ["a", "b"], settle, 0.9, intra=True)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert {r.key: r.cluster for r in out.collect()} == {"k1": "k1", "k2": "k1", "k3": "k3"}
    assert not any("Broadcast" in p for p in plans)


def test_many_different_calls(spark, monkeypatch):
    """300 calls of different spans in one place, 22,500 like pairs: matched in bands of score, without a table of all pairs."""
    rnd = random.Random(5)
    rows = [(f"{i:05}", "xy"[i % 2], "1", 5 * rnd.randrange(10**5), 10**7 + rnd.randrange(10**6)) for i in range(300)]
    near = lambda a, b: (min(a[4], b[4]) - max(a[3], b[3])) / max(a[4] - a[3], b[4] - b[3])
    of, gone = {r[0]: r[0] for r in rows}, set()
    for _, a, b in sorted((-near(a, b), a[0], b[0]) for a in rows[::2] for b in rows[1::2] if near(a, b) >= 0.8):
        if not {a, b} & gone:
            gone |= {a, b}
            of[a] = of[b] = min(a, b)
    monkeypatch.setattr(I, "BAND_PAIRS", 16)
    monkeypatch.setattr(I, "LEAST_PAIRS", 0)
    sizes = []

    def settle(x):
        out = settled(x)
        sizes.append(out.count())
        return out

    df = spark.createDataFrame(rows, "key string, caller string, c string, s long, e long")
    out = I.merge_callers(df, ["c"], ("s", "e"), "key", "caller", ["x", "y"], settle, 0.8, 10)
    assert {r.key: r.cluster for r in out.collect()} == of and max(sizes) < 10_000


def test_many_equal_calls(spark):
    """20,000 calls of one span, two hundred million pairs, are a few rows of links."""
    calls = spark.range(20_000).select(F.lit("1").alias("c"), F.format_string("k%06d", "id").alias("key"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("caller"), F.lit(10).alias("s"), F.lit(500).alias("e"))
    sizes = []

    def settle(x):
        out = settled(x)
        sizes.append(out.count())
        return out

    out = I.merge_callers(calls, ["c"], ("s", "e"), "key", "caller", ["a", "b"], settle, intra=True)
    assert [tuple(r) for r in out.groupBy("cluster", "callers").count().collect()] == [("k000000", "a,b", 20_000)] and max(sizes) <= 20_000


def test_first_source(spark):
    """Names of every length, in any case and place; ties by order; no limit to their number."""
    sources = [(i, k) for i, k in enumerate(["Picard_HsMetrics", "fastqc", "FASTQC/raw", "ab", None, "x"])]
    asked = ["picard", "hsmetrics", "FastQC", "b", "AB", "", "none", None, "x", "raw"] + [f"name{i}" for i in range(1500)]
    out = J.first_source(spark.createDataFrame([(a,) for a in asked], "tool string"), spark.createDataFrame(sources, "i int, key string"), "tool", "key", "i")
    want = {a: next((i for i, k in sources if a is not None and k is not None and a.lower() in k.lower()), None) for a in asked}
    assert {r.tool: r.i for r in out.collect()} == want


def test_first_source_runs(spark, capsys):
    """Where all names are long, keys give runs of one length only, and few names are sent to the keys instead of a shuffle of all runs."""
    keys = spark.range(1000).select(F.format_string("BUILDING-Customer#%09d", "id").alias("key"), F.col("id").alias("i"))
    asked = spark.createDataFrame([("building",), ("000000042",)], "tool string")
    out = J.first_source(asked, keys, "tool", "key", "i")
    assert {r.tool: r.i for r in out.collect()} == {"building": 0, "000000042": 42}
    out.explain()
    plan = capsys.readouterr().out
    final = plan.split("Initial Plan")[0]
    assert "BroadcastHashJoin [_gram" in final and "SortMergeJoin [_gram" not in final and final.count("transform(") == 1
    assert {r.tool: r.i for r in J.first_source(asked, keys.filter("false"), "tool", "key", "i").collect()} == {"building": None, "000000042": None}


def test_mates(spark):
    df = spark.createDataFrame([("p", "1", "x", 1), ("p", "2", "PASS", 2), ("q", "1", "PASS", 3), ("r", "1", "x", 4), ("r", "2", "y", 5)], "p string, m string, f string, o int")
    out = {(r.p, r.m): r.promoted for r in J.promote_mates(df, "p", "m", lambda: F.col("f") == "PASS", order=["o"]).collect()}
    assert out == {("p", "1"): True, ("p", "2"): True, ("q", "1"): False, ("r", "1"): False, ("r", "2"): False}


def test_alleles(spark):
    df = spark.createDataFrame([(["T", "G"], [0.1, 0.2], [9, 3, 4])], "alt array<string>, af array<double>, ad array<int>")
    assert [tuple(r) for r in T.split_alleles(df, per_allele=["af"], with_ref=["ad"]).collect()] == [("T", 0.1, [9, 3]), ("G", 0.2, [9, 4])]


def test_vcf(spark, tmp_path):
    p = tmp_path / "a.vcf"
    p.write_text("##fileformat=VCFv4.2\n##INFO=<ID=AF,Number=A,Type=Float,Description=\"Allele frequency\">\n#CHROM\tPOS\n1\t10327\t.\tT\tC\t0.02\tLowQual\tAC=1;AF=0.5;DB;AC=2\tGT:AD\t0/1:3,1\n2\t5\trs1\tA\tC,G\t.\tPASS\t.\n")
    rows = G.vcf(spark, str(p)).orderBy("chrom").collect()
    assert (rows[0].pos, rows[0].qual, rows[0].filter, rows[0].info["AC"], rows[0].info["DB"], rows[0].samples[0]["AD"]) == (10327, 0.02, ["LowQual"], "1", None, "3,1")
    assert (rows[1].alt, rows[1].qual, rows[1].filter, rows[1].info) == (["C", "G"], None, ["PASS"], {})
    head = {r.category: r for r in G.vcf_header(spark, str(p)).collect()}
    assert (head["INFO"].id, head["INFO"].number, head["INFO"].description) == ("AF", "A", "Allele frequency")
    G.write_vcf(G.vcf(spark, str(p)), ["##fileformat=VCFv4.2"], str(tmp_path / "out"))
    assert [r.value.split("\t")[0] for r in spark.read.text(str(tmp_path / "out")).collect()][0] == "##fileformat=VCFv4.2"


def test_coerced(spark):
    df = spark.createDataFrame([("3", "x", "TRUE"), ("2.0", "NaN", "NA"), (None, "1.5", "FALSE")], "a string, b string, c string")
    assert [tuple(r) for r in G.coerced(df, ints=["a"], floats=["b"], booleans=["c"]).collect()] == [(3, None, True), (2, None, None), (None, 1.5, False)]
    with pytest.raises(G.MissingColumns):
        G.coerced(df, required=["z"])


def test_empty(spark):
    e = spark.createDataFrame([], "k string, i int, v double")
    assert A.stats(e, ["k"], "v").count() == 0
    assert W.islands(e, ["k"], ["i"], F.col("v") > 0).count() == 0
    assert J.missing_stats(e, e, ["k"]).first().total == 0
