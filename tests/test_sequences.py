"""Reference blocks, left-alignment and the phased merge against loops over whole strings."""

import random

import pytest
from pyspark.sql import functions as F

from genoframe.operators import sequences as Q
from genoframe.plans import snv

VARIANT = "chrom string, pos long, ref string, alt string, i int"


def genome(spark, contigs, width, cut=37):
    pieces = [(c, at + 1, s[at : at + cut]) for c, s in contigs.items() for at in range(0, len(s), cut)]
    return Q.blocks(spark.createDataFrame(pieces, "chrom string, start long, bases string"), width=width)


def brute_align(s, pos, ref, alt):
    """One base at a time, as the usual definition has it."""
    ref, alt = ref.upper(), alt.upper()
    while True:
        changed = False
        if ref and alt and ref[-1] == alt[-1]:
            ref, alt, changed = ref[:-1], alt[:-1], True
        if (not ref or not alt) and pos > 1:
            ref, alt, pos, changed = s[pos - 2] + ref, s[pos - 2] + alt, pos - 1, True
        elif not ref or not alt:
            behind = s[pos - 1 + len(ref)]
            return pos, ref + behind, alt + behind
        if not changed:
            break
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        ref, alt, pos = ref[1:], alt[1:], pos + 1
    return pos, ref, alt


def test_blocks_and_bases(spark):
    r = random.Random(1)
    s = "".join(r.choices("ACGTn", k=331))
    reference = genome(spark, {"1": s, "2": s[:5]}, 16)
    assert {(x.chrom, x.block): x.bases for x in reference.collect()} == {(c, b): t[b * 16 : b * 16 + 16].upper() for c, t in (("1", s), ("2", s[:5])) for b in range((len(t) + 15) // 16)}
    at = spark.createDataFrame([("1", p, n) for p in (1, 15, 16, 17, 300, 331, 332, 900) for n in (0, 1, 16)] + [("x", 1, 3)], "chrom string, p long, n int")
    for x in Q.with_bases(at, reference, "b", F.col("p"), F.col("n"), width=16).collect():
        assert x.b == ("" if x.chrom == "x" else s[x.p - 1 : x.p - 1 + x.n].upper())


@pytest.mark.parametrize("width", [8, 64])
def test_left_align(spark, width):
    r = random.Random(width)
    s = "".join(r.choices("AC", k=60)) + "AC" * 50 + "A" * 70 + "".join(r.choices("ACGT", k=60)) + "T"
    s = "AAAA" + s
    rows = []
    for i in range(400):
        p, n = r.randrange(1, len(s) - 8), r.randrange(1, 5)
        kind = i % 4
        if kind == 0:  # deletion
            ref, alt = s[p - 1 : p + n], s[p - 1]
        elif kind == 1:  # duplication of what follows
            ref, alt = s[p - 1], s[p - 1 : p + n]
        elif kind == 2:  # with bases that both share
            ref, alt = s[p - 1 : p + n + 2], s[p - 1] + s[p + n : p + n + 2]
        else:
            ref, alt = s[p - 1 : p + n], "".join(r.choices("ACGT", k=r.randrange(1, 5)))
        if ref != alt:
            rows.append(("1", p, ref, alt, i))
    got = {x.i: (x.pos, x.ref, x.alt) for x in Q.left_align(spark.createDataFrame(rows, VARIANT), genome(spark, {"1": s}, width), width=width).collect()}
    assert got == {i: brute_align(s, p, ref, alt) for _, p, ref, alt, i in rows}
    assert min(p for p, *_ in got.values()) == 1  # some reach the contig's start


def test_left_align_odd_rows(spark):
    reference = genome(spark, {"1": "ACGT" * 10}, 8)
    odd = [("1", 3, "G", "<DEL>", 1), ("1", 3, "G", "*", 2), ("1", 3, "G", "G", 3), (None, 3, "GT", "G", 4), ("1", None, "GT", "G", 5), ("1", 3, None, "G", 6), ("z", 3, "GT", "G", 7), ("1", 3, "G", "", 8)]
    got = {x.i: (x.chrom, x.pos, x.ref, x.alt) for x in Q.left_align(spark.createDataFrame(odd * 2, VARIANT), reference, width=8).collect()}
    assert got == {i: (c, p, r, a) for c, p, r, a, i in odd}
    assert Q.left_align(spark.createDataFrame([], VARIANT), reference, width=8).count() == 0


def test_normalised(spark):
    """Two alleles split, a duplicate found by alignment, a reference allele mended and two that change places."""
    reference = genome(spark, {"1": "GGCACACATTT"}, 4)
    rows = [("1", 5, "CAC", ["C", "G"], [1, 2]), ("1", 4, "ACA", ["A"], [3]), ("1", 1, "A", ["G"], [4]), ("1", 9, "G", ["C"], [5])]
    df = spark.createDataFrame(rows, "chrom string, pos long, ref string, alt array<string>, n array<int>")
    got = sorted((x.pos, x.ref, x.alt, x.n) for x in snv.normalised(df, reference, per_allele=["n"], width=4).collect())
    assert got == [(1, "G", "A", 4), (2, "GCA", "G", 1), (5, "CAC", "G", 2), (9, "T", "C", 5)]


PHASED = "chrom string, pos long, ref string, alt string, phase string, qual double, af double, ad array<int>, filter array<string>, info map<string,double>, af_n double, ad_n array<int>"


def test_phased_merge(spark):
    s = "ACGTACGTACGTACGTACGT"
    rows = [
        ("1", 3, "GT", "GA", "p", 10.0, 0.2, [5, 2], ["PASS"], {"DP": 7.0, "MQ": 1.0}, 0.0, [9, 0]), ("1", 7, "G", "C", "p", 11.0, 0.4, [6, 3], ["PASS"], {"DP": 8.0}, 0.1, [8, 1]), ("1", 9, "A", "T", "p", None, 0.3, [6, 4], ["PASS"], {"DP": 8.0, "MQ": 3.0}, None, [8, 1]),
        ("1", 3, "G", "C", "q", 1.0, 0.1, [1, 1], ["PASS"], None, 0.0, [1, 0]), ("1", 4, "T", "C", "q", 2.0, 0.1, [1, 1], ["in_normal", "x"], None, 0.0, [1, 0]),  # two names
        ("1", 3, "GTA", "G", "o", 1.0, 0.1, [1, 1], ["PASS"], None, 0.0, [1, 0]), ("1", 5, "A", "C", "o", 1.0, 0.1, [1, 1], ["PASS"], None, 0.0, [1, 0]),  # they overlap
        ("1", 12, "T", "C", "n", 1.0, 0.1, [1, 1], ["in_normal", "a"], None, 0.0, [1, 0]), ("1", 13, "A", "C", "n", 1.0, 0.1, [1, 1], ["in_normal"], None, 0.0, [1, 0]),  # all have a preserved name
        ("1", 18, "C", "A", "p", 1.0, 0.1, [1, 1], ["PASS"], None, 0.0, [1, 0]), ("1", 19, "G", "A", None, 1.0, 0.1, [1, 1], ["PASS"], None, 0.0, [1, 0]),
    ]
    out = snv.phased_merge(spark.createDataFrame(rows, PHASED), genome(spark, {"1": s}, 8), preserved=["in_normal"], width=8).collect()
    assert len(out) == len(rows) + 3
    whole = {x.phase: x for x in out if x.parts is not None}
    p = whole["p"]
    assert (p.pos, p.ref, p.alt) == (4, "TACGTA", "AACCTT") and s[3:9] == p.ref
    assert (p.qual, round(p.af, 6), p.ad, p.af_n, p.ad_n, p.info) == (None, 0.3, [5, 3], None, [8, 0], {"DP": 7.6667, "MQ": None})
    assert p.parts.vars == "1_3_GT_GA,1_7_G_C,1_9_A_T" and p.parts.tumor_ads == "5|2,6|3,6|4" and p.parts.filters == "PASS,PASS,PASS"
    assert whole["q"]["filter"] == ["MNV_CONFLICTING_FILTERS"] and whole["q"].qual == 1.5 and whole["n"]["filter"] == ["a", "in_normal"] and "o" not in whole
    assert {(x.phase, x.pos) for x in out if "MERGED" in x["filter"]} == {("p", 3), ("p", 7), ("p", 9), ("q", 3), ("q", 4), ("n", 12), ("n", 13)}


def test_places_in_pieces(spark):
    """Places of a long contig come with a short piece of it each, and with the bases that stand there."""
    from pyspark.sql import functions as F

    from genoframe.plans.carriers_genome import _places

    text = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(30_011))
    df = spark.createDataFrame([("1", text), ("2", text[:100]), ("3", "")], "chrom string, bases string")
    out = _places(df, F.floor(F.length("bases") / 90).cast("int") - 1, 1, 45, 45 * 90, 9).selectExpr("chrom", "j", "length(piece) AS n", "substring(piece, (j - 45 * p) * 90, 9) AS b").collect()
    assert sorted((r.chrom, r.j, r.b) for r in out) == [("1", j, text[j * 90 - 1 : j * 90 + 8]) for j in range(1, 333)]
    assert max(r.n for r in out) == 4059
