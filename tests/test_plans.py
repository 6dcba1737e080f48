"""Whole analyses on a few rows."""

import pytest
from pyspark.sql import functions as F

from genoframe.operators import sets as T
from genoframe.plans import catalogs, cnv, cohort, snv, sv


def test_catalog():
    tga = catalogs.SNV_FILTERS["tga"]["quality"]
    assert [f.name for f in catalogs.choose(tga, "single", "vardict", False)] == ["low_af", "low_tumor_ad", "low_tumor_dp", "low_mq"]
    assert catalogs.unique(catalogs.choose(tga, "paired", "tnscope", True), "low_tumor_dp").value == 20
    with pytest.raises(catalogs.CatalogError):
        catalogs.unique(tga, "low_tumor_dp")
    with pytest.raises(catalogs.CatalogError):
        catalogs.unique(tga, "nothing")
    assert "in_normal" not in catalogs.hard_names(tga, soft_normals=True) and "in_normal" in catalogs.hard_names(tga)
    assert catalogs.kit_of("gmslymphoid_7.1_hg19_design.bed") == "gmslymphoid"
    assert catalogs.requested_metrics("gmslymphoid")["GC_DROPOUT"] == ("lt", 3.0)


def test_snv_merge(spark):
    kind = "chrom string, pos long, ref string, alt string, id string, qual string, filter string, info string, caller string"
    a = spark.createDataFrame([("1", 10, "A", "T", ".", "5", "PASS", "DP=10;AF=0.1", "a"), ("X", 3, "A", "T", "rs1", ".", "PASS", "DP=1", "a")], kind)
    b = spark.createDataFrame([("1", 10, "A", "T", "rs9", "7", "in_normal", "DP=20;X", "b"), ("2", 3, "C", "T", ".", "1", ".", "DP=2", "b")], kind)
    got = [tuple(r) for r in T.genomic_sort(snv.merge_callers(a, b)).collect()]
    assert got == [
        ("1", 10, "A", "T", "rs9", "5", "in_normal", "DP=10;AF=0.1;X;DP_LIST=10,20", "a"),
        ("2", 3, "C", "T", ".", "1", ".", "DP=2", "b"),
        ("X", 3, "A", "T", "rs1", ".", "PASS", "DP=1", "a"),
    ]


def test_quality(spark):
    rows = [(1, [60, 10], 0.1, 0.0, 40.0, 100, 10, 0.1), (2, [60, 10], 0.1, 0.09, 10.0, 20, 1, 0.001)]
    df = spark.createDataFrame(rows, "i int, ad_t array<int>, af_t double, af_n double, mq double, dp int, vd int, af double").withColumn("filter", F.array(F.lit("PASS"), F.lit("MAF0.05")))
    soft, kept = snv.quality_filtered(df, "tga", "paired", "vardict")
    assert {r.i: r["filter"] for r in soft.collect()} == {1: ["PASS"], 2: ["in_normal", "low_tumor_dp", "low_tumor_ad", "low_af", "low_mq"]}
    assert [r.i for r in kept.collect()] == [1]
    soft, kept = snv.quality_filtered(df, "tga", "paired", "vardict", prefix="our_")
    assert {r.i: r["filter"] for r in soft.collect()}[2] == ["in_normal", "our_low_tumor_dp", "our_low_tumor_ad", "our_low_af", "our_low_mq"] and [r.i for r in kept.collect()] == [1]


def test_clinical(spark):
    key = "chrom string, pos long, ref string, alt string"
    df = spark.createDataFrame([("1", 1, "A", "T", ["Benign"]), ("1", 2, "A", "T", ["Likely oncogenic"]), ("1", 3, "A", "T", None), ("1", 4, "A", "T", None)], f"{key}, onc array<string>").withColumn("filter", F.array(F.lit("PASS")))
    freq = spark.createDataFrame([("1", p, "A", "T", 0.5) for p in (1, 2, 3)], f"{key}, freq double")
    saved, kept = snv.clinical_filtered(df, {"Frq": freq}, spark.createDataFrame([("1", 3, "A", "T")], key), "wgs")
    assert {r.pos: r.rescue_status for r in saved.collect()} == {1: None, 2: "ClinvarOnc", 3: "RescueList", 4: None}
    assert sorted(r.pos for r in kept.collect()) == [2, 3, 4]


def test_phased(spark):
    kind = "chrom string, pos long, ref string, alt string, phase string, qual double, af double, ad array<int>, filter array<string>, gap string"
    rows = [("1", 10, "A", "T", "p", 10.0, 0.2, [5, 2], ["PASS"], "GC"), ("1", 12, "C", "G", "p", 20.0, 0.4, [6, 3], ["PASS"], "T"), ("1", 90, "C", "G", "p", 1.0, 0.1, [6, 3], ["PASS"], ""), ("1", 11, "C", "G", None, 1.0, 0.1, [6, 3], ["PASS"], "")]
    out = {(r.pos, r.ref): r for r in snv.phased_merge(spark.createDataFrame(rows, kind)).collect()}
    whole = out[(10, "AGC")]
    assert (whole.alt, whole.qual, whole.ad, whole["filter"]) == ("TGG", 15.0, [5, 2], ["PASS"])
    assert out[(10, "A")]["filter"] == ["MERGED"] and out[(90, "C")]["filter"] == ["PASS"] and len(out) == 5


def test_burden(spark):
    good = (["PASS"], 0.1, "A", "C", None, "", ["missense_variant"])
    bad = [(["x"], *good[1:]), (None, *good[1:]), (["PASS"], 0.01, *good[2:]), (*good[:2], "AC", "GT", *good[4:]), (*good[:4], "rs1", *good[5:]), (*good[:5], "COSM1", good[6]), (*good[:6], ["non_coding_transcript_variant"])]
    df = spark.createDataFrame([good, *bad], "filter array<string>, af_t double, ref string, alt string, existing_variation string, cosmic string, consequence array<string>")
    assert snv.mutational_burden(df, spark.createDataFrame([(0, 500_000)], "start long, end long")).first().rate == 2.0
    assert snv.mutational_burden(df).first().units == catalogs.GENOME_MB


def test_sv(spark):
    df = spark.createDataFrame([(1, ["1:10:1:10|CTG:abc"], ["0:10:0:10|CTG:."], ["PASS"]), (2, ["0:10:0:10|CTG:."], ["5:10:5:10|CTG:x"], ["PASS"])], "i int, tumor array<string>, normal array<string>, filter array<string>")
    got = {r.i: r for r in sv.evidence(df).collect()}
    assert got[1]["filter"] == ["PASS"] and got[1].af_t_max == 0.1 and got[2]["filter"] == ["normal_variant"]
    ends = spark.createDataFrame([("t_1_1", ["5", "9"], ["PASS"], 1), ("t_1_2", ["5", "9"], ["low"], 2), ("t_2_1", ["5", "9"], ["low"], 3)], "name string, region array<string>, filter array<string>, start int")
    assert {r.name: r["filter"] for r in sv.rescued_breakends(ends).collect()} == {"t_1_1": ["PASS"], "t_1_2": ["PASS"], "t_2_1": ["low"]}
    calls = spark.createDataFrame([("k", "1", "DEL", 100, 1100, ["PASS"])], "key string, chrom string, svtype string, start long, end long, filter array<string>")
    db = spark.createDataFrame([("1", "DEL", 110, 1090, 0.3)], "chrom string, svtype string, start long, end long, frq double")
    soft, kept = sv.frequency_filtered(calls, {"Frq": (db, "frq", 10000)}, "clinical")
    assert soft.first()["filter"] == ["Frq"] and kept.count() == 0


def test_cnv(spark):
    rows = [("1", i * 100, i * 100 + 50, "G", 1.0 if 4 <= i < 12 else 0.0) for i in range(16)] + [("1", 5000, 5050, "H", 0.1), ("1", 6000, 6050, "backbone", 0.1)]
    bins = spark.createDataFrame(rows, "chr string, start long, end long, gene string, log2 double")
    pon = bins.withColumns({"log2": F.lit(0.0), "spread": F.lit(0.1)})
    regions = cnv.gene_regions(cnv.baseline_joined(bins, pon)).orderBy("gene", "start").collect()
    called = [r for r in regions if r.call == "GAIN"]
    assert len(called) == 1 and called[0].n >= 6 and called[0].signal == "strong" and called[0].direction == "gain"
    assert [r.call for r in regions if r.gene == "H"] == [""]
    segments = spark.createDataFrame([("1", 0, 900, 3), ("1", 900, 9000, 2)], "chr string, start long, end long, cn int")
    genes = {r.gene: r.segment_call for r in cnv.with_segments(cnv.genes(bins), segments, "female", ["chr", "gene"]).collect()}
    assert genes == {"G": "AMPLIFICATION", "H": "NEUTRAL"}
    bands = spark.createDataFrame([("1", 0, 500, "p1"), ("1", 501, 99999, "q1")], "chr string, band_start long, band_end long, band string")
    table = cnv.segment_table([segments], ["x"], bins, bands, "female").orderBy("start").collect()
    assert [(r.cytoband, r.call, r.genes, r.size_kb) for r in table] == [("chr1p1-q1", "AMPLIFICATION", "G", 1), ("chr1q1", "NEUTRAL", "G", 8)]
    summary = cnv.quality_summary(bins, pon.limit(10)).first()
    assert summary.total == 10 and summary.filtered_out == 0 and summary.noise > 0
    assert cnv.chromosome_view(bins).count() == 18
    shown = cnv.report_filter(cnv.segment_table([segments], ["x"], bins, bands, "female"), "chr1", 0, 500, genes=["g"])
    assert shown.count() == 1


def test_sex(spark):
    rows = [("s", "target", c, d) for c, d in [("X", 10.0)] * 60 + [("Y", 9.5)] * 60] + [("s", "antitarget", c, d) for c, d in [("X", 10.0)] * 5 + [("Y", 0.1)] * 5]
    got = cohort.panel_sex(spark.createDataFrame(rows, "sample string, kind string, chrom string, depth double")).first()
    assert (got.sex, got.kind, got.score) == ("male", "target", 11)
    x, y = spark.createDataFrame([(10.0,), (12.0,)], "value double"), spark.createDataFrame([(0.2,)], "value double")
    assert cohort.genome_sex(x, y).first().sex == "female"


def test_tracks(spark):
    v = spark.createDataFrame([("1", 10327, "0/1", 1, 4), ("1", 20000, "./.", 1, 4), ("1", 30000, "0/1", 1, 0), ("GL", 5, "0/1", 1, 4)], "chrom string, pos long, gt string, ad_alt int, dp int")
    got = sorted(tuple(r) for r in cohort.allele_track(v, ["1"]).collect())
    assert got[0] == ("a_1", 10327, 10328, 0.25) and len(got) == 5
    bins = spark.createDataFrame([("1", 1718694, 1718951, "GNB1", -0.120548), ("1", 5, 9, "Antitarget", 0.1)], "chr string, start long, end long, gene string, log2 double")
    assert cohort.panel_track(bins).count() == 5


def test_metrics(spark):
    data = {"multiqc_picard_HsMetrics": {"x_align_sort_1": {"GC_DROPOUT": "2.0", "OTHER": "1"}, "umi_x": {"GC_DROPOUT": "9"}}, "multiqc_picard_gcbias": {"x_align_sort_1": {"GC_DROPOUT": "9"}}}
    df = spark.createDataFrame([(data,)], "d map<string,map<string,map<string,string>>>")
    rows = cohort.validated(cohort.metrics(df, "d", catalogs.requested_metrics("gmslymphoid"), "tga")).collect()
    assert [(r.name, r["sample"], r.value, r.status) for r in rows] == [("GC_DROPOUT", "x", 2.0, "pass")]


def test_jobs(spark):
    df = spark.createDataFrame([("r1", "1", "FAILED x", "a"), ("r1", "12", "TIMEOUT", "b"), ("r2", "3", "FAILED", "c"), ("r2", "4", "COMPLETED", "d"), ("r3", "5", "RUNNING", "e"), ("r4", "6", "NODE_FAIL", "f")], "rule string, job_id string, state string, path string")
    assert [(r.rule, r.job_id) for r in cohort.job_outcomes(df).collect()] == [("r1", "12")]


def test_panel(spark):
    df = spark.createDataFrame([("1", 10005000, 10005001), ("1", 10005040, 10005041)], "chrom string, start long, end long")
    assert [tuple(r) for r in cohort.panel_regions(df).collect()] == [("1", 10004950, 10005090)]
