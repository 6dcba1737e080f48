"""Golden values of the column functions."""

import pytest
from pyspark.sql import functions as F

from genoframe.functions import predicates as P
from genoframe.functions import scalars as S


def one(spark, column, **values):
    df = spark.range(1)
    for k, (v, kind) in values.items():
        df = df.withColumn(k, F.lit(v).cast(kind) if not isinstance(v, list) else F.array(*map(F.lit, v)).cast(kind))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "items, text",
    [
        (["DP=10", "DP=20"], "DP=10;DP_LIST=10,20"),
        (["NLODF=126.72", "DP=10", "DP=15", "PASS"], "NLODF=126.72;DP=10;PASS;DP_LIST=10,15"),
        ([], ""),
        (["A=1", "A=2", "B"], "A=1,2;B"),
    ],
)
def test_info(spark, items, text):
    assert one(spark, S.merged_info(F.col("i")), i=(items, "array<string>")) == text


@pytest.mark.parametrize("a, b, text", [("PASS", "in_normal;germline_risk", "germline_risk;in_normal"), ("PASS", "PASS", "PASS"), (".", ".", "."), (".", "q", "q"), (None, "PASS", "PASS")])
def test_filter_merge(spark, a, b, text):
    assert one(spark, S.merged_filter(F.col("a"), F.col("b")), a=(a, "string"), b=(b, "string")) == text


def test_order(spark):
    names = ["1", "2", "3", "X", "Y", "M", "GL1"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "c string")
    assert [r.c for r in df.orderBy(S.vcf_order(F.col("c"))).collect()] == names
    assert [r.c for r in df.orderBy(S.report_order(F.col("c"))).collect()] == ["1", "2", "3", "X", "Y", "GL1", "M"]


def test_bed(spark):
    x = S.extended(F.col("s"), F.col("e"), 100)
    assert tuple(one(spark, x, s=(10005000, "long"), e=(10005001, "long"))) == (10004950, 10005050)
    assert tuple(one(spark, x, s=(5, "long"), e=(500, "long"))) == (5, 500)


@pytest.mark.parametrize("text, state", [("FAILED node_fail", "FAILED"), ("CANCELLED+", "CANCELLED"), ("COMPLETED", "COMPLETED")])
def test_job_state(spark, text, state):
    assert one(spark, S.job_state(F.col("t")), t=(text, "string")) == state


@pytest.mark.parametrize("ratio, sex, sure", [(0.95, "male", "high"), (0.75, "male", "medium"), (0.3, "male", "low"), (0.17, "unknown", "low"), (0.1, "female", "medium"), (0.01, "female", "high"), (0.0, "female", "low")])
def test_sex(spark, ratio, sex, sure):
    assert tuple(one(spark, P.sex_by_ratio(F.col("r")), r=(ratio, "double"))) == (sex, sure)


def test_evidence(spark):
    call = lambda t, n, ct, cn: one(spark, P.tumor_normal_evidence(F.col("t"), F.col("n"), F.col("ct"), F.col("cn")), t=(t, "double"), n=(n, "double"), ct=(ct, "boolean"), cn=(cn, "boolean"))
    assert call(0, 0.9, False, True) == ["normal_variant"]
    assert call(0.5, 0.3, False, False) == ["high_normal_af_fraction", "high_normal_af"]
    assert call(0.2, 0.0, True, True) == ["in_normal"]
    assert call(0.9, 0.0, True, False) == []


def test_soft_filters(spark):
    df = spark.createDataFrame([(1, 5.0, ["PASS"]), (2, None, ["old"]), (3, 50.0, ["PASS"])], "i int, x double, filter array<string>")
    rules = [P.SoftFilter("low", F.col("x") >= 10), P.SoftFilter("high", F.col("x") > 40, "exclude"), P.SoftFilter("odd", P.or_missing(F.col("x") <= 20, F.col("x")))]
    got = {r.i: r.filter for r in P.soft_filters(df, rules).collect()}
    assert got == {1: ["low"], 2: ["old", "low"], 3: ["high", "odd"]}
    assert [r.i for r in P.hard_filter(P.soft_filters(df, rules), ["odd"]).orderBy("i").collect()] == [1, 2]
    assert P.hard_filter(df, ["PAS"]).count() == 3  # whole names only


def test_metric_status(spark):
    df = spark.createDataFrame([("lt", 1.0, 2.0), ("gt", 1.0, 2.0), (None, 1.0, 2.0), ("eq", None, 2.0)], "n string, v double, t double")
    assert [r.s for r in df.select(P.metric_status(F.col("n"), F.col("v"), F.col("t")).alias("s")).collect()] == ["pass", "fail", "no_condition", "fail"]
    with pytest.raises(Exception, match="unknown comparison"):
        spark.sql("select 'xx' n, 1.0D v, 2.0D t").select(P.metric_status(F.col("n"), F.col("v"), F.col("t"))).collect()


def test_duplex(spark):
    df = spark.createDataFrame([("XZ:Z:2,1",), ("XZ:Z:1,1",), ("XZ:Z:3,0",), (None,), ("RX:Z:AC",)], "t string")
    assert [r.k for r in df.select(P.duplex_support(F.col("t")).alias("k")).collect()] == [True, False, False, False, False]


def test_flags(spark):
    df = spark.createDataFrame([(2, "*"), (1, "chr1"), (64, "chr1"), (8, "chr1"), (0, "*")], "f int, m string")
    assert [r.x for r in df.select(S.repaired_flag(F.col("f"), F.col("m")).alias("x")).collect()] == [11, 1, 65, 9, 0]


def test_range_filter(spark):
    df = spark.createDataFrame([("chr1", 10, 20), ("1", 30, 40), ("2", 10, 20), ("1", None, None)], "c string, s int, e int")
    assert [r.s for r in df.filter(P.in_range(F.col("c"), F.col("s"), F.col("e"), "1", 20, 29)).collect()] == [10, None]
