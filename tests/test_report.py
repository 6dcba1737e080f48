"""Documents, INFO edits and report tables on a few rows."""

import pytest
from pyspark.sql import functions as F

from genoframe.functions import info as N
from genoframe.plans import report
from genoframe.sources import documents as D
from genoframe.sources import genomic as G


def test_documents(spark, tmp_path):
    data = {"b": [1, {"c": None}], "a": "ä"}
    for name, write, read in (("x.json", D.write_json, D.read_json), ("x.yaml", D.write_yaml, D.read_yaml)):
        pytest.importorskip("yaml")
        write(spark, data, f"{tmp_path}/{name}")
        assert read(spark, f"{tmp_path}/{name}") == data and list(data) == list(read(spark, f"{tmp_path}/{name}"))
        with pytest.raises(FileNotFoundError):
            read(spark, f"{tmp_path}/none")


def test_named_coverage(spark, tmp_path):
    head = "chromosome\tstart\tend\tgene\tdepth\tlog2\n"
    rows = "".join(f"{c}\t{i}\t{i + 9}\tg\t{'x' if i == 3 else i}\t0\n" for c in "1XY" for i in range(5))
    (tmp_path / "a.cnn").write_text(head + rows)
    (tmp_path / "b.cnn").write_text(head + rows.replace("Y\t4", "1\t4"))
    got = D.named_coverage(spark, f"{tmp_path}/a.cnn").collect()
    assert len(got) == 10 and {r.key: r.depth for r in got}["X_3_12"] is None and {r.key: r.depth for r in got}["Y_4_13"] == 4.0
    assert D.named_coverage(spark, f"{tmp_path}/b.cnn").count() == 0


def test_purity(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Sampleid,Ploidy,Purity,Comment\ns,2,0.2,NON-ABERRANT;Failed purity estimation\nt,3,0.5,\n")
    summary = D.purity_summary(G.tsv(spark, f"{tmp_path}/p.csv", sep=","))
    assert summary.columns == ["Purity", "Ploidy", "Comment"]
    got = sorted(tuple(r)[:2] for r in report.purity_display(summary).collect())
    assert got == [("0.2 (default fallback 20% purity)", "2 (default fallback 2 ploidy)"), ("0.5", "3")]
    other = spark.createDataFrame([(1,)], "x int")
    assert D.purity_summary(other).columns == ["x"] and report.purity_display(other).columns == ["x"]


@pytest.mark.parametrize(
    ("info", "value", "want"),
    [("A=1;FOUND_IN=x;B", "y", "A=1;FOUND_IN=y;B"), (".", "y", "FOUND_IN=y"), ("", "y", "FOUND_IN=y"), (None, "y", "FOUND_IN=y"), ("A=1", None, "A=1"), ("XFOUND_IN=1", "y", "XFOUND_IN=1;FOUND_IN=y")],
)
def test_with_info(spark, info, value, want):
    assert spark.range(1).select(N.with_info(F.lit(info).cast("string"), "FOUND_IN", F.lit(value).cast("string"))).first()[0] == want


def test_id_and_type(spark):
    df = spark.createDataFrame([("7", ".", "<DUP:TANDEM>"), (".", "A=1", ""), ("7", "A=1;SVTYPE=BND", "<DEL>"), ("7", "CLNVID=3", None), (None, None, None)], "id string, info string, t string")
    got = [tuple(r) for r in df.select(N.with_id_info(F.col("info"), F.col("id"), "CLNVID"), N.with_svtype(F.col("info"), F.col("t"))).collect()]
    assert got == [("CLNVID=7", "."), ("A=1", "A=1"), ("A=1;SVTYPE=BND;CLNVID=7", "A=1;SVTYPE=DEL"), ("CLNVID=3", "CLNVID=3"), (None, None)]
    sample = spark.range(1).select(N.with_sample_info(F.lit("DP=1"), F.array(F.lit(2), F.lit(5)), F.lit(0.25)), N.with_sample_info(F.lit("DP=1"), F.lit(None).cast("array<int>"), F.lit(None).cast("double")))
    assert tuple(sample.first()) == ("DP=7;AF=0.25", "DP=1;AF=0.0")
    first = spark.range(1).select(N.first_filter(F.array(F.lit("q"), F.lit("r"))), N.first_filter(F.array().cast("array<string>")))
    assert tuple(first.first()) == ("q", "PASS")


def test_version_order(spark):
    names = ["chr10", "chr2", "chrX", "chr1", "2", "10", "a02", "a2", "", "chr2_b"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").orderBy(N.version_key(F.col("n"))).collect()
    assert [r.n for r in rows] == ["", "2", "10", "a02", "a2", "chr1", "chr2", "chr2_b", "chr10", "chrX"]


def test_job_status(spark):
    kind = "kind string, job_id string, path string, state string"
    jobs = spark.createDataFrame([("failed", "2", "/b", "FAILED"), ("failed", "1", "/a", "FAILED"), ("resolved", "5", "/r", "TIMEOUT"), ("unknown", "9", None, None)], kind)
    text = [r.value for r in report.job_status_lines(jobs, "now").collect()]
    assert text == [
        "=== Job status check at now ===", "", "FAILED JOBS (no successful retry):", "1\t/a", "2\t/b", "",
        "", "NOTE:", "Some jobs failed but succeeded on retry:", "5\t/r\tTIMEOUT", "", "Unknown status jobs:", "9\tNA", "",
    ]
    assert [r.value for r in report.job_status_lines(jobs.limit(0), "now").collect()] == ["=== Job status check at now ===", "", "SUCCESSFUL", ""]


def test_status_is_appended(spark, tmp_path):
    jobs = spark.createDataFrame([], "kind string, job_id string, path string, state string")
    for at in ("one", "two"):
        D.write_lines(report.job_status_lines(jobs, at), f"{tmp_path}/s", "append")
    assert spark.read.text(f"{tmp_path}/s").filter(F.col("value").contains("check at")).count() == 2


def test_loh_without_types(spark):
    df = spark.createDataFrame([("1", 1, 2, "purecn")], "chr string, start int, end int, caller string")
    assert report.loh_segments(df).count() == 0 and report.chromosomes_with_calls(df).count() == 0
    assert report.with_metadata(df, "chr", {}).columns == df.columns
