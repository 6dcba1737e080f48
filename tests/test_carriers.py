"""Every operator's query on the general tables against its SQL."""

import pytest
from oracle import assert_same, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry
from genoframe.plans import carriers


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(carriers.QUERIES))
def test_carrier(spark, sf_dir, con, name):
    assert_same(spark, sf_dir, carriers.QUERIES[name], carriers.SQL[name], con)


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_no_nested_loops(spark, sf_dir):
    for name in ("best_overlap", "overlap_gene_list", "band_label", "fuzzy_reciprocal", "region_semi"):
        plan = carriers.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_like_spans_by_the_reference_ratio(spark, tmp_path):
    """Spans of 10 hours that share 8.5 of them are a pair, of 7.5 they are none."""
    rows = [(u, h) for u, a, b in ((1, 0.0, 10.0), (2, 1.5, 10.0), (3, 2.5, 10.0)) for h in (a, b)]
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("h") * 3600).cast("timestamp_ntz")
    spark.createDataFrame(rows, "user_id long, h double").select("user_id", F.lit("view").alias("event_type"), at.alias("ts")).write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in carriers.QUERIES["fuzzy_reciprocal"](spark, str(tmp_path)).select("user_a", "user_b").collect())
    assert got == [(1, 2), (2, 3)]
