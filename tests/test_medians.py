"""Medians by counted ranges against pandas, at sizes that force every kind of round."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from genoframe.operators import aggregates as A
from genoframe.operators.medians import medians


def _same(got, want):
    assert len(got) == len(want)
    for k, w in want.items():
        g = got[k]
        assert (g is None and pd.isna(w)) or (g is not None and (g == w or (math.isnan(g) and math.isnan(w)))), (k, g, w)


@pytest.mark.parametrize("few", [1, 3, 1000])
def test_medians(spark, few):
    """One group with a third of all rows, ties, spans of hundreds of octaves, neighbours in the last bit, infinities."""
    rng = np.random.default_rng(5)
    one = np.nextafter(1.0, 2.0)
    groups = {
        "hot": rng.normal(0, 1, 3001).round(3), "even": rng.normal(5, 100, 1000), "wide": np.ldexp(rng.uniform(1, 2, 600), rng.integers(-1000, 1000, 600)) * rng.choice([-1, 1], 600),
        "ties": np.repeat([2.0, 7.0], [500, 500]), "bits": np.repeat([1.0, one, np.nextafter(one, 2.0)], [7, 6, 1]), "single": np.array([3.5]), "zeros": np.array([-0.0, 0.0, 0.0, -0.0]),
        "ends": np.array([-np.inf, 1.0, 1e308, np.inf, np.inf]), "negative": -rng.uniform(1, 1.0001, 401),
    }
    df = pd.DataFrame([(k, float(x)) for k, v in groups.items() for x in v], columns=["k", "v"]).sample(frac=1, random_state=1)
    rows = spark.createDataFrame([*df.itertuples(index=False, name=None), ("null", None), (None, 4.0), (None, 6.0), ("hot", None)], "k string, v double").withColumn("_v", F.lit("clash"))
    want = {**{k: np.median(v) for k, v in groups.items()}, "null": float("nan"), None: 5.0}
    got = {r.k: r["median"] for r in medians(rows, ["k"], "v", few=few).collect()}
    _same(got, want)
    assert medians(rows, [], "v", few=few).collect() == [(np.median(rows.select("v").toPandas()["v"].dropna()),)]


def test_odd_rows(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", float("nan")), ("a", 2.0), ("a", 3.0)], "k string, v double")
    assert medians(rows, ["k"], "v", few=1).collect() == [("a", 3.0)]
    empty = rows.filter("false")
    assert medians(empty, ["k"], "v").count() == 0 and medians(empty, [], "v").collect() == [(None,)]


def test_stats_keep_groups(spark):
    rows = spark.createDataFrame([("s", "X", 1.0), ("s", "X", 3.0), ("s", "Y", 7.0), ("t", "1", 9.0), (None, "X", 2.0)], "s string, c string, v double")
    flat = {r.s: r for r in A.flat_stats(rows, "c", "v", ["X", "Y"], ["s"]).collect()}
    assert (flat["s"].X_median, flat["s"].Y_median, flat["t"].X_median, flat["t"].X_count, flat[None].X_median) == (2.0, 7.0, None, 0, 2.0)
    assert {r.c: r["median"] for r in A.stats(rows, ["c"], "v").collect()} == {"X": 2.0, "Y": 7.0, "1": 9.0}
