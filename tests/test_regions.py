"""Regions by ranges against one row after the other."""

import random

import pytest
from pyspark.sql import functions as F

from genoframe.operators.regions import region_accumulator


def _one_by_one(rows, size):
    """Regions of one track and size; ``rows`` in order as (chrom, start, end, value)."""
    mean = lambda part: (lambda v: sum(v) / len(v) if v else None)([x[3] for x in part if x[3] is not None])
    out, i, n = [], 0, len(rows)
    while i < n:
        chrom, start = rows[i][:2]
        j = next((j for j in range(i + 1, n) if rows[j][2] - start + 1 >= size or rows[j][0] != chrom), None)
        if j is None:
            return [*out, (chrom, start, rows[-1][2], mean(rows[i:]))]
        length = rows[j][2] - start + 1
        if length == size:
            out.append((chrom, start, rows[j][2], mean(rows[i : j + 1])))
            again = [(chrom, start, rows[j - 1][2], mean(rows[i : j + 1]))]
        else:
            out += [(chrom, start, rows[j - 1][2], mean(rows[i:j]))] * ((length > size) + (rows[j][0] != chrom))
            again = [(*rows[j][:3], mean([rows[j]]))]
        if j == n - 1:
            return out + again
        i = j + 1
    return out


@pytest.mark.parametrize("parts", [1, 23])
def test_many_ranges(spark, parts):
    """One track with nearly all rows over many ranges, uneven rows, gaps, long rows that mask others, repeats, nulls, an extra column."""
    rng = random.Random(parts)
    tracks = {}
    for t, n in (("hot", 900), ("b", 40), ("c", 1), (None, 5)):
        rows, at = [], 1
        for _ in range(n):
            if rows and rng.random() < 0.01:
                at = 1
            width = rng.choice([10, 10, 10, 25, 7] + [400] * (rng.random() < 0.05))
            chrom = "1" if not rows else rows[-1][0] if at > 1 else str(int(rows[-1][0]) + 1)
            rows.append((chrom, at, at + width - 1, None if rng.random() < 0.1 else float(rng.randrange(100))))
            at += rng.choice([10, 10, width, width + 30])
        rows += rows[-1:] * (t == "b")
        tracks[t] = sorted(rows, key=lambda r: (int(r[0]), r[1], r[2], r[3] is not None, r[3] or 0.0))
    df = spark.createDataFrame([(t, *r, "x") for t, rows in tracks.items() for r in rows], "track string, chrom string, start long, end long, value double, _g string").orderBy(F.rand(3))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = region_accumulator(df, ["track"], {"big": 1000, "mid": 100, "small": 40, "row": 10}, 10, [F.col("chrom").cast("int")]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda r: (r[0], r[1], r[2], -1 if r[3] is None else r[3])
    for t, rows in tracks.items():
        for level, size in (("big", 1000), ("mid", 100), ("small", 40), ("row", 10)):
            want = _one_by_one(rows, size) if level != "row" else [*rows, rows[-1]]
            here = [(r.chrom, r.start, r.end, r.value) for r in got if r.track == t and r.level == level]
            assert [(*k[:3], k[3] if k[3] is None else round(k[3], 9)) for k in sorted(here, key=key)] == [(*k[:3], k[3] if k[3] is None else round(k[3], 9)) for k in sorted(want, key=key)], (t, level)


def test_odd_regions(spark):
    rows = spark.createDataFrame([("1", 5, 4, 1.0)], "chrom string, start long, end long, value double")
    with pytest.raises(Exception, match="before it begins"):
        region_accumulator(rows, [], {"a": 100}, 10, [F.col("chrom")]).collect()
    assert region_accumulator(rows.filter("false"), [], {"a": 100}, 10, [F.col("chrom")]).count() == 0
    one = rows.select("chrom", F.lit(1).alias("start"), F.lit(9).alias("end"), F.lit(None).cast("double").alias("value"))
    assert [tuple(r) for r in region_accumulator(one, [], {"a": 100, "r": 10}, 10, [F.col("chrom")]).collect()] == [("a", "1", 1, 9, None), ("r", "1", 1, 9, None), ("r", "1", 1, 9, None)]
