"""Comparison of a query's rows with its SQL in DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if frame[c].dtype.kind == "f":
            frame[c] = frame[c].round(6) + 0.0
        frame[c] = frame[c].astype(str).replace({"None": "-", "nan": "-", "<NA>": "-", "NaT": "-"})
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def assert_same(spark, sf_dir, query, sql, con=None):
    got = rows(query(spark, sf_dir).toPandas())
    want = rows((con or connect(sf_dir)).execute(sql).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert got.equals(want), got[(got != want).any(axis=1)].head().to_string() + "\n" + want[(got != want).any(axis=1)].head().to_string()
