"""Whitening of embeddings by a two-pass covariance.

Entries become whole numbers, so the first pass has exact sums and the mean has no
rounding.  The second pass centres every vector by them before it multiplies: each task
adds up the outer products of its batches by a matrix product and sends one matrix.
``treeAggregate`` merges those by levels, so neither the driver nor a task meets more
than a few of them.  The driver solves the symmetric eigenproblem of the dimensions'
size, and the projection, a few vectors, is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, column

#: Entries are floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Levels in which partial sums are merged.
DEPTH = 3
#: An eigenvalue below this part of the largest one is rounding, not variance.
LEAST = 1e-13
#: Rows that one array pass works on.
ROWS = 2048


def _usable(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch, which rows are usable vectors, and their entries as whole numbers (int64)."""
    vectors = column(batch, "vector")
    ok = pc.fill_null(pc.equal(pc.list_value_length(vectors), size), False).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(vectors.filter(pa.array(ok)))
    entries = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, size)
    with np.errstate(all="ignore"):
        scaled = np.floor(SCALE * entries)
        whole = (np.abs(scaled) < 2.0**62).all(axis=1)  # false for what isn't finite, too
    ok[ok] = whole
    return ok, scaled[whole].astype(np.int64) + SHIFT


def _parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield (*_usable(part, size), part)


def _exact(x: np.ndarray, most: int) -> np.ndarray:
    """``x`` in a type that holds sums and products up to ``most``."""
    return x if most < 2**62 else x.astype(object)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly."""
    most = n * _largest(x) + max(map(abs, sums))
    return _exact(x, most) * n - np.array(sums, dtype=object if most >= 2**62 else np.int64)


def deviations(v: np.ndarray) -> list[int]:
    """The sum of squares of each row, exactly: in limbs of 28 bits where squares don't fit."""
    most = _largest(v)
    if most * most * max(1, v.shape[1]) < 2**62:
        return (v * v).sum(axis=1).tolist()
    if most < 2**55 and v.shape[1] <= 64:
        high, low = np.abs(v) >> 28, np.abs(v) & ((1 << 28) - 1)
        return [(a << 56) + (b << 29) + c for a, b, c in zip(*((x * y).sum(axis=1).tolist() for x, y in ((high, high), (high, low), (low, low))))]
    return [sum(y * y for y in row) for row in v.astype(object).tolist()]


def _merged(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], tuple[int, bytes]], add: Callable[[bytes, bytes], bytes]) -> tuple[int, bytes]:
    """One (count, state) for each task, merged by ``treeAggregate``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, state = work(batches)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([state], pa.binary())], names=["n", "state"])

    def plus(a: tuple[int, bytes], b: tuple[int, bytes]) -> tuple[int, bytes]:
        return (a[0] + b[0], add(a[1], b[1])) if a[0] and b[0] else (a if a[0] else b)

    states = df.mapInArrow(run, "n long, state binary").rdd
    return states.treeAggregate((0, b""), lambda a, row: plus(a, (row[0], bytes(row[1]))), plus, DEPTH)


def _sums(df: DataFrame, size: int) -> tuple[int, list[int]]:
    """First pass: the number of usable vectors and the exact sum of each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> tuple[int, bytes]:
        n, sums = 0, [0] * size
        for _, x, _ in _parts(batches, size):
            part = _exact(x, _largest(x) * len(x)).sum(axis=0).tolist()
            n, sums = n + len(x), [a + b for a, b in zip(sums, part)]
        return n, ",".join(map(str, sums)).encode()

    numbers = lambda state: [int(s) for s in state.split(b",")]
    n, state = _merged(df, work, lambda a, b: ",".join(str(x + y) for x, y in zip(numbers(a), numbers(b))).encode())
    return n, numbers(state) if n else [0] * size


def _products(df: DataFrame, size: int, n: int, sums: list[int], project: np.ndarray | None = None) -> np.ndarray:
    """The mean outer product of centred vectors (projected, where ``project`` is given), without the product of their means."""

    def work(batches: Iterator[pa.RecordBatch]) -> tuple[int, bytes]:
        count, total = 0, 0.0
        for _, x, _ in _parts(batches, size):
            y = centred(x, n, sums).astype(np.float64) / n
            y = y if project is None else y @ project
            one = np.ones((len(y), 1))
            both = np.hstack([y, one])
            count, total = count + len(x), total + both.T @ both
        return count, np.asarray(total, np.float64).tobytes() if count else b""

    _, state = _merged(df, work, lambda a, b: (np.frombuffer(a) + np.frombuffer(b)).tobytes())
    wide = (size if project is None else project.shape[1]) + 1
    moments = np.frombuffer(state).reshape(wide, wide) / n
    mean = moments[-1, :-1]  # rounding only: the vectors are centred already
    return moments[:-1, :-1] - np.outer(mean, mean)


def fit(df: DataFrame, size: int, components: int = COMPONENTS) -> dict:
    """``n``, ``sums``, ``project`` (dimensions x components, null columns where there is no variance), ``explained`` and ``error``."""
    n, sums = _sums(df, size)
    k = min(components, size)
    out = {"n": n, "sums": sums, "project": np.zeros((size, k)), "explained": [None] * k, "error": None}
    if not n:
        return out
    v = _products(df, size, n, sums)
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    real = values > max(LEAST * values[0], 0.0) if values[0] > 0 else np.zeros(k, bool)
    if real.any():
        out["explained"] = [float(e / np.trace(v)) if r else 0.0 for e, r in zip(values, real)]
        out["project"] = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), np.nan)
        sure = out["project"][:, real]
        out["error"] = float(np.abs(_products(df, size, n, sums, sure) - np.eye(sure.shape[1])).max())
    else:
        out["project"][:] = np.nan
    return out


def common_size(df: DataFrame) -> int:
    """The commonest number of dimensions (of equally common ones the largest); 0 without a vector that has any."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    good = df.filter(F.size("vector") > 0).filter(~F.exists("vector", lambda c: bad(c.cast("double"))))
    top = good.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return top["size"] if top else 0


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: ``id_col``, ``component``, ``n``, ``deviation`` (decimal), ``whitened``, ``explained``, ``identity_error``.

    A vector is left out if it is null or empty, holds a null, NaN, infinity or an entry
    whose scaled value has more than 62 bits, or has another number of dimensions than
    most vectors (of equally common ones the largest number counts).  There are as many
    components as dimensions at most.  Components without variance (equal vectors, or
    fewer vectors than components) have a null ``whitened`` and an ``explained`` of 0, or
    null where no component has any; ``identity_error`` is taken over the others.  Equal
    eigenvalues leave their components' directions open, one choice for all rows.
    Repeated rows count each time; a null id is passed on; vectors of many thousand
    dimensions take a matrix of their square on each task; an empty table gives an empty
    one; other columns are ignored.
    """
    df = vectors.select(col(id_col).alias("id"), col(vector_col).alias("vector"))
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    size = common_size(df)
    if not size:
        return df.filter(F.lit(False)).selectExpr("id", "0 AS component", "0L AS n", "CAST(0 AS decimal(38,0)) AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error").withColumnRenamed("id", id_col)
    model = fit(df, size, components)
    n, sums, k = model["n"], model["sums"], min(components, size)
    shared = df.sparkSession.sparkContext.broadcast((model["project"], model["explained"], model["error"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        project, explained, error = shared.value
        for ok, x, part in _parts(batches, size):
            if not len(x):
                continue
            v = centred(x, n, sums)
            whitened = (v.astype(np.float64) / n) @ project
            m = len(x)
            each = np.repeat(np.arange(m), k)
            ids = column(part, "id").filter(pa.array(ok)).take(pa.array(each))
            deviation = pa.array([Decimal(d) if d < 10**38 else None for d in deviations(v)], pa.decimal128(38, 0)).take(pa.array(each))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), deviation, pa.array(whitened.ravel(), from_pandas=True), pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return df.mapInArrow(run, schema).withColumnRenamed("id", id_col)
