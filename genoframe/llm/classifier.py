"""Quality classifier: a byte-level convolutional network in numpy.

A text is a row of bytes, each with a learned vector.  Learned filters look at 8 bytes
every 2 bytes; their largest responses in a chunk of 512 bytes describe the chunk, and
chunks overlap by half and cover the whole text.  A hidden layer reads each chunk, its
maximum and mean over the chunks are combined into one probability.

The network is fitted on the driver from a bounded sample of labelled rows; scoring
runs in the tasks, one pass over each text with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, column, raw_text, slices

#: Labelled rows of each label that the network is fitted on, at most; of a longer text so many parts of so many
#: code points, spread over all of it, stand for it in the fit.
SAMPLE, PARTS, PART = 900, 8, 2_000
WIDTH, STEP, BLOCK = 8, 2, 256
VECTOR, FILTERS, HIDDEN = 6, 32, 16
EPOCHS, BATCH, RATE = 9, 24, 0.01
THRESHOLD = 0.3
_PAD = 256
_TILE = 64


def _blocks(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each block with the WIDTH - STEP bytes that follow in its text, and where each text's blocks begin (with the end)."""
    size = np.diff(at)
    n = np.maximum(1, -(-size // BLOCK))
    first = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(n)), n)
    begin = at[doc] + (np.arange(first[-1]) - first[doc]) * BLOCK
    place = begin[:, None] + np.arange(BLOCK + WIDTH - STEP)
    ok = place < at[1:][doc][:, None]
    out = np.full(place.shape, _PAD, np.int16)
    out[ok] = raw[place[ok]]
    return out, first


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        k = WIDTH * VECTOR
        self.w = {
            "vector": r.normal(0, 0.5, (_PAD + 1, VECTOR)), "filter": r.normal(0, k**-0.5, (k, FILTERS)), "bias": np.zeros(FILTERS),
            "hidden": r.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)), "hidden_bias": np.zeros(HIDDEN), "out": r.normal(0, (2 * HIDDEN) ** -0.5, 2 * HIDDEN), "out_bias": np.zeros(1),
        }
        self.w = {n: x.astype(np.float32) for n, x in self.w.items()}

    def _windows(self, blocks: np.ndarray) -> np.ndarray:
        v = self.w["vector"][blocks].reshape(len(blocks), -1)
        view = np.lib.stride_tricks.sliding_window_view(v, WIDTH * VECTOR, axis=1)[:, :: STEP * VECTOR]
        return view.reshape(-1, WIDTH * VECTOR)

    def _respond(self, blocks: np.ndarray, where: bool):
        """Largest response of each filter in each block, and its place if asked for."""
        best, place = np.empty((len(blocks), FILTERS), np.float32), np.empty((len(blocks), FILTERS), np.int64)
        for a in range(0, len(blocks), _TILE):
            part = blocks[a : a + _TILE]
            z = (self._windows(part) @ self.w["filter"]).reshape(len(part), -1, FILTERS)
            if where:
                place[a : a + _TILE] = z.argmax(axis=1)
            best[a : a + _TILE] = z.max(axis=1)
        return np.maximum(best + self.w["bias"], 0), place

    def _read(self, blocks: np.ndarray, first: np.ndarray, where: bool = False):
        a, place = self._respond(blocks, where)
        follows = np.minimum(np.arange(len(a)) + 1, np.repeat(first[1:], np.diff(first)) - 1)
        chunk = np.maximum(a, a[follows])  # a block and the next one of the text
        h = np.maximum(chunk @ self.w["hidden"] + self.w["hidden_bias"], 0)
        top, mean = np.maximum.reduceat(h, first[:-1]), np.add.reduceat(h, first[:-1]) / np.diff(first)[:, None]
        logit = np.concatenate([top, mean], axis=1) @ self.w["out"] + self.w["out_bias"]
        return logit, (a, place, follows, chunk, h, top, mean)

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        logit, _ = self._read(*_blocks(*raw_text(texts)))
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))

    def _gradient(self, texts: pa.Array, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        blocks, first = _blocks(*raw_text(texts))
        logit, (a, place, follows, chunk, h, top, mean) = self._read(blocks, first, where=True)
        w, n = self.w, np.diff(first)
        doc = np.repeat(np.arange(len(n)), n)
        d = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) * weight / weight.sum()).astype(np.float32)
        g = {"out": np.concatenate([top, mean], axis=1).T @ d, "out_bias": d.sum(keepdims=True)}
        is_top = h == top[doc]
        share = np.add.reduceat(is_top.astype(np.float32), first[:-1])
        dh = d[doc][:, None] * (w["out"][:HIDDEN] * is_top / share[doc] + w["out"][HIDDEN:] / n[doc][:, None]) * (h > 0)
        g["hidden"], g["hidden_bias"] = chunk.T @ dh, dh.sum(axis=0)
        dc = dh @ w["hidden"].T
        own = a >= a[follows]
        da = dc * own
        da[1:] += (dc * ~own)[:-1]  # the last block of a text follows itself and is its own
        da *= a > 0
        g["bias"] = da.sum(axis=0)
        f, b = np.nonzero(da.T)
        value = da[b, f]
        seen = blocks[b[:, None], (place[b, f] * STEP)[:, None] + np.arange(WIDTH)]
        x = w["vector"][seen].reshape(len(b), -1) * value[:, None]
        ends = np.searchsorted(f, np.arange(FILTERS + 1))
        g["filter"] = np.stack([x[i:j].sum(axis=0) for i, j in zip(ends[:-1], ends[1:])], axis=1)
        share = (w["filter"].T[f] * value[:, None]).reshape(-1, VECTOR)
        g["vector"] = np.stack([np.bincount(seen.reshape(-1), share[:, i], _PAD + 1) for i in range(VECTOR)], axis=1).astype(np.float32)
        return g

    def fit(self, texts: pa.Array, label: np.ndarray, weight: np.ndarray, seed: int = 11) -> Network:
        """Adam over shuffled batches; the rate falls to zero."""
        r = np.random.default_rng(seed)
        m = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in self.w.items()}
        step, steps = 0, EPOCHS * -(-len(label) // BATCH)
        for _ in range(EPOCHS):
            order = r.permutation(len(label))
            for a in range(0, len(order), BATCH):
                i = order[a : a + BATCH]
                g = self._gradient(texts.take(pa.array(i)), label[i], weight[i])
                step += 1
                for k, x in self.w.items():
                    m1, m2 = m[k]
                    m1 += 0.1 * (g[k] - m1)
                    m2 += 0.01 * (g[k] ** 2 - m2)
                    x -= RATE * (1 - step / (steps + 1)) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-6)
        return self


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, held: int = 0, sample: int = SAMPLE) -> Network:
    """A network fitted on at most ``sample`` rows of each label outside the held-out fold.

    The rows are those with the least hashes of their ids, so the choice doesn't depend
    on the order of the input; their weights restore the shares of the labels.  Null
    labels, ids and texts are left out.  Where one label has no row, nothing can be
    learned, and every text scores the other label's certainty, or a half without rows.
    """
    marks = labels.select(col(id_col).alias("id"), col(label_col).alias("label")).filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & (_fold(F.col("id"), folds) != held)).distinct()
    counts = {r.label: r.n for r in marks.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    least = lambda y: marks.filter(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(2 * sample)
    chosen = F.broadcast(least(0).union(least(1)))  # 4 * sample ids at most: the texts are found by one scan, without a shuffle
    n = F.length("text")
    spread = F.concat_ws(" ", *[F.substring("text", (F.floor((n - PART) * i / (PARTS - 1)) + 1).cast("int"), F.lit(PART)) for i in range(PARTS)])
    short = F.when(n > PARTS * PART, spread).otherwise(F.col("text"))
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).filter("text is not null").select("id", short.alias("text"))
    table = texts.join(chosen, "id").dropDuplicates(["id", "text"]).withColumn("order", F.xxhash64("id")).toArrow().sort_by([("order", "ascending"), ("id", "ascending"), ("text", "ascending")])
    label = table["label"].to_numpy()
    some = np.sort(np.concatenate([np.flatnonzero(label == y)[:sample] for y in (0, 1)]))
    label = label[some].astype(np.float32)
    net = Network()
    if len(np.unique(label)) < 2:
        share = float(label.mean()) if len(label) else 0.5
        net.w["out"][:] = 0
        net.w["out_bias"][:] = np.log((share + 1e-6) / (1 - share + 1e-6))
    else:
        n = np.bincount(label.astype(int), minlength=2)
        weight = np.where(label == 1, counts.get(1, 0) / max(n[1], 1), counts.get(0, 0) / max(n[0], 1)).astype(np.float32)
        net.fit(table["text"].combine_chunks().take(pa.array(some)), label, weight)
    return net


def _fold(id_, folds: int):
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds


def classify(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` for each row, from its text alone.

    A null text is read as an empty one, which has a score too; a null id counts as the
    empty text for its fold; repeated rows get the same score; a very long text is scored
    by all of its chunks.  Other columns are ignored, whatever their names.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=1 << 19):
                yield pa.RecordBatch.from_arrays([column(part, "id"), column(part, "held_out"), pa.array(net.score(column(part, "text")))], names=["id", "held_out", "score"])

    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"), (_fold(col(id_col), folds) == held).alias("held_out"))
    out = rows.mapInArrow(run, f"id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumnRenamed("id", id_col)
