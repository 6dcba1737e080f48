"""Language-model scores by a weighted backoff automaton.

The model is a smoothed trigram model.  Its states are the root, every training word,
the start of a text, and every pair of words that was seen; a state has an arc for each
word seen behind it, and a failure arc to the state of its last word, or to the root,
which has an arc for every word and one for unknown words.  A text is read once from
left to right: at each word the arc of the current state is taken or, without one, the
failure arcs are followed until a state has it; the log weights of all arcs add up, and
the arc taken leads to the state for the next word.

    root            P(w)      = (c(w) + 1) / (N + V + 1)
    arc h -> w      P(w|h)    = (c(h w) + mu P(w)) / (c(h) + mu)
    arc g h -> w    P(w|g h)  = (c(g h w) + mu' P(w|h)) / (c(g h) + mu')
    failure         mu / (c(h) + mu) and mu' / (c(g h) + mu')

so every state's weights sum to one over the vocabulary and the unknown word.

No task holds the model.  Documents are packed into blocks as they are read; a block asks
for the counts of its own n-grams, the requests of all blocks meet in buckets, which are
ranges of 64-bit hashes, are added up there, and every block gets back the counts for
exactly the arcs its texts can follow.  A frequent word is counted once for each block
before anything is moved, so it is no larger than a rare one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, col, column, deflate, inflate, mix, settled, slices, total_bytes

#: Bytes of text in a block and for each bucket.
BLOCK_BYTES, BUCKET_BYTES = 3 << 20, 6 << 20
#: Weights of the shorter history's distribution against a state's own counts, for words and for pairs.
MU, MU_PAIR = 1000.0, 5.0
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
ORDERS = 3
#: Bits of a pair's or triple's key beside those of its bucket's number: in a bucket of two million such keys two are
#: taken for one about three times in a hundred buckets.  Words keep all 64 bits.
KEY_BITS = 46


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers as byte planes of the least width, behind their number and width."""
    most = int(x.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if w == 8 or most < 1 << 8 * w)
    return np.array([len(x), width], np.int64).tobytes() + x.astype(f"<u{width}").view(np.uint8).reshape(len(x), width).T.tobytes()


def _numbers(data: bytes, at: int) -> tuple[np.ndarray, int]:
    n, width = np.frombuffer(data, np.int64, 2, at).tolist()
    planes = np.frombuffer(data, np.uint8, n * width, at + 16).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(np.uint64), at + 16 + n * width


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys by their differences, and counts."""
    return _planes(np.diff(keys, prepend=np.uint64(0))) + _planes(counts)


def _unpack(data: bytes, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    gaps, at = _numbers(data, at)
    counts, at = _numbers(data, at)
    return np.cumsum(gaps, dtype=np.uint64), counts, at


class Block:
    """The tokens of some texts, each with its text's end, and their distinct n-grams by ascending hash.

    ``grams[k]`` are the hashes of the n-grams of k + 1 tokens, ``at[k]`` the number of
    the one that ends at each token; no trigram ends at a text's first token.
    """

    def __init__(self, batches: list[pa.RecordBatch], buckets: int):
        words, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for part in slices(batch):
                w = Words(column(part, "text"), lower=True)
                words.append(w.hashes())
                counts.append(w.counts)
        n = np.concatenate(counts) + 1
        self.row = np.repeat(np.arange(len(n), dtype=np.int32), n)
        last = np.cumsum(n) - 1
        h = np.full(len(self.row), END)
        inner = np.ones(len(h), bool)
        inner[last] = False
        h[inner] = np.concatenate(words)
        self.first = np.zeros(len(h), bool)
        self.first[last + 1 - n] = True
        before = np.roll(h, 1)
        before[self.first] = START
        pair = mix(before * np.uint64(0x9FB21C651E98DF25) + h)
        triple = mix(np.roll(pair, 1) * np.uint64(0xC2B2AE3D27D4EB4F) + h)
        low = np.uint64(max(0, 64 - KEY_BITS - (buckets - 1).bit_length()))  # bits that no key holds
        pair, triple = pair >> low << low, triple[~self.first] >> low << low
        self.grams, self.at = [], []
        for g in (h, pair, triple):
            u, inverse = np.unique(g, return_inverse=True)
            self.grams.append(u)
            self.at.append(inverse.astype(np.int32))
        whole = np.full(len(h), -1, np.int32)
        whole[~self.first] = self.at[2]
        self.at[2] = whole
        self.low = [np.uint64(0), low, low]

    def counts(self, train: np.ndarray) -> list[np.ndarray]:
        """How often each n-gram occurs in training rows."""
        weight = train[self.row].astype(np.float64)
        return [np.bincount(a[a >= 0], weights=weight[a >= 0], minlength=len(g)).astype(np.uint64) for g, a in zip(self.grams, self.at)]

    def slices(self, train: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """What is asked of each bucket: its n-grams here, and how often they occur in training rows."""
        counts = self.counts(train)
        cuts = [np.concatenate([[0], np.searchsorted(g, bounds), [len(g)]]) for g in self.grams]
        for b in range(len(bounds) + 1):
            if any(c[b + 1] > c[b] for c in cuts):
                yield b, b"".join(_pack(g[c[b] : c[b + 1]] >> low, n[c[b] : c[b + 1]]) for g, n, c, low in zip(self.grams, counts, cuts, self.low))


def _bounds(buckets: int) -> np.ndarray:
    """The least hash of each bucket but the first."""
    return np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as they come, packed into blocks of about BLOCK_BYTES of text."""
    held, size, number = [], 0, TaskContext.get().partitionId() << 32

    def block() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in held:
                out.write_batch(part)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "data"])

    for batch in batches:
        for part in slices(batch):
            held.append(part)
            size += column(part, "text").nbytes
            if size >= BLOCK_BYTES:
                yield block()
                held, size, number = [], 0, number + 1
    if held:
        yield block()


def _opened(data: pa.Scalar) -> list[pa.RecordBatch]:
    return list(pa.ipc.open_stream(pa.py_buffer(data.as_py())))


def _requests(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _bounds(buckets)
        for batch in batches:
            for number, data in zip(column(batch, "block").to_pylist(), column(batch, "data")):
                held = _opened(data)
                train = np.concatenate([column(b, "train").to_numpy(zero_copy_only=False) for b in held])
                names, packed = [], []
                for b, raw in Block(held, buckets).slices(train, bounds):
                    names.append(b)
                    packed.append(deflate(raw))
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(names), pa.int64()), pa.array(names, pa.int32()), pa.array(packed, pa.binary())], names=["block", "bucket", "data"])

    return ask


def _answer(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the counts of one bucket; each block gets the totals of its keys in its own order."""
    blocks, asked = [], []
    for batch in batches:
        blocks += column(batch, "block").to_pylist()
        for x in column(batch, "data"):
            data, at, each = inflate(x.as_py()), 0, []
            for _ in range(ORDERS):
                keys, n, at = _unpack(data, at)
                each.append((keys, n))
            asked.append(each)
    totals, distinct, tokens = [], 0, 0
    for k in range(ORDERS):
        u, inverse = np.unique(np.concatenate([a[k][0] for a in asked]), return_inverse=True)
        n = np.zeros(len(u), np.uint64)
        np.add.at(n, inverse, np.concatenate([a[k][1] for a in asked]))
        if not k:
            distinct, tokens = int((n > 0).sum()), int(n.sum())
        totals.append(np.split(n[inverse], np.cumsum([len(a[k][0]) for a in asked])[:-1]))
    out = [deflate(b"".join(map(_planes, each))) for each in zip(*totals)]
    m = len(blocks)
    yield pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array([key[0].as_py()] * m, pa.int32()), pa.array(out, pa.binary()), pa.array([distinct] + [0] * (m - 1), pa.int64()), pa.array([tokens] + [0] * (m - 1), pa.int64())],
        names=["block", "bucket", "data", "distinct", "tokens"],
    )


class Automaton:
    """The states and arcs that the texts of one block can reach.

    State 0 is the root and 1 the start of a text; then come the block's words and its
    pairs of words.  ``mass`` is how often training texts left a state, ``fail`` where
    its failure arc leads and ``loss`` what that costs.  ``arcs`` has for each n-gram the
    log weight of its last token's arc from the state of the others, -inf for none, and
    ``after`` the state that the arcs of a pair's second word lead to.
    """

    def __init__(self, block: Block, counts: list[np.ndarray], starts: int, n: int, v: int, mu: tuple[float, float] = (MU, MU_PAIR)):
        word, pair, triple = block.at
        c1, c2, c3 = (c.astype(np.float64) for c in counts)
        words, pairs = len(c1), len(c2)
        at = lambda kind, values: _scatter(kind, values)
        left = np.where(block.first, 1, 2 + np.roll(word, 1))  # the state of the word before
        self.block, self.known, self.pair0 = block, c1 > 0, 2 + words
        from_state, last = at((pair, pairs), left), at((pair, pairs), 2 + word)
        self.mass = np.concatenate([[n, starts], c1, c2])
        self.fail = np.concatenate([[0, 0], np.zeros(words, np.int64), np.where(c1[last - 2] > 0, last, 0)])
        weight = np.concatenate([[1.0], np.full(1 + words, mu[0]), np.full(pairs, mu[1])])
        with np.errstate(divide="ignore"):
            self.loss = np.log10(weight / (self.mass + weight))
            p1 = (c1 + 1) / (n + v + 1)
            p2 = (c2 + mu[0] * p1[last - 2]) / (self.mass[from_state] + mu[0])
            inside = triple >= 0
            kind = triple[inside], len(c3)
            history, short = at(kind, np.roll(pair, 1)[inside]), at(kind, pair[inside])
            p3 = (c3 + mu[1] * p2[short]) / (c2[history] + mu[1])
            self.arcs = [np.log10(p1), np.log10(np.where(c2 > 0, p2, 0)), np.log10(np.where(c3 > 0, p3, 0))]
        self.after = np.where(c2 > 0, 2 + words + np.arange(pairs), np.where(c1[last - 2] > 0, last, 0))

    def read(self, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known tokens, base scores and model scores of the texts.

        All tokens are read side by side: where an arc leads depends on the two words
        before it alone, so the states of a left-to-right walk are known at once.
        """
        word, pair, triple = self.block.at
        state = np.where(self.block.first, 1, self.after[np.roll(pair, 1)]) if len(pair) else pair
        total, open_ = np.zeros(len(word)), np.arange(len(word))
        while len(open_):
            s = state[open_]
            order = np.where(s >= self.pair0, 2, np.where(s > 0, 1, 0))
            arc = np.full(len(s), -np.inf)
            for k, gram in enumerate((word, pair, triple)):
                some = order == k
                arc[some] = self.arcs[k][gram[open_[some]]]
            none = np.isneginf(arc)
            total[open_] += np.where(none, self.loss[s], arc)
            state[open_] = self.fail[s]
            open_ = open_[none]
        add = lambda x: np.bincount(self.block.row, weights=x, minlength=rows)
        return add(self.known[word]).astype(np.int64), add(self.arcs[0][word]), add(total)


def _scatter(kind: tuple[np.ndarray, int], values: np.ndarray) -> np.ndarray:
    """One value for each n-gram from those at its places, which are all alike."""
    number, n = kind
    out = np.zeros(n, np.int64)
    out[number] = values
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, mu: tuple[float, float] = (MU, MU_PAIR)) -> DataFrame:
    """Log10 probabilities of all texts under a model of those outside the held-out fold.

    The fold is crc32 of the id as text, modulo ``folds``.  One row for each input row:
    ``id_col``, ``held_out``, ``n_tokens`` (with the end), ``n_known``,
    ``train_tokens``, ``base_score`` (the root alone) and ``score``.  A null or empty
    text is its end token; a null id counts as the empty text for its fold; repeated
    rows are counted and scored each; with nothing to train on every token is unknown.
    A very long text is a block of its own.  Other columns are ignored, whatever their
    names.  Words and n-grams are told apart by 64-bit hashes.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fold = F.crc32(F.coalesce(col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"), (fold != held).alias("train"))
    buckets = max(1, -(-total_bytes(rows, "text") // BUCKET_BYTES))
    blocks = settled(rows.mapInArrow(_packed, "block long, data binary"), "blocks")
    asked = blocks.mapInArrow(_requests(buckets), "block long, bucket int, data binary")
    told = settled(asked.groupBy("bucket").applyInArrow(_answer, "block long, bucket int, data binary, distinct long, tokens long"), "counts")
    v, n = told.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    starts = rows.filter("train").count()

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        held_ = _opened(left["data"][0])
        block = Block(held_, buckets)
        parts: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] for _ in range(ORDERS)]
        for _, data in sorted(zip(right["bucket"].to_pylist(), right["data"].to_pylist())):  # buckets are ranges: their answers follow each other
            raw, at = inflate(data), 0
            for k in range(ORDERS):
                x, at = _numbers(raw, at)
                parts[k].append(x)
        total = np.bincount(block.row)
        known, base, model = Automaton(block, [np.concatenate(p) for p in parts], starts, n, v, mu).read(len(total))
        table = pa.Table.from_batches(held_)
        return pa.table(
            {
                "id": table["id"], "held_out": pa.array(~table["train"].to_numpy()), "n_tokens": pa.array(total, pa.int64()), "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array(np.full(len(total), n), pa.int64()), "base_score": pa.array(base), "score": pa.array(model),
            }
        )

    out = blocks.groupBy("block").cogroup(told.select("block", "bucket", "data").groupBy("block")).applyInArrow(
        read, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.withColumnRenamed("id", id_col)
