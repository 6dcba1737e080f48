"""Token-id files compressed by Re-Pair grammars.

Documents are dealt out in ascending id order, encoded with the tokenizers library and
cut into shards.  In each shard the frequent pairs of adjacent symbols are replaced by
new nonterminals, round after round, until no pair is frequent; a shard stores its rules, the number of ids each
rule expands to, and the remaining sequence, so any range of ids is decoded by finding
its first symbol from the expansion lengths and expanding only the symbols needed.

The files are Parquet rows with one shard each, written through Spark's committer, so
a task that is lost and repeated leaves no half-written shard behind:

    part, shard     place in the order of all shards
    n_docs, n_ids   documents and ids in the shard
    docs, counts    64-bit document ids (0 where null, see nulls) and 32-bit id counts
    nulls           one byte for each document, 1 if its id is null
    rules, lengths  pairs of 32-bit symbols, and the ids each rule expands to
    symbols         the compressed sequence; a symbol of at least ``base`` is a rule

Binary columns are zstd frames behind their length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import NOT_PLAIN, UnitTable, byte_letters, vocabulary_path
from .common import col, column, deflate, inflate, scratch, slices, total_bytes

END = 2
#: Ids of a shard, about; a document is never cut.
SHARD_IDS = 1 << 20
#: Text for each output partition.
PART_BYTES = 24 << 20
#: A pair is replaced if it occurs so often in its shard.
FREQUENT = 24
_CELLS = 1 << 16

SHARDS = "part int, shard int, base int, n_docs long, n_ids long, docs binary, nulls binary, counts binary, rules binary, lengths binary, symbols binary"


def re_pair(ids: np.ndarray, base: int, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (pairs of symbols), ids that each expands to, and the compressed sequence.

    Rounds go on until no pair of adjacent symbols occurs FREQUENT times, or for
    ``rounds`` at most if given.
    """
    seq = ids.astype(np.uint32)
    rules, lengths, top = [np.zeros((0, 2), np.uint32)], np.zeros(0, np.int64), base
    live = np.arange(max(0, len(seq) - 1))  # places whose pairs may be frequent: all places of such a pair are among them
    while len(live) and (rounds is None or len(rules) <= rounds):
        key = (seq[live].astype(np.uint64) << np.uint64(32)) | seq[live + 1]
        cell = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
        some = np.flatnonzero(np.bincount(cell, minlength=_CELLS)[cell] >= FREQUENT)  # a cell counts at least its pairs
        pairs, which, n = np.unique(key[some], return_inverse=True, return_counts=True)
        rank = np.empty(len(n), np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(n))
        hit = n[which] >= FREQUENT
        at, which = live[some[hit]], which[hit]
        taken = _apart(at, rank[which])
        uses = np.bincount(which[taken], minlength=len(n))
        # a pair whose places mostly went to more frequent ones waits; the most frequent always has half of its places
        chosen = np.flatnonzero(uses >= FREQUENT // 2)
        if not len(chosen):
            break
        symbol = np.full(len(pairs), -1, np.int64)
        symbol[chosen] = top + np.arange(len(chosen))
        taken = taken[symbol[which[taken]] >= 0]
        gone = at[taken]
        seq[gone] = symbol[which[taken]]
        changed = np.zeros(len(seq), bool)
        changed[at] = changed[gone] = True
        changed[np.maximum(gone - 1, 0)] = True  # the pair that ends in the new symbol
        left = np.ones(len(seq), bool)
        left[gone + 1] = False
        seq = seq[left]
        live = np.flatnonzero(changed[left][:-1])
        made = np.stack([pairs[chosen] >> np.uint64(32), pairs[chosen] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
        size = np.where(made < base, 1, lengths[np.maximum(made.astype(np.int64) - base, 0)] if len(lengths) else 1).sum(axis=1)
        rules.append(made)
        lengths = np.concatenate([lengths, size])
        top += len(chosen)
    return np.concatenate(rules), lengths, seq


def _apart(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Indexes of places of which no two overlap, taken by rank; of overlapping places of one pair every second, from the left."""
    out, rest = [], np.arange(len(at))
    follows = (np.diff(at, prepend=-2) == 1) & (np.diff(rank, prepend=-1) == 0)
    run = np.flatnonzero(~follows)
    rest = rest[(rest - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
    while len(rest):
        a, r = at[rest], rank[rest]
        joint = np.diff(a) == 1
        lost = np.zeros(len(rest), bool)
        lost[1:] |= joint & (r[:-1] < r[1:])
        lost[:-1] |= joint & (r[1:] < r[:-1])
        won = ~lost
        out.append(rest[won])
        beside = np.zeros(len(rest), bool)
        beside[1:] |= joint & won[:-1]
        beside[:-1] |= joint & won[1:]
        rest = rest[lost & ~beside]
    return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids of some symbols: rules are written out from the first on, as each uses only earlier ones."""
    size = np.ones(len(rules), np.int64)
    flat, starts = [], np.zeros(len(rules) + 1, np.int64)
    done = 0
    parts = rules.astype(np.int64) - base
    while done < len(rules):  # one layer: rules whose parts are all done
        deep = parts[done:].max(axis=1)
        stop = done + (int(np.argmax(deep >= done)) if (deep >= done).any() else len(deep))
        layer = parts[done:stop]
        own = np.where(layer < 0, 1, size[np.maximum(layer, 0)])
        size[done:stop] = own.sum(axis=1)
        starts[done + 1 : stop + 1] = starts[done] + np.cumsum(size[done:stop])
        flat.append(_written((layer + base).reshape(-1), np.concatenate(flat) if flat else np.zeros(0, np.uint32), starts, size, base))
        done = stop
    return _written(symbols.astype(np.int64), np.concatenate(flat) if flat else np.zeros(0, np.uint32), starts, size, base)


def _written(symbols: np.ndarray, flat: np.ndarray, starts: np.ndarray, size: np.ndarray, base: int) -> np.ndarray:
    """Ids of symbols from the written rules."""
    rule = symbols >= base
    which = symbols[rule] - base
    n = np.ones(len(symbols), np.int64)
    n[rule] = size[which]
    ends = np.cumsum(n)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    out[ends[~rule] - 1] = symbols[~rule]
    m = n[rule]
    inner = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
    out[np.repeat(ends[rule] - m, m) + inner] = flat[np.repeat(starts[which], m) + inner]
    return out


def expand_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard, expanding only the symbols that hold them."""
    size = np.where(symbols < base, 1, lengths[np.maximum(symbols.astype(np.int64) - base, 0)] if len(lengths) else 1)
    ends = np.cumsum(size)
    a, b = np.searchsorted(ends, start, "right"), min(len(ends), int(np.searchsorted(ends, stop, "left")) + 1)
    skip = start - (ends[a - 1] if a else 0)
    return expand(symbols[a:b], rules, base)[skip : skip + stop - start]


class _Library:
    """The tokenizers library, asked once for each unit that a worker meets: the vocabulary's rules never look across white space.

    Pieces of plain words go to the library's model, which takes them as letters that
    stand for bytes; other words go through all of its steps.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        letters = byte_letters()
        self.letters = {ord(c): "".join(letters[b] for b in c.encode("utf-8")) for c in map(chr, range(0xC0, 0x100))}
        self.table = UnitTable(self.encode)

    def encode(self, units: list[str]) -> list[list[int]]:
        take, whole, letters = self.library.model.tokenize, self.library.encode, self.letters
        return [whole(x, add_special_tokens=False).ids if NOT_PLAIN.search(x) else [t.id for t in take(x if x.isascii() else x.translate(letters))] for x in units]

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text with END behind them; a null is an empty text."""
        flat, cuts = self.table.ids(texts)
        last = np.array([END], np.uint32)
        return [np.concatenate([flat[a:b].astype(np.uint32), last]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


_LIBRARIES: dict[str, _Library] = {}


def write_tokens(docs: DataFrame, out: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None) -> DataFrame:
    """Writes the token ids of all documents below ``out``, in ascending id order, and returns the files' rows.

    A null or empty text is the end id alone.  Null ids come first; rows that share an
    id are all written, side by side.  Other columns are ignored.
    """
    path = path or vocabulary_path()
    rows = docs.select(col(id_col).cast("long").alias("doc"), col(text_col).alias("text"))
    parts = max(1, -(-total_bytes(rows, "text") // PART_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LIBRARIES:
            _LIBRARIES[path] = _Library(path)
        library = _LIBRARIES[path]
        part, shard = TaskContext.get().partitionId(), 0
        docs_, ids_, held = [], [], 0
        for batch in batches:
            for piece in slices(batch):
                for d, x in zip(column(piece, "doc").to_pylist(), library.ids(column(piece, "text"))):
                    docs_.append(d)
                    ids_.append(x)
                    held += len(x)
                    if held >= SHARD_IDS:
                        yield _shard(part, shard, library.size, docs_, ids_, rounds)
                        docs_, ids_, held, shard = [], [], 0, shard + 1
        if docs_:
            yield _shard(part, shard, library.size, docs_, ids_, rounds)

    ordered = rows.repartitionByRange(parts, "doc").sortWithinPartitions("doc", "text")
    ordered.mapInArrow(run, SHARDS).write.parquet(out)
    return docs.sparkSession.read.schema(SHARDS).parquet(out)


def _shard(part: int, shard: int, base: int, docs: list[int | None], ids: list[np.ndarray], rounds: int | None) -> pa.RecordBatch:
    seq = np.concatenate(ids)
    rules, lengths, symbols = re_pair(seq, base, rounds)
    binary = lambda x: pa.array([deflate(x.tobytes())], pa.binary())
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "base": pa.array([base], pa.int32()),
            "n_docs": pa.array([len(docs)], pa.int64()), "n_ids": pa.array([len(seq)], pa.int64()),
            "docs": binary(np.array([d or 0 for d in docs], np.int64)), "nulls": binary(np.array([d is None for d in docs], np.uint8)),
            "counts": binary(np.array([len(x) for x in ids], np.uint32)), "rules": binary(rules), "lengths": binary(lengths.astype(np.uint32)), "symbols": binary(symbols),
        }
    )


def read_tokens(spark: SparkSession, out: str, start: int = 0, stop: int | None = None, id_col: str = "doc_id", crc: bool = False) -> DataFrame:
    """Documents of the files below ``out``: ``id_col``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (little-endian 32-bit), or instead of these their CRC-32 as ``ids_crc32``.

    With ``start`` and ``stop`` only documents that hold an id in that range are
    decoded; shards outside it are skipped by their counts.
    """
    shards = spark.read.schema(SHARDS).parquet(out)
    sizes = {r.part: r.n for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # one number for each output partition
    before, total = {}, 0
    for p in sorted(sizes):
        before[p], total = total, total + sizes[p]
    bases = spark.createDataFrame(list(before.items()) or [(0, 0)], "part int, before long")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "shard", "n_ids").join(F.broadcast(bases), "part").select("part", "shard", "n_ids", (F.col("before") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("first"))
    places = places.filter((F.col("first") + F.col("n_ids") > start) & (F.col("first") < (total if stop is None else stop))).drop("n_ids")
    last = total if stop is None else stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: column(batch, n)[r].as_py() for n in batch.schema.names}
                load = lambda n, kind: np.frombuffer(inflate(row[n]), kind)
                docs, nulls, counts = load("docs", np.int64), load("nulls", np.uint8), load("counts", np.uint32).astype(np.int64)
                rules, lengths, symbols = load("rules", np.uint32).reshape(-1, 2), load("lengths", np.uint32), load("symbols", np.uint32)
                ends = np.cumsum(counts)
                begins = ends - counts
                some = np.flatnonzero((begins + row["first"] < last) & (ends + row["first"] > start))
                a, b = begins[some[0]], ends[some[-1]]
                ids = expand_range(symbols, rules, lengths, row["base"], int(a), int(b)).astype("<u4")
                raw = memoryview(ids.tobytes())
                own = [raw[4 * x : 4 * y] for x, y in zip((begins[some] - a).tolist(), (ends[some] - a).tolist())]
                last_ = pa.array([zlib.crc32(x) for x in own], pa.int64()) if crc else pa.array([bytes(x) for x in own], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(docs[some], pa.int64(), mask=nulls[some].astype(bool)), pa.array(begins[some] + row["first"]), pa.array(counts[some]), last_], names=["doc", "start", "n_tokens", "ids"])

    found = shards.join(places, ["part", "shard"]).mapInArrow(run, f"doc long, start long, n_tokens long, ids {'long' if crc else 'binary'}")
    return found.withColumnsRenamed({"doc": id_col} | ({"ids": "ids_crc32"} if crc else {}))


def token_files(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None, crc: bool = False) -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    out = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, out, path, id_col, text_col, rounds)
    return read_tokens(docs.sparkSession, out, id_col=id_col, crc=crc)
