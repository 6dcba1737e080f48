"""Substring dedup by super-k-mers.

A window is 20 consecutive words.  Its minimiser is the best of the 3-word grams in
it, where grams that are rare in the corpus come first and a hash breaks ties.
Consecutive windows with the same minimiser travel together as one packed string to
the bucket of that minimiser, so equal windows always meet and the words are not
repeated once per window.  In its bucket every window is put in order with its equals
and all but the first occurrence are marked.

Skew: equal packed strings of one task are merged before the shuffle, as far as a table
of recent strings reaches, their later occurrences being settled on the spot; a bucket
merges the equal strings of all tasks while it reads them, so it holds each different
string once, however often it occurs.  Gram frequencies come from a count sketch of
fixed size over all documents, so a gram that a third of the rows share is a
minimiser only where the whole window is shared, and there the strings are equal.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, Words, col, column, deflate, grams, inflate, slices, text_key, total_bytes

WINDOW = 20
GRAM = 3
#: zstd level of the packed strings, which are most of what is moved.
LEVEL = 10
#: Cells of the gram sketch; its size does not depend on the data.
CELLS = 1 << 20
#: Bytes of text for each bucket; a bucket holds about three times as much packed text.
BUCKET_BYTES = 6 << 20
#: Bytes of recent strings that a task keeps to settle their later occurrences; at most twice as many are held.
RECENT_BYTES = 12 << 20


class Recent:
    """Where strings of a task were last seen first, in two generations, of which the older one is forgotten."""

    def __init__(self, limit: int = RECENT_BYTES):
        self.limit, self.size = limit, 0
        self.new: dict[bytes, tuple[int, int]] = {}
        self.old: dict[bytes, tuple[int, int]] = {}

    def later(self, string: bytes, at: tuple[int, int]) -> bool:
        """Whether an equal string was sent from an earlier place; if not, this place is remembered."""
        first = self.new.get(string)
        if first is None:
            first = self.old.get(string, at)
            self.size += len(string)
            if self.size > self.limit:
                self.old, self.new, self.size = self.new, {}, len(string)
        self.new[string] = min(first, at)
        return first < at


def _sketch(docs: DataFrame, gram: int) -> np.ndarray:
    """Per cell the bit length of the number of grams that fall there, over all documents: CELLS bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch):
                words = Words(column(part, "text"))
                g, ok = words.grams(words.hashes(), gram)
                cells += np.bincount((g[ok] & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        for block, x in enumerate(cells.reshape(64, -1)):
            if x.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "counts": pa.array([deflate(x.tobytes())], pa.binary())})

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS // 64, np.int64)
        for batch in batches:
            for x in column(batch, "counts"):
                total += np.frombuffer(inflate(x.as_py()), np.int64)
        bits = np.ceil(np.log2(total + 1)).astype(np.uint8)
        yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    parts = docs.select("text").mapInArrow(count, "block int, counts binary")
    out = np.zeros((64, CELLS // 64), np.uint8)
    for row in parts.groupBy("block").applyInArrow(add, "block int, bits binary").collect():  # CELLS bytes in all
        out[row.block] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def _minimisers(h: np.ndarray, bits: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The minimiser of the window that begins at each word (of meaning only where the window fits)."""
    g = grams(h, gram)
    order = (g >> np.uint64(6)) | (bits[(g & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(58))
    n, wide = len(order) - (window - gram), window - gram + 1
    if n <= 0:
        return order
    best, have = order, 1
    while have < wide:  # minima over have words grow to minima over wide words
        step = min(have, wide - have)
        best = np.minimum(best[: len(best) - step], best[step:])
        have += step
    return best


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Where windows begin that occur earlier too: rows ``(doc, same, spans)``.

    ``same`` is ``text_key`` of the text.  ``spans`` holds pairs of 32-bit integers, the
    first word and the number of consecutive repeated windows.  A document may have
    several rows, and none if nothing in it is repeated.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"{id_col} must be an integer, not {kind}")
    texts = docs.select(col(id_col).cast("long").alias("doc"), text_key(col(text_col)).alias("same"), col(text_col).alias("text")).filter("doc is not null and text is not null")
    buckets = max(8, -(-total_bytes(texts, "text") // BUCKET_BYTES))
    bits = _sketch(texts, gram)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = Recent()
        for batch in batches:
            for part in slices(batch):
                yield from _cut_slice(part, bits, window, gram, buckets, recent)

    def settle(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key[0].as_py() < 0:  # spans that a slice has settled itself
            for b in batches:
                yield pa.RecordBatch.from_arrays([column(b, n) for n in ("doc", "same", "data")], names=["doc", "same", "spans"])
        else:
            blobs = (inflate(x.as_py()) for b in batches for x in column(b, "data"))
            for found in _settle(blobs, window):
                yield from _span_rows(*found)

    packed = texts.mapInArrow(cut, "bucket int, doc long, same long, data binary")
    return packed.groupBy("bucket").applyInArrow(settle, "doc long, same long, spans binary")


def _cut_slice(part: pa.RecordBatch, bits: np.ndarray, window: int, gram: int, buckets: int, recent: Recent) -> Iterator[pa.RecordBatch]:
    """Packed strings of one slice by bucket; rows of buckets below 0 hold spans that are settled already."""
    words = Words(column(part, "text"))
    if not len(words):
        return
    doc, same = column(part, "doc").to_numpy(), column(part, "same").to_numpy()
    best = _minimisers(words.hashes(), bits, window, gram)
    at = np.flatnonzero(words.whole(window))
    if not len(at):
        return
    new = np.ones(len(at), bool)
    new[1:] = (best[at[1:]] != best[at[:-1]]) | (np.diff(at) > 1)
    lead = np.flatnonzero(new)
    first, count = at[lead], np.diff(np.append(lead, len(at)))
    text, begin, end = words.packed()
    strings = [text[a:b] for a, b in zip(begin[first].tolist(), end[first + count + window - 2].tolist())]
    row = words.doc[first]
    ids, keys, place = doc[row], same[row], first - words.first[row]
    order = np.lexsort((place, ids))
    keep, late = [], []
    for i, at_ in zip(order.tolist(), zip(ids[order].tolist(), place[order].tolist())):
        (late if recent.later(strings[i], at_) else keep).append(i)
    keep_at = np.array(keep, np.int64)
    bucket = (best[first[keep_at]] % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[by], prepend=-1))
    names, data = [], []
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(by)]):
        some = keep_at[by[a:b]]
        own = [strings[i] for i in some.tolist()]
        head = np.array([len(some)], np.int64).tobytes()
        data.append(deflate(head + ids[some].tobytes() + keys[some].tobytes() + place[some].astype(np.int32).tobytes() + np.fromiter(map(len, own), np.int32, len(own)).tobytes() + b"".join(own), LEVEL))
        names.append(int(bucket[by[a]]))
    none = pa.nulls(len(names), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), none, none, pa.array(data, pa.binary())], names=["bucket", "doc", "same", "data"])
    if late:
        x = np.array(late)
        for b in _span_rows(ids[x], keys[x], place[x], count[x]):
            spread = -1 - (column(b, "doc").to_numpy() % 64).astype(np.int32)  # settled spans need no meeting: any group will do
            yield pa.RecordBatch.from_arrays([pa.array(spread, pa.int32()), *b.columns], names=["bucket", "doc", "same", "data"])


#: Places of repeated strings that a bucket gathers before it hands them on.
LATE_ROWS = 1 << 16


def _settle(blobs: Iterable[bytes], window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Repeated windows of one bucket: document, text key, first word and number of windows of each run, in portions.

    Of equal strings only those of the first place are held; the others are repeated
    through and through and go out while the bucket is read.
    """
    first: dict[bytes, list[tuple[int, int, int]]] = {}
    late: list[tuple[int, int, int, int]] = []
    for x in blobs:
        n = int.from_bytes(x[:8], "little")
        ids, keys, place = np.frombuffer(x, np.int64, n, 8).tolist(), np.frombuffer(x, np.int64, n, 8 + 8 * n).tolist(), np.frombuffer(x, np.int32, n, 8 + 16 * n).tolist()
        ends = np.cumsum(np.frombuffer(x, np.int32, n, 8 + 20 * n), dtype=np.int64) + 8 + 24 * n
        for doc_, key, at_, a, b in zip(ids, keys, place, [8 + 24 * n, *ends[:-1].tolist()], ends.tolist()):
            string, here = x[a:b], (doc_, at_, key)
            held = first.setdefault(string, [])
            if not held or held[0][:2] == here[:2]:
                if here not in held:
                    held.append(here)
                continue
            if here[:2] < held[0][:2]:
                first[string], gone = [here], held
            else:
                gone = [here]
            count = string.count(b" ") + 2 - window
            late += [(d, k, p, count) for d, p, k in gone]
        if len(late) >= LATE_ROWS:
            yield _columns(late)
            late = []
    if late:
        yield _columns(late)
    texts = [s for s, held in first.items() for _ in held]
    doc, start, same = (np.array(v, np.int64) for v in zip(*(h for held in first.values() for h in held)))
    del first
    rows: list[int] = []
    raws, of, h, at, to, row, place_ = [], [], [], [], [], [], []
    for part in _portions(range(len(texts)), texts):
        table = Words(_as_text([texts[i] for i in part]))
        k = np.flatnonzero(table.whole(window))
        owner = np.array(part, np.int64)[table.doc[k]]
        h.append(grams(table.hashes(), window)[k])
        at.append(table.start[k].astype(np.int32))
        to.append(table.end[k + window - 1].astype(np.int32))
        of.append(np.full(len(k), len(raws), np.int32))
        row.append(owner)
        place_.append(k - table.first[table.doc[k]])
        raws.append(table.raw.tobytes())
    h, at, to, of, row, place_ = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (h, at, to, of, row, place_))
    d, p = doc[row], start[row] + place_
    by = np.lexsort((p, d, h))
    twin = np.zeros(len(by), bool)
    if len(by) > 1:
        equal = h[by][1:] == h[by][:-1]
        twin[1:] |= equal
        twin[:-1] |= equal
    firsts: dict[bytes, tuple[int, int]] = {}
    last = None
    for i in by[twin].tolist():
        if h[i] != last:
            firsts, last = {}, h[i]
        here = (int(d[i]), int(p[i]))
        if firsts.setdefault(raws[of[i]][at[i] : to[i]], here) != here:  # the words themselves decide
            rows.append(i)
    if rows:
        r = np.array(rows, np.int64)
        yield d[r], same[row[r]], p[r], np.ones(len(r), np.int64)


def _columns(rows: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, ...]:
    return tuple(np.array(v, np.int64) for v in zip(*rows))


def _portions(which: Iterable[int], strings: list[bytes]) -> Iterator[list[int]]:
    """Parts of ``which`` with about SLICE_BYTES of strings each."""
    part, size = [], 0
    for i in which:
        part.append(i)
        size += len(strings[i])
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _as_text(parts: list[bytes]) -> pa.Array:
    """Bytes that are UTF-8 already, as a string array without another look at them."""
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)), out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), len(parts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(parts))])


def _span_rows(doc: np.ndarray, same: np.ndarray, start: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each document; runs that touch are joined."""
    if not len(doc):
        return
    by = np.lexsort((start, same, doc))
    doc, same, start, count = doc[by], same[by], start[by], count[by]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (same[1:] != same[:-1])
    head = other.copy()
    head[1:] |= start[1:] != (start + count)[:-1]
    lead = np.flatnonzero(head)
    runs = np.stack([start[lead], np.add.reduceat(count, lead)], axis=1).astype(np.int32)
    cuts = np.flatnonzero(other[lead])
    ends = [*cuts[1:].tolist(), len(lead)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc[lead[cuts]], pa.int64()), pa.array(same[lead[cuts]], pa.int64()), pa.array([runs[a:b].tobytes() for a, b in zip(cuts.tolist(), ends)], pa.binary())],
        names=["doc", "same", "spans"],
    )


def removed_words(spans: list[bytes] | None, n_words: int, window: int) -> np.ndarray:
    """Which words of a text are covered by repeated windows."""
    edge = np.zeros(n_words + window + 1, np.int64)
    for x in spans or ():
        a = np.frombuffer(x, np.int32).reshape(-1, 2).astype(np.int64)
        np.add.at(edge, a[:, 0], 1)
        np.add.at(edge, a.sum(axis=1) + window - 1, -1)
    return np.cumsum(edge)[:n_words] > 0


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, keep: tuple[str, ...] = (), digest_only: bool = False) -> DataFrame:
    """Removes every word that lies in a window which occurs earlier too (smaller id, or earlier in the same document).

    Returns ``id_col``, the columns ``keep``, ``n_words``, ``n_removed``, ``kept_text``
    (the kept stretches of the text as they are, joined by one space) and
    ``kept_sha256`` of the kept words joined by one space; ``digest_only`` leaves
    ``kept_text`` out.  Windows are judged on the input.  A text of fewer than
    ``window`` words, a null text (taken as empty) and a row with a null id keep all
    their words; rows that share an id count as one document, so an exact repetition of
    a row removes nothing.  Other columns are ignored, whatever their names.
    """
    repeats = find_repeats(docs, id_col, text_col, window, gram)
    spans = repeats.groupBy("doc", "same").agg(F.collect_list("spans").alias("spans"))
    rows = docs.select(
        col(id_col).cast("long").alias("id"), text_key(col(text_col)).alias("key"), col(text_col).alias("text"), *[col(k).alias(f"keep{i}") for i, k in enumerate(keep)]
    )
    joined = rows.join(spans, (rows.id == spans.doc) & (rows.key == spans.same), "left").drop("doc", "same", "key")
    kept = [f for f in joined.schema.fields if f.name.startswith("keep")]
    schema = T.StructType([T.StructField("id", T.LongType()), *kept, *[T.StructField(n, t) for n, t in (("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_text", T.StringType()), ("kept_sha256", T.StringType())) if n != "kept_text" or not digest_only]])

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = defaultdict(list)
                for text, found in zip(column(part, "text").to_pylist(), column(part, "spans").to_pylist()):
                    raw = (text or "").encode("utf-8")
                    words = raw.split()
                    gone = 0
                    if found:
                        mark = removed_words(found, len(words), window)
                        gone = int(mark.sum())
                        if not digest_only:
                            raw = _stretches(text, mark)
                        words = [w for w, m in zip(words, mark.tolist()) if not m]
                    out["n_words"].append(len(words) + gone)
                    out["n_removed"].append(gone)
                    out["kept_sha256"].append(hashlib.sha256(b" ".join(words)).hexdigest())
                    if not digest_only:
                        out["kept_text"].append(text or "" if not found else raw)
                yield pa.RecordBatch.from_arrays([*[column(part, f.name) for f in schema.fields if f.name not in out], *[pa.array(out[f.name], pa.int64() if f.name[:2] == "n_" else pa.string()) for f in schema.fields if f.name in out]], names=[f.name for f in schema.fields])

    out = joined.mapInArrow(cover, schema)
    for name, f in zip(keep, kept):
        out = out.withColumnRenamed(f.name, name)
    return out.withColumnRenamed("id", id_col)


def _stretches(text: str, gone: np.ndarray) -> str:
    """What is left of a text: its kept stretches, white space within them unchanged."""
    words = Words(pa.array([text], pa.string()))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
    raw = words.raw
    return " ".join(raw[words.start[a] : words.end[b - 1]].tobytes().decode("utf-8") for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()))
