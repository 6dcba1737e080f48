"""Shared pieces of the text operators: shared-folder scratch space and numpy word tables.

The word tables work on the raw UTF-8 bytes of an Arrow string column, so a batch is
split, hashed and windowed by a few array operations instead of a loop over words.  A
single long text is read in steps, so what it takes beside its own bytes is a few
numbers for each word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import release, scratch, settled, shared_folder  # noqa: F401  (the operators take them from here)

#: Bytes of text that one array pass works on; a longer single text is taken whole.
SLICE_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Words of the quality, dedup and language-model operators: runs without ASCII white space.
SOLID = ~SPACE
#: Words of the decontamination operator: ASCII digits, lower-case letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[ord("0") : ord("9") + 1] = True
ALNUM[ord("a") : ord("z") + 1] = True
ALNUM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_key(text: Column) -> Column:
    """A 64-bit key that tells apart rows which share an id but not a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def total_bytes(df: DataFrame, text_col: str) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(col(text_col)).cast("long")), F.lit(0))).first()[0]


# ---------------------------------------------------------------- word tables


def slices(batch: pa.RecordBatch, text_col: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``most`` bytes of text, or one row."""
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text_col))), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(size, dtype=np.int64), 0
    while at < len(size):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def raw_text(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array, and where each row begins in them (with the end); nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
    return whole, (at - at[0]) if len(texts) else np.zeros(1, np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: Bytes of a text that one step of the word tables looks at, words that one step hashes, and the longest word hashed side by side with others.
_STEP, _STEP_WORDS, _LONG = 4 << 20, 1 << 18, 64
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


class Words:
    """The words of some texts as arrays: ``start`` and ``end`` in ``raw``, ``doc`` (row of the text), ``first`` (first word of each row, with the end)."""

    def __init__(self, texts: pa.Array, inside: np.ndarray = SOLID, lower: bool = False):
        self.raw, self.at = raw_text(texts)
        if lower:
            self.raw = LOWER[self.raw]
        n = len(self.raw)
        edge = np.zeros(n + 1, bool)  # a text begins here
        edge[self.at] = True
        start, end = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in range(0, n, _STEP):
            b = min(n, a + _STEP)
            is_word = np.zeros(b - a + 2, bool)  # with a byte on either side
            is_word[1:-1] = inside[self.raw[a:b]]
            is_word[0], is_word[-1] = a > 0 and inside[self.raw[a - 1]], b < n and inside[self.raw[b % n]]
            start.append(np.flatnonzero(is_word[1:-1] & (~is_word[:-2] | edge[a:b])) + a)
            end.append(np.flatnonzero(is_word[1:-1] & (~is_word[2:] | edge[a + 1 : b + 1])) + a + 1)
        self.start, self.end = np.concatenate(start), np.concatenate(end)
        self.first = np.searchsorted(self.start, self.at).astype(np.int64)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: eight bytes after eight are mixed into a state that begins with the length.

        Words of more than 64 bytes are hashed one by one by BLAKE2b.
        """
        out = np.empty(len(self), np.uint64)
        padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.raw) + 1, np.dtype("<u8"), padded, strides=(1,))
        for a in range(0, len(out), _STEP_WORDS):
            start = self.start[a : a + _STEP_WORDS]
            size = self.end[a : a + _STEP_WORDS] - start
            h = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
            live = np.flatnonzero(size <= _LONG)
            done = 0
            while len(live):
                rest = size[live] - done
                h[live] = mix(h[live] ^ (eight[start[live] + done] & _MASKS[np.minimum(rest, 8)]))
                live = live[rest > 8]
                done += 8
            for i in np.flatnonzero(size > _LONG).tolist():
                word = self.raw[start[i] : start[i] + size[i]].tobytes()
                h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            out[a : a + _STEP_WORDS] = h
        return out

    def numbered(self) -> tuple[np.ndarray, list[str]]:
        """The number of each word, equal for equal words only, and the distinct words by their numbers; no word holds a space."""
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.end - self.start, out=offsets[1:])
        words = pa.Array.from_buffers(pa.large_string(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.raw[self.inside()])]).dictionary_encode()
        empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        lines = raw_text(pc.binary_join_element_wise(words.dictionary, empty, space))[0]  # a space behind each
        return words.indices.to_numpy(), lines.tobytes().decode("utf-8").split(" ")[:-1]

    def inside(self) -> np.ndarray:
        """Which bytes belong to words."""
        keep = np.zeros(len(self.raw) + 1, np.int8)
        keep[self.start] += 1
        keep[self.end] -= 1  # a word that begins where another text's word ends adds up to none
        return np.cumsum(keep[:-1], dtype=np.int8).astype(bool)

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``k`` consecutive words, one for each word, and whether those words lie in one text."""
        return grams(hashes, k), self.whole(k)

    def whole(self, k: int) -> np.ndarray:
        ok = np.zeros(len(self.doc), bool)
        if len(ok) >= k:
            ok[: len(ok) - k + 1] = self.doc[k - 1 :] == self.doc[: len(ok) - k + 1]
        return ok

    def packed(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words joined by one space, and where each begins and ends there."""
        size = self.end - self.start
        begin = np.zeros(len(size), np.int64)
        np.cumsum(size[:-1] + 1, out=begin[1:])
        out = np.full(int(size.sum() + max(0, len(size) - 1)), 32, np.uint8)
        gap = np.ones(len(out), bool)
        gap[(begin + size)[:-1]] = False
        out[gap] = self.raw[self.inside()]
        return out.tobytes(), begin, begin + size


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(len(hashes), np.uint64)
    n = len(hashes) - k + 1
    if n > 0:
        x = np.zeros(n, np.uint64)
        for j in range(k):
            x += hashes[j : j + n] * np.uint64((0xA0761D6478BD642F + 2 * j * 0x589965CC75374CC3) % (1 << 64) | 1)
        out[:n] = mix(x)
    return out


def deflate(raw: bytes, level: int = 3) -> bytes:
    """zstd with the length in front."""
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def inflate(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
