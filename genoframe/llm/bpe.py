"""BPE encoding and decoding with a public word-level vocabulary.

Each white-space-delimited word is normalised, split and merged on its own, as the
vocabulary's rules never look across white space.  A short piece holds its part
boundaries and the ranks of adjacent parts in two small contiguous arrays: the lowest
rank is found by scanning, its boundary is deleted and the two neighbouring ranks are
refreshed.  Many short pieces go through this side by side, as rows of two matrices; a
long one keeps the boundaries in linked arrays and the ranks in a heap.
What has been encoded is kept in a bounded table per Python worker, a document's ids
are gathered from it, and its text is decoded from its ids.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import LOWER, SPACE, Words, col, column, raw_text, slices

VOCABULARY = "word_bpe_49k.json"
#: Bytes of a piece that is merged with many others at once; longer ones go one by one.
SHORT = 32
#: Rank of parts that don't merge.
NONE = np.int32(2**31 - 1)
#: Units whose ids a worker keeps; beyond it the table starts anew.
KEPT_UNITS = 800_000


_SPACE, _LETTER, _DIGIT, _MARK, _ODD, _WHOLE = range(6)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127], _KIND[SPACE] = _MARK, _SPACE
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[ord("'")] = _ODD
#: Units that are not pieces of plain words.
NOT_PLAIN = regex.compile(r"[^!-&(-~\xDF-\xF6\xF8-\xFF]|<\|")


class Units(Words):
    """What texts are encoded by: the lower-cased pieces of plain words, and other words whole.

    A plain word holds letters of ASCII and Latin-1, digits and ASCII marks other than
    the apostrophe, and no special token.  The vocabulary cuts it into runs of letters,
    single digits and runs of marks.
    """

    def __init__(self, texts: pa.Array):
        raw, self.at = raw_text(texts)
        kind = _KIND[raw]
        pair = np.flatnonzero(raw == 0xC3)  # with the next byte a letter of U+00C0 to U+00FF, or one of the two signs there
        second = raw[pair + 1]
        letter = (second != 0x97) & (second != 0xB7)
        kind[pair[letter]] = kind[pair[letter] + 1] = _LETTER
        self.raw = LOWER[raw]
        self.raw[pair[letter & (second < 0x9F)] + 1] += 32
        bar = np.flatnonzero(raw[1:] == ord("|"))
        bar = bar[raw[bar] == ord("<")]
        kind[bar[~np.isin(bar + 1, self.at)]] = _ODD  # of one text
        if (kind == _ODD).any():
            odd = np.concatenate([[0], np.cumsum(kind == _ODD)])
            words = Words(texts)
            whole = odd[words.end] > odd[words.start]
            self.start, self.end = words.start[whole], words.end[whole]
            inside = self.inside()
            self.raw[inside] = raw[inside]
            kind[inside] = _WHOLE
        other = np.ones(len(raw) + 1, bool)  # another kind begins here, or another text
        np.not_equal(kind[1:], kind[:-1], out=other[1:-1])
        other[np.flatnonzero(kind == _DIGIT)] = True
        other[self.at] = True
        full = kind != _SPACE
        self.start, self.end = np.flatnonzero(other[:-1] & full), np.flatnonzero(other[1:] & full) + 1
        self.first = np.searchsorted(self.start, self.at).astype(np.int64)
        self.counts = np.diff(self.first)


class UnitTable:
    """Token ids of the distinct units that a worker has met, in one flat array; ``encode`` gives the ids of new ones."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = KEPT_UNITS):
        self.encode, self.most = encode, most
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, units: list[str]) -> None:
        ids = self.encode(units)
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units))))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids begin (with the end); nulls are empty."""
        units = Units(texts)
        number, names = units.numbered()
        known = list(map(self.place.get, names))
        if None in known:
            new = [w for w, k in zip(names, known) if k is None]
            if len(self.place) + len(new) > self.most:
                self._forget()
                new = names
            self._learn(new)
            known = list(map(self.place.__getitem__, names))
        which = np.array(known, np.int64)[number]
        begin = self.starts[which]
        n = self.starts[which + 1] - begin
        ends = np.concatenate([[0], np.cumsum(n)])
        return self.flat[np.repeat(begin - ends[:-1], n) + np.arange(ends[-1])], ends[units.first]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.pairs = {(self.ids[a], self.ids[b]): (r, self.ids[a + b]) for r, (a, b) in enumerate(merges)}
        keys = np.array([a << 32 | b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_rank, self.key_made = keys[order], order.astype(np.int32), np.array([x for _, x in self.pairs.values()], np.int32)[order]
        letters = byte_letters()
        self.first_ids, self.last_ids = np.array([self.ids[x] for x in letters], np.int32), np.array([self.ids[x + self.suffix] for x in letters], np.int32)
        self.regex = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.table = UnitTable(self.encode_units)
        size = max(self.tokens) + 1
        #: Each token and each decimal id with a space behind it.
        self.spoken = pa.array([self.tokens.get(i, "") + " " for i in range(size)], pa.large_string())
        self.written = pa.array([f"{i} " for i in range(size)], pa.large_string())

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one long piece: parts know their neighbours, ranks wait in a heap, the leftmost of equals first."""
        raw = np.frombuffer(piece, np.uint8)
        parts = [*self.first_ids[raw[:-1]].tolist(), int(self.last_ids[raw[-1]])]
        n, pairs = len(parts), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (found := pairs.get((a, b)))]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if j >= n or parts[i] != a or parts[j] != b:  # one of the two has been merged since
                continue
            parts[i], parts[j] = pairs[a, b][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := pairs.get((parts[i], parts[k])):
                    heappush(heap, (found[0], i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (found := pairs.get((parts[h], parts[i]))):
                heappush(heap, (found[0], h, parts[h], parts[i]))
        return [x for x in parts if x >= 0]

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of adjacent parts; parts that don't merge, or are absent, have rank NONE."""
        key = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.key_rank[at], NONE), np.where(hit, self.key_made[at], -1)

    def merge_short(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of many short pieces at once: a row of parts and a row of adjacent ranks for each."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        wide = int(size.max(initial=1)) + 1
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        row, place = np.repeat(np.arange(len(pieces)), size), np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
        parts = np.full((len(pieces), wide), -1, np.int32)
        parts[row, place] = self.first_ids[raw]
        parts[np.arange(len(pieces)), size - 1] = self.last_ids[raw[np.cumsum(size) - 1]]
        rank, made = self.look(parts[:, :-1], parts[:, 1:])
        out, live = parts.copy(), np.arange(len(pieces))
        while len(live):
            i = rank.argmin(axis=1)
            n = np.arange(len(live))
            going = rank[n, i] < NONE
            if not going.all():
                out[live[~going]] = parts[~going]
                live, parts, rank, made, i = live[going], parts[going], rank[going], made[going], i[going]
                n = np.arange(len(live))
                if not len(live):
                    break
            parts[n, i] = made[n, i]
            after = np.arange(wide - 1) + (np.arange(wide - 1) > i[:, None])  # parts without the one behind the boundary that goes
            parts[:, :-1] = np.take_along_axis(parts, after, 1)
            parts[:, -1] = -1
            after = np.minimum(np.arange(wide - 1) + (np.arange(wide - 1) >= i[:, None]), wide - 2)
            rank, made = np.take_along_axis(rank, after, 1), np.take_along_axis(made, after, 1)
            rank[:, -1], made[:, -1] = NONE, -1
            for j in (np.maximum(i - 1, 0), i):
                rank[n, j], made[n, j] = self.look(parts[n, j], parts[n, np.minimum(j + 1, wide - 1)])
        used = (out >= 0).sum(axis=1)
        return [x[:k] for x, k in zip(out.tolist(), used.tolist())]

    def split(self, word: str) -> list[str]:
        """The pieces of a word, lower-cased letter by letter (no final sigma); special tokens are pieces of their own."""
        out = []
        for part in self.marks.split(word) if self.marks and "<|" in word else (word,):
            if part in self.special:
                out.append(part)
            elif part:
                out += self.regex.findall(part.lower() if part.isascii() else "".join([c.lower() for c in unicodedata.normalize("NFC", part)]))
        return out

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Token ids of units: of their distinct pieces, short ones side by side."""
        cut = [self.split(x) if NOT_PLAIN.search(x) else (x,) for x in units]
        pieces = {x: x.encode("utf-8") for own in cut for x in own if x not in self.special}
        ids = {x: [i] for x, i in self.special.items()}
        short = sorted([x for x, raw in pieces.items() if len(raw) <= SHORT], key=lambda x: len(pieces[x]))
        for at in range(0, len(short), 8192):
            part = short[at : at + 8192]
            ids.update(zip(part, self.merge_short([pieces[x] for x in part])))
        for x, raw in pieces.items():
            if len(raw) > SHORT:
                ids[x] = self.merge(raw)
        return [ids[own[0]] if len(own) == 1 else [i for x in own for i in ids[x]] for own in cut]

    def encode(self, text: str | None) -> list[int]:
        return self.table.ids(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens of the ids, one space between; special tokens are kept."""
        ids = np.fromiter(ids, np.int64)
        return next(joined(self.spoken, ids, np.array([0, len(ids)]))).tobytes().decode("utf-8")


def joined(forms: pa.Array, ids: np.ndarray, cuts: np.ndarray) -> Iterator[memoryview]:
    """The forms of each document's ids, without the space behind the last; ``cuts`` says where a document's ids begin."""
    _, offsets, data = forms.take(pa.array(ids)).buffers()
    at = np.frombuffer(offsets, np.int64)[cuts]
    raw = memoryview(data) if data is not None else memoryview(b"")
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield raw[a : max(a, b - 1)]


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """One encoder for each file and worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decoded: bool = True) -> DataFrame:
    """Token ids of every document: ``id_col``, ``keep``, ``n_tokens``, ``ids`` and, if asked for, the ``decoded`` text.

    A null or empty text has no ids and decodes to the empty string.  Each row is on its
    own: repeated rows give repeated results, a null id is passed on, other columns are
    ignored, whatever their names.  No shuffle; a text is encoded whole, whatever its
    length, and a piece of any length takes time in proportion to n log n.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    names = ["id", *[f"keep{i}" for i in range(len(keep))]]
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for part in slices(batch):
                ids, cuts = bpe.table.ids(column(part, "text"))
                out = [pa.array(np.diff(cuts)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))]
                if decoded:
                    out.append(pa.array([str(x, "utf-8") for x in joined(bpe.spoken, ids, cuts)], pa.string()))
                yield pa.RecordBatch.from_arrays([*[column(part, x) for x in names], *out], names=[*names, "n_tokens", "ids", "decoded"][: len(names) + len(out)])

    chosen = docs.select(col(id_col).alias("id"), *[col(k).alias(n) for k, n in zip(keep, names[1:])], col(text_col).alias("text"))
    out = chosen.mapInArrow(run, ", ".join(f"{n} {kinds[k]}" for n, k in zip(names, [id_col, *keep])) + ", n_tokens long, ids array<int>" + ", decoded string" * decoded)
    for n, k in zip(names, [id_col, *keep]):
        out = out.withColumnRenamed(n, k)
    return out


def encode_digest(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` with the ids and the decoded text only as SHA-256: ``id_col``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    The decoded text is made from the document's ids; nothing but digests leaves the worker.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for part in slices(batch):
                ids, cuts = bpe.table.ids(column(part, "text"))
                digests = [pa.array([hashlib.sha256(x).hexdigest() for x in joined(forms, ids, cuts)], pa.string()) for forms in (bpe.written, bpe.spoken)]
                yield pa.RecordBatch.from_arrays([column(part, "id"), pa.array(np.diff(cuts)), *digests], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)

