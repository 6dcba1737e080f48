"""Spelling variants: words at distance one, by tries and Levenshtein automata.

Tasks count the words of their documents before anything is shuffled.  The words that
count are range-partitioned in order into shards of bounded size; a task builds each
shard's compact trie, and as many tries as BROADCAST_BYTES allows are broadcast at a
time.  Every word's automaton (a position in the word, and whether the one edit is
spent) walks every trie depth-first: branches on which the automaton has no state left
are never entered.  A shard gives one row for each word with neighbours in it, the
number of those and the best one, and rows of all shards are reduced by word.

A word has no more neighbours than edits, so there is no pair list to grow.  Words are
Latin-1, one byte for a code point, so bytes order as code points do.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SOLID, Words, col, column, raw_text, release, settled, slices

#: A run's code point is lost where this divides its hash; the least length and count of words; how many times as frequent a form is.
LOSES, LENGTH, COUNT, TIMES = 199, 6, 5, 5
#: Words of a shard, about, and bytes of tries that are broadcast together.
SHARD_WORDS, BROADCAST_BYTES = 1 << 17, 64 << 20
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 1 << 19

LETTER = np.zeros(256, bool)
LETTER[ord("A") : ord("Z") + 1] = True
LETTER[ord("a") : ord("z") + 1] = True


def runs(texts: pa.Array) -> Words:
    """The maximal runs of ASCII letters and U+00C0 to U+00FF, with A-Z lower-cased; those code points are the byte C3 and one more."""
    raw, at = raw_text(texts)
    lead = raw == 0xC3
    keep = LETTER[raw] | lead
    keep[1:] |= lead[:-1]
    plain = np.where(keep, LOWER[raw], 32).astype(np.uint8)
    return Words(pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(plain)]), SOLID)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loses: int = LOSES) -> DataFrame:
    """``word`` (Latin-1 bytes), ``n``: every run after the loss of code points; each task merges its words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for part in slices(batch):
                held.update(_counted(part, loses))
                if len(held) >= HELD_WORDS:
                    yield _words_batch(held)
                    held.clear()
        yield _words_batch(held)

    chosen = docs.select(col(id_col).cast("string").alias("id"), col(text_col).alias("text")).filter(F.col("text").isNotNull())
    return chosen.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(part: pa.RecordBatch, loses: int) -> Counter[str]:
    """Words of some texts: all runs, less those of a document that lose a code point, plus what is left of these."""
    words = runs(column(part, "text"))
    if not len(words):
        return Counter()
    number, names = words.numbered()
    counts: Counter[str] = Counter(dict(zip(names, np.bincount(number, minlength=len(names)).tolist())))
    raw = [w.encode() for w in names]
    pair, times = np.unique(words.doc * len(names) + number, return_counts=True)
    seeds = [None if i is None else zlib.crc32(i.encode() + b":") for i in column(part, "id").to_pylist()]
    doc, word = np.divmod(pair, len(names))
    crc = zlib.crc32
    for d, w, t in zip(doc.tolist(), word.tolist(), times.tolist()):
        seed = seeds[d]
        if seed is None:
            continue
        h = crc(raw[w], seed)
        if not h % loses:
            name = names[w]
            at = h % len(name)
            counts[name] -= t
            counts[name[:at] + name[at + 1 :]] += t
    return counts


def _words_batch(held: Counter[str]) -> pa.RecordBatch:
    kept = [(w.encode("latin-1"), n) for w, n in held.items() if n > 0 and w]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])


# ---------------------------------------------------------------- tries


def pack(words: list[bytes], counts: list[int]) -> tuple[bytes, bytes, bytes]:
    """The trie of sorted distinct words as three arrays: nodes are numbered by depth, so that the children of a node stand together.

    ``label[i]`` is the byte that leads to node i, ``child[i]`` to ``child[i + 1]`` (32 bits)
    are its children, ``count[i]`` (64 bits) is the count of the word that ends there, or 0.
    """
    size, n = np.array([len(w) for w in words], np.int64), np.array(counts, np.int64)
    begin = np.zeros(len(words), np.int64)
    np.cumsum(size[:-1], out=begin[1:])
    raw = np.frombuffer(b"".join(words), np.uint8)
    labels, children, ends = [np.zeros(1, np.uint8)], [], []
    at, node = np.arange(len(words)), np.zeros(len(words), np.int64)  # words that reach this depth, and their nodes there
    width, depth = 1, 0
    while width:
        done, here = size[at] == depth, np.zeros(width, np.int64)
        here[node[done]] = n[at[done]]
        ends.append(here)
        at, node = at[~done], node[~done]
        byte = raw[begin[at] + depth]
        new = np.ones(len(at), bool)
        new[1:] = (node[1:] != node[:-1]) | (byte[1:] != byte[:-1])
        children.append(np.bincount(node[new], minlength=width))
        labels.append(byte[new])
        node = np.cumsum(new) - 1
        width, depth = int(new.sum()), depth + 1
    child = np.concatenate([[1], 1 + np.cumsum(np.concatenate(children))])
    return np.concatenate(labels).tobytes(), child.astype(np.uint32).tobytes(), np.concatenate(ends).tobytes()


class Trie:
    def __init__(self, label: bytes, child: bytes, count: bytes):
        self.label, self.child, self.count = label, memoryview(child).cast("I"), memoryview(count).cast("q")

    def neighbours(self, word: bytes) -> Iterator[tuple[bytes, int]]:
        """The words at distance one, with their counts.

        While its edit is unspent the automaton allows one path.  At each node of it the
        edit may be spent on the word's next byte (lost), on a child in its place, or on
        a child before it; from there again one path is left.  An edit next to an equal
        byte is taken at the last of these, so that no word is found twice.
        """
        label, child, size, node = self.label, self.child, len(word), 0
        for at in range(size + 1):
            first, end = child[node], child[node + 1]
            byte = word[at] if at < size else -1
            if byte >= 0 and (at + 1 == size or word[at + 1] != byte):
                if n := self._rest(node, word, at + 1):
                    yield word[:at] + word[at + 1 :], n
            for c in range(first, end):
                if label[c] != byte:
                    if byte >= 0 and (n := self._rest(c, word, at + 1)):
                        yield word[:at] + label[c : c + 1] + word[at + 1 :], n
                    if n := self._rest(c, word, at):
                        yield word[:at] + label[c : c + 1] + word[at:], n
            node = label.find(byte, first, end) if byte >= 0 else -1
            if node < 0:
                return

    def _rest(self, node: int, word: bytes, at: int) -> int:
        """The count at the end of the path of ``word[at:]`` from a node, 0 where it leaves the trie."""
        label, child = self.label, self.child
        for i in range(at, len(word)):
            node = label.find(word[i], child[node], child[node + 1])
            if node < 0:
                return 0
        return self.count[node]


def tries(vocabulary: DataFrame, n_words: int) -> DataFrame:
    """The shards' tries, by ranges of words: ``first`` (its first word), ``bytes``, ``label``, ``child``, ``count``."""

    def row(words: list[bytes], counts: list[int]) -> pa.RecordBatch:
        arrays = pack(words, counts)
        return pa.RecordBatch.from_arrays([pa.array([words[0]], pa.binary()), pa.array([sum(map(len, arrays))], pa.int64()), *[pa.array([a], pa.binary()) for a in arrays]], names=["first", "bytes", "label", "child", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, letters = [], [], 0
        for batch in batches:
            for word, n in zip(column(batch, "word").to_pylist(), column(batch, "n").to_pylist()):
                words.append(word)
                counts.append(n)
                letters += len(word)
                if len(words) >= 2 * SHARD_WORDS or letters >= 32 * SHARD_WORDS:
                    yield row(words, counts)
                    words, counts, letters = [], [], 0
        if words:
            yield row(words, counts)

    ordered = vocabulary.repartitionByRange(n_words // SHARD_WORDS + 1, "word").sortWithinPartitions("word")
    return settled(ordered.mapInArrow(run, "first binary, bytes long, label binary, child binary, count binary"), "tries")


def near_words(vocabulary: DataFrame, n_words: int) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best``: words with neighbours among all words, how many, and the most frequent (then least) of them."""
    shards = tries(vocabulary, n_words)
    rounds, held = [[]], 0
    for first, size in sorted(map(tuple, shards.select("first", "bytes").collect())):
        if rounds[-1] and held + size > BROADCAST_BYTES:
            rounds.append([])
            held = 0
        rounds[-1].append(bytes(first))
        held += size
    dealt = vocabulary.repartition(n_words // 8192 + 1, "word")
    found = [settled(_walk(dealt, shards.filter(F.col("first").between(F.lit(firsts[0]), F.lit(firsts[-1])))), "near") for firsts in rounds if firsts]
    release(shards)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    best = out.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b"))
    return best.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def _walk(words: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows of the words with neighbours in these shards; a broadcast holds the tries, BROADCAST_BYTES of them or one."""
    shared = words.sparkSession.sparkContext.broadcast([tuple(map(bytes, row)) for row in shards.select("label", "child", "count").collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Trie(*arrays) for arrays in shared.value]
        for batch in batches:
            rows = []
            for word in column(batch, "word").to_pylist():
                hits = [(-n, w) for trie in ready for w, n in trie.neighbours(word)]
                if hits:
                    less, best = min(hits)
                    rows.append((word, len(hits), -less, best))
            word, n_near, best_n, best = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.binary()), pa.array(n_near, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.binary())], names=["word", "n_near", "best_n", "best"])

    return words.mapInArrow(run, "word binary, n_near long, best_n long, best binary")


# ---------------------------------------------------------------- forms


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` from ``word``, ``form``: each round follows twice as many steps; a form is at least TIMES as frequent, so chains are short."""
    out = settled(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settled(out.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(out)
        out = moved
        if not out.filter("moved").limit(1).count():
            return out.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loses: int = LOSES, length: int = LENGTH, count: int = COUNT, times: int = TIMES) -> DataFrame:
    """One row for each word: ``word``, ``form``, ``root`` (strings), ``n``, ``n_near``, ``form_n``.

    Words are runs of letters of at least ``length`` code points that occur ``count``
    times or more, after one code point was taken from every run whose hash with its
    document's id ``loses`` divides.  ``form`` is the word's most frequent neighbour, of
    equally frequent ones the least, if it is ``times`` as frequent; ``root`` is where
    following forms ends.  Null and empty texts have no words; runs of a null id lose
    nothing; repeated rows count each time; very long texts and words are taken whole; an
    empty table gives an empty one; other columns are ignored.
    """
    vocabulary = settled(count_words(docs, id_col, text_col, loses).filter((F.octet_length("word") >= length) & (F.col("n") >= count)), "words")
    n_words = vocabulary.count()
    text = lambda c: F.decode(F.col(c), "ISO-8859-1")
    if not n_words:
        return vocabulary.select(text("word").alias("word"), text("word").alias("form"), text("word").alias("root"), "n", F.col("n").alias("n_near"), F.col("n").alias("form_n"))
    told = vocabulary.join(near_words(vocabulary, n_words), "word", "left")
    is_form = F.col("best_n") >= times * F.col("n")
    told = settled(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    last = roots(told.filter(F.col("form").isNotNull()))
    return told.join(last, "word", "left").select(text("word").alias("word"), text("form").alias("form"), F.decode(F.coalesce("root", "word"), "ISO-8859-1").alias("root"), "n", "n_near", "form_n")
