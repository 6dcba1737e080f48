"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of consecutive item words.  Its shingles are ordered by how often
they occur in all documents, and as a window counts only when it is contained whole,
its rarest shingle is a sufficient prefix: a document without that shingle can't hold
the window.  Documents join windows on the prefix shingle alone; the shingle's place
in the window and in the document must leave room for the whole window (positional
and length bound), and the words of the document there are then compared one by one.

A bitmap of fixed size, made of the benchmark's shingles, keeps most document
shingles out of the joins; it only ever lets too many pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, Words, col, column, grams, slices, text_key

WINDOW = 10
SHINGLE = 3
#: Bits of the bitmap, whatever the benchmark's size.
BITS = 1 << 24
#: Parts into which the rows of one frequent shingle are dealt.
SALTS = 16


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """Distinct windows: ``win`` (words joined by a space), ``n``, ``shingles`` in order, ``items``."""
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(column(part, "text"), ALNUM, lower=True)
                text, begin, end = words.packed()
                h = words.hashes()
                by_size = {k: grams(h, k) for k in range(1, shingle + 1)}
                row, win, size, shingles = [], [], [], []
                for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                    n = min(window, b - a)
                    k = min(shingle, n)
                    for p in range(a, b - n + 1) if n else ():
                        row.append(i)
                        win.append(text[begin[p] : end[p + n - 1]].decode("utf-8"))
                        size.append(n)
                        shingles.append(by_size[k][p : p + n - k + 1].view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays([column(part, "item").take(pa.array(row, pa.int64())), pa.array(win, pa.string()), pa.array(size, pa.int32()), pa.array(shingles, pa.list_(pa.int64()))], names=["item", "win", "n", "shingles"])

    rows = items.select(col(id_col).alias("item"), col(text_col).alias("text")).mapInArrow(run, f"item {kind}, win string, n int, shingles array<bigint>")
    return rows.groupBy("win", "n").agg(F.first("shingles").alias("shingles"), F.collect_set("item").alias("items"))


def bitmap(tokens: DataFrame) -> np.ndarray:
    """BITS bits, set where a value of column ``token`` falls."""
    cell = F.col("token").bitwiseAND(F.lit(BITS - 1))
    found = tokens.select(F.shiftright(cell, 15).cast("int").alias("block"), cell.bitwiseAND(F.lit((1 << 15) - 1)).cast("int").alias("bit")).groupBy("block").agg(F.collect_set("bit").alias("bits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for bits in column(batch, "bits").to_pylist():
                x = np.zeros(1 << 15, bool)
                x[bits] = True
                out.append(np.packbits(x).tobytes())
            yield pa.RecordBatch.from_arrays([column(batch, "block"), pa.array(out, pa.binary())], names=["block", "bits"])

    out = np.zeros((BITS >> 15, 1 << 15), bool)
    for r in found.mapInArrow(pack, "block int, bits binary").collect():  # BITS bits in all
        out[r.block] = np.unpackbits(np.frombuffer(r.bits, np.uint8)).astype(bool)
    return np.packbits(out.reshape(-1))


def _holds(bits: np.ndarray, g: np.ndarray) -> np.ndarray:
    cell = (g & np.uint64(BITS - 1)).astype(np.int64)
    return (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1


def shingle_counts(texts: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """How often each shingle that the bitmap lets pass occurs in all documents: ``token``, ``freq``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(column(part, "text"), ALNUM, lower=True)
                h = words.hashes()
                for k in sizes:
                    g, ok = words.grams(h, k)
                    token, n = np.unique(g[ok & _holds(bits, g)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n, pa.int64())], names=["token", "freq"])

    return texts.select("text").mapInArrow(run, "token long, freq long").groupBy("token").agg(F.sum("freq").alias("freq"))


def candidates(texts: DataFrame, bits: np.ndarray, sizes: list[int], window: int) -> DataFrame:
    """Each document with its number of words and the places of prefix shingles: ``places`` of (token, pos, from, words around)."""
    kind = texts.schema["doc"].dataType.simpleString()
    place = pa.struct([("token", pa.int64()), ("pos", pa.int32()), ("begin", pa.int32()), ("around", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(column(part, "text"), ALNUM, lower=True)
                h = words.hashes()
                text, begin, end = words.packed()
                places: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for k in sizes:
                    g, ok = words.grams(h, k)
                    at = np.flatnonzero(ok & _holds(bits, g))
                    doc = words.doc[at]
                    reach = window - k if k == sizes[-1] else 0  # shorter shingles are whole windows
                    a, b = np.maximum(words.first[doc], at - reach), np.minimum(words.first[doc + 1], at + k + reach)
                    for d, token, pos, lo, x, y in zip(doc.tolist(), g[at].view(np.int64).tolist(), (at - words.first[doc]).tolist(), (a - words.first[doc]).tolist(), begin[a].tolist(), end[b - 1].tolist()):
                        places[d].append({"token": token, "pos": pos, "begin": lo, "around": text[x:y].decode("utf-8")})
                yield pa.RecordBatch.from_arrays([column(part, "doc"), column(part, "same"), pa.array(words.counts, pa.int64()), pa.array(places, pa.list_(place))], names=["doc", "same", "n_words", "places"])

    return texts.mapInArrow(run, f"doc {kind}, same long, n_words long, places array<struct<token:bigint,pos:int,begin:int,around:string>>")


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Which words of each document lie in an occurrence of a benchmark window.

    One row for each distinct (id, text): ``id_col``, ``same`` (``text_key`` of the
    text), ``n_words``, ``hits`` (start and length of each occurrence), ``n_hit``
    (words covered), ``items`` (ids of the items that occur, sorted as strings) and
    ``contaminated``.  A-Z are lower-cased; words are runs of ASCII digits, letters and
    non-ASCII characters.  An item of fewer than ``window`` words is one window; items
    and documents that are null, empty or have no words match nothing; a null item id
    hits words but isn't listed.  Repeated rows share one result, null ids are kept.
    Other columns are ignored.
    """
    shingle = min(shingle, window)
    texts = docs.select(col(id_col).alias("doc"), text_key(col(text_col)).alias("same"), col(text_col).alias("text"))
    wins = item_windows(items, item_id_col, item_text_col, window, shingle)
    tokens = wins.select(F.explode("shingles").alias("token"), F.least("n", F.lit(shingle)).alias("k"))
    sizes = sorted(r.k for r in tokens.select("k").distinct().collect()) or [shingle]  # at most `shingle` rows
    if sizes[-1] != shingle:
        sizes.append(shingle)
    counts = shingle_counts(texts, bitmap(tokens), sizes)
    ranked = wins.select("win", "n", "items", F.posexplode("shingles").alias("off", "token")).join(counts, "token")
    # an inner join: a window with a shingle that no document has would be cut to its other shingles, so it is counted
    rarest = Window.partitionBy("win").orderBy("freq", "off")
    whole = ranked.withColumn("have", F.count("*").over(Window.partitionBy("win"))).withColumn("nth", F.row_number().over(rarest))
    prefix = whole.filter((F.col("nth") == 1) & (F.col("have") == F.col("n") - F.least("n", F.lit(shingle)) + 1)).select("token", "off", "win", "n", "items")
    found = candidates(texts, bitmap(prefix.select("token")), sizes, window)
    salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
    flat = found.select("doc", "same", "n_words", F.explode_outer("places").alias("at")).select(
        "doc", "same", "n_words", "at.*", F.coalesce("at.token", F.xxhash64("doc", "same")).alias("key"), salt(F.struct("doc", "same", "at.pos")).alias("salt")
    )
    start = F.col("pos") - F.col("off")
    there = F.array_join(F.slice(F.split("around", " "), F.greatest(start - F.col("begin"), F.lit(0)) + 1, F.col("n")), " ")
    salted = prefix.withColumnRenamed("token", "key").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    fits = (start >= F.col("begin")) & (start + F.col("n") <= F.col("n_words"))
    hit = flat.join(salted, ["key", "salt"], "left").withColumn("hit", F.when(fits & (there == F.col("win")), F.struct(start.alias("start"), F.col("n").alias("n"))))
    by_doc = hit.groupBy("doc", "same").agg(
        F.first("n_words").alias("n_words"), F.collect_set("hit").alias("hits"), F.flatten(F.collect_set(F.when(F.col("hit").isNotNull(), F.col("items")))).alias("items")
    )
    words = F.array_distinct(F.flatten(F.transform("hits", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1))))
    return by_doc.select(
        F.col("doc").alias(id_col), "same", "n_words", "hits", F.size(words).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("items", lambda x: x.cast("string")))).alias("items"), (F.size("hits") > 0).alias("contaminated"),
    )
