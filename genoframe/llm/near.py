"""Near-duplicate documents by SetSketch registers.

Register i of a sketch is the truncated logarithm, to a base just above one, of the
least exponential hash i over the document's shingles.  Sketches of two sets merge by
the larger register, and equal registers are as likely as the sets are similar, so

1. documents with the same shingle set become one class, through a grouped minimum;
2. bands of registers put similar classes into common buckets;
3. each member of a bucket is compared with the bucket's first class, by a joint
   likelihood estimate from both sketches and then exactly on the full sets;
4. only where a bucket still spans several components are its other pairs looked at:
   the exact similarities to the first class rule out most of them by the triangle
   inequality and the likelihood estimate most others.  The likeliest pair of each
   class is verified first; then texts come to the buckets for the classes that still
   have doubtful pairs, and the pairs are verified there, so only links leave a bucket;
5. components of the verified links spread by least labels with pointer jumping.

Copies are never expanded into pairs, and no pair of a bucket whose ends are connected
already is ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, col, column, grams, mix, release, settled, slices, text_key

SHINGLE = 5
#: Links have a similarity of at least so many hundredths.
LINK = 75
#: Bands of ROWS registers.  At a similarity of 0.75 a pair shares no band once in four million.
BANDS, ROWS = 40, 4
#: Registers in all; those beyond the bands only sharpen the estimate, to a standard error of 0.027 at 0.75.
REGISTERS = 256
#: The registers' base, rate and largest value: 16 bits hold sets of any size that occurs.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
#: Estimates below this can't be links: 5 standard errors below 0.75, as seldom wrong as the bands.
DOUBT = 0.615
#: Members of one bucket, about, that ask in one step, and that they are compared with.
BLOCK = 2048

_LANES = np.random.default_rng(20).integers(0, 1 << 32, (2, REGISTERS), dtype=np.uint64).astype(np.uint32)
_SIG = "doc long, same long, n_shingles long, digest binary, sketch binary"


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text begins (with the end)."""
    words = Words(texts, lower=True)
    h = words.hashes()
    g, ok = words.grams(h, shingle)
    doc, g = words.doc[ok], g[ok]
    few = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
    if len(few):  # fewer words than a shingle has: the whole text is one
        whole = np.array([mix(grams(h[a:b], b - a)[:1] + np.uint64(b - a))[0] for a, b in zip(words.first[few].tolist(), words.first[few + 1].tolist())], np.uint64)
        doc, g = np.concatenate([doc, few]), np.concatenate([g, whole])
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    doc, g = doc[new], g[new]
    return g, np.searchsorted(doc, np.arange(len(words.counts) + 1))


def exact_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` by the words themselves: numbers that are equal for equal shingles of these texts only."""
    words = Words(texts, lower=True)
    number, names = words.numbered()
    code, n = number.astype(np.int64), len(names)
    ok = words.whole(shingle)
    for k in range(1, shingle):  # numbers of k + 1 words from those of k
        follows = np.zeros(len(code), np.int64)
        follows[: len(code) - k] = number[k:]
        code = np.unique(code * n + follows, return_inverse=True)[1]
    doc, code = words.doc[ok], code[ok]
    few = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
    if len(few):
        whole: dict[tuple[int, ...], int] = {}
        tuples = [tuple(number[a:b].tolist()) for a, b in zip(words.first[few].tolist(), words.first[few + 1].tolist())]
        doc, code = np.concatenate([doc, few]), np.concatenate([code, [len(words) + whole.setdefault(t, len(whole)) for t in tuples]])
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    doc, code = doc[new], code[new]
    return code, np.searchsorted(doc, np.arange(len(words.counts) + 1))


def sketch(g: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SetSketch registers of each set, one row each; empty sets have zeros."""
    out = np.zeros((len(at) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(np.diff(at))
    if not len(full):
        return out
    x = (g >> np.uint64(32)).astype(np.uint32)
    least = np.empty((REGISTERS, len(full)), np.uint32)
    buffer = np.empty_like(x)
    for j in range(REGISTERS):
        np.bitwise_xor(x, _LANES[0, j], out=buffer)
        np.multiply(buffer, _LANES[1, j] | np.uint32(1), out=buffer)
        least[j] = np.minimum.reduceat(buffer, at[full])
    exponential = -np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0**32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)
    return out


def merge_sketches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sets from their sketches (rows) and sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def fit(j):
        gain, loss = p(u - v * j), p(v - u * j)
        return more * np.log(np.maximum(gain, 1e-12)) + less * np.log(np.maximum(loss, 1e-12)) + same * np.log(np.maximum(1 - gain - loss, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):
        third = (high - low) / 3
        right = fit(low + third) < fit(high - third)
        low, high = np.where(right, low + third, low), np.where(right, high, high - third)
    return (low + high) / 2


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``doc``, ``same``, ``n_shingles``, ``digest`` of the sorted set (null if empty) and ``sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                g, at = shingle_sets(column(part, "text"), shingle)
                rows = sketch(g, at)
                digests = [hashlib.blake2b(g[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc"), column(part, "same"), pa.array(np.diff(at), pa.int64()), pa.array(digests, pa.binary()), pa.array([r.tobytes() for r in rows], pa.binary())],
                    names=["doc", "same", "n_shingles", "digest", "sketch"],
                )

    return docs.select(col(id_col).cast("long").alias("doc"), text_key(col(text_col)).alias("same"), col(text_col).alias("text")).mapInArrow(run, _SIG)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose likelihood estimate leaves a link possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = lambda n: np.frombuffer(b"".join(column(batch, n).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                j = estimate(rows("s_a"), rows("s_b"), column(batch, "n_a").to_numpy(), column(batch, "n_b").to_numpy())
                yield batch.select(["a", "b"]).filter(pa.array(j >= DOUBT))

    side = lambda x: classes.select(F.col("rep").alias(x), F.col("sketch").alias(f"s_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b", "n_a", "n_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """Pairs with ``both`` and ``either``: exact sizes of the intersection and the union of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t_a", 1 << 20):
                n = part.num_rows
                g, at = exact_sets(pa.concat_arrays([column(part, "t_a"), column(part, "t_b")]), shingle)
                both = np.array([len(np.intersect1d(g[at[i] : at[i + 1]], g[at[n + i] : at[n + i + 1]], assume_unique=True)) for i in range(n)], np.int64)
                size = np.diff(at)
                yield pa.RecordBatch.from_arrays([column(part, "a"), column(part, "b"), pa.array(both), pa.array(size[:n] + size[n:] - both)], names=["a", "b", "both", "either"])

    side = lambda x: texts.select(F.col("rep").alias(x), F.col("text").alias(f"t_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "t_b").mapInArrow(run, "a long, b long, both long, either long")


def components(links: DataFrame) -> DataFrame:
    """Least vertex that each end of a link (a, b) can reach: ``v``, ``c``."""
    both = settled(links.select("a", "b").union(links.select("b", "a")).toDF("v", "w").distinct(), "links")
    labels = settled(both.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("w"), "c"), "w").groupBy("v").agg(F.min("c").alias("m"))
        lower = labels.select("v", "c").join(near, "v").select("v", F.least("c", "m").alias("d"), (F.col("m") < F.col("c")).alias("moved"))
        jump = labels.select(F.col("v").alias("d"), F.col("c").alias("e"))
        after = settled(lower.join(jump, "d", "left").select("v", F.least("d", F.coalesce("e", "d")).alias("c"), "moved"), "labels")
        release(labels)
        labels = after
        if not after.filter("moved").take(1):
            release(both)
            return labels


def _doubtful(rows: dict[str, np.ndarray], i: int, best: bool) -> np.ndarray:
    """Members of a block that may be linked with its asking row ``i`` though they are in another component.

    The exact similarities to the bucket's first class rule pairs out by the triangle
    inequality, the estimate others.  With ``best`` only the likeliest; else all for
    which this bucket is the first that the two share.
    """
    n, registers = rows["rep"], rows["sketch"]
    far = (rows["c"] != rows["c"][i]) & ~rows["asks"] & ((n > n[i]) | ~rows["outside"] | best)
    gap = np.abs(rows["near"] - rows["near"][i])
    other = np.flatnonzero(far & ~(gap > 1 - LINK / 100 + 1e-9))  # an unknown gap rules nothing out
    equal = registers[other] == registers[i]
    likely = equal.sum(axis=1) >= REGISTERS // 2  # far below what a link has
    if not best:
        likely &= equal[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == rows["band"][i]
    other = other[likely]
    if not len(other):
        return other
    j = estimate(np.repeat(registers[i : i + 1], len(other), 0), registers[other], np.repeat(rows["n_shingles"][i], len(other)), rows["n_shingles"][other])
    if best:
        return other[[j.argmax()]] if j.max() >= DOUBT else other[:0]
    return other[j >= DOUBT]


def _bucket_rows(table: pa.Table) -> Iterator[tuple[pa.Table, dict[str, np.ndarray]]]:
    """The blocks of buckets in a table that is sorted by them."""
    block = np.stack([table["key"].to_numpy(), table["block"].to_numpy()], axis=1)
    cuts = [0, *(np.flatnonzero((np.diff(block, axis=0) != 0).any(axis=1)) + 1).tolist(), len(block)]
    cols = {n: table[n].to_numpy() for n in ("key", "rep", "c", "near", "asks", "outside", "band", "n_shingles")}
    cols["sketch"] = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
    for a, b in zip(cuts, cuts[1:]):
        yield table.slice(a, b - a), {n: x[a:b] for n, x in cols.items()}


def _by_bucket(buckets: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on each block of each bucket; blocks are dealt by their keys, sorted and read one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            key, block = table["key"].to_numpy(), table["block"].to_numpy()
            other = np.flatnonzero((key != key[-1]) | (block != block[-1]))
            if len(other):  # all but the last block are whole
                for part in _bucket_rows(table.slice(0, other[-1] + 1)):
                    yield from work(*part)
                held = table.slice(other[-1] + 1).to_batches()
        if held:
            for part in _bucket_rows(pa.Table.from_batches(held).combine_chunks()):
                yield from work(*part)

    return buckets.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(run, schema)


def _likeliest(table: pa.Table, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The likeliest partner of each asking row in a block."""
    found = [(i, j) for i in np.flatnonzero(rows["asks"]).tolist() for j in _doubtful(rows, i, True).tolist()]
    if found:
        i, j = np.array(found).T
        n, sketches = rows["n_shingles"], rows["sketch"]
        likely = estimate(sketches[i], sketches[j], n[i], n[j])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rows["key"][i], rows["rep"][i], rows["rep"][j], likely)], names=["key", "v", "w", "likely"])


def _with_doubts(table: pa.Table, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The members of a block that have doubtful pairs."""
    some = np.zeros(len(rows["rep"]), bool)
    for i in np.flatnonzero(rows["asks"]).tolist():
        other = _doubtful(rows, i, False)
        some[other] = True
        some[i] |= len(other) > 0
    if some.any():
        yield from table.filter(pa.array(some)).combine_chunks().to_batches()


def _links_inside(shingle: int):
    """Verified links between the members of a block; rows have their texts."""

    def work(table: pa.Table, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        g, at = exact_sets(table["text"].combine_chunks(), shingle)
        own = lambda i: g[at[i] : at[i + 1]]
        found = []
        for i in np.flatnonzero(rows["asks"]).tolist():
            for j in _doubtful(rows, i, False).tolist():
                both = len(np.intersect1d(own(i), own(j), assume_unique=True))
                if both * 100 >= (len(own(i)) + len(own(j)) - both) * LINK:
                    found.append((rows["rep"][i], rows["rep"][j]))
        if found:
            ab = np.sort(np.array(found), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

    return work


def _open_buckets(member: DataFrame, labels: DataFrame, star: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of the buckets that span several components, in blocks of about 2 * BLOCK rows at most; rows outside the first class's component ask."""
    labels = labels.select("v", "c")
    placed = member.join(labels, F.col("rep") == F.col("v"), "left").select("key", "band", "leader", "n", "rep", F.coalesce("c", "rep").alias("c"))
    split = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
    exact = star.select(F.col("a").alias("leader"), F.col("b").alias("rep"), (F.col("both") / F.col("either")).alias("near"))
    lead = labels.select(F.col("v").alias("leader"), F.col("c").alias("leader_c"))
    rows = placed.join(split, "key", "left_semi").join(exact, ["leader", "rep"], "left").join(lead, "leader", "left")
    rows = rows.withColumn("near", F.when(F.col("rep") == F.col("leader"), F.lit(1.0)).otherwise(F.col("near")))
    rows = rows.withColumn("outside", F.col("c") != F.coalesce("leader_c", "leader"))
    asking = rows.filter("outside").groupBy("key").agg(F.count("*").alias("n_ask"))
    rows = rows.join(asking, "key")
    # asking rows of part i meet all rows of part j in block (i, j)
    asks, others = [F.ceil(F.col(x) / BLOCK).cast("long") for x in ("n_ask", "n")]
    part = lambda n: F.pmod(F.xxhash64("rep"), n)
    zero = F.lit(0).cast("long")
    ask = rows.filter("outside").withColumn("to", F.explode(F.sequence(zero, others - 1))).withColumn("block", part(asks) * others + F.col("to")).withColumn("asks", F.lit(True))
    other = rows.withColumn("to", F.explode(F.sequence(zero, asks - 1))).withColumn("block", F.col("to") * others + part(others)).withColumn("asks", F.lit(False))
    dealt = ask.union(other)
    return dealt.join(classes.select("rep", "n_shingles", "sketch"), "rep").select("key", "block", "band", "asks", "outside", "rep", "c", "near", "n_shingles", "sketch")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Connected groups of documents whose shingle sets have a similarity of 0.75 or more.

    One row for each input row: ``id_col``, ``same`` (``text_key`` of the text),
    ``n_shingles``, ``component_id`` (least id that can be reached, itself included)
    and ``kept`` (the id is its component's).  A-Z are lower-cased; shingles are
    ``shingle`` consecutive words, or the whole text if it has fewer.  Null and empty
    texts have no shingles and stay alone; a null id is compared with nothing, has a
    null component and is kept.  Rows that share an id are one vertex: repeated rows are
    kept or dropped together, and of different texts under one id that with the least
    ``same`` is compared beyond exact copies.  Very long texts are compared whole.  Other
    columns are ignored, whatever their names.  Links are confirmed by the words of the
    shingles, not by their hashes.
    """
    sig = settled(signatures(docs, id_col, text_col, shingle), "signatures")
    full = sig.filter("digest is not null and doc is not null")
    classes = full.groupBy("digest").agg(F.min(F.struct("doc", "same")).alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    sets = settled(classes.select("digest", F.col("first.doc").alias("rep"), F.col("first.same").alias("rep_same"), "n_shingles", "sketch"), "classes")
    # rows that share an id are one vertex; the text with the least key stands for it
    classes = sets.groupBy("rep").agg(F.min(F.struct("rep_same", "n_shingles", "sketch")).alias("x")).select("rep", "x.*")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col("sketch"), i * 2 * ROWS + 1, F.lit(2 * ROWS))))
    member = classes.select("rep", F.posexplode(bands).alias("band", "key"))
    first = member.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    member = settled(member.join(first, "key"), "members")
    star = member.filter("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    near = settled(_estimated(star, classes), "candidates")
    ids = member.select("rep").distinct()
    texts = docs.select(col(id_col).cast("long").alias("rep"), text_key(col(text_col)).alias("rep_same"), col(text_col).alias("text"))
    texts = settled(texts.join(classes.join(ids, "rep", "left_semi").select("rep", "rep_same"), ["rep", "rep_same"], "left_semi").dropDuplicates(["rep"]), "texts")
    is_link = F.col("both") * 100 >= F.col("either") * LINK
    star_checked = settled(_verified(near, texts, shingle), "verified")
    links = star_checked.filter(is_link).select("a", "b")
    labels = components(links)
    likeliest = _by_bucket(_open_buckets(member, labels, star_checked, classes), _likeliest, "key long, v long, w long, likely double")
    likeliest = likeliest.groupBy("key", "v").agg(F.max(F.struct("likely", "w")).alias("x")).select(F.least("v", "x.w").alias("a"), F.greatest("v", "x.w").alias("b")).distinct()
    more = settled(_verified(likeliest.join(star_checked.select("a", "b"), ["a", "b"], "left_anti"), texts, shingle), "verified")
    release(labels)
    links = links.union(more.filter(is_link).select("a", "b"))
    labels = components(links)
    open_ = _open_buckets(member, labels, star_checked, classes)
    doubts = _by_bucket(open_, _with_doubts, open_.schema).join(texts.select("rep", "text"), "rep")
    rest = settled(_by_bucket(doubts, _links_inside(shingle), "a long, b long"), "links")
    release(labels)
    labels = components(links.union(rest))
    release(member, near, texts, star_checked, more, rest)
    of_class = sets.join(labels.select("v", "c"), F.col("rep") == F.col("v"), "left").select(F.col("digest").alias("d"), F.coalesce("c", "rep").alias("component"))
    keyed = sig.withColumn("digest", F.when(F.col("doc").isNotNull(), F.col("digest")))
    out = keyed.join(of_class, F.col("digest") == F.col("d"), "left")
    component = F.coalesce("component", "doc")
    return out.select(F.col("doc").alias(id_col), "same", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))
