"""Text operators against brute force, exact round trips and odd inputs."""

import base64
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from oracle import connect
from pyspark.sql import functions as F

from genoframe.llm import bpe, classifier, decontaminate, html, lm, near, quality, queries, substring, tokens, warc
from genoframe.llm.common import Words, deflate, inflate

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, `a.b` int"
LOREM = "the quick brown fox jumps over the lazy dog while seven small birds sing about rain and wind on an old tin roof near the sea".split()


def corpus(seed=0, n=60):
    """Texts with copies, near copies, repeated lines, junk, nulls, empty and long texts."""
    r = np.random.default_rng(seed)
    vocabulary = LOREM + [f"w{i}" for i in range(400)]
    texts = [" ".join(r.choice(vocabulary, r.integers(1, 160))) for _ in range(n)]
    passage = " ".join(r.choice(vocabulary, 60))
    for i in range(0, n, 5):
        texts[i] += "\n" + passage + " " + vocabulary[i]
    for i in range(1, 12, 2):
        words = texts[2 * i].split()
        words[len(words) // 2 : len(words) // 2 + 1] = ["changed"]
        texts.append(" ".join(words))
    texts += [texts[3]] * 4 + ["", "  \n ", "one", "two words", "spam " * 200, ("a%b$ " * 30).strip(), "ÀÉ ünï cödé " * 20, "x" * 5000, "same line\n" * 12]
    return texts


def docs(spark, texts=None, nulls=True):
    texts = corpus() if texts is None else texts
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t or ""), "extra", 1) for i, t in enumerate(texts)]
    if nulls:
        rows += [(len(rows), None, "en", "s0", 0, None, None), (None, texts[0] if texts else "x", "en", None, 1, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect() if r.doc_id is not None}


# ---------------------------------------------------------------- word tables


def test_words():
    texts = ["a bc  d", None, "", "\tx y\x1cz\n", "é ü"]
    w = Words(pa.array(texts))
    found = [w.raw[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]
    assert found == [x for t in texts for x in WORD.findall(t or "")]
    assert list(w.counts) == [len(WORD.findall(t or "")) for t in texts]
    text, begin, end = w.packed()
    assert text.decode() == " ".join(found) and [text[a:b].decode() for a, b in zip(begin, end)] == found
    again = Words(pa.array(["d bc", "a"])).hashes()
    assert set(again.tolist()) <= set(w.hashes().tolist())
    joined = Words(pa.array(["ab", "cd"]))
    assert joined.packed()[0] == b"ab cd"


def thue_morse(n):
    """Two words that differ in each letter and that sums with powers modulo 2**64 can't tell apart."""
    x = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[i] for i in x), "".join("ba"[i] for i in x)


def test_word_hashes():
    texts = [w for n in (16, 64, 65, 1024, 4096) for w in thue_morse(n)] + ["a" * n for n in range(1, 140)] + [f"{i}" for i in range(5000)] + ["a\x00", "a\x00\x00", "\x00"]
    w = Words(pa.array(texts))
    assert len(set(w.hashes().tolist())) == len(set(texts))
    number, names = w.numbered()
    assert [names[i] for i in number.tolist()] == texts


def test_long_text():
    """A text of several steps of the word tables."""
    text = "ab  cdé " * 1_100_000
    w = Words(pa.array(["x", text, text[:8], "é"]))
    assert w.counts.tolist() == [1, 2_200_000, 2, 1] and set((w.end - w.start).tolist()) == {1, 2, 4}
    assert len(np.unique(w.hashes())) == 4


def test_frames():
    for x in (b"", b"abc" * 1000):
        assert inflate(deflate(x)) == x


# ---------------------------------------------------------------- substring dedup


def brute_substring(texts, window):
    seen, out = set(), {}
    for d in sorted(texts):
        w = WORD.findall(texts[d])
        gone = set()
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if key in seen:
                gone.update(range(p, p + window))
            seen.add(key)
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("window", [20, 5])
def test_substring(spark, window):
    df = docs(spark)
    want = brute_substring(texts_of(df), window)
    got = substring.dedup_substrings(df, window=window, keep=("lang",)).collect()
    assert len(got) == df.count()
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        n, gone, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, " ".join(WORD.findall(r.kept_text))) == (n, gone, kept)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert sum(r.n_removed for r in got) > 100


def test_substring_across_slices():
    """A task's table of recent strings and a bucket that merges while it reads leave the same windows, whatever their order."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    texts = {}
    for doc in range(60):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(60))]
        at = rng.randrange(len(words) + 1)
        texts[doc] = " ".join(words[:at] + passage[: rng.choice([0, 25, 40])] + words[at:])
    seen, want = set(), set()
    for doc, text in texts.items():
        words = text.split()
        for i in range(len(words) - 19):
            w = tuple(words[i : i + 20])
            if w in seen:
                want.add((doc, i))
            seen.add(w)
    least = None
    for limit in (1, 1000, 1 << 20):
        order = list(texts)
        rng.shuffle(order)
        blobs, got, sent = {}, [], 0
        for task in (order[:30], order[30:]):
            recent = substring.Recent(limit)
            for k in range(0, 30, 5):
                some = task[k : k + 5]
                part = pa.RecordBatch.from_pydict({"doc": pa.array(some, pa.int64()), "same": pa.array([0] * 5, pa.int64()), "text": pa.array([texts[d] for d in some])})
                for b in substring._cut_slice(part, np.zeros(substring.CELLS, np.uint8), 20, 3, 4, recent):
                    for r in b.to_pylist():
                        if r["bucket"] < 0:
                            got.append((r["doc"], r["data"]))
                        else:
                            sent += len(r["data"])
                            blobs.setdefault(r["bucket"], []).append(substring.inflate(r["data"]))
        for some in blobs.values():
            for found in substring._settle(some, 20):
                for b in substring._span_rows(*found):
                    got += [(r["doc"], r["spans"]) for r in b.to_pylist()]
        marked = {(d, a + i) for d, x in got for a, n in np.frombuffer(x, np.int32).reshape(-1, 2).tolist() for i in range(n)}
        assert marked == want
        assert limit < 1 << 20 or sent < least
        least = sent


def test_substring_repeated_rows(spark):
    df = docs(spark, [" ".join(LOREM)], nulls=False)
    assert [r.n_removed for r in substring.dedup_substrings(df.union(df)).collect()] == [0, 0]
    assert substring.dedup_substrings(empty(spark)).count() == 0


# ---------------------------------------------------------------- decontamination


def lowered(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))


def brute_contamination(texts, items, window=10):
    out = {}
    for d, t in texts.items():
        w = lowered(t)
        hit, names = set(), set()
        for name, item in items:
            words = lowered(item or "")
            n = min(window, len(words))
            for q in range(len(words) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == words[q : q + n]:
                        hit.update(range(p, p + n))
                        names.add(str(name))
        out[d] = (len(w), len(hit), sorted(names))
    return out


def test_contamination(spark):
    texts = corpus(n=30)
    texts[4] += " One, TWO three-four five SIX seven eight nine ten eleven! end"
    texts[9] = "birds sing"
    items = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "birds sing"), (3, None), (4, "..."), (10, "sea"), (11, " ".join(texts[6].split()[:15])), (12, "one two three four five six seven eight nine ten")]
    df = docs(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination(texts_of(df), items)
    got = {r.doc_id: r for r in decontaminate.find_contamination(df, bench).collect()}
    for d, (n, hit, names) in want.items():
        assert (got[d].n_words, got[d].n_hit, got[d]["items"], got[d].contaminated) == (n, hit, names, hit > 0), d
    assert None in got and sum(r.n_hit for r in got.values()) > 20
    assert decontaminate.find_contamination(empty(spark), bench).count() == 0
    assert decontaminate.find_contamination(df, bench.filter("false")).filter("contaminated").count() == 0


# ---------------------------------------------------------------- quality rules


def test_quality(spark):
    df = docs(spark)
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    for d, t in texts_of(df).items():
        w = WORD.findall(t)
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        repeated = {i + o for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for o in range(5)}
        full = [x for x in t.split("\n") if WORD.search(x)]
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(repeated))
        assert r.base_failed == (len(w) < 10 or 100 * len(repeated) > 20 * len(w))
        assert not (r.base_failed and r.kept)
    junk = next(d for d, t in texts_of(df).items() if t.startswith("a%b$"))
    assert not got[junk].kept and got[2].kept
    assert quality.judge(empty(spark)).count() == 0


def brute_thresholds(rows):
    """Thresholds per (lang, source) from lists of (lang, source, measures), by sorting weighted bins."""

    def low(v):
        shift = max(0, v.bit_length() - 6)
        return v >> shift << shift

    out = {}
    for key in {(lang, source) for lang, source, _ in rows}:
        language = [m for lang, _, m in rows if lang == key[0]]
        own = [m for lang, source, m in rows if (lang, source) == key]
        for k, (p, reach) in quality.FENCES.items():
            weight = Counter()
            for m in language:
                weight[low(m[k])] += quality.PRIOR
            for m in own:
                weight[low(m[k])] += len(language)
            total, upto, at = sum(weight.values()), 0, {}
            for v in sorted(weight):
                upto += weight[v]
                for q in (50, p):
                    if upto * 100 >= total * q:
                        at.setdefault(q, v)
            above = {v: n for v, n in weight.items() if v}
            upto, middle = 0, 0
            for v in sorted(above, reverse=True):  # the least value with half of the rest or more up to it
                if (sum(above.values()) - upto) * 100 >= sum(above.values()) * 50:
                    middle = v
                upto += above[v]
            out[*key, k] = max(at[p] + reach * (at[p] - at[50]), sum(above.values()) / total * middle)
    return out


def quality_texts():
    """Plain documents whose measures vary by source, and for each measure one that only it can tell from them."""
    r = np.random.default_rng(2)
    rows = []
    plain = lambda n: list(r.choice(LOREM, n))
    for i in range(500):
        words = plain(int(r.integers(150, 250)))
        if i % 10 == 0:
            words += words[:5]  # some repeat a little
        text = " ".join(words)
        if i % 12 == 0:
            text += "\nsame\nsame"
        if i % 2 and i % 6 == 1:
            text += " #"
        rows.append((text, "en", f"s{i % 2}"))
    words = plain(600)
    outliers = {
        "repeats": " ".join(words + words[:65]),
        "lines": "\n".join([*words[:200], *["the", "fox", "sea"] * 6]),
        "symbols": " ".join(words[:200]) + " &&&&& %%%%%",
        "letters": " ".join(w + "ingly" for w in words[:200]),
    }
    for i, m in enumerate(quality.MEASURES):
        rows += [(outliers[m], "en", "s0")]
    return rows, {len(rows) - len(quality.MEASURES) + i: m for i, m in enumerate(quality.MEASURES)}


def test_quality_thresholds(spark):
    """Each measure rejects a document by itself, plain ones stay, and thresholds are those of the definition."""
    rows, planted = quality_texts()
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(df, keep=("lang", "source")).collect()}
    assert {i: r.kept for i, r in got.items()} == {r.doc_id: r.kept for r in quality.judge(df).collect()}
    measured = {i: {m: getattr(r, c) * s // r.n_words for m, (c, s) in quality.COUNTS.items()} for i, r in got.items()}
    most = brute_thresholds([(r.lang, r.source, measured[i]) for i, r in got.items() if not r.base_failed])
    for i, r in got.items():
        over = set()
        for m, (count, scale) in quality.COUNTS.items():
            allowed = most[r.lang, r.source, m] * r.n_words
            more = getattr(r, count) * scale - allowed
            if more > 0 and more**2 > quality.ERRORS[m] ** 2 * scale * (allowed + scale):
                over.add(m)
        assert r.kept == (not r.base_failed and not over), (i, over)
        if i in planted:
            assert not r.base_failed and over == {planted[i]}, (planted[i], over)
    assert sum(not got[i].kept for i in got if i not in planted) <= 5
    assert len({most["en", s, "symbols"] for s in ("s0", "s1")}) == 2


def test_quality_thresholds_of_the_tables(spark):
    """Each measure has different thresholds in different groups, and a long clean text keeps a few symbols that a short one may not have."""
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    here = spark.read.parquet(path)
    cuts = quality.thresholds(quality.sketches(quality.measure(here, keep=("lang", "source")), ("lang", "source")), ("lang", "source")).collect()
    for m in quality.MEASURES:
        assert len({r[f"{m}_most"] for r in cuts}) > 4, m
    plain = " ".join(np.base_repr(36**3 + i, 36).lower() for i in range(40_000))
    rows = [(10**9 + i, f"{plain} {'& ' * n}", "en", "src1", 1) for i, n in enumerate((4, 40))] + [(10**9 + 2, " ".join(f"w{i}" for i in range(20)) + " & % & % & % & % & % & % & %", "en", "src1", 1)]
    judged = quality.judge(here.unionByName(spark.createDataFrame(rows, here.schema)))
    got = {r.doc_id: r for r in judged.filter(F.col("doc_id") >= 10**9).collect()}
    assert [got[10**9 + i].kept for i in range(3)] == [True, True, False]
    symbols = {(r.n_symbols, r.kept) for r in judged.filter("not base_failed and n_symbols > 0").collect()}
    assert not any(all(kept == (n < cut) for n, kept in symbols) for cut in range(100))  # no fixed count tells kept from rejected


def test_quality_odd_rows(spark):
    """Nulls, an empty table, repeated rows and ties, and other columns of all names."""
    df = docs(spark).withColumns({"id": F.lit(1), "g0": F.lit("x"), "measure": F.lit(2), "kept": F.lit(3)})
    got = quality.judge(df).collect()
    assert len(got) == df.count() and {r.doc_id: r.kept for r in got}[None] in (True, False)
    twice = quality.judge(df.union(df)).collect()
    assert Counter((r.doc_id, r.kept) for r in twice) == Counter({(r.doc_id, r.kept): 2 for r in got})
    assert quality.judge(df.filter("false"), keep=("text",)).count() == 0


def test_sketch_merges(spark):
    df = quality.measure(docs(spark), keep=("lang", "source"))
    whole = {tuple(r)[:-1]: r.n for r in quality.sketches(df, ("lang", "source")).collect()}
    halves = Counter()
    for part in (df.filter("doc_id % 2 = 0"), df.filter("doc_id % 2 = 1 or doc_id is null")):
        for r in quality.sketches(part, ("lang", "source")).collect():
            halves[tuple(r)[:-1]] += r.n
    assert whole == dict(halves)


# ---------------------------------------------------------------- language model


class BruteTrigrams:
    """The definition of the model, word by word; words are texts and None is the end."""

    def __init__(self, rows, mu):
        self.uni, self.bi, self.tri, self.starts, self.mu = Counter(), Counter(), Counter(), 0, mu
        for w in rows:
            self.starts += 1
            self.uni.update(w)
            self.bi.update(zip(["<s>", *w[:-1]], w))
            self.tri.update(zip(["<s>", *w[:-2]], w, w[1:]))
        self.n, self.v = sum(self.uni.values()), len(self.uni)

    def p(self, w, h=None, g=None):
        p = (self.uni[w] + 1) / (self.n + self.v + 1)
        if h is not None:
            p = (self.bi[h, w] + self.mu[0] * p) / ((self.starts if h == "<s>" else self.uni[h]) + self.mu[0])
        if g is not None:
            p = (self.tri[g, h, w] + self.mu[1] * p) / (self.bi[g, h] + self.mu[1])
        return p

    def score(self, w):
        before = ["<s>", *w]
        return sum(math.log10(self.p(x, before[i], before[i - 1] if i else None)) for i, x in enumerate(w))


def lm_rows(df):
    lower = lambda t: t.translate({c: c + 32 for c in range(65, 91)})
    return [(r.doc_id, WORD.findall(lower(r.text or "")) + [None]) for r in df.collect()]


def test_lm(spark):
    df = docs(spark, corpus() + list(thue_morse(64)) + ["only two", "two only two only two"])
    fold = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7
    rows = lm_rows(df)
    mu = (50.0, 7.0)
    brute = BruteTrigrams([w for d, w in rows if fold(d) != 2], mu)
    got = {r.doc_id: r for r in lm.score(df, mu=mu).collect()}
    for d, w in rows:
        r = got[d]
        base = sum(math.log10(brute.p(x)) for x in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(d) == 2, len(w), sum(brute.uni[x] > 0 for x in w), brute.n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(brute.score(w))
    for g, h in ((None, None), (None, "the"), ("<s>", "the"), ("only", "two"), ("two", "only"), ("the", "quick"), (None, "unseen"), ("a", "unseen")):
        assert sum(brute.p(x, h, g) for x in [*brute.uni, "unseen"]) == pytest.approx(1)
    assert lm.score(empty(spark)).count() == 0
    twice = Counter((r.doc_id, r.n_tokens) for r in lm.score(df.union(df)).collect())
    assert twice == Counter({(d, len(w)): 2 for d, w in rows})
    nothing = lm.score(df.limit(3), held=9).collect() and lm.score(df.limit(3), folds=1, held=0).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(r.base_score) for r in nothing)


def test_lm_of_longer_history_is_better(spark, sf_dir):
    """Held-out texts are likelier under the trigrams than under the bigrams, and these than under the root."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mean = lambda mu: lm.score(df, mu=mu).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    (three, one), (two, _) = mean((lm.MU, lm.MU_PAIR)), mean((lm.MU, 1e12))
    assert three > two > one


def test_lm_in_blocks(spark, monkeypatch):
    df = docs(spark)
    whole = {r.doc_id: r.score for r in lm.score(df).collect()}
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 5000)
    assert {r.doc_id: pytest.approx(r.score) for r in lm.score(df).collect()} == whole


# ---------------------------------------------------------------- near-duplicates


def brute_near(texts):
    sets = {}
    for d, t in texts.items():
        w = WORD.findall(t.translate({c: c + 32 for c in range(65, 91)}))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {d: d for d in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_texts():
    """Chains of near copies: neighbours are linked, ends are not."""
    r = np.random.default_rng(3)
    texts = corpus(n=20)
    for _ in range(3):
        words = list(r.choice([f"v{i}" for i in range(3000)], 120))
        for k in range(25):
            words = words.copy()
            words[int(r.integers(120))] = f"z{k}"
            texts.append(" ".join(words))
        for k in range(25):  # a star of copies with several changes each
            copy = words.copy()
            for _ in range(k % 7):
                copy[int(r.integers(120))] = f"q{k}{r.integers(99)}"
            texts.append(" ".join(copy))
    return texts


def test_near(spark):
    df = docs(spark, near_texts())
    want = brute_near(texts_of(df))
    got = {r.doc_id: r for r in near.near_duplicates(df).collect()}
    assert {d: (got[d].n_shingles, got[d].component_id) for d in want} == want
    assert all(got[d].kept == (got[d].component_id == d) for d in want) and got[None].kept and got[None].component_id is None
    assert near.near_duplicates(empty(spark)).count() == 0


def test_near_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 7)
    df = docs(spark, near_texts(), nulls=False)
    want = brute_near(texts_of(df))
    assert {r.doc_id: r.component_id for r in near.near_duplicates(df).collect()} == {d: c for d, (_, c) in want.items()}


def test_near_blocks_are_bounded(spark, monkeypatch):
    """One bucket of 200 classes, half of them outside the first one's component: no block holds it whole, all pairs meet."""
    monkeypatch.setattr(near, "BLOCK", 10)
    member = spark.createDataFrame([(7, 0, 0, 200, i) for i in range(200)], "key long, band int, leader long, n long, rep long")
    labels = spark.createDataFrame([(i, 0) for i in range(100)], "v long, c long")
    star = spark.createDataFrame([], "a long, b long, both long, either long")
    classes = spark.createDataFrame([(i, 9, bytearray(b"x")) for i in range(200)], "rep long, n_shingles long, sketch binary")
    blocks = {}
    for r in near._open_buckets(member, labels, star, classes).collect():
        blocks.setdefault(r.block, []).append(r)
    assert max(map(len, blocks.values())) <= 6 * near.BLOCK
    met = {(a.rep, b.rep) for x in blocks.values() for a in x if a.asks for b in x if not b.asks}
    assert met == {(a, b) for a in range(100, 200) for b in range(200)}


def test_sketches():
    r = np.random.default_rng(0)
    x, y = r.integers(0, 1 << 63, 900, dtype=np.uint64), r.integers(0, 1 << 63, 300, dtype=np.uint64)
    both = np.sort(np.concatenate([x, y]))
    s = [near.sketch(np.sort(g), np.array([0, len(g)]))[0] for g in (x, y, both)]
    assert (near.merge_sketches(s[0], s[1]) == s[2]).all()
    j = near.estimate(s[0][None], s[2][None], np.array([900]), np.array([1200]))[0]
    assert abs(j - 0.75) < 0.12


# ---------------------------------------------------------------- tokens


ODD = ["", " \n", "á é 'S it's WE'LL ΟΔΟΣ İstanbul ǅ ß", "<|startoftext|>x<|ENDOFTEXT|> <|endoftext|><|endoftext|>", "a\x1cb\x1dc\x85d e​f \x01 g\x01", "日本語 👩‍👩‍👧 ½ ² ٣", "\x00 ﻿ ͅ", "a ́b", "ſ K Å ﬁ ẞ", "x" * 300]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_padding()
    t.no_truncation()
    return t


def test_bpe(spark, library):
    df = docs(spark, corpus(n=30) + ODD)
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids for r in df.collect()}
    got = bpe.encode(df).collect()
    assert len(got) == df.count()
    digests = {r.doc_id: r for r in bpe.encode_digest(df).collect()}
    for r in got:
        ids = want[r.doc_id]
        text = library.decode(ids, skip_special_tokens=False)
        assert (list(r.ids), r.n_tokens, r.decoded) == (ids, len(ids), text)
        d = digests[r.doc_id]
        assert (d.n_tokens, d.ids_sha256, d.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.encode(empty(spark)).count() == 0


def test_long_piece(library):
    b = bpe.loaded(bpe.vocabulary_path())
    for word in ("pneumonoultramicroscopicsilicovolcanoconiosis" * 3, "é" * 40, "=" * 70):
        assert b.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_long_word(library):
    """A word of a million letters, and others whose pieces are longer than those that are merged side by side."""
    r = np.random.default_rng(5)
    letters = "".join(r.choice(list("etaoinshrdlu"), 1 << 20))
    b = bpe.loaded(bpe.vocabulary_path())
    assert b.encode(letters) == library.encode(letters, add_special_tokens=False).ids
    assert "".join(b.decode(b.encode(letters)).split()).replace("</w>", "") == letters


def test_units(library):
    """Words of all kinds of letters and marks, cut in the quick way or the full one, give the library's ids."""
    r = np.random.default_rng(8)
    marks = [*"abzABZ019", *"ÀÉÖ×÷ØßàöøþÿŸĀªº²¼", *"'.,-_<|>&$%!?", *" \n\t\x0b\x1c\x1f\x7f\x00\x85\xa0", "e\u0301", "\u0301", "Σ", "σ", "İ", "日", "ก", "ا", "👩", "'s", "'LL", "<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(r.choice(marks, r.integers(0, 30))) for _ in range(3000)]
    for table in (bpe.loaded(bpe.vocabulary_path()).table, tokens._Library(bpe.vocabulary_path()).table):
        ids, cuts = table.ids(pa.array(texts))
        for t, a, b in zip(texts, cuts.tolist(), cuts[1:].tolist()):
            assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    few = bpe.UnitTable(bpe.loaded(bpe.vocabulary_path()).encode_units, most=50)  # starts anew many times
    assert [few.ids(pa.array([t]))[0].tolist() for t in texts[:200]] == [library.encode(t, add_special_tokens=False).ids for t in texts[:200]]


def test_re_pair():
    r = np.random.default_rng(1)
    for ids in (np.zeros(0), np.array([5]), np.full(1001, 7), r.integers(0, 9, 5000), np.tile([1, 2, 1, 2, 2], 300)):
        ids = ids.astype(np.uint32)
        rules, lengths, symbols = tokens.re_pair(ids, 50)
        assert (tokens.expand(symbols, rules, 50) == ids).all()
        for a, b in ((0, len(ids)), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids))):
            if 0 <= a < b:
                assert (tokens.expand_range(symbols, rules, lengths, 50, a, b) == ids[a:b]).all()
    assert len(symbols) < len(ids) / 2


def test_re_pair_is_whole():
    """In a full shard no pair stays frequent, many rules fit, and a long passage becomes one symbol."""
    r = np.random.default_rng(6)
    base = 1 << 21
    noise = iter(r.permutation(base)[: 1 << 20].astype(np.uint32).reshape(-1, 8))
    passage = r.integers(0, base, 300, dtype=np.uint32)
    many = r.permutation(base)[:18000].astype(np.uint32).reshape(-1, 2)  # 9,000 pairs
    parts = [x for _ in range(24) for x in (passage, next(noise))] + [x for i in r.permutation(np.repeat(np.arange(9000), 24)) for x in (many[i],)] + list(noise)
    ids = np.concatenate(parts)
    rules, lengths, symbols = tokens.re_pair(ids, base)
    assert (tokens.expand(symbols, rules, base) == ids).all()
    counts = np.unique((symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:], return_counts=True)[1]
    assert len(ids) > tokens.SHARD_IDS and counts.max() < tokens.FREQUENT
    assert len(rules) >= 9000 and lengths.max() == 300 and (symbols == base + lengths.argmax()).sum() == 24
    same = np.zeros(1000, np.uint32)
    rules, _, symbols = tokens.re_pair(same, 5)
    assert len(symbols) <= tokens.FREQUENT and (tokens.expand(symbols, rules, 5) == same).all()


def test_token_files(spark, library, tmp_path, monkeypatch):
    df = docs(spark, corpus(n=30) + ODD)
    rows = sorted(df.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    out = str(tmp_path / "t")
    monkeypatch.setattr(tokens, "SHARD_IDS", 500)
    tokens.write_tokens(df, out)
    got = {r.doc_id: r for r in tokens.read_tokens(spark, out).collect()}
    at = 0
    for r in rows:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, bytes(got[r.doc_id].ids)) == (at, len(ids), ids.tobytes())
        at += len(ids)
    some = tokens.read_tokens(spark, out, 100, 101).collect()
    assert len(some) == 1 and some[0].start <= 100 < some[0].start + some[0].n_tokens
    assert tokens.token_files(empty(spark)).count() == 0


# ---------------------------------------------------------------- pages


def pages(spark):
    rows = [(3, "http://b.example.com/x?y=1", "<p>same</p>"), (1, "https://a.example.com/", "<p>same</p>"), (2, "http://b.example.com/x?y=1", "é"), (5, None, None), (4, "no url at all\r\n", ""), (7, "http://[bad", "é"), (None, "http://c.example.com", "<p>same</p>")]
    return spark.createDataFrame(rows + [rows[0]], "page_id long, url string, html string")


def test_warc(spark):
    df = pages(spark)
    got = warc.archive(df).collect()
    assert len(got) == df.count()
    least = {}
    for r in df.collect():
        if r.page_id is not None:
            least[r.html or ""] = min(r.page_id, least.get(r.html or "", r.page_id))
    for r in got:
        html_ = {x.page_id: x.html or "" for x in df.collect()}[r.page_id]
        raw = html_.encode()
        first = least[html_]
        revisit = r.page_id is not None and r.page_id != first
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
    assert warc.archive(df.filter("false")).count() == 0


def test_warc_lookup(spark, tmp_path):
    df = pages(spark)
    out = "file://" + str(tmp_path / "w")
    warc.write_archives(df, out)
    one = warc.lookup(spark, out, df.filter("page_id = 2")).collect()
    assert [bytes(r.payload) for r in one] == ["é".encode()]
    missing = spark.createDataFrame([(99, "http://nowhere.example.com")], "page_id long, url string")
    assert warc.lookup(spark, out, missing).count() == 0
    assert warc.url_key("https://www.example.com:8080/a?b#c") == "com,example,www:8080)/a?b#c"


def test_html(spark):
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>'
        '<div class="ad">Buy this now</div><main><h1>Title &amp; more</h1><p>First   <b>bold</b>\n text &lt;here&gt;<p>Second one<br>goes on</p><form><input><label>Sign</label></form>'
        '<script>var x = "<p>no</p>";</script><ul><li>item</li></ul></main><div id="comments"><p>Nice post indeed, I liked reading it</p></div><aside>Side text</aside><footer>&copy; me</footer></body></html>'
    )
    df = spark.createDataFrame([(1, "u", page), (2, "v", ""), (3, None, None), (4, "w", "<p>just one</p>"), (5, "x", "<nav>menu only</nav>")], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.main_text(df).collect()}
    assert got == {1: "Title & more\nFirst bold text <here>\nSecond one goes on\nitem", 2: "", 3: "", 4: "just one", 5: ""}
    assert html.best_run([-1, 2, -1, 3, -5, 4]) == (1, 4) and html.best_run([-1.0]) == (0, 0)
    assert html.main_text(df.filter("false")).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ('<div class="content with-sidebar">{p}</div>', "{t}"),
        ('<div class="no-sidebar"><p>{t}</p></div>', "{t}"),
        ('<div class="post"><div class="entry-header"><h1>The title</h1></div>{p}</div>', "The title\n{t}"),
        ('<div class="post">{p}<h2 id="related-work">Related work</h2>{p}</div>', "{t}\nRelated work\n{t}"),
        ('<div class="post">{p}<section id="discussion"><h2>Discussion</h2>{p}</section></div>', "{t}\nDiscussion\n{t}"),
        ('<div class="post"><p>Go to <a href="/hidden-gems">hidden gems</a> now</p><p title="Hidden lake">A lake</p>{p}</div>', "Go to hidden gems now\nA lake\n{t}"),
        ('<div class="header">Our site</div><div class="article-content">{p}<section class="discussion"><p>I like it</p></section></div>', "{t}"),
        ('<div class="post">{p}<div class="ad">Buy one now</div>{p}<p hidden>not shown</p></div><div class="sidebar"><p>More to see</p></div><div id="comments"><p>Nice post</p></div>', "{t}\n{t}"),
    ],
)
def test_html_marks(page, want):
    """Names with marks around the main text don't remove it; adverts, sidebars and comments still go."""
    t = " ".join(LOREM * 2)
    got = html.extract("<html><body>" + page.format(p=f"<p>{t}</p>", t=t) + "</body></html>", html.Weights(html.labelled_pages()))
    assert got == want.format(t=t)


def labelled_text(page):
    """What the labels of a page say is its main text, block by block."""
    blocks, label = [[]], 0
    for kind, key, text, wordless, _, _ in html.items(page):
        if kind == "label":
            label += html.LABELS[key]
        elif kind == "text" and label > 0 and not wordless:
            blocks[-1].append(text)
        elif kind == "tag" and key.strip("/") in html.BLOCKS:
            blocks.append([])
        elif key == "br":
            blocks[-1].append(" ")
    return "\n".join(x for x in (" ".join("".join(b).split()) for b in blocks) if x)


def test_html_learns():
    """Labelled pages by their own weights, and each by the weights of the others, whose layouts differ."""
    all_ = html.labelled_pages()
    weights = html.Weights(all_)
    assert sum(html.extract(x, weights) == labelled_text(x) for x in all_) >= len(all_) - 1
    alike = []
    for i, page in enumerate(all_):
        a, b = (Counter(x.split()) for x in (html.extract(page, html.Weights(all_[:i] + all_[i + 1 :])), labelled_text(page)))
        alike.append(2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values())))
    assert sum(alike) / len(alike) > 0.85


def test_best_run():
    r = np.random.default_rng(4)
    for _ in range(300):
        x = r.integers(-5, 6, r.integers(0, 12)).tolist()
        a, b = html.best_run(x)
        assert sum(x[a:b]) == max([0] + [sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)])


def test_html_run_decides(sf_dir, monkeypatch):
    """On the tables' pages the main text is what stands in the article, and without the run it would be more."""
    import pyarrow.parquet as pq

    all_ = pq.read_table(f"{sf_dir}/pages.parquet").column("html").to_pylist()
    weights = html.Weights(html.labelled_pages())

    def article(page):
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = re.split(r"</?(?:p|h1|h2|li|ul|ol|div|blockquote)[^>]*>", re.sub(r"<br\s*/?>", " ", inner))
        return "\n".join(x for x in (" ".join(html.entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks) if x)

    found = [html.extract(x, weights) for x in all_]
    assert found == [article(x) for x in all_]
    monkeypatch.setattr(html, "best_run", lambda scores: (0, len(scores)))
    assert all(html.extract(x, weights) != f for x, f in zip(all_, found))


def test_html_odd_pages(spark):
    """Ties, repeated rows, null ids, a very long page and other columns of all names."""
    long = "<article>" + "<p>some words in a row</p>" * 60_000 + "</article><footer>end</footer>"
    rows = [(1, "u", "<p>same</p>", "x", 1), (1, "u", "<p>same</p>", "x", 1), (None, None, "<p>same</p>", None, None), (2, "v", long, "y", 2), (3, "w", "<<<>>> &amp; <p", "z", 3), (4, "w", "\x00&#0;&bogus;", "z", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = html.main_text(df).collect()
    assert sorted((str(r.page_id), r.text[:20], r.n_chars) for r in got)[:3] == [("1", "same", 4), ("1", "same", 4), ("2", "some words in a row\n", 60_000 * 20 - 1)]
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)


def test_classifier(spark):
    r = np.random.default_rng(5)
    vocabulary = [f"{a}{b}" for a in LOREM for b in LOREM]
    texts = [" ".join(r.choice(vocabulary, 60)) for _ in range(160)]
    labels = [1] * 160
    for i in range(0, 160, 3):
        texts[i] = " ".join(x + "$$$%" for x in texts[i].split())
        labels[i] = 0
    df = docs(spark, texts)
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (1000, None)], "doc_id long, quality int")
    net = classifier.train(df, marks)
    got = classifier.classify(df, net).collect()
    assert len(got) == df.count() and all(0 <= x.score <= 1 for x in got)
    held = [(x.predicted, labels[x.doc_id]) for x in got if x.held_out and x.doc_id is not None and x.doc_id < 160]
    assert len(held) > 10 and sum(a == b for a, b in held) / len(held) > 0.9
    assert classifier.classify(empty(spark), net).count() == 0
    assert len(net.score(pa.array(["", "x" * 100_000], pa.string()))) == 2


def test_classifier_held_out():
    """Held-out accuracy on the tables, better than always guessing the commoner label; long labelled texts take part."""
    import os

    from pyspark.sql import SparkSession

    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("no test tables here")
    spark = SparkSession.getActiveSession()
    df, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.classify(df, classifier.train(df, labels)).join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    right = sum(r.predicted == r.quality for r in got) / len(got)
    common = sum(r.quality for r in got) / len(got)
    assert right > max(common, 1 - common) + 0.03


def test_classifier_without_labels(spark):
    df = docs(spark, ["a text", "another", "", "x " * 40_000])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in classifier.classify(df, classifier.train(df, none)).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1) for i in range(4)], "doc_id long, quality int")
    assert min(r.score for r in classifier.classify(df, classifier.train(df, one)).collect()) > 0.99
    both = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (3, 0)], "doc_id long, quality int")
    assert classifier.classify(df.union(df), classifier.train(df.union(df), both, folds=1, held=1)).count() == 2 * df.count()


def test_exact_sets():
    texts = ["a b c d e f g a b c d e", "A B c d e f", "", "one two", "One two", "two one", "a b c d e", *thue_morse(64)]
    g, at = near.exact_sets(pa.array(texts))
    own = [set(g[a:b].tolist()) for a, b in zip(at, at[1:])]
    h, to = near.shingle_sets(pa.array(texts))
    assert (at == to).all() and own[3] == own[4] != own[5] and own[1] <= own[0] and own[6] <= own[1] and not own[7] & own[8] and not own[2]


def test_gradient():
    """The hand-written gradient agrees with differences of the loss."""
    net = classifier.Network()
    net.w = {k: x.astype(np.float64) for k, x in net.w.items()}
    texts, y, weight = pa.array(["hello world " * 60, "abc $$$ def"]), np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        p = np.clip(net.score(texts), 1e-9, 1 - 1e-9)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    g = net._gradient(texts, y, weight)
    for name, at in (("out", 3), ("out_bias", 0), ("hidden", (4, 5)), ("filter", (7, 2)), ("bias", 2), ("vector", (ord("o"), 1))):
        x, h = net.w[name], 1e-3
        x[at] += h
        up = loss()
        x[at] -= 2 * h
        down = loss()
        x[at] += h
        assert g[name][at] == pytest.approx((up - down) / (2 * h), rel=0.05, abs=1e-4), name


# ---------------------------------------------------------------- queries and pipeline


def test_queries_match_sql(spark, sf_dir):
    from oracle import assert_same, connect

    from genoframe.llm import queries

    con = connect(sf_dir)
    for name, sql in queries.oracle_sql().items():
        assert_same(spark, sf_dir, queries.queries()[name], sql, con)


def test_near_query(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute_near(texts_of(df))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(df).collect()} == want


def test_pipeline(spark, sf_dir, library):
    """Each stage against brute force on what the stage before kept."""
    import corpus_pipeline as P

    here = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stages = dict(P.STAGES)
    keep = spark.createDataFrame(stages["quality_rules"](spark, here, sf_dir).collect(), here.schema)
    judged = connect(sf_dir).execute("WITH " + queries.QUALITY_CTES.replace("{docs}", "documents") + "SELECT doc_id FROM judged WHERE kept").fetchall()
    assert {r.doc_id for r in keep.collect()} == {d for d, in judged} and keep.columns == here.columns
    want = {d for d, (_, c) in brute_near(texts_of(keep)).items() if c == d}
    alone = spark.createDataFrame(stages["near_dedup"](spark, keep, sf_dir).collect(), here.schema)
    assert {r.doc_id for r in alone.collect()} == want
    cut = spark.createDataFrame(stages["substring_dedup"](spark, alone, sf_dir).collect(), here.schema)
    left = brute_substring(texts_of(alone), 20)
    assert {r.doc_id: " ".join(WORD.findall(r.text)) for r in cut.collect()} == {d: k for d, (_, _, k) in left.items()}
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    clean = spark.createDataFrame(stages["benchmark_decontamination"](spark, cut, sf_dir).collect(), here.schema)
    assert {r.doc_id for r in clean.collect()} == {d for d, (_, hit, _) in brute_contamination(texts_of(cut), bench).items() if not hit}
    final = {r.doc_id: list(r.ids) for r in stages["bpe_encoding"](spark, clean, sf_dir).collect()}
    assert final == {d: library.encode(t, add_special_tokens=False).ids for d, t in texts_of(clean).items()}
    assert {r.doc_id for r in P.run(spark, sf_dir).collect()} == set(final)


def test_pipeline_decodes(spark, sf_dir, library):
    """The last stage takes all steps of op8: encoding, and decoding of the document's own ids."""
    import corpus_pipeline as P

    rows = [(1, "Hello,  World <|x|> 42", "en", "s", 1), (2, None, "en", "s", 0), (3, "\u00c4pfel don't", "de", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for r in P.bpe_encoding(spark, docs, sf_dir).collect():
        assert r.decoded == library.decode(list(r.ids), skip_special_tokens=False)
