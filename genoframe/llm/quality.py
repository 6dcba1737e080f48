"""Quality rules with thresholds from mergeable quantile sketches per language and source.

The sketch is a log-linear histogram of integer measures: 32 bins for each power of
two, so a bin is at most 1/32 of its value wide.  Sketches merge by adding counts,
which is an ordinary grouped sum with map-side combining; a language and source that
hold a third of all rows still arrive as a few hundred rows for each task.

A group's sketch is blended with that of its language, which counts as PRIOR documents,
so a small source is judged by its language and a large one by itself.  An upper
quantile of the blend, and its distance to the median, give each threshold.  Where most
texts of a group have none of what is measured, that quantile says nothing: then the
threshold is the median of the part above zero, times the share of that part, so what is
rare in a group is allowed little of and what is common much.  Thresholds are rates: what
a text may have grows with its length.  Documents are filtered by a join with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, col, column, mix, settled, slices

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LETTER = np.ones(256, bool)  # bytes that begin a code point
LETTER[128:192] = False
REPEAT = 5
MEASURES = ("symbols", "repeats", "lines", "letters")
#: Each measure's count, and what of it is measured: thousandths of the words, hundredths of a letter.
COUNTS = {"symbols": ("n_symbols", 1000), "repeats": ("n_repeat_words", 1000), "lines": ("n_dup_lines", 1000), "letters": ("word_chars", 100)}
#: Threshold of a measure: its quantile of so many hundredths, plus so many times the distance from the median to there;
#: at least the median of the values above zero times their share.
FENCES = {"symbols": (75, 3), "repeats": (99, 1), "lines": (99, 1), "letters": (90, 4)}
#: Standard errors by which a count must exceed what the threshold allows in a text of that length, so that
#: short texts aren't judged by chance.  Repeats come in bunches, whose count has no such error.
ERRORS = {"symbols": 3, "repeats": 0, "lines": 0, "letters": 3}
#: Documents of its language that a group's sketch is blended with.
PRIOR = 200
#: Thresholds of so many groups are small enough to be sent to every executor; more are joined by a shuffle.
FEW_GROUPS = 50_000
MEASURED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, ``keep`` and the counts of MEASURED for each row; a null text counts as empty."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    names = ["id", *[f"keep{i}" for i in range(len(keep))]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts = _counts(column(part, "text"))
                yield pa.RecordBatch.from_arrays([*[column(part, n) for n in names], *[pa.array(x, pa.int64()) for x in counts]], names=[*names, *[x.split()[0] for x in MEASURED.split(", ")]])

    chosen = docs.select(col(id_col).alias("id"), *[col(k).alias(f"keep{i}") for i, k in enumerate(keep)], col(text_col).alias("text"))
    schema = ", ".join(f"{n} {fields[k]}" for n, k in zip(names, [id_col, *keep]))
    out = chosen.mapInArrow(run, f"{schema}, {MEASURED}")
    for n, k in zip(names, [id_col, *keep]):
        out = out.withColumnRenamed(n, k)
    return out


def _counts(texts: pa.Array) -> list[np.ndarray]:
    words = Words(texts)
    raw, at = words.raw, words.at
    total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[at])
    word_chars = total(words.inside() & LETTER[raw])
    lines = []
    for t in texts.to_pylist():
        full = [x for x in (t or "").split("\n") if x.strip("\t\n\x0b\x0c\r ")]
        lines.append(len(full) - len(set(full)))
    g, ok = words.grams(words.hashes(), REPEAT)
    place = np.flatnonzero(ok)
    key = g[place] ^ mix(words.doc[place].astype(np.uint64))
    order = np.argsort(key)
    equal = key[order][1:] == key[order][:-1]
    twin = np.zeros(len(place), bool)
    twin[order[1:][equal]] = True
    twin[order[:-1][equal]] = True
    edge = np.zeros(len(words) + REPEAT + 1, np.int64)
    edge[place[twin]] += 1
    edge[place[twin] + REPEAT] -= 1
    repeated = np.cumsum(edge)[: len(words)] > 0
    return [words.counts, word_chars, total(SYMBOLS[raw]), np.array(lines, np.int64), np.bincount(words.doc[repeated], minlength=len(words.counts))]


def measures() -> dict[str, Column]:
    """The measures that thresholds apply to, as integers; null without words."""
    return {m: F.when(F.col("n_words") > 0, F.expr(f"{count} * {scale} div n_words")) for m, (count, scale) in COUNTS.items()}


def exceeds(measure: str, most: Column) -> Column:
    """Whether a document's count is above what a threshold allows at its length, by more than ERRORS standard errors (of one count more); not without a threshold."""
    count, scale = COUNTS[measure]
    allowed = most.cast("double") * F.col("n_words")
    over = F.col(count).cast("double") * scale - allowed
    return F.coalesce((over > 0) & (over * over > float(ERRORS[measure] ** 2 * scale) * (allowed + scale)), F.lit(False))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def sketches(measured: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Quantile sketches: ``groups``, ``measure``, ``bin``, ``n``; the sum of two sketches is the sketch of both inputs."""
    stacked = measured.filter(~base_failed()).select(*map(col, groups), F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("v")) for k, v in measures().items()])).alias("m"))
    power = F.length(F.bin("m.v")) - 6
    shifted = F.expr("shiftright(m.v, length(bin(m.v)) - 6)")
    return stacked.select(*map(col, groups), "m.measure", F.when(F.col("m.v") < 64, F.col("m.v")).otherwise(32 * power + shifted).alias("bin")).groupBy(*map(col, groups), "measure", "bin").agg(F.count("*").alias("n"))


def thresholds(sketch: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """One row for each group with ``<measure>_most``, from its sketch blended with that of all groups that share the first of ``groups``.

    Bins are weighed as the group's count times the language's size plus PRIOR times the
    language's count: whole numbers, so the order of summing doesn't matter.  Bin 0 holds
    the zeros alone.
    """
    wide = groups[:1]
    names = {g: F.col(g).alias(f"w{i}") for i, g in enumerate(wide)}
    language = sketch.groupBy(*map(col, wide), "measure", "bin").agg(F.sum("n").cast("double").alias("n_wide"))
    language = language.withColumn("all_wide", F.sum("n_wide").over(Window.partitionBy(*map(col, wide), "measure")))
    language = language.select(*names.values(), F.col("measure").alias("m"), F.col("bin").alias("b"), "n_wide", "all_wide")
    same = [F.col(g).eqNullSafe(F.col(f"w{i}")) for i, g in enumerate(wide)] + [F.col("measure") == F.col("m")]
    own = sketch.groupBy(*map(col, groups), "measure").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("bins"))  # a few hundred bins
    weight = F.coalesce(F.try_element_at("bins", F.col("b")), F.lit(0)) * F.col("all_wide") + PRIOR * F.col("n_wide")
    blend = own.join(language, same).select(*map(col, groups), "measure", "b", weight.alias("w"))
    group = Window.partitionBy(*map(col, groups), "measure")
    bins = blend.withColumn("upto", F.sum("w").over(group.orderBy("b"))).withColumn("all", F.sum("w").over(group)).withColumn("none", F.sum(F.when(F.col("b") == 0, F.col("w")).otherwise(0)).over(group))
    low = F.expr("CASE WHEN b < 64 THEN b ELSE shiftleft(b - 32 * (b div 32 - 1), cast(b div 32 - 1 AS int)) END")
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("all") * q, low))
    level = F.create_map(*[F.lit(x) for m, (p, _) in FENCES.items() for x in (m, p)])
    reach = F.create_map(*[F.lit(x) for m, (_, r) in FENCES.items() for x in (m, r)])
    some = F.min(F.when((F.col("b") > 0) & ((F.col("upto") - F.col("none")) * 100 >= (F.col("all") - F.col("none")) * 50), low))
    share = F.max((F.col("all") - F.col("none")) / F.col("all"))
    cuts = bins.groupBy(*map(col, groups), "measure").agg(at(50).alias("mid"), at(level[F.col("measure")]).alias("high"), (share * F.coalesce(some, F.lit(0))).alias("rare"))
    most = F.greatest(F.col("high") + reach[F.col("measure")] * (F.col("high") - F.col("mid")), F.col("rare"))
    return cuts.groupBy(*map(col, groups)).agg(*[F.max(F.when(F.col("measure") == m, most)).alias(f"{m}_most") for m in MEASURES])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, ...] = ("lang", "source"), keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns ``keep``, the counts of MEASURED, ``base_failed`` and ``kept`` for each row.

    ``kept`` is false for rows that fail the base rules and for those that exceed a
    threshold of their language and source (``groups``; the first one is the language).
    A null or empty text has no words and fails; a null language or source is a group of
    its own; a group none of whose rows pass the base rules has no thresholds.  Very long
    texts are measured whole.  Repeated rows count each time and give repeated results;
    a null id is passed on; other columns are ignored, whatever their names.  Texts are
    measured once, unless columns are to be kept, which are read again instead of stored.
    """
    names = tuple(f"g{i}" for i in range(len(groups)))
    kept = tuple(f"k{i}" for i in range(len(keep)))
    plain = docs.select(col(id_col).alias("id"), col(text_col).alias("text"), *[col(g).alias(n) for g, n in zip(groups, names)], *[col(k).alias(n) for k, n in zip(keep, kept)])
    once = measure(plain, "id", "text", names) if keep else settled(measure(plain, "id", "text", names), "measured")
    cuts = settled(thresholds(sketches(once, names), names).toDF(*[f"t{i}" for i in range(len(names))], *[f"{m}_most" for m in MEASURES]), "thresholds")
    few = cuts.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    rows = measure(plain, "id", "text", (*names, *kept)) if keep else once
    same = [F.col(g).eqNullSafe(F.col(f"t{i}")) for i, g in enumerate(names)]
    over = [exceeds(m, F.col(f"{m}_most")) for m in MEASURES]
    bad = over[0] | over[1] | over[2] | over[3]
    return rows.join(F.broadcast(cuts) if few else cuts, same, "left").select(
        F.col("id").alias(id_col), *[F.col(n).alias(k) for n, k in zip(kept, keep)], *[x.split()[0] for x in MEASURED.split(", ")], base_failed().alias("base_failed"), (~base_failed() & ~bad).alias("kept")
    )
