"""Secret scans by corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found in whole texts by regular expressions; where a candidate begins
follows from the lengths of the pieces between the matches.  The SHA-256 of every
candidate's value is counted by distinct owners and repositories over the corpus: a
value that several owners hold is a copied example, one that a single owner holds and
that looks random is taken for a live credential.  Tokens of no known kind become spans
by that verdict alone.

A value may be in a third of all documents.  Its owners are counted after each task has
merged equal (value, owner, repository) rows, and documents learn the verdict over
(value, salt) keys: every salt that occurs with a value is one row on the side of the
counts, so that side is never longer than the other, and no key holds more than the
documents of one salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, settled, text_key

#: The kinds in their order, the group that holds the value, and the value's least length.  A run of one
#: class can carry that length in its pattern, as what follows a run that is too short there is no longer.  An assignment
#: can't: one whose value is too short still hides another that begins inside of it.
KINDS = {
    "assign": (r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: Tokens of no known kind, which become spans only as live credentials.
OPAQUE = (r"[A-Za-z0-9+/_-]{20,}", 0, 20)
#: A value looks random if it has letters, digits and so many different characters.
DIFFERENT = 10
#: A live credential has so many owners at most, a copied example has so many at least.
LIVE_OWNERS, COPIED_OWNERS = 1, 3
#: Documents that hold one value are dealt over so many keys.
SALTS = 1024
#: Numbers that are summed up one after another; longer lists are summed by blocks.
BLOCK = 512

SPAN = "struct<start:long,kind:int,end:long>"
NAMES = [*KINDS, "opaque"]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _running(numbers: Column) -> Column:
    """Of numbers, the sums of those before each, and the sum of all at the end."""
    return F.aggregate(numbers, F.array(F.lit(0).cast("long")), lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x))


def before(numbers: Column) -> Column:
    """``_running`` of a long array, without the last one: by blocks, so that a list of a million numbers takes no quadratic time."""
    starts = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int"))
    blocks = F.transform(starts, lambda b: _running(F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK))))
    shifted = lambda block, base: F.transform(F.slice(block, F.lit(1), F.size(block) - 1), lambda x: x + base)
    shift = lambda inner: _let(_running(F.transform(inner, lambda x: F.element_at(x, -1))), lambda outer: F.flatten(F.zip_with(inner, F.slice(outer, F.lit(1), F.size(inner)), shifted)))
    return _let(blocks, shift)


def matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """Leftmost matches that do not overlap and whose ``group`` has ``least`` characters: ``start``, ``end`` (code points) and ``value``."""
    whole, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    sizes = lambda xs: F.transform(xs, lambda x: F.length(x).cast("long"))
    gaps = sizes(F.split(text, pattern, -1))  # one more than matches

    def placed(found: Column) -> Column:
        at = lambda gap: _let(
            before(F.zip_with(F.slice(gap, F.lit(1), F.size(found)), sizes(found), lambda g, s: g + s)),
            lambda past: F.zip_with(F.arrays_zip(past.alias("past"), gap.alias("gap"), found.alias("found")), values, lambda p, v: F.struct((p.past + p.gap).alias("start"), (p.past + p.gap + F.length(p.found)).alias("end"), v.alias("value"))),
        )
        return F.filter(_let(gaps, at), lambda m: F.length(m.value) >= least)

    return _let(whole, placed)


def _found(text: Column) -> Column:
    """All candidates of a text: ``start``, ``kind`` (its number), ``end``, ``value``."""
    none = F.array().cast("array<struct<start:long,kind:int,end:long,value:string>>")

    def of_kind(number: int, pattern: str, group: int, least: int) -> Column:
        numbered = F.transform(matches(text, pattern, group, least), lambda m: F.struct(m.start.alias("start"), F.lit(number).alias("kind"), m.end.alias("end"), m.value.alias("value")))
        return F.when(text.rlike(pattern), numbered).otherwise(none)  # one pass tells that a text has none

    return F.concat(*[of_kind(i, *kind) for i, kind in enumerate([*KINDS.values(), OPAQUE])])


def random_looking(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(F.substring(value, 1, 256), ""))) >= DIFFERENT)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: tuple[str, ...] = ("source",), repo: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row for each row: ``id``, ``same`` (key of the text), ``owner``, ``repo`` and ``found``, with the SHA-256 of each value and whether it looks random."""
    text = F.coalesce(col(text_col), F.lit(""))
    sealed = lambda m: F.struct(m.start.alias("start"), m.kind.alias("kind"), m.end.alias("end"), F.sha2(m.value, 256).alias("hash"), random_looking(m.value).alias("random"))
    rows = docs.select(col(id_col).alias("id"), text_key(col(text_col)).alias("same"), F.struct(*map(col, owner)).alias("owner"), F.struct(*map(col, repo)).alias("repo"), _found(text).alias("found"))
    return rows.withColumn("found", F.transform("found", sealed))


def ownership(found: DataFrame) -> DataFrame:
    """``hash``, ``n_owners``, ``n_repos``: distinct owners and (owner, repository) pairs of every value; a null owner is one owner."""
    held = found.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    owners = held.groupBy("hash", "owner").agg(F.count("*").alias("n_repos"))
    return owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n_repos").alias("n_repos"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: tuple[str, ...] = ("source",), repo: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``id_col``, ``base`` and ``spans`` (arrays of SPAN by start and kind), ``n_live`` and ``n_copied`` (distinct values) for each row.

    ``base`` are the spans of KINDS, ``spans`` those and the live tokens of no known kind
    whose value no kind finds in the same text.  Owner and repository of a document are
    the columns ``owner`` and ``repo``; a null in them is a value of its own.  A null or
    empty text has no spans.  Very long texts are scanned whole, in time and memory in
    proportion to their length.  Repeated rows count once and each get a row; rows with
    one id and different texts, and with a null id, are judged by their own texts.  A
    value of exactly LIVE_OWNERS owners is live, one of COPIED_OWNERS copied: there are no
    ties.  An empty table gives an empty one; other columns are ignored.
    """
    rows = settled(candidates(docs, id_col, text_col, owner, repo), "secrets")
    found = rows.select("id", "same", "owner", "repo", F.explode("found").alias("m")).select("id", "same", "owner", "repo", "m.*")
    salt = F.pmod(F.xxhash64("id", "same"), F.lit(SALTS)).alias("salt")
    held = found.select("id", "same", "hash", "random", "start", "kind", "end", salt).distinct()
    counts = held.select("hash", "salt").distinct().join(ownership(found), "hash")
    live, copied = F.col("random") & (F.col("n_owners") <= LIVE_OWNERS), F.col("n_owners") >= COPIED_OWNERS
    token = F.when(F.col("kind") == len(KINDS), F.struct("start", "kind", "end"))
    values = held.join(counts, ["hash", "salt"]).groupBy("id", "same", "hash").agg(F.min("kind").alias("first"), F.max(live).alias("live"), F.max(copied).alias("copied"), F.collect_list(token).alias("tokens"))
    unknown = F.when(F.col("live") & (F.col("first") == len(KINDS)), F.col("tokens"))
    verdict = values.groupBy("id", "same").agg(F.count_if("live").alias("n_live"), F.count_if("copied").alias("n_copied"), F.flatten(F.collect_list(unknown)).alias("tokens"))
    verdict = verdict.select(F.col("id").alias("of"), F.col("same").alias("of_same"), "n_live", "n_copied", "tokens")
    none, zero = F.array().cast(f"array<{SPAN}>"), F.lit(0).cast("long")
    base = F.array_sort(F.transform(F.filter("found", lambda m: m.kind < len(KINDS)), lambda m: F.struct(m.start.alias("start"), m.kind.alias("kind"), m.end.alias("end"))))
    here = F.col("id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("of_same"))
    with_any = rows.filter(F.size("found") > 0).withColumn("base", base).join(verdict, here)
    with_any = with_any.select("id", "base", F.array_sort(F.concat("base", "tokens")).alias("spans"), "n_live", "n_copied")
    without = rows.filter(F.size("found") == 0).select("id", none.alias("base"), none.alias("spans"), zero.alias("n_live"), zero.alias("n_copied"))
    return with_any.union(without).withColumnRenamed("id", id_col)


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    name = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.element_at(name, m.kind + 1), m.start.cast("string"), m.end.cast("string"))), ",")
