"""Reference sequence as a table of blocks, and what needs its bases: checks, windows, left-alignment of indels.

A contig is any number of rows of WIDTH bases, so it is never in one row.  Where bases
around a position are needed, a block brings its neighbours along, and rows are joined to
it by an equi-join on contig and block number.  Positions count from 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settled

WIDTH = 4096
#: Bases in front of an indel that the first rounds of the alignment look at; the few rows that go on use the whole window.
REACH = (12, 128)


def blocks(pieces: DataFrame, chrom: str = "chrom", start: str = "start", bases: str = "bases", width: int = WIDTH) -> DataFrame:
    """``chrom``, ``block``, ``bases`` (upper case) from pieces of any length that begin at ``start`` and follow each other without gaps."""
    at, n = F.col(start).cast("long") - 1, F.length(bases)
    rows = pieces.filter(n > 0).select(F.col(chrom).alias("chrom"), at.alias("_at"), F.upper(bases).alias("_b"))
    block = F.explode(F.sequence(F.floor(F.col("_at") / width), F.floor((F.col("_at") + F.length("_b") - 1) / width)))
    cut = rows.withColumn("block", block).withColumn("_from", F.greatest(F.col("block") * width, "_at"))
    part = F.substring("_b", (F.col("_from") - F.col("_at") + 1).cast("int"), ((F.col("block") + 1) * width - F.col("_from")).cast("int"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_from", part.alias("b")))), lambda x: x["b"]), "")
    return cut.groupBy("chrom", "block").agg(joined.alias("bases"))  # at most ``width`` bases


def with_neighbours(reference: DataFrame) -> DataFrame:
    """Blocks with the bases of the blocks before and behind."""
    side = lambda by, name: reference.select("chrom", (F.col("block") + by).alias("block"), F.col("bases").alias(name))
    joined = reference.join(side(1, "before"), ["chrom", "block"], "left").join(side(-1, "after"), ["chrom", "block"], "left")
    return joined.fillna("", ["before", "after"])


def with_bases(df: DataFrame, reference: DataFrame, out: str, at: Column, n: Column, chrom: str = "chrom", width: int = WIDTH) -> DataFrame:
    """The ``n`` bases from position ``at`` on, up to ``width``; fewer at a contig's end, empty where the reference has none."""
    rows = df.withColumns({"_at": at.cast("long") - 1, "_n": n.cast("int")}).withColumn("_block", F.floor(F.col("_at") / width))
    near = with_neighbours(reference).select(F.col("chrom").alias("_c"), F.col("block").alias("_b"), F.concat("bases", "after").alias("_s"))
    joined = rows.join(near, (F.col(chrom) == F.col("_c")) & (F.col("_block") == F.col("_b")), "left")
    text = F.substring("_s", (F.col("_at") - F.col("_block") * width + 1).cast("int"), F.least("_n", F.lit(width)))
    return joined.withColumn(out, F.coalesce(F.when(F.col("_n") > 0, text), F.lit(""))).drop("_at", "_n", "_block", "_c", "_b", "_s")


def _common(a: Column, b: Column) -> Column:
    """How many first letters of two texts are equal; letter by letter on arrays, so that no text is cut again for each letter."""
    letters = lambda x: F.split(x, "")
    unlike = F.zip_with(letters(a), letters(b), lambda x, y: ~x.eqNullSafe(y))
    shorter = F.least(F.length(a), F.length(b))
    at = F.array_position(unlike, True)
    return F.when(shorter == 0, F.lit(0)).when(at == 0, shorter).otherwise(F.least(at - 1, shorter)).cast("int")


def common_prefix(a: Column, b: Column, spare: int = 0) -> Column:
    """Length of the common beginning, leaving ``spare`` letters of the shorter text."""
    return F.greatest(F.least(_common(a, b), F.least(F.length(a), F.length(b)) - spare), F.lit(0))


def left_align(df: DataFrame, reference: DataFrame, chrom: str = "chrom", pos: str = "pos", ref: str = "ref", alt: str = "alt", width: int = WIDTH) -> DataFrame:
    """Each row's ``pos``, ``ref`` and ``alt`` in the shortest form that lies furthest to the left.

    Equal ends are taken off both alleles, then equal beginnings.  What is left of an
    insertion or deletion moves to the left over bases that equal its end, as far as the
    block before reaches; rows that got there go on in another round, so repeats of any
    length are followed.  An allele that isn't written in A, C, G, T, N or that equals
    the other one is left alone, and so is a row with nulls or without reference bases
    in front.  At the start of a contig the base behind is the anchor.  Repeated rows
    stay; column names beginning with ``_`` are not allowed.
    """
    kept = df.columns
    plain = F.col(ref).rlike("^[ACGTNacgtn]+$") & F.col(alt).rlike("^[ACGTNacgtn]+$") & (F.upper(ref) != F.upper(alt)) & F.col(chrom).isNotNull() & F.col(pos).isNotNull()
    once = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  (a value that is used several times)
    cut = lambda r, a, end: F.struct(F.left(r, F.length(r) - end).alias("r"), F.left(a, F.length(a) - end).alias("a"))
    rest = lambda x, n: F.struct(x.r.substr(n + 1, F.length(x.r)).alias("r"), x.a.substr(n + 1, F.length(x.a)).alias("a"), n.alias("n"))
    trimmed = once(F.struct(F.upper(ref).alias("r"), F.upper(alt).alias("a")), lambda x: once(common_prefix(F.reverse(x.r), F.reverse(x.a)), lambda end: once(cut(x.r, x.a, end), lambda y: once(common_prefix(y.r, y.a), lambda n: rest(y, n)))))
    rows = df.withColumns({"_ok": F.coalesce(plain, F.lit(False)), "_x": trimmed}).withColumns({"_r": F.col("_x.r"), "_a": F.col("_x.a"), "_p": F.col(pos).cast("long") + F.col("_x.n")})
    rows = settled(rows.drop("_x"), "alleles")
    indel = F.col("_ok") & ((F.length("_r") == 0) | (F.length("_a") == 0))
    still = rows.filter(~indel)
    done = still.select(*[F.col(c) for c in kept if c not in (pos, ref, alt)], F.when(F.col("_ok"), F.col("_p")).otherwise(F.col(pos)).alias(pos), F.when(F.col("_ok"), F.col("_r")).otherwise(F.col(ref)).alias(ref), F.when(F.col("_ok"), F.col("_a")).otherwise(F.col(alt)).alias(alt)).select(*kept)
    around = settled(with_neighbours(reference).select(F.col("chrom").alias("_c"), F.col("block").alias("_b"), F.concat("before", "bases", F.left("after", F.lit(1))).alias("_s"), F.length("before").alias("_skip")), "blocks")
    moving, reaches = rows.filter(indel), iter(REACH)
    while True:
        moved = settled(_moved(moving, around, chrom, width, next(reaches, 2 * width)), "indels")
        done = done.unionByName(_anchored(moved.filter("not _on"), kept, pos, ref, alt))
        moving = moved.filter("_on").select(*moving.columns)
        if not moving.limit(1).count():
            return done


def _moved(rows: DataFrame, around: DataFrame, chrom: str, width: int, reach: int) -> DataFrame:
    """One round: ``_p``, ``_r``, ``_a`` as far left as the window reaches, the base ``_anchor`` in front and ``_behind``, and ``_on``: whether more may follow."""
    block = F.floor((F.greatest(F.col("_p") - 2, F.lit(0))) / width)  # the base in front lies in this block
    joined = rows.join(around, (F.col(chrom) == F.col("_c")) & (block == F.col("_b")), "left")
    offset = F.col("_p") - 1 - (F.col("_b") * width - F.col("_skip"))  # bases of the window in front
    has = F.col("_s").isNotNull() & (offset >= 0) & (offset <= F.length("_s"))
    s = joined.withColumns({"_has": F.coalesce(has, F.lit(False)), "_left": F.when(has, F.substring("_s", (F.greatest(offset - reach, F.lit(0)) + 1).cast("int"), F.least(offset, F.lit(reach)).cast("int"))).otherwise(""), "_ins": F.concat("_r", "_a"), "_behind": F.when(has, F.substring("_s", (offset + 1 + F.length("_r")).cast("int"), F.lit(1))).otherwise("")})
    s = s.withColumn("_all", F.concat("_left", "_ins")).withColumn("_back", F.reverse("_all"))
    s = s.withColumn("_shift", _common(F.expr("substring(_back, length(_ins) + 1)"), F.col("_back"))).drop("_back")  # the text equals itself, moved by the insertion's length
    n, m, t = F.length("_all"), F.length("_ins"), F.col("_shift")
    s = s.withColumns({"_new": F.substring("_all", n - t - m + 1, m), "_p": F.col("_p") - t, "_anchor": F.when(t < F.length("_left"), F.substring("_all", n - t - m, F.lit(1))).otherwise("")})
    shifted = lambda c: F.when(F.length(c) > 0, F.col("_new")).otherwise("")
    s = s.withColumns({"_on": F.col("_has") & (F.col("_anchor") == "") & (F.col("_p") > 1), "_behind": F.when(t == 0, F.col("_behind")).otherwise(F.substring("_all", n - t + 1, F.lit(1)))})
    return s.withColumns({"_r": shifted("_r"), "_a": shifted("_a")}).drop("_c", "_b", "_s", "_skip", "_left", "_ins", "_all", "_shift", "_new")


def _anchored(rows: DataFrame, kept: Sequence[str], pos: str, ref: str, alt: str) -> DataFrame:
    """The alleles with the base in front, at a contig's start with the base behind, and unchanged where there is neither."""
    front, behind = F.col("_anchor") != "", (F.col("_p") == 1) & (F.col("_behind") != "")
    allele = lambda c, whole: F.when(front, F.concat("_anchor", c)).when(behind, F.concat(c, "_behind")).otherwise(F.col(whole))
    new = {pos: F.when(front, F.col("_p") - 1).when(behind, F.col("_p")).otherwise(F.col(pos)), ref: allele("_r", ref), alt: allele("_a", alt)}
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in kept])


def checked_reference(df: DataFrame, reference: DataFrame, chrom: str = "chrom", pos: str = "pos", ref: str = "ref", alt: str = "alt", width: int = WIDTH) -> DataFrame:
    """REF alleles that differ from the reference become its bases; the two alleles change places where ALT has them."""
    seen = with_bases(df, reference, "_seen", F.col(pos), F.length(ref), chrom, width)
    wrong = (F.length("_seen") == F.length(ref)) & F.col(ref).rlike("^[ACGTNacgtn]+$") & (F.upper(ref) != F.col("_seen"))
    swapped = wrong & (F.upper(alt) == F.col("_seen"))
    return seen.withColumns({ref: F.when(wrong, F.col("_seen")).otherwise(F.col(ref)), alt: F.when(swapped, F.col(ref)).otherwise(F.col(alt))}).drop("_seen").select(*df.columns)
