"""Readers of variant, bin, segment, interval and metric files, and writers of their text forms.

Readers take anything ``spark.read`` takes and never infer a schema; values that don't
parse become null.  Parquet partitioned by chromosome is the form to keep tables in;
the text forms are for exchange.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import vcf_order
from .typed import wider_type


class MissingColumns(ValueError):
    """A table lacks columns that it must have."""


def lines(spark: SparkSession, path: str) -> DataFrame:
    """A1: text lines with the file they come from."""
    return spark.read.text(path).withColumn("file", F.col("_metadata.file_name"))


def parse_vcf(rows: DataFrame) -> DataFrame:
    """A2-A4: records of VCF lines (column ``value``), with FILTER and ALT as arrays and INFO as ordered pairs and as a map.

    Of repeated INFO keys the map has the first.
    """
    p = F.split("value", "\t")
    at = lambda i: F.get(p, F.lit(i))
    items = F.filter(F.split(at(7), ";"), lambda x: (x != "") & (x != "."))
    pairs = F.transform(items, lambda x: F.struct(F.substring_index(x, "=", 1).alias("key"), F.when(x.contains("="), x.substr(F.instr(x, "=") + 1, F.length(x))).alias("value")))
    first = F.aggregate("pairs", F.array().cast("array<struct<key:string,value:string>>"), lambda acc, x: F.when(F.exists(acc, lambda y: y["key"] == x["key"]), acc).otherwise(F.concat(acc, F.array(x))))
    names = lambda i, mark: F.when(at(i) == mark, F.array().cast("array<string>")).otherwise(F.split(at(i), "[;,]"))
    keys = F.split(at(8), ":")
    samples = F.when(F.size(p) > 9, F.transform(F.slice(p, 10, F.greatest(F.size(p) - 9, F.lit(0))), lambda s: F.map_from_arrays(keys, F.transform(F.sequence(F.lit(0), F.size(keys) - 1), lambda i: F.get(F.split(s, ":"), i)))))
    return (
        rows.filter(~F.col("value").startswith("#") & (F.col("value") != ""))
        .select(
            at(0).alias("chrom"), at(1).try_cast("long").alias("pos"), at(2).alias("id"), at(3).alias("ref"), F.split(at(4), ",").alias("alt"), at(5).try_cast("double").alias("qual"),
            names(6, ".").alias("filter"), at(7).alias("info_text"), pairs.alias("pairs"), at(8).alias("format"), samples.alias("samples"),
        )
        .withColumn("info", F.map_from_entries(first))
    )


def vcf(spark: SparkSession, path: str) -> DataFrame:
    return parse_vcf(lines(spark, path))


def vcf_header(spark: SparkSession, path: str) -> DataFrame:
    return parse_header(lines(spark, path))


def parse_header(text: DataFrame) -> DataFrame:
    """Header lines (of the column ``value``) with category, id, number, type and description; ``#CHROM`` is a category of its own."""
    of = lambda k: F.regexp_extract("value", rf'[<,]{k}=("[^"]*"|[^,>]*)', 1)
    rows = text.filter(F.col("value").startswith("#"))
    return rows.select(
        F.when(F.col("value").startswith("##"), F.regexp_extract("value", "^##([^=]+)=", 1)).otherwise("#CHROM").alias("category"), of("ID").alias("id"), of("Number").alias("number"),
        of("Type").alias("type"), F.trim(F.translate(of("Description"), '"', "")).alias("description"), F.col("value").alias("line"),
    )


def merged_headers(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("vcf1", "vcf2")) -> DataFrame:
    """One line for each category and id; differing descriptions are both told, differing numbers become a dot, differing types the wider one."""
    both = a.withColumn("_s", F.lit(0)).unionByName(b.withColumn("_s", F.lit(1)))
    one = lambda c, s: F.min(F.when(F.col("_s") == s, F.col(c)))
    g = both.groupBy("category", F.when(F.col("id") == "", F.col("line")).otherwise(F.col("id")).alias("id")).agg(
        one("number", 0).alias("n0"), one("number", 1).alias("n1"), one("description", 0).alias("d0"), one("description", 1).alias("d1"), wider_type(one("type", 0), one("type", 1)).alias("type")
    )
    differ = lambda x, y: F.col(x).isNotNull() & F.col(y).isNotNull() & (F.col(x) != F.col(y))
    text = F.concat(F.lit(f"{names[0]}: "), "d0", F.lit(f" | {names[1]}: "), "d1")
    return g.select("category", "id", F.when(differ("n0", "n1"), ".").otherwise(F.coalesce("n0", "n1")).alias("number"), "type", F.when(differ("d0", "d1"), text).otherwise(F.coalesce("d0", "d1")).alias("description"))


def variant_keys(variants: DataFrame) -> DataFrame:
    """A5: distinct keys with the first alternate allele."""
    return variants.select("chrom", "pos", "ref", F.get("alt", F.lit(0)).alias("alt")).distinct()


def tsv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True, sep: str = "\t") -> DataFrame:
    """Delimited text; without a schema every column is text."""
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)


def coerced(df: DataFrame, ints: Sequence[str] = (), floats: Sequence[str] = (), strings: Sequence[str] = (), booleans: Sequence[str] = (), words: Mapping[str, bool | None] | None = None, required: Sequence[str] = ()) -> DataFrame:
    """Columns cast where they exist; what doesn't parse, NaN and words outside the map are null."""
    if lacking := [c for c in required if c not in df.columns]:
        raise MissingColumns(f"no column named {', '.join(lacking)}")
    words = {"TRUE": True, "FALSE": False, "NA": None} if words is None else words
    out: dict[str, Column] = {}
    for c in df.columns:
        text = F.trim(F.col(c).cast("string"))
        if c in ints:
            out[c] = text.try_cast("double").try_cast("long")
        elif c in floats:
            n = text.try_cast("double")
            out[c] = F.when(~F.isnan(n), n)
        elif c in booleans:
            out[c] = F.coalesce(*[F.when(text == w, F.lit(v).cast("boolean")) for w, v in words.items()])
        elif c in strings:
            out[c] = F.col(c).cast("string")
    return df.withColumns(out) if out else df


def bins(df: DataFrame, chrom: str = "chromosome", gene: str = "gene") -> DataFrame:
    """Copy-ratio bins, one row for each gene of a bin; antitargets go, ``-`` is the backbone."""
    named = F.when(F.trim(gene) == "-", "backbone").otherwise(F.col(gene))
    rows = df.filter(F.col(gene).isNull() | (F.col(gene) != "Antitarget")).withColumn("gene.symbol", F.explode(F.split(named, r"\s*,\s*")))
    typed = coerced(rows, ints=("start", "end"), floats=("log2", "depth", "weight", "gc", "spread"), required=(chrom, "start", "end", gene))
    return typed.drop(gene).withColumnsRenamed({chrom: "chr", "gene.symbol": "gene"})


def purity_segments(df: DataFrame, prefix: str = "purecn_") -> DataFrame:
    """Segments with copies and LOH type; flagged types say so."""
    flagged = F.col("flagged") & F.col("type").isNotNull()
    out = df.withColumn("type", F.when(flagged, F.concat("type", F.lit(" (unreliable)"))).otherwise(F.col("type"))).drop("flagged")
    return out.withColumnsRenamed({c: f"{prefix}{c}" for c in out.columns if c not in ("chr", "start", "end")})


def bed(spark: SparkSession, path: str) -> DataFrame:
    """Intervals."""
    p = F.split("value", "\t")
    rows = lines(spark, path).filter(~F.col("value").rlike("^(#|track|browser|\\s*$)"))
    return rows.select(F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(1)).try_cast("long").alias("start"), F.get(p, F.lit(2)).try_cast("long").alias("end"))


def cytobands(spark: SparkSession, path: str) -> DataFrame:
    """A10."""
    return tsv(spark, path, "chrom string, band_start long, band_end long, band string, stain string", header=False).withColumn("chrom", F.regexp_replace("chrom", "^chr", ""))


def denoised_coverage(spark: SparkSession, path: str) -> DataFrame:
    """Coverage lines behind their header."""
    p = F.split("value", "\t")
    rows = lines(spark, path).filter(~F.col("value").rlike("^(@|CONTIG)"))
    return rows.select(F.get(p, F.lit(0)).alias("chrom"), F.get(p, F.lit(1)).try_cast("long").alias("start"), F.get(p, F.lit(2)).try_cast("long").alias("end"), F.get(p, F.lit(3)).try_cast("double").alias("value"))


def numbers(spark: SparkSession, path: str) -> DataFrame:
    """One number a line."""
    return lines(spark, path).select(F.trim("value").try_cast("double").alias("value"))


def key_values(spark: SparkSession, path: str) -> DataFrame:
    """``Key: value`` lines, keys in upper case with underscores."""
    p = F.split("value", ":")
    rows = lines(spark, path).filter(F.size(p) > 1)
    return rows.select("file", F.upper(F.replace(F.trim(F.get(p, F.lit(0))), F.lit(" "), F.lit("_"))).alias("key"), F.trim(F.get(p, F.lit(1))).alias("value"))


def job_logs(spark: SparkSession, root: str) -> DataFrame:
    """Log files with a numeric name, below a folder: job id and the rule's relative folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.log").load(root).select("path")
    stem = F.regexp_extract("path", r"([^/]+)\.log$", 1)
    folder = F.regexp_extract("path", re.escape(root.removeprefix("file:").rstrip("/")) + r"/(.+)/[^/]+$", 1)
    return files.select("path", stem.alias("job_id"), F.when(folder != "", folder).otherwise(F.regexp_extract("path", "^(.*)/[^/]+$", 1)).alias("rule")).filter(stem.rlike(r"^\d+$"))


def sample_of_file(path: Column) -> Column:
    """Sample and kind of a coverage file, by its name."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.struct(F.get(F.split(name, r"\."), F.lit(0)).alias("sample"), F.when(name.contains("antitarget"), "antitarget").otherwise("target").alias("kind"))


def fastq_pairs(names: DataFrame, path: str = "path", forward: str = r"^(.*?)(_R?1(?:_001)?)\.fastq\.gz$", reverse: str = r"^(.*?)(_R?2(?:_001)?)\.fastq\.gz$") -> DataFrame:
    """Forward and reverse files by their common prefix: ``prefix``, ``forward``, ``reverse`` (null if it lacks)."""
    name = F.element_at(F.split(path, "/"), -1)
    fwd, rev = F.regexp_extract(name, forward, 1), F.regexp_extract(name, reverse, 1)
    rows = names.select(F.col(path), F.when(fwd != "", fwd).otherwise(rev).alias("prefix"), (fwd != "").alias("is_forward")).filter("prefix <> ''")
    return rows.groupBy("prefix").agg(F.min(F.when(F.col("is_forward"), F.col(path))).alias("forward"), F.min(F.when(~F.col("is_forward"), F.col(path))).alias("reverse"))


def baseline_samples(names: DataFrame, path: str = "path") -> DataFrame:
    """Distinct samples, the fourth token from the end of a file name."""
    return names.select(F.try_element_at(F.split(path, "_"), F.lit(-4)).alias("sample")).filter("sample is not null").distinct()


def sql_columns(text: str) -> list[str]:
    """Column names of a CREATE TABLE statement, keys left out."""
    body = re.search(r"CREATE TABLE[^(]*\((.*)\)\s*ENGINE", text, re.S | re.I)
    rows = (r.strip() for r in (body[1].splitlines() if body else ()))
    return [r.split()[0].strip("`,") for r in rows if r and "KEY" not in r]


# ---------------------------------------------------------------- writers


def vcf_lines(variants: DataFrame) -> DataFrame:
    """K1: records as lines, in one column with what they are to be sorted by."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    joined = lambda c, s: F.when(F.size(c) > 0, F.array_join(c, s)).otherwise(".")
    return variants.select("chrom", "pos", F.concat_ws("\t", "chrom", F.col("pos").cast("string"), text("id"), "ref", joined("alt", ","), text("qual"), joined("filter", ";"), text("info_text")).alias("value"))


def write_vcf(variants: DataFrame, header: Sequence[str], path: str) -> None:
    """K1/K2: a folder of text parts in genomic order, the header as the first lines of the first part."""
    spark = variants.sparkSession
    rows = vcf_lines(variants).select(F.lit(1).alias("g"), vcf_order(F.col("chrom")).alias("o"), "pos", "value")
    top = spark.createDataFrame([(0, i, x) for i, x in enumerate(header)], "g int, pos long, value string")
    first = top.select("g", F.struct(F.lit(0).alias("n"), F.lit("").alias("name")).alias("o"), "pos", "value")
    first.unionByName(rows).orderBy("g", "o", "pos", "value").select("value").write.text(path)


def write_bed(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """K3."""
    df.select(*columns).write.option("sep", "\t").option("header", False).csv(path)


def query_lines(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as tab-separated text."""
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in columns]).alias("value"))
