"""File formats as queries: a table is written in a format, read back by its reader, and summed up; plus lookups with their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..operators import joins as J
from ..operators import sets as T
from ..sources import documents as D
from ..sources import genomic as G
from ..sources.tables import scratch, settled, table
from . import cohort
from .carriers import query


def _lines(df: DataFrame, value) -> str:
    """A text file of one line for each row, in the shared folder."""
    path = scratch(df.sparkSession, "lines")
    df.select(value.alias("value")).write.text(path)
    return path


@query("""
WITH v AS (SELECT (l_linenumber + 19)::VARCHAR AS c, l_suppkey AS pos, CASE WHEN l_returnflag = 'A' THEN 'A' ELSE 'AC' END AS ref, CASE WHEN l_linestatus = 'O' THEN ['T'] ELSE ['T', 'G'] END AS alt, l_quantity AS qual,
  CASE WHEN l_returnflag = 'N' THEN [] WHEN l_tax > 0.04 THEN ['low_af', 'in_normal'] ELSE ['PASS'] END AS f, l_partkey AS dp, l_linestatus = 'F' AS db FROM lineitem)
SELECT c AS chrom, count(*) AS n, sum(pos)::BIGINT AS positions, round(sum(qual), 2) AS quality, count(*) FILTER (WHERE f = ['PASS']) AS passed, sum(len(f))::BIGINT AS names, sum(len(alt))::BIGINT AS alleles, sum(dp)::BIGINT AS depth,
       count(*) FILTER (WHERE db) AS flagged, count(*) FILTER (WHERE len(f) = 0) AS unnamed, any_value(k) AS n_keys FROM v JOIN (SELECT c AS kc, count(DISTINCT (pos, ref)) AS k FROM v GROUP BY 1) ON kc = c GROUP BY 1
""")
def variant_files(spark, sf):
    """Variants written as VCF and read back; the header stands first."""
    two = lambda c, a, b: F.when(c, F.array(*map(F.lit, a))).otherwise(F.array(*map(F.lit, b)))
    filters = F.when(F.col("l_returnflag") == "N", F.array().cast("array<string>")).otherwise(two(F.col("l_tax") > 0.04, ["low_af", "in_normal"], ["PASS"]))
    info = F.concat(F.lit("DP="), F.col("l_partkey").cast("string"), F.when(F.col("l_linestatus") == "F", ";DB").otherwise(""), F.lit(";DP=0"))
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_linenumber") + 19).cast("string").alias("chrom"), F.col("l_suppkey").alias("pos"), F.lit(".").alias("id"), F.when(F.col("l_returnflag") == "A", "A").otherwise("AC").alias("ref"),
        two(F.col("l_linestatus") == "O", ["T"], ["T", "G"]).alias("alt"), F.col("l_quantity").alias("qual"), filters.alias("filter"), info.alias("info_text"),
    )
    path = scratch(spark, "vcf")
    G.write_vcf(rows, ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"], path)
    read = G.vcf(spark, path)
    keys = G.variant_keys(read).groupBy(F.col("chrom").alias("_c")).agg(F.count("*").alias("n_keys"))
    count = lambda c, name: F.count_if(c).alias(name)
    told = read.groupBy("chrom").agg(
        F.count("*").alias("n"), F.sum("pos").alias("positions"), F.round(F.sum("qual"), 2).alias("quality"), count(P.is_pass(), "passed"), F.sum(F.size("filter")).alias("names"), F.sum(F.size("alt")).alias("alleles"),
        F.sum(F.col("info.DP").cast("long")).alias("depth"), count(F.map_contains_key("info", F.lit("DB")), "flagged"), count(F.size("filter") == 0, "unnamed"),
    )
    return told.join(keys, F.col("chrom") == F.col("_c")).drop("_c")


@query("""
WITH a AS (SELECT 'F' || p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN '1' ELSE 'A' END AS n, p_name AS d FROM part), b AS (SELECT 'F' || (p_partkey + 500) AS id, CASE WHEN p_size % 3 = 0 THEN '1' ELSE 'A' END AS n, p_name AS d FROM part)
SELECT 'INFO' AS category, id, CASE WHEN a.n <> b.n THEN '.' ELSE coalesce(a.n, b.n) END AS number, 'Float' AS type, CASE WHEN a.d <> b.d THEN 'one: ' || a.d || ' | two: ' || b.d ELSE coalesce(a.d, b.d) END AS description FROM a FULL JOIN b USING (id)
""")
def header_files(spark, sf):
    """Two headers written as text, read, and reconciled."""
    p = table(spark, sf, "part")
    line = lambda by, k: F.format_string('##INFO=<ID=F%d,Number=%s,Type=Float,Description="%s">', F.col("p_partkey") + by, F.when(F.col("p_size") % k == 0, "1").otherwise("A"), F.col("p_name"))
    one, two = (G.vcf_header(spark, _lines(p, line(by, k))) for by, k in ((0, 2), (500, 3)))
    return G.merged_headers(one, two, ("one", "two"))


@query("""
WITH g AS (SELECT p_partkey AS s, p_partkey + p_size AS e, p_retailprice / 1000 - 1 AS v, unnest(CASE WHEN p_size % 5 = 0 THEN ['backbone'] ELSE [p_brand, p_type] END) AS gene FROM part WHERE p_size % 7 <> 0)
SELECT gene, count(*) AS n, min(s)::BIGINT AS "start", max(e)::BIGINT AS "end", round(sum(v), 4) AS log2 FROM g GROUP BY 1
""")
def bin_files(spark, sf):
    """Copy-ratio bins written with a header and read back, a row for each gene, without antitargets."""
    gene = F.when(F.col("p_size") % 7 == 0, "Antitarget").when(F.col("p_size") % 5 == 0, " - ").otherwise(F.concat_ws(" , ", "p_brand", "p_type"))
    rows = table(spark, sf, "part").select(F.lit("1").alias("chromosome"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + F.col("p_size")).alias("end"), gene.alias("gene"), (F.col("p_retailprice") / 1000 - 1).alias("log2"))
    path = scratch(spark, "bins")
    D.write_tsv(rows, path)
    return G.bins(G.tsv(spark, path)).groupBy("gene").agg(F.count("*").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"), F.round(F.sum("log2"), 4).alias("log2"))


@query("""
SELECT n_name AS chrom, count(*) AS n, sum(c_custkey)::BIGINT AS starts, sum(c_custkey + 7)::BIGINT AS ends FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1
""")
def interval_files(spark, sf):
    """Intervals written as BED and read back, by chromosome."""
    rows = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("n_nationkey") == F.col("c_nationkey")).select("n_name", "c_custkey", (F.col("c_custkey") + 7).alias("end"))
    path = scratch(spark, "bed")
    G.write_bed(rows, path, ["n_name", "c_custkey", "end"])
    return G.bed(spark, path).groupBy("chrom").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"))


@query("""
SELECT s_nationkey::VARCHAR AS chrom, count(*) AS n, round(sum(s_acctbal), 2) AS total, (SELECT round(sum(s_acctbal), 2) FROM supplier) AS whole, (SELECT count(*) FROM supplier WHERE s_acctbal IS NOT NULL) AS numbers FROM supplier GROUP BY 1
""")
def coverage_files(spark, sf):
    """Coverage lines behind header lines, and a list of numbers."""
    s = table(spark, sf, "supplier")
    row = F.concat_ws("\t", F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string"), (F.col("s_suppkey") + 1).cast("string"), F.col("s_acctbal").cast("string"))
    heads = F.array(F.concat(F.lit("@SQ\tSN:"), F.col("s_name")), F.lit("CONTIG\tSTART\tEND\tLOG2_COPY_RATIO"), row)
    cover = G.denoised_coverage(spark, _lines(s.select(F.explode(heads).alias("x")), F.col("x")))
    plain = G.numbers(spark, _lines(s, F.concat(F.lit(" "), F.col("s_acctbal").cast("string")))).agg(F.round(F.sum("value"), 2).alias("whole"), F.count("value").alias("numbers"))
    return cover.groupBy("chrom").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).join(F.broadcast(plain))


@query("SELECT upper(replace(o_orderpriority, ' ', '_')) AS key, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def key_value_files(spark, sf):
    """Key and value of text lines."""
    o = table(spark, sf, "orders")
    read = G.key_values(spark, _lines(o, F.concat(F.col("o_orderpriority"), F.lit(" :  "), F.col("o_totalprice").cast("string"))))
    return read.groupBy("key").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("double")), 2).alias("total"))


@query("""
SELECT l_returnflag AS chr, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'LOH' || CASE WHEN l_linestatus = 'F' THEN ' (unreliable)' ELSE '' END END AS purecn_type, count(*) AS n, sum(l_linenumber)::BIGINT AS copies FROM lineitem GROUP BY 1, 2
""")
def segment_files(spark, sf):
    """Segments written as CSV, read as text, typed, and flagged kinds told."""
    kind = F.when(F.col("l_linenumber") % 3 != 0, "LOH")
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("chr"), F.col("l_linenumber").cast("double").cast("string").alias("C"), kind.alias("type"), F.when(F.col("l_linestatus") == "F", "TRUE").otherwise("FALSE").alias("flagged"))
    path = scratch(spark, "segments")
    rows.write.option("header", True).csv(path)
    typed = G.coerced(G.tsv(spark, path, sep=","), ints=["C"], booleans=["flagged"], required=["chr", "C"])
    return G.purity_segments(typed).groupBy("chr", "purecn_type").agg(F.count("*").alias("n"), F.sum("purecn_C").alias("copies"))


@query("""
WITH f AS (SELECT o_custkey, o_orderpriority AS p, o_orderkey AS k FROM orders), g AS (SELECT 'c' || o_custkey || '_' || p AS prefix, min('d/c' || o_custkey || '_' || p || '_R1_001.fastq.gz') FILTER (WHERE k % 2 = 0) AS forward,
       min('d/c' || o_custkey || '_' || p || '_R2_001.fastq.gz') FILTER (WHERE k % 3 = 0) AS reverse FROM f GROUP BY 1)
SELECT * FROM g WHERE forward IS NOT NULL OR reverse IS NOT NULL
""")
def paired_files(spark, sf):
    """Forward and reverse files by prefix; other names are left out."""
    k, base = F.col("o_orderkey"), F.concat(F.lit("d/c"), F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderpriority"))
    ends = F.array(F.when(k % 2 == 0, "_R1_001.fastq.gz"), F.when(k % 3 == 0, "_R2_001.fastq.gz"), F.lit(".bam"))
    names = table(spark, sf, "orders").select(base.alias("base"), F.explode(F.array_compact(ends)).alias("end"))
    return G.fastq_pairs(names.select(F.concat("base", "end").alias("path")))


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT c_custkey, r_name, (SELECT count(*) FROM d) AS n_duplicates, (SELECT sum(n)::BIGINT FROM d) AS n_rows, round(s, 2) AS spent FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS s FROM orders GROUP BY 1) ON o_custkey = c_custkey
""")
def checked_lookups(spark, sf):
    """Lookups whose keys are checked, one of them on both sides, and the keys that a check would refuse."""
    t = lambda name: table(spark, sf, name)
    nations = J.left_unique(t("nation").withColumnRenamed("n_regionkey", "r_regionkey"), t("region"), ["r_regionkey"]).withColumnRenamed("n_nationkey", "c_nationkey")
    spent = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("s"))
    rows = J.left_unique(J.left_unique(t("customer"), nations, ["c_nationkey"]), spent, ["c_custkey"], one_to_one=True)
    twice = J.duplicate_keys(t("lineitem"), ["l_orderkey", "l_linenumber"]).agg(F.count("*").alias("n_duplicates"), F.sum("count").alias("n_rows"))
    return rows.join(F.broadcast(twice)).select("c_custkey", "r_name", "n_duplicates", "n_rows", F.round("s", 2).alias("spent"))


@query("""
WITH m AS (SELECT 'NUMBER_OF_SITES' AS name, c_mktsegment AS sample, count(*)::DOUBLE AS value, 'lt' AS norm, 310.0 AS t FROM customer GROUP BY 2 UNION ALL SELECT 'RELATEDNESS', c_mktsegment, round(avg(c_acctbal) / 6000, 4), 'gt', 0.8 FROM customer GROUP BY 2)
SELECT name, sample, value, CASE WHEN (norm = 'lt' AND value < t) OR (norm = 'gt' AND value > t) THEN 'pass' ELSE 'fail' END AS status FROM m
""")
def metric_sources(spark, sf):
    """Metric rows of several sources under one schema, each with its own condition."""
    c = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("sample"))
    row = lambda name, df, norm, threshold: df.select(F.lit(name).alias("name"), "sample", "value", F.lit(norm).alias("norm"), F.lit(threshold).alias("threshold"))
    sites = row("NUMBER_OF_SITES", c.agg(F.count("*").cast("double").alias("value")), "lt", 310.0)
    related = row("RELATEDNESS", c.agg(F.round(F.avg("c_acctbal") / 6000, 4).alias("value")), "gt", 0.8)
    return cohort.validated(T.union_all([sites, related], ["counts", "pairs"], "source")).select("name", "sample", "value", "status")
