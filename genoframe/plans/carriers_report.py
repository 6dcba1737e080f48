"""INFO edits and what reports show, applied to the general tables over whole tables, with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import info as N
from ..sources.tables import table
from . import report
from .carriers import query


@query("""
WITH e AS (SELECT p_partkey, p_brand AS id, CASE WHEN p_size % 3 = 0 THEN '.' WHEN p_size % 3 = 1 THEN 'DP=3;SVTYPE=BND;X' ELSE 'CLNVID=7' END AS info, p_size, p_type FROM part)
SELECT p_partkey,
  CASE p_size % 3 WHEN 0 THEN 'DP=' || p_size WHEN 1 THEN 'DP=' || p_size || ';SVTYPE=BND;X' ELSE 'CLNVID=7;DP=' || p_size END AS with_dp,
  CASE WHEN p_size % 2 = 0 THEN info WHEN info = '.' THEN 'CLNVID=' || id WHEN p_size % 3 = 2 THEN info ELSE info || ';CLNVID=' || id END AS with_id,
  CASE p_size % 3 WHEN 0 THEN '.' WHEN 1 THEN 'DP=3;SVTYPE=DUP;X' ELSE 'CLNVID=7' END AS with_type,
  CASE p_size % 3 WHEN 0 THEN 'DP=' || (p_size + 1) || ';AF=0.0' WHEN 1 THEN 'DP=' || (p_size + 1) || ';SVTYPE=BND;X;AF=0.0' ELSE 'CLNVID=7;DP=' || (p_size + 1) || ';AF=0.0' END AS with_sample
FROM e
""")
def info_edits(spark, sf):
    """B16, B33, D18."""
    third = F.col("p_size") % 3
    info = F.when(third == 0, ".").when(third == 1, "DP=3;SVTYPE=BND;X").otherwise("CLNVID=7")
    rows = table(spark, sf, "part").select("p_partkey", "p_size", info.alias("info"), F.when(F.col("p_size") % 2 == 0, ".").otherwise(F.col("p_brand")).alias("id"))
    i = F.col("info")
    return rows.select(
        "p_partkey", N.with_info(i, "DP", F.col("p_size")).alias("with_dp"), N.with_id_info(i, F.col("id"), "CLNVID").alias("with_id"), N.with_svtype(i, F.lit("<DUP>")).alias("with_type"),
        N.with_sample_info(i, F.array(F.lit(1), F.col("p_size")), F.lit(None).cast("double")).alias("with_sample"),
    )


@query("""
WITH k AS (SELECT l_suppkey::VARCHAR AS chr, l_partkey AS gene, sum(l_linenumber) AS total_targets, bool_or(l_quantity > 49) AS is_cancer_gene, bool_or(l_returnflag = 'A') AS has_cnv, bool_or(l_linestatus = 'F') AS has_loh
  FROM lineitem WHERE l_suppkey <> 1 GROUP BY 1, 2)
SELECT chr, gene, total_targets::BIGINT AS total_targets, is_cancer_gene, has_cnv, has_loh, (is_cancer_gene AND total_targets >= 4) OR (NOT is_cancer_gene AND (has_cnv OR has_loh) AND total_targets >= 7) AS highlight FROM k
""")
def gene_highlights(spark, sf):
    """B27."""
    gene = F.when(F.col("l_suppkey") == 1, "backbone").otherwise(F.col("l_partkey").cast("string"))
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("chr"), gene.alias("gene"), F.col("l_linenumber").cast("long").alias("n_targets"), (F.col("l_quantity") > 49).alias("is_cancer_gene"),
        F.when(F.col("l_returnflag") == "A", "Deletion ").otherwise("NEUTRAL").alias("a"), F.lit(None).cast("string").alias("b"), F.when(F.col("l_linestatus") == "F", "copy-neutral loh").alias("loh"),
    )
    return report.gene_highlights(rows, ["a", "b"], "loh", 7, 4).withColumn("gene", F.col("gene").cast("long"))


@query("""
SELECT l_suppkey::VARCHAR AS chr, l_orderkey::BIGINT AS start, l_linenumber::BIGINT AS "end" FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_discount <= 0.05
""")
def loh_segments(spark, sf):
    """B28."""
    kind = F.when(F.col("l_linestatus") == "F", F.when(F.col("l_discount") > 0.05, "LOH (unreliable)").otherwise("LOH"))
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("chr"), F.col("l_orderkey").cast("long").alias("start"), F.col("l_linenumber").cast("long").alias("end"), F.when(F.col("l_returnflag") == "A", "PureCN").otherwise("other").alias("caller"), kind.alias("purecn_type"))
    return report.loh_segments(rows)


@query("SELECT DISTINCT l_suppkey::VARCHAR AS chr FROM lineitem WHERE l_quantity = 50 AND (l_discount > 0.08 OR l_tax > 0.07)")
def chromosomes_with_calls(spark, sf):
    """G21."""
    full = F.col("l_quantity") == 50
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("chr"), F.when(full & (F.col("l_discount") > 0.08), "deletion").alias("cnv_call"), F.when(full & (F.col("l_tax") > 0.07), "any").alias("purecn_type"))
    return report.chromosomes_with_calls(rows)


@query("""
SELECT CASE WHEN value IS NULL OR value <= 20 THEN 'invalid' ELSE 'illegal' END AS reason, CASE WHEN value > 20 THEN event_type END AS chrom, count(*) AS n
FROM events WHERE value IS NULL OR value <= 20 OR event_type NOT IN ('click', 'view') GROUP BY 1, 2
""")
def skipped_variants(spark, sf):
    """B26, G18."""
    return report.skipped_variants(table(spark, sf, "events"), F.col("value") > 20, ["click", "view"], "event_type")


@query("""
SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY list_transform(regexp_extract_all(v, '([0-9]+|[^0-9]+)'), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(x, 20, '0') ELSE x END), v) AS place,
  CASE WHEN p_size > 25 THEN p_size || ' (default fallback 2 ploidy)' ELSE p_size::VARCHAR END AS ploidy
FROM (SELECT *, 'chr' || p_partkey || 'b' || p_size AS v FROM part)
""")
def version_order(spark, sf):
    """S3, C36."""
    name = F.concat(F.lit("chr"), "p_partkey", F.lit("b"), "p_size")
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy(N.version_key(name)))
    note = F.when(F.col("p_size") > 25, "x; failed purity estimation")
    return table(spark, sf, "part").select("p_partkey", "p_name", place.alias("place"), N.fallback_note(F.col("p_size"), note, report.PURITY_NOTES["Ploidy"]).alias("ploidy"))


@query("""
SELECT s_suppkey, CASE s_nationkey WHEN 1 THEN 'a' WHEN 2 THEN 'b' END AS argument, CASE s_nationkey WHEN 1 THEN 'one' END AS category,
  CASE WHEN s_name LIKE '%5' THEN 'T,' || s_nationkey ELSE s_name || ',' || s_nationkey END AS names
FROM supplier
""")
def static_metadata(spark, sf):
    """B34, D20."""
    s = table(spark, sf, "supplier")
    known = report.with_metadata(s.withColumn("key", F.col("s_nationkey").cast("string")), "key", {"1": {"argument": "a", "category": "one"}, "2": {"argument": "b"}})
    names = N.renamed(F.array(F.when(F.col("s_name").endswith("5"), "TUMOR").otherwise(F.col("s_name")), F.col("key")), {"TUMOR": "T"})
    return known.select("s_suppkey", "argument", "category", F.array_join(names, ",").alias("names"))


@query("""
SELECT l_orderkey, l_linenumber::VARCHAR AS l_linenumber, coalesce(CASE WHEN l_discount > 0 THEN l_returnflag END, '') AS flag FROM lineitem WHERE l_quantity > 10
""")
def visible_view(spark, sf):
    """J10."""
    rows = table(spark, sf, "lineitem").withColumn("flag", F.when(F.col("l_discount") > 0, F.col("l_returnflag")))
    out = report.visible_view(rows, F.col("l_quantity") > 10, ["l_orderkey", "l_linenumber", "flag"])
    return out.withColumn("l_orderkey", F.col("l_orderkey").cast("long"))


@query("""
SELECT p || '/' || s || '.' || e AS path, p, s, e FROM (SELECT unnest(['a', 'b']) AS p), (SELECT unnest(['x', 'y', 'z']) AS s), (SELECT unnest(['vcf', 'bed']) AS e)
""")
def expanded_paths(spark, sf):
    """S20."""
    return report.expanded(spark, "{p}/{s}.{e}", p=["a", "b"], s=["x", "y", "z"], e=["vcf", "bed"])
