"""Column functions and analyses applied to the general tables, over whole tables, with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import intervals as I
from ..operators import joins as J
from ..operators import sets as T
from ..operators import windows as W
from ..sources.tables import table
from . import catalogs, cnv, cohort, snv, sv
from .carriers import query


# ---------------------------------------------------------------- filters


@query("""
SELECT o_orderkey, o_orderstatus IN ('F', 'P') OR o_orderpriority LIKE '%PASS%' AS mentions, CASE WHEN o_orderpriority LIKE '1%' THEN 'late' ELSE '' END AS left_over,
       o_totalprice > 150000 AS in_first
FROM orders
""")
def filter_edits(spark, sf):
    """B6-B8."""
    o = table(spark, sf, "orders")
    names = F.array_compact(F.array(F.when(F.col("o_orderstatus") == "F", "done"), F.when(F.col("o_orderpriority").startswith("1"), "late"), F.lit("done")))
    rows = P.without_filter(o.withColumn("filter", names), "done").withColumn("value", F.concat(F.when(F.col("o_orderstatus").isin("F", "P"), "#").otherwise(""), "o_orderpriority"))
    rows = rows.select("o_orderkey", P.mentions_pass("value").alias("mentions"), F.array_join("filter", ";").alias("left_over"), "o_totalprice")
    first, second = P.split_by(rows, F.col("o_totalprice") > 150_000)
    return first.withColumn("in_first", F.lit(True)).unionByName(second.withColumn("in_first", F.lit(False))).drop("o_totalprice")


@query("""
WITH e AS (SELECT l_orderkey, l_linenumber, l_discount * 5 AS t, l_tax * 5 AS n, l_returnflag = 'A' AS ct, l_linestatus = 'F' AS cn FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN t = 0 AND NOT ct THEN 'normal_variant' ELSE array_to_string(list_filter([
  CASE WHEN CASE WHEN t = 0 THEN 0 ELSE n / t END > 0.25 THEN 'high_normal_af_fraction' END, CASE WHEN n > 0.25 THEN 'high_normal_af' END,
  CASE WHEN cn AND n = 0 AND t <= 0.25 THEN 'in_normal' END], lambda x: x IS NOT NULL), ';') END AS names FROM e
""")
def tumor_normal_filters(spark, sf):
    """B13."""
    names = P.tumor_normal_evidence(F.col("l_discount") * 5, F.col("l_tax") * 5, F.col("l_returnflag") == "A", F.col("l_linestatus") == "F")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(names, ";").alias("names"))


@query("""
WITH e AS (SELECT *, l_partkey % 5 AS a, l_suppkey % 4 AS b, l_linenumber % 3 AS c, l_orderkey % 3 AS d FROM lineitem)
SELECT CASE WHEN a > b OR c > d THEN 'DUP' WHEN a < b OR c < d THEN 'DEL' ELSE 'CNV' END AS two, CASE WHEN a > 2 THEN 'DUP' WHEN a < 2 THEN 'DEL' ELSE '' END AS one,
       CASE WHEN a > b THEN 'DUP' WHEN a < b THEN 'DEL' ELSE '' END AS pair, count(*) AS n FROM e GROUP BY ALL
""")
def copy_calls(spark, sf):
    """B14, B15."""
    rows = table(spark, sf, "lineitem").select((F.col("l_partkey") % 5).alias("tcn_t"), (F.col("l_suppkey") % 4).alias("tcn_n"), (F.col("l_linenumber") % 3).alias("mcn_t"), (F.col("l_orderkey") % 3).alias("mcn_n"))
    called = sv.copy_calls(rows)
    return called.groupBy(F.col("svtype").alias("two"), P.copy_call_depth(F.col("tcn_t")).alias("one"), P.copy_call_depth(F.col("tcn_t"), F.col("tcn_n")).alias("pair")).agg(F.count("*").alias("n"))


@query("""
WITH b AS (SELECT p_brand, avg(p_retailprice) AS base, stddev_samp(p_retailprice) AS spread FROM part GROUP BY 1),
d AS (SELECT p_partkey, (p_retailprice - base) / base AS delta, abs(p_retailprice - base) / spread * 3 AS z FROM part JOIN b USING (p_brand)),
s AS (SELECT *, CASE WHEN delta > 0 THEN 'gain' WHEN delta < 0 THEN 'loss' ELSE '' END AS direction, CASE WHEN z IS NULL THEN '' WHEN z < 2 THEN 'noise' WHEN z < 5 THEN 'borderline' ELSE 'strong' END AS signal FROM d)
SELECT p_partkey, direction, signal, CASE WHEN signal <> 'strong' THEN '' WHEN delta > 0.07 THEN 'GAIN' WHEN delta < -0.07 THEN 'LOSS' ELSE 'NEUTRAL' END AS call FROM s
""")
def baseline_calls(spark, sf):
    """B19, C18, D3 with its check of keys."""
    p = table(spark, sf, "part")
    base = p.groupBy("p_brand").agg(F.avg("p_retailprice").alias("base"), F.stddev_samp("p_retailprice").alias("spread"))
    delta = (F.col("p_retailprice") - F.col("base")) / F.col("base")
    rows = J.left_unique(p, base, ["p_brand"]).withColumns({"delta": delta, "z": F.abs(S.bin_z(F.col("p_retailprice"), F.col("base"), F.col("spread"))) * 3})
    signal = P.baseline_signal(F.col("z"))
    return rows.select("p_partkey", P.baseline_direction(F.col("delta")).alias("direction"), signal.alias("signal"), P.baseline_call(F.col("delta"), signal).alias("call"))


@query("""
WITH r AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_acctbal / 9000 ELSE 0.000001 END AS x FROM customer)
SELECT c_custkey, CASE WHEN x > 0.2 THEN 'male' WHEN x <= 0.15 THEN 'female' ELSE 'unknown' END AS sex,
       CASE WHEN x >= 0.9 THEN 'high' WHEN x >= 0.7 THEN 'medium' WHEN x > 0.2 THEN 'low' WHEN x > 0.15 THEN 'low' WHEN x >= 0.05 THEN 'medium' WHEN x >= 0.00001 THEN 'high' ELSE 'low' END AS confidence,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'male' WHEN x > 0.2 THEN 'male' WHEN x <= 0.15 THEN 'female' WHEN c_mktsegment = 'MACHINERY' THEN 'male' ELSE 'female' END AS resolved FROM r
""")
def sex_by_ratio(spark, sf):
    """B20, B35."""
    x = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 9000).otherwise(0.000001)
    told = P.sex_by_ratio(x)
    given, tumor = F.when(F.col("c_mktsegment") == "BUILDING", "male").otherwise("unknown"), F.when(F.col("c_mktsegment") == "MACHINERY", "male")
    return table(spark, sf, "customer").select("c_custkey", told["sex"].alias("sex"), told["confidence"].alias("confidence"), P.resolved_sex(given, told["sex"], tumor).alias("resolved"))


@query("""
WITH t AS (SELECT *, l_partkey % 4 AS a, l_suppkey % 3 AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, l_returnflag <> 'R' AND a + b >= 3 AND least(a, b) >= 1 AND greatest(a, b) >= 1 AS duplex,
       (l_partkey & 1024) = 0 AND l_returnflag = 'N' AND l_suppkey BETWEEN 10 AND 60 AND ((l_linestatus = 'O' AND l_quantity BETWEEN 5 AND 20) OR l_linenumber = 2) AS supports
FROM t
""")
def read_support(spark, sf):
    """B23, B24, G15."""
    a, b = F.col("l_partkey") % 4, F.col("l_suppkey") % 3
    tag = F.when(F.col("l_returnflag") != "R", F.concat(F.lit("XZ:Z:"), a, F.lit(","), b))
    tags = F.when(F.col("l_linenumber") == 2, "SA:Z:O,17;").otherwise("NM:i:0")
    supports = P.supporting_read(F.col("l_partkey"), F.col("l_returnflag"), F.col("l_suppkey"), F.col("l_linestatus"), F.col("l_quantity"), tags, ("N", 10, 60), ("O", 5, 20))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", P.duplex_support(tag).alias("duplex"), supports.alias("supports"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_quantity END + l_linenumber < 4 THEN 'low_pr_sr_count' ELSE '' END AS names FROM lineitem")
def paired_read_filter(spark, sf):
    """B25."""
    rows = table(spark, sf, "lineitem").withColumns({"pr_alt": F.when(F.col("l_returnflag") != "A", F.col("l_quantity")), "sr_alt": F.col("l_linenumber")})
    return sv.support_filtered(rows).select("l_orderkey", "l_linenumber", F.array_join("filter", ";").alias("names"))


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('error', 'view') OR value > 90 GROUP BY 1")
def named_classes(spark, sf):
    """B11."""
    text = F.array(F.when(F.col("event_type") == "error", "Likely_Oncogenic").when(F.col("event_type") == "view", "TIER_II"), F.when(F.col("value") > 90, "of Uncertain significance").otherwise("benign"))
    return table(spark, sf, "events").filter(P.names_oncogenic(F.array_compact(text))).groupBy("event_type").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- fields


@query("""
WITH c AS (SELECT *, CASE n_nationkey WHEN 23 THEN 'X' WHEN 24 THEN 'Y' WHEN 0 THEN 'M' ELSE n_nationkey::VARCHAR END AS chrom FROM nation)
SELECT chrom, row_number() OVER (ORDER BY CASE chrom WHEN 'X' THEN 23 WHEN 'Y' THEN 24 WHEN 'M' THEN 25 ELSE chrom::INT END) AS by_file,
       row_number() OVER (ORDER BY CASE chrom WHEN 'X' THEN 23 WHEN 'Y' THEN 24 WHEN 'M' THEN 99 ELSE chrom::INT END) AS by_report FROM c
""")
def genomic_order(spark, sf):
    """Places in the two orders of chromosomes."""
    k = F.col("n_nationkey")
    chrom = F.when(k == 23, "X").when(k == 24, "Y").when(k == 0, "M").otherwise(k.cast("string"))
    rows = table(spark, sf, "nation").select(chrom.alias("chrom"), F.lit(1).alias("pos"))
    place = lambda df, name: W.global_index(df.withColumn("_k", S.vcf_order(F.col("chrom")) if name == "by_file" else S.report_order(F.col("chrom"))), ["_k"], name).select("chrom", (F.col(name) + 1).alias(name))
    return T.genomic_sort(place(rows, "by_file").join(place(rows, "by_report"), "chrom").withColumn("pos", F.lit(1))).drop("pos")


@query("""
WITH l AS (SELECT *, l_linenumber AS a, l_quantity AS b, l_partkey % 7 AS c, l_suppkey % 5 AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, round(CASE WHEN b + d = 0 THEN 0 ELSE (a + c) / (b + d) END, 6) AS af, l_returnflag <> 'N' AS contig, 'BND_' || l_orderkey || '_' || c || '_' || d AS pair, l_linenumber::VARCHAR AS mate FROM l
""")
def evidence_fields(spark, sf):
    """C7-C9."""
    a, b, c, d = F.col("l_linenumber"), F.col("l_quantity"), F.col("l_partkey") % 7, F.col("l_suppkey") % 5
    detail = F.concat_ws(":", a, b, c, d)
    fields = F.concat(F.lit("x|CTG:"), F.when(F.col("l_returnflag") == "N", ".").otherwise("ACGT"), F.lit("|y"))
    name = F.concat_ws("_", F.lit("BND"), "l_orderkey", "l_linenumber")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(S.coverage_fraction(detail), 6).alias("af"), S.has_contig(fields).alias("contig"), S.pair_id(name, F.array(c.cast("string"), d.cast("string"))).alias("pair"), S.mate_number(name).alias("mate"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size + p_partkey % 9 END AS depth, round(CASE WHEN p_size % 5 = 0 THEN NULL ELSE (p_partkey % 9)::DOUBLE / (p_size + p_partkey % 9) END, 6) AS af,
       p_brand || ':' || p_partkey || '_' || substr(p_name, 1, 1) || '->' || substr(p_type, 1, 2) AS key, p_partkey + (p_size * 1000) // 2 - 1 AS mid_start, p_partkey + (p_size * 1000) // 2 AS mid_end,
       p_size::BIGINT AS kb, round(log2(greatest((pow(2, p_size / 50.0) * (0.4 * 2 + 0.6 * 3) - 0.4 * 2) / 0.6, 0.000001) / 3), 6) AS pure FROM part
""")
def depth_fields(spark, sf):
    """C10, C12, C14, C15, C20, C31."""
    alt, ref = (F.col("p_partkey") % 9).cast("int"), F.col("p_size").cast("int")
    depth = S.depth_of(F.when(F.col("p_size") % 5 != 0, F.array(ref, F.lit(None).cast("int"), alt)))
    start, end = F.col("p_partkey"), F.col("p_partkey") + F.col("p_size") * 1000
    mid = S.midpoint(start, end)
    return table(spark, sf, "part").select(
        "p_partkey", depth.alias("depth"), S.allele_fraction(alt.cast("double"), depth).alias("af"), S.variant_key(F.col("p_brand"), F.col("p_partkey"), F.substring("p_name", 1, 1), F.substring("p_type", 1, 2)).alias("key"),
        mid["start"].alias("mid_start"), mid["end"].alias("mid_end"), S.kilobases(start, end).alias("kb"), F.round(S.purity_adjusted(F.col("p_size") / F.lit(50.0), 0.6, 3.0), 6).alias("pure"),
    )


@query(r"""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'c' || o_custkey ELSE 'c' || o_custkey END AS sample, 'case' || o_custkey AS "case", split_part(trim(o_orderpriority), ' ', 1) AS state,
       CASE WHEN o_orderstatus = 'O' THEN 'fastq.gz' WHEN o_orderstatus = 'F' THEN 'vcf.gz' END AS extension, array_to_string(string_split(lower(o_orderpriority), '_'), ',') AS tags,
       o_custkey::VARCHAR AS chrom, 'a' || o_custkey || 'b' AS everywhere, trim(regexp_replace(o_orderpriority, '\s+', ' ', 'g')) AS spaced, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS shown FROM orders
""")
def name_fields(spark, sf):
    """C25, C27-C30, C33, C34, C39."""
    c, key = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    sample = F.when(key % 2 == 0, F.concat(F.lit("c"), c, F.lit("_align_sort_x"))).otherwise(F.concat(F.lit("tumor.c"), c, F.lit("_R.x")))
    name = F.concat(F.lit("s.1."), F.when(F.col("o_orderstatus") == "O", "fastq.gz").when(F.col("o_orderstatus") == "F", "vcf.gz").otherwise("txt"))
    state = F.concat(F.lit(" "), F.get(F.split("o_orderpriority", " "), F.lit(0)), F.lit("++ by 0"))
    return table(spark, sf, "orders").select(
        "o_orderkey", S.sample_of_key(sample).alias("sample"), S.case_of_sample(F.concat(F.lit("case"), c, F.when(key % 2 == 0, "_TUMOR_1").otherwise("_NORMAL"))).alias("case"), S.job_state(state).alias("state"),
        S.known_extension(name, ("vcf.gz", "fastq.gz", "bam")).alias("extension"), F.array_join(S.stem_tags(F.col("o_orderpriority")), ",").alias("tags"), S.plain_chrom(F.concat(F.lit("chr"), c)).alias("chrom"),
        S.plain_chrom(F.concat(F.lit("achr"), c, F.lit("chrb")), True).alias("everywhere"), S.collapsed_space(F.concat(F.lit("  "), F.regexp_replace("o_orderpriority", " ", "\t \n"))).alias("spaced"),
        S.shown(F.when(F.col("o_orderstatus") == "P", "<NA>").otherwise(F.col("o_orderstatus"))).alias("shown"),
    )


@query("SELECT n_nationkey, 'data:text/plain;base64,' || base64(encode(n_name)) AS uri, n_nationkey || ':.:' || n_regionkey || chr(9) || n_name AS calls FROM nation")
def packed_fields(spark, sf):
    """C35, C37."""
    samples = F.array(F.array(F.col("n_nationkey").cast("string"), F.lit(None).cast("string"), F.col("n_regionkey").cast("string")), F.array("n_name"))
    return table(spark, sf, "nation").select("n_nationkey", S.data_uri(F.col("n_name").cast("binary"), "text/plain").alias("uri"), S.flat_calls(samples).alias("calls"))


@query("SELECT s_suppkey AS key, s_acctbal AS balance, s_nationkey FROM supplier")
def spec_columns(spark, sf):
    """B31, B32."""
    return T.to_spec(table(spark, sf, "supplier"), {"s_suppkey": "key", "s_acctbal": "balance"}, ["key", "absent", "balance"], drop=("nothing",), drop_prefix="s_na").join(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), "s_nationkey"), "key"
    )


# ---------------------------------------------------------------- joins


@query("""
SELECT l_orderkey, l_linenumber, (SELECT min(p_retailprice) FROM part WHERE p_partkey = l_partkey AND p_size % 2 = 0) AS price, round(m, 6) AS balance
FROM lineitem LEFT JOIN (SELECT s_suppkey, avg(s_acctbal) AS m FROM (SELECT s_suppkey, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, 0 FROM supplier) GROUP BY 1) ON s_suppkey = l_suppkey
""")
def exact_annotation(spark, sf):
    """D16, D17."""
    part = table(spark, sf, "part").filter("p_size % 2 = 0").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_acctbal")
    twice = s.unionByName(s.withColumn("s_acctbal", F.lit(0.0)))
    out = J.annotate(table(spark, sf, "lineitem"), [(part, ["l_partkey"], {"price": ("p_retailprice", "self")}), (twice, ["l_suppkey"], {"balance": ("s_acctbal", "mean")})])
    return out.select("l_orderkey", "l_linenumber", "price", F.round("balance", 6).alias("balance"))


_GERMLINE = """
WITH a AS (SELECT o_orderkey AS pos, o_totalprice AS qual, o_orderstatus AS f, floor(o_totalprice)::BIGINT AS dp FROM orders WHERE o_orderstatus <> 'F'),
     b AS (SELECT o_orderkey AS pos, o_totalprice + 1 AS qual, o_orderstatus AS f, o_custkey AS dp FROM orders WHERE o_orderpriority < '4' OR o_orderstatus = 'F')
"""


@query(_GERMLINE + """
SELECT coalesce(a.pos, b.pos) AS pos, round(coalesce(a.qual, b.qual), 2) AS qual,
       CASE WHEN a.pos IS NULL OR b.pos IS NULL OR a.f = b.f THEN coalesce(a.f, b.f) ELSE least(a.f, b.f) || ';' || greatest(a.f, b.f) END AS filter,
       CASE WHEN a.pos IS NULL THEN 'DP=' || b.dp || ';NORMAL' WHEN b.pos IS NULL THEN 'DP=' || a.dp || ';AF=1' ELSE 'DP=' || a.dp || ';AF=1;NORMAL;DP_LIST=' || a.dp || ',' || b.dp END AS info
FROM a FULL OUTER JOIN b ON a.pos = b.pos
""")
def caller_merge(spark, sf):
    """Two callers by real columns, every order in at least one."""
    o = table(spark, sf, "orders")
    key = {"chrom": F.lit("1"), "pos": F.col("o_orderkey"), "ref": F.lit("A"), "alt": F.lit("C"), "filter": F.col("o_orderstatus")}
    a = o.filter("o_orderstatus <> 'F'").select(*[c.alias(n) for n, c in key.items()], F.col("o_totalprice").alias("qual"), F.concat(F.lit("DP="), F.floor("o_totalprice").cast("long"), F.lit(";AF=1")).alias("info"))
    b = o.filter("o_orderpriority < '4' OR o_orderstatus = 'F'").select(*[c.alias(n) for n, c in key.items()], (F.col("o_totalprice") + 1).alias("qual"), F.concat(F.lit("DP="), "o_custkey", F.lit(";NORMAL")).alias("info"))
    return snv.merge_callers(a, b).select("pos", F.round("qual", 2).alias("qual"), "filter", "info")


@query("""
WITH r AS (SELECT DISTINCT lower(c_mktsegment) AS w FROM customer)
SELECT w AS wanted, (SELECT min(c_custkey) FROM customer WHERE contains(lower(c_mktsegment || '-' || c_name), w)) AS first FROM r
""")
def first_source(spark, sf):
    """D22, S4."""
    c = table(spark, sf, "customer")
    wanted = c.select(F.lower("c_mktsegment").alias("wanted")).distinct()
    sources = c.select(F.concat_ws("-", "c_mktsegment", "c_name").alias("name"), F.col("c_custkey").alias("first"))
    return J.first_source(wanted, sources, "wanted", "name", "first").select("wanted", "first")


@query("SELECT c_nationkey, round(sum(c_acctbal), 2) AS c_acctbal, bool_or(c_mktsegment = 'BUILDING') AS building, bool_or(c_acctbal > 9990) AS rich FROM customer GROUP BY 1")
def any_rollup(spark, sf):
    """G8."""
    rows = table(spark, sf, "customer").withColumns({"building": F.col("c_mktsegment") == "BUILDING", "rich": F.when(F.col("c_acctbal") > 9990, True)})
    return A.any_rollup(rows, ["c_nationkey"], "c_acctbal", ["building", "rich"]).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT o_custkey, count(*) AS n, string_agg(o_orderkey::VARCHAR || o_orderstatus, ',' ORDER BY o_orderkey) AS jobs FROM orders GROUP BY 1")
def ordered_jobs(spark, sf):
    """G24."""
    out = A.ordered_jobs(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", ["o_orderstatus"])
    return out.select("o_custkey", "n", F.array_join(F.transform("jobs", lambda j: F.concat(j["o_orderkey"].cast("string"), j["o_orderstatus"])), ",").alias("jobs"))


@query("""
WITH r AS (SELECT s_suppkey AS k, s_suppkey * 100 AS a, s_suppkey * 100 + 300 AS b FROM supplier), x AS (SELECT c_custkey * 6 AS s, c_custkey * 6 + c_nationkey * 4 + 2 AS e FROM customer),
ends AS (SELECT k, a, b, greatest(s, a) AS p, 1 AS step FROM r JOIN x ON s < b AND e > a UNION ALL SELECT k, a, b, least(e, b), -1 FROM r JOIN x ON s < b AND e > a),
steps AS (SELECT k, a, b, p, sum(step) AS step FROM ends GROUP BY ALL), runs AS (SELECT k, a, b, sum(step) OVER (PARTITION BY k ORDER BY p) AS depth, lead(p) OVER (PARTITION BY k ORDER BY p) - p AS len FROM steps)
SELECT r.k AS s_suppkey, round(coalesce(m, 0), 6) AS mean_depth, round(coalesce(s5, 0), 6) AS share_5, round(coalesce(s10, 0), 6) AS share_10 FROM r LEFT JOIN (
SELECT k, sum(depth * len) / (any_value(b) - any_value(a)) AS m, sum(CASE WHEN depth >= 5 THEN len ELSE 0 END) / (any_value(b) - any_value(a)) AS s5, sum(CASE WHEN depth >= 10 THEN len ELSE 0 END) / (any_value(b) - any_value(a)) AS s10 FROM runs GROUP BY 1) q ON q.k = r.k
""")
def region_coverage(spark, sf):
    """G16."""
    regions = table(spark, sf, "supplier").select("s_suppkey", F.lit("1").alias("chrom"), (F.col("s_suppkey") * 100).alias("a"), (F.col("s_suppkey") * 100 + 300).alias("b"))
    reads = table(spark, sf, "customer").select(F.lit("1").alias("chrom"), (F.col("c_custkey") * 6).alias("s"), (F.col("c_custkey") * 6 + F.col("c_nationkey") * 4 + 2).alias("e"))
    out = I.coverage_by_region(reads, regions, ["chrom"], ("s", "e"), ("a", "b"), ["s_suppkey"], [5, 10], 1000)
    return out.select("s_suppkey", *[F.round(c, 6).alias(c) for c in ("mean_depth", "share_5", "share_10")])


# ---------------------------------------------------------------- reshaping


@query("""
SELECT o_orderkey, unnest(['C', 'G', 'T'][1:1 + (o_orderkey % 3)::INT]) AS alt, unnest([1, 2, 3][1:1 + (o_orderkey % 3)::INT])::INT AS number, unnest(['9,1', '9,2', '9,3'][1:1 + (o_orderkey % 3)::INT]) AS ad FROM orders
""")
def split_alleles(spark, sf):
    """S14."""
    n = (F.col("o_orderkey") % 3).cast("int") + 1
    rows = table(spark, sf, "orders").select("o_orderkey", F.slice(F.array(*map(F.lit, "CGT")), F.lit(1), n).alias("alt"), F.slice(F.array(*map(F.lit, (1, 2, 3))), F.lit(1), n).alias("number"), F.array(*map(F.lit, (9, 1, 2, 3))).alias("ad"))
    out = T.split_alleles(rows, "alt", ["number"], ["ad"])
    return out.select("o_orderkey", "alt", "number", F.array_join("ad", ",").alias("ad"))


@query("""
SELECT c_custkey::VARCHAR AS sample, name, value, CASE name WHEN 'GC_DROPOUT' THEN CASE WHEN value < 3 THEN 'pass' ELSE 'fail' END WHEN 'PCT_TARGET_BASES_500X' THEN CASE WHEN value > 0.95 THEN 'pass' ELSE 'fail' END ELSE 'no_condition' END AS status
FROM customer, (SELECT unnest(['GC_DROPOUT', 'PCT_TARGET_BASES_500X', 'MEAN_INSERT_SIZE']) AS name) n, LATERAL (SELECT CASE name WHEN 'GC_DROPOUT' THEN (c_nationkey % 6)::DOUBLE WHEN 'PCT_TARGET_BASES_500X' THEN c_nationkey / 24.0 ELSE c_custkey::DOUBLE END AS value)
""")
def metric_rows(spark, sf):
    """H14, B29, B30, S16-S18."""
    c = table(spark, sf, "customer")
    values = F.create_map(
        F.lit("GC_DROPOUT"), (F.col("c_nationkey") % 6).cast("double").cast("string"), F.lit("PCT_TARGET_BASES_500X"), (F.col("c_nationkey") / F.lit(24.0)).cast("string"),
        F.lit("MEAN_INSERT_SIZE"), F.col("c_custkey").cast("string"), F.lit("OTHER"), F.lit("1"),
    )
    sample = F.concat(F.col("c_custkey").cast("string"), F.lit("_align_sort_1"))
    data = F.create_map(F.lit("multiqc_picard_HsMetrics"), F.create_map(sample, values, F.lit("umi_x"), values), F.lit("multiqc_picard_gcbias"), F.create_map(sample, F.create_map(F.lit("GC_DROPOUT"), F.lit("9"))))
    rows = cohort.metrics(c.select(data.alias("data")), "data", catalogs.requested_metrics("gmslymphoid"), "tga")
    return cohort.validated(rows).select("sample", "name", "value", "status")


# ---------------------------------------------------------------- analyses


@query("""
WITH j AS (SELECT l_suppkey || '/' || l_linenumber AS rule, l_partkey AS job_id, l_orderkey, CASE WHEN l_quantity < 5 THEN 'FAILED' WHEN l_quantity < 9 THEN 'CANCELLED' WHEN l_quantity < 12 THEN 'TIMEOUT' WHEN l_discount > 0.093 AND l_returnflag = 'A' THEN 'COMPLETED' ELSE 'RUNNING' END AS state FROM lineitem),
f AS (SELECT rule, max(job_id) FILTER (WHERE state IN ('FAILED', 'CANCELLED', 'TIMEOUT')) AS job_id FROM j GROUP BY 1 HAVING count(*) FILTER (WHERE state = 'COMPLETED') = 0)
SELECT f.rule, f.job_id, count(DISTINCT state) AS n_states FROM f JOIN j ON j.rule = f.rule AND j.job_id = f.job_id AND state IN ('FAILED', 'CANCELLED', 'TIMEOUT') GROUP BY 1, 2
""")
def job_outcomes(spark, sf):
    """States have details behind them, and most rules that end have failed at least once."""
    q = F.col("l_quantity")
    state = F.when(q < 5, " FAILED node_fail").when(q < 9, "CANCELLED+ by 0").when(q < 12, "TIMEOUT++").when((F.col("l_discount") > 0.093) & (F.col("l_returnflag") == "A"), "COMPLETED").otherwise("RUNNING")
    jobs = table(spark, sf, "lineitem").select(F.concat_ws("/", "l_suppkey", "l_linenumber").alias("rule"), F.col("l_partkey").cast("string").alias("job_id"), state.alias("state"), F.lit("p").alias("path"))
    last = cohort.job_outcomes(jobs).select("rule", F.col("job_id").cast("long").alias("job_id"))
    told = jobs.select("rule", F.col("job_id").cast("long").alias("job_id"), S.job_state(F.col("state")).alias("state")).filter(F.col("state").isin(*cohort.FAILED_STATES)).distinct()
    return last.join(told, ["rule", "job_id"]).groupBy("rule", "job_id").agg(F.count("*").alias("n_states"))


@query("""
SELECT count(*) AS n, (SELECT sum(p_size) / 1e6 FROM part)::DOUBLE AS units, round(count(*) / (SELECT sum(p_size) / 1e6 FROM part), 4) AS rate FROM lineitem
WHERE l_returnflag = 'R' AND l_discount >= 0.05 AND (l_linenumber % 3 <> 1 OR l_partkey % 2 = 0) AND l_shipdate IS NOT NULL AND l_suppkey % 10 <> 3 AND l_linestatus <> 'O'
""")
def mutation_burden(spark, sf):
    """Reference and alternate of one, or of two and one or two letters."""
    n = F.col("l_linenumber") % 3
    two = lambda c: F.when(c, "AC").otherwise("A")
    flag = F.when(F.col("l_returnflag") == "R", F.array(F.lit("PASS"))).when(F.col("l_returnflag") == "N", F.array(F.lit("x")))
    rows = table(spark, sf, "lineitem").select(
        flag.alias("filter"), F.col("l_discount").alias("af_t"), two(n == 1).alias("ref"), two((n == 1) & (F.col("l_partkey") % 2 != 0)).alias("alt"), F.when(F.col("l_suppkey") % 10 == 3, "rs1").alias("existing_variation"),
        F.lit("").alias("cosmic"), F.when(F.col("l_linestatus") == "O", F.array(F.lit("feature_truncation"))).alias("consequence"),
    )
    regions = table(spark, sf, "part").select(F.lit(0).alias("start"), F.col("p_size").alias("end"))
    return snv.mutational_burden(rows, regions).withColumn("rate", F.round("rate", 4))


@query("""
SELECT level || '_' || l_returnflag AS name, count(*) AS n, round(sum(l_discount), 4) AS total, sum(l_linenumber + 3)::BIGINT AS starts FROM lineitem, (VALUES ('o'), ('d')) AS t(level) WHERE l_returnflag <> 'N' GROUP BY 1
""")
def panel_points(spark, sf):
    """The middle of every bin at every level."""
    bins = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("chr"), F.col("l_linenumber").cast("long").alias("start"), (F.col("l_linenumber") + 7).cast("long").alias("end"), F.when(F.col("l_returnflag") == "N", "Antitarget").otherwise("g").alias("gene"), F.col("l_discount").alias("log2"))
    return cohort.panel_track(bins, ["o", "d"]).groupBy("name").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.sum("start").alias("starts"))


@query("""
WITH w AS (SELECT p_brand AS chr, p_type AS gene, p_partkey * 10 AS s, p_partkey * 10 + p_size AS e, p_retailprice / 1000 - 1 AS v FROM part WHERE p_brand <> 'backbone')
SELECT chr, gene, min(s) AS "start", max(e) AS "end", count(*) AS n, round(avg(v), 6) AS mean_log2 FROM w GROUP BY 1, 2
""")
def gene_table(spark, sf):
    """H9, G1."""
    bins = table(spark, sf, "part").select(F.col("p_brand").alias("chr"), F.col("p_type").alias("gene"), (F.col("p_partkey") * 10).alias("start"), (F.col("p_partkey") * 10 + F.col("p_size")).alias("end"), (F.col("p_retailprice") / 1000 - 1).alias("log2"))
    return cnv.genes(bins).select("chr", "gene", "start", "end", "n", F.round("mean_log2", 6).alias("mean_log2"))


@query("""
WITH b AS (SELECT DISTINCT ON (c, s) p_brand AS c, p_partkey AS s, p_retailprice / 1000 AS v FROM part), d AS (SELECT v - lag(v) OVER (PARTITION BY c ORDER BY s) AS x FROM b)
SELECT round(stddev_pop(x) / sqrt(2), 6) AS noise, (SELECT count(*) FROM part) AS total, (SELECT count(*) FROM part WHERE p_size % 7 = 0) AS filtered_out,
       (SELECT round(count(*) FILTER (WHERE p_size % 7 = 0) * 100.0 / count(*), 3)::DOUBLE FROM part) AS filtered_out_pct FROM d WHERE TRUE
""")
def quality_summary(spark, sf):
    """The baseline has all parts, the sample those whose size is no multiple of seven, for the noise all."""
    p = table(spark, sf, "part").select(F.col("p_brand").alias("chr"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + 1).alias("end"), (F.col("p_retailprice") / 1000).alias("log2"), "p_size")
    whole, seen = cnv.quality_summary(p, p), cnv.quality_summary(p.filter("p_size % 7 <> 0"), p)
    return whole.select(F.round("noise", 6).alias("noise")).join(seen.drop("noise"))


@query("""
WITH b AS (SELECT event_type AS c, event_id AS s, 1 + user_id % 9 AS w, value / 25 - 1 AS v FROM events),
x AS (SELECT c, s, sum(w) OVER (PARTITION BY c ORDER BY s) - w / 2 AS x, greatest(least(v, 2), -2) AS y, CASE WHEN count(*) OVER f = 5 THEN median(v) OVER f END AS smooth FROM b WINDOW f AS (PARTITION BY c ORDER BY s ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
SELECT c AS chr, s AS "start", round(x, 4) AS x, round(y, 6) AS y, round(smooth, 6) AS smooth FROM x
""")
def chromosome_view(spark, sf):
    """H18, E3, E7, C19, G6."""
    bins = table(spark, sf, "events").select(F.col("event_type").alias("chr"), F.col("event_id").alias("start"), (F.col("event_id") + 1 + F.col("user_id") % 9).alias("end"), F.lit("g").alias("gene"), (F.col("value") / 25 - 1).alias("log2"))
    return cnv.chromosome_view(bins).select("chr", "start", F.round("x", 4).alias("x"), F.round("y", 6).alias("y"), F.round("smooth", 6).alias("smooth"))


@query("""
WITH t AS (SELECT s_suppkey::VARCHAR AS id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'tumor' ELSE 'normal' END AS type FROM supplier)
SELECT p_name || p_partkey AS path, coalesce(name, (p_partkey % 150)::VARCHAR) || CASE WHEN type IS NULL THEN '' ELSE ',' || type END || ',' || p_brand AS tags FROM part LEFT JOIN t ON id = (p_partkey % 150)::VARCHAR
""")
def tagged_files(spark, sf):
    """H17, D21, D23, S10."""
    files = table(spark, sf, "part").select(F.concat("p_name", "p_partkey").alias("path"), F.array((F.col("p_partkey") % 150).cast("string"), F.col("p_brand"), F.col("p_brand")).alias("tags"))
    kind = F.when(F.col("s_suppkey") % 2 == 0, "tumor").otherwise("normal")
    samples = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), kind.alias("type"))
    return cohort.tagged_files(files, samples).select("path", F.array_join("tags", ",").alias("tags"))


@query("""
WITH w AS (SELECT n_name AS c, CASE WHEN e - s < 100 THEN greatest(0, (s + e) // 2 - 50) ELSE s END AS s, CASE WHEN e - s < 100 THEN (s + e) // 2 + 50 ELSE e END AS e FROM (SELECT n_name, c_custkey * 3 AS s, c_custkey * 3 + 1 + c_custkey % 200 AS e FROM customer JOIN nation ON n_nationkey = c_nationkey)),
m AS (SELECT *, max(e) OVER (PARTITION BY c ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM w), i AS (SELECT *, sum((s > coalesce(top, -1))::INT) OVER (PARTITION BY c ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT c AS chrom, min(s) AS "start", max(e) AS "end" FROM i GROUP BY c, k
""")
def panel_regions(spark, sf):
    """H19, C11, E14."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("chrom"), (F.col("c_custkey") * 3).alias("start"), (F.col("c_custkey") * 3 + 1 + F.col("c_custkey") % 200).alias("end"))
    return cohort.panel_regions(rows)


@query("""
SELECT l_suppkey AS pos, '1:' || l_suppkey || '_A->C' AS variant, l_discount AS af FROM lineitem WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 10 = 0 AND l_suppkey - 1 < s_suppkey + 3 AND l_suppkey > s_suppkey)
""")
def region_fractions(spark, sf):
    """H20, A23, D7."""
    rows = table(spark, sf, "lineitem").select(F.lit("1").alias("chrom"), F.col("l_suppkey").alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"), F.col("l_discount").alias("af"))
    regions = table(spark, sf, "supplier").filter("s_suppkey % 10 = 0").select(F.lit("1").alias("chrom"), F.col("s_suppkey").alias("start"), (F.col("s_suppkey") + 3).alias("end"))
    return snv.umi_fractions(rows, regions).select("pos", "variant", "af")


@query("""
WITH q AS (SELECT l_orderkey, l_linenumber, l_returnflag, list_filter([
  CASE WHEN coalesce(CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END > 0.3, false) THEN 'in_normal' END,
  CASE WHEN NOT (l_quantity >= 50 OR l_suppkey % 60 >= 50) THEN 'low_tumor_dp' END, CASE WHEN NOT l_linenumber >= 5 THEN 'low_tumor_ad' END, CASE WHEN NOT l_discount >= 0.005 THEN 'low_af' END,
  CASE WHEN NOT l_partkey % 5 < 3 THEN 'high_strand_oddsratio' END, CASE WHEN l_partkey % 14 > 12 THEN 'high_tnscope_rpa' END], lambda x: x IS NOT NULL) AS f FROM lineitem)
SELECT array_to_string(f, ';') AS names, count(*) AS n, count(*) FILTER (WHERE len(f) = 0 OR f = ['in_normal']) AS kept FROM q GROUP BY 1
""")
def quality_chain(spark, sf):
    """The filters of paired panel calls; matched-normal names stay soft."""
    depth = lambda total, alt: F.array((total - alt).cast("long"), alt.cast("long"))
    rows = table(spark, sf, "lineitem").select(
        F.array().cast("array<string>").alias("filter"), depth(F.col("l_quantity"), F.col("l_linenumber")).alias("ad_t"), depth(F.col("l_suppkey") % 60, F.lit(0)).alias("ad_n"), F.col("l_discount").alias("af_t"), F.col("l_tax").alias("af_n"),
        F.array(F.lit(0)).alias("qss"), F.lit(1).alias("alt_f1r2"), F.lit(1).alias("alt_f2r1"), (F.col("l_partkey") % 5).alias("sor"), F.array(F.col("l_partkey") % 14).alias("rpa"),
        F.lit(0).alias("dp"), F.lit(0).alias("vd"), F.lit(0.0).alias("af"), F.lit(0).alias("mq"),
    )
    soft, kept = snv.quality_filtered(rows, "tga", "paired", "tnscope", exome=False, soft_normals=True)
    count = lambda df, name: df.groupBy(F.array_join("filter", ";").alias("names")).agg(F.count("*").alias(name))
    return count(soft, "n").join(count(kept, "kept"), "names", "left").fillna(0, ["kept"])


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 3 = 0 THEN p_size / 5000.0 END AS a, CASE WHEN l_partkey % 5 = 0 THEN p_size / 25000.0 END AS b FROM lineitem JOIN part ON p_partkey = l_partkey),
f AS (SELECT *, list_filter([CASE WHEN NOT coalesce(a <= 0.01, true) THEN 'SWEGENAF' END, CASE WHEN NOT coalesce(b <= 0.001, true) THEN 'high_pop_freq' END], lambda x: x IS NOT NULL) AS names FROM v)
SELECT array_to_string(names, ';') AS names, count(*) AS n, CASE WHEN len(any_value(names)) = 0 THEN count(*) ELSE 0 END AS kept FROM f GROUP BY names
""")
def research_chain(spark, sf):
    """H4, B3, B5, D16."""
    part = table(spark, sf, "part")
    key = [F.lit("1").alias("chrom"), F.col("p_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt")]
    sources = {"SWEGENAF": part.filter("p_partkey % 3 = 0").select(*key, (F.col("p_size") / F.lit(5000.0)).alias("freq")), "high_pop_freq": part.filter("p_partkey % 5 = 0").select(*key, (F.col("p_size") / F.lit(25000.0)).alias("freq"))}
    rows = table(spark, sf, "lineitem").select(F.lit("1").alias("chrom"), F.col("l_partkey").alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    soft, kept = snv.research_filtered(rows, sources, "wgs")
    count = lambda df, name: df.groupBy(F.array_join("filter", ";").alias("names")).agg(F.count("*").alias(name))
    return count(soft, "n").join(count(kept, "kept"), "names", "left").fillna(0, ["kept"])


@query("""
WITH v AS (SELECT l_partkey, p_size, l_partkey % 6 = 0 AS listed, l_returnflag = 'A' AS onc, CASE WHEN p_size > 35 THEN 'Frq' ELSE '' END AS f FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT CASE WHEN f <> '' AND (listed OR onc) THEN 'PASS' ELSE f END AS filter, CASE WHEN f <> '' AND (listed OR onc) THEN f END AS rescue_filters,
       CASE WHEN f <> '' AND (listed OR onc) THEN array_to_string(list_filter([CASE WHEN listed THEN 'RescueList' END, CASE WHEN onc THEN 'ClinvarOnc' END], lambda x: x IS NOT NULL), '|') END AS rescue_status, count(*) AS n, count(*) FILTER (WHERE f = '' OR listed OR onc) AS kept FROM v GROUP BY ALL
""")
def clinical_chain(spark, sf):
    """H5, B11, B12, D2."""
    key = lambda k: [F.lit("1").alias("chrom"), F.col(k).alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt")]
    part = table(spark, sf, "part")
    rows = table(spark, sf, "lineitem").select(*key("l_partkey"), F.array(F.when(F.col("l_returnflag") == "A", "Oncogenic").otherwise("benign")).alias("onc"))
    sources = {"Frq": part.select(*key("p_partkey"), (F.col("p_size") / F.lit(5000.0)).alias("freq"))}
    saved, kept = snv.clinical_filtered(rows, sources, part.filter("p_partkey % 6 = 0").select(*key("p_partkey")), "wgs")
    names = ["filter", "rescue_filters", "rescue_status"]
    counted = lambda df, n: df.groupBy(F.array_join("filter", ";").alias("filter"), "rescue_filters", "rescue_status").agg(F.count("*").alias(n))
    left = counted(kept, "kept").toDF(*[f"_{c}" for c in names], "kept")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in names]
    return counted(saved, "n").join(left, same, "left").select(*names, "n", F.coalesce("kept", F.lit(0)).alias("kept"))


@query("""
WITH s AS (SELECT 'a' AS caller, s_nationkey::VARCHAR AS chr, s_suppkey * 1000 AS s, s_suppkey * 1000 + 5000 + s_nationkey * 100 AS e, s_suppkey % 4 AS cn FROM supplier UNION ALL
           SELECT 'b', s_nationkey::VARCHAR, s_suppkey * 1000 + 500, s_suppkey * 1000 + 2500, s_suppkey % 3 FROM supplier),
k AS (SELECT n_nationkey::VARCHAR AS chr, n_nationkey * 100 + r * 4000 AS s, n_nationkey * 100 + r * 4000 + 3999 AS e, 'q' || r AS band FROM nation, (SELECT unnest(range(0, (SELECT max(s_suppkey) // 4 + 3 FROM supplier))) AS r)),
h AS (SELECT s.caller, s.chr, s.s, min_by(band, k.s) AS first, max_by(band, k.s) AS last FROM s JOIN k ON s.chr = k.chr AND s.e >= k.s AND s.s <= k.e GROUP BY 1, 2, 3),
p AS (SELECT s.caller, s.chr, s.s, p_partkey, p_brand FROM s JOIN part ON p_size::VARCHAR = s.chr AND p_partkey * 50 < e AND p_partkey * 50 + 40 > s),
g AS (SELECT caller, chr, s, string_agg(p_brand, ',' ORDER BY p_brand) AS genes FROM (SELECT caller, chr, s, p_brand FROM p GROUP BY ALL HAVING count(*) >= 2) GROUP BY 1, 2, 3)
SELECT s.caller, s.chr, s.s AS "start", e AS "end", round_even((e - s.s) / 1000.0, 0)::BIGINT AS size_kb, CASE WHEN cn > 2 THEN 'AMPLIFICATION' WHEN cn < 2 THEN 'DELETION' ELSE 'NEUTRAL' END AS call,
       (SELECT count(*) FROM p WHERE p.caller = s.caller AND p.chr = s.chr AND p.s = s.s) AS n_targets, coalesce('chr' || s.chr || CASE WHEN first = last THEN first ELSE first || '-' || last END, '') AS cytoband, coalesce(genes, '') AS genes
FROM s LEFT JOIN h ON h.caller = s.caller AND h.chr = s.chr AND h.s = s.s LEFT JOIN g ON g.caller = s.caller AND g.chr = s.chr AND g.s = s.s
""")
def segment_table(spark, sf):
    """Segments of two callers with bands of every nation, genes and calls."""
    x = table(spark, sf, "supplier")
    common = lambda a, b, cn: x.select(F.col("s_nationkey").cast("string").alias("chr"), (F.col("s_suppkey") * 1000 + a).alias("start"), (F.col("s_suppkey") * 1000 + b).alias("end"), cn.alias("cn"))
    segments = [common(F.lit(0), F.col("s_nationkey") * 100 + 5000, F.col("s_suppkey") % 4), common(F.lit(500), F.lit(2500), F.col("s_suppkey") % 3)]
    bins = table(spark, sf, "part").select(F.col("p_size").cast("string").alias("chr"), (F.col("p_partkey") * 50).alias("start"), (F.col("p_partkey") * 50 + 40).alias("end"), F.col("p_brand").alias("gene"))
    most = x.agg(F.floor(F.max("s_suppkey") / 4).alias("most"))  # one row
    at = F.col("n_nationkey") * 100 + F.col("r") * 4000
    bands = table(spark, sf, "nation").join(F.broadcast(most)).select("n_nationkey", F.explode(F.sequence(F.lit(0), F.col("most") + 2)).alias("r")).select(F.col("n_nationkey").cast("string").alias("chr"), at.alias("band_start"), (at + 3999).alias("band_end"), F.concat(F.lit("q"), F.col("r").cast("string")).alias("band"))
    out = cnv.segment_table(segments, ["a", "b"], bins, bands, "female")
    return out.select("caller", "chr", "start", "end", "size_kb", "call", F.coalesce("n_targets", F.lit(0)).cast("long").alias("n_targets"), "cytoband", "genes")


@query("""
WITH e AS (SELECT user_id AS k, event_id, event_type, (value > 50)::INT AS hi FROM events), r AS (SELECT *, sum(ch) OVER (PARTITION BY k ORDER BY event_id) AS run FROM (SELECT *, coalesce((hi <> lag(hi) OVER (PARTITION BY k ORDER BY event_id))::INT, 0) AS ch FROM e)),
p AS (SELECT k, run, count(*) AS n, any_value(hi) AS sign FROM r GROUP BY 1, 2)
SELECT k AS user_id, min(n)::BIGINT AS least, (max(run) + 1)::BIGINT AS runs, sum(n)::BIGINT AS n FROM p GROUP BY 1
""")
def run_lengths(spark, sf):
    """Runs of like values and their lengths; merged runs hold all rows again."""
    e = table(spark, sf, "events").select("user_id", "event_id", (F.col("value") > 50).cast("int").alias("hi"))
    runs = W.islands(e, ["user_id"], ["event_id"], F.col("hi"))
    pieces = runs.groupBy("user_id", "run").agg(F.count("*").alias("n"), F.min("hi").alias("sign"))
    whole = W.bridge_merge(pieces, ["user_id"], "run", "sign", "n", 0)  # bridges of no row: nothing is joined
    back = pieces.join(whole, ["user_id"]).filter(F.col("run").between(F.col("first"), F.col("last")))
    return back.groupBy("user_id").agg(F.min("n").alias("least"), F.count("*").alias("runs"), F.sum("n").alias("n"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.05 AND NOT (l_returnflag = 'N') AND (l_linestatus = 'O' OR l_quantity > 25)")
def report_rows(spark, sf):
    """A signal, a call that isn't neutral, cancer genes only, targets and genes."""
    rows = table(spark, sf, "lineitem").withColumns(
        {
            "chr": F.lit("chr1"), "start": F.lit(5), "end": F.lit(9), "genes": F.concat(F.lit("A, "), "l_returnflag"), "n_targets": F.col("l_linenumber") + 5, "is_cancer_gene": F.when(F.col("l_discount") > 0.05, "TRUE").otherwise("no"),
            "pon_call": F.when(F.col("l_linestatus") == "O", "GAIN").otherwise("NEUTRAL"), "amount": F.col("l_quantity"),
        }
    )
    out = cnv.report_filter(rows, "1", 1, 6, [P.non_neutral(F.col("pon_call")), F.col("amount") > 25], ["r", "a "], 3, True)
    return out.filter(P.any_of_list(F.col("l_returnflag"), ["A", "R"])).select("l_orderkey", "l_linenumber")
