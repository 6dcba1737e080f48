"""Reference sequences, phased variants and bridged runs as queries on the general tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sequences as Q
from ..operators import windows as W
from ..sources import genomic as G
from ..sources import typed as Y
from ..sources.tables import settled, table
from . import cohort, snv, sv
from .carriers import query

#: The letters of a document as bases: few kinds of them, so that there are repeats to move over.
LETTERS, BASES = "abcdefghijklmnopqrstuvwxyz", "AACCAAGACATACACATCACAAAGCT"


def _contigs(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a contig."""
    letters = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]", "")
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("chrom"), F.lit(1).alias("start"), F.translate(letters, LETTERS, BASES).alias("bases"))


def _places(contigs: DataFrame, last: Column, first: int, many: int, width: int, more: int) -> DataFrame:
    """Numbers ``j`` up to ``last`` in pieces ``p`` of ``many`` (the first from ``first`` on), each with its ``piece`` of ``width + more`` bases only, so that a long contig isn't copied for each number."""
    pieces = contigs.withColumn("_last", last).filter(F.col("_last") >= 1).select("chrom", "bases", "_last", F.explode(F.expr(f"sequence(0, cast(floor((_last - {first}) / {many}) AS int))")).alias("p"))
    cut = pieces.select("chrom", "_last", "p", F.substring("bases", F.col("p") * width + 1, F.lit(width + more)).alias("piece"))
    return cut.select("chrom", "p", "piece", F.explode(F.expr(f"sequence(p * {many} + {first}, least(p * {many} + {first + many - 1}, _last))")).alias("j"))


_CONTIGS = f"SELECT doc_id::VARCHAR AS chrom, translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), '{LETTERS}', '{BASES}') AS s FROM documents"


@query(f"""
WITH RECURSIVE c AS ({_CONTIGS}), v AS (SELECT chrom, s, unnest(range(1, len(s) // 90)) AS j FROM c),
e AS (SELECT chrom, j * 90 + 1 AS p, CASE j % 3 WHEN 1 THEN 'I' ELSE 'D' END AS t, substr(s, j * 90 + 1, CASE j % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END) AS ins FROM v),
m AS (SELECT * FROM e UNION ALL SELECT chrom, p - 1, t, right(ins, 1) || left(ins, len(ins) - 1) FROM m JOIN c USING (chrom) WHERE p > 1 AND substr(s, p - 1, 1) = right(ins, 1)),
f AS (SELECT m.*, substr(s, p - 1, 1) AS front, substr(s, p + CASE t WHEN 'D' THEN len(ins) ELSE 0 END, 1) AS behind FROM m JOIN c USING (chrom) WHERE p = 1 OR substr(s, p - 1, 1) <> right(ins, 1))
SELECT DISTINCT chrom, greatest(p - 1, 1)::BIGINT AS pos, CASE WHEN p = 1 THEN '' ELSE front END || CASE t WHEN 'D' THEN ins ELSE '' END || CASE WHEN p = 1 THEN behind ELSE '' END AS ref,
       CASE WHEN p = 1 THEN '' ELSE front END || CASE t WHEN 'I' THEN ins ELSE '' END || CASE WHEN p = 1 THEN behind ELSE '' END AS alt FROM f
""")
def left_aligned(spark, sf):
    """Deletions and duplications in every document's sequence, left-aligned, each once."""
    contigs = settled(_contigs(spark, sf), "contigs")
    near = _places(contigs, F.floor(F.length("bases") / 90).cast("int") - 1, 1, 45, 45 * 90, 9).select("chrom", "j", F.expr("substring(piece, (j - 45 * p) * 90, 9)").alias("b"))
    one, n = F.substring("b", 1, 1), F.expr("CASE j % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END")
    two = F.concat(one, F.substring(F.col("b"), F.lit(2), n))
    dup = F.col("j") % 3 == 1
    behind = F.substring("b", 7, 2)  # bases that both alleles share
    rows = near.select("chrom", (F.col("j") * 90).alias("pos"), F.when(dup, one).when(F.col("j") % 3 == 0, two).otherwise(F.concat(two, F.substring("b", 6, 1), behind)).alias("ref"), F.array(F.when(dup, two).when(F.col("j") % 3 == 0, one).otherwise(F.concat(one, F.substring("b", 6, 1), behind))).alias("alt"))
    return snv.normalised(rows, settled(Q.blocks(contigs), "reference")).select("chrom", "pos", "ref", "alt")


@query(f"""
WITH c AS ({_CONTIGS}), j AS (SELECT chrom, s, unnest(range(1, len(s) // 60)) AS j FROM c),
v AS (SELECT chrom, s, j, 60 * (j // 3) + (j % 3) * 4 + 1 AS pos, CASE j % 3 WHEN 0 THEN 2 ELSE 1 END AS n, 'p' || (j // 3) AS phase FROM j WHERE NOT (j % 3 = 2 AND (j // 3) % 2 = 1)),
w AS (SELECT chrom, phase, j, pos, n, substr(s, pos, n) AS ref, CASE j % 3 WHEN 0 THEN substr(s, pos, 1) || translate(substr(s, pos + 1, 1), 'ACGT', 'TGCA') ELSE translate(substr(s, pos, n), 'ACGT', 'TGCA') END AS alt,
       substr(s, pos + n, coalesce(lead(pos) OVER (PARTITION BY chrom, phase ORDER BY pos) - pos - n, 0)) AS gap FROM v),
g AS (SELECT chrom, phase, min(pos) AS pos, string_agg(ref || gap, '' ORDER BY pos) AS ref, string_agg(alt || gap, '' ORDER BY pos) AS alt, count(*) AS k, round_even(avg(j * 1.5), 4) AS qual,
       avg((j % 10) / 20.0) AS af, floor(avg(j % 30))::INT AS ad_ref, floor(avg(j % 7))::INT AS ad_alt, count(DISTINCT j % 5 = 0) AS names, min(CASE WHEN j % 5 = 0 THEN 'in_normal' ELSE 'PASS' END) AS name,
       round_even(avg(j % 40), 4) AS dp, count(*) FILTER (WHERE j % 4 = 0) AS without FROM w GROUP BY ALL HAVING count(*) > 1),
t AS (SELECT *, coalesce(list_filter(range(1, least(len(ref), len(alt))), lambda i: substr(ref, i, 1) <> substr(alt, i, 1))[1] - 1, least(len(ref), len(alt)) - 1) AS same FROM g)
SELECT chrom, phase, pos + same AS pos, substr(ref, same + 1) AS ref, substr(alt, same + 1) AS alt, qual, round(af, 6) AS af, ad_ref, ad_alt, CASE WHEN names > 1 THEN 'MNV_CONFLICTING_FILTERS' ELSE name END AS filter, dp,
       CASE WHEN without > 0 THEN NULL ELSE 1.0 END AS mq, k::BIGINT AS n_parts FROM t
""")
def phased_variants(spark, sf):
    """Variants of two or three phased parts in every document's sequence, with the bases between."""
    contigs = settled(_contigs(spark, sf), "contigs")
    j = _places(contigs, F.floor(F.length("bases") / 60).cast("int") - 1, 0, 204, 68 * 60, 0).filter("j > 0 AND NOT (j % 3 = 2 AND floor(j / 3) % 2 = 1)").withColumn("pos", F.expr("cast(60 * floor(j / 3) + (j % 3) * 4 + 1 AS long)"))
    at = lambda a, n: F.substring("piece", (F.col("pos") - F.col("p") * (68 * 60) + a).cast("int"), F.lit(n))
    other = lambda c: F.translate(c, "ACGT", "TGCA")
    first = F.col("j") % 3 == 0
    depth = F.create_map(F.lit("DP"), (F.col("j") % 40).cast("double"), F.lit("MQ"), F.when(F.col("j") % 4 != 0, 1.0))
    rows = j.select(
        "chrom", "pos", F.when(first, at(0, 2)).otherwise(at(0, 1)).alias("ref"), F.when(first, F.concat(at(0, 1), other(at(1, 1)))).otherwise(other(at(0, 1))).alias("alt"), F.expr("concat('p', cast(floor(j / 3) AS string))").alias("phase"),
        (F.col("j") * 1.5).alias("qual"), ((F.col("j") % 10) / F.lit(20.0)).alias("af"), F.array((F.col("j") % 30).cast("int"), (F.col("j") % 7).cast("int")).alias("ad"), F.array(F.when(F.col("j") % 5 == 0, "in_normal").otherwise("PASS")).alias("filter"), depth.alias("info"),
    )
    merged = snv.phased_merge(rows, settled(Q.blocks(contigs), "reference"), preserved=[]).filter(F.col("parts").isNotNull())
    return merged.select(
        "chrom", "phase", "pos", "ref", "alt", "qual", F.round("af", 6).alias("af"), F.col("ad")[0].alias("ad_ref"), F.col("ad")[1].alias("ad_alt"), F.array_join("filter", ";").alias("filter"), F.col("info.DP").alias("dp"), F.col("info.MQ").alias("mq"),
        F.size(F.split("parts.vars", ",")).cast("long").alias("n_parts"),
    )


@query("""
WITH RECURSIVE e AS (SELECT event_type AS k, event_id, CASE WHEN abs(value - 50) < 15 THEN 0 ELSE sign(value - 50) END AS s FROM events),
r AS (SELECT *, sum((s <> coalesce(p, s))::INT) OVER (PARTITION BY k ORDER BY event_id) AS run FROM (SELECT *, lag(s) OVER (PARTITION BY k ORDER BY event_id) AS p FROM e)),
q AS (SELECT k, run, any_value(s) AS s, count(*) AS n FROM r GROUP BY 1, 2),
c AS (SELECT k, run, s, coalesce(s <> 0 AND lead(s, 2) OVER w = s AND lead(s) OVER w = 0 AND lead(n) OVER w <= 2, false) AS joins FROM q WINDOW w AS (PARTITION BY k ORDER BY run)),
t AS (SELECT k, run, s, joins, 0 AS clean FROM c WHERE run = 0 UNION ALL SELECT c.k, c.run, c.s, c.joins, t.clean + 1 FROM t JOIN c ON c.k = t.k AND c.run = t.run + CASE WHEN t.joins THEN 3 ELSE 1 END)
SELECT k AS event_type, clean::BIGINT AS clean, run::BIGINT AS first, (run + CASE WHEN joins THEN 2 ELSE 0 END)::BIGINT AS last, s::INT AS sign FROM t
""")
def bridged_runs(spark, sf):
    """Runs of like signs, joined from left to right over bridges of one or two rows."""
    e = table(spark, sf, "events").select("event_type", "event_id", F.when(F.abs(F.col("value") - 50) < 15, 0).otherwise(F.signum(F.col("value") - 50)).cast("int").alias("sign"))
    runs = W.islands(e, ["event_type"], ["event_id"], F.col("sign")).groupBy("event_type", "run").agg(F.first("sign").alias("sign"), F.count("*").alias("n"))
    return W.bridge_merge(runs, ["event_type"], "run", "sign", "n", 2)


_CALLS = """SELECT event_type AS chrom, event_type || ':' || user_id AS key, CASE WHEN user_id % 2 = 0 THEN 'manta' ELSE 'delly' END AS caller, min(floor(epoch(ts))::BIGINT) AS s, max(floor(epoch(ts))::BIGINT) + 1 AS e FROM events GROUP BY 1, 2, 3"""


def _calls(spark: SparkSession, sf: str) -> DataFrame:
    """The span of each user's events of one kind as a call."""
    at = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    caller = F.when(F.col("user_id") % 2 == 0, "manta").otherwise("delly")
    rows = table(spark, sf, "events").select(F.col("event_type").alias("chrom"), F.concat_ws(":", "event_type", "user_id").alias("key"), caller.alias("caller"), at.alias("at"))
    spans = rows.groupBy("chrom", "key", "caller").agg(F.min("at").alias("start"), (F.max("at") + 1).alias("end"))
    return spans.withColumns({"svtype": F.lit("DEL"), "filter": F.array(F.lit("PASS"))})


@query(f"""
WITH RECURSIVE c AS ({_CALLS}),
l AS (SELECT a.chrom, a.key AS ka, b.key AS kb, (least(a.e, b.e) - greatest(a.s, b.s))::DOUBLE / greatest(a.e - a.s, b.e - b.s) AS score FROM c a JOIN c b ON a.chrom = b.chrom AND a.caller = 'manta' AND b.caller = 'delly'
      AND ((least(a.e, b.e) > greatest(a.s, b.s) AND least(a.e, b.e) - greatest(a.s, b.s) >= 0.98 * greatest(a.e - a.s, b.e - b.s)) OR (abs(a.s - b.s) <= 5000 AND abs(a.e - b.e) <= 5000))),
p AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY score DESC, ka, kb) AS i FROM l),
g AS (SELECT DISTINCT chrom, 0::BIGINT AS i, []::VARCHAR[] AS used, NULL::VARCHAR AS ka, NULL::VARCHAR AS kb FROM c
      UNION ALL SELECT g.chrom, p.i, CASE WHEN list_contains(used, p.ka) OR list_contains(used, p.kb) THEN used ELSE used || [p.ka, p.kb] END,
        CASE WHEN list_contains(used, p.ka) OR list_contains(used, p.kb) THEN NULL ELSE p.ka END, p.kb FROM g JOIN p ON p.chrom = g.chrom AND p.i = g.i + 1),
m AS (SELECT ka, kb FROM g WHERE ka IS NOT NULL)
SELECT key, coalesce(least(x.ka, x.kb), least(y.ka, y.kb), key) AS cluster, CASE WHEN x.ka IS NULL AND y.ka IS NULL THEN caller ELSE 'delly,manta' END AS callers, y.ka IS NULL AS chosen
FROM c LEFT JOIN m x ON x.ka = key LEFT JOIN m y ON y.kb = key
""")
def caller_clusters(spark, sf):
    """No two calls of one caller in a cluster, the representative by the callers' order."""
    return sv.merged(_calls(spark, sf), ratio=0.98).select("key", "cluster", "callers", "chosen")


@query(f"""
WITH RECURSIVE c AS ({_CALLS}), l AS (SELECT a.key AS a, b.key AS b FROM c a JOIN c b ON a.chrom = b.chrom AND a.key <> b.key
      AND ((least(a.e, b.e) > greatest(a.s, b.s) AND least(a.e, b.e) - greatest(a.s, b.s) >= 0.995 * greatest(a.e - a.s, b.e - b.s)) OR (abs(a.s - b.s) <= 500 AND abs(a.e - b.e) <= 500))),
r AS (SELECT key AS v, key AS w FROM c UNION SELECT r.v, l.b FROM r JOIN l ON r.w = l.a), n AS (SELECT v, min(w) AS cluster FROM r GROUP BY v),
t AS (SELECT key, cluster, CASE caller WHEN 'manta' THEN 'tumor' ELSE 'normal' END AS caller FROM c JOIN n ON v = key)
SELECT key, cluster, CASE WHEN min(caller) OVER w = max(caller) OVER w THEN caller ELSE 'normal,tumor' END AS callers, row_number() OVER (PARTITION BY cluster ORDER BY caller DESC, key) = 1 AS chosen
FROM t WINDOW w AS (PARTITION BY cluster)
""")
def paired_clusters(spark, sf):
    """Calls of tumour and normal that are connected by likeness."""
    calls = _calls(spark, sf).withColumn("caller", F.when(F.col("caller") == "manta", "tumor").otherwise("normal"))
    return sv.paired(calls, ratio=0.995).select("key", "cluster", "callers", "chosen")


@query("""
WITH m AS (SELECT c_nationkey AS sample, CASE WHEN c_mktsegment < 'G' THEN 'target' ELSE 'antitarget' END AS kind, CASE WHEN c_custkey % 3 = 0 THEN 'Y' WHEN c_custkey % 3 = 1 THEN 'X' ELSE '7' END AS chrom,
             CASE WHEN c_custkey % 3 = 0 THEN abs(c_acctbal) / (1 + c_nationkey * 3) ELSE abs(c_acctbal) + 1 END AS d FROM customer),
w AS (SELECT sample, kind, median(d) FILTER (WHERE chrom = 'Y') AS y, median(d) FILTER (WHERE chrom = 'X') AS x, count(*) FILTER (WHERE chrom = 'X') AS nx, count(*) FILTER (WHERE chrom = 'Y') AS ny FROM m WHERE chrom IN ('X', 'Y') GROUP BY 1, 2)
SELECT sample, kind, CASE WHEN x IS NULL OR y IS NULL THEN 'unknown' WHEN y / x > 0.2 THEN 'male' WHEN y / x <= 0.15 THEN 'female' ELSE 'unknown' END AS sex, nx::BIGINT AS n_x, ny::BIGINT AS n_y FROM w
""")
def panel_sexes(spark, sf):
    """Sex by the ratio of two medians, for both kinds of coverage of a sample."""
    n = F.col("c_custkey") % 3
    depth = F.when(n == 0, F.abs("c_acctbal") / (1 + F.col("c_nationkey") * 3)).otherwise(F.abs("c_acctbal") + 1)
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias("sample"), F.when(F.col("c_mktsegment") < "G", "target").otherwise("antitarget").alias("kind"), F.when(n == 0, "Y").when(n == 1, "X").otherwise("7").alias("chrom"), depth.alias("depth"))
    return cohort.rated_sex(rows).select("sample", "kind", "sex", F.col("X_count").cast("long").alias("n_x"), F.col("Y_count").cast("long").alias("n_y"))


_LEVELS = "(VALUES ('o', 100000), ('a', 25000), ('b', 5000), ('c', 1000)) AS l(k, z)"


@query(f"""
WITH RECURSIVE r AS (SELECT o_orderstatus AS t, left(o_orderpriority, 1) AS c, o_orderkey * 100 + 1 AS s, o_orderkey * 100 + 100 AS e, o_custkey AS v FROM orders),
o AS (SELECT *, row_number() OVER w AS i, sum(v) OVER w AS upto, lag(e) OVER w AS e0, count(*) OVER (PARTITION BY t) AS n FROM r WINDOW w AS (PARTITION BY t ORDER BY c, s)),
x AS (SELECT o.*, k, z, max(i) OVER (PARTITION BY t, c) AS edge FROM o, {_LEVELS}),
y AS (SELECT x.*, CASE WHEN coalesce(f.i, x.edge + 1) <= x.n THEN coalesce(f.i, x.edge + 1) END AS j FROM x ASOF LEFT JOIN o f ON x.t = f.t AND x.c = f.c AND x.s + x.z - 1 <= f.e),
w AS (SELECT DISTINCT t, k, 1::BIGINT AS i FROM y UNION ALL SELECT w.t, w.k, y.j + 1 FROM w JOIN y ON w.t = y.t AND w.k = y.k AND w.i = y.i WHERE y.j < y.n),
g AS (SELECT y.*, b.e AS ej, b.e0 AS ej0, b.c AS cj, b.s AS sj, b.v AS vj, b.upto AS upj FROM w JOIN y ON w.t = y.t AND w.k = y.k AND w.i = y.i LEFT JOIN o b ON b.t = y.t AND b.i = coalesce(y.j, y.n)),
h AS (
  SELECT t, k, c, s, ej AS e, (upj - upto + v) / (n - i + 1) AS m FROM g WHERE j IS NULL
  UNION ALL SELECT t, k, c, s, unnest(CASE WHEN j = n THEN [ej, ej0] ELSE [ej] END), (upj - upto + v) / (j - i + 1) FROM g WHERE j IS NOT NULL AND ej - s + 1 = z
  UNION ALL SELECT t, k, c, s, unnest(CASE WHEN ej - s + 1 > z AND cj <> c THEN [ej0, ej0] ELSE [ej0] END), (upj - vj - upto + v) / (j - i) FROM g WHERE j IS NOT NULL AND ej - s + 1 <> z AND (ej - s + 1 > z OR cj <> c)
  UNION ALL SELECT t, k, cj, sj, ej, vj FROM g WHERE j = n AND ej - s + 1 <> z
  UNION ALL SELECT t, 'd', c, s, unnest(CASE WHEN i = n THEN [e, e] ELSE [e] END), v FROM o)
SELECT t AS track, k || '_' || c AS name, s + (e - s) // 2 - 1 AS start, s + (e - s) // 2 AS "end", round(m, 6) AS value FROM h
""")
def coverage_regions(spark, sf):
    """Mean coverage in regions of five sizes; two of the three tracks hold nearly all rows."""
    key = F.col("o_orderkey").cast("long") * 100
    rows = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("track"), F.substring("o_orderpriority", 1, 1).alias("chrom"), (key + 1).alias("start"), (key + 100).alias("end"), F.col("o_custkey").cast("double").alias("value"))
    out = cohort.coverage_track(rows, by=["track"])
    return out.select("track", "name", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.round("value", 6).alias("value"))


_DECLARED = ("AF,Number=A,Type=Float", "AD,Number=R,Type=Integer", "PL,Number=G,Type=Integer", "DP,Number=1,Type=Integer", "DB,Number=0,Type=Flag")


@query("""
WITH p AS (SELECT p_partkey::BIGINT AS k, unnest(CASE WHEN p_partkey % 2 = 0 THEN [0, 1] ELSE [0] END) AS i FROM part)
SELECT (k % 22 + 1)::VARCHAR AS chrom, k * 10 AS pos, CASE WHEN k % 2 = 1 THEN 'T' WHEN i = 0 THEN 'C' ELSE 'G' END AS alt, CASE WHEN i = 0 THEN (k % 10) / 10.0 ELSE (k % 9) / 8.0 END AS af, k % 30 AS ad_ref,
       CASE WHEN i = 0 THEN k % 7 WHEN k % 6 <> 0 THEN k % 5 END::DOUBLE AS ad_alt, k AS pl_ref, CASE WHEN i = 0 THEN k + 1 ELSE k + 3 END AS pl_het, CASE WHEN i = 0 THEN k + 2 ELSE k + 5 END AS pl_hom, CASE WHEN k % 4 <> 0 THEN k % 40 END::DOUBLE AS dp, k % 3 = 0 AS db FROM p
""")
def typed_alleles(spark, sf):
    """Records whose fields are typed and split by what the header declares."""
    header = G.parse_header(spark.createDataFrame([(f"##INFO=<ID={d},Description=\"of {d[:2]}\">",) for d in _DECLARED], "value string"))
    k, two = F.col("p_partkey").cast("long"), F.col("p_partkey") % 2 == 0
    listed = lambda one, more: F.concat_ws(",", *one, *[F.when(two, m) for m in more])
    info = F.concat_ws(";", F.concat(F.lit("AF="), listed([k % 10 / 10], [k % 9 / 8])), F.concat(F.lit("AD="), listed([k % 30, k % 7], [F.when(k % 6 != 0, (k % 5).cast("string")).otherwise(".")])),
                       F.concat(F.lit("PL="), listed([k, k + 1, k + 2], [k + 3, k + 4, k + 5])), F.concat(F.lit("DP="), F.when(k % 4 != 0, (k % 40).cast("string")).otherwise(".")), F.when(k % 3 == 0, "DB"))
    text = F.concat_ws("\t", k % 22 + 1, k * 10, F.lit("."), F.lit("A"), F.when(two, "C,G").otherwise("T"), F.lit("."), F.lit("PASS"), info)
    fields = Y.declared(header)
    split = Y.split_by_header(Y.typed_info(G.parse_vcf(table(spark, sf, "part").select(text.alias("value"))), fields), fields)
    f = lambda name, i: F.col(f"fields.{name}")[i]
    return split.select("chrom", "pos", "alt", f("AF", 0).alias("af"), f("AD", 0).alias("ad_ref"), f("AD", 1).cast("double").alias("ad_alt"), f("PL", 0).alias("pl_ref"), f("PL", 1).alias("pl_het"), f("PL", 2).alias("pl_hom"), F.col("fields.DP").cast("double").alias("dp"), F.col("fields.DB").alias("db"))
