"""Each operator applied to the general tables, over whole tables, with the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import intervals as I
from ..operators import joins as J
from ..operators import sets as T
from ..operators import windows as W
from ..sources.tables import settled, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _seconds():
    """Whole seconds since 1970 of ``ts``, which has no time zone."""
    return F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")


def _chain(spark: SparkSession, sf: str) -> DataFrame:
    tax = F.when(F.col("l_tax") != 0, F.col("l_tax"))
    return P.soft_filters(
        table(spark, sf, "lineitem"),
        [
            P.SoftFilter("low_quantity", F.col("l_quantity") >= 10),
            P.SoftFilter("high_discount", F.col("l_discount") > 0.08, "exclude"),
            P.SoftFilter("high_tax", P.or_missing(tax <= 0.06, tax)),
        ],
    )


_CHAIN_SQL = """
SELECT *, list_filter([CASE WHEN NOT coalesce(l_quantity >= 10, false) THEN 'low_quantity' END,
                       CASE WHEN coalesce(l_discount > 0.08, false) THEN 'high_discount' END,
                       CASE WHEN NOT coalesce(nullif(l_tax, 0) <= 0.06, true) THEN 'high_tax' END], lambda x: x IS NOT NULL) AS f FROM lineitem
"""


@query(f"SELECT array_to_string(f, ';') AS filters, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM ({_CHAIN_SQL}) GROUP BY 1")
def soft_filter_chain(spark, sf):
    """B1-B3."""
    return _chain(spark, sf).groupBy(F.array_join("filter", ";").alias("filters")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query(f"SELECT l_returnflag, count(*) AS sites, count(*) FILTER (WHERE len(f) = 0) AS passed FROM ({_CHAIN_SQL}) WHERE NOT list_has_any(f, ['low_quantity', 'high_tax']) GROUP BY 1")
def hard_filter_counts(spark, sf):
    """B4, B5, G13."""
    kept = P.hard_filter(_chain(spark, sf), ["low_quantity", "high_tax"])
    return kept.groupBy("l_returnflag").agg(F.count("*").alias("sites"), F.count_if(P.is_pass(missing=True)).alias("passed"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE upper(trim(event_type)) <> 'ERROR' OR coalesce(value, 0) >= 50 GROUP BY 1")
def source_dependent_filter(spark, sf):
    """B9."""
    kept = table(spark, sf, "events").filter(P.source_dependent(F.col("event_type"), "error", F.col("value"), 50))
    return kept.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""
WITH a AS (SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS f FROM orders WHERE o_orderstatus <> 'F'),
     b AS (SELECT o_orderkey, o_totalprice + 1 AS price, CASE WHEN o_orderpriority LIKE '1%' THEN 'PASS' ELSE 'X;' || o_orderstatus END AS f FROM orders WHERE o_orderpriority < '4' OR o_orderstatus = 'F'),
     j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.price, b.price) AS price,
                  list_distinct(list_concat(string_split(coalesce(a.f, ''), ';'), string_split(coalesce(b.f, ''), ';'))) AS fs
           FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey),
     k AS (SELECT *, list_sort(list_filter(fs, lambda x: x NOT IN ('', 'PASS'))) AS named FROM j)
SELECT o_orderkey, price, CASE WHEN len(named) > 0 THEN array_to_string(named, ';') WHEN list_contains(fs, 'PASS') THEN 'PASS' ELSE '.' END AS filter FROM k
""")
def two_caller_merge(spark, sf):
    """D1, C3."""
    o = table(spark, sf, "orders")
    a = o.filter("o_orderstatus <> 'F'").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("filter"))
    status = F.when(F.col("o_orderpriority").startswith("1"), "PASS").otherwise(F.concat(F.lit("X;"), "o_orderstatus"))
    b = o.filter("o_orderpriority < '4' OR o_orderstatus = 'F'").select("o_orderkey", (F.col("o_totalprice") + 1).alias("price"), status.alias("filter"))
    return J.merge_full_outer(a, b, ["o_orderkey"], {"filter": S.merged_filter})


@query("""
SELECT o_custkey, 'DP=' || first(p ORDER BY o_orderdate, o_orderkey) || CASE WHEN count(*) > 1 THEN ';DP_LIST=' || string_agg(p, ',' ORDER BY o_orderdate, o_orderkey) ELSE '' END AS info
FROM (SELECT *, (floor(o_totalprice)::BIGINT)::VARCHAR AS p FROM orders) GROUP BY 1
""")
def info_list_merge(spark, sf):
    """C1, C2."""
    item = F.concat(F.lit("DP="), F.floor("o_totalprice").cast("long").cast("string"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", item.alias("item")))), lambda x: x["item"])
    return table(spark, sf, "orders").groupBy("o_custkey").agg(items.alias("items")).select("o_custkey", S.merged_info(F.col("items")).alias("info"))


@query("""
SELECT event_id, user_id, user_id IN (SELECT user_id FROM events WHERE value > 95) AS in_list,
       CASE WHEN user_id IN (SELECT user_id FROM events WHERE value > 95) AND event_type = 'error' THEN 'PASS' ELSE event_type END AS filter,
       CASE WHEN user_id IN (SELECT user_id FROM events WHERE value > 95) AND event_type = 'error' THEN 'error' END AS rescue_filters
FROM events
""")
def rescue_flag(spark, sf):
    """D2, B12."""
    e = table(spark, sf, "events").withColumn("filter", F.when(F.col("event_type") == "error", F.array(F.lit("error"))).otherwise(F.array()))
    flagged = J.flag_join(e, e.filter("value > 95"), ["user_id"], "in_list")
    reasons = F.array_compact(F.array(F.when(F.col("in_list"), "RescueList")))
    out = P.rescued(flagged, reasons)
    return out.select("event_id", "user_id", "in_list", F.when(F.size("filter") > 0, F.array_join("filter", ";")).otherwise(F.col("event_type")).alias("filter"), "rescue_filters")


@query("""
SELECT p_partkey, round(p_retailprice - b.base, 4) AS delta, round(abs(p_retailprice - b.base) / (b.spread / sqrt(b.n)), 4) AS z
FROM part JOIN (SELECT p_brand, avg(p_retailprice) AS base, stddev_samp(p_retailprice) AS spread, count(*) AS n FROM part GROUP BY 1) b USING (p_brand)
""")
def left_unique_baseline(spark, sf):
    """D3-D5 without the check of keys, C17."""
    p = table(spark, sf, "part")
    base = p.groupBy("p_brand").agg(F.avg("p_retailprice").alias("base"), F.stddev_samp("p_retailprice").alias("spread"), F.count("*").alias("n"))
    delta = F.col("p_retailprice") - F.col("base")
    return J.left_unique(p, base, ["p_brand"], check=False).select("p_partkey", F.round(delta, 4).alias("delta"), F.round(S.abs_z(delta, F.col("spread"), F.col("n")), 4).alias("z"))


@query("""
SELECT count(*) AS total, count(*) FILTER (WHERE NOT s) AS filtered_out, round(count(*) FILTER (WHERE NOT s) * 100.0 / count(*), 3)::DOUBLE AS filtered_out_pct
FROM (SELECT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS s FROM customer)
""")
def filtered_out_stats(spark, sf):
    """D6."""
    return J.missing_stats(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), ["k"])


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    """Span of each user and event type in seconds."""
    e = table(spark, sf, "events").withColumn("s", _seconds())
    return e.groupBy("user_id", "event_type").agg(F.min("s").alias("start"), (F.max("s") + 1).alias("end"), F.count("*").alias("n"))


_SPANS = "SELECT user_id, event_type, min(floor(epoch(ts))::BIGINT) AS s, max(floor(epoch(ts))::BIGINT) + 1 AS e, count(*) AS n FROM events GROUP BY 1, 2"
_ORIGIN = 1704067200


def _weeks(spark: SparkSession) -> DataFrame:
    return spark.range(6).select(F.col("id").alias("week"), (F.col("id") * 604800 + _ORIGIN).alias("w_start"), ((F.col("id") + 1) * 604800 + _ORIGIN).alias("w_end"), F.lit("all").alias("k"))


_WEEKS = f"SELECT i AS week, i * 604800 + {_ORIGIN} AS ws, (i + 1) * 604800 + {_ORIGIN} AS we FROM range(6) t(i)"


@query(f"""
SELECT count(*) AS n, round(sum(value), 4) AS total FROM events e
WHERE EXISTS (SELECT 1 FROM (SELECT user_id, floor(epoch(ts))::BIGINT AS t FROM events WHERE value > 98) r WHERE r.user_id = e.user_id AND floor(epoch(e.ts))::BIGINT > r.t - 3600 AND floor(epoch(e.ts))::BIGINT < r.t + 3600)
""")
def region_semi(spark, sf):
    """D7."""
    e = table(spark, sf, "events").select("event_id", "user_id", "value", _seconds().alias("p"), (_seconds() + 1).alias("q"))
    regions = e.filter("value > 98").select("user_id", (F.col("p") - 3599).alias("a"), (F.col("p") + 3600).alias("b"))
    return I.overlap_join(e, regions, ["user_id"], ("p", "q"), ("a", "b"), 7200, how="left_semi").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""
SELECT user_id, event_type, week, overlap FROM (
  SELECT s.*, w.week, least(e, we) - greatest(s, ws) AS overlap, row_number() OVER (PARTITION BY user_id, event_type ORDER BY least(e, we) - greatest(s, ws) DESC, ws) AS nth
  FROM ({_SPANS}) s LEFT JOIN ({_WEEKS}) w ON e > ws AND s < we) WHERE nth = 1
""")
def best_overlap(spark, sf):
    """D8, C16."""
    spans = _spans(spark, sf).withColumn("k", F.lit("all"))
    out = I.best_overlap(spans, _weeks(spark), ["k"], ("start", "end"), ("w_start", "w_end"), ["user_id", "event_type"], 604800)
    return out.select("user_id", "event_type", "week", "overlap")


@query(f"""
WITH p AS (SELECT week, floor(epoch(ts))::BIGINT AS t, event_type FROM ({_WEEKS}) JOIN events ON floor(epoch(ts))::BIGINT + 1 > ws AND floor(epoch(ts))::BIGINT < we),
     g AS (SELECT week, event_type FROM p GROUP BY 1, 2 HAVING count(*) >= 40)
SELECT w.week, coalesce(n, 0) AS n_targets, coalesce(l, '') AS labels FROM ({_WEEKS}) w
LEFT JOIN (SELECT week, count(DISTINCT t) AS n FROM p GROUP BY 1) USING (week) LEFT JOIN (SELECT week, string_agg(event_type, ',' ORDER BY event_type) AS l FROM g GROUP BY 1) USING (week)
""")
def overlap_gene_list(spark, sf):
    """D9, G10."""
    e = table(spark, sf, "events").select(F.lit("all").alias("k"), _seconds().alias("p"), (_seconds() + 1).alias("q"), "event_type")
    return I.overlap_counts(_weeks(spark), e, ["k"], ("w_start", "w_end"), ("p", "q"), ["week"], "event_type", 40, 604800).select("week", "n_targets", "labels")


@query(f"""
SELECT user_id, event_type, CASE WHEN min(week) = max(week) THEN 'w' || min(week) ELSE 'w' || min(week) || '-' || max(week) END AS band
FROM ({_SPANS}) s JOIN ({_WEEKS}) w ON e >= ws AND s <= we GROUP BY 1, 2
""")
def band_label(spark, sf):
    """D10, C21."""
    spans = _spans(spark, sf).withColumn("k", F.lit("all"))
    bands = _weeks(spark).withColumn("name", F.col("week").cast("string"))
    out = I.band_range(spans, bands, ["k"], ("start", "end"), ("w_start", "w_end"), ["user_id", "event_type"], "name", 604800)
    return out.select("user_id", "event_type", S.band_label(F.lit("w"), F.col("first_band"), F.col("last_band")).alias("band"))


@query(f"""
WITH r AS (SELECT event_type, floor(epoch(ts))::BIGINT AS t, max(event_id) AS v FROM events GROUP BY 1, 2),
     l AS (SELECT o_orderkey, CASE o_orderkey % 2 WHEN 0 THEN 'click' ELSE 'view' END AS event_type, {_ORIGIN} - 50000 + o_orderkey % 2600000 AS p FROM orders)
SELECT o_orderkey, coalesce(r.v, f.v) AS event_id FROM l ASOF LEFT JOIN r ON l.event_type = r.event_type AND l.p >= r.t
LEFT JOIN (SELECT event_type, arg_min(v, t) AS v FROM r GROUP BY 1) f ON f.event_type = l.event_type
""")
def asof_lookup(spark, sf):
    """D11."""
    e = table(spark, sf, "events").select("event_type", _seconds().alias("t"), "event_id")
    kind = F.when(F.col("o_orderkey") % 2 == 0, "click").otherwise("view")
    o = table(spark, sf, "orders").select("o_orderkey", kind.alias("event_type"), (F.col("o_orderkey") % 2600000 + _ORIGIN - 50000).alias("p"))
    return I.asof_backward(o, e, ["event_type"], "p", "t", "event_id", "event_id").select("o_orderkey", "event_id")


def _like_sql(ratio: float) -> str:
    return f"""
SELECT a.event_type, a.user_id AS user_a, b.user_id AS user_b FROM ({_SPANS}) a JOIN ({_SPANS}) b ON a.event_type = b.event_type AND a.user_id < b.user_id
AND least(a.e, b.e) > greatest(a.s, b.s) AND least(a.e, b.e) - greatest(a.s, b.s) >= {ratio} * greatest(a.e - a.s, b.e - b.s)
"""


def _like(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of like spans by the ratio that the reference asks of like variants."""
    spans = settled(_spans(spark, sf), "spans")
    a = spans.select("event_type", F.col("user_id").alias("user_a"), "start", "end")
    b = spans.select("event_type", F.col("user_id").alias("user_b"), F.col("start").alias("s"), F.col("end").alias("e"))
    return I.fuzzy_join(a, b, ["event_type"], ("start", "end"), ("s", "e"), 0.8, width=864000).filter("user_a < user_b").select("event_type", "user_a", "user_b")


@query(_like_sql(0.8))
def fuzzy_reciprocal(spark, sf):
    """D12."""
    return _like(spark, sf)


@query(f"""
WITH RECURSIVE p AS ({_like_sql(0.995)}), e AS (SELECT event_type || user_a AS a, event_type || user_b AS b FROM p), both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a AS v, b AS c FROM both_ways UNION SELECT r.v, x.b FROM r JOIN both_ways x ON r.c = x.a)
SELECT v, least(v, min(c)) AS c FROM r GROUP BY v
""")
def caller_components(spark, sf):
    """D13."""
    spans = _spans(spark, sf).withColumn("v", F.concat("event_type", F.col("user_id").cast("string")))
    of = settled(I.like_components(spans, ["event_type"], ("start", "end"), "v", lambda df: settled(df, "components"), 0.995), "components")
    return of.join(of.filter("v <> c").select("c").distinct(), "c", "left_semi").select("v", "c")


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS f FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, (count(*) OVER w >= 2) AND (max((f = 'R')::INT) OVER w = 1) AS promoted FROM x WINDOW w AS (PARTITION BY l_orderkey)
""")
def mate_promotion(spark, sf):
    """D15, E12, G7."""
    one = A.one_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag"])
    return J.promote_mates(one, "l_orderkey", "l_linenumber", lambda: F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "promoted")


@query("SELECT event_type, round(stddev_pop(d) / sqrt(2), 6) AS noise FROM (SELECT event_type, value - lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS d FROM events) GROUP BY 1")
def dlr_noise(spark, sf):
    """E1, G5."""
    return A.noise(W.lag_diff(table(spark, sf, "events"), ["event_type"], ["event_id"], "value"), ["event_type"], "diff").withColumn("noise", F.round("noise", 6))


@query("SELECT event_id, round(median(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS median FROM events")
def centered_median3(spark, sf):
    """E2."""
    return W.centered_median(table(spark, sf, "events"), ["event_type"], ["event_id"], "value", 3).select("event_id", F.round("median", 6).alias("median"))


@query("""
SELECT event_id, CASE WHEN count(value) OVER w = 5 THEN round(median(value) OVER w, 6) END AS median FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)
""")
def centered_median5_full(spark, sf):
    """E3."""
    return W.centered_median(table(spark, sf, "events"), ["event_type"], ["event_id"], "value", 5, full=True).select("event_id", F.round("median", 6).alias("median"))


@query("""
WITH a AS (SELECT *, value - 50 AS z FROM events), l AS (SELECT *, CASE WHEN abs(z) < 5 THEN 0 WHEN z > 0 THEN 1 ELSE -1 END AS s FROM a),
c AS (SELECT *, coalesce((s <> lag(s) OVER w)::INT, 0) AS ch FROM l WINDOW w AS (PARTITION BY event_type ORDER BY event_id)),
r AS (SELECT *, sum(ch) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT event_type, min(event_id) AS first_id, max(event_id) AS last_id, count(*) AS n, s AS sign FROM r GROUP BY event_type, run, s HAVING count(*) >= 4
""")
def sign_islands(spark, sf):
    """E4, E5."""
    e = table(spark, sf, "events").withColumn("sign", W.sign_label(F.col("value") - 50, 5))
    runs = W.islands(e, ["event_type"], ["event_id"], F.col("sign"))
    out = runs.groupBy("event_type", "run", "sign").agg(F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), F.count("*").alias("n"))
    return out.filter("n >= 4").drop("run")


@query("""
WITH x AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i FROM events), b AS (SELECT event_type, avg(value) AS base, stddev_pop(value) AS spread FROM events GROUP BY 1)
SELECT event_type, (i // 16)::BIGINT AS block, count(*) AS n, round(avg(value - base), 6) AS delta, round(abs(avg(value - base)) / (avg(spread) / sqrt(count(*))), 6) AS z
FROM x JOIN b USING (event_type) GROUP BY 1, 2 HAVING count(*) >= 4 AND abs(avg(value - base)) / (avg(spread) / sqrt(count(*))) >= 1.5
""")
def accepted_runs(spark, sf):
    """E15."""
    e = table(spark, sf, "events")
    base = e.groupBy("event_type").agg(F.avg("value").alias("base"), F.stddev_pop("value").alias("spread"))
    block = F.floor((F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")) - 1) / 16).cast("long")
    rows = e.withColumn("block", block).join(base, "event_type")
    out = W.accepted_runs(rows, ["event_type"], "block", "value", "base", "spread", 4, 1.5)
    return out.select("event_type", "block", "n", F.round("delta", 6).alias("delta"), F.round("z", 6).alias("z"))


@query("""
SELECT level, count(*) AS n, sum(event_id)::BIGINT AS ids FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events), (VALUES ('o', 9), ('a', 3), ('b', 1)) t(level, step) WHERE i % step = 0 GROUP BY 1
""")
def every_nth(spark, sf):
    """E8, S6."""
    return W.every_nth(table(spark, sf, "events").select("event_id"), ["event_id"], {"o": 8, "a": 2, "b": 0}).groupBy("level").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT p_partkey, round(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) - p_size / 2, 4)::DOUBLE AS center, greatest(least(p_retailprice - 1000, 300), -300)::DOUBLE AS y FROM part")
def cumsum_center(spark, sf):
    """E7, C19."""
    p = W.cumulative_center(table(spark, sf, "part"), ["p_brand"], ["p_partkey"], "p_size")
    return p.select("p_partkey", F.round("center", 4).cast("double").alias("center"), S.clipped(F.col("p_retailprice") - 1000, 300.0).alias("y"))


@query("""
WITH i AS (SELECT user_id, floor(epoch(ts))::BIGINT - 3600 AS s, floor(epoch(ts))::BIGINT + 3601 AS e FROM events),
m AS (SELECT *, coalesce(s > max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)::INT AS new FROM i),
n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT user_id, min(s) AS "start", max(e) AS "end" FROM n GROUP BY user_id, k
""")
def interval_union(spark, sf):
    """E14."""
    e = table(spark, sf, "events").select("user_id", _seconds().alias("start"), (_seconds() + 1).alias("end"))
    return I.interval_union(e, ["user_id"], "start", "end", pad=3600)


@query("""
SELECT p_partkey, CASE WHEN p_size < 20 THEN greatest(0, p_partkey + p_size // 2 - 10) ELSE p_partkey END::BIGINT AS "start", CASE WHEN p_size < 20 THEN p_partkey + p_size // 2 + 10 ELSE p_partkey + p_size END::BIGINT AS "end" FROM part
""")
def bed_extend(spark, sf):
    """C11: the centre of an interval of this length is start + length div 2."""
    p = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") * 2).alias("a"), (F.col("p_partkey") * 2 + F.col("p_size")).alias("b"))
    x = S.extended(F.col("p_partkey"), F.col("p_partkey") + (F.col("b") - F.col("a")), 20)
    return p.select("p_partkey", x["start"].alias("start"), x["end"].alias("end"))


@query("""
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events e
WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.value > 97)) WHERE n = 1
""")
def latest_failure(spark, sf):
    """E11, C28."""
    e = table(spark, sf, "events")
    done = (F.col("event_type") == "purchase") & (F.col("value") > 97)
    return W.latest_of_group(e, ["user_id"], [F.col("event_id").desc()], keep=F.col("event_type") == "error", unless=done).select("user_id", "event_id", "event_type")


@query("""
SELECT event_id, list_max(v) AS top, list_position(v, list_max(v)) - 1 AS idx FROM (SELECT event_id, [value, 100 - value, 55.0] AS v FROM events)
""")
def argmax_list(spark, sf):
    """E10."""
    v = F.array(F.col("value"), 100 - F.col("value"), F.lit(55.0))
    x = W.argmax_index(v)
    return table(spark, sf, "events").select("event_id", x["value"].alias("top"), x["index"].alias("idx"))


@query("""
SELECT l_suppkey, l_returnflag, min(l_orderkey) AS "start", max(l_orderkey) AS "end", count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean_l_quantity, min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity, round(avg(l_tax), 6) AS mean_l_tax
FROM lineitem GROUP BY 1, 2
""")
def gene_rollup(spark, sf):
    """G1, G2, G9."""
    out = A.rollup(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"], "l_orderkey", "l_orderkey", "l_quantity", ["l_tax"])
    return out.withColumns({"mean_l_quantity": F.round("mean_l_quantity", 4), "mean_l_tax": F.round("mean_l_tax", 6)})


@query("""
WITH s AS (SELECT event_type, avg(value) AS mean, median(value) AS med, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS std, count(value) AS n FROM events GROUP BY 1)
SELECT event_type, round(mean, 6) AS mean, round(med, 6) AS median, lo AS "min", hi AS "max", round(std, 6) AS std, n AS "count",
CASE WHEN n < 10 THEN 'low' WHEN n < 50 THEN 'medium' ELSE 'high' END AS amount, CASE WHEN med / hi > 0.1 THEN 'male' WHEN med / hi < 0.08 THEN 'female' ELSE 'unknown' END AS sex FROM s
""")
def stats_pivot(spark, sf):
    """G3, G4, B21, B22."""
    s = A.stats(table(spark, sf, "events"), ["event_type"], "value")
    ratio = F.col("median") / F.col("max")
    return s.withColumns({"amount": P.data_amount(F.col("count"), F.col("count")), "sex": P.sex_by_median(ratio)}).withColumns({c: F.round(c, 6) for c in ("mean", "median", "std")})


@query("SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs FROM documents GROUP BY 1")
def distinct_collect(spark, sf):
    """G6."""
    return A.distinct_list(table(spark, sf, "documents"), ["source"], "lang", "langs")


@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split(trim(p_name), ' ')) AS word FROM part) GROUP BY 1 HAVING count(*) >= 3")
def explode_counts(spark, sf):
    """S12, G10."""
    return A.counts_at_least(T.explode_list(table(spark, sf, "part"), "p_name", "word", " "), ["word"], 3)


@query("SELECT event_type, round(avg(n), 6) AS mean_count, count(*) AS keys FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def two_level_mean(spark, sf):
    """G14."""
    return A.two_level_mean(table(spark, sf, "events"), ["user_id"], ["event_type"]).withColumn("mean_count", F.round("mean_count", 6))


@query("SELECT count(*) AS n, (SELECT sum(p_size) / 1e3 FROM part)::DOUBLE AS units, round(count(*) / (SELECT sum(p_size) / 1e3 FROM part), 6) AS rate FROM lineitem WHERE l_discount >= 0.05 AND l_returnflag = 'R'")
def rate_per_unit(spark, sf):
    """G12."""
    rows = table(spark, sf, "lineitem").filter("l_discount >= 0.05 AND l_returnflag = 'R'")
    return A.rate_per_unit(rows, table(spark, sf, "part"), F.col("p_size"), 1e3).withColumn("rate", F.round("rate", 6))


@query("""
SELECT user_id, event_id, event_type, score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, (event_type = 'purchase') DESC, event_id DESC) AS nth FROM (
SELECT *, CASE WHEN value >= 90 THEN 4 WHEN value >= 70 THEN 3 ELSE 1 END + CASE WHEN event_id % 100 < 10 THEN 1 WHEN event_id % 100 < 50 THEN 5 ELSE 6 END + (event_type = 'purchase')::INT AS score FROM events)) WHERE nth = 1
""")
def score_consolidate(spark, sf):
    """G19, C22."""
    target = F.col("event_type") == "purchase"
    fraction = F.when(F.col("value") >= 90, "high").when(F.col("value") >= 70, "medium").otherwise("low")
    amount = P.data_amount(F.col("event_id") % 100, F.col("event_id") % 100)
    scored = table(spark, sf, "events").withColumn("score", S.confidence(fraction, amount, target))
    return J.choose_by_score(scored, ["user_id"], [F.col("score").desc(), target.desc(), F.col("event_id").desc()]).select("user_id", "event_id", "event_type", "score")


@query("SELECT c_nationkey, floor(c_acctbal / 500)::BIGINT AS level, CASE WHEN count(DISTINCT c_mktsegment) = 1 THEN min(c_mktsegment) ELSE 'conflicting' END AS segment FROM customer GROUP BY 1, 2")
def group_agreement(spark, sf):
    """G20."""
    rows = table(spark, sf, "customer").withColumn("level", F.floor(F.col("c_acctbal") / 500).cast("long"))
    return A.agreement(rows, ["c_nationkey", "level"], "c_mktsegment", "segment")


@query("""
WITH c AS (SELECT * FROM (VALUES ('click', 'lt', 50.0), ('view', 'ge', 20.0), ('purchase', 'eq', 7.0), ('signup', NULL, NULL)) t(event_type, norm, threshold)),
j AS (SELECT e.event_id, e.event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v, norm, threshold FROM events e LEFT JOIN c USING (event_type))
SELECT event_type, CASE WHEN norm IS NULL THEN 'no_condition' WHEN coalesce(CASE norm WHEN 'lt' THEN v < threshold WHEN 'ge' THEN v >= threshold WHEN 'eq' THEN v = threshold END, false) THEN 'pass' ELSE 'fail' END AS status, count(*) AS n FROM j GROUP BY 1, 2
""")
def metric_validate(spark, sf):
    """B30."""
    catalog = spark.createDataFrame([("click", "lt", 50.0), ("view", "ge", 20.0), ("purchase", "eq", 7.0), ("signup", None, None)], "event_type string, norm string, threshold double")
    rows = table(spark, sf, "events").join(F.broadcast(catalog), "event_type", "left").withColumn("v", F.get_json_object("props", "$.k").try_cast("double"))
    return rows.groupBy("event_type", P.metric_status(F.col("norm"), F.col("v"), F.col("threshold")).alias("status")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, 'customer' AS source FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier")
def union_by_name(spark, sf):
    """S5."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return T.union_all([c, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))], ["customer", "supplier"])


def _keys(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT s_suppkey FROM supplier")
def set_except(spark, sf):
    """S8."""
    return T.minus(_keys(spark, sf)[0], table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")), ["k"])


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def set_intersect(spark, sf):
    """S9."""
    return T.common(*_keys(spark, sf), ["k"])


@query("SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS price FROM orders WHERE o_orderstatus = 'O'")
def zip_expand(spark, sf):
    """S13."""
    o = table(spark, sf, "orders").filter("o_orderstatus = 'O'")
    lists = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))).alias("x"))
    out = T.zip_expand(lists, {"o_orderkey": F.col("x.o_orderkey"), "price": F.col("x.o_totalprice")})
    return out.select("o_custkey", "o_orderkey", F.round("price", 2).alias("price"))


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: least(x::DOUBLE, 0.1::DOUBLE))), 4) AS total FROM embeddings")
def array_cap(spark, sf):
    """C23."""
    capped = S.capped(F.col("embedding").cast("array<double>"), 0.1)
    return table(spark, sf, "embeddings").select("vec_id", F.round(F.aggregate(capped, F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN (l_partkey & 234) <> 0 THEN CASE WHEN l_returnflag = 'N' OR (l_partkey & 8) <> 0 THEN l_partkey | 8 ELSE l_partkey END | 1 ELSE l_partkey END AS flag FROM lineitem")
def bit_repair(spark, sf):
    """C24."""
    mate = F.when(F.col("l_returnflag") == "N", "*").otherwise("chr1")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.repaired_flag(F.col("l_partkey"), mate).alias("flag"))


@query(f"""
SELECT event_id FROM events WHERE floor(epoch(ts))::BIGINT >= {_ORIGIN + 86400 * 5} AND floor(epoch(ts))::BIGINT <= {_ORIGIN + 86400 * 12}
AND list_has_any([lower(event_type)], ['click', 'error']) AND coalesce(CAST(json_extract_string(props, '$.k') AS DOUBLE) >= 10, true) AND (value > 60 OR lower(event_type) NOT IN ('click', ''))
""")
def interactive_filter(spark, sf):
    """J1-J3, J5, J7, J8."""
    t = _seconds()
    rows = P.in_range(F.lit("chr1"), t, t, "1", _ORIGIN + 86400 * 5, _ORIGIN + 86400 * 12)
    signal = P.any_signal(F.col("value") > 60, P.present_text(F.col("event_type")) & (F.lower("event_type") != "click"))
    keep = rows & P.any_of_list(F.col("event_type"), ["Click", "error "]) & P.min_targets(F.get_json_object("props", "$.k"), 10) & signal
    return table(spark, sf, "events").filter(keep).select("event_id")


@query("""
WITH c AS (SELECT * FROM (VALUES ('low', NULL, '1-URGENT'), ('open', 'O', NULL), ('any', NULL, NULL), ('shut', 'F', '5-LOW')) t(name, status, priority))
SELECT name, count(*) AS n FROM orders JOIN c ON (status IS NULL OR status = o_orderstatus) AND (priority IS NULL OR priority = o_orderpriority) GROUP BY 1
""")
def catalog_match(spark, sf):
    """The catalog has four entries; orders are counted by what it looks at before it is matched."""
    catalog = spark.createDataFrame([("low", None, "1-URGENT"), ("open", "O", None), ("any", None, None), ("shut", "F", "5-LOW")], "name string, status string, priority string")
    counted = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    fits = P.catalog_match(F.col("status"), F.col("o_orderstatus")) & P.catalog_match(F.col("priority"), F.col("o_orderpriority"))
    return counted.join(F.broadcast(catalog), fits).groupBy("name").agg(F.sum("n").alias("n"))


@query("""
SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN '' WHEN c_nationkey % 5 > e THEN 'AMPLIFICATION' WHEN c_nationkey % 5 < e THEN 'DELETION' ELSE 'NEUTRAL' END AS call FROM (
SELECT *, CASE c_custkey % 4 WHEN 0 THEN CASE WHEN c_nationkey % 2 = 0 THEN 2 ELSE 1 END WHEN 1 THEN CASE WHEN c_nationkey % 2 = 0 THEN 0 ELSE 1 END ELSE 2 END AS e FROM customer)
""")
def copy_class(spark, sf):
    """B17, B18."""
    chrom = F.when(F.col("c_custkey") % 4 == 0, "chrX").when(F.col("c_custkey") % 4 == 1, "Y").otherwise("7")
    sex = F.when(F.col("c_nationkey") % 2 == 0, "female").otherwise("male")
    copies = F.when(F.col("c_acctbal").isNotNull(), F.col("c_nationkey") % 5)
    return table(spark, sf, "customer").select("c_custkey", P.copy_class(copies, chrom, sex).alias("call"))


@query("""
SELECT p_brand, count(*) AS sites, count(*) FILTER (WHERE length(r) = 1 AND length(a) = 1) AS snps, count(*) FILTER (WHERE length(r) <> length(a)) AS indels, count(*) FILTER (WHERE length(r) = length(a) AND length(r) > 1) AS mnps, 0::BIGINT AS others
FROM (SELECT p_brand, substr(p_type, 1, 1 + p_size % 3) AS r, substr(p_name, 1, (1 + p_partkey % 3)::INT) AS a FROM part) GROUP BY 1
""")
def variant_types(spark, sf):
    """G13, B10."""
    p = table(spark, sf, "part").select("p_brand", F.expr("substr(p_type, 1, 1 + p_size % 3)").alias("ref"), F.expr("substr(p_name, 1, cast(1 + p_partkey % 3 as int))").alias("alt"))
    return A.variant_types(p, by=["p_brand"])


@query("""
WITH e AS (SELECT event_type, event_id, floor(epoch(ts))::BIGINT AS p FROM events), g AS (SELECT *, coalesce((p - lag(p) OVER w) > 120, false)::INT AS far FROM e WINDOW w AS (PARTITION BY event_type ORDER BY p, event_id)),
s AS (SELECT *, sum(far) OVER (PARTITION BY event_type ORDER BY p, event_id ROWS UNBOUNDED PRECEDING) AS stack FROM g)
SELECT event_type, min(p) AS "start", count(*) AS n FROM s GROUP BY event_type, stack
""")
def stack_islands(spark, sf):
    """Rows of one letter each."""
    e = table(spark, sf, "events").select("event_type", _seconds().alias("p"), F.lit("A").alias("ref"))
    return W.stacks(e, ["event_type"], "p", "ref", 120).groupBy("event_type", "stack").agg(F.min("p").alias("start"), F.count("*").alias("n")).drop("stack")
