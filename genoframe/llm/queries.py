"""The contract queries of the text operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, classifier, decontaminate, html, lm, near, quality, secrets, spelling, substring, tokens, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(_table(spark, sf_dir, "documents"), digest_only=True)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = decontaminate.find_contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_files(_table(spark, sf_dir, "documents"), crc=True)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return classifier.classify(docs, classifier.train(docs, _table(spark, sf_dir, "labels")))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, m -> m.kind = {i})) AS long)").alias(f"n_{kind}") for i, kind in enumerate(secrets.KINDS)]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"), "n_live", "n_copied")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {"op1_substring_dedup": op1_substring_dedup, "op2_decontaminate": op2_decontaminate, "op3_quality_rules": op3_quality_rules, "op4_lm_score": op4_lm_score, "op5_near_dedup": op5_near_dedup, "op6_token_files": op6_token_files, "op7_warc": op7_warc, "op8_bpe": op8_bpe, "op9_html_extraction": op9_html_extraction, "op10_quality_classifier": op10_quality_classifier, "op11_secret_scan": op11_secret_scan, "op12_embedding_whitening": op12_embedding_whitening, "op13_spelling_variants": op13_spelling_variants}


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS p, w FROM words WHERE len(w) >= 20
), keyed AS (
  SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS win FROM windows
), late AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS nth FROM keyed) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, p + o AS p FROM late, range(0, 20) AS t(o)
), lost AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w
         ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(ps, x[2])), lambda x: x[1]) END, ' '), '')) AS kept_sha256
FROM words d LEFT JOIN lost USING (doc_id)
"""


OP2_SQL = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_at AS (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM item WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM item_at
), doc_at AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM low, (SELECT DISTINCT n FROM win) WHERE len(w) >= n
), hit AS (
  SELECT d.doc_id, d.p, d.n, x.item_id FROM (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM doc_at) d JOIN win x ON d.win = x.win AND d.n = x.n
), covered AS (
  SELECT doc_id, count(DISTINCT p + o) AS n_hit FROM hit, range(0, 10) AS t(o) WHERE o < n GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')))) END AS s FROM words
), classes AS (
  SELECT s, min(doc_id) AS rep, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), items AS (
  SELECT rep, n, unnest(s) AS g FROM classes
), rare AS (
  SELECT *, row_number() OVER (PARTITION BY rep ORDER BY f, g) AS k FROM (SELECT *, count(*) OVER (PARTITION BY g) AS f FROM items)
), prefix AS (
  SELECT rep, n, g FROM rare WHERE k <= n - ceil(0.75 * n) + 1
), pairs AS (
  SELECT DISTINCT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb FROM prefix a JOIN prefix b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
), links AS (
  SELECT p.a, p.b FROM pairs p JOIN items x ON x.rep = p.a JOIN items y ON y.rep = p.b AND y.g = x.g
  GROUP BY p.a, p.b, p.na, p.nb HAVING 100 * count(*) >= 75 * (p.na + p.nb - count(*))
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS v, b AS c FROM edges UNION SELECT r.v, e.b FROM reach r JOIN edges e ON r.c = e.a
), least_of AS (
  SELECT v, min(c) AS c FROM reach GROUP BY v
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(least(c.rep, l.c), c.rep, s.doc_id) AS component_id, coalesce(least(c.rep, l.c), c.rep, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN classes c ON s.s = c.s AND len(s.s) > 0 LEFT JOIN least_of l ON c.rep = l.v
"""

def _fence(measure: str) -> str:
    return f"max(greatest(high + {quality.FENCES[measure][1]} * (high - mid), rare)) FILTER (WHERE m = '{measure}')"


def _over(measure: str) -> str:
    errors, scale = quality.ERRORS[measure], quality.COUNTS[measure][1]
    return f"(o_{measure} > 0 AND o_{measure} * o_{measure} > {errors**2 * scale} * (a_{measure} + {scale}))"


#: Rows of the quality rules by document, for op3 and for the pipeline's first stage; {docs} is the table.  Thresholds and errors are those of the operator.
QUALITY_CTES = r"""
words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {docs}
), grams AS (
  SELECT doc_id, p, array_to_string(w[p:p + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM words WHERE len(w) >= 5)
), twins AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p + o) AS n_repeat_words FROM twins, range(0, 5) AS t(o) GROUP BY doc_id
), lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), again AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id
), measured AS (
  SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN again USING (doc_id) LEFT JOIN repeated USING (doc_id)
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
), stacked AS (
  SELECT lang, source, m, v, CASE WHEN v < 64 THEN v ELSE 32 * (length(bin(v)) - 6) + (v >> (length(bin(v)) - 6)) END AS b FROM (
    SELECT lang, source, unnest([{measures}]) AS m, unnest([{rates}]) AS v
    FROM based WHERE NOT base_failed)
), bins AS (
  SELECT lang, source, m, b, count(*) AS n FROM stacked GROUP BY ALL
), wide AS (
  SELECT lang, m, b, sum(n)::DOUBLE AS nw FROM bins GROUP BY ALL
), widest AS (
  SELECT *, sum(nw) OVER (PARTITION BY lang, m) AS aw FROM wide
), owners AS (
  SELECT DISTINCT lang, source, m FROM bins
), blend AS (
  SELECT o.lang, o.source, o.m, x.b, coalesce(y.n, 0) * x.aw + {prior} * x.nw AS n
  FROM owners o JOIN widest x ON o.lang IS NOT DISTINCT FROM x.lang AND o.m = x.m
  LEFT JOIN bins y ON y.lang IS NOT DISTINCT FROM o.lang AND y.source IS NOT DISTINCT FROM o.source AND y.m = o.m AND y.b = x.b
), upto AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, m ORDER BY b) AS u, sum(n) OVER (PARTITION BY lang, source, m) AS a, sum(CASE WHEN b = 0 THEN n ELSE 0 END) OVER (PARTITION BY lang, source, m) AS z,
         CASE WHEN b < 64 THEN b ELSE (b - 32 * (b // 32 - 1)) << (b // 32 - 1) END AS low FROM blend
), cuts AS (
  SELECT lang, source, m, min(low) FILTER (WHERE u * 100 >= a * 50) AS mid, min(low) FILTER (WHERE u * 100 >= a * CASE m {levels} END) AS high,
         max((a - z) / a) * coalesce(min(low) FILTER (WHERE b > 0 AND (u - z) * 100 >= (a - z) * 50), 0) AS rare FROM upto GROUP BY ALL
), fences AS (
  SELECT lang, source, {fences} FROM cuts GROUP BY ALL
), over AS (
  SELECT b.*, {excess} FROM based b LEFT JOIN fences f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
), judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce({tests}, false) AS kept FROM over
)
"""
for _token, _text in {
    "{measures}": ", ".join(f"'{m}'" for m in quality.MEASURES),
    "{rates}": ", ".join(f"{c} * {k} // n_words" for c, k in quality.COUNTS.values()),
    "{prior}": str(quality.PRIOR),
    "{levels}": " ".join(f"WHEN '{m}' THEN {p}" for m, (p, _) in quality.FENCES.items()),
    "{fences}": ", ".join(f"{_fence(m)} AS f_{m}" for m in quality.MEASURES),
    "{excess}": ", ".join(f"{c} * {k}.0::DOUBLE - f_{m}::DOUBLE * n_words AS o_{m}, f_{m}::DOUBLE * n_words AS a_{m}" for m, (c, k) in quality.COUNTS.items()),
    "{tests}": " OR ".join(map(_over, quality.MEASURES)),
}.items():
    QUALITY_CTES = QUALITY_CTES.replace(_token, _text)
OP3_SQL = "WITH " + QUALITY_CTES.replace("{docs}", "documents") + "SELECT * FROM judged"


#: DuckDB has SHA-1 in hexadecimal; base32 is made from its bits, five at a time.
OP7_SQL = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(instr('123456789abcdef', substr(h, i, 1))), 4, '0')), '') AS bits FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (16 * (substr(bits, i * 5 + 1, 1) = '1')::INT + 8 * (substr(bits, i * 5 + 2, 1) = '1')::INT + 4 * (substr(bits, i * 5 + 3, 1) = '1')::INT
          + 2 * (substr(bits, i * 5 + 4, 1) = '1')::INT + (substr(bits, i * 5 + 5, 1) = '1')::INT)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id > min(page_id) OVER (PARTITION BY h) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > min(page_id) OVER (PARTITION BY h) THEN min(page_id) OVER (PARTITION BY h) END AS refers_to
FROM b
"""


#: Every kind as (number, pattern, group, least length); positions are sums of the pieces between matches.
OP11_SQL = r"""
WITH kinds AS (
  SELECT * FROM (VALUES (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
    (1, 'access', 'AKIA[A-Z0-9]+', 0, 18), (2, 'hex', '[0-9a-f]+', 0, 16), (3, 'opaque', '[A-Za-z0-9+/_-]+', 0, 20)) AS k(kind, name, pattern, grp, least)
), cut AS (
  SELECT doc_id, source, lang, kind, name, least, regexp_extract_all(t, pattern) AS whole, CASE grp WHEN 2 THEN regexp_extract_all(t, pattern, 2) ELSE regexp_extract_all(t, pattern) END AS vals, string_split_regex(t, pattern) AS gaps
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents), kinds
), numbered AS (
  SELECT doc_id, source, lang, kind, name, least, unnest(range(1, len(whole) + 1)) AS i, unnest(whole) AS m, unnest(vals) AS v, unnest(gaps[1:len(whole)]) AS g FROM cut WHERE len(whole) > 0
), placed AS (
  SELECT *, (sum(length(g) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i))::BIGINT AS til FROM numbered
), found AS (
  SELECT doc_id, source, lang, kind, name, v, til - length(m) AS beg, til AS fin,
         regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(substr(v, 1, 256), ''))) >= 10 AS random
  FROM placed WHERE length(v) >= least
), owned AS (
  SELECT v, count(DISTINCT coalesce(source, '~null')) AS n_owners FROM found GROUP BY v
), judged AS (
  SELECT f.*, random AND n_owners <= 1 AS live, n_owners >= 3 AS copied, min(kind) OVER (PARTITION BY doc_id, f.v) AS lowest FROM found f JOIN owned o ON f.v = o.v
), told AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(name || ':' || beg || ':' || fin, ',' ORDER BY beg, kind) FILTER (WHERE kind < 3) AS base,
         string_agg(name || ':' || beg || ':' || fin, ',' ORDER BY beg, kind) FILTER (WHERE kind < 3 OR (live AND lowest = 3)) AS spans,
         count(DISTINCT v) FILTER (WHERE live) AS n_live, count(DISTINCT v) FILTER (WHERE copied) AS n_copied
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM documents d LEFT JOIN told USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op2_decontaminate": OP2_SQL, "op3_quality_rules": OP3_SQL, "op5_near_dedup": OP5_SQL, "op7_warc": OP7_SQL, "op11_secret_scan": OP11_SQL}
