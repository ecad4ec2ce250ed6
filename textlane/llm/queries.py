"""Registered queries of the training-data operators, over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlane.llm import (decontaminate, divergence, filter_audit, jaccard_join, licenses, line_dedup, mixing, quality_lines,
                          sharding, style_tree, url_rules, va_search, warc)

#: (host, path, verdict) of the url rules.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-modified revisits of all pages, resolved."""
    records = warc.records_of_pages(table(spark, sf_dir, "pages"))
    out = warc.resolve_revisits(records)
    return out.select("record_id", "canonical", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("ts"), "origin_id", "status",
                      F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws(
                          "=", e["key"], e["value"]))), ";").alias("headers"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class, copies and number of links of all documents."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality metrics and verdicts of all documents; the host is the document's source."""
    return quality_lines.judge(table(spark, sf_dir, "documents")).drop("text_in_host")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents dropped from all documents."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all pages' urls."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 5 : 2 : 1 mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best window of every document and benchmark item that match."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op8_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return style_tree.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of all documents: an own notice, that of the nearest ancestor directory, or none."""
    files = licenses.files_of_documents(table(spark, sf_dir, "documents"))
    out = licenses.scan(files)
    return out.select(F.substring_index("path", "/", -1).cast("bigint").alias("doc_id"), "path", "license", "score", "origin",
                      "inherited_from")


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of near equal bytes."""
    out = sharding.shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents: removals of every step of every order, by source."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_va_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every 50th vector with all others."""
    return va_search.top_k(table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of all sources from each other and from their language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_revisits, op2_jaccard_join, op3_line_frequency, op4_line_dedup, op5_url_rules, op6_mix,
                                  op7_decontaminate, op8_style_tree, op9_licenses, op10_byte_shards, op11_filter_audit,
                                  op12_va_search, op13_divergence)}

# --- SQL --------------------------------------------------------------------------------------------------------------

#: DuckDB's white space class of this module and its trimming characters.
_WS = r"\x20\x09-\x0D"
_TRIM = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_KEY = f"translate(trim(l, {_TRIM}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP4 = f"""
WITH l AS (
  SELECT doc_id, pos, lines[pos] AS l FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, unnest(generate_series(1, len(lines))) AS pos FROM documents)),
k AS (SELECT doc_id, pos, l, {_KEY} AS k FROM l),
bad AS (SELECT k FROM k WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM bad)) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (k NOT IN (SELECT k FROM bad)), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""

_OP5 = f"""
WITH p AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, {_ASCII_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(h, pre, v) AS (VALUES {", ".join(str(x) for x in URL_RULES)}),
m AS (SELECT page_id, host, path, h || pre AS rule, v,
             row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || pre) DESC NULLS LAST) AS n
      FROM u LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE n = 1
"""

_OP3 = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^{_WS}]+') AS ws, string_split(text, chr(10)) AS ls FROM t),
line AS (SELECT doc_id, source, text, unnest(ls) AS l FROM w),
keyed AS (SELECT doc_id, source, text, l, {_KEY} AS k FROM line),
dup AS (SELECT doc_id, sum(n - 1) AS n_dup_lines FROM (
          SELECT doc_id, l, count(*) AS n FROM keyed WHERE k <> '' GROUP BY ALL) GROUP BY doc_id),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (
          SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words FROM rep, generate_series(0, 7) AS s(d) GROUP BY doc_id),
bad AS (SELECT source, k FROM keyed WHERE k <> '' GROUP BY ALL HAVING count(DISTINCT text) >= {quality_lines.MIN_LINE_DOCS}),
gone AS (SELECT doc_id, sum(len(regexp_extract_all(k, '[^{_WS}]+'))) AS removed FROM keyed
         JOIN bad USING (source, k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed, 0)::BIGINT AS removed_words
      FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words - removed_words >= {quality_lines.MIN_LEFT_SHARE} * n_words AS kept, removed_words FROM b
"""

_MIX_HASH = f"md5('{mixing.SEED}|' || doc_id::VARCHAR || '|' || md5(coalesce(text, '')))"
# Every quotient is listed here, up to more seats than any claimant can win.
_OP6 = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^{_WS}]+')) AS size, {_MIX_HASH} AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INT] AS w, 3 * s AS cap FROM s),
lv AS (SELECT *, max(level) OVER () AS top FROM (
  SELECT *, (sum(s) OVER () - coalesce(sum(cap) OVER f, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER f, 0))::DOUBLE AS level FROM w
  WINDOW f AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
t AS (SELECT source, rank, s, least(cap::DOUBLE, w * top) AS target, round(sum(s) OVER () / {mixing.BLOCK_TOKENS}.0)::BIGINT AS blocks FROM lv),
q AS (SELECT source, rank, target / (2 * k + 1) AS q, blocks, k FROM (
  SELECT *, unnest(generate_series(0, (target / {mixing.BLOCK_TOKENS})::BIGINT + 40)) AS k FROM t WHERE target > 0)),
won AS (SELECT rank, count(*) AS seats FROM (
  SELECT *, row_number() OVER (ORDER BY q DESC, rank, k) AS n FROM q) WHERE n <= blocks GROUP BY rank),
p AS (SELECT rank, substr(h, 1, 1) AS part, sum(size)::BIGINT AS ps FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
pq AS (SELECT rank, part, seats, ps / (2 * k + 1) AS q, k FROM (
  SELECT p.*, seats, unnest(generate_series(0, seats)) AS k FROM p JOIN won USING (rank) WHERE ps > 0)),
pw AS (SELECT rank, part, count(*) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY rank ORDER BY q DESC, part, k) AS r FROM pq) WHERE r <= seats GROUP BY ALL),
pp AS (SELECT rank, part, ps, least(coalesce(n, 0) * {mixing.BLOCK_TOKENS}, 3 * ps) AS quota FROM p LEFT JOIN pw USING (rank, part)),
o AS (SELECT d.doc_id, d.size, t.s AS source_size, t.target, ps, quota,
             coalesce(sum(d.size) OVER (PARTITION BY t.rank, part ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN pp ON pp.rank = t.rank AND pp.part = substr(h, 1, 1))
SELECT doc_id, size, source_size, target, CASE WHEN ps = 0 THEN 0 ELSE
       (quota // ps) * size + greatest(0, least(size, quota % ps - start)) END::BIGINT AS taken FROM o
"""

# DuckDB has no CRC-32: the check sum is worked out bit by bit over the bytes of each text (of the reflected polynomial).
_OP10 = f"""
WITH RECURSIVE poly(i, v) AS (
  SELECT b.i, b.i FROM generate_series(0, 255) AS b(i)),
steps(i, v, n) AS (
  SELECT i, v, 0 FROM poly
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, n + 1 FROM steps WHERE n < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM steps WHERE n = 8),
d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size,
             md5(coalesce(text, '')) AS h, md5('|' || coalesce(doc_id::VARCHAR, '')) AS dh FROM documents),
crc AS (SELECT h, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
             generate_series(1, strlen(text)), lambda i: ('0x' || substr(hex, (2 * i - 1)::INT, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c & 255, b) + 1)::INT])), 4294967295::BIGINT) AS text_crc32
        FROM (SELECT h, any_value(text) AS text, hex(any_value(text)) AS hex FROM d GROUP BY h), tab),
g AS (SELECT h, count(*) AS n, sum(size)::BIGINT AS b FROM d GROUP BY h),
gp AS (SELECT *, coalesce(sum(b) OVER f, 0)::BIGINT AS b0, sum(b) OVER ()::BIGINT AS total, (SELECT max(size) FROM d) AS largest FROM g
       WINDOW f AS (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT d.*, b, b0, total, b <= greatest(largest, total // {sharding.SHARDS * 100}) AS whole,
             row_number() OVER (PARTITION BY d.h ORDER BY dh, doc_id) - 1 AS k,
             row_number() OVER (ORDER BY d.h, dh, doc_id) AS pos FROM d JOIN gp ON d.h = gp.h),
c AS (SELECT *, least((CASE WHEN whole THEN 2 * b0 + b ELSE 2 * (b0 + k * size) + size END * {sharding.SHARDS}) // (2 * total),
                      {sharding.SHARDS - 1})::INT AS shard FROM r)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, pos - min(pos) OVER (PARTITION BY shard) AS slot, NULL::INT AS grown_shard
FROM c JOIN crc USING (h)
"""

_CANON = """
SELECT *, host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical FROM (
  SELECT *, regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\\.', '') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\\?(.*)$', 1), '&'),
           lambda a: a <> '' AND NOT regexp_full_match(a, '(utm_[^=&]*|ref|gclid|fbclid)(=[^&]*)?'))), '&') AS q
  FROM (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[^:/?]*://', '') AS rest, md5(coalesce(html, '')) AS dg,
               TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * page_id AS seen FROM pages))
"""
_OP1 = f"""
WITH p AS ({_CANON}),
full_r AS (SELECT page_id * 2 AS id, canonical, seen AS ts, CASE WHEN dg[1] BETWEEN '0' AND '9' THEN dg END AS tag,
                  strftime(seen, '%Y-%m-%d') AS d FROM p),
rev AS (SELECT page_id * 2 + 1 AS id, canonical, seen + INTERVAL 1 DAY AS ts, CASE WHEN dg[1] BETWEEN '0' AND '9' THEN dg END AS tag,
               CASE WHEN dg[32] BETWEEN '0' AND '9' THEN strftime(seen, '%Y-%m-%d') END AS d FROM p),
j AS (SELECT r.id, r.canonical, r.ts, r.tag, r.d, max_by(struct_pack(id := f.id, tag := f.tag, d := f.d), (f.ts, f.id)) AS f
      FROM rev r LEFT JOIN full_r f ON r.canonical = f.canonical AND f.ts < r.ts GROUP BY ALL),
s AS (SELECT *, CASE WHEN f.id IS NULL THEN 'no-origin'
        WHEN tag IS NOT NULL AND f.tag IS NOT NULL THEN CASE WHEN tag = f.tag THEN 'etag' ELSE 'mismatch' END
        WHEN d IS NOT NULL AND f.d IS NOT NULL THEN CASE WHEN d = f.d THEN 'last-modified' ELSE 'mismatch' END
        ELSE 'unchecked' END AS status FROM j)
SELECT id AS record_id, canonical, strftime(ts, '%Y-%m-%d %H:%M') AS ts, f.id AS origin_id, status,
  CASE WHEN status IN ('mismatch', 'no-origin') THEN concat_ws(';', 'content-type=message/http', 'etag=W/"' || tag || '"',
              'last-modified=' || d, 'server=b')
       ELSE concat_ws(';', 'content-type=text/html', coalesce('etag=W/"' || tag || '"', 'etag="' || f.tag || '"'),
              'last-modified=' || coalesce(d, f.d), 'server=b') END AS headers
FROM s
"""

_SEP = licenses.SEPARATOR
_TEMPLATES = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(licenses.TEMPLATES))
_FALLBACK = ", ".join(f"'{x}'" for x in licenses.FALLBACK)
_OP9 = f"""
WITH f AS (
  SELECT doc_id, coalesce(text, '') AS text,
    len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(x) <= 100 AND regexp_matches(lower(x), 'licen[sc]e|rights reserved'))) > 0 AS is_lic,
    coalesce(source, '_') || '/' || coalesce(lang, '_') || '/' || (doc_id // 1000) AS top FROM documents),
p AS (SELECT *, top || CASE WHEN is_lic THEN '' ELSE '/' || (doc_id // 100) END AS dir FROM f),
tpl AS (SELECT * FROM (SELECT k, license, unnest(string_split_regex(lower(txt), '{_SEP}')) AS term FROM (VALUES {_TEMPLATES}) AS t(k, license, txt)) WHERE term <> ''),
voc AS (SELECT DISTINCT term FROM tpl),
doc_terms AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(text), '{_SEP}')) AS term FROM p),
df AS (SELECT term, count(doc_id) AS df FROM voc LEFT JOIN doc_terms USING (term) GROUP BY term),
n AS (SELECT count(*) AS n FROM p),
idf AS (SELECT term, ln((n + 1) / (df + 1)) + 1 AS w FROM df, n),
tv AS (SELECT k, license, term, (1 + ln(count(*))) * any_value(w) AS x FROM tpl JOIN idf USING (term) GROUP BY ALL),
tu AS (SELECT k, license, term, x / sqrt(sum(x * x) OVER (PARTITION BY k)) AS x FROM tv),
ln AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM p),
hd AS (SELECT *, list_position(list_transform(l, lambda x: NOT regexp_matches(x, '{licenses.COMMENT}')), true) AS e FROM ln),
un AS (SELECT doc_id, text AS s FROM p
  UNION ALL SELECT doc_id, array_to_string(CASE WHEN coalesce(e, 0) = 0 THEN l ELSE l[1:e - 1] END, chr(10)) FROM hd
  UNION ALL SELECT doc_id, unnest(string_split_regex(text, '{licenses.BLOCK_END}')) FROM p
  UNION ALL SELECT doc_id, unnest(string_split(regexp_replace(text, '[.;!?]([[:space:]]|$)', chr(10) || ' ', 'g'), chr(10))) FROM p),
st AS (SELECT doc_id, row_number() OVER () AS sid, list_filter(string_split_regex(lower(s), '{_SEP}'), lambda x: x <> '') AS terms FROM un),
bag AS (SELECT doc_id, sid, term, count(*) AS tf FROM (SELECT doc_id, sid, unnest(terms) AS term FROM st) GROUP BY ALL),
wb AS (SELECT bag.*, (1 + ln(tf)) * coalesce(w, (SELECT ln((n + 1) / 2) + 1 FROM n)) AS w FROM bag LEFT JOIN idf USING (term)),
nrm AS (SELECT sid, sqrt(sum(w * w)) AS len FROM wb GROUP BY sid),
sc AS (SELECT doc_id, sid, license, round(sum(w * x) / any_value(len), 9) AS score
       FROM wb JOIN tu USING (term) JOIN nrm USING (sid) GROUP BY doc_id, sid, k, license),
own AS (SELECT doc_id, license, score, license IN ({_FALLBACK}) AS last FROM sc WHERE score >= {licenses.THRESHOLD}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY last, score DESC, license) = 1),
given AS (SELECT dir, license, score FROM p JOIN own USING (doc_id) WHERE is_lic
          QUALIFY row_number() OVER (PARTITION BY dir ORDER BY last, score DESC, license) = 1)
SELECT p.doc_id, p.dir || '/' || p.doc_id AS path, coalesce(own.license, given.license) AS license, coalesce(own.score, given.score) AS score,
       CASE WHEN own.license IS NOT NULL THEN 'notice' WHEN given.license IS NOT NULL THEN 'directory' ELSE 'none' END AS origin,
       CASE WHEN own.license IS NULL THEN given.dir END AS inherited_from
FROM p LEFT JOIN own USING (doc_id) LEFT JOIN given ON given.dir = p.top
"""

_OP11 = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^{_WS}]+') AS ws FROM documents),
least AS (SELECT text, min(doc_id) AS first_id FROM d GROUP BY text),
good AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT
             + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
             + 16 * coalesce(first_id < d.doc_id, false)::INT AS bits, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM d JOIN least USING (text) LEFT JOIN good USING (doc_id)),
c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l(x, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE a.b + b.b + c.b + d.b + e.b = 31
        AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
s AS (SELECT filter_order, step, l.b AS bit, (SELECT coalesce(sum(y.b), 0) FROM l y WHERE contains(substr(filter_order, 1, step::INT - 1), y.x)) AS before
      FROM o, generate_series(1, 5) AS g(step), l WHERE l.x = substr(filter_order, step::INT, 1)),
r AS (SELECT part, filter_order, step::INT AS step, bit,
             coalesce(sum(n) FILTER (bits::INT & (before + bit)::INT = 0), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (bits::INT & bit <> 0 AND bits::INT & before::INT = 0), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (bits::INT & bit <> 0 AND bits::INT & before::INT <> 0), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (bits = bit), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (bits::INT & bit <> 0 AND bits::INT & before::INT = 0), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (bits::INT & bit <> 0 AND bits::INT & before::INT = 0), 0)::BIGINT AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM r
"""

_OP12 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
QUALIFY rank <= 5
"""

_OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  {_ASCII_LOWER.format("coalesce(text, '')")} AS text FROM documents),
occ AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
tc AS (SELECT r, lang, source, term, count(*) AS n FROM occ GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::BIGINT AS total FROM tc GROUP BY ALL HAVING count(*) >= {divergence.MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, sum(n)::BIGINT AS n FROM tc GROUP BY ALL),
c AS (SELECT g.lang, g.source, k.term, k.total, coalesce(own.n, 0) AS n
      FROM g JOIN kept k USING (lang) LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = k.term),
s AS (SELECT *, sum(n) OVER w AS gn, count(*) OVER w AS v, sum(total) OVER w AS ln FROM c WINDOW w AS (PARTITION BY lang, source)),
p AS (SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 2)) // (gn + 2 * v))::BIGINT AS p,
             (1 + (1000000000::HUGEINT * (total + 2)) // (ln + 2 * v))::BIGINT AS q FROM s),
ab AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
          LEFT JOIN ab ON ab.lang = g.lang AND ab.source = g.source AND ab.item = h.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""

ORACLE = {"op9_licenses": _OP9, "op1_revisits": _OP1, "op3_line_frequency": _OP3, "op4_line_dedup": _OP4, "op5_url_rules": _OP5, "op6_mix": _OP6,
          "op10_byte_shards": _OP10, "op11_filter_audit": _OP11, "op12_va_search": _OP12, "op13_divergence": _OP13}
