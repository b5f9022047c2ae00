"""The corpus operators over the given tables, with the digests that make results comparable."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.llm import divergence, html_text, licenses, lm, mixing, near_vectors, neighbours, packing, prefix_trie, quality, secret_scans, simhash, url_filters
from pricewatch.llm.columns import read
from pricewatch.session import written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op1_neighbours")
def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).drop("row")


@query("op3_lm_scoring")
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), TOKENIZER)


@query("op5_license_scans")
def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(read(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


#: Events are the list's dated changes about the page of their user's number; pages are fetched through January.
_URL_SQL = r"""
WITH place AS (
  SELECT page_id, url,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts,
         TIMESTAMP '2024-01-01' + to_minutes((page_id * 1237) % 43200) AS fetched_at
  FROM pages
), entry AS (
  SELECT CASE WHEN event_type IN ('error', 'purchase') THEN host ELSE host || '/' || parts[1] END AS key, ts AS listed_at,
         max(CASE event_type WHEN 'error' THEN 'block' WHEN 'click' THEN 'block' WHEN 'signup' THEN 'allow' ELSE 'remove' END) AS action
  FROM events JOIN place ON page_id = user_id WHERE len(parts) > 0 GROUP BY 1, 2
), span AS (
  SELECT key, action, listed_at AS active_from, lead(listed_at) OVER (PARTITION BY key ORDER BY listed_at) AS active_until FROM entry
), label AS (
  SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels FROM place
), looked AS (
  SELECT page_id, fetched_at, unnest(range(1, len(labels) + 1)) AS depth,
         unnest(list_transform(range(1, len(labels) + 1), lambda n: array_to_string(labels[len(labels) - n + 1:], '.'))) AS key FROM label
  UNION ALL
  SELECT page_id, fetched_at, len(labels) + unnest(range(1, len(parts) + 1)),
         unnest(list_transform(range(1, len(parts) + 1), lambda n: host || '/' || array_to_string(parts[:n], '/'))) FROM label
), best AS (
  SELECT page_id, arg_max(struct_pack(k := l.key, a := s.action, f := s.active_from, u := s.active_until), depth) AS b
  FROM looked l JOIN span s ON l.key = s.key AND s.active_from <= fetched_at AND (s.active_until IS NULL OR fetched_at < s.active_until)
  WHERE s.action <> 'remove' GROUP BY page_id
)
SELECT page_id, url, fetched_at, b.k AS entry, b.a AS action, b.f AS active_from, b.u AS active_until,
       coalesce(b.a = 'block', false) AS blocked
FROM place LEFT JOIN best USING (page_id)
"""


@query("op7_url_filters", _URL_SQL)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    pages = read(spark, sf_dir, "pages").select(
        "page_id", "url", F.expr("timestamp_micros(1704067200000000 + (page_id * 1237) % 43200 * 60000000)").alias("fetched_at")
    )
    part = F.get(F.filter(F.split(url_filters.path(url), "/"), lambda x: x != ""), F.lit(0))
    places = pages.select("page_id", url_filters.host(url).alias("host"), part.alias("part")).where("part IS NOT NULL")
    action = F.expr("CASE WHEN event_type IN ('error', 'click') THEN 'block' WHEN event_type = 'signup' THEN 'allow' ELSE 'remove' END")
    whole = F.col("event_type").isin("error", "purchase")
    entries = (
        read(spark, sf_dir, "events")
        .join(places, F.col("page_id") == F.col("user_id"))
        .select(
            F.when(whole, F.col("host")).otherwise(F.concat_ws("/", "host", "part")).alias("key"),
            F.col("ts").cast("timestamp").alias("listed_at"),
            action.alias("action"),
        )
    )
    return url_filters.judged(pages, entries)


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(read(spark, sf_dir, "pages"))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(quality.measured(read(spark, sf_dir, "documents"), "doc_id"), "measures")
    rules = quality.learn(rows, read(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id", *quality.MEASURES, quality.base_failed().alias("base_failed"), quality.verdict(rules).alias("kept")
    )


@query("op10_secret_scans")
def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")

    def of_kind(kind: int):
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")

    return secret_scans.scan(read(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(secret_scans.listed(F.filter(found, lambda s: s["kind"] <= 2)), 256).alias("base_sha256"),
        secret_scans.listed(found).alias("spans"),
    )


_DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms,
         row_number() OVER () AS row
  FROM documents
), word AS (
  SELECT row, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term FROM word GROUP BY 1, 2 HAVING count(DISTINCT row) >= 10
), size AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY 1
), cell AS (
  SELECT lang, source, term, count(*) AS c FROM word JOIN kept USING (lang, term) GROUP BY 1, 2, 3
), grp AS (
  SELECT d.lang, d.source, coalesce(any_value(t.n), 0) AS n, coalesce(any_value(v), 0) AS v
  FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN size USING (lang)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM cell GROUP BY 1, 2) t ON t.lang = d.lang AND t.source = d.source GROUP BY 1, 2
), share AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
         1 + CAST(1000000000::HUGEINT * (coalesce(c, 0) + 2) // (n + 2 * v) AS BIGINT) AS p
  FROM grp g JOIN kept k USING (lang) LEFT JOIN cell x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
), whole AS (
  SELECT lang, term, 1 + CAST(1000000000::HUGEINT * (sum(c) + 2) // (any_value(n) + 2 * any_value(v)) AS BIGINT) AS q
  FROM cell JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM grp GROUP BY 1) USING (lang) GROUP BY 1, 2
), pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source AS one, y.source AS two, CAST(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS BIGINT) AS value
    FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3
  ) s ON s.lang = a.lang AND s.one = a.source AND s.two = b.source
), term AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM share JOIN whole USING (lang, term) WHERE c > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR rank <= 10
"""


@query("op12_divergence", _DIVERGENCE_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


@query("op13_near_vectors")
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.grouped(read(spark, sf_dir, "embeddings"))


#: The checksum of a decimal number is taken bit by bit; a key holds 32 digits for each turn.
_TRIE_SQL = r"""
WITH turn AS (
  SELECT conv_id AS c, md5(coalesce(role, '') || chr(0) || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT c, c - c % 20 AS donor,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda h, b: list_reduce(list_prepend(xor(h, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
             lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turn)
), part AS (
  SELECT conv.c, 0 AS own, t.i, t.k, t.w FROM conv JOIN turn t ON t.c = conv.donor AND t.i <= h
  UNION ALL
  SELECT conv.c, 1, t.i, t.k, t.w FROM conv JOIN turn t ON t.c = conv.c AND t.i > h
), prefix AS (
  SELECT c, row_number() OVER o AS depth, string_agg(k, '') OVER o AS key, w FROM part
  WINDOW o AS (PARTITION BY c ORDER BY own, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL
  SELECT c, 0, '', 0 FROM conv
), node AS (
  SELECT depth, key, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM prefix GROUP BY 1, 2
), last AS (
  SELECT c, arg_max(key, depth) AS key FROM prefix GROUP BY 1
), ending AS (
  SELECT key, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS d FROM last GROUP BY 1
), child AS (
  SELECT left(key, (depth - 1) * 32) AS key, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT left(n.key, d * 32) AS key, CAST(count(*) FILTER (ch.n IS NULL) AS BIGINT) AS n_leaves, CAST(sum((n_convs - 1) * w) AS BIGINT) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM node) n LEFT JOIN child ch ON ch.key = n.key GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n, 0) AS n_children, b.n_leaves,
       b.saved AS saved_tokens, coalesce(e.d, sha256('')) AS ends_sha256
FROM node n LEFT JOIN node p ON n.depth > 0 AND p.key = left(n.key, (n.depth - 1) * 32) AND p.depth = n.depth - 1
LEFT JOIN child ch ON ch.key = n.key LEFT JOIN below b ON b.key = n.key LEFT JOIN ending e ON e.key = n.key
"""


@query("op11_prefix_trie", _TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))
