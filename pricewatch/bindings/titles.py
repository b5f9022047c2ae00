"""Titles, captured pages and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.registry import query
from pricewatch.functions import attributes, classify
from pricewatch.functions.markup import tag_text
from pricewatch.functions.once import computed_once
from pricewatch.operators import cards
from pricewatch.operators.dedup import distinct_texts
from pricewatch.sources.captures import page_prices, page_states

_SPACE = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query("non_tv", """
    SELECT part_no, page, p_size IN (17, 23) AS non_tv FROM {cards}""")
def non_tv(r):
    return r["cards"].select("part_no", "page", classify.is_non_tv(F.col("title")).alias("non_tv"))


@query("title_candidate", r"""
    WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM {documents})
    SELECT doc_id, count(*) AS lines, count(*) FILTER (
        length(line) BETWEEN 8 AND 200
        AND NOT regexp_matches(lower(line), '^(fréquence|frequence|résolution|resolution|consommation|rétroéclair|retroeclair|balayage|luminosité|luminosite|native)')
        AND NOT regexp_matches(line, '^\d[,.]\d/5\s*\(')
        AND regexp_matches(upper(line), '[A-Z]\d|\d[A-Z]')) AS candidates
    FROM lines GROUP BY doc_id""")
def title_candidate(r):
    lines = r["documents"].select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(
        F.count("*").alias("lines"),
        F.count_if(classify.is_title_candidate(F.col("line"))).alias("candidates"),
    )


_LINK_TEXT = """CASE line_no WHEN 0 THEN concat('TV ', brand, ' ', CAST(inches AS STRING), 'QN90F')
    WHEN 1 THEN '4,6/5 (16)' WHEN 2 THEN concat('Fréquence 100Hz ', brand)
    WHEN 3 THEN concat(brand, ' Smart TV QLED ', CAST(inches AS STRING), 'X90 4K Ultra HD Google')
    WHEN 4 THEN 'TV4K' ELSE concat('Big TV ', CAST(inches AS STRING), 'C', CAST(p_size AS STRING), ' ', brand) END"""
_LINK_KEY = "CAST(floor(part_no / 5) AS BIGINT)"


@query("best_title", f"""
    WITH links AS (SELECT {_LINK_KEY} AS link_key, part_no AS pos, line_no, {_LINK_TEXT} AS text FROM {{models}}),
    scored AS (
        SELECT link_key, pos, text,
               CASE line_no WHEN 0 THEN 130 WHEN 3 THEN 0 ELSE 30 END
               + CASE WHEN length(text) BETWEEN 25 AND 100 THEN 20 ELSE 0 END
               + CASE WHEN line_no = 3 AND position('tv' IN lower(substr(text, 1, 10))) > 0 THEN 30 ELSE 0 END AS score
        FROM links WHERE line_no IN (0, 3, 5))
    SELECT link_key, text AS title, CAST(score AS INT) AS score FROM scored
    QUALIFY row_number() OVER (PARTITION BY link_key ORDER BY score DESC, pos) = 1""")
def best_title(r):
    named = computed_once(r["models"], {"text": F.expr(_LINK_TEXT)})
    links = named.selectExpr(f"{_LINK_KEY} AS link_key", "part_no AS pos", "text")
    return cards.best_titles(links, "link_key")


@query("text_dedup", rf"""
    WITH normal AS (
        SELECT doc_id, n_chars, lower(trim(regexp_replace(text, '{_SPACE}+', ' ', 'g'))) AS normal_text FROM {{documents}})
    SELECT min(doc_id) AS doc_id, arg_min(n_chars, doc_id) AS n_chars
    FROM normal WHERE normal_text <> '' GROUP BY normal_text""")
def text_dedup(r):
    return distinct_texts(r["documents"], "text", ["doc_id"], keep=["n_chars"])


@query("line_dedup", rf"""
    WITH normal AS (
        SELECT doc_id, lower(trim(regexp_replace(unnest(string_split(text, chr(10))), '{_SPACE}+', ' ', 'g'))) AS line
        FROM {{documents}}),
    firsts AS (SELECT line, min(doc_id) AS doc_id FROM normal WHERE line <> '' GROUP BY line)
    SELECT doc_id, count(*) AS first_lines FROM firsts GROUP BY doc_id""")
def line_dedup(r):
    lines = r["documents"].select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return distinct_texts(lines, "line", ["doc_id", "pos"], keep=[]).groupBy("doc_id").agg(
        F.count("*").alias("first_lines")
    )


# --- captured pages ----------------------------------------------------------------

_TITLE = """CASE page_id % 9 WHEN 2 THEN 'Oups, page' WHEN 3 THEN 'Artikel derzeit nicht lieferbar'
    WHEN 4 THEN 'This item is Out of Stock' WHEN 5 THEN 'Siden finnes ikke' WHEN 6 THEN 'Page Not Found'
    WHEN 7 THEN 'Just a moment...' ELSE {0} END"""


def _captures(r):
    """Captured pages with their own titles, except those that show a marker title."""
    own = r["captures"].withColumn("own_title", tag_text(F.col("html"), "title"))
    return own.selectExpr("*", f"{_TITLE.format('own_title')} AS page_title")


@query("dead_page", """
    SELECT page_id, platform,
           CASE page_id % 9 WHEN 2 THEN platform = 'Boulanger' WHEN 3 THEN platform = 'Amazon'
                WHEN 4 THEN platform IN ('Currys', 'Amazon') WHEN 5 THEN platform = 'Elkjop'
                WHEN 6 THEN true ELSE false END AS dead_page
    FROM {captures}""")
def dead_page(r):
    return page_states(_captures(r)).select("page_id", "platform", "dead_page")


@query("unavailable_response", """
    SELECT page_id, http_status IN (404, 410) OR (platform = 'Currys' AND page_id % 7 IN (1, 2)) AS unavailable
    FROM {captures}""")
def unavailable_response(r):
    return page_states(_captures(r)).select("page_id", "unavailable")


@query("challenge_page", """
    SELECT platform, count(*) AS pages, count(*) FILTER (page_id % 9 = 7) AS blocked,
           count(*) FILTER (page_id % 9 <> 7) AS priced
    FROM {captures} GROUP BY platform""")
def challenge_page(r):
    marked = _captures(r).withColumn(
        "html", F.concat(F.lit('<meta itemprop="price" content="499">'), F.col("html"))
    )
    return page_states(page_prices(marked)).groupBy("platform").agg(
        F.count("*").alias("pages"),
        F.count_if("blocked").alias("blocked"),
        F.count("page_price").alias("priced"),
    )


@query("page_titles", r"""
    SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM {pages}""")
def page_titles(r):
    return r["pages"].select("page_id", tag_text(F.col("html"), "title").alias("title"))
