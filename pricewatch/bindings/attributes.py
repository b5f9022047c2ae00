"""Brand, size, year, series and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewatch.bindings.registry import query
from pricewatch.functions import attributes as at
from pricewatch.functions.once import computed_once
from pricewatch.functions.classify import is_family_2026, is_variant_candidate


@query("brand_detect", """
    SELECT part_no, brand_raw AS by_substring, brand_raw AS by_word, brand_raw AS by_slug,
           CASE WHEN brand_raw = 'Philips' THEN 'iFFALCON' ELSE brand_raw END AS source_brand,
           CASE WHEN brand_raw = 'Philips' THEN 'TCL' ELSE brand_raw END AS business_brand
    FROM {items}""")
def brand_detect(r):
    title = F.col("raw_text")
    texts = computed_once(
        r["items"].select("part_no", "raw_text"),
        {
            "raw_text": title,
            "falcon": F.regexp_replace(title, "Philips", "iFFalcon"),
            "slug": F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"),
        },
    )
    falcon, slug = F.col("falcon"), F.col("slug")
    return texts.select(
        "part_no",
        at.brand_by_substring(title).alias("by_substring"),
        at.brand_by_word(title).alias("by_word"),
        at.brand_of_slug(slug).alias("by_slug"),
        at.source_brand_elkjop(falcon).alias("source_brand"),
        at.brand_elkjop(falcon).alias("business_brand"),
    )


_SIZE_TEXT = """CASE part_no % 5 WHEN 0 THEN concat('TV ', CAST(inches AS STRING), ' pouces')
    WHEN 1 THEN concat('TV ', CAST(inches AS STRING), '" QLED') WHEN 2 THEN concat('TV 999 pouces ', CAST(inches AS STRING), '"')
    WHEN 3 THEN concat('TV ', CAST(CAST(round(inches * 2.54) AS INT) AS STRING), ' cm') ELSE 'TV 16 pouces' END"""


@query("size_detect", """
    SELECT part_no, CASE WHEN part_no % 5 = 4 THEN NULL ELSE size_hint_inch END AS french,
           size_hint_inch AS slug_size, size_hint_inch AS amazon, size_hint_inch AS norwegian
    FROM {items}""")
def size_detect(r):
    rows = r["items"].selectExpr("*", f"{_SIZE_TEXT} AS size_text")
    inches = F.col("inches").cast("string")
    return rows.select(
        "part_no",
        at.size_boulanger(F.col("size_text")).alias("french"),
        at.size_currys(
            F.concat(F.lit("tv-2025-150-"), inches, F.lit("-qe55-10283600")), F.lit("")
        ).alias("slug_size"),
        at.size_amazon(F.concat(F.lit("TV "), inches, F.lit("- Zoll"))).alias("amazon"),
        at.size_elkjop(F.concat(F.lit("TV 1234567\" "), inches, F.lit(" tommer"))).alias("norwegian"),
    )


@query("year_detect", """
    SELECT part_no, CASE WHEN p_size % 5 = 0 THEN 2026 ELSE 2025 END AS model_year FROM {items}""")
def year_detect(r):
    return r["items"].select("part_no", at.model_year(F.col("raw_text"), F.lit(2025)).alias("model_year"))


@query("series_detect", "SELECT part_no, brand_raw, expected_series AS series FROM {items}")
def series_detect(r):
    series = at.series_of(F.col("brand_raw"), F.col("raw_text"))
    return r["items"].select("part_no", "brand_raw", series.alias("series"))


@query("series_detect_sku", "SELECT part_no, CASE brand_raw WHEN 'Samsung' THEN 'S90F' WHEN 'LG' THEN 'G5' WHEN 'TCL' THEN 'P7K' WHEN 'Hisense' THEN 'E7S' WHEN 'Sony' THEN 'XR70' ELSE '' END AS series FROM {items}")
def series_detect_sku(r):
    """Series inside model numbers, where the size runs into the code."""
    size = F.col("inches").cast("string")
    code = (
        F.when(F.col("brand_raw") == "Samsung", F.concat(F.lit("On the wall: TQ"), size, F.lit("S90FAEXXC")))
        .when(F.col("brand_raw") == "LG", F.concat(F.lit("Offer OLED"), size, F.lit("G5XYZ")))
        .when(F.col("brand_raw") == "TCL", F.concat(F.lit("Kitchen set "), size, F.lit("P7K")))
        .when(F.col("brand_raw") == "Hisense", F.concat(F.lit("Television "), size, F.lit("E7S black")))
        .otherwise(F.concat(F.lit("Screen XR70 "), size))
    )
    return r["items"].select("part_no", at.series_of(F.col("brand_raw"), code).alias("series"))


@query("slug_title", """
    SELECT part_no, concat('samsung 65 ', replace(p_name, '_', ' ')) AS title
    FROM (SELECT p_partkey AS part_no, p_name FROM {part})""")
def slug_title(r):
    slug = F.concat(
        F.lit("samsung-65--"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-102-"),
        (F.col("p_partkey") + 10000000).cast("string"),
    )
    return r["part"].select(F.col("p_partkey").alias("part_no"), at.slug_title(slug).alias("title"))


@query("range_text", """
    SELECT part_no, CAST(48 * (part_no % 7) + 1 AS INT) AS first_item, CAST(48 * (part_no % 7) + 48 AS INT) AS last_item,
           CAST(400 + part_no AS INT) AS total_items, CAST(ceil((400 + part_no) / 48) AS INT) AS pages
    FROM {items}""")
def range_text(r):
    n = F.col("part_no") % 7 * 48
    text = F.concat(
        (n + 1).cast("string"), F.lit(" – "), (n + 48).cast("string"), F.lit(" av "),
        (F.col("part_no") + 400).cast("string"), F.lit(" Produkter i TV"),
    )
    return r["items"].select("part_no", at.listing_range(text).alias("r")).select(
        "part_no",
        F.col("r.first").alias("first_item"),
        F.col("r.last").alias("last_item"),
        F.col("r.total").alias("total_items"),
        at.page_count(F.col("r.total"), 48).alias("pages"),
    )


@query("raw_text_concat", """
    SELECT p_partkey AS part_no, concat(p_name, CASE WHEN p_type = 'PROMO' THEN '' ELSE concat(' ', p_type) END, ' ', p_brand) AS raw_text
    FROM {part}""")
def raw_text_concat(r):
    kind = F.when(F.col("p_type") == "PROMO", " ").otherwise(F.col("p_type"))
    text = at.distinct_parts(F.col("p_name"), kind, F.concat(F.lit(" "), F.col("p_name")), F.col("p_brand"))
    return r["part"].select(F.col("p_partkey").alias("part_no"), text.alias("raw_text"))


@query("attribute_first", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
           CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS kind
    FROM {events}""")
def attribute_first(r):
    """A map of list and plain attributes built from the event properties."""
    k = F.get_json_object("props", "$.k")
    bag = F.create_map(
        F.lit("k"), F.when(F.col("event_id") % 2 == 0, k).otherwise(F.to_json(F.array(k, F.lit("0")))),
        F.lit("kind"), F.when(F.col("event_type") == "view", "[]").otherwise(F.to_json(F.array("event_type"))),
    )
    return r["events"].select("event_id", bag.alias("bag")).select(
        "event_id",
        at.to_number(at.attribute_first(F.col("bag"), "k")).alias("k"),
        at.attribute_first(F.col("bag"), "kind").alias("kind"),
    )


@query("title_brand_prefix", """
    SELECT part_no, CASE WHEN p_size % 2 = 0 THEN raw_text
        WHEN part_no % 3 = 0 THEN substr(raw_text, length(brand_raw) + 2) ELSE raw_text END AS title
    FROM {items}""")
def title_brand_prefix(r):
    """The brand goes in front of titles that lack it; blank brands change nothing."""
    has_brand = (F.col("p_size") % 2) == 0
    bare = F.expr("substr(raw_text, length(brand_raw) + 2)")
    title = F.when(has_brand, F.col("raw_text")).otherwise(bare)
    brand = F.when(~has_brand & (F.col("part_no") % 3 == 0), " ").otherwise(F.upper("brand_raw"))
    own = at.title_with_brand(title, F.when(brand == " ", brand).otherwise(F.col("brand_raw")))
    return r["items"].select("part_no", own.alias("title"))


@query("variant_candidate", """
    SELECT part_no, p_size % 4 = 0 OR p_size % 5 = 0
        OR expected_series IN ('S95H', 'QN90F', 'U8000F', 'Q7F', 'QNED85A', 'C8L', 'C6KPRO', 'P7K', 'X11L') AS candidate
    FROM {items}""")
def variant_candidate(r):
    candidate = is_variant_candidate(F.col("raw_text"), F.col("variant_hint"))
    return r["items"].select("part_no", candidate.alias("candidate"))


@query("family_2026", """
    SELECT part_no, p_size % 5 = 0 OR (brand_raw = 'Samsung' AND expected_series LIKE '%H')
        OR (brand_raw = 'TCL' AND expected_series LIKE '%L')
        OR (brand_raw = 'LG' AND (expected_series LIKE '%6' OR expected_series LIKE '%B'))
        OR (brand_raw = 'Hisense' AND expected_series LIKE '%S') AS is_2026
    FROM {items}""")
def family_2026(r):
    series = at.series_of(F.col("brand_raw"), F.col("raw_text"))
    return r["items"].select(
        "part_no", is_family_2026(F.col("brand_raw"), series, F.col("raw_text")).alias("is_2026")
    )
