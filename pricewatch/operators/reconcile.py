"""Counting, completeness and reconciliation checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewatch.fixed_values import (
    FROM_BATCH,
    LISTING_PAGE_SIZE,
    MIN_HITS_PER_YEAR,
    REQUIRED_SOURCE_BRANDS,
    RE_ELKJOP_SKU,
    STATUS_OK,
    TARGET_YEARS,
)
from pricewatch.functions.attributes import listing_range, page_count
from pricewatch.functions.once import computed_once


def run_summary(results: DataFrame) -> DataFrame:
    """Per platform: rows, successes, failures and batch hits."""
    ok = F.col("status") == STATUS_OK
    return results.groupBy("platform").agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("failed"),
        F.count_if(F.col("provenance") == FROM_BATCH).alias("batch_hits"),
    )


def failed_platforms(expected: DataFrame, results: DataFrame) -> DataFrame:
    """Expected platforms that delivered no row."""
    return expected.select("platform").join(
        results.select("platform").distinct(), "platform", "left_anti"
    )


def price_coverage(items: DataFrame, keys: list[str]) -> DataFrame:
    """Items, priced items and nameless items per group."""
    named = F.col("raw_text").isNotNull() & (F.col("raw_text") != "")
    return items.groupBy(*keys).agg(
        F.count_if(named).alias("items"),
        F.count_if(named & F.col("price_local").isNotNull()).alias("priced"),
        F.count_if(~named).alias("nameless"),
    )


def brand_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("source_brand").agg(F.count("*").alias("hits"))


def missing_brands(hits: DataFrame, required: DataFrame) -> DataFrame:
    """Required source brands that no hit carries."""
    seen = hits.select(F.lower("source_brand").alias("brand")).distinct()
    return required.select("brand").join(seen, "brand", "left_anti")


def required_brands(spark) -> DataFrame:
    return spark.createDataFrame([(b,) for b in REQUIRED_SOURCE_BRANDS], "brand string")


def page_drift(pages: DataFrame) -> DataFrame:
    """Per year: do all pages declare the same totals?"""
    return pages.groupBy("year").agg(
        F.count("*").alias("pages"),
        F.min("nb_hits").alias("min_hits"),
        F.max("nb_hits").alias("max_hits"),
        F.min("nb_pages").alias("min_pages"),
        F.max("nb_pages").alias("max_pages"),
        (
            (F.min("nb_hits") == F.max("nb_hits")) & (F.min("nb_pages") == F.max("nb_pages"))
        ).alias("stable"),
    )


def completeness(pages: DataFrame, hits: DataFrame, minimum: int = MIN_HITS_PER_YEAR) -> DataFrame:
    """Per year: different SKUs against the declared total."""
    declared = pages.groupBy("year").agg(
        F.max("nb_hits").alias("declared"), F.max("nb_pages").alias("declared_pages")
    )
    found = (
        hits.select("year", "sku").distinct().groupBy("year").agg(F.count("*").alias("found"))
    )
    counted = declared.join(found, "year", "left").fillna(0, ["found"])
    return counted.withColumn(
        "complete",
        (F.col("declared") >= minimum)
        & (F.col("declared_pages") >= 1)
        & (F.col("found") == F.col("declared")),
    )


def duplicate_skus(hits: DataFrame) -> DataFrame:
    return (
        hits.groupBy("year", "sku").agg(F.count("*").alias("times")).filter(F.col("times") > 1)
    )


def cross_year_skus(hits: DataFrame) -> DataFrame:
    """SKUs listed under several years; the set is as long as the number of years."""
    years = hits.select("sku", "year").distinct().groupBy("sku").agg(
        F.sort_array(F.collect_set("year")).alias("years")
    )
    return years.filter(F.size("years") > 1)


def with_hit_rule(hits: DataFrame, require_price: bool = True) -> DataFrame:
    """Add the first rule that a hit breaks, null for a valid one."""
    sku, url = F.col("sku"), F.col("url")
    rule = (
        F.when(~sku.rlike(r"^\d+$"), "sku")
        .when(~F.col("facet_year").eqNullSafe(F.col("year")), "year")
        .when(~url.rlike(RE_ELKJOP_SKU) | ~F.contains(url, sku), "url")
        .when(F.col("source_brand").isNull(), "brand")
    )
    if require_price:
        rule = rule.when(F.col("amount").isNotNull() & (F.col("currency") != "NOK"), "currency").when(
            F.col("amount").isNotNull() & ~F.col("amount").between(100, 500_000), "price"
        )
    return computed_once(hits, {"rule": rule})


def invalid_hits(hits: DataFrame, require_price: bool = True) -> DataFrame:
    """Hits that break a rule, with the first rule broken."""
    return with_hit_rule(hits, require_price).filter(F.col("rule").isNotNull())


#: Gates of an API capture in the order in which a broken one is named.
API_GATES = ("page_drift", "invalid_hit", "duplicate_sku", "incomplete", "cross_year_sku", "missing_brand")


def api_gates(pages: DataFrame, hits: DataFrame, years=TARGET_YEARS, brands=REQUIRED_SOURCE_BRANDS,
              minimum: int = MIN_HITS_PER_YEAR) -> DataFrame:
    """Violations of every gate of an API capture in one plan: (gate, violations).

    Hits are grouped once, by SKU; years and required brands are fixed, so their counts are
    columns that add up over SKUs to one row. Pages add up to one row likewise. A year
    without pages, and pages or hits of another year, count as incomplete.
    """
    ruled = with_hit_rule(hits)
    year, brand = F.col("year"), F.lower(F.col("source_brand"))
    by_sku = ruled.groupBy("sku").agg(
        F.count_if(F.col("rule").isNotNull()).alias("invalid"),
        F.count_if(~year.isin(*years) | year.isNull()).alias("strange"),
        *(F.count_if(year == y).alias(f"in_{y}") for y in years),
        *(F.bool_or(F.coalesce(brand == b, F.lit(False))).alias(f"brand_{i}") for i, b in enumerate(brands)),
    )
    listed = [F.col(f"in_{y}") > 0 for y in years]
    n_years = sum((F.when(here, 1).otherwise(0) for here in listed), F.lit(0))
    total = by_sku.agg(
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_hit"),
        F.coalesce(F.sum("strange"), F.lit(0)).alias("strange"),
        F.count_if(n_years > 1).alias("cross_year_sku"),
        *(F.count_if(here).alias(f"found_{y}") for y, here in zip(years, listed, strict=True)),
        *(F.count_if(F.col(f"in_{y}") > 1).alias(f"twice_{y}") for y in years),
        *(F.count_if(f"brand_{i}").alias(f"brand_{i}") for i in range(len(brands))),
    )

    def of_year(y: int, column: str):
        return F.when(year == y, F.col(column))

    declared = pages.agg(
        F.count_if(~year.isin(*years) | year.isNull()).alias("strange_pages"),
        *(
            f(of_year(y, c)).alias(f"{name}_{c}_{y}")
            for y in years for c in ("nb_hits", "nb_pages") for name, f in (("min", F.min), ("max", F.max))
        ),
    )

    def ones(conditions) -> Column:
        return sum((F.when(F.coalesce(c, F.lit(True)), 1).otherwise(0) for c in conditions), F.lit(0)).cast("long")

    drift = [(F.col(f"min_{c}_{y}") != F.col(f"max_{c}_{y}")) & F.col(f"max_{c}_{y}").isNotNull() for y in years for c in ("nb_hits", "nb_pages")]
    drift = [F.coalesce(d, F.lit(False)) for d in drift]
    complete = [
        (F.col(f"max_nb_hits_{y}") >= minimum) & (F.col(f"max_nb_pages_{y}") >= 1) & (F.col(f"found_{y}") == F.col(f"max_nb_hits_{y}"))
        for y in years
    ]
    counts = {
        "page_drift": ones(drift),
        "invalid_hit": F.col("invalid_hit"),
        "duplicate_sku": sum((F.col(f"twice_{y}") for y in years), F.lit(0)),
        "incomplete": ones(~c for c in complete) + F.col("strange") + F.col("strange_pages"),
        "cross_year_sku": F.col("cross_year_sku"),
        "missing_brand": ones(F.col(f"brand_{i}") == 0 for i in range(len(brands))),
    }
    verdicts = F.array(*(F.struct(F.lit(g).alias("gate"), counts[g].cast("long").alias("violations")) for g in API_GATES))
    # Both are one row of sums; together they are one row again.
    both = total.unionByName(declared, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns)).select(F.inline(verdicts))


def listing_gates(ranges: DataFrame, cards: DataFrame, years=TARGET_YEARS) -> DataFrame:
    """Violations of a listing capture: pages that break their range, are missing or name no total, and years short of products."""
    checked = page_range_check(ranges, cards).join(
        ranges.select("year", "page", F.col("range_text"), listing_range(F.col("range_text"))["total"].alias("total")), ["year", "page"]
    )
    by_year = checked.groupBy("year").agg(
        F.count_if(~F.col("consistent")).alias("broken"),
        F.count_if(F.col("total").isNull()).alias("unstated"),
        F.max_by("total", "page").alias("total"),
        F.max_by("total_pages", "page").alias("total_pages"),
        F.count_distinct("page").alias("pages"),
    )
    found = cards.where("product_key <> ''").groupBy("year").agg(F.count_distinct("product_key").alias("found"))
    wanted = cards.sparkSession.createDataFrame([(y,) for y in years], "year int")
    judged = wanted.join(by_year, "year", "left").join(found, "year", "left")
    fine = (F.col("pages") == F.col("total_pages")) & (F.col("total") == F.col("found")) & (F.col("broken") == 0) & (F.col("unstated") == 0)
    return judged.select("year", "broken", "unstated", "pages", "total_pages", "total", "found", F.coalesce(fine, F.lit(False)).alias("passed"))


def page_range_check(ranges: DataFrame, cards: DataFrame) -> DataFrame:
    """Cards on each listing page against the range the page states."""
    on_page = cards.groupBy("year", "page").agg(F.count("*").alias("cards"))
    stated = ranges.withColumn("__r", listing_range(F.col("range_text")))
    expected = F.col("__r.last") - F.col("__r.first") + 1
    return (
        stated.join(on_page, ["year", "page"], "left")
        .fillna(0, ["cards"])
        .select(
            "year",
            "page",
            expected.alias("expected"),
            "cards",
            page_count(F.col("__r.total"), LISTING_PAGE_SIZE).alias("total_pages"),
            (expected.isNull() | (expected == F.col("cards"))).alias("consistent"),
        )
    )


def family_sizes(items: DataFrame, keys: list[str]) -> DataFrame:
    """Different sizes per family of known series."""
    known = items.filter(F.col("series") != "").select(*keys, "size").distinct()
    return known.groupBy(*keys).agg(F.count("*").alias("sizes"))


def expected_counts(recovered: DataFrame, expected: DataFrame) -> DataFrame:
    """Actual against expected rows per run and platform; both sides are kept."""
    keys = ["run_id", "platform"]
    actual = recovered.groupBy(*keys).agg(F.count("*").alias("actual"))
    return actual.join(expected, keys, "full_outer").select(
        *keys, "actual", "expected", F.col("actual").eqNullSafe(F.col("expected")).alias("matches")
    )


def content_digest(rows: DataFrame, columns: list[str]):
    """Aggregate expression: a digest of the row set that no row order changes.

    Each row is hashed on its own and all 256 bits are summed in four parts, so the digest
    is combined on the map side instead of streaming the whole table through one task. A
    null differs from an empty value.
    """
    cells = (F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns)
    row = F.sha2(F.concat_ws("\x1f", *cells), 256)
    parts = (F.conv(F.substring(row, 1 + 16 * i, 16), 16, 10).cast("decimal(38,0)") for i in range(4))
    return F.concat_ws(":", *(F.sum(part).cast("string") for part in parts))


def manifest_counts(recovered: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and digest per date and platform."""
    return recovered.groupBy("obs_date", "platform").agg(
        F.count("*").alias("recovered_rows"),
        content_digest(recovered, columns).alias("digest"),
    )
