"""Price rows recovered from run logs, with trends recomputed day by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewatch.fixed_values import (
    EXCLUDED_REASON,
    FROM_BATCH,
    RECOVERY_METHOD,
    RECOVERY_PLATFORMS,
    SERIES_KEY,
    STATUS_OK,
)
from pricewatch.functions.logs import (
    line_kind,
    line_timestamp,
    price_fields,
    product_fields,
    time_of,
)
from pricewatch.functions.once import computed_once
from pricewatch.functions.trend import trend_code
from pricewatch.operators.ordered import BLOCK, previous_row
from pricewatch.sources.links import BRAND_KEY
from pricewatch.sources.price_log import latest_by, successful

KEY = list(SERIES_KEY)


def log_fields(lines: DataFrame) -> DataFrame:
    """Kind, product, price and time of each line that carries any."""
    line, kind = F.col("line"), F.col("kind")
    told = computed_once(lines, {"kind": line_kind(line)}).filter(kind != "OTHER")
    product = {c: F.when(kind == "PRODUCT", v) for c, v in product_fields(line).items()}
    amount = {c: F.when(kind == "PRICE", v) for c, v in price_fields(line).items()}
    return told.withColumns({**product, **amount, "logged_at": line_timestamp(line)})


def log_pairs(fields: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each price line with the product line just before it.

    Among product and price lines only, a price pairs exactly when its predecessor is a
    product: a newer product replaces an unused one, and a price uses it up. Lines
    without identity are left out and so use nothing up. ``paired`` is false for a price
    that has no product, which is an error in the log.
    """
    events = fields.filter(F.col("kind").isin("PRODUCT", "PRICE"))
    with_previous = previous_row(events, ["run_id"], "line_no", ["kind", *KEY], "before", block)
    paired = F.coalesce(F.col("before.kind") == "PRODUCT", F.lit(False))
    product = [F.when(paired, F.col(f"before.{c}")).alias(c) for c in KEY]
    rest = [c for c in fields.columns if c not in ("kind", *KEY)]
    return with_previous.filter(F.col("kind") == "PRICE").select(*rest, *product, paired.alias("paired"))


def excluded_lines(lines: DataFrame) -> DataFrame:
    """Successful lines that name no product, kept for the audit."""
    line = F.col("line")
    kept = [c for c in ("run_id", "revision", "run_date") if c in lines.columns]
    return lines.filter(line_kind(line) == "UNNAMED").select(
        *kept,
        "line_no",
        line_timestamp(line).alias("logged_at"),
        F.lit(EXCLUDED_REASON).alias("reason"),
        line.alias("raw_line"),
    )


def brand_lookup(pairs: DataFrame, brands: DataFrame) -> DataFrame:
    """Add the brand of the run's mapping revision; ``brand`` is null on a miss."""
    return pairs.join(brands.select(*BRAND_KEY, "brand"), list(BRAND_KEY), "left")


def recovered_rows(branded: DataFrame) -> DataFrame:
    """Paired and branded log prices in the layout of the audit table."""
    return branded.select(
        "run_id",
        "revision",
        "line_no",
        "logged_at",
        F.col("run_date").alias("obs_date"),
        time_of(F.col("logged_at")).alias("obs_time"),
        "brand",
        *KEY,
        "price",
        "currency",
        F.lit(FROM_BATCH).alias("provenance"),
        F.lit(STATUS_OK).alias("status"),
        "logged_trend",
        F.lit(RECOVERY_METHOD).alias("recovery_method"),
    )


def line_order() -> list[Column]:
    """Order of recovered rows: run, then line. Shorter run ids come first, so numbers sort as numbers."""
    run = F.col("run_id").cast("string")
    return [F.length(run), run, F.col("line_no")]


def recompute_trends(
    rows: DataFrame, existing: DataFrame | None = None, order: list[Column] | None = None, latest: DataFrame | None = None
) -> DataFrame:
    """Trend of each row against the last price of an earlier day.

    All rows of a day compare with the state before that day. Rows are first reduced to
    one closing price per series and day; only those are windowed, and the baseline then
    joins back, so the work of a busy series is spread over its days. ``order`` ranks the
    rows of a day, by default ``seq``; an existing log needs no sequence. ``latest`` are
    the latest prices before the first day, kept beside a log: one row for each series
    instead of the log's rows.
    """
    closing = latest_by(rows, [*KEY, "obs_date"], order or [F.col("seq")], "price", "closing")
    first_day = rows.agg(F.min("obs_date")).scalar()
    days = closing
    if existing is not None:
        earlier = successful(existing).filter(F.col("obs_date") < first_day)
        times = [F.col(c) for c in ("obs_time", "seq") if c in existing.columns]
        days = days.unionByName(latest_by(earlier, [*KEY, "obs_date"], times, "price", "closing"))
    if latest is not None:
        none = F.lit(None).cast(closing.schema["obs_date"].dataType)  # before all days
        known = latest.select(*KEY, none.alias("obs_date"), F.col("old_price").alias("closing"))
        days = days.unionByName(known.join(closing.select(*KEY).distinct(), KEY, "left_semi"))
    by_day = Window.partitionBy(*KEY).orderBy(F.asc_nulls_first("obs_date"))
    baseline = days.withColumn("old_price", F.lag("closing").over(by_day)).drop("closing")
    return rows.join(baseline, [*KEY, "obs_date"], "left").withColumn(
        "trend", trend_code(F.col("price"), F.col("old_price"))
    )


def conflicting_rows(existing: DataFrame, target_dates: DataFrame, platforms=RECOVERY_PLATFORMS) -> DataFrame:
    """Rows already logged on a target date and platform; any such row forbids the append.

    The target dates are distinct days; the planner decides how to join them.
    """
    days = target_dates.select("obs_date").distinct()
    return existing.filter(F.col("platform").isin(*platforms)).join(
        days, "obs_date", "left_semi"
    )
