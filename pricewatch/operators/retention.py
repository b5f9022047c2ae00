"""Rolling window over the price log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewatch.fixed_values import KEEP_DAYS
from pricewatch.functions.once import computed_once
from pricewatch.functions.text import or_empty, strip


def parsed_date(column):
    """``YYYY-M-D`` text or a date; anything else is null."""
    text = strip(or_empty(column.cast("string")))
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text.try_cast("date"))


def trim_window(log: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Rows of the last days before the newest date; rows without a valid date stay.

    The newest date is a scalar subquery inside the plan, not a value fetched first.
    """
    # A real date column is compared as it is, so that partitions can be pruned.
    is_date = dict(log.dtypes)["obs_date"] == "date"
    day = F.col("obs_date") if is_date else parsed_date(F.col("obs_date"))
    cutoff = log.agg(F.date_sub(F.max(day), keep_days)).scalar()
    dated = log if is_date else computed_once(log, {"__day": day})
    known = F.col("obs_date" if is_date else "__day")
    return dated.filter(known.isNull() | (known >= cutoff)).select(*log.columns)
