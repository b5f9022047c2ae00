"""Recovery of price rows from run logs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from pricewatch.operators import recovery as steps
from pricewatch.operators.reconcile import expected_counts
from pricewatch.sources.links import brand_map


class RecoveryRejected(RuntimeError):
    """The log does not reconcile; nothing may be written."""


@dataclass(frozen=True)
class Recovered:
    rows: DataFrame
    excluded: DataFrame
    violations: dict[str, DataFrame]

    def checked(self) -> "Recovered":
        for name, rows in self.violations.items():
            if not rows.isEmpty():
                raise RecoveryRejected(name)
        return self


def recover(lines: DataFrame, mapping: DataFrame, expected: DataFrame, existing: DataFrame,
            staging: str | None = None) -> Recovered:
    """Pair log lines, add brands and trends, and list every violation found on the way.

    With ``staging``, the parsed lines, a small part of the log, are written there first,
    so that the log is read and searched once for all the tables returned.
    """
    brands = brand_map(mapping)
    fields = steps.log_fields(lines)
    if staging:
        fields.write.mode("overwrite").parquet(staging)
        fields = lines.sparkSession.read.parquet(staging)
    pairs = steps.log_pairs(fields)
    branded = steps.brand_lookup(pairs, brands)
    rows = steps.recovered_rows(branded.filter(F.col("paired")))
    trended = steps.recompute_trends(rows, existing, steps.line_order())
    return Recovered(
        rows=trended,
        excluded=steps.excluded_lines(fields),
        violations={
            "ambiguous_brand": brands.filter(F.col("brands") != 1),
            "unpaired_price": pairs.filter(~F.col("paired")),
            "unknown_brand": branded.filter(F.col("paired") & F.col("brand").isNull()),
            "unexpected_count": expected_counts(rows, expected).filter(~F.col("matches")),
            "conflict": steps.conflicting_rows(existing, rows),
        },
    )
