"""Derived columns that are evaluated a single time per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns whose later filters must not repeat their expression.

    Spark moves a filter on a projected column below the projection and evaluates the
    expression there as well. It leaves filters on generated columns where they are, so
    costly text rules are generated from a one-element array.
    """
    kept = [c for c in rows.columns if c not in columns]
    cells = F.struct(*(expression.alias(name) for name, expression in columns.items()))
    return rows.select(*kept, F.inline(F.array(cells)))
