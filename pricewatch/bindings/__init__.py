"""Named queries over the given tables, each with its SQL counterpart.

``roles`` renames the tables into the shapes the library works on. Every other module
registers queries: the Spark side calls the library, the SQL side states the expected
result in its own way.
"""

from __future__ import annotations

from pricewatch.bindings import (  # noqa: F401
    attributes,
    cards,
    catalogue,
    files,
    gates,
    joins,
    log_recovery,
    prices,
    ranking,
    responses,
    run,
    titles,
    watch_list,
)
from pricewatch.bindings.registry import QUERIES, oracle_texts

__all__ = ["QUERIES", "oracle_texts"]
