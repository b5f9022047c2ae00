"""Relational steps: joins, gates, aggregates, rankings and ordered matching."""
