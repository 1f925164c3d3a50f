"""Joins, aggregations, ledger views and partition maps."""
