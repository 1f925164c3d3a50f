"""Spark jobs for partitioned event logs and keyed tables."""
