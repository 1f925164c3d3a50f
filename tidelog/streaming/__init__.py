"""Streaming sinks: exactly-once batches, appends, row writers, progress."""
