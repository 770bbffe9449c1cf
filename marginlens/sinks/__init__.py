"""Sinks: overwrite, keyed upsert, partitioned + clustered writes, CSV export."""
