"""Scans: schema-enforced CSV ingest, table reads, the driver-table mapping."""
