"""Readers of landed snapshots. Each adds ``ingest_seq``, the arrival number within its source."""
