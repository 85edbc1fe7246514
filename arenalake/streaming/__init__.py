"""File-stream ingest: raw loading and the resumable backfill."""
