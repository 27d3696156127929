"""Incremental ingest (file streams with checkpoints) and late-duplicate handling."""
