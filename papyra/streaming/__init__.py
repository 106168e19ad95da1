"""Incremental runs: resumable file processing and index refresh."""
