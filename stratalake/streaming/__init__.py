"""Incremental ingestion with the batch transformations."""
