"""Pipelines from raw files to published tables."""
