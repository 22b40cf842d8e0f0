"""Scans of raw files and stored tables."""
