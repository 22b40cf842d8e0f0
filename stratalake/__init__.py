"""Layered (raw, standardised, daily) analytics as plain Spark DataFrame functions."""

__version__ = "1.0"
