"""Layered warehouse building blocks for Spark: files -> typed tables -> history -> star -> reports."""

__version__ = "0.1.0"
