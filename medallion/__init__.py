"""Medallion operators for Spark: raw files and event streams to bronze, silver and gold tables."""

__version__ = "0.1.0"
