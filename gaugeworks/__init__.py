"""Telemetry analytics on Spark: as-of lookups, interval joins, gap filling,
state sessions, schema tools, keyed tables and the marts built from them."""

__version__ = "0.1.0"
