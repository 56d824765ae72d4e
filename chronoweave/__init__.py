"""Temporal features, table profiling, model preparation and graph analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
