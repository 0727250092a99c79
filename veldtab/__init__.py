"""Tabular analytics on Spark: cleaning, profiling, drift, metrics, models and scoring."""

__version__ = "0.1.0"
