"""Operators for training-data pipelines: scoring, mixing, counting, scanning, filtering, de-duplication."""
