"""Operators of a training-data pipeline (dedup, filtering, mixing, formatting,
tokens, archives) on Spark. Nothing else in the library imports this package."""
