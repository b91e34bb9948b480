"""Operators that a training-data pipeline needs, one module each; nothing outside this package imports it."""
