"""Spark operators for animal records, pedigrees and association results."""

__version__ = "0.1.0"
