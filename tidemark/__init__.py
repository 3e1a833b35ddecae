"""Keeps tables fresh, versioned and clean with native Spark DataFrame operators."""

__version__ = "0.1.0"
