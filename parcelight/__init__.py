"""Spark analytics for commerce orders and product reviews."""

__version__ = "0.1.0"
