"""Allocata: a Spark-native analytics engine for investment-disclosure data."""

__version__ = "0.1.0"
