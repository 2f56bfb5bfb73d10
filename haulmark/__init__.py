"""Commodity-trade and market-news analytics as parameterised Spark DataFrame operators."""

__version__ = "0.1.0"
