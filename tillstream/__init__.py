"""Retail stream and batch analytics as reusable DataFrame -> DataFrame operators."""

__version__ = "0.1.0"
