"""Vessel position analytics on Spark: one set of DataFrame transformations for
batch tables and for Structured Streaming."""

from wakeline.config import Settings

__all__ = ["Settings"]
