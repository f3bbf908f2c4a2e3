"""Evaluate a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, column: Column, name: str) -> DataFrame:
    """Add ``name``, so that later filters use its value and do not repeat ``column``.

    A filter on a projected column is pushed below the projection with the
    expression copied into every place it is used; parsing JSON would then run
    many times per row. Filters are not pushed below a one-element explode.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
