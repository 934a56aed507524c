"""Derived columns that are costly to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or replace a column whose expression later filters must not repeat.

    Spark moves a filter on a projected column below the projection and evaluates
    the whole expression once more there; it cannot move it below a generator.
    """
    kept = [c for c in rows.columns if c != name]
    return rows.select(*kept, F.explode_outer(F.array(value)).alias(name))
