"""Columns that cost much, worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add (or replace) columns; filters and later columns that use them read the values, not their expressions.

    A filter on a projected column is moved below the projection and takes a copy of the expression for each
    use, so a parse that a filter uses ten times runs ten times, and once more for its column. Nothing is
    copied across a generator: the values are projected first, then pass one as the only element of an array.
    """
    order = [*df.columns, *[c for c in columns if c not in df.columns]]
    kept = [c for c in order if c not in columns]
    values = df.select(*kept, F.struct(*[c.alias(name) for name, c in columns.items()]).alias("_values"))
    passed = values.select(*kept, F.explode(F.array("_values")).alias("_once"))
    return passed.select(*[F.col("_once")[c].alias(c) if c in columns else F.col(c) for c in order])
