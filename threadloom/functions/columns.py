"""Columns that a row works out once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with further columns, each worked out once for a row, however many filters and projections read it.

    The planner copies the expressions of a projection into every filter that it moves below it, and so works out an expensive one again and again. It moves no filter
    below the generator that makes a column, so these come from a generator of one row each, which stays in generated code.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))
