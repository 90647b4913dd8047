"""Tall to wide: one pass instead of a chain of full outer joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_variables(df: DataFrame, keys: list[str], variable_col: str, value_col: str, columns: dict[str, str]) -> DataFrame:
    """One row for each key, one column for each variable of ``columns`` (variable -> column);
    a variable that a key lacks is null. The input has one row for each key and variable."""
    picked = df.filter(F.col(variable_col).isin(*columns))
    return picked.groupBy(*keys).agg(*[F.max(F.when(F.col(variable_col) == v, F.col(value_col))).alias(c) for v, c in columns.items()])


def reference_row(df: DataFrame, keys: list[str], columns: list[str], order_col: str) -> DataFrame:
    """The latest values of reference columns for each key; ties go to the largest values."""
    best = F.max(F.struct(order_col, *columns)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}") for c in columns])
