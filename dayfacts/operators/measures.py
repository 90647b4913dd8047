"""Measures over daily facts: totals, ratios over a period, changes, calendar averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import safe_pct


def period_measures(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Totals, mean price and the renewable share of a period, for each key and over all (key null).

    The share is a ratio of sums over the rows where both sides are known.
    """
    both = F.col("total_generation_mwh").isNotNull() & F.col("renewable_generation_mwh").isNotNull()
    total, part = F.sum(F.when(both, F.col("total_generation_mwh"))), F.sum(F.when(both, F.col("renewable_generation_mwh")))
    return fact.rollup(*keys).agg(
        F.sum("daily_demand_mwh").alias("demand_mwh"),
        F.avg("avg_day_ahead_price_eur_mwh").alias("avg_price"),
        F.sum("total_generation_mwh").alias("generation_mwh"),
        safe_pct(part, total).alias("renewable_pct"),
    )


def latest_complete_date(df: DataFrame, keys: list[str], date_col: str, status_col: str) -> DataFrame:
    """The latest complete date for each key, and over all keys (key null)."""
    return df.rollup(*keys).agg(F.max(F.when(F.col(status_col) == "complete", F.col(date_col))).alias("latest_complete_date"))


def pair_correlation(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Correlation and number of pairs; pairs with a null on either side do not count."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys).agg(F.corr(x, y).alias("correlation"), F.count(F.lit(1)).alias("n_pairs"))


def previous_day_change(df: DataFrame, keys: list[str], date_col: str, value_col: str) -> DataFrame:
    """Adds previous_value and change_pct; both null unless the day before has a row."""
    order = W.partitionBy(*keys).orderBy(date_col)
    before = F.when(F.datediff(date_col, F.lag(date_col).over(order)) == 1, F.lag(value_col).over(order))
    return df.withColumn("previous_value", before).withColumn("change_pct", safe_pct(F.col(value_col) - F.col("previous_value"), F.col("previous_value")))


def calendar_average(df: DataFrame, keys: list[str], date_col: str, value_col: str, days: int = 7) -> DataFrame:
    """Adds moving_average over the last ``days`` calendar days, the row's own included; missing
    days and nulls do not count."""
    number = F.datediff(date_col, F.lit("1970-01-01").cast("date"))
    span = W.partitionBy(*keys).orderBy(number).rangeBetween(-(days - 1), 0)
    return df.withColumn("moving_average", F.avg(value_col).over(span))
