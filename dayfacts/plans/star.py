"""Dimensions and facts. Only trusted inputs feed facts: a partial day is null there, never a
smaller number; a zero or unknown denominator gives null."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import kwh_per_capita, safe_pct
from ..operators.quality import reconcile
from ..sources.tables import date_spine

DAY = ["country_code", "local_date"]


def dim_country(countries: DataFrame) -> DataFrame:
    """country_key (the upper-cased code) before the given columns."""
    return countries.select(F.upper("country_code").alias("country_key"), *countries.columns)


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row for each date; days of the week count from Sunday as 1."""
    d = F.col("date")
    return date_spine(spark, start, end).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def complete_only(daily: DataFrame) -> DataFrame:
    return daily.filter("completeness_status = 'complete'").drop("completeness_status")


def generation_totals(mix: DataFrame) -> DataFrame:
    """Total and renewable generation of a day; null unless every category is complete."""
    whole = F.bool_and(F.col("completeness_status") == "complete")
    return mix.groupBy(*DAY).agg(
        F.when(whole, F.sum("generation_mwh")).alias("total_generation_mwh"),
        F.when(whole, F.sum(F.when(F.col("renewable_flag"), F.col("generation_mwh")).otherwise(0.0))).alias("renewable_generation_mwh"),
    )


def with_dimensions(facts: DataFrame, countries: DataFrame, dates: DataFrame) -> DataFrame:
    """Inner joins to both dimensions; rows that either lacks drop out, and the natural keys give
    way to country_key and date_key. Spark broadcasts a dimension if it is small."""
    c = countries.select("country_key", "country_code")
    d = dates.select("date_key", F.col("date").alias("local_date"))
    rest = [x for x in facts.columns if x not in DAY]
    return facts.join(c, "country_code").join(d, "local_date").select("country_key", "date_key", *rest)


def daily_energy(demand: DataFrame, price: DataFrame, mix: DataFrame) -> DataFrame:
    """One row for each country-day that any of the three knows, metrics of complete days only."""
    demand = complete_only(demand).select(*DAY, "daily_demand_mwh")
    price = complete_only(price).select(*DAY, "avg_day_ahead_price_eur_mwh", "min_day_ahead_price_eur_mwh", "max_day_ahead_price_eur_mwh")
    either = demand.unionByName(price, allowMissingColumns=True).unionByName(generation_totals(mix), allowMissingColumns=True)
    out = either.groupBy(*DAY).agg(*[F.max(c).alias(c) for c in either.columns if c not in DAY])  # each has one row for a day
    return out.withColumn("renewable_generation_pct", safe_pct(F.col("renewable_generation_mwh"), F.col("total_generation_mwh")))


def with_annual(daily: DataFrame, annual: DataFrame) -> DataFrame:
    """Adds a year's indicators to each of its days; a year without any leaves nulls. ``annual``
    is country_code, year and indicators, one row for each country and year."""
    a = annual.withColumnRenamed("country_code", "_country").withColumnRenamed("year", "_year")
    return daily.join(a, (F.col("country_code") == F.col("_country")) & (F.year("local_date") == F.col("_year")), "left").drop("_country", "_year")


def fact_energy_daily(demand: DataFrame, price: DataFrame, mix: DataFrame, annual: DataFrame, countries: DataFrame, dates: DataFrame) -> DataFrame:
    out = with_annual(daily_energy(demand, price, mix), annual)
    out = out.withColumn("demand_kwh_per_capita", kwh_per_capita(F.col("daily_demand_mwh"), F.col("population")))
    return with_dimensions(out, countries, dates)


def fact_weather_daily(weather: DataFrame, countries: DataFrame, dates: DataFrame) -> DataFrame:
    return with_dimensions(weather, countries, dates)


def fact_generation_mix_daily(mix: DataFrame, countries: DataFrame, dates: DataFrame) -> DataFrame:
    """Complete categories with their share of the day; null shares on days with a partial
    category or without generation. The total comes from the same pass as the rows."""
    day = W.partitionBy(*DAY)
    whole = F.min((F.col("completeness_status") == "complete").cast("int")).over(day) == 1
    marked = mix.withColumn("_total", F.sum("generation_mwh").over(day)).withColumn("_whole", whole)
    share = F.when(F.col("_whole") & (F.col("_total") > 0), F.col("generation_mwh") / F.col("_total") * 100)
    rows = marked.withColumn("generation_share_pct", share).filter("completeness_status = 'complete'")
    rows = rows.select(*DAY, F.col("normalized_production_type").alias("production_type"), "generation_mwh", "renewable_flag", "generation_share_pct")
    return with_dimensions(rows, countries, dates)


def generation_off_mix(fact: DataFrame, mix_fact: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Days on which an energy fact's total or renewable generation is not what its mix adds up to:
    country_key, date_key, measure, left_value (the fact's), right_value (the mix's). Days that only
    one of the two has, or whose value the fact does not know, are not compared."""
    keys = ["country_key", "date_key"]
    sums = mix_fact.groupBy(*keys).agg(F.sum("generation_mwh").alias("total_generation_mwh"), F.sum(F.when(F.col("renewable_flag"), F.col("generation_mwh")).otherwise(0.0)).alias("renewable_generation_mwh"))

    def tall(df: DataFrame) -> DataFrame:
        each = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in ("total_generation_mwh", "renewable_generation_mwh")])
        return df.select(*keys, F.explode(each).alias("_m")).select(*keys, "_m.measure", "_m.value")

    return reconcile(tall(fact), tall(sums), [*keys, "measure"], "value", "value", tolerance)
