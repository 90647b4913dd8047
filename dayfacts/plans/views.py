"""Views of the given tables as observations, indicators, attempts and the like."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import floor_to

ZONES = [("C0", "Europe/Dublin"), ("C1", "Europe/Berlin"), ("C2", "Europe/Helsinki")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, read in a session that counts time in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ZONES, "country_code string, timezone string")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = F.concat(F.lit("C"), (F.col("user_id") % 3).cast("string"))
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("country_code", country)


def obs_load(spark: SparkSession, sf_dir: str, *, slot_seconds: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """Load readings of three lengths. They begin at multiples of their lengths, or of
    ``slot_seconds``, so that they overlap."""
    third = F.col("user_id") % 3 == 2
    resolution = F.when(third & (F.col("user_id") % 2 == 0), "PT15M").when(third | (F.col("user_id") % 7 == 0), "PT30M").otherwise("PT60M")
    seconds = F.when(F.col("source_resolution") == "PT15M", 900).when(F.col("source_resolution") == "PT30M", 1800).otherwise(3600)
    rows = _events(spark, sf_dir).withColumn("source_resolution", resolution)
    return rows.select("country_code", floor_to(F.col("ts"), slot_seconds or seconds).alias("slot"), "source_resolution", (F.col("value") - 1).alias("value"), "event_id", *columns or [])


def obs_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation at three hours; clicks of C1 at six, and signups of C2 hourly on every fifth day."""
    kind = F.col("event_type")
    code = F.when(F.col("user_id") % 50 == 0, "B99").when(kind == "signup", "B19").when(kind == "purchase", "B04").when(kind == "error", "B16").when(kind == "click", "B09").otherwise("B17")
    business = F.when((kind == "signup") & (F.col("user_id") % 5 == 0), "A04").when(kind == "click", F.lit(None).cast("string")).otherwise("A01")
    hours = F.when((F.col("user_id") % 3 == 1) & (kind == "click"), 6).when((F.col("user_id") % 3 == 2) & (kind == "signup") & (F.day("ts") % 5 == 0), 1).otherwise(3)
    rows = _events(spark, sf_dir).withColumn("_hours", hours)
    return rows.select("country_code", floor_to(F.col("ts"), F.col("_hours") * 3600).alias("slot"), F.concat(F.lit("PT"), F.col("_hours").cast("string"), F.lit("H")).alias("source_resolution"), "value", code.alias("production_type_raw"), business.alias("business_type"), "event_id")


def variables_tall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest value of each country, day and event type."""
    day = F.to_date("ts").alias("local_date")
    rows = _events(spark, sf_dir).select("country_code", day, F.col("event_type").alias("source_variable"), "value", "event_id", "user_id")
    best = rows.groupBy("country_code", "local_date", "source_variable").agg(F.max_by(F.struct("value", "user_id"), "event_id").alias("b"), F.max("event_id").alias("event_id"))
    return best.select("country_code", "local_date", "source_variable", F.col("b.value").alias("value"), F.col("b.user_id").alias("user_id"), "event_id")


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, order value, also by customer, and the share of orders of customers in credit, by
    country and year, the years moved to those of the events."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    key = F.concat(F.lit("C"), (F.col("c_nationkey") % 3).cast("string")).alias("country_code")
    value, people = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), F.count_distinct("c_custkey")
    credit = F.avg(F.when(F.col("c_acctbal") >= 0, 100.0).otherwise(0.0))
    sums = joined.groupBy(key, (F.year("o_orderdate") + 26).alias("year")).agg(people.alias("population"), value.alias("gdp_constant_2015_usd"), credit.alias("urban_population_pct"))
    return sums.withColumn("gdp_per_capita_constant_2015_usd", F.col("gdp_constant_2015_usd") / F.col("population"))


def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators(spark, sf_dir).select("country_code", "year", "population", "gdp_constant_2015_usd")


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate").alias("order_date")
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus", day).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "reset").when(F.col("event_type") == "purchase", "unavailable").when(F.col("event_type") == "view", "failed").otherwise("success")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("combo"), F.col("event_id").alias("at"), status.alias("status"))


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")
