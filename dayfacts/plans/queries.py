"""Registered queries over the given tables, each with DuckDB SQL for the same rows.

Names of computed columns agree on both sides; floating-point results are rounded on both.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import duration_hours, local_day_hours, weighted_mean
from ..operators import completeness, intervals, lookups, measures, observed, quality, reshape, revisions, windows
from .. import versions
from ..sinks import merge_months, rebuild, serving_projection, write_by_month, write_by_outcome, write_merged
from ..sources import documents, tables
from . import star, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


SPINE = (dt.date(2024, 1, 1), dt.date(2024, 12, 31))
JANUARY = (dt.date(2024, 1, 8), dt.date(2024, 1, 20))
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]

# --- SQL shared by the daily facts ---------------------------------------------------------

_ZONES = "zones(country_code, timezone) AS (VALUES ('C0', 'Europe/Dublin'), ('C1', 'Europe/Berlin'), ('C2', 'Europe/Helsinki'))"
_OBS = f"""{_ZONES},
obs AS (
  SELECT 'C' || CAST(user_id % 3 AS VARCHAR) AS country_code,
    CASE WHEN user_id % 3 = 2 AND user_id % 2 = 0 THEN 'PT15M' WHEN user_id % 3 = 2 OR user_id % 7 = 0 THEN 'PT30M' ELSE 'PT60M' END AS source_resolution,
    CASE WHEN user_id % 3 = 2 AND user_id % 2 = 0 THEN 15 WHEN user_id % 3 = 2 OR user_id % 7 = 0 THEN 30 ELSE 60 END AS minutes,
    ts, event_id, value - 1 AS value FROM events
), slotted AS (SELECT *, time_bucket(to_minutes(minutes), ts) AS slot, minutes / 60.0 AS hours FROM obs),
latest AS (SELECT * FROM slotted QUALIFY row_number() OVER (PARTITION BY country_code, slot, source_resolution ORDER BY event_id DESC, value DESC) = 1),
local AS (SELECT l.*, CAST(timezone(z.timezone, timezone('UTC', slot)) AS DATE) AS local_date FROM latest l JOIN zones z USING (country_code))"""
_FULL = "(epoch(timezone(z.timezone, CAST(local_date + 1 AS TIMESTAMP))) - epoch(timezone(z.timezone, CAST(local_date AS TIMESTAMP)))) / 3600.0"
_STATUS = f"CASE WHEN covered >= {_FULL} - 1/60.0 THEN 'complete' ELSE 'partial' END"


def _preferred(filter_: str) -> str:
    return f"""chosen AS (
  SELECT * FROM local WHERE {filter_}
  QUALIFY hours = CASE WHEN max(CAST(hours = 1 AS INT)) OVER (PARTITION BY country_code, local_date) = 1 THEN 1 ELSE min(hours) OVER (PARTITION BY country_code, local_date) END)"""


_DEMAND = f"""demand AS (
  SELECT country_code, local_date, energy AS daily_demand_mwh, n AS source_interval_count, covered AS covered_duration_hours, {_STATUS} AS completeness_status
  FROM (SELECT country_code, local_date, sum(value * hours) AS energy, count(*) AS n, sum(hours) AS covered FROM chosen GROUP BY ALL) d JOIN zones z USING (country_code))"""
_MIX = f"""raw AS (
  SELECT 'C' || CAST(user_id % 3 AS VARCHAR) AS country_code, value, event_id,
    CASE WHEN user_id % 3 = 1 AND event_type = 'click' THEN 6 WHEN user_id % 3 = 2 AND event_type = 'signup' AND day(ts) % 5 = 0 THEN 1 ELSE 3 END AS hours,
    time_bucket(to_hours(CASE WHEN user_id % 3 = 1 AND event_type = 'click' THEN 6 WHEN user_id % 3 = 2 AND event_type = 'signup' AND day(ts) % 5 = 0 THEN 1 ELSE 3 END), ts) AS slot,
    CASE WHEN user_id % 50 = 0 THEN 'B99' WHEN event_type = 'signup' THEN 'B19' WHEN event_type = 'purchase' THEN 'B04' WHEN event_type = 'error' THEN 'B16' WHEN event_type = 'click' THEN 'B09' ELSE 'B17' END AS code,
    CASE WHEN event_type = 'signup' AND user_id % 5 = 0 THEN 'A04' WHEN event_type = 'click' THEN NULL ELSE 'A01' END AS business_type
  FROM events
), rawlatest AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY country_code, slot, hours, code, business_type ORDER BY event_id DESC) = 1),
types(code, category, renewable) AS (VALUES ('B19', 'wind', TRUE), ('B04', 'gas', FALSE), ('B16', 'solar', TRUE), ('B09', 'other', TRUE), ('B17', 'other', FALSE)),
series AS (
  SELECT r.*, CAST(timezone(z.timezone, timezone('UTC', slot)) AS DATE) AS local_date, coalesce(category, 'other') AS normalized_production_type, coalesce(renewable, FALSE) AS flag
  FROM rawlatest r JOIN zones z USING (country_code) LEFT JOIN types t USING (code) WHERE business_type IS DISTINCT FROM 'A04' AND value >= 0
), mixchosen AS (
  SELECT * FROM series
  QUALIFY hours = CASE WHEN max(CAST(hours = 1 AS INT)) OVER (PARTITION BY country_code, local_date) = 1 THEN 1 ELSE min(hours) OVER (PARTITION BY country_code, local_date) END
), mix AS (
  SELECT country_code, local_date, normalized_production_type, renewable_flag, generation_mwh, codes, covered AS covered_duration_hours, {_STATUS} AS completeness_status
  FROM (SELECT country_code, local_date, normalized_production_type, arg_min(flag, code) AS renewable_flag, sum(value * hours) AS generation_mwh, list_sort(list(DISTINCT code)) AS codes, CAST(sum(hours) AS DOUBLE) AS covered FROM mixchosen GROUP BY country_code, local_date, normalized_production_type) d JOIN zones z USING (country_code))"""
_PRICE = f"""pchosen AS (
  SELECT * FROM local WHERE value IS NOT NULL
  QUALIFY hours = CASE WHEN max(CAST(hours = 1 AS INT)) OVER (PARTITION BY country_code, local_date) = 1 THEN 1 ELSE min(hours) OVER (PARTITION BY country_code, local_date) END),
price AS (
  SELECT country_code, local_date, mean AS avg_day_ahead_price_eur_mwh, low AS min_day_ahead_price_eur_mwh, high AS max_day_ahead_price_eur_mwh, n AS source_interval_count, covered AS covered_duration_hours, {_STATUS} AS completeness_status
  FROM (SELECT country_code, local_date, sum(value * hours) / nullif(sum(hours), 0) AS mean, min(value) AS low, max(value) AS high, count(*) AS n, sum(hours) AS covered FROM pchosen GROUP BY ALL) d JOIN zones z USING (country_code))"""
_ANNUAL = """annual AS (
  SELECT 'C' || CAST(c_nationkey % 3 AS VARCHAR) AS country_code, year(o_orderdate) + 26 AS year, count(DISTINCT c_custkey) AS population, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS gdp_constant_2015_usd,
    gdp_constant_2015_usd / population AS gdp_per_capita_constant_2015_usd, CAST(avg(CASE WHEN c_acctbal >= 0 THEN 100 ELSE 0 END) AS DOUBLE) AS urban_population_pct
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""
_TOTALS = """totals AS (
  SELECT country_code, local_date,
    CASE WHEN bool_and(completeness_status = 'complete') THEN sum(generation_mwh) END AS total_generation_mwh,
    CASE WHEN bool_and(completeness_status = 'complete') THEN sum(CASE WHEN renewable_flag THEN generation_mwh ELSE 0 END) END AS renewable_generation_mwh
  FROM mix GROUP BY country_code, local_date)"""
_ENERGY = f"""WITH {_OBS}, {_preferred('value >= 0')}, {_DEMAND}, {_PRICE}, {_MIX}, {_TOTALS},
keys AS (
  SELECT country_code, local_date FROM demand WHERE completeness_status = 'complete'
  UNION SELECT country_code, local_date FROM price WHERE completeness_status = 'complete'
  UNION SELECT country_code, local_date FROM totals),
energy AS (
  SELECT k.country_code, k.local_date, daily_demand_mwh, avg_day_ahead_price_eur_mwh, min_day_ahead_price_eur_mwh, max_day_ahead_price_eur_mwh, total_generation_mwh, renewable_generation_mwh,
    renewable_generation_mwh / nullif(total_generation_mwh, 0) * 100 AS renewable_generation_pct
  FROM keys k
  LEFT JOIN (SELECT * FROM demand WHERE completeness_status = 'complete') d USING (country_code, local_date)
  LEFT JOIN (SELECT * FROM price WHERE completeness_status = 'complete') p USING (country_code, local_date)
  LEFT JOIN totals t USING (country_code, local_date)), {_ANNUAL}"""


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.daily_demand(views.obs_load(spark, sf_dir), views.zones(spark))


def price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.daily_price(views.obs_load(spark, sf_dir), views.zones(spark))


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.generation_mix(views.obs_mix(spark, sf_dir), views.zones(spark))


def dimensions(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return star.dim_country(views.zones(spark)), star.dim_date(spark, *SPINE)


def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.daily_energy(demand(spark, sf_dir), price(spark, sf_dir), mix(spark, sf_dir))


# --- Daily rollups ---------------------------------------------------------------------------


@query(f"WITH {_OBS}, {_preferred('value >= 0')}, {_DEMAND} SELECT country_code, local_date, round(daily_demand_mwh, 4) AS daily_demand_mwh, source_interval_count, round(covered_duration_hours, 4) AS covered_duration_hours, completeness_status FROM demand")
def daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(demand(spark, sf_dir), "daily_demand_mwh", "covered_duration_hours")


@query(f"WITH {_OBS}, {_PRICE} SELECT country_code, local_date, round(avg_day_ahead_price_eur_mwh, 8) AS avg_day_ahead_price_eur_mwh, round(min_day_ahead_price_eur_mwh, 4) AS min_day_ahead_price_eur_mwh, round(max_day_ahead_price_eur_mwh, 4) AS max_day_ahead_price_eur_mwh, source_interval_count, round(covered_duration_hours, 4) AS covered_duration_hours, completeness_status FROM price")
def daily_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(price(spark, sf_dir), "avg_day_ahead_price_eur_mwh", digits=8), "min_day_ahead_price_eur_mwh", "max_day_ahead_price_eur_mwh", "covered_duration_hours")


@query(f"WITH {_ZONES}, {_MIX} SELECT country_code, local_date, normalized_production_type, renewable_flag, round(generation_mwh, 4) AS generation_mwh, array_to_string(codes, ',') AS production_type_raw_codes, covered_duration_hours, completeness_status FROM mix")
def generation_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mix(spark, sf_dir), "generation_mwh").withColumn("production_type_raw_codes", F.array_join("production_type_raw_codes", ","))


@query(f"WITH {_OBS}, {_preferred('value >= 0')} SELECT country_code, local_date, source_resolution, count(*) AS n_rows, count(DISTINCT slot) AS n_slots FROM chosen GROUP BY ALL")
def preferred_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = revisions.latest_per_key(views.obs_load(spark, sf_dir), ["country_code", "slot", "source_resolution"], "event_id").filter("value >= 0")
    timed = intervals.with_local_date(current, views.zones(spark)).withColumn("interval_hours", duration_hours(F.col("source_resolution")))
    return intervals.with_preferred_resolution(timed).groupBy("country_code", "local_date", "source_resolution").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("slot").alias("n_slots"))


@query(f"WITH {_OBS} SELECT country_code, source_resolution, min(hours) AS interval_hours, count(*) AS n_rows FROM obs o JOIN (SELECT DISTINCT minutes m, minutes / 60.0 AS hours FROM obs) ON m = minutes GROUP BY ALL")
def iso_duration_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.obs_load(spark, sf_dir).withColumn("interval_hours", duration_hours(F.col("source_resolution")))
    return rows.groupBy("country_code", "source_resolution").agg(F.min("interval_hours").alias("interval_hours"), F.count(F.lit(1)).alias("n_rows"))


@query(f"WITH {_ZONES} SELECT country_code, CAST(timezone(timezone, timezone('UTC', ts)) AS DATE) AS local_date, count(*) AS n_rows FROM (SELECT 'C' || CAST(user_id % 3 AS VARCHAR) AS country_code, ts FROM events) JOIN zones USING (country_code) GROUP BY ALL")
def local_day_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "events").select(F.concat(F.lit("C"), (F.col("user_id") % 3).cast("string")).alias("country_code"), F.col("ts").cast("timestamp").alias("slot"))
    return intervals.with_local_date(rows, views.zones(spark)).groupBy("country_code", "local_date").agg(F.count(F.lit(1)).alias("n_rows"))


_NATION_ZONES = "SELECT n_name, n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'Europe/Dublin' WHEN 1 THEN 'Europe/Berlin' ELSE 'Europe/Helsinki' END AS timezone FROM nation"


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.when(F.col("n_nationkey") % 3 == 0, "Europe/Dublin").when(F.col("n_nationkey") % 3 == 1, "Europe/Berlin").otherwise("Europe/Helsinki")
    return views.table(spark, sf_dir, "nation").select("n_name", "n_nationkey", zone.alias("timezone"))


@query(f"SELECT n_name AS country_code, CAST(d AS DATE) AS local_date, CAST((epoch(timezone(timezone, CAST(CAST(d AS DATE) + 1 AS TIMESTAMP))) - epoch(timezone(timezone, CAST(d AS TIMESTAMP)))) / 3600.0 AS DOUBLE) AS day_hours FROM ({_NATION_ZONES}), generate_series(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY) AS s(d)")
def expected_day_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nation_zones(spark, sf_dir).select(F.col("n_name").alias("country_code"), "timezone", F.explode(F.sequence(F.lit(SPINE[0]), F.lit(SPINE[1]))).alias("local_date"))
    return rows.select("country_code", "local_date", local_day_hours(F.col("local_date"), F.col("timezone")).alias("day_hours"))


@query("SELECT l_returnflag, round(sum(CASE WHEN l_quantity IS NOT NULL AND l_discount IS NOT NULL THEN l_discount * l_quantity END) / nullif(sum(l_quantity), 0), 6) AS mean_discount FROM lineitem GROUP BY l_returnflag")
def duration_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = weighted_mean(F.col("l_discount"), F.col("l_quantity"))
    return views.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(mean, 6).alias("mean_discount"))


@query(f"WITH {_OBS}, {_preferred('value >= 0')}, {_DEMAND} SELECT count(*) AS n_days FROM demand WHERE local_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'")
def incremental_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a window on which the padded recompute agrees with the full one."""
    full = windows.restrict(demand(spark, sf_dir), *JANUARY)
    part = intervals.daily_demand(windows.padded_read(views.obs_load(spark, sf_dir), "slot", *JANUARY), views.zones(spark))
    part = windows.restrict(part, *JANUARY)
    keys = ["country_code", "local_date", "source_interval_count", "completeness_status"]
    same = rounded(full, "daily_demand_mwh").select(*keys, "daily_demand_mwh").intersect(rounded(part, "daily_demand_mwh").select(*keys, "daily_demand_mwh"))
    return same.agg(F.count(F.lit(1)).alias("n_days"))


# --- Dimensions and facts --------------------------------------------------------------------


@query(f"SELECT upper(n_name) AS country_key, n_name AS country_code, timezone FROM ({_NATION_ZONES})")
def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_country(nation_zones(spark, sf_dir).select(F.col("n_name").alias("country_code"), "timezone"))


@query(
    "SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, day(d) AS day_of_month, dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name, weekofyear(d) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend, n AS n_orders FROM (SELECT d, count(o_orderkey) AS n FROM generate_series((SELECT min(o_orderdate)::DATE FROM orders), (SELECT max(o_orderdate)::DATE FROM orders), INTERVAL 1 DAY) AS s(d) LEFT JOIN orders ON o_orderdate::DATE = d::DATE GROUP BY d)"
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the orders' dates, with each day's orders."""
    orders = views.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    low, high = orders.agg(F.min("date"), F.max("date")).first()
    days = star.dim_date(spark, low, high)
    return days.join(orders, "date", "left").select(*days.columns, F.coalesce("n", F.lit(0)).alias("n_orders"))


_FACT_COLUMNS = ["daily_demand_mwh", "avg_day_ahead_price_eur_mwh", "min_day_ahead_price_eur_mwh", "max_day_ahead_price_eur_mwh", "total_generation_mwh", "renewable_generation_mwh", "renewable_generation_pct"]
_PER_YEAR = ["gdp_per_capita_constant_2015_usd", "urban_population_pct"]
_ROUNDED = ", ".join(f"round({c}, 8) AS {c}" for c in _FACT_COLUMNS)
_DIM = "country_code AS country_key, CAST(strftime(local_date, '%Y%m%d') AS INT) AS date_key"
_IN_SPINE = "local_date BETWEEN DATE '2024-01-01' AND DATE '2024-12-31'"


@query(f"{_ENERGY} SELECT {_DIM}, {_ROUNDED}, population, gdp_constant_2015_usd, round(gdp_per_capita_constant_2015_usd, 6) AS gdp_per_capita_constant_2015_usd, round(urban_population_pct, 6) AS urban_population_pct, round(daily_demand_mwh * 1000 / nullif(population, 0), 8) AS demand_kwh_per_capita FROM energy e LEFT JOIN annual a ON a.country_code = e.country_code AND a.year = year(e.local_date) WHERE {_IN_SPINE}".replace("SELECT country_code AS country_key", "SELECT e.country_code AS country_key"))
def fact_energy_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries, dates = dimensions(spark)
    fact = star.fact_energy_daily(demand(spark, sf_dir), price(spark, sf_dir), mix(spark, sf_dir), views.indicators(spark, sf_dir), countries, dates)
    return rounded(rounded(fact, *_FACT_COLUMNS, "demand_kwh_per_capita", digits=8), *_PER_YEAR, digits=6)


@query(f"WITH {_ZONES}, {_MIX}, t AS (SELECT country_code, local_date, sum(generation_mwh) AS total, bool_and(completeness_status = 'complete') AS whole FROM mix GROUP BY ALL) SELECT {_DIM}, normalized_production_type AS production_type, round(generation_mwh, 4) AS generation_mwh, renewable_flag, round(CASE WHEN whole AND total > 0 THEN generation_mwh / total * 100 END, 4) AS generation_share_pct FROM mix JOIN t USING (country_code, local_date) WHERE completeness_status = 'complete' AND {_IN_SPINE}")
def fact_mix_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(star.fact_generation_mix_daily(mix(spark, sf_dir), *dimensions(spark)), "generation_mwh", "generation_share_pct")


@query(
    f"""{_ENERGY}, parts AS (SELECT country_code, local_date, sum(generation_mwh) AS total, coalesce(sum(generation_mwh) FILTER (renewable_flag), 0) AS renewable FROM mix WHERE completeness_status = 'complete' AND normalized_production_type <> 'solar' GROUP BY ALL),
    pairs AS (SELECT country_code, local_date, 'total_generation_mwh' AS measure, total_generation_mwh AS a, total AS b FROM energy JOIN parts USING (country_code, local_date) UNION ALL SELECT country_code, local_date, 'renewable_generation_mwh', renewable_generation_mwh, renewable FROM energy JOIN parts USING (country_code, local_date))
    SELECT {_DIM}, measure, round(a, 4) AS left_value, round(b, 4) AS right_value FROM pairs WHERE abs(a - b) > 0.5 AND {_IN_SPINE}"""
)
def generation_off_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The energy fact against a mix fact that has lost its solar rows."""
    countries, dates = dimensions(spark)
    fact = star.fact_energy_daily(demand(spark, sf_dir), price(spark, sf_dir), mix(spark, sf_dir), views.indicators(spark, sf_dir), countries, dates)
    parts = star.fact_generation_mix_daily(mix(spark, sf_dir).filter("normalized_production_type != 'solar'"), countries, dates)
    return rounded(star.generation_off_mix(fact, parts), "left_value", "right_value")



_TALL = "tall AS (SELECT * FROM (SELECT 'C' || CAST(user_id % 3 AS VARCHAR) AS country_code, CAST(ts AS DATE) AS local_date, event_type AS source_variable, value, user_id, event_id FROM events) QUALIFY row_number() OVER (PARTITION BY country_code, local_date, source_variable ORDER BY event_id DESC) = 1)"
_WIDE = "wide AS (SELECT country_code, local_date, max(value) FILTER (source_variable = 'view') AS avg_temperature_c, max(value) FILTER (source_variable = 'click') AS avg_wind_speed_kmh, max(value) FILTER (source_variable = 'signup') AS solar_radiation_mj_m2 FROM tall GROUP BY ALL)"
_VARIABLES = {"view": "avg_temperature_c", "click": "avg_wind_speed_kmh", "signup": "solar_radiation_mj_m2"}


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.pivot_variables(views.variables_tall(spark, sf_dir), ["country_code", "local_date"], "source_variable", "value", _VARIABLES)


@query(f"WITH {_TALL}, {_WIDE} SELECT * FROM wide WHERE coalesce(avg_temperature_c, avg_wind_speed_kmh, solar_radiation_mj_m2) IS NOT NULL")
def pivot_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather(spark, sf_dir)


@query(f"WITH {_TALL} SELECT country_code, arg_max(user_id, (event_id)) AS user_id, max(event_id) AS event_id FROM tall GROUP BY country_code")
def reference_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    tall = views.variables_tall(spark, sf_dir).withColumn("latest", F.col("event_id"))
    return reshape.reference_row(tall, ["country_code"], ["user_id", "event_id"], "latest")


@query(f"WITH {_TALL}, {_WIDE} SELECT {_DIM}, avg_temperature_c, avg_wind_speed_kmh, solar_radiation_mj_m2 FROM wide WHERE {_IN_SPINE} AND coalesce(avg_temperature_c, avg_wind_speed_kmh, solar_radiation_mj_m2) IS NOT NULL")
def fact_weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_weather_daily(weather(spark, sf_dir), *dimensions(spark))


@query(f"{_ENERGY} SELECT e.country_code, e.local_date, population, gdp_constant_2015_usd FROM energy e LEFT JOIN annual a ON a.country_code = e.country_code AND a.year = year(e.local_date)")
def annual_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = energy(spark, sf_dir).select("country_code", "local_date")
    return star.with_annual(days, views.annual(spark, sf_dir))


@query(f"WITH {_ZONES}, {_MIX} SELECT country_code, local_date, normalized_production_type, CAST(generation_mwh AS DECIMAL(14,3)) AS generation_mwh FROM mix")
def serving_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving_projection(mix(spark, sf_dir).select("country_code", "local_date", "normalized_production_type", "generation_mwh"))


@query(f"WITH {_ZONES}, {_MIX}, t AS (SELECT country_code, local_date, sum(generation_mwh) AS total, bool_and(completeness_status = 'complete') AS whole FROM mix GROUP BY ALL) SELECT {_DIM}, normalized_production_type AS production_type, round(generation_mwh, 4) AS generation_mwh FROM mix JOIN t USING (country_code, local_date) WHERE completeness_status = 'complete' AND local_date BETWEEN DATE '{JANUARY[0]}' AND DATE '{JANUARY[1]}'")
def fact_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window of a fact that is published: its range of date keys."""
    facts = star.fact_generation_mix_daily(mix(spark, sf_dir), *dimensions(spark))
    return rounded(windows.date_key_range(facts, *JANUARY).select("country_key", "date_key", "production_type", "generation_mwh"), "generation_mwh")


# --- Revisions and merges --------------------------------------------------------------------

_LATEST = f"SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in LINE_COLUMNS)}) = 1"


@query(_LATEST)
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisions.latest_per_key(views.revisions(spark, sf_dir), LINE_KEYS, "l_shipdate", LINE_COLUMNS[1:])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisions.duplicate_keys(views.revisions(spark, sf_dir), LINE_KEYS)


_NULLED = "SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS flag, l_linestatus FROM lineitem"
#: Some flags are null and some empty: as keys, one value.
_KEYED = "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS flag, l_linestatus FROM lineitem"


def _nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.revisions(spark, sf_dir).select("l_orderkey", "l_linenumber", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"), "l_linestatus")


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).when(F.col("l_linestatus") != "O", "")
    return views.revisions(spark, sf_dir).select("l_orderkey", "l_linenumber", flag.alias("flag"), "l_linestatus")


@query(f"WITH s AS ({_KEYED}) SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM s l WHERE l.l_linestatus = 'O' AND l.l_orderkey = s.l_orderkey AND l.l_linenumber = s.l_linenumber AND coalesce(l.flag, '') = coalesce(s.flag, ''))")
def null_safe_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _keyed(spark, sf_dir)
    return revisions.missing_keys(staged, staged.filter("l_linestatus = 'O'").alias("loaded").select("*"), ["l_orderkey", "l_linenumber", "flag"])


@query(f"WITH s AS ({_KEYED}), l AS (SELECT DISTINCT l_orderkey, flag FROM s WHERE l_linestatus = 'O') SELECT l_linestatus, count(*) AS staged_rows, count(*) FILTER (NOT EXISTS (SELECT 1 FROM l WHERE l.l_orderkey = s.l_orderkey AND coalesce(l.flag, '') = coalesce(s.flag, ''))) AS missing_rows FROM s GROUP BY l_linestatus")
def missing_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _keyed(spark, sf_dir)
    return revisions.missing_by_source(staged, staged.filter("l_linestatus = 'O'"), ["l_orderkey", "flag"], "l_linestatus")


_SPLIT = dt.datetime(1998, 1, 1)
_TARGET = "target AS (SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"
_SOURCE = "source AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-02')"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    source = orders.filter(F.col("o_orderdate") >= F.lit(_SPLIT - dt.timedelta(days=30))).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return orders.filter(F.col("o_orderdate") < F.lit(_SPLIT)), source


@query(f"WITH {_TARGET}, {_SOURCE} SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM (SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey) UNION ALL SELECT * FROM source)")
def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _sides(spark, sf_dir)
    return rounded(revisions.merge_keyed(target, source, ["o_orderkey"]), "o_totalprice", digits=2).withColumn("o_orderdate", F.to_date("o_orderdate"))


@query(f"WITH {_TARGET}, {_SOURCE} SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM (SELECT *, 0 AS side FROM target UNION ALL SELECT *, 1 FROM source) QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY side DESC, o_orderdate DESC, o_totalprice DESC) = 1")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _sides(spark, sf_dir)
    return rounded(revisions.last_write_wins(target, source, ["o_orderkey"], "o_orderdate"), "o_totalprice", digits=2).withColumn("o_orderdate", F.to_date("o_orderdate"))


@query(f"WITH {_TARGET}, {_SOURCE} SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM (SELECT * FROM target WHERE o_orderdate NOT BETWEEN TIMESTAMP '1997-12-15' AND TIMESTAMP '1998-06-30' UNION ALL SELECT * FROM source WHERE o_orderkey % 3 = 0 AND o_orderdate BETWEEN TIMESTAMP '1997-12-15' AND TIMESTAMP '1998-06-30')")
def window_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _sides(spark, sf_dir)
    out = revisions.reconcile_window(target, source.filter("o_orderkey % 3 = 0"), "o_orderdate", F.lit(dt.datetime(1997, 12, 15)), F.lit(dt.datetime(1998, 6, 30)))
    return rounded(out, "o_totalprice", digits=2).withColumn("o_orderdate", F.to_date("o_orderdate"))


_TWO = "p AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, value FROM events WHERE event_id % 2 = 1 AND day(ts) % 2 = 0), a AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, value FROM events WHERE NOT (event_id % 2 = 1 AND day(ts) % 2 = 0))"


@query(
    f"""WITH {_TWO}, short AS (SELECT u.user_id FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT user_id, count(DISTINCT day) AS n FROM p GROUP BY user_id) c USING (user_id) WHERE coalesce(n, 0) < 15),
    u AS (SELECT *, 1 AS side FROM p UNION ALL SELECT *, 0 FROM a WHERE user_id IN (SELECT user_id FROM short))
    SELECT user_id, day, event_id, value FROM u QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY side DESC, event_id DESC) = 1"""
)
def fallback_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fallback(spark, sf_dir, 15)[0]


def _fallback(spark: SparkSession, sf_dir: str, days: int) -> tuple[DataFrame, DataFrame]:
    """Events of odd ids on even days come from the primary source, all others from the alternative."""
    rows = views.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "value")
    primary = (F.col("event_id") % 2 == 1) & (F.day("day") % 2 == 0)
    expected = rows.select("user_id").distinct().withColumn("expected", F.lit(days))
    return revisions.resolve_fallback(rows.filter(primary), rows.filter(~primary), ["user_id", "day"], ["user_id"], "day", expected, "event_id")


@query(
    f"""WITH {_TWO}, e AS (SELECT DISTINCT user_id FROM events), c AS (SELECT user_id, coalesce(n, 0) AS primary_days FROM e LEFT JOIN (SELECT user_id, count(DISTINCT day) AS n FROM p GROUP BY user_id) USING (user_id)),
    d AS (SELECT user_id, count(DISTINCT day) AS n, count(DISTINCT day) > count(DISTINCT CASE WHEN side = 1 THEN day END) AS other FROM (SELECT user_id, day, 1 AS side FROM p UNION ALL SELECT user_id, day, 0 FROM a) GROUP BY user_id),
    f AS (SELECT user_id, primary_days, CASE WHEN primary_days < 18 THEN coalesce(n, 0) ELSE primary_days END AS days, primary_days < 18 AND coalesce(other, FALSE) AS other FROM c LEFT JOIN d USING (user_id))
    SELECT user_id, CASE WHEN days >= 18 THEN 'success' WHEN days = 0 THEN 'unavailable' ELSE 'failed' END AS status, CASE WHEN other AND primary_days > 0 THEN 'both' WHEN other THEN 'alternative' WHEN primary_days > 0 THEN 'primary' ELSE 'none' END AS served_by, CAST(18 AS INT) AS expected, primary_days, days FROM f"""
)
def fallback_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's coverage of 18 days, judged again once the alternative has been asked."""
    return _fallback(spark, sf_dir, 18)[1]


_FLAGS = "SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag, sum(l_quantity) AS quantity FROM lineitem WHERE l_linestatus = '{}' GROUP BY ALL"


@query(f"WITH t AS ({_FLAGS.format('O')}), s AS ({_FLAGS.format('F')}) SELECT l_orderkey, flag, round(quantity, 2) AS quantity FROM (SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = t.l_orderkey AND s.flag = t.flag) UNION ALL SELECT * FROM s)")
def plain_key_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge by plain keys: null flags match nothing, so both sides' rows stay."""
    flags = views.table(spark, sf_dir, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    sums = {s: flags.filter(F.col("l_linestatus") == s).groupBy("l_orderkey", "flag").agg(F.sum("l_quantity").alias("quantity")) for s in "OF"}
    return rounded(revisions.merge_keyed(sums["O"], sums["F"], ["l_orderkey", "flag"], null_safe=False), "quantity", digits=2)


# --- Written and read again: new folders beside the tables of the warehouse ------------------


def _new_folder(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_written/{uuid.uuid4().hex}"


@query(f"WITH {_TARGET}, {_SOURCE} SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM (SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey) UNION ALL SELECT * FROM source)")
def merged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version of a table and the next one, merged with newer rows."""
    target, source = _sides(spark, sf_dir)
    first, second = _new_folder(spark), _new_folder(spark)
    write_merged(spark, target, ["o_orderkey"], first)
    write_merged(spark, source, ["o_orderkey"], second, first)
    merged = tables.read_batch(spark, second, target.schema)
    return rounded(merged, "o_totalprice", digits=2).withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def month_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders laid out by year and month, read again by a recursive scan as the owned schema."""
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"))
    path = _new_folder(spark)
    write_by_month(orders, path, "o_orderdate")
    return rounded(tables.read_batch(spark, path, orders.schema, recursive=True), "o_totalprice", digits=2)


_ORDER_KEYS = ["o_orderkey", "o_orderdate", "flag"]
_FLAGGED = "SELECT o_orderkey, round(o_totalprice + {}, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, CASE WHEN o_orderstatus = 'F' THEN {} ELSE o_orderstatus END AS flag FROM orders"
_MERGED_MONTHS = f"""WITH target AS ({_FLAGGED.format(0, "NULL")}), source AS ({_FLAGGED.format(1, "''")} WHERE o_orderdate BETWEEN TIMESTAMP '1995-03-10' AND TIMESTAMP '1995-06-20')
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey AND s.o_orderdate = t.o_orderdate AND coalesce(s.flag, '') = coalesce(t.flag, '')) UNION ALL SELECT * FROM source"""


def _flagged(spark: SparkSession, sf_dir: str, more: int, missing: str | None) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "F", F.lit(missing).cast("string")).otherwise(F.col("o_orderstatus"))
    return views.table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.col("o_totalprice") + more, 2).alias("o_totalprice"), F.to_date("o_orderdate").alias("o_orderdate"), flag.alias("flag"))


@query(_MERGED_MONTHS)
def merged_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of changed orders merged into a layout by month; only its months are rewritten. The
    old rows' flags are null where the new ones' are empty: one key."""
    target, path = _flagged(spark, sf_dir, 0, None), _new_folder(spark)
    write_by_month(target, path, "o_orderdate")
    merge_months(_flagged(spark, sf_dir, 1, "").filter("o_orderdate between date'1995-03-10' and date'1995-06-20'"), path, _ORDER_KEYS, "o_orderdate")
    return tables.read_batch(spark, path, target.schema, recursive=True)


@query(
    """SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1997-12-15'
    UNION ALL SELECT o_orderkey, round(o_totalprice + 1, 2), CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate >= TIMESTAMP '1997-12-15' AND o_orderdate < TIMESTAMP '1998-07-01' AND o_orderpriority <> '5-LOW'"""
)
def window_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored window replaced: orders of low priority have vanished upstream."""
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority")
    source = orders.filter("o_orderdate >= date'1997-12-02' and o_orderpriority <> '5-LOW'").withColumn("o_totalprice", F.col("o_totalprice") + 1).drop("o_orderpriority")
    target, folder = orders.filter("o_orderdate < date'1998-01-01'").drop("o_orderpriority"), _new_folder(spark)
    log = f"{folder}/versions"
    versions.put_months(spark, log, f"{folder}/data", "orders", target, "o_orderdate", None)
    versions.replace_window(spark, log, f"{folder}/data", "orders", source, "o_orderdate", dt.date(1997, 12, 15), dt.date(1998, 6, 30))
    return rounded(versions.read_version(spark, log, "orders", target.schema), "o_totalprice", digits=2)


@query(f"WITH {_TARGET}, {_SOURCE} SELECT 'orders' AS table_name, 'published' AS status, count(*) AS source_rows, count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01') AS replaced_rows, count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS inserted_rows, CAST(NULL AS VARCHAR) AS error FROM source UNION ALL SELECT 'repeated_orders', 'failed', NULL, NULL, NULL, 'ValueError'")
def publish_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each published table: rows replaced and inserted, or the kind of failure."""
    target, source = _sides(spark, sf_dir)
    folder, keys = _new_folder(spark), ["o_orderkey", "o_orderdate"]
    log, data = f"{folder}/versions", f"{folder}/data"
    versions.publish_versions(spark, log, data, {"orders": (target, keys, "o_orderdate")})
    return versions.publish_versions(spark, log, data, {"repeated_orders": (source.unionByName(source), keys, "o_orderdate"), "orders": (source, keys, "o_orderdate")})


@query("SELECT CAST(year(o_orderdate) AS INT) AS batch FROM orders GROUP BY ALL ORDER BY count(*) DESC, batch LIMIT 1")
def changed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a batch of files a year, the state of their files stored, and the largest
    year written again: only that one is to be loaded."""
    orders = views.table(spark, sf_dir, "orders").withColumn("batch", F.year("o_orderdate"))
    path = _new_folder(spark)
    lists = lambda: tables.listed_files(spark, f"{path}/data", "*.parquet").withColumn("batch", F.regexp_extract("path", r"batch=(\d+)/", 1).cast("int"))
    orders.write.partitionBy("batch").parquet(f"{path}/data")
    completeness.file_prints(lists()).write.parquet(f"{path}/state")
    largest = orders.groupBy("batch").count().orderBy(F.desc("count"), "batch").limit(1).select("batch")
    orders.join(F.broadcast(largest), "batch", "left_semi").write.mode("append").partitionBy("batch").parquet(f"{path}/data")
    return completeness.batches_to_load(lists(), spark.read.parquet(f"{path}/state"))


@query("SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey")
def rebuilt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the catalog, rebuilt in full and read by its name."""
    spent = views.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("double").alias("spent"))
    name = f"customer_orders_{uuid.uuid4().hex}"  # an older session's table may lie in the warehouse
    rebuild(spent, name)
    return tables.read_table(spark, name)


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations written as CSV with a header and read as a seed."""
    nations = views.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    path = _new_folder(spark)
    nations.write.csv(path, header=True)
    return tables.read_seed(spark, path, nations.schema)


# --- Coverage and state ----------------------------------------------------------------------


@query("SELECT user_id, date_trunc('month', d)::DATE AS month_start, CAST(count(*) AS INT) AS covered_days, day(last_day(date_trunc('month', d)::DATE)) AS expected_days, day(last_day(date_trunc('month', d)::DATE)) - CAST(count(*) AS INT) AS missing_days, CASE WHEN count(*) = day(last_day(date_trunc('month', d)::DATE)) THEN 'success' ELSE 'failed' END AS status FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) GROUP BY user_id, date_trunc('month', d)::DATE")
def month_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = completeness.month_coverage(views.table(spark, sf_dir, "events"), ["user_id"], "ts")
    return found.withColumn("status", completeness.coverage_status(F.col("covered_days"), F.col("expected_days"), F.lit(False)))


@query(
    """WITH c AS (SELECT event_type, date_trunc('month', d)::DATE AS month_start, CAST(count(*) AS INT) AS covered FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events) GROUP BY ALL),
    e AS (SELECT event_type, m::DATE AS month_start, day(last_day(m::DATE)) AS expected_days FROM (SELECT DISTINCT event_type FROM events), unnest(generate_series(DATE '2023-12-01', DATE '2024-02-01', INTERVAL 1 MONTH)) AS t(m))
    SELECT event_type, month_start, coalesce(covered, 0) AS covered_days, expected_days, expected_days - coalesce(covered, 0) AS missing_days,
      CASE WHEN coalesce(covered, 0) = expected_days THEN 'success' WHEN coalesce(covered, 0) = 0 AND month_start < DATE '2024-01-01' THEN 'unavailable' ELSE 'failed' END AS status
    FROM e LEFT JOIN c USING (event_type, month_start)"""
)
def every_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months without a day are unavailable where the source says so (before 2024), else failed."""
    events = views.table(spark, sf_dir, "events")
    found = completeness.every_month(completeness.month_coverage(events, ["event_type"], "ts"), events.select("event_type"), dt.date(2023, 12, 1), dt.date(2024, 2, 29))
    no_data = F.col("month_start") < F.lit(dt.date(2024, 1, 1))
    return found.withColumn("status", completeness.coverage_status(F.col("covered_days"), F.col("expected_days"), no_data))


@query(
    """WITH l AS (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) - INTERVAL 1 MONTH AS latest FROM orders),
    m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders, l WHERE date_trunc('month', o_orderdate) <= latest),
    c AS (SELECT month_start, CAST(unnest(generate_series(month_start - INTERVAL 2 DAYS, last_day(month_start) + INTERVAL 2 DAYS, INTERVAL 10 DAYS)) AS DATE) AS chunk_start FROM m)
    SELECT month_start, chunk_start, CAST(least(chunk_start + 9, last_day(month_start) + 2) AS DATE) AS chunk_end FROM c"""
)
def month_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of at most ten days to ask for each month with orders up to the last complete one,
    padded by two days."""
    orders = views.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    latest = orders.agg(windows.last_complete_month(F.max("day")).alias("latest"))
    months = orders.select(F.trunc("day", "month").cast("date").alias("month_start")).distinct().join(F.broadcast(latest), F.col("month_start") <= F.col("latest")).drop("latest")
    return windows.month_chunks(months, "month_start", buffer_days=2, chunk_days=10)


_ATTEMPTS = "SELECT user_id AS combo, event_id AS seq, CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'reset' WHEN 'purchase' THEN 'unavailable' WHEN 'view' THEN 'failed' ELSE 'success' END AS status FROM events"
_FOLD = f"""
WITH RECURSIVE log AS (SELECT combo, status, row_number() OVER (PARTITION BY combo ORDER BY seq) AS k FROM ({_ATTEMPTS})),
fold AS (
  SELECT combo, 0::BIGINT AS k, NULL::VARCHAR AS status, 0 AS attempts FROM (SELECT DISTINCT combo FROM log)
  UNION ALL
  SELECT f.combo, l.k,
    CASE WHEN l.status = 'reset' THEN 'failed' WHEN l.status = 'failed' AND NOT coalesce(f.status IN ('success', 'unavailable', 'given_up'), FALSE) AND f.attempts + 1 >= 3 THEN 'given_up' ELSE l.status END,
    CASE WHEN l.status = 'reset' THEN 0 WHEN coalesce(f.status IN ('success', 'unavailable', 'given_up'), FALSE) THEN f.attempts ELSE f.attempts + 1 END
  FROM fold f JOIN log l ON l.combo = f.combo AND l.k = f.k + 1
), state AS (SELECT combo, status, attempts FROM fold QUALIFY row_number() OVER (PARTITION BY combo ORDER BY k DESC) = 1)
"""


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness.fold_attempts(views.attempts(spark, sf_dir), ["combo"], "at", "status")


@query(_FOLD + "SELECT combo, status, attempts FROM state")
def attempt_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(spark, sf_dir)


@query(_FOLD + "SELECT status, count(*) AS n_rows FROM state GROUP BY status")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness.status_counts(_state(spark, sf_dir))


@query(_FOLD + "SELECT combo, status, attempts FROM state WHERE status NOT IN ('success', 'unavailable', 'given_up')")
def pending_combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness.pending(_state(spark, sf_dir))


@query(_FOLD + "SELECT combo % 10 AS month_group, bool_and(status IN ('success', 'unavailable', 'given_up')) AS is_done FROM state GROUP BY combo % 10")
def groups_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness.groups_done(_state(spark, sf_dir).withColumn("month_group", F.col("combo") % 10), ["month_group"])


@query(_FOLD + "SELECT combo, status, attempts FROM state ORDER BY status, combo")
def listed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completeness.listed_states(_state(spark, sf_dir), ["combo"])


@query(f"SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{JANUARY[0]}' AND DATE '{JANUARY[1]}'")
def points_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.trim_to_days(views.table(spark, sf_dir, "events"), "ts", *JANUARY).select("event_id", "user_id", "value")


_OUTCOMES = "SELECT user_id AS country_code, event_type AS dataset, CASE WHEN value > 280 THEN 'success' WHEN value > 20 THEN 'unavailable' ELSE 'failed' END AS status FROM events"


@query(
    f"""WITH o AS ({_OUTCOMES}), r(dataset) AS (VALUES ('click'), ('signup'), ('view')),
    d AS (SELECT c.country_code, r.dataset, coalesce(bool_or(status = 'success'), FALSE) AS won, coalesce(bool_or(status = 'failed'), FALSE) AS lost
      FROM (SELECT DISTINCT country_code FROM o) c, r LEFT JOIN o ON o.country_code = c.country_code AND o.dataset = r.dataset GROUP BY ALL)
    SELECT country_code, CASE WHEN count(*) FILTER (won) = 3 THEN 'complete' WHEN count(*) FILTER (won) > 0 THEN 'partially_available' WHEN count(*) FILTER (lost) > 0 THEN 'failed' ELSE 'unavailable' END AS availability,
    coalesce(string_agg(dataset, ',' ORDER BY dataset) FILTER (NOT won), '') AS missing_datasets FROM d GROUP BY country_code"""
)
def availability_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("value") > 280, "success").when(F.col("value") > 20, "unavailable").otherwise("failed")
    outcomes = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("country_code"), F.col("event_type").alias("dataset"), status.alias("status"))
    return completeness.availability(outcomes, ["view", "click", "signup"])


@query(
    f"""SELECT country_code, CASE WHEN bool_or(dataset = 'click' AND status = 'success') THEN 'complete' WHEN bool_or(dataset = 'click' AND status = 'failed') THEN 'failed' ELSE 'unavailable' END AS availability,
    CASE WHEN bool_or(dataset = 'click' AND status = 'success') THEN '' ELSE 'click' END AS missing_datasets FROM ({_OUTCOMES}) GROUP BY country_code"""
)
def single_dataset_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("value") > 280, "success").when(F.col("value") > 20, "unavailable").otherwise("failed")
    outcomes = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("country_code"), F.col("event_type").alias("dataset"), status.alias("status"))
    return completeness.availability(outcomes, ["click"])


@query("WITH s AS (SELECT DISTINCT user_id, time_bucket(INTERVAL 3 HOURS, ts) AS slot FROM events), b AS (SELECT *, lag(slot) OVER (PARTITION BY user_id ORDER BY slot) AS before FROM s) SELECT user_id, before + INTERVAL 3 HOURS AS gap_start, CAST((epoch(slot) - epoch(before)) / 10800 - 1 AS BIGINT) AS missing_slots FROM b WHERE epoch(slot) - epoch(before) > 10800")
def timeline_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = views.table(spark, sf_dir, "events").select("user_id", views.floor_to(F.col("ts").cast("timestamp"), 10_800).alias("slot"))
    return completeness.timeline_gaps(slots, ["user_id"], "slot", 10_800).withColumn("gap_start", F.col("gap_start").cast("timestamp_ntz"))


@query("WITH i AS (SELECT user_id, event_id, ts AS begins, ts + to_minutes(CAST(30 + event_id % 600 AS INT)) AS ends FROM events) SELECT user_id, event_id FROM i QUALIFY begins < max(ends) OVER (PARTITION BY user_id ORDER BY begins, ends ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def overlapping_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = F.expr("ts + make_dt_interval(0, 0, cast(30 + event_id % 600 as int), 0)")
    rows = views.table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("begins"), ends.alias("ends"))
    return completeness.overlaps(rows, ["user_id"], "begins", "ends").select("user_id", "event_id")


_OVERLAPPING = _OBS.replace("time_bucket(to_minutes(minutes), ts) AS slot", "time_bucket(INTERVAL 15 MINUTES, ts) AS slot")


@query(
    f"""WITH {_OVERLAPPING}, valid AS (
      SELECT *, coalesce(max(slot + to_minutes(minutes)) OVER (PARTITION BY country_code, source_resolution ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), slot) AS before FROM local WHERE value >= 0),
    clipped AS (SELECT *, greatest(0, least(hours, (epoch(slot + to_minutes(minutes)) - epoch(greatest(slot, before))) / 3600.0)) AS own FROM valid),
    best AS (SELECT * FROM clipped WHERE own > 0 QUALIFY hours = CASE WHEN max(CAST(hours = 1 AS INT)) OVER (PARTITION BY country_code, local_date) = 1 THEN 1 ELSE min(hours) OVER (PARTITION BY country_code, local_date) END)
    SELECT country_code, local_date, round(energy, 4) AS daily_demand_mwh, n AS source_interval_count, round(covered, 4) AS covered_duration_hours, {_STATUS} AS completeness_status
    FROM (SELECT country_code, local_date, sum(value * own) AS energy, count(*) AS n, sum(own) AS covered FROM best GROUP BY ALL) d JOIN zones z USING (country_code)"""
)
def demand_of_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily demand of readings that begin every quarter of an hour, whatever their length: what an
    earlier reading has covered does not count again."""
    obs = views.obs_load(spark, sf_dir, slot_seconds=900)
    return rounded(intervals.daily_demand(obs, views.zones(spark)), "daily_demand_mwh", "covered_duration_hours")


@query(
    f"""WITH {_OVERLAPPING}, own AS (SELECT * FROM local WHERE country_code <> 'C1'), valid AS (
      SELECT *, coalesce(max(slot + to_minutes(minutes)) OVER (PARTITION BY country_code, source_resolution ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), slot) AS before FROM own WHERE value >= 0),
    clipped AS (SELECT *, greatest(0, least(hours, (epoch(slot + to_minutes(minutes)) - epoch(greatest(slot, before))) / 3600.0)) AS rest FROM valid),
    best AS (SELECT * FROM clipped WHERE rest > 0 QUALIFY hours = CASE WHEN max(CAST(hours = 1 AS INT)) OVER (PARTITION BY country_code, local_date) = 1 THEN 1 ELSE min(hours) OVER (PARTITION BY country_code, local_date) END),
    sums AS (SELECT country_code, local_date, count(*) AS n, sum(rest) AS covered FROM best GROUP BY ALL),
    days AS (SELECT country_code, local_date, n, {_STATUS} AS status FROM sums JOIN zones z USING (country_code)),
    c AS (SELECT (SELECT count(*) FROM obs) AS received, (SELECT count(*) FROM obs WHERE country_code <> 'C1') AS placed, (SELECT count(*) FROM own) AS cur)
    SELECT received AS rows_received, received - placed AS rows_unplaced, placed - cur AS duplicates_removed, cur - (SELECT count(*) FROM valid) AS rows_rejected, (SELECT count(*) FROM clipped WHERE rest < hours) AS overlaps_detected,
      CAST(sum(n) AS BIGINT) AS rows_used, count(*) AS days_written, count(*) FILTER (status = 'partial') AS partial_days, min(local_date) AS first_date, max(local_date) AS last_date FROM days, c GROUP BY received, placed, cur"""
)
def observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rollup of overlapping readings counted while it was written; one country has no zone."""
    watch = observed.Watch()
    zones = views.zones(spark).filter("country_code != 'C1'")
    intervals.daily_demand(views.obs_load(spark, sf_dir, slot_seconds=900), zones, watch=watch).write.parquet(_new_folder(spark))
    return intervals.rollup_metrics(spark, watch)


_GAP_DAYS = (dt.date(2024, 3, 12), dt.date(2024, 4, 18))
_UTC_MIDNIGHT = "timezone('UTC', timezone(timezone, CAST({} AS TIMESTAMP)))"


@query(
    f"""WITH {_ZONES}, users AS (SELECT DISTINCT user_id, timezone FROM events JOIN zones ON country_code = 'C' || CAST(user_id % 3 AS VARCHAR)),
    r AS (SELECT user_id, timezone, time_bucket(INTERVAL 15 MINUTES, ts) + INTERVAL 75 DAYS AS s, CASE WHEN user_id % 3 = 2 AND user_id % 2 = 0 THEN 15 WHEN user_id % 3 = 2 OR user_id % 7 = 0 THEN 30 ELSE 60 END AS minutes FROM events JOIN users USING (user_id)),
    t AS (SELECT *, s + to_minutes(minutes) AS e FROM r),
    spread AS (SELECT user_id, timezone, CAST(unnest(generate_series(CAST(timezone(timezone, timezone('UTC', s)) AS DATE), CAST(timezone(timezone, timezone('UTC', e - INTERVAL 1 MICROSECOND)) AS DATE), INTERVAL 1 DAY)) AS DATE) AS local_date, s, e, FALSE AS at_end FROM t),
    days AS (SELECT user_id, timezone, CAST(d AS DATE) AS local_date FROM users, generate_series(DATE '{_GAP_DAYS[0]}', DATE '{_GAP_DAYS[1]}', INTERVAL 1 DAY) AS g(d)),
    every AS (SELECT * FROM spread UNION ALL SELECT user_id, timezone, local_date, {_UTC_MIDNIGHT.format("local_date + 1")}, {_UTC_MIDNIGHT.format("local_date + 1")}, TRUE FROM days),
    m AS (SELECT *, max(e) OVER (PARTITION BY user_id, local_date ORDER BY s, at_end, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, {_UTC_MIDNIGHT.format("local_date")} AS first, {_UTC_MIDNIGHT.format("local_date + 1")} AS last FROM every),
    g AS (SELECT user_id, local_date, greatest(first, coalesce(before, first)) AS gap_start, least(s, last) AS gap_end FROM m WHERE local_date BETWEEN DATE '{_GAP_DAYS[0]}' AND DATE '{_GAP_DAYS[1]}')
    SELECT user_id, local_date, gap_start, gap_end, round((epoch(gap_end) - epoch(gap_start)) / 3600.0, 4) AS gap_hours FROM g WHERE gap_end > gap_start"""
)
def local_day_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user's readings, of three lengths and moved to the spring, leave open of the local
    days of five weeks with a day of 23 hours. The users are few bytes, which adaptive execution would
    put into one task, so they are dealt out by number before each becomes all its days."""
    obs = views.obs_load(spark, sf_dir, slot_seconds=900, columns=["user_id"]).join(F.broadcast(views.zones(spark)), "country_code")
    readings = obs.select("user_id", (F.col("slot") + F.expr("interval 75 days")).alias("slot"), duration_hours(F.col("source_resolution")).alias("hours"))
    users = obs.select("user_id", "timezone").distinct().repartition(2 * spark.sparkContext.defaultParallelism)
    days = users.withColumn("local_date", F.explode(F.sequence(F.lit(_GAP_DAYS[0]), F.lit(_GAP_DAYS[1]))))
    found = intervals.local_day_gaps(readings, days, ["user_id"], "slot", "hours")
    return rounded(found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("gap_start", "gap_end")}), "gap_hours")


@query("WITH f AS (SELECT CAST(year(o_orderdate) AS INT) AS batch, CAST(month(o_orderdate) AS VARCHAR) AS path, count(*) AS length FROM orders GROUP BY ALL), g AS (SELECT CAST(year(o_orderdate) AS INT) AS batch, CAST(month(o_orderdate) AS VARCHAR) AS path, count(*) AS length FROM orders WHERE o_orderdate < TIMESTAMP '1997-06-15' GROUP BY ALL), a AS (SELECT batch, list_sort(list(path || ':' || length)) AS files FROM f GROUP BY batch), b AS (SELECT batch, list_sort(list(path || ':' || length)) AS files FROM g GROUP BY batch) SELECT a.batch FROM a LEFT JOIN b ON a.batch = b.batch AND a.files = b.files WHERE b.batch IS NULL")
def batches_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    def files(orders: DataFrame) -> DataFrame:
        return orders.groupBy(F.year("o_orderdate").alias("batch"), F.month("o_orderdate").cast("string").alias("path")).agg(F.count(F.lit(1)).alias("length"))

    orders = views.table(spark, sf_dir, "orders")
    return completeness.batches_to_load(files(orders), files(orders.filter("o_orderdate < timestamp_ntz'1997-06-15'")))


# --- Lookups and quality ---------------------------------------------------------------------


@query(f"WITH {_ZONES}, {_MIX} SELECT code AS raw_code, count(*) AS n_rows FROM raw WHERE code = 'B99' GROUP BY code")
def unknown_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.unknown_codes(views.obs_mix(spark, sf_dir))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def orphan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = views.table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return quality.orphans(views.table(spark, sf_dir, "orders"), customers, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("SELECT 'flag' AS column_name, count(*) FILTER (l_returnflag = 'N') AS n_failed FROM lineitem UNION ALL SELECT 'l_orderkey', count(*) FILTER (l_orderkey IS NULL) FROM lineitem")
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_violations(_nulled(spark, sf_dir), ["flag", "l_orderkey"])


@query("SELECT l_orderkey, l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_combination(views.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45")
def accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_range(views.table(spark, sf_dir, "lineitem"), "l_quantity", 5, 45).select("l_orderkey", "l_linenumber", "l_quantity")


@query("WITH l AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS left_value FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey AS k, o_totalprice AS right_value FROM orders) SELECT k, left_value, right_value FROM l JOIN o USING (k) WHERE abs(left_value - right_value) > 0.5")
def reconcile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("v"))
    orders = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    return quality.reconcile(lines, orders, ["k"], "v", "v")


@query(f"WITH {_ZONES}, {_MIX}, t AS (SELECT country_code, local_date, sum(generation_mwh) AS total FROM mix GROUP BY ALL), s AS (SELECT country_code, local_date, sum(generation_mwh / total * 100) AS share_total FROM mix JOIN t USING (country_code, local_date) WHERE normalized_production_type <> 'gas' GROUP BY ALL) SELECT country_code, local_date, round(share_total, 4) AS share_total FROM s WHERE abs(share_total - 100) > 0.5")
def share_sums_to_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose shares without gas do not add up to 100."""
    rows = mix(spark, sf_dir)
    totals = rows.groupBy("country_code", "local_date").agg(F.sum("generation_mwh").alias("total"))
    shares = rows.join(totals, ["country_code", "local_date"]).filter("normalized_production_type != 'gas'").withColumn("share", F.col("generation_mwh") / F.col("total") * 100)
    return rounded(quality.shares_off_total(shares, ["country_code", "local_date"], "share"), "share_total")


@query("SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN 'price' ELSE 'status' END AS rule, CASE WHEN o_totalprice < 1000 THEN 'price too low' ELSE 'status not known' END AS reason FROM orders WHERE o_totalprice < 1000 OR o_orderstatus NOT IN ('F', 'O')")
def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"price": (F.col("o_totalprice") >= 1000, "price too low"), "status": (F.col("o_orderstatus").isin("F", "O"), "status not known")}
    return quality.quarantine(views.table(spark, sf_dir, "orders"), rules)[1].select("o_orderkey", "rule", "reason")


_RULES = [("price", "o_totalprice >= 100000", "price too low"), ("status", "o_orderstatus IN ('F', 'O')", "status not known"), ("priority", "o_orderpriority <> '5-LOW'", "priority too low")]


@query(" UNION ALL ".join(f"SELECT 'orders' AS source_system, CAST(o_custkey AS VARCHAR) AS country, 'price' AS dataset, CAST(o_orderdate AS DATE) AS processing_date, o_orderkey AS record_id, o_orderdate AS ingested_at, '{name}' AS rule, '{reason}' AS reason FROM orders WHERE NOT coalesce({good}, FALSE)" for name, good, reason in _RULES))
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and rejected orders written in one pass; of the rejected ones a row for each rule that
    they fail."""
    path = _new_folder(spark)
    write_by_outcome(quality.judged(views.table(spark, sf_dir, "orders"), {name: (F.expr(good), reason) for name, good, reason in _RULES}), path)
    rejected = spark.read.parquet(path).filter("outcome = 'rejected'")
    return quality.rejections(rejected, source_system=F.lit("orders"), country=F.col("o_custkey").cast("string"), dataset=F.lit("price"), processing_date=F.to_date("o_orderdate"), record_id=F.col("o_orderkey"), ingested_at=F.col("o_orderdate"))


def _shown_keys() -> Column:
    shown = F.transform("sample_keys", lambda k: F.concat_ws(":", k["l_orderkey"].cast("string"), F.coalesce(k["flag"], F.lit("-"))))
    return F.array_join(shown, ",")


@query(
    f"""WITH s AS ({_KEYED}), l AS (SELECT DISTINCT l_orderkey, coalesce(flag, '') AS flag FROM s WHERE l_linestatus = 'O'),
    m AS (SELECT s.*, l.l_orderkey IS NULL AS missing FROM s LEFT JOIN l ON l.l_orderkey = s.l_orderkey AND l.flag = coalesce(s.flag, '')),
    k AS (SELECT * FROM (SELECT DISTINCT l_linestatus, l_orderkey, flag FROM m WHERE missing) QUALIFY row_number() OVER (PARTITION BY l_linestatus ORDER BY l_orderkey, flag NULLS FIRST) <= 5)
    SELECT l_linestatus, CASE WHEN missing_rows > 0 THEN 'missing_rows' ELSE 'verified' END AS status, staged_rows, missing_rows, sample_keys
    FROM (SELECT l_linestatus, count(*) AS staged_rows, count(*) FILTER (missing) AS missing_rows FROM m GROUP BY l_linestatus)
    LEFT JOIN (SELECT l_linestatus, string_agg(l_orderkey || ':' || coalesce(flag, '-'), ',' ORDER BY l_orderkey, flag NULLS FIRST) AS sample_keys FROM k GROUP BY l_linestatus) USING (l_linestatus)"""
)
def verified_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against the loaded ones: a verdict for each source, with the first missing keys."""
    staged = _keyed(spark, sf_dir)
    found = revisions.verify_loaded(staged, staged.filter("l_linestatus = 'O'"), ["l_orderkey", "flag"], "l_linestatus")
    return found.withColumn("sample_keys", _shown_keys())


@query(
    f"""WITH s AS ({_KEYED}), k AS (SELECT * FROM (SELECT DISTINCT l_linestatus, l_orderkey, flag FROM s) QUALIFY row_number() OVER (PARTITION BY l_linestatus ORDER BY l_orderkey, flag NULLS FIRST) <= 5)
    SELECT l_linestatus, 'no_table' AS status, staged_rows, staged_rows AS missing_rows, sample_keys FROM (SELECT l_linestatus, count(*) AS staged_rows FROM s GROUP BY l_linestatus)
    JOIN (SELECT l_linestatus, string_agg(l_orderkey || ':' || coalesce(flag, '-'), ',' ORDER BY l_orderkey, flag NULLS FIRST) AS sample_keys FROM k GROUP BY l_linestatus) USING (l_linestatus)"""
)
def verified_without_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose table was never made: told for each source, not an error."""
    loaded = tables.read_table(spark, f"never_made_{uuid.uuid4().hex}", optional=True)
    found = revisions.verify_loaded(_keyed(spark, sf_dir), loaded, ["l_orderkey", "flag"], "l_linestatus")
    return found.withColumn("sample_keys", _shown_keys())


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click')")
def unknown_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = spark.createDataFrame([("view",), ("click",)], "event_type string")
    return quality.unknown_units(views.table(spark, sf_dir, "events"), allowed, ["event_type"]).select("event_id", "event_type")


@query("SELECT event_id, value, CASE event_type WHEN 'view' THEN 'warn' ELSE 'reject' END AS action FROM events WHERE (event_type = 'view' AND value > 200) OR (event_type = 'click' AND (value < 1 OR value > 150))")
def implausible_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = spark.createDataFrame([("view", None, 200.0, "warn"), ("click", 1.0, 150.0, "reject")], "variable string, low double, high double, action string")
    return quality.implausible(views.table(spark, sf_dir, "events"), bounds, "event_type", "value").select("event_id", "value", "action")


@query(f"WITH s AS ({_NULLED}), k AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (flag IS NULL) AS z FROM s GROUP BY ALL) SELECT CAST(sum(n) AS BIGINT) AS rows_received, CAST(sum(n - 1) AS BIGINT) AS duplicates_removed, CAST(sum(z) AS BIGINT) AS rows_with_nulls, CAST(0 AS BIGINT) AS partial_rows FROM k")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_metrics(_nulled(spark, sf_dir), LINE_KEYS, ["flag"])


@query(f"WITH {_OBS}, {_preferred('value >= 0')}, {_DEMAND} SELECT max(local_date) AS latest_date, max(local_date) FILTER (completeness_status = 'complete') AS latest_complete_date, CAST(max(local_date) - max(local_date) FILTER (completeness_status = 'complete') AS INT) AS days_behind FROM demand")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(demand(spark, sf_dir), "local_date", "completeness_status")


_RUNS = {1: "2024-01-19 00:00:00", 2: "2024-01-31 00:00:00"}
_MARKS = f"""runs(run, moment) AS (VALUES (1, TIMESTAMP '{_RUNS[1]}'), (2, TIMESTAMP '{_RUNS[2]}')),
    seen AS (SELECT run, moment, event_type AS source, ts, CAST(date_trunc('day', ts) AS TIMESTAMP) AS d FROM events, runs WHERE ts < moment AND (event_type <> 'signup' OR ts < TIMESTAMP '{_RUNS[1]}')),
    daily AS (SELECT run, moment, source, d, count(DISTINCT hour(ts)) >= 6 AS whole FROM seen GROUP BY ALL),
    marks AS (
      SELECT source, 'raw' AS layer, run, unnest(['executed', 'ingested', 'data']) AS event, unnest([CASE WHEN run = 1 OR source <> 'error' THEN moment END, max(ts), max(d)]) AS moment FROM seen GROUP BY source, run, seen.moment
      UNION ALL SELECT source, 'daily', run, unnest(['executed', 'complete', 'published']), unnest([CASE WHEN run = 1 OR source <> 'error' THEN moment END, max(d) FILTER (whole), CASE WHEN source <> 'click' THEN moment + INTERVAL 1 HOUR END]) FROM daily GROUP BY source, run, daily.moment)"""
_FRESH = """WITH {marks}, folded AS (
      SELECT {by}, {moment}, max(moment) FILTER (run < 2 AND event = 'data') AS data_before, max(moment) FILTER (run < 2 AND event = 'complete') AS complete_before, count(*) FILTER (run = 2 AND event = 'executed' AND moment IS NOT NULL) > 0 AS ran FROM marks GROUP BY {by}),
    told AS (SELECT *, coalesce(complete_at, data_at) AS usable, CASE WHEN complete_at IS NULL THEN data_before ELSE complete_before END AS usable_before FROM folded)
    SELECT {by}, executed_at, ingested_at, data_at, complete_at, published_at, usable_before, CAST(date_diff('day', usable, executed_at) AS INT) AS days_behind,
      CASE WHEN NOT ran THEN 'not_executed' WHEN usable IS NULL THEN 'empty' WHEN usable <= usable_before THEN 'stale' ELSE 'advanced' END AS status FROM told"""
_EVENTS_AT = ", ".join(f"max(moment) FILTER (event = '{e}') AS {e}_at" for e in quality.EVENTS)


def _fresh(spark: SparkSession, sf_dir: str, by: list[str]) -> DataFrame:
    """Two runs over the events append their watermarks to one table; then the second is judged.
    Signups stop to arrive after the first; the second does not run for errors."""
    path = _new_folder(spark)
    for run, text in _RUNS.items():
        at = F.to_timestamp(F.lit(text))
        seen = views._events(spark, sf_dir).filter((F.col("ts") < at) & ((F.col("event_type") != "signup") | (F.col("ts") < _RUNS[1])))
        executed = at if run == 1 else F.when(F.col("event_type") != "error", at)
        daily = seen.groupBy("event_type", F.to_date("ts").alias("d")).agg((F.count_distinct(F.hour("ts")) >= 6).alias("whole"))
        raw = quality.watermarks(seen, F.col("event_type"), "raw", run, executed=executed, ingested=F.col("ts"), data=F.to_date("ts"))
        published = F.when(F.col("event_type") != "click", at + F.expr("interval 1 hour"))
        rolled = quality.watermarks(daily, F.col("event_type"), "daily", run, executed=executed, complete=F.when(F.col("whole"), F.col("d")), published=published)
        raw.unionByName(rolled).write.mode("append").parquet(path)
    found = quality.freshness_of_layers(spark.read.parquet(path), 2, by)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in [*[f"{e}_at" for e in quality.EVENTS], "usable_before"]})


@query(_FRESH.format(marks=_MARKS, moment=_EVENTS_AT, by="source"))
def freshness_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fresh(spark, sf_dir, ["source"])


@query(_FRESH.format(marks=_MARKS, moment=_EVENTS_AT, by="source, layer"))
def freshness_of_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fresh(spark, sf_dir, ["source", "layer"])


@query("SELECT 'has_rows' AS check_name, CAST(count(*) = 0 AS BIGINT) AS n_failed FROM lineitem UNION ALL SELECT 'keys_not_null', count(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) FROM lineitem UNION ALL SELECT 'grain_unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'orphans_l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def publish_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").filter("o_orderstatus != 'P'")
    return quality.table_checks(views.table(spark, sf_dir, "lineitem"), LINE_KEYS, {"l_orderkey": (orders, "o_orderkey")})


# --- Measures --------------------------------------------------------------------------------


@query("WITH d AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS order_date, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price FROM orders GROUP BY ALL) SELECT a.o_orderstatus, a.order_date, a.total_price, b.total_price AS previous_value, round((a.total_price - b.total_price) / nullif(b.total_price, 0) * 100, 4) AS change_pct FROM d a LEFT JOIN d b ON a.o_orderstatus = b.o_orderstatus AND b.order_date = a.order_date - 1")
def previous_day_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measures.previous_day_change(views.daily_orders(spark, sf_dir), ["o_orderstatus"], "order_date", "total_price"), "change_pct")


@query("WITH d AS (SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS order_date, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price FROM orders GROUP BY ALL) SELECT o_orderstatus, order_date, total_price, round(avg(total_price) OVER (PARTITION BY o_orderstatus ORDER BY order_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 6) AS moving_average FROM d")
def seven_day_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(measures.calendar_average(views.daily_orders(spark, sf_dir), ["o_orderstatus"], "order_date", "total_price"), "moving_average", digits=6)


@query(f"{_ENERGY} SELECT country_code, round(sum(daily_demand_mwh), 3) AS demand_mwh, round(avg(avg_day_ahead_price_eur_mwh), 4) AS avg_price, round(sum(total_generation_mwh), 3) AS generation_mwh, round(sum(renewable_generation_mwh) / nullif(sum(total_generation_mwh), 0) * 100, 4) AS renewable_pct FROM energy GROUP BY ROLLUP (country_code)")
def period_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rounded(measures.period_measures(energy(spark, sf_dir), ["country_code"]), "avg_price", "renewable_pct")
    return rounded(out, "demand_mwh", "generation_mwh", digits=3)


@query(f"WITH {_OBS}, {_preferred('value >= 0')}, {_DEMAND} SELECT country_code, max(local_date) FILTER (completeness_status = 'complete') AS latest_complete_date FROM demand GROUP BY ROLLUP (country_code)")
def latest_complete_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures.latest_complete_date(demand(spark, sf_dir), ["country_code"], "local_date", "completeness_status")


@query(f"{_ENERGY}, {_TALL}, {_WIDE} SELECT country_code, round(corr(total_generation_mwh, avg_temperature_c), 6) AS correlation, count(*) AS n_pairs FROM energy JOIN wide USING (country_code, local_date) WHERE total_generation_mwh IS NOT NULL AND avg_temperature_c IS NOT NULL GROUP BY country_code")
def pair_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = energy(spark, sf_dir).join(weather(spark, sf_dir), ["country_code", "local_date"])
    return rounded(measures.pair_correlation(both, ["country_code"], "total_generation_mwh", "avg_temperature_c"), "correlation", digits=6)


@query("SELECT CASE user_id % 3 WHEN 0 THEN 'Europe/Dublin' WHEN 1 THEN 'Europe/Berlin' END AS timezone, count(*) AS n_rows, count(DISTINCT user_id) AS n_users FROM events GROUP BY 1")
def record_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by the zone of records in memory, one of which lacks its zone and another has a field
    that the schema does not know."""
    schema = T.StructType([T.StructField("rest", T.LongType()), T.StructField("timezone", T.StringType())])
    records = tables.from_records(spark, [{"timezone": "Europe/Dublin", "rest": 0}, {"rest": 1, "timezone": "Europe/Berlin", "name": "x"}, {"rest": 2}], schema)
    events = views.table(spark, sf_dir, "events").withColumn("rest", F.col("user_id") % 3)
    return events.join(records, "rest").groupBy("timezone").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("user_id").alias("n_users"))


# --- Documents -------------------------------------------------------------------------------

_HOURS = "SELECT 'C' || CAST(user_id % 3 AS VARCHAR) AS country_code, date_trunc('hour', ts) AS h, max(value) AS value FROM events GROUP BY ALL"


def _market_documents(spark: SparkSession, sf_dir: str, kind: Column | None = None) -> DataFrame:
    """country_code, day, document. ``kind`` is the element of the business type, by default of A04."""
    hours = views._events(spark, sf_dir).groupBy("country_code", F.date_trunc("hour", "ts").alias("h")).agg(F.max("value").alias("value"))
    point = F.concat(F.lit("<Point><position>"), (F.hour("h") + 1).cast("string"), F.lit("</position><quantity>"), F.col("value").cast("string"), F.lit("</quantity></Point>"))
    days = hours.groupBy("country_code", F.to_date("h").alias("day")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("h", point.alias("p")))), lambda x: x["p"]), "").alias("points"))
    head = '<?xml version="1.0" encoding="UTF-8"?><GL_MarketDocument xmlns="urn:example:load"><mRID>'
    text = F.concat(F.lit(head), F.col("country_code"), F.lit("</mRID><TimeSeries>"), F.lit("<businessType>A04</businessType>") if kind is None else kind, F.lit("<quantity_Measure_Unit.name>MAW</quantity_Measure_Unit.name><Period><timeInterval><start>"), F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00Z</start></timeInterval><resolution>PT60M</resolution>"), F.col("points"), F.lit("</Period></TimeSeries></GL_MarketDocument>"))
    return days.select("country_code", "day", text.alias("document"))


@query(f"SELECT country_code, h AS source_timestamp, value, 'PT60M' AS resolution, 'MAW' AS unit, 'A04' AS business_type FROM ({_HOURS})")
def parse_market_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly maxima written as a document for each country-day, and parsed again."""
    rows = documents.parse_market_xml(_market_documents(spark, sf_dir).drop("day"), "load")
    return rows.select("country_code", F.col("source_timestamp").cast("timestamp_ntz").alias("source_timestamp"), "value", "resolution", "unit", "business_type")


@query(
    f"""SELECT country_code, '10Y-' || country_code AS domain, 'load' AS dataset_type, strftime(h, '%Y-%m-%dT%H:%M:%SZ') AS source_timestamp, 'PT60M' AS source_resolution, value, 'MAW' AS unit, CAST(NULL AS VARCHAR) AS production_type_raw, 'A04' AS business_type, CAST(NULL AS VARCHAR) AS currency,
    strftime(h, '%Y-%m-%d') AS requested_start_date, strftime(h + INTERVAL 1 DAY, '%Y-%m-%d') AS requested_end_date, country_code AS source_document_mrid, 'market' AS source_system, strftime(h + INTERVAL 1 DAY, '%Y-%m-%dT06:00:00Z') AS ingestion_timestamp FROM ({_HOURS}) WHERE country_code <> 'C1'"""
)
def market_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of two datasets as a raw table by dataset, of which one is read again. Those of one
    country tell no business type and are rejected."""
    kind = F.when(F.col("country_code") == "C1", "").otherwise("<businessType>A04</businessType>")
    points = documents.parse_market_xml(_market_documents(spark, sf_dir, kind), "load")
    day = {"start": F.date_format("day", "yyyy-MM-dd"), "end": F.date_format(F.date_add("day", 1), "yyyy-MM-dd"), "ingested_at": F.date_format(F.date_add("day", 1), "yyyy-MM-dd'T'06:00:00'Z'")}
    raw = documents.raw_table(points, domain=F.concat(F.lit("10Y-"), "country_code"), dataset="load", source_system="market", strict=False, **day)
    path = _new_folder(spark)
    raw.unionByName(raw.withColumn("dataset_type", F.lit("generation"))).write.partitionBy("dataset_type").parquet(path)
    return windows.of_dataset(spark.read.parquet(path), "load")


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'data' WHEN 1 THEN 'no_data' ELSE 'error' END AS class FROM events")
def document_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each event, classified: of data, without any, refused with the same code, of
    another dataset, cut off, absent."""
    reason = "<Acknowledgement_MarketDocument><mRID>a</mRID><Reason><code>999</code><text>{}</text></Reason></Acknowledgement_MarketDocument>"
    forms = ['<?xml version="1.0"?><GL_MarketDocument xmlns="urn:example:load"><mRID>m</mRID></GL_MarketDocument>', reason.format("No matching data found"), reason.format("The token is not valid"), "<Publication_MarketDocument><mRID>m</mRID></Publication_MarketDocument>", "<GL_MarketDocument><mRID>m</mRID>"]
    document = F.element_at(F.array(*map(F.lit, forms), F.lit(None).cast("string")), (F.col("event_id") % 6 + 1).cast("int"))
    return views.table(spark, sf_dir, "events").select("event_id", documents.classify_market_xml(document, "load").alias("class"))


@query("SELECT 'C' || CAST(user_id % 3 AS VARCHAR) AS country_code, strftime(ts, '%Y-%m-%d') AS observation_date, unnest(['highest', 'lowest']) AS source_variable, unnest([max(value), min(value)]) AS source_value, unnest(['MW', 'kW']) AS source_unit FROM events GROUP BY 1, 2")
def parse_daily_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = views._events(spark, sf_dir).groupBy("country_code", F.date_format("ts", "yyyy-MM-dd").alias("d")).agg(F.max("value").alias("hi"), F.min("value").alias("lo"))
    arrays = days.groupBy("country_code").agg(F.array_sort(F.collect_list(F.struct("d", "hi", "lo"))).alias("a"))
    daily = F.struct(F.col("a.d").alias("time"), F.col("a.hi").alias("highest"), F.col("a.lo").alias("lowest"))
    units = F.struct(F.lit("MW").alias("highest"), F.lit("kW").alias("lowest"))
    text = F.to_json(F.struct(F.lit(1.5).alias("latitude"), units.alias("daily_units"), daily.alias("daily")))
    rows = documents.parse_daily_json(arrays.select("country_code", text.alias("document")), ["highest", "lowest"])
    return rows.select("country_code", "observation_date", "source_variable", "source_value", "source_unit")


@query(f"WITH {_ANNUAL} SELECT country_code, 'POP' AS indicator_code, year, CAST(population AS DOUBLE) AS value FROM annual")
def parse_indicator_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.struct(F.struct(F.lit("POP").alias("id"), F.lit("People").alias("value")).alias("indicator"), F.struct(F.col("country_code").alias("id"), F.col("country_code").alias("value")).alias("country"), F.col("year").cast("string").alias("date"), F.col("population").cast("double").alias("value"))
    lists = views.annual(spark, sf_dir).groupBy("country_code").agg(F.to_json(F.array_sort(F.collect_list(named))).alias("records"))
    docs = lists.select(F.concat(F.lit('[{"page": 1}, '), F.col("records"), F.lit("]")).alias("document"))
    return documents.parse_indicator_json(docs).select("country_code", "indicator_code", "year", "value")
