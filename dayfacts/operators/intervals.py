"""From irregular intervals to daily facts on local dates.

The rollups aggregate by resolution first, on the map side as well, and choose a day's
resolution among the few aggregated rows; raw rows are shuffled once, for the dedupe and for
clipping readings that overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalar import duration_hours, energy_mwh, local_date, local_day_hours
from .lookups import with_production_type, with_zone
from .observed import Watch
from .revisions import latest_per_key

#: A day counts as complete within a minute of its length.
TOLERANCE_HOURS = 1 / 60
CONSUMPTION = "A04"


def with_local_date(df: DataFrame, zones: DataFrame, instant_col: str = "slot") -> DataFrame:
    """Adds timezone and local_date; rows of countries without a zone are left out (``with_zone``
    gives them)."""
    known, _ = with_zone(df, zones)
    return known.withColumn("local_date", local_date(F.col(instant_col), F.col("timezone")))


def with_preferred_resolution(df: DataFrame, keys: list[str] | None = None, *, hours_col: str = "interval_hours") -> DataFrame:
    """Row-level choice of one resolution for each group: hourly if there is any, else the finest."""
    group = W.partitionBy(*(keys or ["country_code", "local_date"]))
    marked = df.withColumn("_hourly", F.max((F.col(hours_col) == 1.0).cast("int")).over(group)).withColumn("_finest", F.min(hours_col).over(group))
    chosen = F.when(F.col("_hourly") == 1, F.lit(1.0)).otherwise(F.col("_finest"))
    return marked.filter(F.col(hours_col) == chosen).drop("_hourly", "_finest")


def _choose_resolution(sums: DataFrame, keys: list[str]) -> DataFrame:
    """One row of per-resolution sums for each group, by the rule of ``with_preferred_resolution``."""
    values = [c for c in sums.columns if c not in [*keys, "interval_hours"]]
    order = F.struct((F.col("interval_hours") == 1.0).cast("int"), -F.col("interval_hours"))
    best = sums.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}") for c in values])


def with_completeness(df: DataFrame, zones: DataFrame, *, covered_col: str = "covered_duration_hours") -> DataFrame:
    """Adds completeness_status: complete if the covered hours reach the local day's length."""
    known, _ = with_zone(df, zones)
    full = local_day_hours(F.col("local_date"), F.col("timezone")) - F.lit(TOLERANCE_HOURS)
    return known.withColumn("completeness_status", F.when(F.col(covered_col) >= full, "complete").otherwise("partial")).drop("timezone")


def current_readings(obs: DataFrame, zones: DataFrame, series: list[str], order_col: str, keep: Column, watch: Watch | None = None) -> DataFrame:
    """The latest revision of each reading of a series that meets ``keep``, with local_date,
    interval_hours and covered_hours: the hours of it that no earlier reading of the series, in
    the same resolution, has covered. Readings that have none left are dropped, so no moment
    counts twice.

    A reading that runs into the next local day is also seen there, as it may cover the beginning
    of that day's first. Rows are shuffled once, by country, resolution and day. A ``watch`` counts
    on the way what ``rollup_metrics`` tells.
    """
    point = watch.at if watch else lambda df, _, **counts: df
    hours = F.col("interval_hours")
    own, usable = F.col("_day") == F.col("local_date"), F.coalesce(keep & (hours > 0), F.lit(False))
    ends = F.unix_micros("slot") + (hours * 3_600_000_000).cast("long")
    obs = point(obs, "received", received=F.count(F.lit(1)))
    timed = with_local_date(obs, zones).withColumn("interval_hours", duration_hours(F.col("source_resolution")))
    timed = point(timed, "placed", placed=F.count("local_date"))
    last = local_date(F.timestamp_micros(ends - 1), F.col("timezone"))
    seen = timed.withColumn("_day", F.explode(F.sequence("local_date", F.coalesce(last, "local_date")))).repartition("country_code", "source_resolution", "_day")
    current = latest_per_key(seen, ["country_code", "slot", "source_resolution", *series, "_day"], order_col)
    current = point(current, "current", current=F.count_if(own), usable=F.count_if(own & usable)).filter(keep)
    earlier = W.partitionBy("country_code", "source_resolution", *series, "_day").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    begins = F.greatest(F.unix_micros("slot"), F.coalesce("_ended", F.unix_micros("slot")))
    left = current.withColumn("_ended", F.max(ends).over(earlier)).withColumn("covered_hours", F.greatest(F.lit(0.0), F.least(hours, (ends - begins) / 3_600_000_000)))
    left = point(left, "clipped", overlapping=F.count_if(own & usable & (F.col("covered_hours") < hours)))
    return left.filter("_day = local_date and covered_hours > 0").drop("_day", "_ended")


def _daily(obs: DataFrame, zones: DataFrame, order_col: str, keep: Column, *aggregates: Column, watch: Watch | None = None) -> DataFrame:
    sums = current_readings(obs, zones, [], order_col, keep, watch).groupBy("country_code", "local_date", "interval_hours").agg(
        *aggregates,
        F.count(F.lit(1)).alias("source_interval_count"),
        F.sum("covered_hours").alias("covered_duration_hours"),
    )
    days = with_completeness(_choose_resolution(sums, ["country_code", "local_date"]), zones)
    if watch is None:
        return days
    partial = F.count_if(F.col("completeness_status") == "partial")
    return watch.at(days, "days", days=F.count(F.lit(1)), partial_days=partial, used=F.sum("source_interval_count"), first_date=F.min("local_date"), last_date=F.max("local_date"))


#: What ``rollup_metrics`` tells, in this order.
METRICS = "rows_received long, rows_unplaced long, duplicates_removed long, rows_rejected long, overlaps_detected long, rows_used long, days_written long, partial_days long, first_date date, last_date date"


def rollup_metrics(spark: SparkSession, watch: Watch) -> DataFrame:
    """One row on a watched daily rollup that has been written: readings received; without a zone or
    time; older revisions; not valid, or without a length; partly or wholly covered by earlier
    ones; used in the chosen resolutions; days, partial days, and the first and last date."""
    n = watch.read()
    n |= {name: value or 0 for name, value in n.items() if not name.endswith("_date")}
    row = (n["received"], n["received"] - n["placed"], n["placed"] - n["current"], n["current"] - n["usable"], n["overlapping"], n["used"], n["days"], n["partial_days"], n["first_date"], n["last_date"])
    return spark.createDataFrame([row], METRICS)


def local_day_gaps(readings: DataFrame, days: DataFrame, keys: list[str], start_col: str, hours_col: str) -> DataFrame:
    """keys, local_date, gap_start, gap_end, gap_hours: what the readings leave open of each expected
    local day (23, 24 or 25 hours), gaps before the first and after the last reading included.

    ``readings`` is keys, start (an instant), hours; ``days`` keys, local_date, timezone, one zone
    for a key. Readings of any mixture of lengths count once where they overlap; those without a
    start, or not longer than 0, are nothing. A day without readings is one gap. One sort of the
    readings by key and day; no spine of slots is built. Days that repeat leave nothing open after
    their first and are not folded, so no table of all days is held.
    """
    midnight = lambda day: F.unix_micros(F.to_utc_timestamp(day.cast("timestamp"), F.col("timezone")))
    zone = days.select(*keys, "timezone").distinct()
    begins = F.unix_micros(start_col)
    spans = readings.filter(F.col(start_col).isNotNull() & (F.col(hours_col) > 0)).select(*keys, begins.alias("_s"), (begins + (F.col(hours_col) * 3_600_000_000).cast("long")).alias("_e"))
    at = lambda micros: local_date(F.timestamp_micros(micros), F.col("timezone"))
    spread = spans.join(zone, keys).withColumn("local_date", F.explode(F.sequence(at(F.col("_s")), at(F.col("_e") - 1)))).select(*keys, "local_date", "timezone", "_s", "_e", F.lit(False).alias("_end"))
    ends = days.select(*keys, "local_date", "timezone").withColumn("_s", midnight(F.date_add("local_date", 1))).select("*", F.col("_s").alias("_e"), F.lit(True).alias("_end"))
    group = W.partitionBy(*keys, "local_date")
    earlier = group.orderBy("_s", "_end", "_e").rowsBetween(W.unboundedPreceding, -1)
    marked = spread.unionByName(ends).withColumns({"_before": F.max("_e").over(earlier), "_wanted": F.max("_end").over(group)}).filter("_wanted")
    first, last = midnight(F.col("local_date")), midnight(F.date_add("local_date", 1))
    open_from, open_to = F.greatest(first, F.coalesce("_before", first)), F.least("_s", last)
    found = marked.select(*keys, "local_date", open_from.alias("_f"), open_to.alias("_t")).filter("_t > _f")
    return found.select(*keys, "local_date", F.timestamp_micros("_f").alias("gap_start"), F.timestamp_micros("_t").alias("gap_end"), ((F.col("_t") - F.col("_f")) / 3_600_000_000).alias("gap_hours"))


def daily_demand(obs: DataFrame, zones: DataFrame, *, order_col: str = "event_id", watch: Watch | None = None) -> DataFrame:
    """Daily energy of a load series: country_code, local_date, daily_demand_mwh, interval count,
    covered hours, completeness_status.

    ``obs`` is country_code, slot (UTC), source_resolution, value (MW) and an order of revisions.
    Negative and null readings are dropped after the latest revision is chosen; a day without
    readings has no row; a partial day keeps its diagnostic value.
    """
    energy = F.sum(energy_mwh(F.col("value"), F.col("covered_hours"))).alias("daily_demand_mwh")
    return _daily(obs, zones, order_col, F.col("value") >= 0, energy, watch=watch)


def daily_price(obs: DataFrame, zones: DataFrame, *, order_col: str = "event_id", watch: Watch | None = None) -> DataFrame:
    """Daily price statistics, the mean weighted by duration. Negative prices are valid."""
    v, h = F.col("value"), F.col("covered_hours")
    mean = (F.sum(v * h) / F.nullif(F.sum(h), F.lit(0.0))).alias("avg_day_ahead_price_eur_mwh")
    return _daily(obs, zones, order_col, v.isNotNull(), mean, F.min("value").alias("min_day_ahead_price_eur_mwh"), F.max("value").alias("max_day_ahead_price_eur_mwh"), watch=watch)


def generation_series(obs: DataFrame, zones: DataFrame, *, order_col: str = "event_id") -> DataFrame:
    """Current, non-negative production rows with local date, hours and category. Consumption is
    left out; rows without a business type stay. No moment of a series counts twice."""
    kept = ~F.col("business_type").eqNullSafe(CONSUMPTION) & (F.col("value") >= 0)
    timed = current_readings(obs, zones, ["production_type_raw", "business_type"], order_col, kept)
    return with_production_type(timed)


def generation_mix(obs: DataFrame, zones: DataFrame, *, order_col: str = "event_id", series_cols: list[str] | None = None) -> DataFrame:
    """Daily generation by category: energy, renewable flag, sorted distinct raw codes, covered
    hours, completeness_status.

    A country-day has one resolution for all its categories, by the rule of
    ``with_preferred_resolution``; series at other resolutions are left out of that day. The flag
    of a mixed category is that of its smallest raw code. Covered hours add up over raw codes; with ``series_cols`` they are the least covered series' hours instead.
    """
    series = generation_series(obs, zones, order_col=order_col)
    day = ["country_code", "local_date", "normalized_production_type"]
    by_code = series.groupBy(*day, "interval_hours", "production_type_raw", *[c for c in series_cols or [] if c != "production_type_raw"]).agg(
        F.min("renewable_flag").alias("_flag"),
        F.sum(energy_mwh(F.col("value"), F.col("covered_hours"))).alias("_mwh"),
        F.sum("covered_hours").alias("_hours"),
    )
    sums = with_preferred_resolution(by_code).groupBy(*day).agg(
        F.min_by("_flag", F.coalesce("production_type_raw", F.lit(""))).alias("renewable_flag"),
        F.sum("_mwh").alias("generation_mwh"),
        F.sort_array(F.collect_set("production_type_raw")).alias("production_type_raw_codes"),
        (F.min("_hours") if series_cols else F.sum("_hours")).alias("covered_duration_hours"),
    )
    return with_completeness(sums, zones)
