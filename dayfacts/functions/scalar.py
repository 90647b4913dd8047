"""Column expressions for interval lengths, local calendar days and null-preserving arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DURATION = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?)?$"


def duration_hours(duration: Column, *, strict: bool = True) -> Column:
    """Hours of an ISO-8601 duration of days, hours and minutes, as a double.

    Malformed and non-positive durations raise, or are null where ``strict`` is false. Null: null.
    """
    text = F.trim(duration)

    def part(group: int) -> Column:
        return F.coalesce(F.regexp_extract(text, DURATION, group).try_cast("double"), F.lit(0.0))

    hours = part(1) * 24 + part(2) + part(3) / 60
    bad = F.raise_error(F.concat(F.lit("unsupported duration: "), text)).cast("double") if strict else F.lit(None).cast("double")
    return F.when(duration.isNull(), F.lit(None).cast("double")).when(text.rlike(DURATION) & (hours > 0), hours).otherwise(bad)


def local_date(instant: Column, zone: Column) -> Column:
    """The calendar date of a UTC instant in a zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def local_day_hours(day: Column, zone: Column) -> Column:
    """Length of a local calendar day in hours: 23, 24 or 25 with daylight saving."""

    def midnight(d: Column) -> Column:
        return F.unix_timestamp(F.to_utc_timestamp(d.cast("timestamp"), zone))

    return (midnight(F.date_add(day, 1)) - midnight(day)) / 3600.0


def energy_mwh(power_mw: Column, hours: Column) -> Column:
    return power_mw * hours


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: mean by weight over rows where both are known; null where the weights sum to zero."""
    both = value.isNotNull() & weight.isNotNull()
    return F.sum(F.when(both, value * weight)) / F.nullif(F.sum(F.when(both, weight)), F.lit(0.0))


def safe_pct(part: Column, whole: Column) -> Column:
    """part / whole * 100; null where either is null or whole is zero."""
    return part / F.nullif(whole, F.lit(0).cast("double")) * 100


def kwh_per_capita(mwh: Column, population: Column) -> Column:
    """MWh to kWh for each person; null where either is null or nobody lives there."""
    return mwh * 1000 / F.nullif(population.cast("double"), F.lit(0).cast("double"))


def floor_to(instant: Column, seconds: Column | int) -> Column:
    """The start of the interval of so many seconds that holds an instant, counted from the epoch."""
    seconds = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_seconds(F.floor(F.unix_timestamp(instant) / seconds) * seconds)
