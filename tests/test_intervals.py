import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dayfacts.functions.scalar import duration_hours, local_day_hours, safe_pct
from dayfacts.operators import intervals, lookups, windows

OBS = "country_code string, slot timestamp, source_resolution string, value double, event_id long"
MIX = "country_code string, slot timestamp, source_resolution string, value double, production_type_raw string, business_type string, event_id long"


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([("IE", "Europe/Dublin"), ("DE", "Europe/Berlin")], "country_code string, timezone string")


def at(hour, minute=0, day=dt.date(2024, 1, 1)):
    return dt.datetime.combine(day, dt.time(0)) + dt.timedelta(hours=hour, minutes=minute)


def demand(spark, zones, rows):
    return intervals.daily_demand(spark.createDataFrame([("IE", *r, i) for i, r in enumerate(rows)], OBS), zones).collect()


def test_two_loads_make_a_partial_day(spark, zones):
    (row,) = demand(spark, zones, [(at(0), "PT60M", 3500.5), (at(1), "PT60M", 3400.2)])
    assert (round(row.daily_demand_mwh, 6), row.source_interval_count, row.covered_duration_hours, row.completeness_status) == (6900.7, 2, 2.0, "partial")


def test_negative_load_is_dropped_and_the_latest_revision_wins(spark, zones):
    (row,) = demand(spark, zones, [(at(0), "PT60M", 100.0), (at(0), "PT60M", 110.0), (at(1), "PT60M", -5.0)])
    assert (row.daily_demand_mwh, row.source_interval_count) == (110.0, 1)


def test_a_full_day_is_complete(spark, zones):
    (row,) = demand(spark, zones, [(at(h), "PT60M", 3000.0) for h in range(24)])
    assert (row.daily_demand_mwh, row.completeness_status) == (72000.0, "complete")


def test_no_observations_give_no_row(spark, zones):
    assert demand(spark, zones, [(at(0), "PT60M", None)]) == []


def test_hourly_wins_else_the_finest(spark, zones):
    hourly = [(at(h), "PT60M", 10.0) for h in range(24)] + [(at(h), "PT15M", 99.0) for h in range(24)]
    (row,) = demand(spark, zones, hourly)
    assert (row.daily_demand_mwh, row.source_interval_count) == (240.0, 24)
    (row,) = demand(spark, zones, [(at(0), "PT30M", 10.0), (at(0), "PT15M", 20.0)])
    assert (row.daily_demand_mwh, row.covered_duration_hours) == (5.0, 0.25)


@pytest.mark.parametrize("zone", ["Europe/Dublin", "Europe/Berlin"])
@pytest.mark.parametrize("day, hours", [(dt.date(2026, 3, 28), 24), (dt.date(2026, 3, 29), 23), (dt.date(2026, 3, 30), 24), (dt.date(2026, 10, 25), 25), (dt.date(2026, 10, 26), 24)])
def test_local_days_have_23_24_or_25_hours(spark, zone, day, hours):
    assert spark.range(1).select(local_day_hours(F.lit(day), F.lit(zone))).first()[0] == hours


@pytest.mark.parametrize("day, start, hours", [(dt.date(2026, 3, 29), 0, 23), (dt.date(2026, 10, 25), -1, 25)])
def test_a_day_of_daylight_saving_is_complete_with_its_own_hours(spark, zones, day, start, hours):
    rows = [(at(start + h, day=day), "PT60M", 1.0) for h in range(hours)]
    (row,) = demand(spark, zones, rows)
    assert (row.local_date, row.completeness_status) == (day, "complete")
    (row,) = demand(spark, zones, rows[:-1])
    assert row.completeness_status == "partial"


def test_price_keeps_negatives_and_weighs_by_duration(spark, zones):
    rows = spark.createDataFrame([("IE", at(0), "PT60M", -5.32, 1), ("IE", at(1), "PT60M", 45.10, 2)], OBS)
    (row,) = intervals.daily_price(rows, zones).collect()
    assert (round(row.avg_day_ahead_price_eur_mwh, 6), row.min_day_ahead_price_eur_mwh, row.max_day_ahead_price_eur_mwh) == (19.89, -5.32, 45.10)


def mix(spark, zones, rows, **options):
    return {r.normalized_production_type: r for r in intervals.generation_mix(spark.createDataFrame([("IE", *r, i) for i, r in enumerate(rows)], MIX), zones, **options).collect()}


def test_codes_become_categories(spark, zones):
    out = mix(spark, zones, [(at(0), "PT60M", 120.0, "B19", "A01"), (at(0), "PT60M", 50.0, " b16 ", "A01"), (at(0), "PT60M", 7.0, "B99", "A01"), (at(1), "PT60M", 1.0, None, None)])
    assert (out["wind"].generation_mwh, out["wind"].renewable_flag) == (120.0, True)
    assert out["solar"].generation_mwh == 50.0
    assert (out["other"].generation_mwh, out["other"].renewable_flag, out["other"].production_type_raw_codes) == (8.0, False, ["B99"])


def test_codes_of_a_category_add_up_and_consumption_is_left_out(spark, zones):
    out = mix(spark, zones, [(at(0), "PT60M", 100.0, "B02", "A01"), (at(0), "PT60M", 70.0, "B05", "A01"), (at(0), "PT60M", 80.0, "B10", "A01"), (at(0), "PT60M", 30.0, "B10", "A04")])
    assert (out["coal"].generation_mwh, out["coal"].production_type_raw_codes, out["coal"].covered_duration_hours) == (170.0, ["B02", "B05"], 2.0)
    assert out["hydro"].generation_mwh == 80.0


def test_coverage_by_series_takes_the_least(spark, zones):
    rows = [(at(h), "PT60M", 1.0, "B02", "A01") for h in range(12)] + [(at(h), "PT60M", 1.0, "B05", "A01") for h in range(12)]
    assert mix(spark, zones, rows)["coal"].completeness_status == "complete"
    assert mix(spark, zones, rows, series_cols=["production_type_raw"])["coal"].completeness_status == "partial"


def test_durations(spark):
    rows = spark.createDataFrame([("PT60M",), ("PT15M",), ("P1D",), ("PT1H30M",), (None,)], "d string")
    assert [r[0] for r in rows.select(duration_hours(F.col("d"))).collect()] == [1.0, 0.25, 24.0, 1.5, None]
    for bad in ("PT", "P", "PT0M", "60M", ""):
        one = spark.createDataFrame([(bad,)], "d string")
        assert one.select(duration_hours(F.col("d"), strict=False)).first()[0] is None
        with pytest.raises(PySparkException):
            one.select(duration_hours(F.col("d"))).collect()


def test_safe_pct_is_null_for_zero_and_null(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in rows.select(safe_pct(F.col("a"), F.col("b"))).collect()] == [25.0, None, None]


def test_padded_read(spark):
    rows = spark.createDataFrame([(x,) for x in ("2026-10-30T23:59:00Z", "2026-10-31T00:00:00Z", "2026-11-04T23:45:00Z", "2026-11-05T00:00:00Z")], "t string")
    window = dt.date(2026, 11, 1), dt.date(2026, 11, 3)
    kept = ["2026-10-31T00:00:00Z", "2026-11-04T23:45:00Z"]
    assert [r.t for r in windows.padded_read(rows, "t", *window).collect()] == kept
    assert [r.t for r in windows.padded_read(rows.withColumn("s", F.to_timestamp("t")), "s", *window).collect()] == kept


def test_unknown_countries_are_rejected_not_dated(spark, zones):
    known, rejected = lookups.with_zone(spark.createDataFrame([("IE",), ("XX",), (None,)], "country_code string"), zones)
    assert [r.country_code for r in known.collect()] == ["IE"]
    assert {r.country_code for r in rejected.collect()} == {"XX", None}


def test_rowwise_resolution_agrees_with_the_rollup(spark, zones):
    rows = [(at(0), "PT30M", 10.0), (at(0), "PT15M", 20.0), (at(6), "PT15M", 2.0)]
    obs = spark.createDataFrame([("IE", *r, i) for i, r in enumerate(rows)], OBS)
    timed = intervals.with_local_date(obs, zones).withColumn("interval_hours", duration_hours(F.col("source_resolution")))
    assert {r.value for r in intervals.with_preferred_resolution(timed).collect()} == {20.0, 2.0}


def test_one_resolution_for_all_categories_of_a_day(spark, zones):
    """Hourly wind and quarter-hourly solar on one day: solar is left out of that day."""
    out = mix(spark, zones, [(at(0), "PT60M", 100.0, "B19", "A01"), (at(0), "PT15M", 40.0, "B16", "A01")])
    assert set(out) == {"wind"} and out["wind"].generation_mwh == 100.0
    out = mix(spark, zones, [(at(0), "PT30M", 100.0, "B19", "A01"), (at(0), "PT15M", 40.0, "B16", "A01")])
    assert set(out) == {"solar"} and out["solar"].generation_mwh == 10.0
