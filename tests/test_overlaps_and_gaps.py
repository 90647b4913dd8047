"""Readings that overlap count once; what they leave open of local days."""

import datetime as dt

from pyspark.sql import functions as F

from dayfacts.operators import intervals as I

T = dt.datetime
D = dt.date


def zones(spark):
    return spark.createDataFrame([("IE", "Europe/Dublin"), ("DE", "Europe/Berlin")], "country_code string, timezone string")




def readings(spark, rows):
    """country, 'yyyy-mm-dd hh:mm' in UTC, resolution, value; later rows are later revisions."""
    df = spark.createDataFrame([(c, t, r, v, i) for i, (c, t, r, v) in enumerate(rows)], "country_code string, t string, source_resolution string, value double, event_id long")
    return df.select("country_code", F.to_timestamp("t").alias("slot"), "source_resolution", "value", "event_id")


def daily(df, spark):
    return {(r["country_code"], str(r["local_date"])): (round(r["daily_demand_mwh"], 6), r["source_interval_count"], r["covered_duration_hours"]) for r in I.daily_demand(df, zones(spark)).collect()}


def test_overlapping_readings_count_once(spark):
    rows = [("IE", "2024-01-05 00:00", "PT60M", 10.0), ("IE", "2024-01-05 00:30", "PT60M", 20.0)]
    assert daily(readings(spark, rows), spark) == {("IE", "2024-01-05"): (20.0, 2, 1.5)}
    rows += [("IE", "2024-01-05 00:15", "PT60M", 40.0), ("IE", "2024-01-05 00:15", "PT60M", -1.0)]  # the last revision is not valid
    assert daily(readings(spark, rows), spark) == {("IE", "2024-01-05"): (20.0, 2, 1.5)}


def test_reading_across_local_midnight_covers_the_next_day(spark):
    rows = [("DE", "2024-01-05 22:30", "PT60M", 10.0), ("DE", "2024-01-05 23:00", "PT60M", 20.0)]  # Berlin 23:30 and 00:00
    assert daily(readings(spark, rows), spark) == {("DE", "2024-01-05"): (10.0, 1, 1.0), ("DE", "2024-01-06"): (10.0, 1, 0.5)}
    whole = [("DE", "2024-01-05 12:00", "P2D", 1.0), ("DE", "2024-01-06 12:00", "P2D", 1.0), ("DE", "2024-01-07 06:00", "P2D", 1.0)]
    assert daily(readings(spark, whole), spark) == {("DE", "2024-01-05"): (48.0, 1, 48.0), ("DE", "2024-01-06"): (24.0, 1, 24.0), ("DE", "2024-01-07"): (18.0, 1, 18.0)}


def test_price_is_weighted_by_what_counts(spark):
    rows = [("IE", "2024-01-05 00:00", "PT60M", 10.0), ("IE", "2024-01-05 00:30", "PT60M", 40.0)]
    (r,) = I.daily_price(readings(spark, rows), zones(spark)).collect()
    assert r["avg_day_ahead_price_eur_mwh"] == 20.0


def gaps(spark, rows, days):
    r = spark.createDataFrame(rows, "k string, t string, hours double").select("k", F.to_timestamp("t").alias("slot"), "hours")
    d = spark.createDataFrame(days, "k string, local_date date, timezone string")
    return sorted((x["k"], str(x["local_date"]), x["a"][5:16], x["b"][5:16], x["gap_hours"]) for x in I.local_day_gaps(r, d, ["k"], "slot", "hours").selectExpr("*", "cast(gap_start as string) a", "cast(gap_end as string) b").collect())


def test_gaps_of_local_days(spark):
    berlin = "Europe/Berlin"
    days = [("a", D(2024, 3, 30), berlin), ("a", D(2024, 3, 31), berlin), ("a", D(2024, 10, 27), berlin), ("b", D(2024, 3, 31), berlin), ("b", D(2024, 3, 31), berlin)]
    rows = [
        ("a", "2024-03-30 00:00", 1.0),  # one hour into the local day
        ("a", "2024-03-30 00:15", 0.25),  # within it
        ("a", "2024-03-30 01:00", 20.0),
        ("a", "2024-03-30 22:30", 2.0),  # into the next day of 23 hours
        ("a", "2024-03-31 12:00", 0.0),
        ("a", None, 5.0),
        ("a", "2024-04-10 00:00", 5.0),  # a day that is not expected
        ("a", "2024-10-26 22:00", 24.5),
        ("c", "2024-03-31 00:00", 5.0),  # a key that is not expected
    ]
    assert gaps(spark, rows, days) == [
        ("a", "2024-03-30", "03-29 23:00", "03-30 00:00", 1.0),
        ("a", "2024-03-30", "03-30 21:00", "03-30 22:30", 1.5),
        ("a", "2024-03-31", "03-31 00:30", "03-31 22:00", 21.5),
        ("a", "2024-10-27", "10-27 22:30", "10-27 23:00", 0.5),
        ("b", "2024-03-31", "03-30 23:00", "03-31 22:00", 23.0),
    ]
    assert gaps(spark, [], days[:1]) == [("a", "2024-03-30", "03-29 23:00", "03-30 23:00", 24.0)]
    assert gaps(spark, rows, []) == []


def test_days_of_a_gap_are_neither_folded_nor_expanded_in_one_task(spark):
    import re

    from __spark_entry__ import queries

    plan = queries()["local_day_gaps"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Aggregate\(keys?=\[[^\]]*local_date", plan)
    assert f"RoundRobinPartitioning({2 * spark.sparkContext.defaultParallelism})" in plan


def test_expected_days_may_repeat(spark):
    days = [("a", D(2024, 3, 31), "Europe/Berlin"), ("b", D(2024, 3, 31), "Europe/Berlin")]
    rows = [("a", "2024-03-31 12:00", 1.0), ("a", "2024-03-31 21:30", 0.5)]  # the second up to midnight
    assert gaps(spark, rows, days * 3) == gaps(spark, rows, days) == [
        ("a", "2024-03-31", "03-30 23:00", "03-31 12:00", 13.0),
        ("a", "2024-03-31", "03-31 13:00", "03-31 21:30", 8.5),
        ("b", "2024-03-31", "03-30 23:00", "03-31 22:00", 23.0),
    ]


def test_month_chunks(spark):
    from dayfacts.operators import windows as X

    df = spark.createDataFrame([(D(2024, 2, 9), 1), (None, 2)], "m date, chunk int")
    got = [tuple(r) for r in X.month_chunks(df, "m", buffer_days=1, chunk_days=20).select("chunk_start", "chunk_end").collect()]
    assert got == [(D(2024, 1, 31), D(2024, 2, 19)), (D(2024, 2, 20), D(2024, 3, 1))]
    assert [str(r[0]) for r in df.select(X.last_complete_month(F.col("m"))).collect()] == ["2024-01-01", "None"]
    assert str(spark.sql("select date'2024-01-31' d").select(X.last_complete_month(F.col("d"))).first()[0]) == "2023-12-01"
