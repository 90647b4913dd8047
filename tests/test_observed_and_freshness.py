"""Metrics counted while a rollup is written; freshness over layers and runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dayfacts.operators import intervals as I
from dayfacts.operators import quality as Q
from dayfacts.operators.observed import Watch

T = dt.datetime
D = dt.date
MARKS = "source string, layer string, run long, event string, at timestamp"


def observations(spark, rows):
    """country, 'yyyy-mm-dd hh:mm' in UTC or null, resolution, value; later rows are later revisions."""
    df = spark.createDataFrame([(c, t, r, v, i) for i, (c, t, r, v) in enumerate(rows)], "country_code string, t string, source_resolution string, value double, event_id long")
    return df.select("country_code", F.to_timestamp("t").alias("slot"), "source_resolution", "value", "event_id")


def watched(spark, rows, path):
    watch = Watch()
    zones = spark.createDataFrame([("IE", "Europe/Dublin"), ("DE", "Europe/Berlin")], "country_code string, timezone string")
    I.daily_demand(observations(spark, rows), zones, watch=watch).write.parquet(str(path))
    return I.rollup_metrics(spark, watch).first().asDict()


def test_each_row_is_counted_once_and_told_apart(spark, tmp_path):
    rows = [
        ("IE", "2024-01-05 00:00", "PT60M", 1.0),  # an older revision
        ("IE", "2024-01-05 00:00", "PT60M", 10.0),
        ("IE", "2024-01-05 00:30", "PT60M", 20.0),  # half covered
        ("IE", "2024-01-05 23:30", "PT60M", 5.0),  # also seen on the next day
        ("IE", "2024-01-06 00:00", "PT60M", 5.0),  # half covered by it
        ("IE", "2024-01-05 03:00", "PT60M", -1.0),  # not valid
        ("IE", "2024-01-05 04:00", "PT60M", None),  # not valid
        ("IE", "2024-01-05 05:00", None, 1.0),  # without a length
        ("IE", None, "PT60M", 1.0),  # no time
        ("FR", "2024-01-05 00:00", "PT60M", 1.0),  # no zone
        (None, "2024-01-05 00:00", "PT60M", 1.0),
        ("DE", "2024-01-07 00:00", "PT15M", 1.0),
        ("DE", "2024-01-07 01:00", "PT60M", 1.0),  # the day's resolution; the quarter is not used
    ]
    assert watched(spark, rows, tmp_path / "out") == {
        "rows_received": 13, "rows_unplaced": 3, "duplicates_removed": 1, "rows_rejected": 3, "overlaps_detected": 2,
        "rows_used": 5, "days_written": 3, "partial_days": 3, "first_date": D(2024, 1, 5), "last_date": D(2024, 1, 7),
    }


def test_the_watch_changes_no_row_and_needs_one_job(spark, tmp_path):
    rows = [("IE", f"2024-01-05 {h:02d}:00", "PT60M", float(h)) for h in range(24)] * 2
    zones = spark.createDataFrame([("IE", "Europe/Dublin")], "country_code string, timezone string")
    plain = I.daily_demand(observations(spark, rows), zones)
    watch = Watch()
    with_watch = I.daily_demand(observations(spark, rows), zones, watch=watch)
    text = with_watch._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("CollectMetrics") == 5 and text.count("RepartitionByExpression") == 1
    assert with_watch.collect() == plain.collect()
    assert I.rollup_metrics(spark, watch).first().duplicates_removed == 24
    with pytest.raises(ValueError, match="received is watched already"):
        I.daily_demand(observations(spark, rows), zones, watch=watch)


def test_no_readings(spark, tmp_path):
    got = watched(spark, [], tmp_path / "out")
    assert got.pop("first_date") is None and got.pop("last_date") is None and set(got.values()) == {0}


def test_watermarks_are_the_latest_times(spark):
    df = spark.createDataFrame([("a", T(2024, 1, 1, 5), None), ("a", T(2024, 1, 2), None), (None, T(2024, 1, 3), D(2024, 1, 3))], "s string, t timestamp, d date")
    got = Q.watermarks(df, F.col("s"), "raw", 7, ingested=F.col("t"), data=F.col("d")).collect()
    assert sorted(got, key=repr) == sorted([("a", "raw", 7, "ingested", T(2024, 1, 2)), (None, "raw", 7, "ingested", T(2024, 1, 3)), (None, "raw", 7, "data", T(2024, 1, 3))], key=repr)
    assert Q.watermarks(df.limit(0), F.col("s"), "raw", 7, data=F.col("d")).count() == 0
    with pytest.raises(ValueError, match="seen"):
        Q.watermarks(df, F.col("s"), "raw", 7, seen=F.col("t"))


def test_a_successful_run_need_not_bring_newer_days(spark):
    ran, again = T(2024, 1, 10, 6), T(2024, 1, 11, 6)
    rows = []
    for s, days in {"moves": (8, 9), "stays": (8, 8), "back": (8, 7), "new": (None, 9), "none": (None, None), "lost": (8, None), None: (8, 9)}.items():
        for run, (at, day) in enumerate(zip((ran, again), days), 1):
            if s != "lost" or run == 1:
                rows.append((s, "raw", run, "executed", at))
            rows += [(s, "raw", run, "data", T(2024, 1, 8 + run))]  # arrives for all, complete or not
            if day:
                rows.append((s, "gold", run, "complete", T(2024, 1, day)))
    rows += [("moves", "gold", 3, "executed", T(2024, 1, 12)), ("none", "raw", 1, "published", T(2024, 1, 10))]  # a later run does not count
    marks = spark.createDataFrame(rows, MARKS)
    got = {r.source: r for r in Q.freshness_of_layers(marks, 2, ["source"]).collect()}
    assert {s: r.status for s, r in got.items()} == {"moves": "advanced", "stays": "stale", "back": "stale", "new": "advanced", "none": "advanced", "lost": "not_executed", None: "advanced"}
    assert (got["moves"].days_behind, got["stays"].days_behind, got["stays"].usable_before) == (2, 3, T(2024, 1, 8))
    assert got["moves"].executed_at == again and got["none"].published_at == T(2024, 1, 10)
    assert got["none"].usable_before == T(2024, 1, 9)  # of its data, as nothing tells of complete days
    layers = {(r.source, r.layer): r.status for r in Q.freshness_of_layers(marks, 2, ["source", "layer"]).collect()}
    assert layers["stays", "raw"] == "advanced" and layers["stays", "gold"] == "not_executed"
    assert Q.freshness_of_layers(marks.limit(0), 2, ["source"]).count() == 0
    first = {r.source: r.status for r in Q.freshness_of_layers(marks, 1, ["source"]).collect()}
    assert set(first.values()) == {"advanced"}
    only = marks.filter("event = 'executed'")
    assert {r.status for r in Q.freshness_of_layers(only.filter("source = 'moves'"), 2, ["source"]).collect()} == {"empty"}
