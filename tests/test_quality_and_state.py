import datetime as dt
import random

from pyspark.sql import functions as F

from dayfacts.operators import completeness as C
from dayfacts.operators import measures as M
from dayfacts.operators import quality as Q
from dayfacts.operators import reshape


def fold(spark, *statuses):
    log = spark.createDataFrame([("m", i, s) for i, s in enumerate(statuses)], "k string, t int, s string")
    return tuple(C.fold_attempts(log, ["k"], "t", "s").first())[1:]


def test_three_failures_give_up_and_a_reset_clears(spark):
    assert fold(spark, "failed") == ("failed", 1)
    assert fold(spark, "failed", "failed", "failed") == ("given_up", 3)
    assert fold(spark, "failed", "failed", "success", "failed") == ("failed", 3)
    assert fold(spark, "failed", "failed", "failed", "reset") == ("failed", 0)
    assert fold(spark, "failed", "failed", "failed", "reset", "failed") == ("failed", 1)
    assert fold(spark, "success", "success") == ("success", 1)


def test_a_log_cut_in_pieces_folds_like_a_whole_one(spark):
    rng, names = random.Random(3), ["failed", "failed", "failed", "success", "unavailable", "given_up", "reset", "running", None]
    rows = [(rng.choice("aaaaaabc"), rng.randrange(400), rng.choice(names)) for _ in range(900)] + [("d", None, "failed"), ("d", 1, "success"), (None, 1, "failed")]
    want = {}
    for k, _, entry in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")):
        status, attempts = want.get(k, (None, 0))
        attempts += status not in C.DONE
        spent = status not in C.DONE and entry == "failed" and attempts >= 3
        want[k] = ("failed", 0) if entry == "reset" else ("given_up" if spent else entry, attempts)
    log = spark.createDataFrame(rows, "k string, t int, s string").repartition(3)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for shares in ("1", "8", "61"):
            spark.conf.set("spark.sql.shuffle.partitions", shares)
            assert {r[0]: tuple(r)[1:] for r in C.fold_attempts(log, ["k"], "t", "s").collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert C.fold_attempts(log.limit(0), ["k"], "t", "s").count() == 0


def test_coverage_status(spark):
    rows = spark.createDataFrame([(31, 31, False), (5, 31, True), (0, 31, True), (0, 31, False), (0, 31, None)], "c int, e int, n boolean")
    got = [r[0] for r in rows.select(C.coverage_status(F.col("c"), F.col("e"), F.col("n"))).collect()]
    assert got == ["success", "failed", "unavailable", "failed", "failed"]


def test_month_coverage_counts_days_once_and_by_month(spark):
    days = spark.createDataFrame([("a", dt.date(2024, 2, 1)), ("a", dt.date(2024, 2, 1)), ("a", dt.date(2024, 3, 1)), ("a", None)], "k string, d date")
    got = {r.month_start: (r.covered_days, r.expected_days, r.missing_days) for r in C.month_coverage(days, ["k"], "d").collect()}
    assert got == {dt.date(2024, 2, 1): (1, 29, 28), dt.date(2024, 3, 1): (1, 31, 30)}


def test_availability(spark):
    rows = [("a", "x", "success"), ("a", "y", "success"), ("b", "x", "success"), ("b", "y", "failed"), ("c", "x", "failed"), ("c", "y", "unavailable"), ("d", "x", "unavailable"), ("d", "y", "unavailable"), ("d", "z", "success")]
    out = C.availability(spark.createDataFrame(rows, "country_code string, dataset string, status string"), ["x", "y"])
    assert {r.country_code: (r.availability, r.missing_datasets) for r in out.collect()} == {"a": ("complete", ""), "b": ("partially_available", "y"), "c": ("failed", "x,y"), "d": ("unavailable", "x,y")}


def test_gaps_and_overlaps(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    slots = spark.createDataFrame([("a", t(0)), ("a", t(1)), ("a", t(4)), ("a", t(4)), ("b", t(2))], "k string, s timestamp")
    assert [tuple(r) for r in C.timeline_gaps(slots, ["k"], "s", 3600).collect()] == [("a", t(2), 2)]
    spans = spark.createDataFrame([("a", 0, 10), ("a", 2, 3), ("a", 5, 6), ("a", 10, 12)], "k string, b int, e int")
    assert sorted(r.b for r in C.overlaps(spans, ["k"], "b", "e").collect()) == [2, 5]


def test_batches_reload_when_their_files_change(spark):
    cols = "batch string, path string, length long"
    now = spark.createDataFrame([("a", "1", 5), ("b", "1", 5), ("c", "1", 5)], cols)
    then = spark.createDataFrame([("a", "1", 5), ("b", "1", 6)], cols)
    assert sorted(r.batch for r in C.batches_to_load(now, then).collect()) == ["b", "c"]


def test_rules_name_the_first_failure(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, v double")
    good, bad = Q.quarantine(df, {"known": (F.col("v").isNotNull(), "no value"), "positive": (F.col("v") >= 0, "negative")})
    assert [r.id for r in good.collect()] == [1]
    assert {(r.id, r.rule) for r in bad.collect()} == {(2, "positive"), (3, "known")}


def test_range_lets_nulls_pass_and_orphans_too(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "v int")
    assert sorted(r.v for r in Q.accepted_range(df, "v", 2, 8).collect()) == [1, 9]
    assert sorted(r.v for r in Q.accepted_range(df, "v", 1, 9, inclusive=False).collect()) == [1, 9]
    assert [r.v for r in Q.orphans(df, spark.createDataFrame([(1,), (5,)], "p int"), "v", "p").collect()] == [9]


def test_reconciliation_has_a_tolerance_and_reports_nulls_apart(spark):
    a = spark.createDataFrame([("x", 10.0), ("y", 10.0), ("z", None)], "k string, v double")
    b = spark.createDataFrame([("x", 10.4), ("y", 11.0), ("z", 1.0)], "k string, v double")
    assert [r.k for r in Q.reconcile(a, b, ["k"], "v", "v").collect()] == ["y"]
    assert [r.k for r in Q.reconcile_nulls(a, b, ["k"], "v", "v").collect()] == ["z"]


def test_previous_day_is_blank_after_a_gap(spark):
    day = lambda n: dt.date(2024, 1, n)
    df = spark.createDataFrame([("a", day(1), 10.0), ("a", day(2), 15.0), ("a", day(4), 30.0), ("a", day(9), 1.0)], "k string, d date, v double")
    got = {r.d: (r.previous_value, r.change_pct) for r in M.previous_day_change(df, ["k"], "d", "v").collect()}
    assert got == {day(1): (None, None), day(2): (10.0, 50.0), day(4): (None, None), day(9): (None, None)}
    got = {r.d: r.moving_average for r in M.calendar_average(df, ["k"], "d", "v").collect()}
    assert got[day(4)] == 55 / 3 and got[day(9)] == 31 / 2


def test_period_share_is_a_ratio_of_sums_over_known_rows(spark):
    cols = "c string, daily_demand_mwh double, avg_day_ahead_price_eur_mwh double, total_generation_mwh double, renewable_generation_mwh double"
    df = spark.createDataFrame([("a", 1.0, 2.0, 100.0, 50.0), ("a", 1.0, 4.0, 300.0, 30.0), ("a", None, None, 999.0, None)], cols)
    got = {r.c: r.renewable_pct for r in M.period_measures(df, ["c"]).collect()}
    assert got == {"a": 20.0, None: 20.0}


def test_pivot_keeps_a_row_with_a_missing_variable(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0), ("c", "other", 1.0)], "k string, n string, v double")
    got = {r.k: (r.cx, r.cy) for r in reshape.pivot_variables(df, ["k"], "n", "v", {"x": "cx", "y": "cy"}).collect()}
    assert got == {"a": (1.0, 2.0), "b": (3.0, None)}


def test_keys_without_a_required_outcome_are_seen(spark):
    from dayfacts.operators import completeness

    rows = [("A", "load", "success"), ("A", "price", "failed"), ("B", "other", "success"), ("C", "load", "success"), ("C", "price", "success"), ("D", "load", "failed"), ("E", None, None)]
    out = completeness.availability(spark.createDataFrame(rows, "country_code string, dataset string, status string"), ["price", "load"])
    got = {r[0]: (r[1], r[2]) for r in out.collect()}
    assert got == {"A": ("partially_available", "price"), "B": ("unavailable", "load,price"), "C": ("complete", ""), "D": ("failed", "load,price"), "E": ("unavailable", "load,price")}


def test_rebuild_replaces_a_table(spark):
    from dayfacts import sinks

    sinks.rebuild(spark.createDataFrame([(1, "a")], "k int, v string"), "rebuilt_fact")
    out = sinks.rebuild(spark.createDataFrame([(2,), (3,)], "k int"), "rebuilt_fact")
    assert out.columns == ["k"] and sorted(r.k for r in out.collect()) == [2, 3]
    spark.sql("DROP TABLE rebuilt_fact")
