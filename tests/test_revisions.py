import datetime as dt

import pytest

from dayfacts.operators import revisions as R

ROWS = "k string, n int, v double, t long"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_wins_and_ties_do_not_depend_on_order(spark):
    rows = [("a", 1, 1.0, 1), ("a", 1, 2.0, 2), ("b", 1, 5.0, 1), ("b", 1, 9.0, 1), ("b", 1, None, 1), (None, 1, 3.0, 1)]
    want = [("a", 1, 2.0, 2), ("b", 1, 9.0, 1), (None, 1, 3.0, 1)]
    assert content(R.latest_per_key(table(spark, *rows), ["k", "n"], "t")) == sorted(want, key=str)
    assert content(R.latest_per_key(table(spark, *rows[::-1]), ["k", "n"], "t")) == sorted(want, key=str)


def test_merge_replaces_adds_and_never_deletes(spark):
    target = table(spark, ("a", 1, 1.0, 1), ("b", 1, 2.0, 1), (None, 1, 3.0, 1))
    source = table(spark, ("a", 1, 9.0, 2), ("c", 1, 8.0, 2), (None, 1, 7.0, 2))
    assert content(R.merge_keyed(target, source, ["k", "n"])) == content(table(spark, ("a", 1, 9.0, 2), ("b", 1, 2.0, 1), ("c", 1, 8.0, 2), (None, 1, 7.0, 2)))
    assert R.merge_keyed(target, source, ["k", "n"], null_safe=False).count() == 5


def test_merging_twice_changes_nothing(spark):
    target, source = table(spark, ("a", 1, 1.0, 1)), table(spark, ("a", 1, 9.0, 2), ("c", 1, 8.0, 2))
    once = R.merge_keyed(target, source, ["k", "n"])
    assert content(R.merge_keyed(once, source, ["k", "n"])) == content(once)


def test_last_write_wins_whatever_its_time(spark):
    out = R.last_write_wins(table(spark, ("a", 1, 1.0, 9)), table(spark, ("a", 1, 2.0, 1)), ["k", "n"], "t")
    assert content(out) == [("a", 1, 2.0, 1)]


def test_empty_incoming_leaves_the_target(spark):
    target = table(spark, ("a", 1, 1.0, 9))
    empty = target.limit(0)
    assert content(R.last_write_wins(target, empty, ["k"], "t")) == content(R.merge_keyed(target, empty, ["k"])) == content(target)


def test_window_reconcile_removes_what_vanished(spark):
    target = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 2, 3, 4)], "day date, v int")
    source = spark.createDataFrame([(dt.date(2024, 1, 3), 30), (dt.date(2024, 1, 9), 90)], "day date, v int")
    out = R.reconcile_window(target, source, "day", dt.date(2024, 1, 2), dt.date(2024, 1, 3))
    assert sorted(r.v for r in out.collect()) == [1, 4, 30]


def test_null_keys_match_in_the_anti_join(spark):
    a = table(spark, (None, 1, 1.0, 1), ("x", None, 1.0, 1), ("y", 1, 1.0, 1))
    b = table(spark, (None, 1, 5.0, 2), ("x", None, 5.0, 2))
    assert [r.k for r in R.missing_keys(a, b, ["k", "n"]).collect()] == ["y"]
    assert [tuple(r) for r in R.missing_by_source(a.withColumn("s", a.n), b, ["k", "n"], "t").collect()] == [(1, 3, 1)]


def test_duplicates_raise(spark):
    df = table(spark, ("a", 1, 1.0, 1), ("a", 1, 2.0, 1))
    with pytest.raises(ValueError, match="duplicate keys"):
        R.assert_unique_keys(df, ["k", "n"])
    assert R.assert_unique_keys(df, ["k", "v"]) is df


def test_fallback_completes_short_groups_only(spark):
    cols = "g string, day int, v string, o int"
    primary = spark.createDataFrame([("a", 1, "p", 1), ("a", 2, "p", 1), ("b", 1, "p", 1)], cols)
    other = spark.createDataFrame([("a", 1, "x", 5), ("b", 1, "x", 5), ("b", 2, "x", 5), ("c", 1, "x", 5)], cols)
    expected = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2)], "g string, expected int")
    out = R.union_with_fallback(primary, other, ["g", "day"], ["g"], "day", expected, "o")
    assert sorted((r.g, r.day, r.v) for r in out.collect()) == [("a", 1, "p"), ("a", 2, "p"), ("b", 1, "p"), ("b", 2, "x"), ("c", 1, "x")]
