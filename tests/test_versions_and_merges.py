"""Merges into months, versions of tables, null and empty keys, fallback verdicts, verification."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dayfacts import sinks, versions
from dayfacts.operators import completeness as C
from dayfacts.operators import quality as Q
from dayfacts.operators import revisions as R
from dayfacts.sources import tables

D = dt.date
SCHEMA = "k string, day date, v long"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns or df.columns).collect()), key=repr)


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_null_and_empty_strings_are_one_key(spark):
    old = spark.createDataFrame([("a", "", 1), ("b", None, 2), ("c", "x", 3)], "k string, t string, v long")
    new = spark.createDataFrame([("a", None, 10), ("b", "", 20), ("d", None, 40)], "k string, t string, v long")
    assert rows(R.merge_keyed(old, new, ["k", "t"])) == [("a", None, 10), ("b", "", 20), ("c", "x", 3), ("d", None, 40)]
    assert rows(R.missing_keys(new, old, ["k", "t"])) == [("d", None, 40)]
    assert rows(R.missing_keys(old, old, ["k", "t"])) == []
    assert len(rows(R.merge_keyed(old, new, ["k", "t"], null_safe=False))) == 6
    with pytest.raises(ValueError):
        R.assert_unique_keys(spark.createDataFrame([("a", ""), ("a", None)], "k string, t string"), ["k", "t"], null_safe=True)


def test_merge_touches_only_its_months(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("", D(2024, 2, 1), 2), ("c", D(2024, 3, 1), 3), ("d", D(2024, 2, 29), 4), ("e", None, 5)], SCHEMA)
    sinks.write_by_month(old, path, "day")
    before = files(path)
    new = spark.createDataFrame([(None, D(2024, 2, 1), 20), ("f", D(2024, 4, 1), 6)], SCHEMA)
    assert sinks.merge_months(new, path, ["k", "day"], "day") == 2
    kept = {f for f in before if "month=2" not in f}
    assert kept <= files(path) and len(kept) == 3 and not {f for f in before if "year=2024/month=2/" in f} & files(path)
    assert rows(tables.read_batch(spark, path, old.schema, recursive=True)) == sorted([("a", D(2024, 1, 1), 1), (None, D(2024, 2, 1), 20), ("c", D(2024, 3, 1), 3), ("d", D(2024, 2, 29), 4), ("e", None, 5), ("f", D(2024, 4, 1), 6)], key=repr)
    sinks.merge_months(spark.createDataFrame([("e", None, 50)], SCHEMA), path, ["k", "day"], "day")
    assert ("e", None, 50) in rows(tables.read_batch(spark, path, old.schema, recursive=True))
    sinks.merged_months(new, spark.read.parquet(path), ["k", "day"], "day").explain("formatted")
    assert "PartitionFilters: [coalesce" in capsys.readouterr().out
    with pytest.raises(ValueError):
        sinks.merge_months(new, path, ["k"], "day")
    with pytest.raises(ValueError):
        sinks.merge_months(new.unionByName(new), path, ["k", "day"], "day")


@pytest.fixture
def store(spark, tmp_path):
    log, data = str(tmp_path / "log"), str(tmp_path / "data")
    rows_ = spark.createDataFrame([("a", D(2024, 1, 10), 1), ("b", D(2024, 1, 20), 2), ("c", D(2024, 2, 5), 3), ("d", D(2024, 3, 5), 4), ("e", None, 5)], SCHEMA)
    versions.put_months(spark, log, data, "t", rows_, "day", None)
    return log, data, rows_


def test_window_appears_whole_or_not_at_all(spark, store):
    log, data, first = store
    read = lambda: rows(versions.read_version(spark, log, "t", first.schema))
    broken = spark.createDataFrame([("x", D(2024, 2, 6), 9)], SCHEMA).withColumn("v", F.when(F.col("v") == 9, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        versions.replace_window(spark, log, data, "t", broken, "day", D(2024, 1, 15), D(2024, 2, 28))
    assert read() == rows(first)
    last, parts = versions.months_of(spark, log, "t")
    assert versions.replace_window(spark, log, data, "t", spark.createDataFrame([("b", D(2024, 1, 21), 20), ("z", D(2024, 4, 1), 1)], SCHEMA), "day", D(2024, 1, 15), D(2024, 2, 28)) == last + 1
    assert read() == sorted([("a", D(2024, 1, 10), 1), ("b", D(2024, 1, 21), 20), ("d", D(2024, 3, 5), 4), ("e", None, 5)], key=repr)
    march, undated = 2024 * 12 + 2, versions.UNDATED
    now = versions.months_of(spark, log, "t")[1]
    assert now[march] == parts[march] and now[undated] == parts[undated] and 2024 * 12 + 1 not in now
    versions.replace_window(spark, log, data, "t", first.limit(0), "day", D(2024, 1, 1), D(2024, 12, 31))
    assert read() == [("e", None, 5)]


def test_no_version_and_a_number_taken_twice(spark, store, tmp_path):
    log, data, first = store
    assert rows(versions.read_version(spark, log, "other", first.schema)) == []
    assert rows(versions.read_version(spark, str(tmp_path / "none"), "t", first.schema)) == []
    taken = 0
    for _ in range(8):  # the change with the smaller name wins, the others are told
        try:
            versions.commit(spark, log, "t", 2, {1: "p"})
        except RuntimeError:
            taken += 1
    assert 0 < taken < 8 or taken == 7


def test_publish_tells_what_became_of_each_table(spark, store):
    log, data, first = store
    new = spark.createDataFrame([("a", D(2024, 1, 10), 10), (None, D(2024, 2, 6), 7)], SCHEMA)
    got = versions.publish_versions(spark, log, data, {"u": (new.unionByName(new), ["k", "day"], "day"), "t": (new, ["k", "day"], "day"), "w": (new, ["k"], "day")})
    assert rows(got) == [("t", "published", 2, 1, 1, None), ("u", "failed", None, None, None, "ValueError"), ("w", "failed", None, None, None, "ValueError")]
    assert rows(versions.read_version(spark, log, "t", first.schema)) == sorted([("a", D(2024, 1, 10), 10), ("b", D(2024, 1, 20), 2), ("c", D(2024, 2, 5), 3), (None, D(2024, 2, 6), 7), ("d", D(2024, 3, 5), 4), ("e", None, 5)], key=repr)


def test_fallback_is_judged_again(spark):
    make = lambda r: spark.createDataFrame(r, "g string, day int, o int")
    primary = make([("whole", 1, 1), ("whole", 2, 1), ("half", 1, 1), ("short", 1, 1), ("over", 1, 1)])
    other = make([("whole", 1, 9), ("half", 1, 9), ("half", 2, 9), ("late", 1, 9), ("late", 2, 9), ("over", 1, 9)])
    expected = spark.createDataFrame([(g, 2) for g in ("whole", "half", "short", "late", "none", "over")], "g string, expected int")
    found, outcome = R.resolve_fallback(primary, other, ["g", "day"], ["g"], "day", expected, "o")
    assert rows(found) == sorted([("whole", 1, 1), ("whole", 2, 1), ("half", 1, 1), ("half", 2, 9), ("short", 1, 1), ("late", 1, 9), ("late", 2, 9), ("over", 1, 1)], key=repr)
    assert rows(outcome, "g", "status", "served_by", "primary_days", "days") == [("half", "success", "both", 1, 2), ("late", "success", "alternative", 0, 2), ("none", "unavailable", "none", 0, 0), ("over", "failed", "primary", 1, 1), ("short", "failed", "primary", 1, 1), ("whole", "success", "primary", 2, 2)]


def test_verification_shows_the_first_missing_keys(spark):
    staged = spark.createDataFrame([("s", i % 7, None if i % 2 else "") for i in range(40)] + [("t", 1, "x")], "src string, k int, f string")
    loaded = spark.createDataFrame([(1, "x"), (0, None)], "k int, f string")
    got = {r["src"]: r for r in R.verify_loaded(staged, loaded, ["k", "f"], "src").collect()}
    assert (got["t"]["status"], got["t"]["sample_keys"]) == ("verified", None)
    assert (got["s"]["status"], got["s"]["staged_rows"], got["s"]["missing_rows"]) == ("missing_rows", 40, 34)
    assert [tuple(x) for x in got["s"]["sample_keys"]] == [(1, None), (1, ""), (2, None), (2, ""), (3, None)]
    assert {(r["status"], r["missing_rows"]) for r in R.verify_loaded(staged, None, ["k", "f"], "src").collect()} == {("no_table", 40), ("no_table", 1)}
    assert tables.read_table(spark, "no_such_table", optional=True) is None


def test_prints_of_files_do_not_depend_on_order(spark):
    listed = [("a", f"f{i}", i) for i in range(50)] + [("b", "f1", 1), ("c", "x", 1)]
    make = lambda r: spark.createDataFrame(r, "batch string, path string, length long")
    assert rows(C.file_prints(make(listed))) == rows(C.file_prints(make(listed[::-1] + listed[:3]).repartition(7)))
    state = C.file_prints(make(listed))
    assert rows(C.batches_to_load(make([*listed[:49], ("a", "f49", 50), ("b", "f1", 1), ("d", "y", 1)]), state)) == [("a",), ("d",)]


def test_every_failed_rule_is_told_in_one_pass(spark, tmp_path, capsys):
    df = spark.createDataFrame([(1, 5, "x"), (2, -1, None), (3, None, "x"), (4, 7, "y")], "id int, v int, s string")
    marked = Q.judged(df, {"v": (F.col("v") > 0, "not positive"), "s": (F.col("s") == "x", "unknown")})
    assert {r["id"]: [tuple(f) for f in r["failed_rules"]] for r in marked.collect()} == {1: [], 2: [("v", "not positive"), ("s", "unknown")], 3: [("v", "not positive")], 4: [("s", "unknown")]}
    path = str(tmp_path / "q")
    sinks.write_by_outcome(marked, path)
    back = spark.read.parquet(path)
    assert rows(back.filter("outcome = 'good'"), "id", "v", "s") == [(1, 5, "x")]
    now = F.lit(dt.date(2024, 1, 1))
    found = Q.rejections(back.filter("outcome = 'rejected'"), source_system=F.lit("m"), country=F.col("s"), dataset=F.lit("d"), processing_date=now, record_id=F.col("id"), ingested_at=now)
    assert rows(found, "record_id", "rule") == [(2, "s"), (2, "v"), (3, "v"), (4, "s")]
    good, bad = Q.quarantine(df, {"v": (F.col("v") > 0, "not positive"), "s": (F.col("s") == "x", "unknown")})
    assert rows(good) == [(1, 5, "x")] and rows(bad, "id", "rule") == [(2, "v"), (3, "v"), (4, "s")]
