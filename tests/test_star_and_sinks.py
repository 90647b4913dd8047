import datetime as dt

import pytest
from pyspark.sql import types as T

from dayfacts import sinks
from dayfacts.plans import star
from dayfacts.sources import schemas, tables

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def dims(spark):
    countries = spark.createDataFrame([("ie", "Europe/Dublin"), ("de", "Europe/Berlin")], "country_code string, timezone string")
    return star.dim_country(countries), star.dim_date(spark, DAY, dt.date(2024, 1, 7))


def test_dim_date(dims):
    rows = {r.date_key: r for r in dims[1].collect()}
    assert len(rows) == 7
    monday, sunday = rows[20240101], rows[20240107]
    assert (monday.day_of_week, monday.day_name, monday.is_weekend, monday.month_name, monday.week_of_year) == (2, "Monday", False, "January", 1)
    assert (sunday.day_of_week, sunday.is_weekend) == (1, True)


def parts(spark, status, mwh=100.0):
    demand = spark.createDataFrame([("ie", DAY, 10.0, status)], "country_code string, local_date date, daily_demand_mwh double, completeness_status string")
    price = spark.createDataFrame([("ie", DAY, 1.0, 0.5, 2.0, status)], "country_code string, local_date date, avg_day_ahead_price_eur_mwh double, min_day_ahead_price_eur_mwh double, max_day_ahead_price_eur_mwh double, completeness_status string")
    mix = spark.createDataFrame([("ie", DAY, "wind", True, mwh / 4, "complete"), ("ie", DAY, "gas", False, mwh * 3 / 4, status)], "country_code string, local_date date, normalized_production_type string, renewable_flag boolean, generation_mwh double, completeness_status string")
    return demand, price, mix


def annual(spark, year=2024):
    return spark.createDataFrame([("ie", year, 1000, 5.0)], "country_code string, year int, population long, gdp_constant_2015_usd double")


def test_a_complete_day_has_all_metrics(spark, dims):
    (row,) = star.fact_energy_daily(*parts(spark, "complete"), annual(spark), *dims).collect()
    assert (row.country_key, row.date_key, row.daily_demand_mwh, row.total_generation_mwh, row.renewable_generation_pct, row.demand_kwh_per_capita) == ("IE", 20240101, 10.0, 100.0, 25.0, 10.0)


def test_a_partial_day_is_null_not_smaller(spark, dims):
    (row,) = star.fact_energy_daily(*parts(spark, "partial"), annual(spark, 2023), *dims).collect()
    assert (row.daily_demand_mwh, row.avg_day_ahead_price_eur_mwh, row.total_generation_mwh, row.renewable_generation_pct, row.population) == (None,) * 5


def test_no_generation_gives_no_percentage(spark, dims):
    (row,) = star.fact_energy_daily(*parts(spark, "complete", 0.0), annual(spark), *dims).collect()
    assert (row.total_generation_mwh, row.renewable_generation_pct) == (0.0, None)


def test_mix_shares(spark, dims):
    whole = star.fact_generation_mix_daily(parts(spark, "complete")[2], *dims).collect()
    assert {r.production_type: r.generation_share_pct for r in whole} == {"wind": 25.0, "gas": 75.0}
    part = star.fact_generation_mix_daily(parts(spark, "partial")[2], *dims).collect()
    assert {r.production_type: r.generation_share_pct for r in part} == {"wind": None}


def test_schema_comparison():
    want = schemas.INDICATORS
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in want])
    assert schemas.schema_problems(loose, want) == []
    assert schemas.schema_problems(T.StructType(want.fields[1:]), want) == ["missing column country_code"]
    wrong = T.StructType([T.StructField("year", T.StringType()) if f.name == "year" else f for f in want])
    assert schemas.schema_problems(wrong, want) == ["year is string, not int"]
    with pytest.raises(ValueError):
        schemas.ensure_compatible(T.StructType(want.fields + [T.StructField("x", T.LongType())]), want, "t")


def test_versioned_merge_and_batch_scan(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    first = tables.from_records(spark, [{"k": "a", "v": 1}, {"k": None, "v": 2}], schema)
    second = tables.from_records(spark, [{"v": 20, "k": None}, {"k": "b", "v": 3}], schema)
    assert sinks.write_merged(spark, first, ["k"], f"{tmp_path}/v1") == 2
    assert sinks.write_merged(spark, second, ["k"], f"{tmp_path}/v2", f"{tmp_path}/v1") == 2
    out = tables.read_batch(spark, f"{tmp_path}/v2", T.StructType(schema.fields[::-1]))
    assert out.columns == ["v", "k"] and sorted((r.k or "", r.v) for r in out.collect()) == [("", 20), ("a", 1), ("b", 3)]
    with pytest.raises(ValueError):
        sinks.write_merged(spark, first.union(first), ["k"], f"{tmp_path}/v3")
    assert tables.listed_files(spark, f"{tmp_path}/v1", "*.parquet").count() >= 1
    assert tables.read_table(spark, "no_such_table", optional=True) is None


def test_month_layout(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 1), (dt.date(2024, 2, 5), 2)], "d date, v int")
    sinks.write_by_month(df, f"{tmp_path}/m", "d")
    assert (tmp_path / "m/year=2024/month=2").is_dir()
    plain = tables.read_batch(spark, f"{tmp_path}/m", T.StructType.fromDDL("v int"), recursive=True)
    assert sorted(r.v for r in plain.collect()) == [1, 2]


def test_one_failing_table_leaves_the_others(spark):
    good = spark.createDataFrame([("a", 1.23456)], "k string, generation_mwh double")
    written = {}
    out = sinks.publish({"good": (good, ["k"]), "bad": (good.union(good), ["k"])}, lambda name, df: written.update({name: df.collect()}), ["bad", "good"])
    assert out["good"] == "published" and out["bad"].startswith("failed") and list(written) == ["good"]
    assert str(written["good"][0].generation_mwh) == "1.235"


def test_jdbc_upsert_replaces_by_key(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    types = {"createTableColumnTypes": "k varchar(64)"}
    old.write.jdbc(url, "facts", mode="overwrite", properties=types)
    write = sinks.jdbc_upsert(url, {"facts": ["k"]}, types)
    for _ in range(2):
        write("facts", spark.createDataFrame([("b", 20), ("c", 3)], "k string, v int"))
    assert sorted(tuple(r) for r in spark.read.jdbc(url, "facts").collect()) == [("a", 1), ("b", 20), ("c", 3)]


def test_facts_that_do_not_add_up_to_their_mix(spark):
    fact = spark.createDataFrame([("A", 1, 10.0, 4.0), ("A", 2, 10.0, 4.0), ("A", 3, None, None), ("A", 4, 10.4, 0.0)], "country_key string, date_key int, total_generation_mwh double, renewable_generation_mwh double")
    rows = [("A", 1, 6.0, False), ("A", 1, 4.0, True), ("A", 2, 6.0, False), ("A", 2, 3.0, True), ("A", 3, 1.0, True), ("A", 4, 10.0, False), ("B", 1, 5.0, True)]
    parts = spark.createDataFrame(rows, "country_key string, date_key int, generation_mwh double, renewable_flag boolean")
    got = {tuple(r) for r in star.generation_off_mix(fact, parts).collect()}
    assert got == {("A", 2, "total_generation_mwh", 10.0, 9.0), ("A", 2, "renewable_generation_mwh", 4.0, 3.0)}
