import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dayfacts.operators import windows
from dayfacts.sources import documents as D
from dayfacts.sources import schemas

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<{root} xmlns="urn:example:{root}:3:0">\n  <mRID>doc-1</mRID>\n'


def series(points, tag="quantity", kind="A01", code=None, unit="<quantity_Measure_Unit.name>MAW</quantity_Measure_Unit.name>", start="2024-01-01T00:00Z", step="PT60M"):
    psr = f"<MktPSRType><psrType>{code}</psrType></MktPSRType>" if code else ""
    body = "".join(f"<Point><position>{p}</position><{tag}>{v}</{tag}></Point>" for p, v in points)
    return f"<TimeSeries><businessType>{kind}</businessType>{psr}{unit}<Period><timeInterval><start>{start}</start></timeInterval><resolution>{step}</resolution>{body}</Period></TimeSeries>"


def market(*parts, root="GL_MarketDocument"):
    return HEAD.format(root=root) + "".join(parts) + f"</{root}>\n"


def answer(text):
    root = "Acknowledgement_MarketDocument"
    return HEAD.format(root=root) + f"<Reason><code>999</code><text>{text}</text></Reason></{root}>"


def parsed(spark, xml, dataset="load", **options):
    docs = spark.createDataFrame([("IE", xml)], "country_code string, document string")
    return D.parse_market_xml(docs, dataset, **options)


def test_points_get_their_times_and_gaps_stay(spark):
    rows = parsed(spark, market(series([(1, 3500.5), (3, 3400.2)], kind="A04"))).collect()
    assert [(r.source_timestamp, r.value, r.unit, r.business_type, r.resolution, r.source_document_mrid) for r in rows] == [
        (dt.datetime(2024, 1, 1, 0), 3500.5, "MAW", "A04", "PT60M", "doc-1"),
        (dt.datetime(2024, 1, 1, 2), 3400.2, "MAW", "A04", "PT60M", "doc-1"),
    ]


def test_several_series_keep_code_and_business_type(spark):
    xml = market(series([(1, 80.0)], code="B10"), series([(1, 30.0)], kind="A04", code="B10"), series([(1, 5.0)], code="B16"))
    assert sorted((r.production_type_raw, r.business_type, r.value) for r in parsed(spark, xml, "generation").collect()) == [("B10", "A01", 80.0), ("B10", "A04", 30.0), ("B16", "A01", 5.0)]


def test_prices_have_their_own_element_and_currency(spark):
    body = series([(1, -5.32), (2, 45.10)], tag="price.amount", kind="A62", unit="<currency_Unit.name>EUR</currency_Unit.name>")
    rows = parsed(spark, market(body, root="Publication_MarketDocument"), "price").collect()
    assert [(r.value, r.currency, r.unit) for r in rows] == [(-5.32, "EUR", None), (45.10, "EUR", None)]


def test_answers_are_told_apart_by_their_text(spark):
    broken = HEAD.format(root="GL_MarketDocument").replace("</mRID>", "") + "<TimeSeries>\n</GL_MarketDocument>"
    docs = [(answer("No matching data found for the requested period."),), (answer("AMOUNT OF REQUESTED DATA EXCEEDS ALLOWED LIMIT"),), (market(series([(1, 1.0)])),), (broken,), ("",), (None,), ("<html></html>",)]
    got = [r[0] for r in spark.createDataFrame(docs, "x string").select(D.classify_market_xml(F.col("x"), "load")).collect()]
    assert got == ["no_data", "error", "data", "error", "error", "error", "error"]
    assert parsed(spark, docs[0][0]).count() == 0
    assert parsed(spark, broken, strict=False).count() == 0
    with pytest.raises(PySparkException):
        parsed(spark, docs[1][0]).collect()


def test_raw_rows_need_a_business_type(spark):
    points = parsed(spark, market(series([(1, 1.0)]).replace("<businessType>A01</businessType>", "")))
    with pytest.raises(PySparkException):
        D.market_rows_to_raw(points).collect()
    assert D.market_rows_to_raw(points, strict=False).count() == 0
    (row,) = D.market_rows_to_raw(parsed(spark, market(series([(2, 1.0)], step="PT15M")))).collect()
    assert row.source_timestamp == "2024-01-01T00:15:00Z"


DAILY = {"latitude": 53.39, "longitude": -6.17, "timezone": "Europe/Dublin", "utc_offset_seconds": 3600, "daily_units": {"t": "°C", "w": "km/h"}, "daily": {"time": ["2024-01-01", "2024-01-02"], "t": [4.1, None], "w": [12.0, 13.0]}}


def test_daily_json(spark):
    docs = spark.createDataFrame([("IE", json.dumps(DAILY))], "country_code string, document string")
    rows = D.parse_daily_json(docs, ["t", "w"]).collect()
    assert sorted((r.source_variable, r.observation_date, r.source_value, r.source_unit) for r in rows)[0] == ("t", "2024-01-01", 4.1, "°C")
    assert len(rows) == 4 and rows[0].returned_timezone == "Europe/Dublin" and rows[0].utc_offset_seconds == 3600
    short = json.loads(json.dumps(DAILY))
    short["daily"]["w"] = [1.0]
    with pytest.raises(PySparkException):
        D.parse_daily_json(spark.createDataFrame([("IE", json.dumps(short))], "country_code string, document string"), ["t", "w"]).collect()


def test_indicator_json(spark):
    record = {"indicator": {"id": "SP.POP.TOTL", "value": "Population, total"}, "country": {"id": "IE", "value": "Ireland"}, "date": "2023", "value": 5311538}
    cols = "document string"
    rows = D.parse_indicator_json(spark.createDataFrame([(json.dumps([{"page": 1}, [record, {**record, "value": None}]]),), (json.dumps([{"page": 1}, None]),)], cols)).collect()
    assert [(r.country_code, r.indicator_code, r.year, r.value) for r in rows] == [("IE", "SP.POP.TOTL", 2023, 5311538.0), ("IE", "SP.POP.TOTL", 2023, None)]
    for bad in (json.dumps([{"message": [{"id": "120"}]}]), "{}", "no json", None):
        with pytest.raises(PySparkException):
            D.parse_indicator_json(spark.createDataFrame([(bad,)], cols)).collect()


def test_raw_rows_have_every_column_of_the_table(spark):
    points = parsed(spark, market(series([(1, 3500.5)], kind="A04"), series([(2, 1.0)], kind="A04")))
    told = {"domain": F.lit("10Y"), "start": F.lit("2024-01-01"), "end": F.lit("2024-01-02"), "ingested_at": F.lit("2024-01-02T06:00:00Z")}
    raw = D.raw_table(points, dataset="load", source_system="market", **told)
    assert schemas.schema_problems(raw.schema, schemas.ENERGY) == [] and raw.columns == schemas.ENERGY.names
    first = raw.orderBy("source_timestamp").first().asDict()
    assert (first["source_timestamp"], first["value"], first["dataset_type"], first["requested_end_date"], first["currency"]) == ("2024-01-01T00:00:00Z", 3500.5, "load", "2024-01-02", None)
    both = raw.unionByName(raw.withColumn("dataset_type", F.lit("price"))).unionByName(raw.withColumn("dataset_type", F.lit(None).cast("string")))
    assert windows.of_dataset(both, "load").count() == 2 and windows.of_dataset(both, "load", "price").count() == 4
