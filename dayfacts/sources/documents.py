"""XML and JSON documents to rows, with built-in parsers only.

Documents are a string column; malformed ones raise where ``strict`` is true and otherwise come
out of the ``classify_*`` expressions, so that a quarantine can keep them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import duration_hours
from .schemas import ENERGY

_POINT = "struct<position:int,quantity:double,`price.amount`:double>"
_PERIOD = f"struct<timeInterval:struct<start:string,end:string>,resolution:string,Point:array<{_POINT}>>"
_SERIES = f"struct<businessType:string,MktPSRType:struct<psrType:string>,`quantity_Measure_Unit.name`:string,`currency_Unit.name`:string,Period:array<{_PERIOD}>>"
MARKET_DOCUMENT = f"struct<mRID:string,TimeSeries:array<{_SERIES}>>"
ACKNOWLEDGEMENT = "struct<mRID:string,Reason:array<struct<code:string,text:string>>>"

#: The data element of a point by dataset, the expected roots, and reason texts of empty answers.
VALUE_TAGS = {"load": "quantity", "generation": "quantity", "price": "price.amount"}
ROOTS = {"load": "GL_MarketDocument", "generation": "GL_MarketDocument", "price": "Publication_MarketDocument"}
NO_DATA_TEXTS = ["no matching data"]


def _plain(xml: Column) -> Column:
    """Without declaration and namespaces, which the row parser does not need."""
    return F.regexp_replace(F.regexp_replace(xml, r"^\s*<\?xml[^>]*\?>\s*", ""), r'\sxmlns(:\w+)?="[^"]*"', "")


def root_tag(xml: Column) -> Column:
    return F.regexp_extract(_plain(xml), r"^\s*<(?:\w+:)?([\w.]+)", 1)


def classify_market_xml(xml: Column, dataset: str) -> Column:
    """data, no_data, or error. An acknowledgement is no_data by the text of its reason: its code
    also stands for real errors. Null, empty, malformed and unexpected documents are errors."""
    text = _plain(xml)
    root = root_tag(xml)
    closes = F.rtrim(F.regexp_replace(text, r"\s+$", "")).endswith(F.concat(F.lit("</"), root, F.lit(">")))
    reason = F.lower(F.coalesce(F.array_join(F.transform(F.from_xml(text, ACKNOWLEDGEMENT)["Reason"], lambda r: r["text"]), " "), F.lit("")))
    empty = F.lit(False)
    for marker in NO_DATA_TEXTS:
        empty = empty | reason.contains(marker)
    parsed = F.from_xml(text, MARKET_DOCUMENT, {"mode": "PERMISSIVE"})["mRID"].isNotNull()
    return F.when(closes & (root == "Acknowledgement_MarketDocument") & empty, "no_data").when(closes & (root == ROOTS[dataset]) & parsed, "data").otherwise("error")


def parse_market_xml(docs: DataFrame, dataset: str, *, xml_col: str = "document", strict: bool = True) -> DataFrame:
    """One row for each point, and the other columns of the document's row: resolution,
    source_timestamp (start of the period plus (position - 1) resolutions; missing positions stay
    missing), value, unit, currency, production_type_raw, business_type, source_document_mrid."""
    kept = [c for c in docs.columns if c != xml_col]
    status = classify_market_xml(F.col(xml_col), dataset)
    checked = docs.withColumn("_status", status)
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a document of the dataset: "), F.coalesce(F.substring(xml_col, 1, 80), F.lit("null"))))
        checked = checked.withColumn("_status", F.when(F.col("_status") == "error", bad.cast("string")).otherwise(F.col("_status")))
    data = checked.filter("_status = 'data'").withColumn("_d", F.from_xml(_plain(F.col(xml_col)), MARKET_DOCUMENT))
    series = data.select(*kept, F.trim("_d.mRID").alias("source_document_mrid"), F.explode("_d.TimeSeries").alias("_s"))
    periods = series.select(
        *kept,
        "source_document_mrid",
        F.trim("_s.businessType").alias("business_type"),
        F.trim("_s.MktPSRType.psrType").alias("production_type_raw"),
        F.trim(F.col("_s.`quantity_Measure_Unit.name`")).alias("unit"),
        F.trim(F.col("_s.`currency_Unit.name`")).alias("currency"),
        F.explode("_s.Period").alias("_p"),
    )
    timed = periods.withColumn("resolution", F.trim("_p.resolution")).withColumn("_start", F.to_timestamp(F.trim("_p.timeInterval.start"), "yyyy-MM-dd'T'HH:mmX"))
    points = timed.withColumn("_hours", duration_hours(F.col("resolution"), strict=strict)).withColumn("_q", F.explode("_p.Point"))
    seconds = ((F.col("_q.position") - 1) * F.col("_hours") * 3600).cast("long")
    return points.select(
        *kept,
        "resolution",
        F.timestamp_seconds(F.unix_timestamp("_start") + seconds).alias("source_timestamp"),
        F.col(f"_q.`{VALUE_TAGS[dataset]}`").alias("value"),
        "unit",
        "currency",
        "production_type_raw",
        "business_type",
        "source_document_mrid",
    ).filter(F.col("value").isNotNull())


def market_rows_to_raw(points: DataFrame, *, strict: bool = True) -> DataFrame:
    """Points as raw rows with an ISO-8601 UTC text time; a missing business type is rejected."""
    if strict:
        kind = F.coalesce(F.col("business_type"), F.raise_error(F.lit("a series without business type")).cast("string"))
        points = points.withColumn("business_type", kind)
    else:
        points = points.filter(F.col("business_type").isNotNull())
    return points.withColumn("source_timestamp", F.date_format("source_timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")).withColumnRenamed("resolution", "source_resolution")


def raw_table(points: DataFrame, *, domain: Column, dataset: str, start: Column, end: Column, source_system: str, ingested_at: Column, strict: bool = True) -> DataFrame:
    """Points of ``parse_market_xml``, whose documents also have a country_code, as rows of the raw
    energy table: every column of its schema, in its order."""
    rows = market_rows_to_raw(points, strict=strict)
    told = {"domain": domain, "dataset_type": F.lit(dataset), "requested_start_date": start, "requested_end_date": end, "source_system": F.lit(source_system), "ingestion_timestamp": ingested_at}
    return rows.withColumns(told).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENERGY])


def parse_daily_json(docs: DataFrame, variables: list[str], *, json_col: str = "document") -> DataFrame:
    """Daily JSON with parallel arrays to tall rows: the other columns, the coordinates, zone and
    offset that came back, observation_date, source_variable, source_value, source_unit. Arrays
    of another length than the dates raise."""
    kept = [c for c in docs.columns if c != json_col]
    daily = ",".join(f"`{v}`:array<double>" for v in variables)
    units = ",".join(f"`{v}`:string" for v in variables)
    schema = f"struct<latitude:double,longitude:double,timezone:string,utc_offset_seconds:long,daily_units:struct<{units}>,daily:struct<time:array<string>,{daily}>>"
    parsed = docs.withColumn("_d", F.from_json(json_col, schema))

    def block(v: str) -> Column:
        values, days = F.col(f"_d.daily.`{v}`"), F.col("_d.daily.time")
        same = F.when(F.size(values) == F.size(days), values).otherwise(F.raise_error(F.lit(f"{v} does not match the dates")).cast("array<double>"))

        def row(day: Column, value: Column) -> Column:
            return F.struct(day.alias("observation_date"), F.lit(v).alias("source_variable"), value.alias("source_value"), F.col(f"_d.daily_units.`{v}`").alias("source_unit"))

        return F.zip_with(days, same, row)

    return parsed.select(
        *kept,
        F.col("_d.latitude").alias("returned_latitude"),
        F.col("_d.longitude").alias("returned_longitude"),
        F.col("_d.timezone").alias("returned_timezone"),
        F.col("_d.utc_offset_seconds").alias("utc_offset_seconds"),
        F.explode(F.concat(*[block(v) for v in variables])).alias("_r"),
    ).select(*kept, "returned_latitude", "returned_longitude", "returned_timezone", "utc_offset_seconds", "_r.*")


def parse_indicator_json(docs: DataFrame, *, json_col: str = "document") -> DataFrame:
    """``[metadata, records]`` to rows: country_code, country_name, indicator_code, indicator_name,
    year, value. ``[metadata, null]`` gives none; a message in the metadata, and what is no such
    list, raises."""
    kept = [c for c in docs.columns if c != json_col]
    v = F.try_parse_json(F.col(json_col))
    message = F.try_variant_get(v, "$[0].message", "string")
    head = F.try_variant_get(v, "$[0]", "string")
    record = "struct<indicator:struct<id:string,value:string>,country:struct<id:string,value:string>,date:string,value:double>"
    records = F.try_variant_get(v, "$[1]", f"array<{record}>")
    checked = F.when(message.isNotNull() | head.isNull(), F.raise_error(F.concat(F.lit("source error: "), F.coalesce(message, F.col(json_col), F.lit("null")))).cast(f"array<{record}>")).otherwise(records)
    rows = docs.select(*kept, F.explode(checked).alias("_r"))
    return rows.select(
        *kept,
        F.col("_r.country.id").alias("country_code"),
        F.col("_r.country.value").alias("country_name"),
        F.col("_r.indicator.id").alias("indicator_code"),
        F.col("_r.indicator.value").alias("indicator_name"),
        F.col("_r.date").cast("int").alias("year"),
        F.col("_r.value").alias("value"),
    )
