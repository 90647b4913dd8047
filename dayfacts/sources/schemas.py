"""Schemas that the application owns, and how an existing table is compared with them."""

from __future__ import annotations

from pyspark.sql import types as T

#: The layout of the raw tables.
ENERGY = T.StructType([
    T.StructField("country_code", T.StringType(), nullable=False),
    T.StructField("domain", T.StringType(), nullable=False),
    T.StructField("dataset_type", T.StringType(), nullable=False),
    T.StructField("source_timestamp", T.StringType(), nullable=False),
    T.StructField("source_resolution", T.StringType(), nullable=False),
    T.StructField("value", T.DoubleType(), nullable=False),
    T.StructField("unit", T.StringType()),
    T.StructField("production_type_raw", T.StringType()),
    T.StructField("business_type", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("requested_start_date", T.StringType(), nullable=False),
    T.StructField("requested_end_date", T.StringType(), nullable=False),
    T.StructField("source_document_mrid", T.StringType()),
    T.StructField("source_system", T.StringType(), nullable=False),
    T.StructField("ingestion_timestamp", T.StringType(), nullable=False),
])
WEATHER = T.StructType([
    T.StructField("country_code", T.StringType(), nullable=False),
    T.StructField("country_name", T.StringType(), nullable=False),
    T.StructField("reference_location", T.StringType(), nullable=False),
    T.StructField("latitude", T.DoubleType(), nullable=False),
    T.StructField("longitude", T.DoubleType(), nullable=False),
    T.StructField("timezone", T.StringType(), nullable=False),
    T.StructField("returned_latitude", T.DoubleType()),
    T.StructField("returned_longitude", T.DoubleType()),
    T.StructField("returned_timezone", T.StringType()),
    T.StructField("utc_offset_seconds", T.LongType()),
    T.StructField("observation_date", T.StringType(), nullable=False),
    T.StructField("source_variable", T.StringType(), nullable=False),
    T.StructField("source_value", T.DoubleType()),
    T.StructField("source_unit", T.StringType()),
    T.StructField("source_endpoint", T.StringType(), nullable=False),
    T.StructField("source_system", T.StringType(), nullable=False),
    T.StructField("ingestion_timestamp", T.StringType(), nullable=False),
])
INDICATORS = T.StructType([
    T.StructField("country_code", T.StringType(), nullable=False),
    T.StructField("country_name", T.StringType(), nullable=False),
    T.StructField("indicator_code", T.StringType(), nullable=False),
    T.StructField("indicator_name", T.StringType(), nullable=False),
    T.StructField("year", T.IntegerType(), nullable=False),
    T.StructField("value", T.DoubleType()),
    T.StructField("source_system", T.StringType(), nullable=False),
    T.StructField("ingestion_timestamp", T.StringType(), nullable=False),
])

#: Business keys of the raw tables.
KEYS = {
    "energy": ["country_code", "dataset_type", "source_timestamp", "source_resolution", "production_type_raw", "business_type"],
    "weather": ["country_code", "source_variable", "observation_date"],
    "indicators": ["country_code", "indicator_code", "year"],
}


def schema_problems(existing: T.StructType, expected: T.StructType) -> list[str]:
    """Missing, extra and mismatched columns; nullability does not count."""
    have, want = ({f.name: f.dataType for f in s} for s in (existing, expected))
    out = [f"missing column {c}" for c in want if c not in have]
    out += [f"extra column {c}" for c in have if c not in want]
    return out + [f"{c} is {have[c].simpleString()}, not {want[c].simpleString()}" for c in want if c in have and have[c] != want[c]]


def ensure_compatible(existing: T.StructType, expected: T.StructType, table: str) -> None:
    if found := schema_problems(existing, expected):
        raise ValueError(f"{table}: {'; '.join(found)}")
