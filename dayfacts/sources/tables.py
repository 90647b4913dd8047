"""Scans of Parquet, CSV and catalog tables, records in memory, generated date spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_batch(spark: SparkSession, path: str, schema: T.StructType, *, recursive: bool = False) -> DataFrame:
    """A Parquet batch as the owned schema: columns by name, in its order. ``recursive`` reads
    nested folders without taking their names for partitions."""
    reader = spark.read.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(path).select(*schema.names)


def read_table(spark: SparkSession, name: str, *, optional: bool = False) -> DataFrame | None:
    """A catalog table; None for a missing one if that is allowed."""
    if optional and not spark.catalog.tableExists(name):
        return None
    return spark.table(name)


def from_records(spark: SparkSession, records: list[dict], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in records], schema)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def listed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and length of the files below a folder; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "length")


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))
