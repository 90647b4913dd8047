"""Tables whose content is replaced whole or not at all.

A table is a list of months and the folders that hold them. A change writes new folders, for the
months that it touches alone, and then appends one file to a list of versions; readers take the
folders of the last version. A change that fails before has written nothing that a reader sees.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.revisions import assert_unique_keys, join_keyed, merge_keyed

ENTRIES = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("change", T.StringType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("path", T.StringType()),
])
#: The month of rows without a date.
UNDATED = -1


def month_number(date_col: str) -> Column:
    """Months since the year 0; UNDATED for nulls."""
    return F.coalesce((F.year(date_col) * 12 + F.month(date_col) - 1).cast("int"), F.lit(UNDATED))


def entries(spark: SparkSession, log: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(log)


def months_of(spark: SparkSession, log: str, table: str) -> tuple[int, dict[int, str]]:
    """The last version of a table, 0 if it has none, and the folder of each of its months. Of two
    changes that took the same number, only the first in order of their names counts."""
    own = entries(spark, log).filter(F.col("table_name") == table)
    last = own.agg(F.max("version")).first()[0]
    if last is None:
        return 0, {}
    found = own.filter(F.col("version") == last)
    change = found.agg(F.min("change")).first()[0]
    return last, {r["month"]: r["path"] for r in found.filter((F.col("change") == change) & F.col("path").isNotNull()).collect()}


def read_version(spark: SparkSession, log: str, table: str, schema: T.StructType, months: list[int] | None = None) -> DataFrame:
    """The table as its last version has it, or some of its months. No version: no rows."""
    _, parts = months_of(spark, log, table)
    paths = [p for m, p in parts.items() if months is None or m in months]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def commit(spark: SparkSession, log: str, table: str, version: int, parts: dict[int, str]) -> None:
    """Append a version: one file, seen whole or not at all. Raises if another change took the number."""
    change = uuid.uuid4().hex
    rows = [(table, version, change, m, p) for m, p in parts.items()] or [(table, version, change, None, None)]
    spark.createDataFrame(rows, ENTRIES).coalesce(1).write.mode("append").parquet(log)
    first = entries(spark, log).filter((F.col("table_name") == table) & (F.col("version") == version)).agg(F.min("change")).first()[0]
    if first != change:
        raise RuntimeError(f"{table}: another change took version {version}")


def put_months(spark: SparkSession, log: str, folder: str, table: str, rows: DataFrame, date_col: str, months: list[int] | None) -> int:
    """A version in which ``rows`` are the content of the given months (None: of all); the others
    keep their folders. The version's number."""
    last, parts = months_of(spark, log, table)
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    rows.withColumn("month_number", month_number(date_col)).hint("rebalance", "month_number").write.partitionBy("month_number").parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    written = [f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place) if f.isDirectory()]
    kept = {} if months is None else {m: p for m, p in parts.items() if m not in months}
    commit(spark, log, table, last + 1, kept | {int(name.partition("=")[2]): f"{path}/{name}" for name in written})
    return last + 1


def replace_window(spark: SparkSession, log: str, folder: str, table: str, source: DataFrame, date_col: str, start: dt.date, end: dt.date) -> int:
    """Replace the rows of a window (inclusive dates) by the source's rows for it, so that rows which
    vanished upstream vanish here. Only the window's months are read and written; at its ends
    their rows outside the window stay. Rows without a date are in no window."""
    months = list(range(start.year * 12 + start.month - 1, end.year * 12 + end.month))
    inside = F.coalesce(F.to_date(date_col).between(F.lit(start), F.lit(end)), F.lit(False))
    stay = read_version(spark, log, table, source.schema, months).filter(~inside)
    return put_months(spark, log, folder, table, stay.unionByName(source.filter(inside)), date_col, months)


def merge_version(spark: SparkSession, log: str, folder: str, table: str, source: DataFrame, keys: list[str], date_col: str) -> dict[str, int]:
    """Merge the source by keys, the date among them, into the months that it has rows for: the
    version, source rows, and how many of them replaced a row or are new. An empty source changes
    nothing."""
    if date_col not in keys:
        raise ValueError(f"{date_col} is not among the keys, so a row's old version may lie in any month")
    assert_unique_keys(source, keys, null_safe=True)
    months = [r[0] for r in source.select(month_number(date_col)).distinct().collect()]
    if not months:
        return {"version": months_of(spark, log, table)[0], "source_rows": 0, "replaced_rows": 0, "inserted_rows": 0}
    old = read_version(spark, log, table, source.schema, months)
    replaced = join_keyed(source, old, keys, "left_semi").count()
    seen = Observation("source")
    merged = merge_keyed(old, source.observe(seen, F.count(F.lit(1)).alias("rows")), keys)
    version = put_months(spark, log, folder, table, merged, date_col, months)
    rows = seen.get["rows"]
    return {"version": version, "source_rows": rows, "replaced_rows": replaced, "inserted_rows": rows - replaced}


def publish_versions(spark: SparkSession, log: str, folder: str, tables: dict[str, tuple[DataFrame, list[str], str]]) -> DataFrame:
    """Merge each table (rows, keys, date column) in the given order; one row a table: table_name,
    status (published or failed), source_rows, replaced_rows, inserted_rows, error. A table that
    fails, for repeated keys say, keeps its last version and leaves the others alone."""
    out = []
    for name, (df, keys, date_col) in tables.items():
        try:
            got = merge_version(spark, log, folder, name, df, keys, date_col)
            out.append((name, "published", got["source_rows"], got["replaced_rows"], got["inserted_rows"], None))
        except Exception as error:  # told by table, as each is a change of its own
            out.append((name, "failed", None, None, None, type(error).__name__))
    return spark.createDataFrame(out, "table_name string, status string, source_rows long, replaced_rows long, inserted_rows long, error string")
