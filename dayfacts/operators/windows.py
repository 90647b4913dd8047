"""Processing windows: padded reads of raw rows, exact restriction of daily results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def padded_bounds(start: dt.date, end: dt.date, pad_days: int = 1) -> tuple[dt.datetime, dt.datetime]:
    """Inclusive lower and exclusive upper instant for local dates start..end: local days draw on
    the neighbouring UTC days."""
    midnight = dt.time(0)
    return dt.datetime.combine(start - dt.timedelta(days=pad_days), midnight), dt.datetime.combine(end + dt.timedelta(days=pad_days + 1), midnight)


def padded_read(df: DataFrame, column: str, start: dt.date, end: dt.date, *, pad_days: int = 1) -> DataFrame:
    """Rows of the padded window; bounds are literals of the column's type, so Parquet can skip."""
    low, high = padded_bounds(start, end, pad_days)
    kind = df.schema[column].dataType.simpleString()
    if kind == "string":
        return df.filter((F.col(column) >= f"{low:%Y-%m-%d}") & (F.col(column) < f"{high:%Y-%m-%d}"))
    return df.filter((F.col(column) >= F.lit(str(low)).cast(kind)) & (F.col(column) < F.lit(str(high)).cast(kind)))


def restrict(df: DataFrame, start: dt.date, end: dt.date, *, column: str = "local_date") -> DataFrame:
    """Exactly the dates of the window, both ends included."""
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def date_key_bounds(start: dt.date, end: dt.date) -> tuple[int, int]:
    return int(f"{start:%Y%m%d}"), int(f"{end:%Y%m%d}")


def date_key_range(df: DataFrame, start: dt.date, end: dt.date, *, column: str = "date_key") -> DataFrame:
    low, high = date_key_bounds(start, end)
    return df.filter(F.col(column).between(low, high))


def of_dataset(df: DataFrame, *datasets: str, column: str = "dataset_type") -> DataFrame:
    """The rows of some series of a raw table; of a table partitioned by them, only their folders
    are read. A null is of no dataset."""
    return df.filter(F.col(column).isin(*datasets))


def trim_to_days(df: DataFrame, column: str, start: dt.date, end: dt.date) -> DataFrame:
    """Points within the requested UTC days."""
    return df.filter(F.to_date(column).between(F.lit(start), F.lit(end)))


def last_complete_month(day: Column) -> Column:
    """The first day of the month before that of a day."""
    return F.trunc(F.add_months(day, -1), "month").cast("date")


def month_chunks(months: DataFrame, month_col: str, *, buffer_days: int, chunk_days: int) -> DataFrame:
    """The rows with chunk_start and chunk_end: the month, padded by some days on either side, cut into
    windows of at most ``chunk_days`` days, one row each. A null month has no row."""
    if buffer_days < 0 or chunk_days < 1:
        raise ValueError("a buffer of 0 or more days and chunks of at least one are needed")
    first = F.date_sub(F.trunc(month_col, "month").cast("date"), buffer_days)
    last = F.date_add(F.last_day(month_col), buffer_days)
    starts = F.explode(F.sequence(first, last, F.expr(f"interval {int(chunk_days)} day"))).alias("chunk_start")
    cut = months.select("*", last.alias("_last"), starts)
    return cut.select(*months.columns, "chunk_start", F.least(F.date_add("chunk_start", chunk_days - 1), "_last").alias("chunk_end"))
