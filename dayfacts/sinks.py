"""Writing results: versioned merges, partitioned layouts, serving tables.

A merge never overwrites what its plan reads: the new content goes to a fresh folder, and the
caller points readers to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.quality import table_checks
from .operators.revisions import assert_unique_keys, merge_keyed
from .sources.schemas import ensure_compatible

#: Digits and decimals of the serving columns.
SERVING_TYPES = {
    "daily_demand_mwh": (14, 3),
    "total_generation_mwh": (14, 3),
    "renewable_generation_mwh": (14, 3),
    "generation_mwh": (14, 3),
    "avg_day_ahead_price_eur_mwh": (10, 3),
    "min_day_ahead_price_eur_mwh": (10, 3),
    "max_day_ahead_price_eur_mwh": (10, 3),
    "renewable_generation_pct": (5, 2),
    "generation_share_pct": (5, 2),
    "urban_population_pct": (5, 2),
    "population": (14, 0),
    "gdp_constant_2015_usd": (20, 3),
    "gdp_per_capita_constant_2015_usd": (14, 3),
    "demand_kwh_per_capita": (10, 3),
    "avg_temperature_c": (6, 2),
    "avg_wind_speed_kmh": (6, 2),
    "solar_radiation_mj_m2": (8, 3),
}


def serving_projection(df: DataFrame) -> DataFrame:
    """Fixed-point types for the columns that have one; others stay."""

    def typed(c: str) -> Column:
        return F.col(c).cast("decimal({},{})".format(*SERVING_TYPES[c])).alias(c) if c in SERVING_TYPES else F.col(c)

    return df.select(*[typed(c) for c in df.columns])


def write_merged(spark: SparkSession, source: DataFrame, keys: list[str], new_path: str, old_path: str | None = None, *, null_safe: bool = True) -> int:
    """Write old content merged with ``source`` to ``new_path``; the number of source rows, counted
    during the write. Keys must be unique in the source, and the schemas must agree."""
    assert_unique_keys(source, keys, null_safe=null_safe)
    seen = Observation("source")
    out = source.observe(seen, F.count(F.lit(1)).alias("rows"))
    if old_path:
        target = spark.read.parquet(old_path)
        ensure_compatible(target.schema, source.schema, old_path)
        out = merge_keyed(target, out, keys, null_safe=null_safe)
    out.write.parquet(new_path)
    return seen.get["rows"] if not source.isEmpty() else 0


def month_of(year: str = "year", month: str = "month") -> Column:
    return F.coalesce(F.col(year) * 12 + F.col(month), F.lit(-1))


def merged_months(source: DataFrame, target: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """The months of a layout by year and month that the source has rows for, merged with it. Only
    their partitions of the target are read. The date must be among the keys, as an older version
    of a row could lie in any month otherwise."""
    if date_col not in keys:
        raise ValueError(f"{date_col} is not among the keys, so a row's old version may lie in any month")
    dated = source.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))
    touched = [r[0] for r in dated.select(month_of()).distinct().collect()]  # months of a calendar
    old = target.filter(month_of().isin(touched))
    return merge_keyed(old, dated, keys)


def merge_months(source: DataFrame, path: str, keys: list[str], date_col: str) -> int:
    """Merge into a layout of ``write_by_month``; the number of source rows, counted during the write.

    Keys must be unique in the source, null and the empty string being one key. Only partitions
    with source rows are read and, by dynamic overwrite, replaced; files of others are not
    touched. Rows without a date have a partition of their own.
    """
    spark = source.sparkSession
    assert_unique_keys(source, keys, null_safe=True)
    target = spark.read.parquet(path)
    ensure_compatible(target.drop("year", "month").schema, source.schema, path)
    if source.isEmpty():
        return 0
    seen = Observation("source")
    merged = merged_months(source.observe(seen, F.count(F.lit(1)).alias("rows")), target, keys, date_col)
    merged.hint("rebalance", "year", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)
    return seen.get["rows"]


def rebuild(df: DataFrame, table: str) -> DataFrame:
    """Replace a table of the catalog with all rows of ``df``, whatever its schema was; the table."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
    return df.sparkSession.table(table)


def write_by_month(df: DataFrame, path: str, date_col: str) -> None:
    """``year=/month=`` folders, with one writing task for each month that has not too many rows."""
    dated = df.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))
    dated.hint("rebalance", "year", "month").write.partitionBy("year", "month").parquet(path)


def write_by_outcome(marked: DataFrame, path: str) -> None:
    """The rows of ``quality.judged`` in one pass: good and rejected ones in folders of their own."""
    marked.withColumn("outcome", F.when(F.size("failed_rules") > 0, "rejected").otherwise("good")).write.partitionBy("outcome").parquet(path)


def publish(tables: dict[str, tuple[DataFrame, list[str]]], write, order: list[str]) -> dict[str, str]:
    """Validate and write each table in the given order; what became of each. One table's failure
    leaves the others alone. ``write(name, df)`` does the keyed upsert, from the executors."""
    out = {}
    for name in order:
        df, keys = tables[name]
        try:
            failed = table_checks(df, keys, {}).filter("n_failed > 0").select("check_name").collect()
            if failed:
                raise ValueError(f"{name}: {sorted(r[0] for r in failed)}")
            write(name, serving_projection(df))
            out[name] = "published"
        except Exception as error:  # reported by table, as each is a transaction of its own
            out[name] = f"failed: {error}"
    return out


def jdbc_upsert(url: str, keys: dict[str, list[str]], options: dict[str, str] | None = None):
    """A ``write`` for ``publish``: rows go to a staging table over JDBC from the executors, then
    one transaction on the server replaces and inserts by key. ``options`` are the JDBC writer's,
    such as createTableColumnTypes where a database cannot compare its default text type."""

    def write(name: str, df: DataFrame) -> None:
        staged = f"{name}_staged"
        df.write.jdbc(url, staged, mode="overwrite", properties=options or {})
        session = df.sparkSession
        quote = '"{}"'.format  # as the JDBC writer names columns
        match = " and ".join(f"s.{quote(k)} = t.{quote(k)}" for k in keys[name])
        columns = ", ".join(map(quote, df.columns))
        connection = session._jvm.java.sql.DriverManager.getConnection(url)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            statement.executeUpdate(f"delete from {name} t where exists (select 1 from {staged} s where {match})")
            statement.executeUpdate(f"insert into {name} ({columns}) select {columns} from {staged}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    return write
