"""What the corpus operators share: reading, cutting lineage, shipping task code."""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space between words, and a word, as the query contracts define them.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(module: str) -> None:
    """Send this module's task functions by value, so that workers need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder the cluster names.

    The folder comes from ``spark.checkpoint.dir``; where that is unset, as in local tests, it is
    a new one beside the tables of the session's warehouse, which all executors share.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = context.getConf().get("spark.checkpoint.dir")
        context.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return df.checkpoint(eager=True)


def local_table(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """A small table from the driver. As Arrow it goes straight to the JVM; from a list of rows
    Spark would pickle it anew on the executors, in a second Python daemon with workers of its own
    that stay, some 80 MB an executor of two cores."""
    return spark.createDataFrame(pa.table(columns))


def text_key(text: Column) -> Column:
    """The 64-bit hash of a text (null: empty) that tells apart rows which share an id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def at_end(run):
    """The task function ``run``, giving memory back to the machine when a task ends: workers are
    used again, and what a task's caches took would stay with them."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            import pyarrow

            gc.collect()
            pyarrow.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return task


def ascii_lower(col):
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, UPPER.lower())


#: Rows of a few numbers that may be broadcast: some tens of megabytes.
SMALL_ROWS = 1 << 18


def join_sized(df: DataFrame, small: DataFrame, on, how: str, limit: int = SMALL_ROWS) -> DataFrame:
    """Join a checkpointed table of few, narrow columns: broadcast if its counted rows are within
    the limit, else shuffled."""
    return df.join(F.broadcast(small) if small.limit(limit + 1).count() <= limit else small, on, how)


#: Bytes of the rows that a model is fitted on.
MODEL_BYTES = 256 << 20


def first_rows(df: DataFrame, order: list[str], weight: str | None, most: int, most_bytes: int = MODEL_BYTES) -> DataFrame:
    """The first ``most`` rows in an order, cut where the binary column ``weight`` adds up to more
    than ``most_bytes``. Tasks keep their first rows only, so a key with very many rows gathers
    nowhere; the running sum is over the rows that are left."""
    first = df.orderBy(*order).limit(most)
    if weight is None:
        return first
    running = F.sum(F.octet_length(weight)).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("_upto", running).filter(F.col("_upto") <= most_bytes).drop("_upto")


ship(__name__)
