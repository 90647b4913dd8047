"""Rows that a model is fitted on are bounded; clashing columns, missing weights, odd media files."""

import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dayfacts.llm import linking
from dayfacts.llm import media as M
from dayfacts.llm import mixing as X
from dayfacts.llm import quality, toxicity
from dayfacts.llm.common import cut, first_rows, local_table


def test_first_rows_are_bounded_by_number_and_bytes(spark):
    df = spark.range(50_000).select(F.lit(1).alias("h"), (F.col("id") % 3).alias("k"), F.lpad(F.col("id").cast("string"), 10, "0").cast("binary").alias("x"))
    assert first_rows(df, ["h", "k", "x"], "x", 40).count() == 40
    rows = first_rows(df, ["h", "k", "x"], "x", 40, 95).collect()
    assert [bytes(r["x"]).decode() for r in sorted(rows, key=lambda r: bytes(r["x"]))] == [f"{3 * i:010}" for i in range(9)]


def test_one_id_on_very_many_rows(spark):
    """Tables in which one labelled id has nearly all rows: models are fitted on few of them."""
    docs = spark.range(50_000).selectExpr("case when id < 49000 then 7 else id end AS doc_id", "concat('good words ', id, ' and then some more words of the text') AS text")
    labels = spark.range(49_000, 50_000).selectExpr("id AS doc_id", "cast(id % 2 as int) AS quality", "cast(id % 3 = 0 as int) AS toxic").union(spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int"))
    assert toxicity.label_chain(docs, labels, max_rows=200, max_bytes=1 << 20).categories == ["low_quality", "toxic"]
    assert quality.fit(docs, labels, max_rows=200) is not None


def test_driver_tables_start_no_second_python_daemon(spark, monkeypatch):
    """Lists of rows go through a Python worker of Spark's RDDs on every executor; Arrow tables do not."""
    plan = lambda df: df._jdf.queryExecution().toRdd().toDebugString()
    docs = cut(spark.range(40).selectExpr("id AS doc_id", "nullif(concat('s', id % 3), 's0') AS source", "10L AS n_chars"))
    banded = cut(spark.range(40).selectExpr("id", "array(7L, id div 2) AS bands"))
    table = local_table(spark, {"a": pa.array([1, 2], pa.int64()), "b": pa.array(["x", None], pa.string())})
    assert table.dtypes == [("a", "bigint"), ("b", "string")] and [tuple(r) for r in table.collect()] == [(1, "x"), (2, None)]
    assert "PythonRDD" in plan(spark.createDataFrame([(1, "x")], "a long, b string")) and "PythonRDD" not in plan(table)

    def as_arrow(self, data, *a, made=type(spark).createDataFrame, **b):
        assert isinstance(data, pa.Table)
        return made(self, data, *a, **b)

    monkeypatch.setattr(type(spark), "createDataFrame", as_arrow)
    monkeypatch.setattr(linking, "SAMPLE", 1)
    monkeypatch.setattr(linking, "HOT_COUNT", 10)
    assert sorted(r.doc_id for r in X.mix(docs, block_size=20).collect()) == list(range(40))
    met = {(r.key, r.id, r.hub) for r in linking.shared_buckets(banded).collect()}
    assert met == {(7, i, 0) for i in range(1, 40)} | {(k, 2 * k + 1, 2 * k) for k in range(20) if k != 7} | {(7, 14, 0), (7, 15, 0)}


def test_clashing_columns_are_carried(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", i, "mine", {"a": i}, i) for i in range(30)], "doc_id long, source string, _size int, _row string, _block map<string,int>, n_chars long").withColumn("mix_slot", F.lit("old"))
    out = X.mix(docs, block_size=20)
    assert out.columns == [*docs.drop("mix_slot").columns, "mix_block", "mix_slot", "mix_rank"]
    assert sorted((r.doc_id, r._size, r._row, r._block["a"]) for r in out.collect()) == [(i, i, "mine", i) for i in range(30)]


def test_a_source_without_a_weight_is_told(spark):
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('s', id % 10) AS source")
    weights = {f"s{i}": 1.0 for i in range(9)}
    with pytest.raises(KeyError):
        X.mix(docs, weights=weights, size_col=None, block_size=1).count()


def test_files_without_rate_or_with_two_channels_give_nulls(spark):
    def wav(rate, channels, data=b"\x01" * 64, tag=7):
        return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, tag, channels, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(data)) + data

    df = spark.createDataFrame([(0, wav(8000, 1)), (1, wav(0, 1)), (2, wav(8000, 2)), (3, wav(8000, 0)), (4, wav(8000, 1, b"\x01" * 63, 0x11))], "k int, media binary")
    assert {r["k"]: r["n_samples"] for r in M.decode(df).collect()} == {0: 128, 1: None, 2: None, 3: None, 4: None}
