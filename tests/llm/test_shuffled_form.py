"""The form that joins take beyond the rows that may be broadcast gives the same rows."""

import pytest

from dayfacts.llm import common, line_dedup
from dayfacts.llm.queries import QUERIES


@pytest.mark.parametrize("name", ["op3_minhash", "op8_line_dedup", "op9_mixing"])
def test_rows_do_not_depend_on_the_form_of_joins(spark, sf_dir, monkeypatch, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = sorted(map(repr, QUERIES[name](spark, sf_dir).collect()))
    monkeypatch.setattr(common.join_sized, "__defaults__", (0,))
    monkeypatch.setattr(line_dedup, "SMALL_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = sorted(map(repr, QUERIES[name](spark, sf_dir).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert small and small == large
