"""Registered queries of the corpus operators against their SQL in DuckDB, and op1 and op8 against
brute force, on the smallest tables."""

import os

import duckdb
import pytest
from conftest import SMALL
from test_near_duplicates import brute_lines

from dayfacts.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    return con


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, duck, name):
    df, found = QUERIES[name](spark, SMALL), duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert sorted(map(tuple, df.select(*found.columns).collect()), key=repr) == sorted(found.fetchall(), key=repr)


def test_op8_against_brute_force(spark, small):
    want = brute_lines([(r.doc_id, r.text) for r in small["documents"].collect()])
    got = {r.doc_id: (r.n_removed, r.removed_lines) for r in QUERIES["op8_line_dedup"](spark, SMALL).collect()}
    assert got == {r.doc_id: (len(want.get(r.doc_id, [])), ",".join(map(str, want.get(r.doc_id, [])))) for r in small["documents"].collect()}


def test_op1_against_a_dense_scorer(spark, small):
    import math

    from dayfacts.llm import toxicity as T

    model = T.label_chain(small["documents"], small["labels"])
    rows = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, SMALL).collect()}
    for r in small["documents"].collect():
        out = []
        for w, b, link in zip(model.weights, model.biases, model.links):
            z = b + sum(w.get(f, 0.0) for token in set(r.text.split()) for f in T.token_features(token)) + sum(a * p for a, p in zip(link, out))
            out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
        assert rows[r.doc_id].p_toxic == pytest.approx(out[1], abs=1e-9) and rows[r.doc_id].toxic == (rows[r.doc_id].p_toxic >= model.thresholds[1])
