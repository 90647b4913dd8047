"""Ranked search against a plain evaluation of every document."""

import math
import re

import pytest

from dayfacts.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, queries, k=20):
    terms = lambda text: TERM.findall((text or "").translate(LOWER))
    held = [(i, terms(t)) for i, t in docs]
    total, length = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(queries):
        scores = []
        for i, t in held:
            m = 75 + 25 * len(t) * total // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 12 * m)) for x in terms(text) if x in t)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


DOCS = [(1, "the cat, the dog"), (2, "The CAT sat"), (3, None), (4, ""), (5, "..."), (6, "dog dog dog ÀÉ a1b2"), (7, "the cat, the dog"), (7, "the cat, the dog"), (None, "cat"), (8, "x" * 50_000 + " cat"), (9, "unrelated words here")]
QUERIES = [(1, "cat dog"), (2, "Cat cat dog, the"), (2, "sat"), (3, None), (4, "nothing"), (5, "àé ÀÉ A1B2"), (None, "cat the"), (1, "cat dog"), (6, "..."), (7, "the cat dog")]


@pytest.mark.parametrize(("k", "chunk"), [(20, 1 << 17), (2, 1 << 17), (3, 4), (20, 1)])
def test_all_documents_and_queries_are_ranked(spark, k, chunk):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS score").repartition(5)
    queries = spark.createDataFrame(QUERIES, "item_id long, text string").selectExpr("*", "2 AS rank")
    assert found(search.ranked(docs, queries, k=k, chunk=chunk)) == brute(DOCS, QUERIES, k)


def test_empty_tables(spark):
    docs, queries = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert found(search.ranked(docs, one.toDF("item_id", "text"))) == []
    assert found(search.ranked(one, queries)) == []


def test_a_group_of_equal_documents_is_ranked_by_id(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'alpha beta' AS text").union(spark.range(-2000, 0).selectExpr("id", "'gamma'"))
    rows = found(search.ranked(docs, spark.createDataFrame([(0, "beta")], "item_id long, text string")))
    assert [r[2] for r in sorted(rows, key=lambda r: r[1])] == list(range(20))


def test_queries_share_what_they_have_in_common():
    queries = [[(b"a", 1), (b"b", 1), (b"c", 1)], [(b"a", 1), (b"b", 1), (b"d", 2)], [(b"a", 1), (b"b", 1)], [(b"d", 2)], [(b"d", 1)]]
    plan = search.share(queries)
    assert plan.n_sets == 4  # a and b, c, d twice, d once
    assert len(plan.node_set) == 5  # ab, ab+c, ab+dd, dd, d
    assert plan.last[0] != plan.last[1] and plan.depth[plan.last[2]] == 0
