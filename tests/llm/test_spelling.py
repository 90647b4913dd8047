"""Words one edit apart against a comparison of every two words."""

import random
import re
import zlib
from collections import Counter

import pytest

from dayfacts.llm import queries, spelling
from dayfacts.llm.common import cut, read

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[i + 1 :] == (b[i + 1 :] if len(a) == len(b) else b[i:])


def brute(counts):
    by = {}
    for w in counts:
        for i in range(len(w)):
            by.setdefault(w[:i] + "*" + w[i + 1 :], set()).add(w)
        for i in range(len(w) + 1):
            by.setdefault(w[:i] + "*" + w[i:], set()).add(w)
    nears = {w: {x for i in range(len(w)) for x in by[w[:i] + "*" + w[i + 1 :]]} | {x for i in range(len(w) + 1) for x in by[w[:i] + "*" + w[i:]]} for w in counts}
    nears = {w: {x for x in xs if near(w, x)} for w, xs in nears.items()}
    form = {}
    for w, xs in nears.items():
        if xs and counts[best := min(xs, key=lambda x: (-counts[x], x))] >= 2 * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(nears[w]), counts[form[w]] if w in form else None))
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("many", [1 << 14, 0, 3])
def test_near_words_equal_brute_force(spark, many):
    draw = random.Random(5)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(5, 8))) for _ in range(600)}
    counts = {w: draw.choice([3, 4, 6, 7, 20, 100]) for w in words} | {"x" * 60: 9, "x" * 59: 3, "x" * 58: 3}
    table = cut(spark.createDataFrame(list(counts.items()), "word string, n long"))
    pairs = {tuple(sorted((r["a"], r["b"]))): (r["n_a"], r["n_b"]) for r in spelling.near_words(table, many=many).collect()}
    expected = {(a, b) for a in counts for b in counts if a < b and abs(len(a) - len(b)) < 2 and near(a, b)}
    assert set(pairs) == expected


def test_many_words_with_one_beginning(spark):
    """A chunk that all words share is split until few meet; all links are found."""
    counts = {f"{'z' * 8}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}": 3 + i % 5 for i in range(1500)}
    df = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert rows(df) == brute(counts)


def test_forms_and_roots(spark):
    counts = {"house": 100, "hous": 40, "houss": 10, "hozss": 4, "mouse": 300, "other": 3, "othes": 3}
    assert rows(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long").selectExpr("*", "'x' AS form"))) == brute(counts)
    assert rows(spelling.variants(spark.createDataFrame([], "word string, n long"))) == []


def expected_counts(docs):
    total = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            total[low] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def test_word_counts(spark):
    draw = random.Random(1)
    docs = [(i if i % 7 else None, " ".join("".join(draw.choice("abÀÉ×") for _ in range(draw.randint(1, 7))) for _ in range(200))) for i in range(60)] + [(1, None), (2, ""), (3, "1 2 ..."), (4, "longword" * 9000)] * 3
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS word")
    assert {r["word"]: r["n"] for r in spelling.word_counts(df, written=spelling.with_lost_letters).collect()} == expected_counts(docs)


def test_registered_query_equals_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert rows(queries.op12_spelling(spark, sf_dir)) == brute(expected_counts(docs))
