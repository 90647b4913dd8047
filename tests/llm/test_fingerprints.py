"""Bottom-k sketches against sets of shingles computed plainly."""

import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from dayfacts.llm import fingerprints as fp
from dayfacts.llm import queries
from dayfacts.llm.common import read

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    out = set()
    for i in range(max(1, len(words) - 4) if words else 0):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w, h)
        out.add(h - (1 << 64) if h >= 1 << 63 else h)
    return out


def sketch(s, k=fp.K):
    return sorted(s)[:k]


def near(a, b, k=fp.K):
    both = sorted(set(a) | set(b))[:k]
    return len(set(both) & set(a) & set(b)) / len(both) if both else 1.0


def brute(docs):
    """Rows for (id, text) without repeated rows."""
    order = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, text), (_, other) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        a, b, c = (sketch(shingles(t)) for t in (text, edited, other))
        text_of = lambda s: "".join(f"{h & (1 << 64) - 1:016x}" for h in s)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(a), text_of(b), near(a, b), near(a, c)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=repr)


def test_registered_query_equals_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert rows(queries.op13_fingerprints(spark, sf_dir)) == brute(docs)


DOCS = [(5000, "A b c d e f"), (-3, None), (7, ""), (9, " \t"), (None, "x y"), (2**62, "one two Three"), (-(2**40), "éà ü " * 4000), (10, "one two three"), (11, "ten words " * 300)]


@pytest.mark.parametrize("parts", [1, 7])
def test_awkward_rows(spark, parts):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS key", "'x' AS value", "2 AS o").repartition(parts)
    assert rows(fp.edited_fingerprints(df)) == brute(DOCS)
    assert rows(fp.edited_fingerprints(df.filter("doc_id = 7"))) == brute([(7, "")])
    assert rows(fp.edited_fingerprints(df.filter("doc_id = 1"))) == []


def test_repeated_ids_and_rows(spark):
    """An id with many texts is dealt out by their hashes; each text's next one is given once, and rows
    that repeat id and text are one document."""
    many = spark.range(9000).selectExpr("3L AS doc_id", "concat('text ', id) AS text")
    few = spark.createDataFrame([(2, "last"), (2, "last"), (4, "first")], "doc_id long, text string")
    out = fp.with_next(many.unionByName(few), lambda df: df.withColumn("value", F.length("text"))).collect()
    assert len(out) == 9003
    assert [r["next_text"] for r in out if r["doc_id"] == 2] == ["first", "first"]
    (first,) = [r["next_text"] for r in out if r["doc_id"] == 4]
    following = {r["text"]: r["next_text"] for r in out if r["doc_id"] == 3}
    seen = [first]
    while seen[-1] in following:
        assert len(seen) <= 9000
        seen.append(following[seen[-1]])
    assert len(seen) == 9001 and seen[-1] == "last"


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(3000)]
    a, b, c = " ".join(words[:2000]), " ".join(words[1000:]), " ".join(words[:500])
    docs = spark.createDataFrame([(1, "p", a), (2, "p", b), (3, "q", c), (4, "r", None), (5, None, c)], "doc_id long, part string, text string")
    made = fp.fingerprints(docs).join(docs.select("doc_id", "part"), "doc_id")
    exact = {i: shingles(t) for i, t in ((1, a), (2, b), (3, c))}
    by = {r["part"]: r["sketch"] for r in fp.merged_by(made, ["part"]).collect()}
    assert by == {"p": sketch(exact[1] | exact[2]), "q": sketch(exact[3]), "r": [], None: sketch(exact[3])}
    x, y = made.filter("doc_id = 1").select(F.col("sketch").alias("x")), made.filter("doc_id = 3").select(F.col("sketch").alias("y"))
    r = x.crossJoin(y).select(fp.resemblance(F.col("x"), F.col("y")), fp.containment(F.col("y"), F.col("x")), fp.distinct_shingles(F.col("x"))).first()
    assert abs(r[0] - 496 / 1996) < 0.13 and r[1] > 0.7 and abs(r[2] / 1996 - 1) < 0.3


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    queries.op13_fingerprints(spark, sf_dir).explain()
    assert not any(word in capsys.readouterr().out for word in ("Python", "Pandas", "Arrow"))
