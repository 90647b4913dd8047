import re
from collections import Counter

import numpy as np

from dayfacts.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_counts(spark, small, awkward):
    texts = [r.text for r in small["documents"].collect()] + [r.text for r in awkward.collect()]
    texts += ["a b c d e f g h " * 3, "a " * 30, "x\n\nx\n x\nx", "#*$%&|<>", "a\x0bb\x0cc\x85d e"]
    for text in texts:
        assert Q.statistics(text)[:5] == brute(text)


def walk(t, x, node):
    while t["left"][node] != node:
        node = t["left"][node] if x[t["feature"][node]] <= t["cut"][node] else t["right"][node]
    return t["value"][node]


def sample(n=1500, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 3))
    y = ((1 - x[:, 0]) + 0.5 * np.sin(7 * x[:, 1]) + 0.2 * rng.standard_normal(n) > 0.6).astype(float)
    return x, y


def test_flat_arrays_score_as_a_walk_through_each_tree():
    x, y = sample()
    t = Q.grow(x, y, [-1, 0, 0], rounds=20)
    want = [t["base"] + sum(walk(t, row, r) for r in t["roots"]) for row in x[:200]]
    assert np.allclose(Q.Trees(**t).probability(x[:200]), 1 / (1 + np.exp(-np.array(want))))


def test_constraints_hold_everywhere():
    x, y = sample()
    y = np.where(x[:, 0] > 0.9, 1.0, y)  # against the constraint
    trees = Q.Trees(**Q.grow(x, y, [-1, 0, 0]))
    grid = np.linspace(0, 1, 101)
    for rest in np.random.default_rng(0).random((40, 2)):
        p = trees.probability(np.column_stack([grid, np.tile(rest, (101, 1))]))
        assert (np.diff(p) <= 1e-12).all()


def test_held_out_accuracy():
    x, y = sample()
    trees = Q.Trees(**Q.grow(x, y, [-1, 0, 0]))
    a, b = sample(seed=9)
    assert ((trees.probability(a) > 0.5) == (b > 0.5)).mean() > 0.85


def test_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    trees = Q.fit(docs, labels.filter("doc_id % 2 = 0"))
    rows = Q.judge(docs, trees).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    right = [(r.p_quality >= 0.5) == (r.quality == 1) for r in rows]
    assert sum(right) / len(right) > 0.95
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)


def test_awkward_documents(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    trees = Q.fit(awkward, labels)
    rows = Q.judge(awkward, trees).collect()
    assert len(rows) == awkward.count() and {r.kept for r in rows if r.doc_id in (2, 3, 4)} == {False}
    none = Q.fit(awkward, labels.limit(0))
    assert {r.p_quality for r in Q.judge(awkward, none).collect()} == {0.5}
    assert Q.judge(awkward.limit(0), trees).count() == 0
