import numpy as np
from pyspark.sql import functions as F

from dayfacts.llm import toxicity as X


def corpus(n, seed):
    """Texts with marked words; the second category needs the first one's word or its own."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    texts, labels = [], []
    for _ in range(n):
        text = list(rng.choice(words, 60))
        insult, threat = rng.random() < 0.3, False
        if insult:
            text += ["zzinsult" + str(rng.choice(["a", "ing", "ed", "xyz"]))]
            threat = rng.random() < 0.5
            if threat:
                text += ["zzthreat"]
        texts.append(" ".join(rng.permutation(text)))
        labels.append((int(insult), int(threat), int(insult or threat)))
    return texts, np.array(labels)


def features(texts):
    return [np.array(sorted(f for t in set(x.split()) for f in X.token_features(t)), np.uint32) for x in texts]


def test_the_chain_on_held_out_texts():
    texts, y = corpus(900, 1)
    weights, biases, links, thresholds = X.fit_chain(features(texts), y, np.arange(900) % 3, folds=3, features=500, penalty=0.25)
    model = X.ChainModel(["insult", "threat", "any"], weights, biases, links, thresholds)
    assert [len(v) for v in links] == [0, 1, 2] and links[2][0] > 0  # later models lean on earlier probabilities
    more, z = corpus(300, 2)
    p = np.array([model.probabilities(t) for t in more])
    for c in range(3):
        assert ((p[:, c] >= thresholds[c]) == (z[:, c] == 1)).mean() > 0.97


def test_later_models_learn_from_out_of_fold_probabilities(monkeypatch):
    """With labels that are noise, in-sample probabilities would look informative; these do not."""
    rng = np.random.default_rng(0)
    texts, _ = corpus(300, 3)
    noise = rng.integers(0, 2, 300)
    y = np.column_stack([noise, noise])
    seen = []
    real = X.sparse_logistic
    monkeypatch.setattr(X, "sparse_logistic", lambda *a, **k: seen.append(a[4]) or real(*a, **k))
    X.fit_chain(features(texts), y, np.arange(300) % 3, folds=3, features=500, penalty=0.25)
    extra = seen[-1]
    assert extra.shape == (300, 1) and abs(np.corrcoef(extra[:, 0], noise)[0, 1]) < 0.3


def test_scoring_sums_features_of_distinct_tokens():
    weights = [{f: 1.0 for f in X.token_features("bad")}, {}]
    model = X.ChainModel(["a", "b"], weights, [-1.0, 0.5], [[], [2.0]], [0.5, 0.5], keep=1)
    k = len(set(X.token_features("bad")))
    p = 1 / (1 + np.exp(1.0 - k))
    assert np.allclose(model.probabilities("bad bad some other words"), [p, 1 / (1 + np.exp(-0.5 - 2 * p))])
    assert np.allclose(model.probabilities(""), [1 / (1 + np.e), 1 / (1 + np.exp(-0.5 - 2 / (1 + np.e)))])


def test_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = X.label_chain(docs, labels.filter("doc_id % 3 != 0"))
    held = labels.filter("doc_id % 3 = 0")
    rows = X.score(docs.join(held, "doc_id"), model).select("toxic", "quality", (F.col("p_toxic") >= model.thresholds[1]).alias("hit")).collect()
    toxic = [r.hit for r in rows if r.toxic and r.quality]  # junk that replaced a text keeps its label
    clean = [r.hit for r in rows if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.95 and sum(clean) / len(clean) < 0.01


def test_awkward_documents(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (7, None, None), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    model = X.label_chain(awkward, labels)
    out = X.score(awkward, model)
    assert out.columns == [c for c in awkward.columns if c != "p_toxic"] + ["p_low_quality", "p_toxic"]
    rows = out.collect()
    assert len(rows) == awkward.count() and all(0 <= r.p_toxic <= 1 for r in rows)
    none = X.label_chain(awkward, labels.limit(0))
    assert {r.p_toxic for r in X.score(awkward, none).collect()} == {0.5}
    assert X.score(awkward.limit(0), model).count() == 0
