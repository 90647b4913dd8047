"""Toxicity by a classifier chain: linear models over hashed token features, one per category.

The categories have an order. A later category's model also gets the probabilities of the
earlier ones; in training those come from out-of-fold predictions, so that a later model learns
from probabilities as good, or as bad, as it will meet. The models are fitted in one task on a
bounded sample of labelled documents; scoring reads whole texts and shuffles nothing.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MODEL_BYTES, at_end, first_rows, ship

ship(__name__)

BITS = 18
EDGES = "".join(map(chr, range(0x21, 0x30))) + ":;<=>?@[\\]^_`{|}~«»“”‘’…–—"


def token_features(token: str) -> list[int]:
    """Hashed features of a token: its core, the core's beginnings, the marks around it, capitals."""
    core = token.strip(EDGES)
    low = core.lower()
    names = ["w" + low] if low else []
    names += [f"{n}{low[:n]}" for n in (4, 5, 6) if len(low) > n]
    after = token[len(token.rstrip(EDGES)) :]
    if len(after) > 1 or not core:
        names.append("e" + after[:4])
    if len(core) > 1 and core.isupper():
        names.append("C")
    return [zlib.crc32(n.encode("utf-8", "replace")) & ((1 << BITS) - 1) for n in names]


class ChainModel:
    """Sparse linear models by category: weights over hashed features, a bias, and a weight for
    the probability of each earlier category. A feature counts once for each distinct token.
    ``thresholds`` are the probabilities from which a category is taken to be met."""

    def __init__(self, categories: list[str], weights: list[dict[int, float]], biases: list[float], links: list[list[float]], thresholds: list[float], keep: int = 200_000):
        self.categories, self.weights, self.biases, self.links, self.thresholds, self.keep = categories, weights, biases, links, thresholds, keep
        self.known: dict[str, tuple | None] = {}

    def _of(self, token: str) -> tuple | None:
        found = token_features(token)
        parts = tuple(sum(w.get(f, 0.0) for f in found) for w in self.weights)
        out = parts if any(parts) else None
        if len(token) <= 64:
            if len(self.known) >= self.keep:
                self.known.clear()
            self.known[token] = out
        return out

    def probabilities(self, text: str) -> list[float]:
        known, sums = self.known, list(self.biases)
        for token in sorted(set(text.split())):
            parts = known[token] if token in known else self._of(token)
            if parts:
                sums = [s + p for s, p in zip(sums, parts)]
        out: list[float] = []
        for s, link in zip(sums, self.links):
            z = s + sum(w * p for w, p in zip(link, out))
            out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
        return out


def sparse_logistic(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, extra: np.ndarray, y: np.ndarray, penalty: float, steps: int = 160) -> tuple[np.ndarray, np.ndarray, float]:
    """L1-penalised logistic regression by accelerated proximal gradient, columns scaled to unit
    norm; ``rows, cols`` are the positions of ones (repeats add up), ``extra`` dense columns."""
    norm = np.sqrt(np.maximum(np.bincount(cols, minlength=n_cols), 1))
    values = 1 / norm[cols]
    w, b, v = np.zeros(n_cols), math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), np.zeros(extra.shape[1])
    lead = (w, v, b)
    t = 1.0
    # Steps by a bound on the curvature: the largest eigenvalue of the scaled columns, by power iteration.
    u = np.ones(n_cols)
    for _ in range(12):
        u = np.bincount(cols, np.bincount(rows, (u / max(np.linalg.norm(u), 1e-9))[cols] * values, n_rows)[rows] * values, n_cols)
    rw, rb = 4 / (2.2 * max(1.0, np.linalg.norm(u))), 4 / (2.2 * len(y) * (1 + extra.shape[1]))
    for _ in range(steps):
        lw, lv, lb = lead
        z = np.bincount(rows, lw[cols] * values, n_rows) + extra @ lv + lb
        r = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        gw = np.bincount(cols, r[rows] * values, n_cols)
        nw = lw - rw * gw
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rw * penalty, 0)
        nv = lv - rb * (extra.T @ r) if extra.shape[1] else lv
        nb = lb - rb * r.sum()
        s = (1 + math.sqrt(1 + 4 * t * t)) / 2
        k = (t - 1) / s
        lead = (nw + k * (nw - w), nv + k * (nv - v), nb + k * (nb - b))
        w, v, b, t = nw, nv, nb, s
    return w / norm, v, b


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability that parts out-of-fold predictions with the best F1, halfway in log odds
    between the scores beside it; among equals the highest, one half if nothing is to be learnt."""
    if not y.any() or y.all():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hit, z = np.cumsum(y[order]), np.log(np.clip(p[order], 1e-12, 1) / np.clip(1 - p[order], 1e-12, 1))
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][z[:-1] == z[1:]] = -1  # equal scores stay on one side
    k = int(np.argmax(f1))
    cut = (z[k] + z[min(k + 1, len(z) - 1)]) / 2
    return float(1 / (1 + np.exp(-cut)))


def fit_chain(ids: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, *, folds: int, features: int, penalty: float) -> tuple[list[dict[int, float]], list[float], list[list[float]], list[float]]:
    """Weights, biases, links and thresholds of the chain; labels is (documents, categories) of 0 and 1."""
    rows = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    cols = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int64)
    seen = np.unique(rows * (1 << BITS) + cols)
    seen_rows, seen_cols = seen >> BITS, seen & ((1 << BITS) - 1)

    def fit(train: np.ndarray, y: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Weights over all hashed features, from those most associated with the label."""
        of = train[seen_rows]
        n, pos = train.sum(), (y * train).sum()
        total = np.bincount(seen_cols[of], minlength=1 << BITS)
        hit = np.bincount(seen_cols[of], y[seen_rows[of]], 1 << BITS)
        expected = total * pos / max(n, 1)
        gain = np.where(total >= 3, (hit - expected) ** 2 / np.maximum(expected * (1 - total / (n + 1)), 1e-9), 0)
        chosen = np.argsort(-gain, kind="stable")[:features]
        chosen = np.sort(chosen[gain[chosen] > 0])
        place = np.full(1 << BITS, -1)
        place[chosen] = np.arange(len(chosen))
        number = np.cumsum(train) - 1
        use = train[rows] & (place[cols] >= 0)
        w, v, b = sparse_logistic(number[rows[use]], place[cols[use]], int(n), max(1, len(chosen)), extra[train], y[train], penalty)
        out = np.zeros(1 << BITS)
        out[chosen] = w[: len(chosen)]
        return out, v, b

    def predict(model: tuple, extra: np.ndarray) -> np.ndarray:
        w, v, b = model
        return 1 / (1 + np.exp(-np.clip(np.bincount(rows, w[cols], len(ids)) + extra @ v + b, -40, 40)))

    weights, biases, links, thresholds = [], [], [], []
    earlier = np.zeros((len(ids), 0))
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        apart = np.zeros(len(ids))
        for k in range(folds):
            apart = np.where(fold == k, predict(fit(fold != k, y, earlier), earlier), apart)
        w, v, b = fit(np.ones(len(ids), bool), y, earlier)
        weights.append({int(f): float(w[f]) for f in np.flatnonzero(w)})
        biases.append(float(b))
        links.append([float(x) for x in v])
        thresholds.append(best_threshold(apart, y))
        earlier = np.column_stack([earlier, apart])
    return weights, biases, links, thresholds


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 8000, folds: int = 3, features: int = 3000, penalty: float = 0.25, max_bytes: int = MODEL_BYTES) -> ChainModel:
    """Fit a chain on at most ``max_rows`` labelled documents, drawn by the hash of their id, whose
    features take ``max_bytes`` or less together. However many rows repeat a drawn id, Spark keeps
    the first in the order of the hash, the id and the features, and no more reach the fitting task.

    ``categories`` maps a name to a boolean column of ``labels``, in the chain's order; a null
    label counts as false. Without labelled documents every probability is one half.
    Thresholds are those with the best F1 of the out-of-fold predictions.
    """
    names = list(categories)
    marked = labels.select(F.col(id_col).alias("_id"), F.array(*[F.coalesce(c.cast("int"), F.lit(0)) for c in categories.values()]).alias("_y")).filter("_id is not null").dropDuplicates(["_id"])
    drawn = marked.withColumn("_h", F.xxhash64("_id", F.lit(17))).orderBy("_h", "_id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    sample = texts.join(F.broadcast(drawn), "_id").select("_h", "_id", "_y", "_text")  # max_rows ids at most

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(3):
                ids = [f for token in set((text.as_py() or "").split()) for f in token_features(token)]
                found.append(np.array(sorted(ids), dtype=np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int64()), batch.column(2), pa.array(found, pa.binary())], names=["h", "id", "y", "x"])

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "id", "x"])
        ids = [np.frombuffer(x, dtype=np.uint32) for x in pdf["x"]]
        y = np.array(pdf["y"].tolist(), dtype=np.int64).reshape(len(pdf), -1)
        weights, biases, links, thresholds = fit_chain(ids, y, np.arange(len(pdf)) % folds, folds=folds, features=features, penalty=penalty)
        return pd.DataFrame({"category": range(len(names)), "feature": [list(w) for w in weights], "weight": [list(w.values()) for w in weights], "bias": biases, "threshold": thresholds, "links": links})

    rows = sample.mapInArrow(at_end(featurise), "h long, id long, y array<int>, x binary")
    rows = first_rows(rows, ["h", "id", "x"], "x", max_rows, max_bytes)
    models = rows.groupBy(F.lit(0).alias("all")).applyInPandas(train, "category int, feature array<int>, weight array<double>, bias double, threshold double, links array<double>").collect()
    models.sort(key=lambda m: m["category"])
    if not models:
        return ChainModel(names, [{} for _ in names], [0.0] * len(names), [[0.0] * k for k in range(len(names))], [0.5] * len(names))
    return ChainModel(names, [dict(zip(m["feature"], m["weight"])) for m in models], [m["bias"] for m in models], [m["links"] for m in models], [m["threshold"] for m in models])


def score(docs: DataFrame, model: ChainModel, *, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with p_<category> added for every category of the chain, from whole texts.

    Null, empty and blank texts: the probabilities of no tokens at all. Ties and repeated rows:
    equal texts, equal values. Empty table: no rows. Columns of the input whose names clash with
    the added ones are replaced; all others stay as they are, but for the text itself if
    ``keep_text`` is false.
    """
    added = [f"p_{c}" for c in model.categories]
    kept = docs.drop(*added)
    at = kept.columns.index(text_col)
    stay = [i for i in range(len(kept.columns)) if keep_text or i != at]
    schema = T.StructType([*[kept.schema.fields[i] for i in stay], *[T.StructField(c, T.DoubleType()) for c in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.probabilities(text.as_py() or "") for text in batch.column(at)]
            columns = [pa.array([f[c] for f in found], pa.float64()) for c in range(len(added))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in stay], *columns], names=[*[batch.schema.names[i] for i in stay], *added])
        model.known.clear()

    return kept.mapInArrow(at_end(run), schema)


def label_chain(docs: DataFrame, labels: DataFrame, **options) -> ChainModel:
    """The chain over the labels that the corpus has: low quality first, then toxic."""
    return fit(docs, labels, {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}, **options)
