"""Quality rules: gradient-boosted trees over document statistics, flattened into node arrays.

Statistics are counted over whole texts in Arrow batches. The trees are grown in one task on a
bounded sample of labelled documents, with monotonic constraints on chosen statistics (more
symbols, duplicate lines or repeated windows never make a document better), and scored for a
whole batch at once by walking numpy arrays of nodes. Nothing is shuffled in scoring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_end, first_rows, ship

ship(__name__)

#: Words of a window that counts as repeated when it is found twice.
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks"]
#: What the trees see, and how the quality may move with it: -1 down only, 0 freely.
FEATURES = {"symbols": -1, "dup_lines": -1, "repeated": -1, "capitals": -1, "marks": -1, "digits": 0, "word_length": 0, "distinct": 0, "log_words": 0, "words_a_line": 0}


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that the text holds twice or more, the first included.

    Windows are compared by a 64-bit hash of their words.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    _, place, times = np.unique(key, return_inverse=True, return_counts=True)
    if len(times) == n:
        return 0
    twice = np.concatenate([times[place] > 1, np.zeros(WINDOW - 1, bool)])
    since = np.arange(len(words)) - np.maximum.accumulate(np.where(twice, np.arange(len(words)), -WINDOW))
    return int(np.count_nonzero(since < WINDOW))


def statistics(text: str | None) -> tuple[int, ...]:
    """COUNTS of a text; null is a text without words."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()  # for bytes: at 0x20 and 0x09-0x0D
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    space = int(seen[9:14].sum() + seen[32])
    lines = [x for x in data.split(b"\n") if x.strip()]
    upper, digits = int(seen[65:91].sum()), int(seen[48:58].sum())
    marks = int(seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum())
    return len(words), len(text) - space, int(seen[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated_words(words), len(lines), len(set(words)), upper, digits, marks


def features(counts: np.ndarray) -> np.ndarray:
    """(documents, COUNTS) -> (documents, FEATURES)."""
    n_words, chars, symbols, dup, repeat, lines, distinct, upper, digits, marks = counts.astype(float).T
    w, c, l = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.column_stack([symbols / c, dup / l, repeat / w, upper / c, marks / c, digits / c, chars / w, distinct / np.sqrt(w), np.log1p(n_words), n_words / l])


class Trees:
    """Boosted trees as flat arrays: node i goes left if x[feature[i]] <= cut[i]; leaves point at
    themselves. ``roots`` are the trees' first nodes, ``depth`` the most steps from a root."""

    def __init__(self, base: float, roots: list[int], feature: list[int], cut: list[float], left: list[int], right: list[int], value: list[float], depth: int):
        self.base, self.depth = base, depth
        self.roots, self.feature, self.left, self.right = (np.array(a, dtype=np.int64) for a in (roots, feature, left, right))
        self.cut, self.value = np.array(cut, dtype=float), np.array(value, dtype=float)

    def probability(self, x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
        z = self.base + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def grow(x: np.ndarray, y: np.ndarray, monotone: list[int], *, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 64, least: int = 20, smooth: float = 1.0) -> dict:
    """Boost logistic loss with second-order leaf values; the arguments of ``Trees``.

    A split on a constrained feature is taken only if its sides are in order, and bounds at the
    middle of the two values keep everything below in order as well.
    """
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    score = np.full(len(y), base)
    out: dict = {"base": base, "roots": [], "feature": [], "cut": [], "left": [], "right": [], "value": [], "depth": depth}

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + smooth), low, high))

    def node(rows: np.ndarray, level: int, low: float, high: float) -> int:
        me = len(out["feature"])
        for name, v in (("feature", 0), ("cut", np.inf), ("left", me), ("right", me)):
            out[name].append(v)
        gs, hs = g[rows].sum(), h[rows].sum()
        out["value"].append(rate * leaf(gs, hs, low, high))
        best = (1e-6, -1, 0, 0.0, 0.0)
        if level < depth and len(rows) >= 2 * least:
            parent = gs * gs / (hs + smooth)
            for f, e in enumerate(edges):
                b = binned[rows, f]
                n = len(e) + 1
                gl, hl, nl = (np.cumsum(np.bincount(b, w, n))[:-1] for w in (g[rows], h[rows], None))
                if not len(gl):
                    continue
                gr, hr = gs - gl, hs - hl
                vl, vr = np.clip(-gl / (hl + smooth), low, high), np.clip(-gr / (hr + smooth), low, high)
                gain = gl * gl / (hl + smooth) + gr * gr / (hr + smooth) - parent
                fine = (nl >= least) & (len(rows) - nl >= least) & (monotone[f] * (vr - vl) >= 0)
                gain = np.where(fine, gain, -1)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], f, k, vl[k], vr[k])
        _, f, k, vl, vr = best
        if f >= 0:
            middle = (vl + vr) / 2
            goes = binned[rows, f] <= k
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[monotone[f]]
            out["feature"][me], out["cut"][me] = f, float(edges[f][k])
            out["left"][me] = node(rows[goes], level + 1, *bounds[0])
            out["right"][me] = node(rows[~goes], level + 1, *bounds[1])
        else:
            score[rows] += out["value"][me]
        return me

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        out["roots"].append(node(np.arange(len(y)), 0, -10.0, 10.0))
    return out


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = 8000) -> Trees:
    """Fit on at most ``max_rows`` labelled documents, drawn by the hash of their id; of rows that
    repeat a drawn id the first in the order of their statistics, so that no more than
    ``max_rows`` rows, of a few numbers each, reach the fitting task. Rows without id or label are
    no labels. Without labelled documents every probability is one half."""
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_id is not null and _y is not null").dropDuplicates(["_id"])
    drawn = marked.withColumn("_h", F.xxhash64("_id", F.lit(23))).orderBy("_h", "_id").limit(max_rows)
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(drawn), "_id")  # max_rows ids at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(statistics(t.as_py())) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.int64()))], names=["h", "id", "y", "c"])

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf["t"] = pdf["c"].map(tuple)
        pdf = pdf.sort_values(["h", "id", "t"])
        x = features(np.array(pdf["c"].tolist(), dtype=np.int64).reshape(len(pdf), len(COUNTS)))
        return pd.DataFrame([grow(x, pdf["y"].to_numpy(dtype=float), list(FEATURES.values()))])

    counted = sample.select("_h", "_id", "_y", "_text").mapInArrow(count, "h long, id long, y int, c array<long>")
    counted = first_rows(counted, ["h", "id", "c"], None, max_rows)
    found = counted.groupBy(F.lit(0).alias("all")).applyInPandas(train, "base double, roots array<int>, feature array<int>, cut array<double>, left array<int>, right array<int>, value array<double>, depth int").collect()
    if not found:
        return Trees(0.0, [], [], [], [], [], [], 0)
    return Trees(**found[0].asDict())


def judge(docs: DataFrame, trees: Trees, *, id_col: str = "doc_id", text_col: str = "text", least_words: int = 20, most_repeated: int = 30, threshold: float = 0.5) -> DataFrame:
    """doc_id, COUNTS, base_failed, p_quality and kept for every document, from whole texts.

    base_failed: fewer than ``least_words`` words, or more than ``most_repeated`` percent of
    them in repeated windows. kept: not base_failed, and p_quality reaches ``threshold``.

    Null, empty and blank texts: no words, so base_failed. Null ids and repeated rows: a row
    each. Empty table: no rows. Other columns are not read, whatever their names.
    """
    names = ["doc_id", *COUNTS, "p_quality"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([statistics(t.as_py()) for t in batch.column(1)], dtype=np.int64).reshape(batch.num_rows, len(COUNTS))
            p = trees.probability(features(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in np.ascontiguousarray(counts.T)], pa.array(p)], names=names)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = picked.mapInArrow(at_end(run), ", ".join(f"{n} {'double' if n == 'p_quality' else 'long'}" for n in names))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("p_quality") >= threshold))
