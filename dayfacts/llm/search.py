"""Ranked lexical search of many queries at once, by sharing what they have in common.

1. The queries' terms become a ``Plan``: terms that the same queries hold, equally often, are one
   shared set; queries that begin with the same sets, the most common first, share the nodes of a
   graph. A node's score is its parent's and that of one set.
2. One pass over the texts writes each document's length and its counts of the queries' terms.
   From these come the corpus statistics, over all documents.
3. A task keeps, for a batch of documents, one accumulator for each shared set, adds them up along
   the graph, each node once, and writes the best documents of every query; the best of all tasks
   are found by Spark.

Queries are dealt to chunks of bounded size, each with a plan and a pass of its own, so that a
plan, the only thing sent to the tasks, stays small whatever the number of queries.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import at_end, cut, ship
from .linking import parts

ship(__name__)

#: Bytes that stand between terms: ASCII but for digits and letters. A-Z are lower-cased.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
#: Distinct (query, term) of a chunk of queries; accumulators that a task holds at a time.
CHUNK, HELD = 1 << 17, 1 << 21
#: A group of tasks' best documents is reduced before the groups are.
GROUPS = 32


def terms(text: str | None) -> list[bytes]:
    """The terms of a text: maximal runs of digits, letters and characters beyond ASCII; of these
    only A-Z are lower-cased. None: no terms."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


@dataclass
class Plan:
    """What to add up: entry i of a term's slice ``begin[t]:begin[t + 1]`` says that the term counts
    ``times[i]`` times in the shared set ``sets[i]``. Node k is its parent (-1: none) and the set
    ``node_set[k]``, at ``depth[k]``; parents come first. Query q scores what ``last[q]`` does."""

    vocabulary: dict[bytes, int]
    begin: np.ndarray
    sets: np.ndarray
    times: np.ndarray
    node_set: list[int]
    depth: list[int]
    last: np.ndarray
    n_sets: int


def share(queries: list[list[tuple[bytes, int]]]) -> Plan:
    """The plan of queries, each a list of (term, occurrences) without repeated terms."""
    holders: dict[tuple[bytes, int], list[int]] = {}
    for q, held in enumerate(queries):
        for element in held:
            holders.setdefault(element, []).append(q)
    numbers: dict[tuple[int, ...], int] = {}
    of = {element: numbers.setdefault(tuple(qs), len(numbers)) for element, qs in holders.items()}
    common = {number: len(qs) for qs, number in numbers.items()}
    tree: dict[tuple[int, int], int] = {}
    parents, node_set, last = [], [], np.full(len(queries), -1, np.int64)
    for q, held in enumerate(queries):
        at = -1
        for number in sorted({of[e] for e in held}, key=lambda s: (-common[s], s)):
            if (at, number) not in tree:
                tree[at, number] = len(node_set)
                parents.append(at)
                node_set.append(number)
            at = tree[at, number]
        last[q] = at
    children: dict[int, list[int]] = {}
    for k, parent in enumerate(parents):
        children.setdefault(parent, []).append(k)
    order, depth, stack = [], [], [(k, 0) for k in reversed(children.get(-1, []))]
    while stack:  # depth first, so that one accumulator a level is enough
        k, level = stack.pop()
        order.append(k)
        depth.append(level)
        stack += [(c, level + 1) for c in reversed(children.get(k, []))]
    place = np.empty(len(order) + 1, np.int64)
    place[order], place[-1] = np.arange(len(order)), -1
    vocabulary: dict[bytes, int] = {}
    rows = sorted((vocabulary.setdefault(term, len(vocabulary)), number, times) for (term, times), number in of.items())
    begin = np.searchsorted(np.array([r[0] for r in rows], np.int64), np.arange(len(vocabulary) + 1))
    return Plan(vocabulary, begin, np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64), [node_set[k] for k in order], depth, place[last], len(numbers))


def counted(texts: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), terms (numbers in the vocabulary, ascending) and tfs for doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 1, 1 << 20):
                n, numbers, tfs = [], [], []
                for text in part.column(1):
                    words = terms(text.as_py())
                    found = sorted((vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary)
                    n.append(len(words))
                    numbers.append([t for t, _ in found])
                    tfs.append([c for _, c in found])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(numbers, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tfs"])

    return texts.mapInArrow(at_end(run), "doc_id long, n long, terms array<int>, tfs array<int>")


def sums(plan: Plan, at: np.ndarray, contribution: np.ndarray, term: np.ndarray, docs: int) -> np.ndarray:
    """(queries, docs) scores from contributions of terms to documents ``at``."""
    many = plan.begin[term + 1] - plan.begin[term]
    entry = np.repeat(plan.begin[term] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
    held = np.zeros((plan.n_sets, docs), np.int64)
    np.add.at(held, (plan.sets[entry], np.repeat(at, many)), np.repeat(contribution, many) * plan.times[entry])
    ends: dict[int, list[int]] = {}
    for q, k in enumerate(plan.last.tolist()):
        ends.setdefault(k, []).append(q)
    out = np.zeros((len(plan.last), docs), np.int64)
    level = np.zeros((max(plan.depth, default=0) + 2, docs), np.int64)
    for k, (number, depth) in enumerate(zip(plan.node_set, plan.depth)):
        np.add(level[depth], held[number], out=level[depth + 1])
        if k in ends:
            out[ends[k]] = level[depth + 1]
    return out


def best_of(counts: DataFrame, plan: Plan, weights: np.ndarray, total: int, length: int, k: int) -> DataFrame:
    """query (its number in the plan), doc_id, score: of every task the ``k`` best documents of each
    query, smaller ids first among equals, ids that are null last."""
    most = max(1, min(1024, HELD // max(1, plan.n_sets, len(plan.last), max(plan.depth, default=0))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = len(plan.last)
        best: list[np.ndarray] = [np.zeros((3, 0), np.int64)] * queries  # score, null id, id
        least = np.ones(queries, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                n = part.column(1).to_numpy(zero_copy_only=False)
                lengths = np.diff(part.column(2).offsets.to_numpy())
                at = np.repeat(np.arange(part.num_rows), lengths)
                term = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                m = 75 + 25 * n * total // max(1, length)
                scores = sums(plan, at, weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[at])), term, part.num_rows)
                missing = part.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                hit = scores >= least[:, None]
                for q in np.flatnonzero(hit.any(axis=1)):
                    new = np.flatnonzero(hit[q])
                    rows = np.concatenate([best[q], np.stack([scores[q, new], missing[new].astype(np.int64), ids[new]])], axis=1)
                    best[q] = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[:k]]
                    if best[q].shape[1] == k:
                        least[q] = max(1, best[q][0, -1])
        for q in range(0, queries, 1024):
            rows = np.concatenate([np.zeros((3, 0), np.int64), *best[q : q + 1024]], axis=1)
            number = np.repeat(np.arange(q, min(q + 1024, queries)), [b.shape[1] for b in best[q : q + 1024]])
            yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), pa.array(rows[2], mask=rows[1] > 0), pa.array(rows[0])], names=["query", "doc_id", "score"])

    return counts.mapInArrow(at_end(run), "query int, doc_id long, score long")


def query_chunks(queries: DataFrame, chunk: int) -> Iterator[list[tuple[int | None, list[tuple[bytes, int]]]]]:
    """(item_id, its terms and their occurrences) of the queries, in lists of at most ``chunk``
    distinct terms of queries, or of one query that has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 1, 1 << 20):
                held = [sorted(Counter(terms(x.as_py())).items()) for x in part.column(1)]
                columns = [pa.array([[f(p) for p in h] for h in held], kind) for f, kind in ((lambda p: p[0], pa.list_(pa.binary())), (lambda p: p[1], pa.list_(pa.int64())))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array([len(h) for h in held], pa.int64())], names=["item_id", "terms", "times", "size"])

    read = queries.distinct().mapInArrow(run, "item_id long, terms array<binary>, times array<long>, size long").filter("size > 0")
    held = cut(read.withColumn("key", F.xxhash64("item_id", "terms", "times")))
    whole = held.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("all")).first()["all"]
    waiting = [(1, 0)] if whole else []  # (so many chunks, the one meant)
    while waiting:
        many, which = waiting.pop()
        own = held.filter(F.pmod("key", F.lit(many)) == which)
        size, rows = own.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
        if size > chunk and rows > 1 and many < 1 << 40:
            waiting += [(2 * many, which + many), (2 * many, which)]
        elif rows:
            yield [(r["item_id"], [(bytes(t), c) for t, c in zip(r["terms"], r["times"])]) for r in own.orderBy("item_id", "key").collect()]


def ranked(docs: DataFrame, queries: DataFrame, *, k: int = 20, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest scores above 0 for each
    query, equal scores by ascending id.

    Terms: see ``terms``. N counts documents with a term, L all their terms, df the documents that
    hold a term. A term weighs floor(1000 * ln((2N + 2) / (2df + 1))); it adds to a document of n
    terms, with m = 75 + 25nN div L, weight * (10^9 tf div (1000 tf + 12m)) for each occurrence in
    the query. All documents count, in the statistics and in the ranking.

    Null and empty texts have no terms: such documents are not found, such queries have no rows.
    Null document ids rank last among equals; repeated documents each have a rank. Queries that
    repeat id and text count once; a repeated or null query id with another text is a query of its
    own. A query longer than a chunk is a chunk. Empty tables: no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = queries.select(F.col(query_col).cast("long").alias("item_id"), F.col(query_text_col).cast("string").alias("text"))
    found: DataFrame | None = None
    begun = 0
    for held in query_chunks(asked, chunk):
        plan = share([q for _, q in held])
        counts = cut(counted(texts, plan.vocabulary))
        total, length = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(plan.vocabulary), np.int64)
        for term, n in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[term] = n
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        names = spark.createDataFrame([(begun + q, q, item) for q, (item, _) in enumerate(held)], "number long, query int, item_id long")
        begun += len(held)
        own = best_of(counts, plan, weights, total, length, k).join(F.broadcast(names), "query").select("number", "item_id", "doc_id", "score")
        found = own if found is None else found.unionByName(own)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("number", "group").orderBy(*order))).filter(F.col("rank") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).filter(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
