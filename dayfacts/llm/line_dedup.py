"""Fuzzy line dedup: one line stays of every component of similar lines in the whole corpus.

1. One pass over the texts numbers every line by the 64-bit hash of its text, so that equal lines
   are one line here, and gives each line that a task meets for the first time the MinHash band
   keys of its character shingles.
2. Lines that share a band key are compared by the exact Jaccard similarity of their shingle
   sets, and links give components by the distributed union-find.
3. Occurrences are counted by component. The first, by document and line number, stays; each
   document gets the numbers of its lines that go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SMALL_ROWS, WORD, at_end, cut, join_sized, ship, text_key
from .linking import linked, parts, shared_buckets
from .shingles import band_keys, line_shingles, minima

ship(__name__)

BANDS, ROWS, SHINGLE = 14, 4, 8
#: The seed of Spark's xxhash64.
SEED = 42
FRESH = pa.list_(pa.struct([("id", pa.int64()), ("bands", pa.list_(pa.int64()))]))


def numbered_lines(texts: DataFrame) -> DataFrame:
    """doc_id, text_key, lines (the ids of a text's lines in order, null for lines without a word)
    and fresh (id, bands of the lines of a shingle or more that the task has not met lately) for
    doc_id, text_key, text. Null text: no lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            for part in parts(batch, 2):
                all_ids: list[list[int | None] | None] = []
                ids: list[int] = []
                new: list[bytes] = []
                ends = [0]
                for text in part.column(2).cast(pa.binary()).to_pylist():
                    here: list[int | None] = []
                    for line in text.split(b"\n") if text is not None else ():
                        if line.strip():  # for bytes: 0x20 and 0x09-0x0D
                            key = digest(line, SEED)
                            if key >> 63:
                                key -= 1 << 64
                            here.append(key)
                            if key not in seen:
                                if len(seen) >= 200_000:
                                    seen.clear()
                                seen.add(key)
                                if len(line) >= SHINGLE:
                                    ids.append(key)
                                    new.append(line)
                        else:
                            here.append(None)
                    all_ids.append(here)
                    ends.append(len(ids))
                sets = line_shingles(new, SHINGLE, np.uint32)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands = band_keys(minima([sets[i] for i in full], BANDS * ROWS), ROWS)
                stops = np.zeros(len(new) + 1, dtype=np.int32)
                stops[np.array(full, dtype=np.int64) + 1] = BANDS
                flat = pa.ListArray.from_arrays(pa.array(np.cumsum(stops, dtype=np.int32)), pa.array(bands.reshape(-1)))
                fresh = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(ids, pa.int64()), flat], fields=list(FRESH.value_type)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(all_ids, pa.list_(pa.int64())), fresh.cast(FRESH)], names=["doc_id", "text_key", "lines", "fresh"])

    return texts.mapInArrow(at_end(run), "doc_id long, text_key long, lines array<long>, fresh array<struct<id: long, bands: array<long>>>")


def line_sets(lines: pa.Array) -> list[np.ndarray]:
    return [np.unique(x) for x in line_shingles(lines.cast(pa.binary()).to_pylist(), SHINGLE)]


def repeated_lines(docs: DataFrame, *, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (``common.text_key``), removed (the sorted numbers, from 0, of lines that
    go), for the documents that lose lines.

    Two lines are linked if their sets of 8-character shingles have 100 * intersection >=
    ``percent`` * union; a line shorter than a shingle is one shingle, so that only equal ones
    meet. Lines are split at ``\\n``; those without a word are left alone. At a similarity of 0.8
    a pair of lines shares no band with a chance of 6 in ten thousand, at 0.9 of 3 in ten million.

    Null and empty texts: no lines. Ties: the first line of the smallest document id stays (null
    ids come first, then the smaller text_key). Rows that repeat an id with other texts, and rows
    without an id, are documents of their own; rows that repeat id and text are one document and
    lose the same lines. Empty table: no rows. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    numbered = cut(numbered_lines(texts))
    banded = numbered.select(F.explode("fresh").alias("f")).select("f.id", "f.bands")
    crowded = cut(shared_buckets(banded))
    lines = texts.select(F.explode(F.split("text", "\n")).alias("items")).select(F.xxhash64("items").alias("id"), "items")
    known = cut(join_sized(lines, cut(crowded.select(F.explode(F.array("hub", "id")).alias("id")).distinct()), "id", "left_semi").dropDuplicates(["id"]))
    found = cut(linked(crowded, lambda ids: join_sized(known, ids, "id", "left_semi"), percent=percent, read=line_sets).withColumnRenamed("node", "id"))

    places = numbered.select("doc_id", "text_key", F.posexplode("lines").alias("line_no", "id")).filter("id is not null")
    each = places.groupBy("id").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "text_key", "line_no")).alias("first"))
    placed = cut(join_sized(each, found, "id", "left").filter("times > 1 or component is not null").withColumn("component", F.coalesce("component", "id")))
    first = cut(placed.groupBy("component").agg(F.sum("times").alias("times"), F.min("first").alias("first")).filter("times > 1").select("component", "first"))
    again = cut(join_sized(placed.select("id", "component"), first, "component", "inner").select("id", "first"))
    gone = join_sized(places, again, "id", "inner").filter(~F.struct("doc_id", "text_key", "line_no").eqNullSafe(F.col("first")))
    return gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def beside_removed(rows: DataFrame, removed: DataFrame) -> DataFrame:
    """``rows``, with doc_id and text_key among its columns, and _gone: the numbers of the lines
    that go, or null. The list is broadcast if it is counted to take some tens of megabytes."""
    gone = cut(removed.select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key"), F.col("removed").alias("_gone")))
    size = gone.agg(F.sum(4 * F.size("_gone") + 100)).first()[0] or 0
    on = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.col("text_key") == F.col("_gone_key"))
    return rows.join(F.broadcast(gone) if size <= 100 * SMALL_ROWS else gone, on, "left").drop("_gone_id", "_gone_key")


def without_lines(docs: DataFrame, removed: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars", keep_empty: bool = True) -> DataFrame:
    """``docs``, every row and column, with the removed lines taken out of the text and the
    length in ``count_col``, if there is such a column, brought up to date. Unless ``keep_empty``,
    rows that lost lines and have no word left go; rows that had none before stay. Nulls and
    empty tables: as they are, whatever the names of other columns."""
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("text_key"))
    out = beside_removed(keyed, removed)
    text = F.col("_row")[text_col].cast("string")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("_gone", i)), "\n")
    out = out.withColumn("_text", F.when(F.col("_gone").isNull(), text).otherwise(kept))
    if not keep_empty:
        out = out.filter(F.col("_gone").isNull() | F.col("_text").rlike(WORD))
    new = {text_col: F.col("_text")}
    if count_col in docs.columns:
        count = F.col("_row")[count_col]
        new[count_col] = F.when(F.col("_gone").isNull(), count).otherwise(F.length("_text").cast(docs.schema[count_col].dataType))
    return out.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
