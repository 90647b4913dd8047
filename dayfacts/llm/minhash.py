"""Near-duplicate documents by b-bit MinHash.

1. Each text's word-shingle set gives its size, a digest, band keys and a packed signature of
   the low bits of its minima. Texts with equal sets form a class, a node of the link graph.
2. Nodes that share a band key are candidates with their bucket's hub. The packed signatures
   estimate the similarity by bit counts, corrected for chance agreement of the low bits.
3. What the estimate lets pass is compared exactly, on whole sets, and linked (``linking``).

Narrow tables are shuffled, and the sets of nodes that have candidates; where these nodes are too
many to be broadcast (``common.join_sized``), so are the texts, once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import at_end, cut, join_sized, ship, text_key
from .linking import linked, parts, salted, shared_buckets
from .shingles import WordHashes, band_keys, low_bits, minima, word_shingles

ship(__name__)

BANDS, ROWS, BITS = 32, 5, 2
#: Estimated similarity to a hub from which a pair is compared exactly.
LEAST = 0.45
#: Minima in the packed signature: 32 to a 64-bit word.
PACKED = BANDS * ROWS // 32 * 32
SIGNATURES = "doc_id long, text_key long, n_shingles long, digest binary, node long, bands array<long>, packed array<long>"


def digest_node(items: np.ndarray) -> tuple[bytes, int]:
    """The 128-bit digest of a set, and the signed number of its node: the first half."""
    digest = xxhash.xxh3_128_digest(items.tobytes())
    return digest, int.from_bytes(digest[:8], "little", signed=True)


def signatures(texts: DataFrame, size: int) -> DataFrame:
    """doc_id, text_key, n_shingles, digest of the set, node, bands and packed low bits for
    doc_id, text_key, text; texts without words have no digest, node, bands or bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for part in parts(batch, 2, 1 << 20):
                sets = [word_shingles(text.as_py(), size, known) for text in part.column(2)]
                full = [i for i, s in enumerate(sets) if len(s)]
                m = minima([sets[i] for i in full], BANDS * ROWS)
                digest, node, bands, packed = ([None] * len(sets) for _ in range(4))
                for i, keys, bits in zip(full, band_keys(m, ROWS).tolist(), low_bits(m, BITS).tolist()):
                    (digest[i], node[i]), bands[i], packed[i] = digest_node(sets[i]), keys, bits
                longs = pa.list_(pa.int64())
                found = [pa.array(map(len, sets), pa.int64()), pa.array(digest, pa.binary()), pa.array(node, pa.int64()), pa.array(bands, longs), pa.array(packed, longs)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *found], names=["doc_id", "text_key", "n_shingles", "digest", "node", "bands", "packed"])

    return texts.mapInArrow(at_end(run), SIGNATURES)


def estimate(a: Column, b: Column, packed: int) -> Column:
    """Similarity estimated from packed signatures of so many minima: the share of agreeing codes,
    less the share 2**-BITS of the others that agrees by chance."""
    low = 0x5555555555555555
    apart = F.lit(0)
    for k in range(packed * BITS // 64):
        x = F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))
        apart = apart + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(low)))
    agree = 1 - apart / packed
    return (agree - 0.5**BITS) / (1 - 0.5**BITS)


def likely_pairs(stars: DataFrame, light: DataFrame, packed: int = PACKED, least: float = LEAST) -> DataFrame:
    """The (hub, id) whose packed signatures (``light``: id, packed) estimate a similarity of
    ``least`` or more; a hub with many members meets them in parts."""
    pairs, heads = salted(stars)
    pairs = join_sized(light.withColumnRenamed("packed", "p"), pairs, "id", "inner")
    heads = join_sized(light.select(F.col("id").alias("hub"), F.col("packed").alias("q")), heads, "hub", "inner")
    return pairs.join(heads, ["hub", "salt"]).filter(estimate(F.col("p"), F.col("q"), packed) >= least).select("hub", "id")


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """id, items: the sets as sorted 64-bit hashes, for rows of id (a node), text whose set is the
    node's; other rows give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for part in parts(batch, 1, 1 << 20):
                ids, items = [], []
                for node, text in zip(part.column(0).to_pylist(), part.column(1)):
                    found = word_shingles(text.as_py(), size, known)
                    if len(found) and digest_node(found)[1] == node:
                        ids.append(node)
                        items.append(found.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(items, pa.binary())], names=["id", "items"])

    return texts.mapInArrow(at_end(run), "id long, items binary")


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", slack: float = 0.18) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable over links, itself included),
    kept (it is that id) and text_key (``common.text_key``), for every row.

    Two documents are linked if their sets of ``size``-word shingles have 100 * intersection >=
    ``percent`` * union; shingles are compared by 64-bit hashes, whole sets by 128-bit digests,
    whose first half numbers the nodes. At a similarity of 0.8 a pair shares no band with a
    chance of 3 in a million. A pair is compared exactly if the estimate reaches LEAST, far below
    the threshold; ``slack`` (close to five standard errors) is what an estimate may err by where
    items that are not near their hub are held against others.

    Null texts and texts without words: an empty set, linked with nothing. Rows that repeat an id
    with other texts are documents of their own; rows that repeat id and text share all values.
    Null ids: a row each, component null, kept. Empty table: no rows. Other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = cut(signatures(texts.select("doc_id", text_key(F.col("text")).alias("text_key"), "text"), size))
    some = signed.filter("n_shingles > 0 and doc_id is not null")
    first = cut(some.groupBy("digest").agg(F.min(F.struct("doc_id", "node", "bands", "packed")).alias("f"), F.count(F.lit(1)).alias("times")).select("digest", "f.*", "times"))

    crowded = cut(shared_buckets(first.select(F.col("node").alias("id"), "bands")))
    holders = first.select(F.col("node").alias("id"), "doc_id")

    def sets(ids: DataFrame) -> DataFrame:
        wanted = cut(join_sized(holders, ids, "id", "inner").select("id", F.col("doc_id").alias("_doc_id")))
        held = join_sized(texts, wanted, F.col("doc_id") == F.col("_doc_id"), "inner").select("id", "text")
        return shingle_sets(held, size).dropDuplicates(["id"])

    light = first.select(F.col("node").alias("id"), "packed")
    found = linked(crowded, sets, percent=percent, likely=lambda stars: likely_pairs(cut(stars), light), slack=slack)

    placed = cut(join_sized(holders.withColumnRenamed("id", "node"), cut(found), "node", "inner"))
    least = cut(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    grouped = join_sized(placed, least, "component", "inner").select("node", "component_id")
    several = cut(join_sized(first, cut(grouped), "node", "left").filter("times > 1 or component_id is not null").select("digest", F.coalesce("component_id", "doc_id").alias("component_id")))
    alone = signed.filter("digest is null or doc_id is null").withColumn("component_id", F.col("doc_id"))
    met = join_sized(signed.filter("digest is not null and doc_id is not null"), several, "digest", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    out = met.unionByName(alone, allowMissingColumns=True)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_key")
