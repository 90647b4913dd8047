"""A training-corpus pipeline over ``documents``: reject toxic documents, drop repeated lines,
keep one of each group of near duplicates, mix the sources to target weights, pack to windows.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and, but for the last,
returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayfacts.llm import line_dedup, minhash, mixing, packing, toxicity
from dayfacts.llm.common import cut, join_sized, read, text_key


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain takes for toxic go; null and empty texts stay."""
    model = toxicity.label_chain(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("p_toxic") < model.thresholds[1]).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each component of similar lines stays, and n_chars follows the text. A document
    that had words and has lost every line with one is held by others line by line, and goes;
    documents without words (null, empty, blank) stay. Ties and repeated rows: as
    ``line_dedup.repeated_lines`` says."""
    return line_dedup.without_lines(docs, line_dedup.repeated_lines(docs), keep_empty=False)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near duplicates stays, and of rows
    with the same id and text one (any, where other columns differ). Documents without an id or
    without words stay, as do rows that repeat an id with a text of another component. Empty
    table: no rows."""
    groups = minhash.near_duplicates(docs)
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"), text_key(F.col("text")).alias("_key"))
    gone = cut(groups.filter("not kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct())
    left = join_sized(keyed, gone, ["_id", "_key"], "left_anti")
    again = cut(groups.filter("kept and doc_id is not null and n_shingles > 0").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).count().filter("count > 1").drop("count"))
    if not again.isEmpty():
        once = join_sized(left, again, ["_id", "_key"], "left_semi").dropDuplicates(["_id", "_key"])
        left = join_sized(left, again, ["_id", "_key"], "left_anti").unionByName(once)
    return left.select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every row, in the order of the mixture. Nulls, ties, repeated rows and empty
    tables: as ``mixing.mix`` says."""
    return mixing.mix(docs).orderBy("mix_slot", "mix_rank").select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids, packed in the order of the
    mixture. A table that is read again has lost the order of its rows, so it comes from the
    documents themselves. Null and empty texts: the end id alone. Null ids and repeated rows: each
    row is a document of its own. Empty table: no rows."""
    mixed = mixing.mix(docs).repartitionByRange("mix_slot", "mix_rank").sortWithinPartitions("mix_slot", "mix_rank")
    return packing.piece_digests(packing.pack(mixed, packing.public_encoder()))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", keep_one_of_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: SQL cannot express these stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
