import corpus_pipeline as P
from conftest import SMALL
from pyspark.sql import functions as F

from dayfacts.llm import mixing


def test_sequences_follow_the_mixture_of_a_table_read_again(spark, tmp_path):
    """Tasks pack ranges of slots, though the table's files hold its rows in another order."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    big = docs.withColumn("n_chars", F.col("n_chars") * 100)  # many blocks
    P.mix_sources(spark, big, SMALL).repartition(5, F.xxhash64("doc_id")).write.parquet(f"{tmp_path}/docs")
    again = spark.read.parquet(f"{tmp_path}/docs")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = P.pack_windows(spark, again, SMALL).filter("start = 0").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    place = {r.doc_id: (r.mix_slot, r.mix_rank) for r in mixing.mix(again).collect()}
    assert len(pieces) == docs.count() and len({s for s, _ in place.values()}) > 50
    tasks = {}
    for r in pieces:
        tasks.setdefault(r.sequence_id >> 40, []).append(place[r.doc_id])
    assert len(tasks) > 1
    met = [x for t in sorted(tasks) for x in (min(tasks[t]), max(tasks[t]))]
    assert met == sorted(met)


def test_packing_gets_the_rows_in_order(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3, F.xxhash64("doc_id"))
    given = []
    pack = P.packing.pack
    monkeypatch.setattr(P.packing, "pack", lambda df, *a: given.append(df) or pack(df, *a))
    P.pack_windows(spark, docs, SMALL)
    want = [r.doc_id for r in sorted(mixing.mix(docs).collect(), key=lambda r: (r.mix_slot, r.mix_rank))]
    assert [r.doc_id for r in given[0].select("doc_id").collect()] == want
