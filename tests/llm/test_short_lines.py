"""Lines of any length are deduplicated by the query and by the pipeline."""

from collections import defaultdict

import corpus_pipeline as P

from dayfacts.llm.queries import op8_line_dedup

DOCS = [
    (1, "Menu\nRead more\n今天天气很好。\nabcdefghijklmno"),
    (2, "Menu\nonly here\n今天天气很好。\nabcdefghijklmn\n- -"),
    (3, "Read more\nMenu\nMenus\n \n\nababababab"),
    (4, "a\nabababababab\na\n今天天气不好。\n- -"),
]


def brute(docs):
    """Removed line numbers by document, over all pairs of lines with a word."""
    places = [(d, k, x) for d, t in docs for k, x in enumerate(t.split("\n")) if x.strip()]
    sets = [frozenset(x[i : i + 8] for i in range(max(1, len(x) - 7))) for _, _, x in places]
    top = list(range(len(places)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = max(top[i], top[j]), min(top[i], top[j])
                top = [new if x == old else x for x in top]
    out = defaultdict(list)
    for i, (d, k, _) in enumerate(places):
        if top[i] != i:
            out[d].append(k)
    return dict(out)


def test_the_query_looks_at_every_line(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.removed_lines for r in op8_line_dedup(spark, str(tmp_path)).collect()}
    want = brute(DOCS)
    assert got == {d: ",".join(map(str, want.get(d, []))) for d, _ in DOCS}
    assert want[2] == [0, 2, 3] and want[4] == [1, 2, 4]


def test_the_pipeline_looks_at_every_line(spark):
    out = P.drop_repeated_lines(spark, spark.createDataFrame([*DOCS, (5, "Menu\n"), (6, " \n")], "doc_id long, text string"), "")
    want = brute(DOCS)
    texts = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want.get(d, [])) for d, t in DOCS}
    assert {r.doc_id: r.text for r in out.collect()} == texts | {6: " \n"}


def test_the_pipeline_keeps_one_of_repeated_rows(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = [(1, words, 1), (1, words, 2), (2, words + " more", 3), (1, "another text that shares its id", 4), (None, words, 5), (None, words, 6), (3, None, 7), (3, None, 8)]
    out = P.keep_one_of_near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string, _id long"), "")
    assert out.columns == ["doc_id", "text", "_id"]
    got = sorted(r._id for r in out.collect())
    assert got[0] in (1, 2) and got[1:] == [4, 5, 6, 7, 8]
