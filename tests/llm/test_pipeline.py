from collections import Counter

import corpus_pipeline as P
import pytest
from conftest import SMALL

from dayfacts.llm import line_dedup, minhash, toxicity


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and output of each stage, written and read again as the driver does it."""
    docs, out, at = spark.read.parquet(f"{SMALL}/documents.parquet"), [], tmp_path_factory.mktemp("stages")
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{at}/{i}")
        made = spark.read.parquet(f"{at}/{i}")
        out.append((name, docs, made))
        docs = made
    return out


def test_columns(stages):
    assert [name for name, _, _ in stages] == ["toxicity", "line dedup", "near-dedup", "mixing", "packing"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_toxicity_rejects_what_the_model_rejects(spark, stages):
    _, before, after = stages[0]
    model = toxicity.label_chain(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    want = {r.doc_id for r in before.collect() if model.probabilities(r.text)[1] < model.thresholds[1]}
    assert {r.doc_id for r in after.collect()} == want and 0 < len(want) < before.count()


def test_lines_go_and_documents_with_words_left_stay(stages):
    _, before, after = stages[1]
    gone = {r.doc_id: set(r.removed) for r in line_dedup.repeated_lines(before).collect()}
    texts = {r.doc_id: "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in gone.get(r.doc_id, ())) for r in before.collect()}
    want = {d: t for d, t in texts.items() if t.strip() or d not in gone}
    assert {r.doc_id: r.text for r in after.collect()} == want and gone and len(want) < before.count()
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_one_of_each_group_stays(stages):
    _, before, after = stages[2]
    kept = {r.doc_id for r in minhash.near_duplicates(before).collect() if r.kept}
    assert {r.doc_id for r in after.collect()} == kept


def test_mixing_keeps_all(stages):
    _, before, after = stages[3]
    key = lambda r: (r.doc_id, r.text, r.lang, r.source, r.n_chars)
    assert Counter(map(key, after.collect())) == Counter(map(key, before.collect()))


def test_packing_holds_every_document(stages):
    _, before, after = stages[4]
    tokens = Counter()
    for r in after.collect():
        tokens[r.doc_id] += r.length
    assert set(tokens) == {r.doc_id for r in before.collect()}


def test_run_gives_the_rows_of_the_stages(spark, stages):
    by = lambda rows: Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0)
    assert by(P.run(spark, SMALL).collect()) == by(stages[-1][2].collect())
