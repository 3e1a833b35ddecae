import corpus_pipeline
import pytest

from __spark_entry__ import oracle_sql, queries
from checks import compare
from tests.llm.test_text_operators import plain_components, plain_lines
from tidemark.llm import decontaminate, toxicity


def test_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram join", "decontamination", "packing"]


@pytest.mark.parametrize("name", ["op8_warc", "op10_line_dedup"])
def test_sql_agrees(spark, small, name):
    con = compare.connect(small)
    assert compare.difference(spark, con, small, queries()[name], oracle_sql()[name]) is None


def test_stages_against_plain_versions(spark, small):
    """Each stage's rows are those of a plain version of it over what the stage before kept."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, small)
    field = toxicity.train(toxicity.train_rows(spark, docs, labels))
    scores = {r.doc_id: field.score(*field.marginals(field.potentials(toxicity._words(r.text)))[:2]) for r in docs.collect()}
    kept = {r.doc_id: r for r in clean.collect()}
    assert set(kept) == {i for i, s in scores.items() if s < toxicity.THRESHOLD} and clean.columns == docs.columns
    deduped = stages["line dedup"](spark, clean, small)
    rows = sorted(((r.doc_id, r.text) for r in deduped.collect()), key=repr)
    assert rows == plain_lines([(i, r.text) for i, r in kept.items()])
    single = stages["n-gram join"](spark, deduped, small)
    left = {r.doc_id: r for r in single.collect()}
    assert set(left) == {i for i, (_, c) in plain_components(rows).items() if c == i}
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    whole = [b" " + b" ".join(w) + b" " for w in items if w]
    leaked = {i for i, r in left.items() if any(w in b" " + b" ".join(decontaminate.words_of(r.text)) + b" " for w in whole)}
    open_ = {r.doc_id for r in stages["decontamination"](spark, single, small).collect()}
    assert leaked and not open_ & leaked and len(set(left) - open_ - leaked) <= 1
    last = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in last} == open_
    fill = {}
    for r in last:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096 and len(fill) == -(-sum(fill.values()) // 4096)
