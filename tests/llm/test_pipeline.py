"""Each pipeline stage, on what its predecessor kept, against a brute-force version."""

import corpus_pipeline
import pytest
from test_decontaminate import plain as plain_contamination
from test_mixing import plain_targets
from test_nearcopies import kept_by_all_pairs
from test_pii import plain_spans

from trustflow.llm import store, toxicity


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    docs = store.table(spark, sf_dir, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = store.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        out.append(docs)
    return [sorted(d.collect(), key=lambda r: r.doc_id) for d in out], out


def test_stages_return_the_columns_of_documents(results):
    frames = results[1]
    assert len(corpus_pipeline.STAGES) == 5
    assert all(f.columns == frames[0].columns for f in frames[1:-1])


def test_toxicity_removes_what_the_model_rejects(spark, sf_dir, results):
    rows, frames = results
    scored = toxicity.fit(frames[0], store.table(spark, sf_dir, "labels")).score(frames[0])
    want = {r.row.doc_id for r in scored.collect() if r.score < 0.5}
    assert {r.doc_id for r in rows[1]} == want
    assert len(want) > 0.8 * len(rows[0])


def test_one_of_each_group_stays(results):
    """Near copies are those of similarity 0.8 over five words, found here among all pairs."""
    before, after = results[0][1], results[0][2]
    assert [r.doc_id for r in after] == sorted(before[i].doc_id for i in kept_by_all_pairs([r.text or "" for r in before]))


def test_contaminated_documents_go(spark, sf_dir, results):
    before, after = results[0][2], results[0][3]
    items = [(r.item_id, r.text) for r in store.table(spark, sf_dir, "benchmark").collect()]
    judged = plain_contamination([(r.doc_id, r.text) for r in before], items)
    assert {r.doc_id for r in after} == {x[0] for x in judged if not x[-1]}


def test_personal_data_is_masked(results):
    before, after = results[0][3], results[0][4]
    assert [r.doc_id for r in before] == [r.doc_id for r in after]
    changed = 0
    for a, b in zip(before, after, strict=True):
        spans = plain_spans(a.text)
        changed += bool(spans)
        assert (a.text == b.text) == (not spans)
        assert not plain_spans(b.text) and b.n_chars == len(b.text)
    assert changed


def test_mix_of_what_is_left(results):
    before, mixed = results[0][4], results[0][5]
    size = {r.doc_id: len(r.text.split()) for r in before}
    sizes = {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + size[r.doc_id]
    want = plain_targets(sizes)
    assert {r.doc_id for r in mixed} == set(size)
    for r in mixed:
        assert r["size"] == size[r.doc_id] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r["size"]
    for s in sizes:
        assert abs(sum(r.taken for r in mixed if r.source == s) - want[s]) <= 2 * 128


def test_reruns_agree(spark, sf_dir, results):
    again = sorted(corpus_pipeline.run(spark, sf_dir).collect(), key=lambda r: r.doc_id)
    assert again == results[0][5]
