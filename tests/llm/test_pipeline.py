"""Each stage on its predecessor's rows, compared with the plain versions."""

from __future__ import annotations

from collections import Counter

import brute
import corpus_pipeline
import pytest
import tiktoken
from conftest import SF_DIR, edge_rows
from test_bpe import FILE, PATTERN

from orderlake.llm import quality
from orderlake.llm.common import documents, labels, remainder
from pyspark.sql import functions as F

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = documents(spark, SF_DIR)
    rows = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "stage")
        rows.append(docs.collect())
        if stage is not corpus_pipeline.token_ids:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return rows


def test_good_documents(spark, stages):
    docs = documents(spark, SF_DIR)
    allowed = remainder(F.col("doc_id"), 4) != 2
    model = quality.fit(docs, labels(spark, SF_DIR), allowed)
    texts = [r.text for r in stages[0]]
    scores = model.scores([quality.bag(t) for t in texts])
    want = {r.doc_id for r, s in zip(stages[0], scores) if s >= 0.7}
    assert {r.doc_id for r in stages[1]} == want
    marks = {r.doc_id: r.quality for r in labels(spark, SF_DIR).collect()}
    clean = {i for i, q in marks.items() if q == 1}
    assert len(clean & want) >= 0.98 * len(clean)


def test_different_texts(stages):
    groups = brute.exact_groups([(r.doc_id, r.text) for r in stages[1]])
    assert {r.doc_id for r in stages[2]} == {i for i, _, _, kept, _ in groups if kept}


def test_dissimilar_documents(stages):
    found = brute.jaccard_components([(r.doc_id, r.text) for r in stages[2]], 5, 80)
    assert {r.doc_id for r in stages[3]} == {c for _, _, c in found}


def test_mixed_sources(stages):
    before = {r.doc_id: r for r in stages[3]}
    words, sources = Counter(), Counter()
    for r in stages[4]:
        old = brute.WORD.findall(before[r.doc_id].text)
        new = brute.WORD.findall(r.text)
        assert new == old[: len(new)] and r.n_chars == len(r.text)
        words[r.doc_id] += len(new)
        sources[r.source] += len(new)
    total = sum(brute.word_count(r.text) for r in stages[3])
    assert sum(words.values()) == pytest.approx(1.5 * total, rel=0.02)


def test_token_ids(stages):
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, FILE.splitlines())}
    plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = Counter((r.doc_id, tuple(r.ids), r.n_tokens) for r in stages[5])
    own = [(r.doc_id, tuple(plain.encode_ordinary(r.text))) for r in stages[4]]
    assert got == Counter((i, ids, len(ids)) for i, ids in own)


@pytest.mark.parametrize("name", list(STAGES))
def test_edge_rows_and_no_rows(spark, edges, nothing, name):
    """The labels of the given tables know none of these documents well; nothing may break."""
    kept = STAGES[name](spark, edges, SF_DIR).count()
    assert 0 < kept <= 2 * len(edge_rows())
    assert STAGES[name](spark, nothing, SF_DIR).count() == 0
