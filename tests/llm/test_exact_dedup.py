from __future__ import annotations

import brute
import numpy as np
import pytest
from conftest import SF_DIR, edge_rows, frame

from orderlake.llm import exact_dedup
from orderlake.llm.common import documents

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@pytest.mark.parametrize("n, top", [(0, 10), (1, 0), (1, 2**59), (5, 3), (1000, 2**60), (300, 50)])
def test_codes_round_trip(n, top):
    values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
    assert exact_dedup.decode(exact_dedup.encode(values)).tolist() == values.tolist()


def test_codes_are_short():
    values = np.sort(np.random.default_rng(1).integers(0, 2**60, 100_000))
    assert len(exact_dedup.encode(values)) * 8 / len(values) < 60 - 16 + 3


@pytest.mark.parametrize("key_bits", [60, 6])
def test_equals_brute_force(spark, unique_rows, key_bits):
    """Six bits make different texts share a fingerprint, so that bytes must decide."""
    found = exact_dedup.exact_duplicates(
        frame(spark, unique_rows), key_bits=key_bits, rows_per_block=4
    )
    want = brute.exact_groups([r[:2] for r in unique_rows])
    assert sorted(map(tuple, found.select(COLUMNS).collect())) == want


@pytest.mark.parametrize("key_bits", [60, 5])
def test_one_row_of_each_text_stays(edges, key_bits):
    rows = exact_dedup.exact_duplicates(edges, key_bits=key_bits).collect()
    texts = {brute.SPACE.sub(" ", t or "") for _, t, _ in edge_rows()}
    assert len(rows) == len(edge_rows())
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows}) == len(texts)
    # a null id stays only where there is no other
    assert all(r.keep_id is not None for r in rows if r.doc_id is not None)


@pytest.mark.parametrize("key_bits", [60, 5])
def test_whole_rows(edges, key_bits):
    kept = exact_dedup.deduplicated(edges, key_bits=key_bits)
    assert kept.columns == edges.columns
    want = sorted(
        ((r.keep_id, r.text_sha256) for r in exact_dedup.exact_duplicates(edges).collect() if r.kept),
        key=repr,
    )
    hashed = exact_dedup._fingerprints(kept, "doc_id", "text", 60).select("doc_id", "sha")
    assert sorted(map(tuple, hashed.collect()), key=repr) == want


def test_empty_table(nothing):
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    assert exact_dedup.deduplicated(nothing).count() == 0


def test_given_documents(spark):
    docs = documents(spark, SF_DIR)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = exact_dedup.exact_duplicates(docs).select(COLUMNS).collect()
    assert sorted(map(tuple, found)) == brute.exact_groups(rows)
