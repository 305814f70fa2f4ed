from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR, edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlake.llm import bpe
from orderlake.llm.common import TOKENIZER, documents

PATH, PATTERN = public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN
FILE = open(PATH, "rb").read()


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, FILE.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary(FILE), PATTERN)


def ids(code: bytes) -> list[int]:
    return np.frombuffer(code, "<u4").tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text(reference, encoder, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for text, code in zip(texts, encoder.encode(texts)):
        assert ids(code) == reference.encode_ordinary(text)
        assert encoder.words.decode(ids(code)) == text.encode()


def test_pieces_on_both_sides_of_the_longest_row(reference, encoder):
    r = random.Random(3)
    texts = ["".join(r.choices("abcdeéß", k=n)) for n in (*range(120, 300, 7), 1000, 5000)]
    texts += [" " * 700 + "x", "a" * 3000, "日本語" * 400, "<|endoftext|>"]
    for text, code in zip(texts, encoder.encode(texts)):
        assert ids(code) == reference.encode_ordinary(text)


def test_pair_table_finds_all_and_nothing_else():
    table = bpe.PairTable(np.arange(1000), np.arange(1000) % 7, np.arange(1000, dtype=np.int32))
    assert table.look_up(np.arange(1000), np.arange(1000) % 7).tolist() == list(range(1000))
    assert (table.look_up(np.arange(1000), np.arange(1000) % 7 + 7) == bpe.NONE).all()


def test_edge_rows(edges, reference):
    got = bpe.round_trip(edges, PATH, PATTERN).collect()
    want = []
    for i, t, _ in edge_rows():
        own = np.array(reference.encode_ordinary(t or ""), "<u4").tobytes()
        digests = (hashlib.sha256(own).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        want.append((i, len(own) // 4, *digests))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_ids_and_bytes(edges, reference):
    encoded = bpe.encode(edges, PATH, PATTERN, keep=["doc_id", "source", "ids"])
    rows = bpe.decode(encoded, PATH).collect()
    assert sorted((bytes(r.bytes) for r in rows)) == sorted(
        (t or "").encode() for _, t, _ in edge_rows()
    )
    assert all(bytes(r.bytes).decode() == reference.decode(r.ids) for r in rows)


def test_empty_table(nothing):
    assert bpe.round_trip(nothing, PATH, PATTERN).count() == 0


def test_given_documents(spark, reference):
    docs = documents(spark, SF_DIR).select("doc_id", "text")
    got = {r.doc_id: r for r in bpe.round_trip(docs, PATH, PATTERN).collect()}
    for doc_id, text in docs.collect():
        own = np.array(reference.encode_ordinary(text), "<u4").tobytes()
        assert got[doc_id].ids_sha256 == hashlib.sha256(own).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
