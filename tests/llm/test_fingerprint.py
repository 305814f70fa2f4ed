from __future__ import annotations

import random

import brute
import numpy as np
from conftest import SF_DIR, edge_rows, frame, sentence

from orderlake.llm import fingerprint as fp
from orderlake.llm.common import documents

COLUMNS = ["doc_id", "n_chars", "edited_sha256"]


def same(a, b):
    return fp.as_text(a) == fp.as_text(b)


def test_order_does_not_matter_and_counts_do():
    lines = [sentence(i, 12) for i in range(20)]
    shuffled = random.Random(1).sample(lines, 20)
    assert same(fp.vector(lines), fp.vector(shuffled))
    assert not same(fp.vector(lines), fp.vector([*lines, lines[0]]))


def test_insertion_and_deletion():
    lines = [sentence(i, 12) for i in range(9)]
    base = fp.vector(lines)
    assert same(fp.inserted(base, ["a b c d", "x"]), fp.vector([*lines, "a b c d", "x"]))
    assert same(fp.deleted(base, lines[2:4]), fp.vector(lines[:2] + lines[4:]))


def test_likeness_falls_with_edits():
    words = sentence(1, 400).split()
    base = fp.fingerprint(" ".join(words))
    likes = []
    for changed in (0, 20, 100, 400):
        new = [f"w{i}" if i < changed else w for i, w in enumerate(words)]
        likes.append(fp.likeness(base, fp.fingerprint(" ".join(new))))
    assert likes[0] == 1.0 and likes == sorted(likes, reverse=True)
    assert likes[1] > 0.8 and likes[3] < 0.35
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint(None)) == 1.0
    assert fp.likeness(fp.fingerprint(""), base) == 0.0


def test_lanes_wrap():
    many = fp.vector(["a b c"] * 3)
    assert same(fp.deleted(many, ["a b c"] * 3), (np.zeros(8, np.uint64), np.zeros(128, np.uint32)))


def test_edge_rows(spark, unique_rows):
    rows = fp.with_next(frame(spark, unique_rows)).collect()
    got = sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows)
    assert got == brute.edited([r[:2] for r in unique_rows])
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))


def test_null_and_repeated_ids(edges):
    rows = fp.with_next(edges).collect()
    assert len(rows) == len(edge_rows())
    prints = {r.doc_id: r.fingerprint for r in fp.fingerprints(edges).collect() if r.doc_id}
    assert all(prints[r.doc_id] == r.fingerprint for r in rows if r.doc_id)


def test_one_row_follows_itself(spark):
    (row,) = fp.with_next(frame(spark, [(5, "ab cd", "s")])).collect()
    assert (row.near_next, row.n_chars) == (1.0, 5)


def test_only_null_ids(spark):
    rows = fp.with_next(frame(spark, [(None, "ab", "s"), (None, "cd ef", "s")])).collect()
    assert len(rows) == 2


def test_empty_table(nothing):
    assert fp.with_next(nothing).count() == 0
    assert fp.fingerprints(nothing).count() == 0


def test_given_documents(spark):
    docs = documents(spark, SF_DIR).select("doc_id", "text")
    rows = fp.with_next(docs).collect()
    texts = [tuple(r) for r in docs.collect()]
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == brute.edited(texts)
    by_id = dict(texts)
    assert len({r.fingerprint for r in rows}) == len(set(by_id.values()))
    nearer = sum(r.near_edited > r.near_next for r in rows)
    assert nearer > 0.95 * len(rows)
