from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

import brute
from conftest import edge_rows, frame
from orderlake.llm import merkle

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def rows_of(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


def many(n_large: int):
    """One large source and a few of one to ten rows, with line breaks, nulls and repeated rows."""
    rows = [(i, None if i % 31 == 0 else f"a{i}\nb{i % 7}", "large") for i in range(n_large)]
    for s in range(1, 11):
        rows += [(1000 * s + i, "x\ny", f"s{s:02}") for i in range(s)]
    return rows + rows[-3:]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_equals_brute_force(spark, monkeypatch, levels):
    """With leaf partitions of 3, 9 and 2,187 leaves."""
    monkeypatch.setattr(merkle, "_LEVELS", levels)
    monkeypatch.setattr(merkle, "SPAN", 3**levels)
    docs = frame(spark, many(100))
    expected = sorted(brute.merkle(rows_of(docs)), key=repr)
    assert found(merkle.verified_rows(docs)) == expected


def test_edge_rows_equal_brute_force(spark, edges, nothing):
    expected = sorted(brute.merkle(rows_of(edges)), key=repr)
    assert found(merkle.verified_rows(edges)) == expected
    assert found(merkle.verified_rows(nothing)) == []


def test_one_row_is_its_own_root(spark):
    (row,) = merkle.verified_rows(frame(spark, [(1, "ab", None)])).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root
    assert row.proof_sha256 == hashlib.sha256(b"").hexdigest()
    assert row.leaf == hashlib.sha256("1:1-2:en1:22:ab".encode()).hexdigest()
    assert row.verified


def test_proof_holds_the_siblings(spark):
    docs = frame(spark, many(20))
    row = (
        merkle.verified_rows(docs, with_proof=True).filter("doc_id = 4").first()
    )
    assert hashlib.sha256("".join(row.proof).encode()).hexdigest() == row.proof_sha256
    # 20 leaves: two siblings, two, two of three, and those of 11 subroots: none or two each
    assert len(row.proof) >= 6


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9, 10, 28, 82])
def test_missing_nodes_are_as_few_as_can_be(size):
    """All that is asked for is needed, and with it the root follows from the given leaves."""
    digests = [f"{i}" for i in range(size)]
    levels = brute._climb(digests)
    for places in ({0}, {size - 1}, set(range(0, size, 2)), set(range(size // 2)) or {0}, set(range(size))):
        needed = merkle.missing(places, size)
        assert len(needed) == len(set(needed))
        fetched = {(level, p): levels[level][p] for level, p in needed}
        tree = merkle._Tree({p: digests[p] for p in places}, size, fetched)
        assert tree.node(tree.height, 0) == levels[-1][0]
        given = {(0, p) for p in places}
        for level in range(len(levels) - 1):
            known = {p for at, p in given if at == level}
            given |= {(level + 1, p // 3) for p in known}
        assert not given & set(needed)
        for p in places:
            assert tree.fold(p, digests[p]) == levels[-1][0]
            assert tree.fold(p, "other") != levels[-1][0]


def test_some_leaves_can_be_proved(spark):
    """Claims on a few leaves fetch the nodes they lack and fold to the root."""
    docs = frame(spark, many(60)).dropDuplicates()
    hashed = docs.select(
        "doc_id", "source", merkle.row_digest([F.col("text")]).alias("digest")
    ).withColumn("claimed", F.col("digest"))
    found = merkle.manifest(hashed, ["doc_id", "claimed"])
    few = found.leaves.filter("doc_id % 13 = 0")
    proofs = merkle.multiproofs(found, few).collect()
    assert len(proofs) == few.count() >= 5
    assert {r.folded_root for r in proofs} == {found.root}
    wrong = merkle.multiproofs(found, few.withColumn("claimed", F.lit("other"))).collect()
    assert found.root not in {r.folded_root for r in wrong}
