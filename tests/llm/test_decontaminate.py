from __future__ import annotations

import hashlib
import random

import pytest

import brute
from conftest import frame, sentence
from orderlake.llm import decontaminate

ITEMS = [
    (1, sentence(50, 25)),
    (2, "Three SHORT words"),
    (3, None),
    (4, " .,- "),
    (5, sentence(50, 25)),
    (6, "Ünïcödé wörds, 12 of them; é é é ß x-ray a.b 😀 end of item"),
    (None, sentence(51, 12)),
    (1, sentence(52, 10)),
]


def table(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def documents():
    base = sentence(60, 30).split()
    return [
        (1, f"{sentence(61, 5)} {sentence(50, 25).upper()}, {sentence(62, 5)}"),
        (2, sentence(63, 40)),
        (3, "it has three short... words! and three short words"),
        (4, " ".join(sentence(50, 25).split()[:9])),
        (5, " ".join([*base[:9], *sentence(50, 25).split()[4:14], *base[9:]])),
        (6, "x Ünïcödé wörds 12 of them é é é ß x ray a b 😀 end of item y"),
        (7, None),
        (8, ""),
        (9, " \t\x00-/:@[`{\x7f "),
        (10, sentence(51, 12)),
        (11, sentence(64, 30_000) + " " + sentence(52, 10)),
        (12, "Ü" * 40_000),
        # the same passage twice, overlapping itself
        (13, " ".join(["a b"] * 20)),
        # ends with the first words of an item that the next document continues
        (14, " ".join(sentence(50, 25).split()[:5])),
        (15, " ".join(sentence(50, 25).split()[5:15])),
    ]


def found(df):
    rows = decontaminate.contamination(*df).collect()
    return sorted(
        (
            (r.doc_id, r.n_words, r.n_hit, ",".join(sorted(map(str, r["items"]))), r.contaminated)
            for r in rows
        ),
        key=repr,
    )


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 400])
def test_equals_brute_force(spark, monkeypatch, block_bytes):
    """With one block, and with more blocks than one job takes."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", min(decontaminate.PIECE_BYTES, block_bytes // 4))
    items = [*ITEMS, (7, " ".join(["a b"] * 6)), (8, sentence(64, 200))]
    rows = [(i, t, "a") for i, t in documents()]
    expected = sorted(brute.contaminated(documents(), items), key=repr)
    assert found((frame(spark, rows), table(spark, items))) == expected


def test_random_texts(spark):
    r = random.Random(1)

    def text(n):
        return " ".join(r.choices("abc", k=n))

    items = [(i, text(r.randint(0, 30))) for i in range(20)]
    docs = [(i, text(r.randint(0, 400))) for i in range(60)]
    rows = [(i, t, "a") for i, t in docs]
    assert found((frame(spark, rows), table(spark, items))) == sorted(
        brute.contaminated(docs, items), key=repr
    )


def test_edges(spark, edges, nothing):
    items = table(spark, ITEMS)
    assert decontaminate.contamination(nothing, items).count() == 0
    assert decontaminate.decontaminated(nothing, items).count() == 0
    none = decontaminate.contamination(edges, table(spark, [])).collect()
    assert len(none) == edges.count()
    assert not any(r.contaminated for r in none)
    assert sum(r.n_words for r in none) > 0


def test_digest(spark):
    rows = [(1, ITEMS[0][1], "a"), (2, "", "a")]
    out = decontaminate.digests(
        decontaminate.contamination(frame(spark, rows), table(spark, ITEMS))
    )
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[1].n_items == 2
    assert by_id[1].items_sha256 == hashlib.sha256(b"1,5").hexdigest()
    assert by_id[2].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_spans_are_cut_out(spark):
    passage = sentence(50, 25)
    rows = [
        (1, f"É first. {passage}. last 😀", "a"),
        (2, "clean\ttext", None),
        (3, None, "a"),
        (4, f"{passage}\n{passage}", "a"),
    ]
    docs = frame(spark, rows).drop("n_chars").withColumnRenamed("row", "spans")
    out = decontaminate.decontaminated(docs, table(spark, ITEMS))
    assert out.schema == docs.schema
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts == {1: "É first. . last 😀", 2: "clean\ttext", 3: None, 4: ""}
    left = decontaminate.decontaminated(docs, table(spark, ITEMS), remove="documents")
    assert sorted(r.doc_id for r in left.collect()) == [2, 3]
    with pytest.raises(ValueError):
        decontaminate.decontaminated(docs, table(spark, ITEMS), remove="words")


def test_spans_point_at_the_words(spark):
    rows = [(1, f"É x. {sentence(50, 25)} y {sentence(51, 12)}", "a")]
    row = decontaminate.contamination(frame(spark, rows), table(spark, ITEMS)).first()
    cut = [rows[0][1][s.start : s.stop] for s in row.spans]
    assert cut == [sentence(50, 25), sentence(51, 12)]
    assert [(s.first, s.last) for s in row.spans] == [(2, 27), (28, 40)]


def test_equal_hashes_of_different_windows_change_the_seed(monkeypatch):
    """All windows of the first seed collide; the index then takes another one."""

    class Weak(decontaminate._Hasher):
        def windows(self, hashes, length):
            out = super().windows(hashes, length)
            return out * 0 + 7 if self.weak else out

        def __init__(self, seed):
            super().__init__(seed)
            self.weak = seed == 1

    monkeypatch.setattr(decontaminate, "_Hasher", Weak)
    block = decontaminate._block([(1, b"a b c d e f g h i j k"), (2, b"l m")])
    assert block.seed == 2
    assert len(block.hashes) == 3


def test_a_hash_alone_decides_nothing():
    block = decontaminate._block([(1, b"a b c d e f g h i j k")])
    scanner = decontaminate._Scanner(block)
    other = b"a b c d e f g h i j z"
    scanner.hasher.windows = lambda hashes, length: block.hashes[
        [list(block.places).index(0), list(block.places).index(1)]
    ]
    (n, spans, items), = scanner.scan([other])
    assert (n, [s[:2] for s in spans], items) == (11, [(0, 10)], [1])
