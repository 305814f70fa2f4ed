from __future__ import annotations

import random

import pytest

import brute
from conftest import edge_rows, frame
from orderlake.llm import spelling


def found(df):
    columns = ("word", "n", "n_near", "form", "form_n", "root")
    return sorted(tuple(r[c] for c in columns) for r in spelling.variant_groups(df).collect())


def word_rows(counts: dict[str, int]):
    """Documents of one word each, whose checksum damages none of them."""
    rows, doc_id = [], 0
    for word, n in counts.items():
        for _ in range(n):
            while spelling.as_written(doc_id, word.encode("latin-1")) != word.encode("latin-1"):
                doc_id += 1
            rows.append((doc_id, word, "a"))
            doc_id += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_words_equal_brute_force(spark, seed):
    r = random.Random(seed)
    words = ["".join(r.choices("aabé×", k=r.randint(4, 7))) for _ in range(150)]
    docs = [
        (i, " ".join(r.choice((str.upper, str))(w) for w in r.choices(words, k=60)))
        for i in range(200)
    ]
    assert found(frame(spark, [(i, t, "a") for i, t in docs])) == brute.spelling(docs)


def test_edge_rows_equal_brute_force(spark, edges, nothing):
    rows = [(i, t) for i, t, _ in edge_rows()]
    assert found(edges) == brute.spelling(rows)
    assert found(nothing) == []


def test_chain_ties_and_repeated_letters(spark):
    counts = {
        "letter": 40, "lettre": 3, "lettter": 3, "leter": 9, "letters": 20, "better": 40,
        "leterr": 3, "naïves": 6, "naives": 12, "bbbbb": 3, "bbbbbb": 6, "bbbbbbb": 12,
    }
    by_word = {r[0]: r[1:] for r in found(frame(spark, word_rows(counts)))}
    # equal counts: the smaller word
    assert by_word["lettter"] == (3, 1, "letter", 40, "letter")
    assert by_word["letters"][2:4] == ("letter", 40)
    # a letter more in a run of equal letters is one neighbour
    assert by_word["bbbbb"] == (3, 1, "bbbbbb", 6, "bbbbbbb")
    assert by_word["bbbbbb"] == (6, 2, "bbbbbbb", 12, "bbbbbbb")
    assert by_word["naïves"][2:] == ("naives", 12, "naives")
    assert by_word["leterr"][2:] == ("leter", 9, "letter")
    assert by_word["lettre"] == (3, 0, None, None, "lettre")
    assert by_word["better"][2:] == (None, None, "better")


def test_tie_goes_to_the_smaller_word(spark):
    by_word = {r[0]: r[1:] for r in found(frame(spark, word_rows({"xaaaa": 8, "xaaab": 8, "xaaac": 3})))}
    assert by_word["xaaac"] == (3, 2, "xaaaa", 8, "xaaaa")


def test_long_ways_end_at_the_last_form(spark):
    word, counts = "abcdefgh", {}
    for i in range(7):
        counts[word[: 8 - i] + "z" * i] = 3 * 2**i
    by_word = {r[0]: r[1:] for r in found(frame(spark, word_rows(counts)))}
    assert {r[-1] for r in by_word.values()} == {"abzzzzzz"}


def test_rows_grow_with_letters_not_with_pairs(spark):
    """Many words at one replaced letter: as many rows as letters, not their square."""
    words = spark.createDataFrame(
        [(f"word{chr(c)}", 5) for c in range(97, 123)] + [("word", 5)], "word string, n long"
    )
    assert spelling.rotations(words).count() == sum(2 * len(w.word) + 1 for w in words.collect())
    near = {r.word: r for r in spelling.neighbours(words).collect()}
    assert near["word"].n_near == 26
    assert near["wordz"].n_near == 26
    assert near["worda"].best.word == "word"


def test_ratio_must_make_ways_end(nothing):
    with pytest.raises(ValueError):
        spelling.variant_groups(nothing, ratio=1)
