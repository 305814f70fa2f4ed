"""Spelling variant grouping by permuterm rotations.

A word of L letters is closed with a terminator, and its rotations are sorted: ``cat`` has ``cat$``,
``at$c``, ``t$ca`` and ``$cat``. The rotation that starts behind letter i, without its last letter,
is the word with letter i skipped: words that share such a prefix and are as long differ by a
replaced letter, and the word whose whole rotation is that prefix lacks the letter. So the words
near each other stand together in the sorted rotations, as one prefix range per skipped letter:
the shorter word first, then a word for each letter that fills the gap.

A range has at most one word per letter of the alphabet and one without, 91 in all, whatever the
corpus. A replaced letter is found in one range. An inserted letter in a run of equal letters is
found once per letter of the run, of which the first is counted. Neighbours are emitted as one row per
word and range (how many, and the most frequent), so rows grow with the words' letters, not with
pairs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import narrowed, pieces, stored

# Fixed values of the contract: letters, the checksum's divisor, and what counts as a word.
DAMAGED = 97
MIN_LETTERS = 5
MIN_COUNT = 3

END = "$"
_HELD = 300_000

# Bytes of Latin-1 text: lower-case letters, and a space for everything else.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def runs(text: str | None) -> list[bytes]:
    """The runs of letters of a text, in Latin-1, A-Z in lower case.

    What Latin-1 lacks is no letter and becomes a question mark, which parts words as a space does.
    """
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split(b" ")


def as_written(doc_id: object, run: bytes) -> bytes:
    """The run, or the run without one letter where its checksum with the document says so."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    return _damaged(run, start)


def _damaged(run: bytes, start: int) -> bytes:
    written = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(written, start)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) for documents (doc_id, text): all words that are long and frequent enough.

    Each task adds up its own counts, some hundred thousand words at a time, before they are
    shuffled, so the most frequent word sends a few rows per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            counts = pa.array(list(held.values()), pa.int64())
            return pa.RecordBatch.from_arrays([words, counts], ["word", "n"])

        for batch in pieces(batches):
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            ):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for found, n in Counter(runs(text)).items():
                    # a shorter run cannot become long enough
                    if len(found) >= MIN_LETTERS:
                        word = _damaged(found, start)
                        if len(word) >= MIN_LETTERS:
                            held[word] = held.get(word, 0) + n
                if len(held) >= _HELD:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """(key, letter, n): every rotation of every word, whole and without its last letter.

    ``key`` is a rotation or its prefix, ``letter`` the one that the prefix skips, empty for a whole
    rotation. Both halves of the word can be read from the key.
    """
    whole = (
        "transform(sequence(0, length(word)), i -> struct("
        f"concat(substring(word, i + 1), '{END}', substring(word, 1, i)) AS key, '' AS letter))"
    )
    skipped = (
        "transform(sequence(1, length(word)), i -> struct("
        f"concat(substring(word, i + 1), '{END}', substring(word, 1, i - 1)) AS key, "
        "substring(word, i, 1) AS letter))"
    )
    return words.select(F.expr(f"inline(concat({whole}, {skipped}))"), "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best) for the words (word, n) that are near another one.

    ``n_near`` counts the words at one inserted, deleted or replaced letter; ``best`` is the most
    frequent of them as (n, word), ties by the smallest word. Words must be distinct.
    """
    before = F.substring_index("key", END, -1)
    after = F.substring_index("key", END, 1)
    keyed = rotations(words).withColumn("word", F.concat(before, F.col("letter"), after))
    ranges = (
        Window.partitionBy("key")
        .orderBy(F.desc("n"), "word")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    # a letter equal to the one before it gives the same shorter word as that one
    first_of_run = (F.col("letter") != "") & (F.col("letter") != F.substring("key", -1, 1))
    each = F.struct(F.col("n"), F.col("word"))
    scanned = keyed.withColumn("first_of_run", first_of_run).select(
        "word",
        "letter",
        "first_of_run",
        F.count(F.lit(1)).over(ranges).alias("size"),
        F.max(F.col("letter") == "").over(ranges).alias("has_shorter"),
        F.count_if("first_of_run").over(ranges).alias("n_longer"),
        F.first(each).over(ranges).alias("top"),
        F.nth_value(each, 2).over(ranges).alias("second"),
    )
    replaced = F.col("size") - 1 - F.col("has_shorter").cast("long")
    shorter = (F.col("has_shorter") & F.col("first_of_run")).cast("long")
    near = F.when(F.col("letter") == "", F.col("n_longer")).otherwise(replaced + shorter)
    best = F.when(F.col("top.word") == F.col("word"), F.col("second")).otherwise(F.col("top"))
    emitted = scanned.filter("size > 1").select("word", near.alias("near"), best.alias("best"))
    order = F.struct((-F.col("best.n")).alias("fewer"), F.col("best.word").alias("word"))
    return emitted.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min_by("best", order).alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word that forms lead to.

    Every step joins the table with itself and doubles how far a row has gone, so there are as many
    steps as the longest way has bits. Counts at least double from word to form, so ways end.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = reached.join(further, "root", "left")
        moved = stored(
            joined.select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")
            ),
            "roots",
        )
        reached = moved.select("word", "root")
        if not moved.filter("on").limit(1).count():
            return reached


def variant_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", *, ratio: int = 2
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Words are the runs of Latin letters of all whole texts, A-Z in lower case, some of them damaged
    by ``as_written``, that have at least ``MIN_LETTERS`` letters and occur ``MIN_COUNT`` times.
    ``form`` is the most frequent near word (ties: the smallest by code points) if it occurs at
    least ``ratio`` times as often as the word, else null; ``root`` is where forms lead, the word
    itself without a form. Words of one root are spellings of it. ``ratio`` must be above 1, or forms
    could go round in circles. Null and blank texts have no words; a null id counts as an empty
    text in the checksum. Repeated rows count each time. An empty table gives an empty result.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    words = stored(word_counts(narrowed(docs, doc_id=id_column, text=text)), "words")
    near = neighbours(words)
    enough = F.col("best.n") >= ratio * F.col("n")
    known = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.word")).alias("form"),
            F.when(enough, F.col("best.n")).alias("form_n"),
        ),
        "near_words",
    )
    roots = _roots(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
