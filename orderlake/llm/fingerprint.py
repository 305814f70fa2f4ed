"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A document is a multiset of paragraphs (lines). Each paragraph hashes to a wide vector, and a
fingerprint is the sum of its paragraphs' vectors modulo powers of two. So the order of paragraphs
does not matter, and paragraphs can be inserted or deleted by adding or subtracting their vectors.

A vector has two sections. The exact one (8 lanes modulo 2**64, from BLAKE2b of the paragraph)
decides equality. The likeness one (128 lanes modulo 2**32) adds each word trigram of the
paragraph (of a paragraph under 8 words also each word) to a lane with a sign, so the cosine of two
sections estimates how much text they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import narrowed, pieces

EXACT, LIKE = 8, 128
SHORT = 8  # words; a shorter paragraph has few trigrams
_LANE_BITS = np.uint64(7)
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_CACHED_WORDS = 200_000


class _Hashes(dict):
    """64-bit hashes of words; forgotten when too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()

Vector = tuple[np.ndarray, np.ndarray]


def vector(paragraphs: list[str]) -> Vector:
    """The sum of the paragraphs' vectors."""
    digests = b"".join(
        hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=64).digest()
        for p in paragraphs
    )
    exact = np.frombuffer(digests, np.uint64).reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
    words: list[str] = []
    ends, short = [], []
    for p in paragraphs:
        own = p.split()
        if len(own) < SHORT:
            short += map(_hashes.__getitem__, own)
        if len(own) > 2:
            words += own
            ends.append(len(words))
    grams = np.array(short, np.uint64)
    if words:
        h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
        windows = (h[:-2] * _MIX[0]) ^ (h[1:-1] * _MIX[1]) ^ (h[2:] * _MIX[2])
        # a window must not cross the end of a paragraph
        inside = np.ones(len(words) + 2, bool)
        inside[np.array(ends) - 1] = inside[np.array(ends) - 2] = False
        grams = np.concatenate([grams, windows[inside[: len(windows)]]])
    grams = grams * _MIX[1]
    lanes = (grams >> (np.uint64(64) - _LANE_BITS)).astype(np.int64)
    signs = 1.0 - 2.0 * ((grams >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    like = np.bincount(lanes, weights=signs, minlength=LIKE).astype(np.int64).astype(np.uint32)
    return exact, like


def fingerprint(text: str | None) -> Vector:
    """The fingerprint of a text; a null text counts as empty, which is one empty paragraph."""
    return vector((text or "").split("\n"))


def inserted(base: Vector, paragraphs: list[str]) -> Vector:
    more = vector(paragraphs)
    return base[0] + more[0], base[1] + more[1]


def deleted(base: Vector, paragraphs: list[str]) -> Vector:
    less = vector(paragraphs)
    return base[0] - less[0], base[1] - less[1]


def as_text(v: Vector) -> str:
    return v[0].astype("<u8").tobytes().hex() + v[1].astype("<u4").tobytes().hex()


def likeness(a: Vector, b: Vector) -> float:
    """1 for equal fingerprints, else the cosine of the likeness sections, at least 0."""
    if np.array_equal(a[0], b[0]):
        return 1.0
    x, y = (v[1].view(np.int32).astype(np.float64) for v in (a, b))
    norm = float(np.sqrt((x @ x) * (y @ y)))
    return min(max(float(x @ y) / norm, 0.0), 1.0) if norm else 0.0


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint) for every row of ``docs``, as they are."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            prints = [as_text(fingerprint(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"]
            )

    return narrowed(docs, doc_id=id_column, text=text).mapInArrow(
        run, f"doc_id {kind}, fingerprint string"
    )


# Each document with the next


def _dealt(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, part, tail): ranges of ids, each closed by a copy of the row after it.

    Range bounds come from the ids alone. Of them and of the first id in each range only as many
    as there are ranges reach the driver, so each text is shuffled once.
    """
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id").filter("doc_id is not null")
    ranged = ids.repartitionByRange(n, "doc_id").groupBy(F.spark_partition_id().alias("p"))
    bounds = sorted(row.low for row in ranged.agg(F.min("doc_id").alias("low")).collect())
    if not bounds:
        part = F.lit(0)
    else:
        edges = np.array(bounds)

        @F.pandas_udf("int")
        def range_of(values):
            import pandas as pd

            return pd.Series(np.searchsorted(edges, values.to_numpy(), side="right") - 1)

        part = F.when(F.col("doc_id").isNull(), len(bounds) - 1).otherwise(
            range_of(F.coalesce("doc_id", F.lit(bounds[0])))
        )
    # Every bound is the smallest id of its range; only without any id is there none.
    firsts = bounds or [None]
    kind = docs.schema["doc_id"].dataType
    heads = spark.createDataFrame(
        [(low, (k - 1) % len(firsts)) for k, low in enumerate(firsts)],
        f"low {kind.simpleString()}, before int",
    )
    both = docs.withColumn("part", part.cast("int")).join(
        F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("low")), "left"
    )
    own = F.struct("part", F.lit(0).alias("tail"))
    copy = F.struct(F.col("before").alias("part"), F.lit(1).alias("tail"))
    places = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))
    return both.select("doc_id", "text", F.explode(places).alias("place")).select(
        "doc_id", "text", "place.part", "place.tail"
    )


def with_next(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike they and the next are.

    The edited text has the last floor(n/2) code points replaced by the first as many (or all) of
    the next document by ascending id; after the last comes the first. Null ids come last, rows
    with equal ids follow each other by text, and a null text counts as empty.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    narrow = narrowed(docs, doc_id=id_column, text=text)
    rows = _dealt(narrow.withColumn("text", F.coalesce("text", F.lit(""))))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, "part").sortWithinPartitions(
        "part", "tail", F.col("doc_id").asc_nulls_last(), "text"
    )
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    names += ["near_edited", "near_next"]

    def compared(doc_id, own_text, own, next_text, following):
        half = len(own_text) // 2
        edited = own_text[: len(own_text) - half] + next_text[:half]
        changed = fingerprint(edited)
        return (
            doc_id,
            len(own_text),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            as_text(own),
            as_text(changed),
            likeness(own, changed),
            likeness(own, following),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row that still waits for the next one of its range
        for batch in pieces(batches):
            out = []
            for doc_id, current, part, tail in zip(
                batch.column("doc_id"),
                batch.column("text").to_pylist(),
                batch.column("part").to_pylist(),
                batch.column("tail").to_pylist(),
            ):
                waits = last is not None and last[3] == part
                if tail and not waits:
                    continue  # further rows with the id of the first one
                own = fingerprint(current)
                if waits:
                    out.append(compared(*last[:3], current, own))
                last = None if tail else (doc_id.as_py(), current, own, part)
            columns = list(zip(*out)) or [()] * len(names)
            kinds = [batch.column("doc_id").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names
            )

    return ordered.mapInArrow(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
