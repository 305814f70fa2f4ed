"""Language-model scores: stupid backoff over bigram tables, counted and joined by hash.

Every word position of every document is counted, and every document is scored by the tables made
from all of them. With counts c, N words in all and backoff factor 0.4, a word v after u scores
c(uv) / c(u) if the bigram occurs at least ``cutoff`` times, else 0.4 c(v) / N; a first word
scores c(v) / N. A document's score is the mean natural logarithm.

Words are told apart by a number of 63 bits (``word_hash``), or by what a caller's ``word_key``
makes of them. The table of words grows with the input and is partitioned by that number; only its
``MAX_WORDS`` most frequent rows are sent to all tasks, which turn these hot words into their rank.
A word that is not hot has at most N / MAX_WORDS positions, and so has a bigram that holds one, so
joining them by hash fills no single partition. Of bigrams of two hot words the ``MAX_FREQUENT``
most frequent ones, found and counted on all documents, are summed where they stand. The others are
dealt out by a part of their number into buckets, whose count follows the input; a task sends one row
per bucket and run of documents, with the positions packed side by side.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import narrowed, pieces, stored

CLASS_BITS = 20
HOT_BITS = 17
MAX_WORDS = 1 << HOT_BITS
MAX_FREQUENT = 1 << 17
_BATCH_WORDS = 2_000_000
_CACHED_WORDS = 200_000
_GRAM_BITS = 2 * HOT_BITS
_MIX = 0x2545F4915  # odd, so that multiplying modulo 2**_GRAM_BITS has an inverse
_LEAST_BUCKET_BITS = 8
_BUCKET_WORDS = 1 << 19  # words of the input per bucket
_RUN_ROWS = 1 << 16  # documents of a run: their places in it fit 16 bits
_COLD = np.uint64(1 << 63)


def word_class(word: bytes) -> int:
    """The class of a word in the contract of ``op4_lm_score``: 20 bits of its MD5."""
    return int(hashlib.md5(word).hexdigest()[: CLASS_BITS // 4], 16)


def word_hash(word: bytes) -> int:
    """63 bits, which tell words apart: two of 10**8 are equal with a chance near 1 in 2,000."""
    return xxhash.xxh64_intdigest(word) >> 1


class _Keys(dict):
    """Numbers of words; forgotten when too many."""

    def __init__(self, key: Callable[[bytes], int]):
        super().__init__()
        self.key = key

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = self.key(word)
        return value


def _words(
    batches: Iterator[pa.RecordBatch], key: Callable[[bytes], int]
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """(rows, the words of each as negative numbers), a few rows at a time.

    Only ASCII white space separates words, which is what ``split`` of byte strings does.
    """
    keys = _Keys(key)
    for batch in pieces(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        split = ((t or b"").split() for t in texts)
        yield batch, [
            (np.fromiter(map(keys.__getitem__, w), np.uint64, len(w)) | _COLD).view(np.int64)
            for w in split
        ]


class _Counter:
    """Counts of numbers, made in batches."""

    def __init__(self, name: str, least: Callable[[int], float] = lambda size: 1):
        self.name, self.least, self.held, self.size = name, least, [], 0

    def add(self, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(values)
        self.size += len(values)
        if self.size >= _BATCH_WORDS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            values, counts = np.unique(np.concatenate(self.held), return_counts=True)
            often = counts >= self.least(self.size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[often]), pa.array(counts[often].astype(np.int64))],
                [self.name, "c"],
            )
        self.held, self.size = [], 0


def _unigrams(docs: DataFrame, key: Callable[[bytes], int]) -> DataFrame:
    """(word, c) for every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter("word")
        for _, words in _words(batches, key):
            yield from counter.add(np.concatenate(words))
        yield from counter.rest()

    counts = docs.select("text").mapInArrow(run, "word bigint, c bigint")
    return stored(counts.groupBy("word").agg(F.sum("c").alias("c")), "unigrams")


def _number_lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _tokens(docs: DataFrame, key: Callable[[bytes], int], hot_words: np.ndarray) -> DataFrame:
    """(row, doc_id, ranks, cold): ranks of hot words and -1 for the others, which ``cold`` lists."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = np.argsort(hot_words)
    sent = docs.sparkSession.sparkContext.broadcast((hot_words[order], order.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = sent.value
        for batch, words in _words(batches, key):
            lengths = np.array([len(w) for w in words], np.int64)
            flat = np.concatenate(words)
            ranks = np.full(len(flat), -1, np.int32)
            if len(known):
                place = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                hit = known[place] == flat
                ranks[hit] = rank[place[hit]]
            document = np.repeat(np.arange(len(words)), lengths)
            cold = np.bincount(document[ranks < 0], minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    _number_lists(lengths, ranks),
                    _number_lists(cold, flat[ranks < 0]),
                ],
                ["row", "doc_id", "ranks", "cold"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return stored(
        rows.mapInArrow(run, f"row bigint, doc_id {kind}, ranks array<int>, cold array<bigint>"),
        "tokens",
    )


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return np.diff(offsets), column.values.to_numpy()[offsets[0] : offsets[-1]]


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, u, v) per position after the first; hot words by rank, others as they are."""
    lengths, ranks = _flat(batch.column("ranks"))
    words = ranks.astype(np.int64)
    if "cold" in batch.schema.names:
        words[ranks < 0] = _flat(batch.column("cold"))[1]
    document = np.repeat(np.arange(len(lengths)), lengths)
    together = document[1:] == document[:-1]
    return document[1:][together], words[:-1][together], words[1:][together]


def _hot_grams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(document, gram) per bigram of two hot words."""
    document, u, v = _pairs(batch)
    hot = (u >= 0) & (v >= 0)
    return document[hot], (u[hot] << HOT_BITS) + v[hot]


def _among(known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each value is known, the places of those that are)."""
    if not len(known):
        return np.zeros(len(values), bool), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    hit = known[place] == values
    return hit, place[hit]


def _frequent(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent bigrams of hot words, sorted, and their counts over all documents."""
    context, most = tokens.sparkSession.sparkContext, MAX_FREQUENT

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rarer ones of a batch fill no partition
        counter = _Counter("gram", lambda size: max(2, size >> HOT_BITS))
        for batch in pieces(batches):
            yield from counter.add(_hot_grams(batch)[1])
        yield from counter.rest()

    schema = "gram bigint, c bigint"
    found = (
        tokens.select("ranks")
        .mapInArrow(often, schema)
        .groupBy("gram")
        .agg(F.sum("c").alias("c"))
        .orderBy(F.desc("c"), "gram")
        .limit(most)
        .toPandas()
    )
    sent = context.broadcast(np.sort(found["gram"].to_numpy(np.int64)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = sent.value
        counts = np.zeros(len(grams), np.int64)
        for batch in pieces(batches):
            counts += np.bincount(_among(grams, _hot_grams(batch)[1])[1], minlength=len(grams))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams[some]), pa.array(counts[some])], ["gram", "c"]
        )

    exact = (
        tokens.select("ranks")
        .mapInArrow(count, schema)
        .groupBy("gram")
        .agg(F.sum("c").alias("c"))
        .toPandas()
        .sort_values("gram")
    )
    return exact["gram"].to_numpy(np.int64), exact["c"].to_numpy(np.int64)


def _bucket_bits(total: int) -> int:
    """Bits of a mixed bigram that say its bucket; the others fit 32 bits."""
    return min(max(_LEAST_BUCKET_BITS, (total // _BUCKET_WORDS).bit_length()), _GRAM_BITS)


def _packed(
    rows: list[np.ndarray], grams: list[np.ndarray], bits: int
) -> Iterator[pa.RecordBatch]:
    """(bucket, base, places, rests): a row per bucket, its positions side by side."""
    if not rows:
        return
    row, gram = np.concatenate(rows), np.concatenate(grams).astype(np.uint64)
    mixed = (gram * np.uint64(_MIX)) & np.uint64((1 << _GRAM_BITS) - 1)
    bucket = (mixed >> np.uint64(_GRAM_BITS - bits)).astype(np.int64)
    order = np.argsort(bucket.astype(np.uint16) if bits <= 16 else bucket, kind="stable")
    row, mixed, bucket = row[order], mixed[order], bucket[order]
    base = row.min()
    places = (row - base).astype("<u2")
    rests = (mixed & np.uint64((1 << (_GRAM_BITS - bits)) - 1)).astype("<u4")
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = [*starts[1:].tolist(), len(bucket)]
    spans = list(zip(starts.tolist(), ends))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[starts]),
            pa.array(np.full(len(starts), base, np.int64)),
            pa.array([places[a:b].tobytes() for a, b in spans], pa.binary()),
            pa.array([rests[a:b].tobytes() for a, b in spans], pa.binary()),
        ],
        ["bucket", "base", "places", "rests"],
    )


def _unpacked(table: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram) of each position in the rows of one bucket, ordered by bigram."""
    places = table.column("places").to_pylist()
    row = np.frombuffer(b"".join(places), "<u2").astype(np.int64)
    row += np.repeat(table.column("base").to_numpy(), [len(p) // 2 for p in places])
    rest = np.frombuffer(b"".join(table.column("rests").to_pylist()), "<u4").astype(np.uint64)
    order = np.argsort(rest)
    bucket = np.uint64(table.column("bucket")[0].as_py())
    mixed = (bucket << np.uint64(_GRAM_BITS - bits)) | rest[order]
    inverse = np.uint64(pow(_MIX, -1, 1 << _GRAM_BITS))
    gram = (mixed * inverse) & np.uint64((1 << _GRAM_BITS) - 1)
    return row[order], gram.astype(np.int64)


def backoff_scores(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    cutoff: int = 2,
    backoff: float = 0.4,
    word_key: Callable[[bytes], int] = word_class,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_seen (bigrams in the table), lm_score.

    ``word_key`` says which words count as one, by a number below 2**63: ``word_hash`` keeps all
    apart, ``word_class`` is the contract of ``op4_lm_score`` and pools them in 2**20 classes.
    A null or empty text has no words and a null score. Repeated rows count each time and get a
    row each; an empty table gives an empty table. Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    docs = narrowed(docs, doc_id=id_column, text=text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    unigrams = _unigrams(docs, word_key)
    total = unigrams.agg(F.sum("c")).first()[0] or 1
    log_total, bits = math.log(total), _bucket_bits(total)
    top = unigrams.orderBy(F.desc("c"), "word").limit(MAX_WORDS).toPandas()
    tokens = _tokens(docs, word_key, top["word"].to_numpy(np.int64))
    logs = np.log(top["c"].to_numpy(np.float64))
    grams, counts = _frequent(tokens)
    # what a seen bigram adds to the score of backing off, besides logarithms of counts
    gain = log_total - math.log(backoff)
    gains = (
        np.log(counts) - logs[grams >> HOT_BITS] - logs[grams & ((1 << HOT_BITS) - 1)] + gain
    )
    sent = spark.sparkContext.broadcast((logs, grams, gains * (counts >= cutoff), counts >= cutoff))

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, grams, gains, seen = sent.value
        for batch in pieces(batches):
            lengths, ranks = _flat(batch.column("ranks"))
            size = len(lengths)
            words = np.repeat(np.arange(size), lengths)[ranks >= 0]
            document, found = _hot_grams(batch)
            hit, place = _among(grams, found)
            part = np.bincount(words, logs[ranks[ranks >= 0]], size) - lengths * log_total
            part += np.bincount(document[hit], gains[place], size)
            n_seen = np.bincount(document[hit], seen[place], size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(lengths.astype(np.int64)),
                    pa.array(part),
                    pa.array(n_seen.astype(np.int64)),
                ],
                ["row", "doc_id", "n_words", "hot_part", "hot_seen"],
            )

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = sent.value[1]
        rows, found, size, low, high = [], [], 0, 0, 0
        for batch in pieces(batches):
            document, each = _hot_grams(batch)
            hit, _ = _among(grams, each)
            if hit.all():
                continue
            row = batch.column("row").to_numpy()[document[~hit]]
            each = each[~hit]
            # a run ends where the next documents' numbers lie too far off, as in another file
            while len(row):
                first, last = int(row.min()), int(row.max())
                if last - first >= _RUN_ROWS:
                    near = (row >= first) & (row < first + _RUN_ROWS)
                else:
                    near = np.ones(len(row), bool)
                last = int(row[near].max())
                if rows and max(high, last) - min(low, first) >= _RUN_ROWS:
                    yield from _packed(rows, found, bits)
                    rows, found, size = [], [], 0
                low, high = (min(low, first), max(high, last)) if rows else (first, last)
                rows.append(row[near])
                found.append(each[near])
                size += int(near.sum())
                row, each = row[~near], each[~near]
            if size >= _BATCH_WORDS:
                yield from _packed(rows, found, bits)
                rows, found, size = [], [], 0
        yield from _packed(rows, found, bits)

    def rare_parts(bucket: pa.Table) -> pa.Table:
        logs = sent.value[0]
        row, gram = _unpacked(bucket, bits)
        starts = np.flatnonzero(np.diff(gram, prepend=-1))
        n = np.diff(np.append(starts, len(gram)))
        often = np.repeat(n >= cutoff, n)
        u, v = gram[starts] >> HOT_BITS, gram[starts] & ((1 << HOT_BITS) - 1)
        part = np.repeat(np.log(n) - logs[u] - logs[v] + gain, n)[often]
        row, place = np.unique(row[often], return_inverse=True)
        return pa.table(
            {
                "row": pa.array(row, pa.int64()),
                "part": pa.array(np.bincount(place, part, len(row)), pa.float64()),
                "seen": pa.array(np.bincount(place, minlength=len(row)), pa.int64()),
            }
        )

    def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            document, u, v = _pairs(batch)
            some = (u < 0) | (v < 0)
            rows = batch.column("row").to_numpy()[document[some]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(u[some]), pa.array(v[some])], ["row", "u", "v"]
            )

    rare_sums = (
        tokens.select("row", "ranks")
        .mapInArrow(rare, "bucket bigint, base bigint, places binary, rests binary")
        .groupBy("bucket")
        .applyInArrow(rare_parts, "row bigint, part double, seen bigint")
    )
    cold_seen = stored(
        tokens.select("row", "ranks", "cold")
        .mapInArrow(cold, "row bigint, u bigint, v bigint")
        .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("u", "v")))
        .filter(F.col("n") >= cutoff)
        .select("row", "u", "v", F.lit(1).alias("k"), "n"),
        "cold_bigrams",
    )

    # At most MAX_WORDS rows.
    hot = spark.createDataFrame(
        list(enumerate(logs.tolist())), "rank bigint, log_c double"
    )

    def summed(seen: DataFrame) -> DataFrame:
        """(row, part, seen); words that are not hot are left to ``cold_words``."""
        for x in "uv":
            side = F.broadcast(hot.select(F.col("rank").alias(x), F.col("log_c").alias(f"log_{x}")))
            seen = seen.join(side, x, "left")
        known = F.coalesce("log_u", F.lit(0.0)) + F.coalesce("log_v", F.lit(0.0))
        part = F.col("k") * (F.log("n") - known + gain)
        return seen.groupBy("row").agg(F.sum(part).alias("part"), F.sum("k").alias("seen"))

    cold_words = tokens.select("row", F.explode("cold").alias("word"), F.lit(1).alias("k"))
    for x in "uv":
        cold_words = cold_words.unionByName(
            cold_seen.filter(F.col(x) < 0).select("row", F.col(x).alias("word"), (-F.col("k")).alias("k"))
        )
    of_words = (
        cold_words.join(unigrams, "word")
        .groupBy("row")
        .agg(F.sum(F.col("k") * F.log("c")).alias("part"))
        .select("row", "part", F.lit(0).cast("bigint").alias("seen"))
    )
    sums = (
        rare_sums.unionByName(summed(cold_seen))
        .unionByName(of_words)
        .groupBy("row")
        .agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"))
    )
    rows = tokens.select("row", "doc_id", "ranks").mapInArrow(
        base, f"row bigint, doc_id {kind}, n_words bigint, hot_part double, hot_seen bigint"
    )
    score = (
        F.col("hot_part")
        + F.coalesce("part", F.lit(0.0))
        + (F.col("n_words") - 1) * math.log(backoff)
    )
    return rows.join(sums, "row", "left").select(
        "doc_id",
        "n_words",
        (F.col("hot_seen") + F.coalesce("seen", F.lit(0))).cast("bigint").alias("n_seen"),
        F.when(F.col("n_words") > 0, F.round(score / F.col("n_words"), 6)).alias("lm_score"),
    )
