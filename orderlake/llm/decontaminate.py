"""Benchmark decontamination: test windows in a broadcast hash set, scanned by all documents.

The words of every benchmark item are normalised and cut into windows of ten words; an item of
fewer words is one window. The windows' hashes, sorted, with the normalised text they come from go
to all tasks. A task hashes every window of its documents with NumPy, looks the hashes up, and
compares the words of each hit with the benchmark's text, so a hash alone decides nothing. Documents
are never shuffled.

What is sent out is bounded: the benchmark is dealt into blocks of at most ``BLOCK_BYTES`` of
normalised text (a long item in overlapping pieces), and documents pass the blocks one after the
other. The same code runs for one block and for many.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import narrowed, stored

# Fixed value of the contract: words in a window.
WINDOW = 10

BLOCK_BYTES = 8 << 20
PIECE_BYTES = 1 << 20
BLOCKS_PER_JOB = 4
_SCAN_BYTES = 1 << 20

# Bytes of a word: digits, letters in lower case, everything beyond ASCII. The rest is a space.
_NORMAL = bytes(
    b + 32
    if 65 <= b <= 90
    else b
    if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
    else 32
    for b in range(256)
)
_POSITIONS = 256
_SPANS = "array<struct<first:long,last:long,start:long,stop:long>>"


def normalised(text: str | None) -> bytes:
    """The text's bytes in lower case, with a space for each byte that is in no word."""
    return (text or "").encode().translate(_NORMAL)


class _Hasher:
    """64-bit hashes of words and windows; another seed gives other hashes."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.values = random.integers(1, 1 << 63, 256, np.uint64)
        self.values[32] = 0
        self.weights = random.integers(1, 1 << 62, _POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)
        self.step = np.uint64(random.integers(1, 1 << 62) * 2 + 1)

    def _some_words(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(text, np.uint8)
        inside = data != 32
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        starts = np.flatnonzero(first)
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        place = np.arange(starts[0], len(data)) - np.repeat(
            starts, np.diff(starts, append=len(data))
        )
        terms = self.values[data[starts[0] :]] * self.weights[place & (_POSITIONS - 1)]
        return starts, np.add.reduceat(terms, starts - starts[0])

    def words(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every word of a normalised text, made a stretch at a time."""
        starts, hashes, at = [], [], 0
        while at < len(text):
            cut = len(text)
            if cut - at > _SCAN_BYTES:
                cut = text.rfind(b" ", at, at + _SCAN_BYTES)
                cut = text.find(b" ", at + _SCAN_BYTES) if cut <= at else cut
                cut = len(text) if cut < 0 else cut
            s, h = self._some_words(text[at:cut])
            starts.append(s + at)
            hashes.append(h)
            at = cut
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return np.concatenate(starts), np.concatenate(hashes)

    def windows(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """The hash of each run of ``length`` words."""
        n = len(hashes) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.full(n, length, np.uint64)
        for i in range(length):
            out = out * self.step + hashes[i : n + i]
        out ^= out >> np.uint64(32)
        return out * np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Block:
    """The windows of some items: ``hashes`` sorted, each the hash of one window text.

    Window ``i`` is the ``sizes[i]`` words of ``text`` from word ``places[i]``; it occurs in the
    items ``owners[bounds[i] : bounds[i + 1]]``, which number the entries of ``items``.
    """

    seed: int
    text: bytes
    starts: np.ndarray
    hashes: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    bounds: np.ndarray
    owners: np.ndarray
    items: list
    lengths: list[int]

    def words(self, place: int, size: int) -> bytes:
        return self.text[self.starts[place] : self.starts[place + size] - 1]


def _block(pieces: list[tuple], seed: int = 1) -> Block:
    """The index of (item, normalised words joined by one space).

    Two different windows with one hash make it start again with another seed.
    """
    hasher = _Hasher(seed)
    text = b"".join(words + b" " for _, words in pieces)
    starts, hashes = hasher.words(text)
    starts = np.append(starts, len(text))
    ends = np.cumsum([0] + [words.count(b" ") + 1 for _, words in pieces])
    found = []
    for i in range(len(pieces)):
        size = int(min(WINDOW, ends[i + 1] - ends[i]))
        own = hasher.windows(hashes[ends[i] : ends[i + 1]], size)
        found.append((own, np.arange(ends[i], ends[i] + len(own)), np.full(len(own), size), i))
    every = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
    place = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    size = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
    # pieces of one item count once
    items = list(dict.fromkeys(item for item, _ in pieces if item is not None))
    number = {item: i for i, item in enumerate(items)}
    owner = np.repeat(
        np.array([number.get(item, -1) for item, _ in pieces], np.int64),
        [len(f[0]) for f in found],
    )
    order = np.lexsort((owner, every))
    every, place, size, owner = every[order], place[order], size[order], owner[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    block = Block(
        seed, text, starts, every[first], place[first], size[first],
        np.zeros(0, np.int64), np.zeros(0, np.int64), items, sorted(set(size.tolist())),
    )
    for i in np.flatnonzero(~new):
        g = group[i]
        if block.words(place[i], size[i]) != block.words(block.places[g], block.sizes[g]):
            return _block(pieces, seed + 1)
    kept = np.ones(len(every), bool)
    kept[1:] = new[1:] | (owner[1:] != owner[:-1])
    kept &= owner >= 0
    counts = np.bincount(group[kept], minlength=len(first))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return Block(
        seed, text, starts, block.hashes, block.places, block.sizes,
        bounds, owner[kept], items, block.lengths,
    )


def _pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, words): normalised words of each item, a long one in pieces that overlap."""
    item_type = benchmark.schema["item"].dataType.simpleString()

    def cut(words: list[bytes]) -> Iterator[bytes]:
        first = size = 0
        for i, word in enumerate(words):
            size += len(word) + 1
            # a piece has whole windows, and the next one starts with the first window cut off
            if size >= PIECE_BYTES and i + 1 - first >= window and i + 1 < len(words):
                yield b" ".join(words[first : i + 1])
                first = i + 2 - window
                size = sum(len(w) + 1 for w in words[first : i + 1])
        if words:
            yield b" ".join(words[first:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = list(cut(normalised(batch.column("text")[i].as_py()).split()))
                item = batch.column("item").slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [item.take(pa.array([0] * len(parts), pa.int32())), pa.array(parts, pa.binary())],
                    ["item", "words"],
                )

    return benchmark.mapInArrow(run, f"item {item_type}, words binary").distinct()


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The benchmark (item, text) as blocks, each of at most ``BLOCK_BYTES``; at least one.

    Only a piece that is larger by itself, ten words of together more than a block, can exceed that.
    """
    pieces = stored(_pieces(benchmark, WINDOW), "benchmark_pieces").withColumn(
        "size", F.length("words")
    )
    total = pieces.agg(F.sum("size")).first()[0] or 0
    n, largest = max(1, -(-total // (BLOCK_BYTES // 2))), None
    while largest is None or (largest > BLOCK_BYTES and n < total // PIECE_BYTES + 1):
        n = n if largest is None else 2 * n
        dealt = pieces.withColumn("block", F.expr(f"pmod(xxhash64(words), {n})"))
        largest = dealt.groupBy("block").agg(F.sum("size").alias("s")).agg(F.max("s")).first()[0] or 0
    for i in range(n):
        rows = dealt.filter(F.col("block") == i).select("item", "words").collect()
        if rows or n == 1:
            yield _block(sorted(((r.item, bytes(r.words)) for r in rows), key=repr))


class _Scanner:
    """Finds the windows of a block in documents."""

    def __init__(self, block: Block):
        self.block, self.hasher = block, _Hasher(block.seed)
        bits = min(24, max(10, (16 * len(block.hashes)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.may_be = np.zeros(1 << bits, bool)
        self.may_be[block.hashes >> self.shift] = True

    def _candidates(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, number of the window) of each hash that is in the block."""
        windows = self.hasher.windows(hashes, length)
        at = np.flatnonzero(self.may_be[windows >> self.shift])
        place = np.searchsorted(self.block.hashes, windows[at])
        place[place == len(self.block.hashes)] = 0
        hit = self.block.hashes[place] == windows[at] if len(at) else np.zeros(0, bool)
        hit &= self.block.sizes[place] == length if len(at) else hit
        return at[hit], place[hit]

    def _same(self, text: bytes, ends: np.ndarray, at: int, place: int, size: int) -> bool:
        """Whether ``size`` words from ``at`` are the block's words from ``place``."""
        found = b" ".join(text[ends[at] : ends[at + size]].split())
        return found == self.block.words(place, size)

    def _verified(
        self, text: bytes, starts: np.ndarray, at: np.ndarray, number: np.ndarray, length: int
    ) -> np.ndarray:
        """Which candidates have the block's words; a run of neighbours is compared at once."""
        places = self.block.places[number]
        breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(places) != 1)) + 1
        right = np.zeros(len(at), bool)
        for first, last in zip([0, *breaks], [*breaks, len(at)]):
            size = length + last - first - 1
            if self._same(text, starts, at[first], places[first], size):
                right[first:last] = True
            else:
                for i in range(first, last):
                    right[i] = self._same(text, starts, at[i], places[i], length)
        return right

    def scan(self, texts: list[bytes]) -> list[tuple[int, list[tuple], list]]:
        """(number of words, spans, items) of each normalised text."""
        text = b" ".join(texts)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        starts, hashes = self.hasher.words(text)
        bounds = np.searchsorted(starts, begins)
        counts = np.diff(bounds)
        out = [(int(n), [], []) for n in counts]
        if not len(self.block.hashes):
            return out
        ends = np.append(starts, len(text))
        ats, numbers, stops = [], [], []
        for length in self.block.lengths:
            at, number = self._candidates(hashes, length)
            doc = np.searchsorted(bounds, at, "right") - 1
            whole = at + length <= bounds[doc + 1]
            at, number = at[whole], number[whole]
            if len(at):
                right = self._verified(text, ends, at, number, length)
                ats.append(at[right])
                numbers.append(number[right])
                stops.append(at[right] + length)
        if not ats:
            return out
        at, number, stop = map(np.concatenate, (ats, numbers, stops))
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, stop, -1)
        hit = np.cumsum(cover) > 0
        docs = np.searchsorted(bounds, at, "right") - 1
        for d in np.unique(docs):
            low, high = bounds[d], bounds[d + 1]
            out[d] = (
                int(counts[d]),
                self._spans(texts[d], hit[low:high], starts[low:high] - begins[d]),
                self._items(np.unique(number[docs == d])),
            )
        return out

    def _items(self, numbers: np.ndarray) -> list:
        block = self.block
        owners = [block.owners[block.bounds[i] : block.bounds[i + 1]] for i in numbers]
        return [block.items[i] for i in np.unique(np.concatenate(owners))]

    def _spans(self, text: bytes, hit: np.ndarray, starts: np.ndarray) -> list[tuple]:
        """(first word, word after the last, code point of each) of the runs of hit words."""
        edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
        points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        spans = []
        for first, last in zip(edges[::2], edges[1::2]):
            begin = int(starts[first])
            final = int(starts[last - 1])
            end = text.find(b" ", final)
            end = len(text) if end < 0 else end
            spans.append((int(first), int(last), int(points[begin]) - 1, int(points[end - 1])))
        return spans


def merged(spans: list[tuple]) -> list[tuple]:
    """Spans of several blocks as the fewest that do not touch in words."""
    out: list[tuple] = []
    for span in sorted(spans):
        if out and span[0] <= out[-1][1]:
            last = out.pop()
            span = (last[0], max(last[1], span[1]), last[2], max(last[3], span[3]))
        out.append(span)
    return out


def _scan(rows: DataFrame, block: Block) -> DataFrame:
    """``rows`` (row, text, n_words, spans, items) after one more block."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(sent.value)

        def flush(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
            found = scanner.scan(texts)
            # most documents have no hit, before or now
            spans, items = part.column("spans").to_pylist(), part.column("items").to_pylist()
            for i, (_, more, more_items) in enumerate(found):
                if more:
                    old = [(s["first"], s["last"], s["start"], s["stop"]) for s in spans[i]]
                    spans[i] = [
                        dict(zip(("first", "last", "start", "stop"), s)) for s in merged(old + more)
                    ]
                    items[i] = list(dict.fromkeys(items[i] + more_items))
            return pa.RecordBatch.from_arrays(
                [
                    part.column("row"),
                    part.column("text"),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array(spans, part.schema.field("spans").type),
                    pa.array(items, part.schema.field("items").type),
                ],
                ["row", "text", "n_words", "spans", "items"],
            )

        for batch in batches:
            first, size, texts = 0, 0, []
            for i in range(batch.num_rows):
                texts.append(normalised(batch.column("text")[i].as_py()))
                size += len(texts[-1])
                if size >= _SCAN_BYTES:
                    yield flush(batch.slice(first, i + 1 - first), texts)
                    first, size, texts = i + 1, 0, []
            if texts:
                yield flush(batch.slice(first), texts)

    return rows.mapInArrow(run, rows.schema)


def _scanned(docs: DataFrame, row: list[str], text: str, benchmark: DataFrame) -> DataFrame:
    """(row, text, n_words, spans, items): ``row`` holds the named columns of ``docs``."""
    item_type = benchmark.schema["item"].dataType.simpleString()
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in row)).alias("row"),
        F.col(f"`{text}`").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPANS).alias("spans"),
        F.array().cast(f"array<{item_type}>").alias("items"),
    )
    for i, block in enumerate(blocks(benchmark)):
        if i and i % BLOCKS_PER_JOB == 0:
            rows = stored(rows, "scanned")
        rows = _scan(rows, block)
    return rows


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items, spans, contaminated.

    ``spans`` are the runs of hit words: words ``first`` up to ``last`` and code points ``start`` up
    to ``stop``, both ends exclusive. ``items`` are the distinct ids of the items that have a window
    in the document, in no order; items without an id hit words but are not listed. Null and blank
    texts have no words and no hit, and null or blank items no window. Rows with equal ids stay
    separate rows, repeated items count once. Other columns are ignored; an empty table of documents
    gives an empty result, an empty benchmark no hit.
    """
    rows = _scanned(
        narrowed(docs, doc_id=id_column, text=text),
        ["doc_id"],
        "text",
        narrowed(benchmark, item=item_id, text=item_text),
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return rows.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        "items",
        "spans",
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_spans(text: str, spans: list[dict]) -> str:
    """The text without the code points of each span."""
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : span["start"]])
        at = span["stop"]
    return "".join([*kept, text[at:]])


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    *,
    remove: str = "spans",
) -> DataFrame:
    """``docs`` without what the benchmark holds, with all their columns under their names.

    With ``remove="spans"`` every run of hit words is cut out of its text, and what stands around it
    stays as it is; with ``remove="documents"`` documents with a hit go. Documents without a hit stay
    unchanged, null and blank texts included.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove must be 'spans' or 'documents', not {remove!r}")
    rows = _scanned(docs, docs.columns, text, narrowed(benchmark, item=item_id, text=item_text))
    if remove == "documents":
        return rows.filter(F.size("spans") == 0).select("row.*")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            texts = [
                without_spans(t.as_py(), s.as_py()) if len(s) else t.as_py()
                for t, s in zip(batch.column("text"), spans)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, batch.column("text").type)], ["row", "text"]
            )

    kept = rows.select("row", "text", "spans").mapInArrow(
        cut, rows.select("row", "text").schema
    )
    return kept.select(
        *(F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )


def digests(found: DataFrame) -> DataFrame:
    """The columns of ``contamination`` with the items as a count and one hash."""
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        "contaminated",
    )
