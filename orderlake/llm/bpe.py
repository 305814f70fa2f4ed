"""Byte-level BPE: encoding and decoding by the ranks of a tokenizer file.

A text is split by the tokenizer's pattern and each piece is merged on its own: the adjacent pair
with the lowest rank, the leftmost of equals, until no pair has a rank. Pieces new to a worker are
merged together as padded matrices, one per range of lengths: each round merges one pair in every
row, looks up only the pairs beside the merge in a hash table, closes the gap and takes finished
rows out. Pieces longer than ``LONGEST_ROW`` bytes, for which rounds over a matrix would cost the
square of their length, are merged with a heap of pairs in the same order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from orderlake.llm.common import narrowed, pieces

NONE = np.int32(2**31 - 1)  # the rank of a pair that does not merge
LONGEST_ROW = 256
_CACHED_PIECES = 200_000
_CHUNK_CHARS = 1_000_000
_IDS = ArrayType(IntegerType())
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rank of each mergeable pair of tokens, in an open-addressing hash table."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(8, (2 * len(rank)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = self._key(left, right)
        place = self._place(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[place] == 0)
            _, first = np.unique(place[free], return_index=True)
            won = free[first]
            self.keys[place[won]] = keys[won]
            self.ranks[place[won]] = rank[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, rank = keys[rest], rank[rest]
            place = (place[rest] + 1) & (len(self.keys) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return ((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)) + np.uint64(1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._key(left, right)
        place = self._place(keys)
        found = np.full(len(keys), NONE, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[place]
            hit = there == keys
            found[open_[hit]] = self.ranks[place[hit]]
            go_on = ~hit & (there != 0)
            open_, keys = open_[go_on], keys[go_on]
            place = (place[go_on] + 1) & (len(self.keys) - 1)
        return found


@dataclass(frozen=True)
class Vocabulary:
    tokens: list[bytes | None]  # by id
    ids: dict[bytes, int]
    byte_ids: np.ndarray  # id of each single byte
    pairs: PairTable

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        rows: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            known = self.ids.get(piece)
            if known is not None:
                out[i] = known.to_bytes(4, "little")
            elif len(piece) > LONGEST_ROW:
                out[i] = self._merge_long(piece)
            else:
                # widths 4, 8, 12 … so that little of a row is padding
                rows.setdefault(-(-len(piece) // 4) * 4, []).append(i)
        for width, members in rows.items():
            for at in range(0, len(members), 1 << 16):
                self._merge_rows(pieces, members[at : at + (1 << 16)], width, out)
        return out

    def _merge_rows(self, pieces: list[bytes], members: list[int], width: int, out: list[bytes]):
        lengths = np.array([len(pieces[i]) for i in members])
        padded = b"".join(pieces[i].ljust(width, b"\0") for i in members)
        ids = self.byte_ids[np.frombuffer(padded, np.uint8).reshape(-1, width)]
        used = np.arange(width - 1) < (lengths - 1)[:, None]
        ranks = np.full((len(members), width - 1), NONE, np.int32)
        ranks[used] = self.pairs.look_up(ids[:, :-1][used], ids[:, 1:][used])
        members_left = np.array(members)
        while len(ids):
            at = ranks.argmin(axis=1)  # the leftmost of the lowest
            lowest = ranks[np.arange(len(ids)), at]
            done = lowest == NONE
            if done.any():
                finished = ids[done].astype("<u4")
                for i, row, n in zip(members_left[done], finished, lengths[done]):
                    out[i] = row[:n].tobytes()
                keep = ~done
                ids, ranks, lengths = ids[keep], ranks[keep], lengths[keep]
                at, lowest, members_left = at[keep], lowest[keep], members_left[keep]
                if not len(ids):
                    break
            # close the gap right of the merge; the longest row sets the new width
            row = np.arange(len(ids))
            ids[row, at] = lowest
            columns = np.arange(ids.shape[1] - 1)
            ids = np.where(columns <= at[:, None], ids[:, :-1], ids[:, 1:])
            shifted = np.where(columns[:-1] <= at[:, None], ranks[:, :-1], ranks[:, 1:])
            lengths = lengths - 1
            ranks = np.concatenate([shifted, np.full((len(ids), 1), NONE, np.int32)], axis=1)
            for left in (at - 1, at):
                fits = (left >= 0) & (left + 1 < lengths)
                ranks[row[fits], left[fits]] = self.pairs.look_up(
                    ids[row[fits], left[fits]], ids[row[fits], left[fits] + 1]
                )
            edge = (at == lengths - 1) & (at < ranks.shape[1])
            ranks[row[edge], at[edge]] = NONE
            widest = max(int(lengths.max()), 2)
            ids, ranks = ids[:, :widest], ranks[:, : widest - 1]

    def _merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        first = self.pairs.look_up(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)

        def rank(a: int, b: int) -> int | None:
            joined = self.tokens[a] + self.tokens[b]
            return self.ids.get(joined)

        while heap:
            r, i = heapq.heappop(heap)
            j = right[i]
            if ids[i] < 0 or j >= n or rank(ids[i], ids[j]) != r:
                continue
            ids[i], ids[j] = r, -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                new = rank(r, ids[k])
                if new is not None:
                    heapq.heappush(heap, (new, i))
            h = left[i]
            if h >= 0:
                new = rank(ids[h], r)
                if new is not None:
                    heapq.heappush(heap, (new, h))
        return np.array([t for t in ids if t >= 0], "<u4").tobytes()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(rank_file: bytes) -> Vocabulary:
    """Read lines of a base64 token and its rank, which is its id."""
    ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
    tokens: list[bytes | None] = [None] * (max(ids.values()) + 1)
    for token, i in ids.items():
        tokens[i] = token
    left, right, rank = [], [], []
    for token, i in ids.items():
        for at in range(1, len(token)):
            a, b = ids.get(token[:at]), ids.get(token[at:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(i)
    table = PairTable(np.array(left), np.array(right), np.array(rank, np.int32))
    return Vocabulary(tokens, ids, np.array([ids[bytes([b])] for b in range(256)], np.int32), table)


class Encoder:
    """Encodes texts; remembers the ids of pieces, up to a bound."""

    def __init__(self, words: Vocabulary, pattern: str):
        self.words = words
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        pieces = [self.split(t) for t in texts]
        new = {p for own in pieces for p in own if p not in self.known}
        if len(self.known) + len(new) > _CACHED_PIECES:
            self.known = {}
            new = {p for own in pieces for p in own}
        fresh = sorted(new)
        merged = self.words.encode_pieces([p.encode() for p in fresh])
        self.known.update(zip(fresh, merged))
        get = self.known.__getitem__
        return [b"".join(map(get, own)) for own in pieces]


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in lists of about ``_CHUNK_CHARS`` characters, so that pieces stay few in memory."""
    chunk: list[str] = []
    size = 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= _CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def encoded(
    batches: Iterator[pa.RecordBatch], rank_file: bytes, pattern: str, text: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Replace the text column of Arrow batches by ``ids``; a few batches for each that comes."""
    encoder = Encoder(vocabulary(rank_file), pattern)
    for batch in pieces(batches):
        place = batch.schema.get_field_index(text)
        rest = [i for i in range(batch.num_columns) if i != place]
        at = 0
        texts = [t or "" for t in batch.column(place).to_pylist()]
        for chunk in _chunks(texts):
            codes = encoder.encode(chunk)
            offsets = np.cumsum([0] + [len(c) // 4 for c in codes])
            values = pa.array(np.frombuffer(b"".join(codes), "<i4"))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            part = batch.slice(at, len(chunk))
            at += len(chunk)
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in rest] + [ids],
                [batch.schema.names[i] for i in rest] + ["ids"],
            )


def decoded(batches: Iterator[pa.RecordBatch], rank_file: bytes) -> Iterator[pa.RecordBatch]:
    """Add ``bytes``, what the ids of each row stand for."""
    words = vocabulary(rank_file)
    for batch in batches:
        ids = batch.column("ids")
        flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        found = [words.decode(flat[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, "bytes"]
        )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat, offsets = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        own = [flat[a:b] for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(x) for x in own], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in own], pa.string()),
                pa.array(
                    [hashlib.sha256(b.as_buffer()).hexdigest() for b in batch.column("bytes")],
                    pa.string(),
                ),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (all others by default) and ``ids``, the text's token ids.

    A null or empty text has no ids. The rank file is read by the driver and sent to the workers;
    its size is that of a vocabulary, whatever the documents. A column of ``docs`` named ``ids``
    is replaced.
    """
    file = docs.sparkSession.sparkContext.broadcast(_read(path))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (text, "ids")]
    narrow = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`"))
    schema = narrow.drop(text).schema.add("ids", _IDS)
    return narrow.mapInArrow(lambda b: encoded(b, file.value, pattern, text), schema)


def decode(encoded_docs: DataFrame, path: str) -> DataFrame:
    """Add ``bytes`` to rows with ``ids``; they equal the encoded text in UTF-8."""
    file = encoded_docs.sparkSession.sparkContext.broadcast(_read(path))
    schema = StructType([*encoded_docs.schema.fields, StructField("bytes", BinaryType())])
    return encoded_docs.mapInArrow(lambda b: decoded(b, file.value), schema)


def checked_ids(
    docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text"
) -> DataFrame:
    """The columns ``keep``, ``n_tokens``, ``ids``, and the SHA-256 of what the ids decode to."""
    file = docs.sparkSession.sparkContext.broadcast(_read(path))
    narrow = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in decoded(encoded(batches, file.value, pattern, "_text"), file.value):
            ids = batch.column("ids")
            digests = [hashlib.sha256(b.as_buffer()).hexdigest() for b in batch.column("bytes")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    ids.value_lengths().cast(pa.int64()),
                    ids,
                    pa.array(digests, pa.string()),
                ],
                [*keep, "n_tokens", "ids", "decoded_sha256"],
            )

    schema = narrow.drop("_text").schema.add("n_tokens", "long").add("ids", _IDS)
    return narrow.mapInArrow(run, schema.add("decoded_sha256", "string"))


def round_trip(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Digests of both directions per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encoding, decoding and hashing follow each other in one pass over Arrow batches.
    """
    file = docs.sparkSession.sparkContext.broadcast(_read(path))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digested(decoded(encoded(batches, file.value, pattern), file.value))

    return narrowed(docs, doc_id=id_column, text=text).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
