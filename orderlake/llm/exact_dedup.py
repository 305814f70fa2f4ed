"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Fingerprints (60 bits of the SHA-256 of the normalised text) are dealt into blocks. Each block
sends every owner of a fingerprint range its sorted fingerprints, Golomb-Rice coded; the owner
answers each block with a bitmap of those it has seen more than once. Only texts with such a
suspect fingerprint are then shuffled and compared byte by byte.

Blocks and ranges hold a fixed number of fingerprints whatever the input, so a task's memory is
bounded: equal fingerprints beyond two per block and range add nothing to an answer and are sent
as one run.

Texts are found again by their fingerprint. A bit filter of bounded size (``common.FILTER_BITS``) keeps
nearly all other texts out of that shuffle; beyond its bound it lets more of them through, and the
join that follows removes them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import SPACE, bit_filter, narrowed, split_by_filter, stored, text_or_empty

KEY_BITS = 60


# Golomb-Rice codes of sorted numbers. The unary quotients and the remainders are two streams, so
# that both can be read with array operations.


def encode(sorted_values: np.ndarray) -> bytes:
    """Code sorted non-negative 63-bit integers, repeats allowed."""
    n = len(sorted_values)
    if n == 0:
        return b""
    gaps = np.diff(sorted_values, prepend=0).astype(np.uint64)
    k = max(int(sorted_values[-1]) // n, 1).bit_length() - 1
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(ends[-1], np.uint8)
    unary[ends - 1] = 1
    shifts = np.arange(k, dtype=np.uint64)
    low = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    head = np.array([n, k, len(unary)], np.int64).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(low.ravel()).tobytes()


def decode(code: bytes) -> np.ndarray:
    if not code:
        return np.zeros(0, np.int64)
    n, k, n_unary = np.frombuffer(code, np.int64, 3)
    split = 24 + (int(n_unary) + 7) // 8
    unary = np.unpackbits(np.frombuffer(code[24:split], np.uint8), count=int(n_unary))
    quotients = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    gaps = quotients.astype(np.int64) << int(k)
    if k:
        bits = np.unpackbits(np.frombuffer(code[split:], np.uint8), count=int(n * k))
        gaps += bits.reshape(int(n), int(k)).astype(np.int64) @ (1 << np.arange(k, dtype=np.int64))
    return np.cumsum(gaps)


# The exchange


def _fingerprints(
    docs: DataFrame, id_column: str, text: str, key_bits: int, *more: str
) -> DataFrame:
    """(doc_id, text, sha, key) with the normalised text, and the columns ``more``."""
    normal = F.regexp_replace(text_or_empty("text"), SPACE, " ")
    narrow = narrowed(docs, doc_id=id_column, text=text, **{c: c for c in more})
    hashed = narrow.select("doc_id", normal.alias("text"), *more)
    hashed = hashed.withColumn("sha", F.sha2("text", 256))
    number = F.conv(F.substring("sha", 1, KEY_BITS // 4), 16, 10).cast("bigint")
    return hashed.withColumn("key", F.shiftright(number, KEY_BITS - key_bits))


def _send(key_bits: int, owner_bits: int):
    """A block's distinct fingerprints per owner, and which of them it holds more than once."""

    def send(block: pd.DataFrame) -> pd.DataFrame:
        keys, counts = np.unique(block["key"].to_numpy(), return_counts=True)
        owners = keys >> (key_bits - owner_bits)
        starts = np.flatnonzero(np.diff(owners, prepend=-1))
        rows = [
            (
                int(block["block"].iloc[0]),
                int(owners[a]),
                encode(keys[a:b]),
                np.packbits(counts[a:b] > 1).tobytes(),
            )
            for a, b in zip(starts, [*starts[1:], len(keys)])
        ]
        return pd.DataFrame(rows, columns=["block", "owner", "codes", "repeated"])

    return send


def _answer(messages: pd.DataFrame) -> pd.DataFrame:
    """For each message the bitmap of fingerprints that occur more than once anywhere."""
    parts = [decode(c) for c in messages["codes"]]
    flags = [
        np.unpackbits(np.frombuffer(r, np.uint8), count=len(p))
        for r, p in zip(messages["repeated"], parts)
    ]
    values, place = np.unique(np.concatenate(parts), return_inverse=True)
    seen = np.bincount(place, weights=1 + np.concatenate(flags), minlength=len(values)) > 1
    hits = np.split(seen[place], np.cumsum([len(p) for p in parts])[:-1])
    return pd.DataFrame(
        {
            "block": messages["block"],
            "owner": messages["owner"],
            "bitmap": [np.packbits(h).tobytes() for h in hits],
        }
    )


def _mark(key_bits: int, owner_bits: int):
    """A block's rows with the answers: is the row's fingerprint a suspect?"""

    def mark(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(rows["key"].to_numpy())
        owners = keys >> (key_bits - owner_bits)
        suspect = np.zeros(len(keys), bool)
        for owner, bitmap in zip(answers["owner"], answers["bitmap"]):
            a, b = np.searchsorted(owners, [owner, owner + 1])
            suspect[a:b] = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=b - a)
        out = rows[["row", "doc_id", "sha", "key"]].copy()
        out["suspect"] = suspect[np.searchsorted(keys, rows["key"].to_numpy())]
        return out

    return mark


def exchange(
    fingerprints: DataFrame, key_bits: int, rows_per_block: int, n_rows: int
) -> DataFrame:
    """(row, doc_id, sha, key, suspect) for stored fingerprints.

    A block is a hash class of row numbers; repeats of one key spread over blocks evenly.
    """
    wanted = max(1, -(-n_rows // rows_per_block))
    owner_bits = min(max(6, wanted.bit_length()), key_bits)
    n_blocks = max(16, wanted)
    dealt = fingerprints.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
    messages = (
        dealt.select("block", "key")
        .groupBy("block")
        .applyInPandas(
            _send(key_bits, owner_bits), "block long, owner long, codes binary, repeated binary"
        )
    )
    answers = messages.groupBy("owner").applyInPandas(
        _answer, "block long, owner long, bitmap binary"
    )
    kind = fingerprints.schema["doc_id"].dataType.simpleString()
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(
            _mark(key_bits, owner_bits),
            f"row long, doc_id {kind}, sha string, key long, suspect boolean",
        )
    )


# Byte verification


def suspect_texts(texts: DataFrame, suspects: DataFrame, n_suspects: int) -> DataFrame:
    """Rows of ``texts`` whose key is among the distinct keys of ``suspects``."""
    among = bit_filter(suspects, "key", n_suspects)
    likely = split_by_filter(texts.select("doc_id", "text", "sha", "key"), "key", among)[1]
    return likely.join(suspects, "key", "left_semi")


def _classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per class the row that stays (smallest id, nulls last, then row number) and its size."""
    return rows.groupBy(*keys).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("group_size"),
    )


def _with_class(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(_classes(rows, keys), keys).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _marked(texts: DataFrame, key_bits: int, rows_per_block: int) -> DataFrame:
    """(row, doc_id, sha, key, suspect), stored, after the exchange."""
    fingerprints = stored(
        texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "sha", "key"),
        "fingerprints",
    )
    n_rows = fingerprints.count()
    return stored(exchange(fingerprints, key_bits, rows_per_block, n_rows), "marked")


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    key_bits: int = KEY_BITS,
    rows_per_block: int = 2_000_000,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space became one space; a null text
    counts as empty. Of equal texts the smallest id stays, null ids last; among repeated rows
    with that id exactly one is kept. An empty table gives an empty table. Other columns of
    ``docs`` are ignored.
    """
    texts = _fingerprints(docs, id_column, text, key_bits)
    marked = _marked(texts, key_bits, rows_per_block)
    single = marked.filter(~F.col("suspect")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    suspect_rows = marked.filter("suspect").drop("suspect")
    keys = stored(suspect_rows.select("key").distinct(), "suspect_keys")
    verified = stored(
        suspect_texts(texts, keys, keys.count())
        .groupBy("key", "text")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_texts")),
        "verified",
    )
    # A fingerprint with one text: its rows are copies. With more: told apart by their texts.
    one = suspect_rows.join(verified.filter("n_texts = 1"), "key", "left_semi")
    several = verified.filter("n_texts > 1").select("key")
    result = single.unionByName(_with_class(one, ["key"]))
    n_several = several.count()
    if n_several:
        rows = suspect_texts(texts, several, n_several)
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "colliding")
        result = result.unionByName(_with_class(rows, ["key", "text"]))
    return result


def deduplicated(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    *,
    key_bits: int = KEY_BITS,
    rows_per_block: int = 2_000_000,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one for each different text.

    The row that stays is that of ``exact_duplicates``. Only texts with a suspect fingerprint are
    shuffled.
    """
    texts = _fingerprints(docs, id_column, text, key_bits)
    marked = _marked(texts, key_bits, rows_per_block)
    keys = stored(marked.filter("suspect").select("key").distinct(), "suspect_keys")
    among = bit_filter(keys, "key", keys.count())
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"),
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
    )
    hashed = _fingerprints(whole, "doc_id", "text", key_bits, "whole")
    clear = split_by_filter(hashed.select("whole", "key"), "key", among)[0]
    likely = split_by_filter(hashed.select("whole", "key", "doc_id", "text"), "key", among)[1]
    unmatched = likely.join(keys, "key", "left_anti")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("whole"))
    chosen = (
        likely.join(keys, "key", "left_semi")
        .groupBy("key", "text")
        .agg(F.min_by("whole", order).alias("whole"))
    )
    parts = [part.select("whole.*") for part in (clear, unmatched, chosen)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
