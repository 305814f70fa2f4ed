"""What the operators share: narrow inputs, words, stored intermediate tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import scratch_path

# Fixed values of the contracts: what counts as white space, and a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)

TOKENIZER = "byte_bpe_multi_50k.tiktoken"

FILTER_BITS = 1 << 24


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def narrowed(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator reads, under its own names, whatever else ``docs`` holds."""
    return docs.select(*(docs[old].alias(new) for new, old in columns.items()))


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores behind it if a table has such a column already."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: no recompute after a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(id_column: Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; null ids give null."""
    return F.crc32(id_column.cast("string")) % divisor


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that a worker holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def bit_filter(
    keys: DataFrame, key: str, n_keys: int, most_bits: int | None = None
) -> Callable[[np.ndarray], np.ndarray]:
    """A test whether non-negative numbers may be among ``keys``; never false for one that is.

    One bit per hash class, at least 16 classes per key, but at most ``most_bits`` bits
    (``FILTER_BITS`` by default), which bounds what the driver collects and sends out. Beyond that
    bound more numbers pass, so a join has to follow.
    """
    bits = min(most_bits or FILTER_BITS, max(1 << 10, 1 << (16 * n_keys).bit_length()))
    words = np.zeros(bits // 32, np.uint32)
    rows = (
        keys.selectExpr(
            f"cast({key} % {bits} div 32 as int) AS word",
            f"shiftleft(1L, cast({key} % {bits} % 32 as int)) AS bit",
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    found = rows.toArrow()
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)

    def among(values: np.ndarray) -> np.ndarray:
        place = values % bits
        return ((words[place >> 5] >> (place & 31).astype(np.uint32)) & 1).astype(bool)

    return among


def split_by_filter(
    rows: DataFrame, key: str, among: Callable[[np.ndarray], np.ndarray]
) -> tuple[DataFrame, DataFrame]:
    """(rows surely without a match, rows that may have one) by their non-negative ``key``."""

    def part(wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                yield batch.filter(pa.array(among(batch.column(key).to_numpy()) == wanted))

        return rows.mapInArrow(run, rows.schema)

    return part(False), part(True)


# Connected components


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), "m")
    return moved.unionByName(least).distinct().withColumnRenamed("m", "b")


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``links`` (a, b): the smallest node it reaches.

    Alternating large-star and small-star steps, each stored, until every node points at its
    smallest one. Steps shuffle the links only, and their number grows with the logarithm of the
    longest path.
    """
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    seen = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars")
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    lowest = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(lowest)
