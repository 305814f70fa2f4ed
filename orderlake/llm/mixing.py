"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of blocks of equally many words. Blocks go to sources by highest quotients
target / (2k + 1), and a source's blocks go to its shards (hash classes of documents) in the same
way, so every shard has an integer quota. Within a shard the documents stand in a seeded order,
which cuts the shard into blocks; its quota is whole passes over all blocks plus the first blocks
of that order.

Per shard only the row at the cut matters: documents before it are taken once more than those
after it. So documents find their share through a table with one row per shard, and texts are
never shuffled. One row per source and shard reaches the driver: sources are the entries of a mix,
and a source has at most ``MAX_SHARDS`` shards, which only grow in size beyond that.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import WORD, narrowed, stored, text_or_empty

MAX_SHARDS = 4096
CYCLE = (3, 1, 2)


def targets(
    sizes: Sequence[int], weights: Sequence[float], factor: float, cap: float
) -> list[float]:
    """Shares of ``factor`` times all sizes by weight; none above ``cap`` times its size.

    What a source cannot take goes to the others by weight, until none is above its limit.
    """
    found = [0.0] * len(sizes)
    free, rest = list(range(len(sizes))), factor * sum(sizes)
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if rest * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in free:
                found[i] = rest * weights[i] / total
            break
        for i in over:
            found[i] = cap * sizes[i]
        rest -= sum(found[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return found


def apportion(shares: Sequence[float], seats: int) -> list[int]:
    """Seats by highest quotients share / (2k + 1); ties go to the earlier entry.

    A divisor gives nearly all seats at once, a heap of next quotients gives the last ones.
    """
    share = np.asarray(shares, float)
    total = share.sum()
    if seats <= 0 or total <= 0:
        return [0] * len(share)
    low, high = total / (2.0 * seats + 2 * len(share)), 4 * total + 1

    def given(divisor: float) -> np.ndarray:
        return np.floor(share / divisor + 0.5).astype(np.int64)

    for _ in range(200):
        middle = (low + high) / 2
        if given(middle).sum() > seats:
            low = middle
        else:
            high = middle
        if seats - given(high).sum() <= len(share):
            break
    won = given(high)
    heap = [(-s / (2 * int(k) + 1), i) for i, (s, k) in enumerate(zip(share, won)) if s > 0]
    heapq.heapify(heap)
    for _ in range(seats - int(won.sum())):
        _, i = heap[0]
        won[i] += 1
        heapq.heapreplace(heap, (-share[i] / (2 * int(won[i]) + 1), i))
    return won.tolist()


def _sized(docs: DataFrame, seed: int, *more: str) -> DataFrame:
    """Adds the word count and the place in the seeded order; both follow from the row alone."""
    return docs.select(
        "doc_id",
        "source",
        F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("place"),
        *more,
    )


def plan(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[float] = CYCLE,
    factor: float = 1.5,
    cap: float = 2.0,
    block_words: int = 8,
    shard_words: int = 1_000_000,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized rows, sources, cuts): word counts, one row per source, one row per shard.

    Sources in code point order, null last, take ``weights`` in turn, over and over.
    """
    spark = docs.sparkSession
    rows = stored(
        _sized(narrowed(docs, doc_id=id_column, source=source, text=text), seed), "sizes"
    )
    found = {
        r.source: r.total for r in rows.groupBy("source").agg(F.sum("size").alias("total")).collect()
    }
    names = sorted((s for s in found if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in found else []
    sizes = [found[n] for n in names]
    cycle = [weights[i % len(weights)] for i in range(len(names))]
    target = targets(sizes, cycle, factor, cap)
    blocks = apportion(target, round(sum(target) / block_words))
    sources = spark.createDataFrame(
        [
            (n, i, sizes[i], target[i], min(max(1, -(-sizes[i] // shard_words)), MAX_SHARDS))
            for i, n in enumerate(names)
        ],
        "name string, source_no int, source_size long, target double, n_shards int",
    )
    sharded = with_shard(rows, sources)
    shard_sizes: dict[int, list[tuple[int, int]]] = {}
    for r in sharded.groupBy("source_no", "shard").agg(F.sum("size").alias("total")).collect():
        shard_sizes.setdefault(r.source_no, []).append((r.shard, r.total))
    quotas = []
    for number, shards in sorted(shard_sizes.items()):
        shards.sort()
        for (shard, size), won in zip(shards, apportion([s for _, s in shards], blocks[number])):
            words = min(won * block_words, int(cap * size))
            quotas.append((number, shard, *(divmod(words, size) if size else (0, 0))))
    quota = spark.createDataFrame(quotas, "source_no int, shard int, passes long, rest long")

    # Rows that share a place are copies; they share what falls on them.
    order = Window.partitionBy("source_no", "shard").orderBy("place")
    placed = (
        sharded.groupBy("source_no", "shard", "place")
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    before = F.col("upto") - F.col("size")
    at_cut = (
        placed.join(quota, ["source_no", "shard"])
        .filter((before <= F.col("rest")) & (F.col("rest") < F.col("upto")))
        .select(
            "source_no",
            "shard",
            F.col("place").alias("cut_place"),
            F.expr("(rest - (upto - size)) div n").alias("cut_words"),
        )
    )
    cuts = stored(quota.join(at_cut, ["source_no", "shard"], "left"), "cuts")
    return rows, sources, cuts


def with_shard(rows: DataFrame, sources: DataFrame) -> DataFrame:
    joined = rows.join(sources, F.col("source").eqNullSafe(F.col("name")))
    shard = F.pmod(F.xxhash64("place"), F.col("n_shards").cast("bigint")).cast("int")
    return joined.withColumn("shard", shard).drop("name")


def with_taken(rows: DataFrame, sources: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds source_size, target and the words taken to sized rows."""
    more: Column = (
        F.when(F.col("place") < F.col("cut_place"), F.col("size"))
        .when(F.col("place") == F.col("cut_place"), F.col("cut_words"))
        .otherwise(0)
    )
    taken = F.col("passes") * F.col("size") + F.coalesce(more, F.lit(0))
    shared = with_shard(rows, sources).join(cuts, ["source_no", "shard"])
    return shared.withColumn("taken", taken.cast("bigint")).drop(*cuts.columns, "n_shards")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (see ``plan``).

    A null text has size 0, a null source is a source of its own and the last one. Repeated rows
    stay and share a cut that falls on them. No rows give no rows; other columns are ignored.
    """
    rows, sources, cuts = plan(docs, **options)
    return with_taken(rows, sources, cuts).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A document stands once for each whole time it is taken, and once more cut after the words of
    the part taken; ``n_chars``, if present, is that of the new text. What is not taken goes.
    """
    columns = docs.columns
    seed = options.get("seed", 7)
    names = {k: options.get(o, k) for k, o in (("doc_id", "id_column"), ("source", "source"))}
    text = options.get("text", "text")
    _, sources, cuts = plan(docs, **options)
    kept = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("kept")
    whole = docs.select(
        F.col(names["doc_id"]).alias("doc_id"),
        F.col(names["source"]).alias("source"),
        F.col(text).alias("text"),
        kept,
    )
    taken = with_taken(_sized(whole, seed, "kept"), sources, cuts).filter("taken > 0")
    times = F.transform(
        F.sequence(F.lit(0), F.expr("cast((taken - 1) div size as int)")),
        lambda i: F.least(F.col("size"), F.col("taken") - i * F.col("size")),
    )
    rows = taken.select("kept", "size", F.explode(times).alias("words"))
    cut = F.when(F.col("words") == F.col("size"), F.col(f"kept.{text}")).otherwise(
        _first_words(F.col(f"kept.{text}"), F.col("words"))
    )
    rows = rows.withColumn("cut", cut)
    out = []
    for c in columns:
        if c == text:
            out.append(F.col("cut").alias(c))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            out.append(F.length("cut").cast(kind).alias(c))
        else:
            out.append(F.col(f"kept.`{c}`").alias(c))
    return rows.select(*out)


def _first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words, joined by spaces."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, n), " ")
