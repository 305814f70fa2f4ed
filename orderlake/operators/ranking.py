"""Ranks and quantile buckets over groups of any size.

A plain window sorts each group in one task, and a window without partitions sorts the whole
table in one task. Here one range-partitioned sort spreads every group over all tasks; a row's
rank is its place within its slice plus the number of rows of its group in earlier slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.session import checkpointed

_SLICE_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_rank(
    df: DataFrame,
    order_by: Sequence[Column],
    partition_by: Sequence[str] = (),
    rank: str = "rank",
    group_size: str | None = None,
) -> DataFrame:
    """Add ``row_number()`` over the given groups and order, and optionally the group's size.

    ``order_by`` must be a total order. The sorted rows are checkpointed: the slices come from
    sampled bounds, so the counts and the rows must be read from the same sort.
    """
    keys = list(partition_by)
    placed = checkpointed(
        df.sort(*keys, *order_by).withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_place", _SLICE_BITS))

    # One row per slice and group. Without groups that is one row per sort task.
    slices = placed.groupBy("_slice", *keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        F.col("_slice").alias("_o_slice"),
        *(F.col(k).alias(f"_o_{k}") for k in keys),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_n").over(group).alias("_size"),
    )
    same_group = F.col("_slice") == F.col("_o_slice")
    for k in keys:
        same_group &= F.col(k).eqNullSafe(F.col(f"_o_{k}"))

    # Broadcast only the ungrouped offsets, whose size is the number of sort tasks; with groups
    # adaptive execution decides by the measured size.
    ranked = placed.join(offsets if keys else F.broadcast(offsets), same_group)
    extra = [F.col("_size").alias(group_size)] if group_size else []
    return ranked.select(*df.columns, (F.col("_place") + F.col("_shift")).alias(rank), *extra)


def ntile_of(rank: str, size: str, buckets: int) -> Column:
    """The ``ntile(buckets)`` of a row with 1-based ``rank`` among ``size`` rows.

    The first ``size mod buckets`` buckets hold one row more than the others.
    """
    wide = f"({size} div {buckets} + 1)"
    in_wide = f"({size} % {buckets}) * {wide}"
    narrow = f"greatest({size} div {buckets}, 1)"
    return F.expr(
        f"cast(case when {rank} <= {in_wide} then ({rank} - 1) div {wide} + 1 "
        f"else {size} % {buckets} + ({rank} - 1 - {in_wide}) div {narrow} + 1 end as int)"
    )


def with_ntile(
    df: DataFrame, order_by: Sequence[Column], buckets: int, name: str = "bucket"
) -> DataFrame:
    """Add ``ntile(buckets)`` over the whole table."""
    ranked = with_rank(df, order_by, rank="_rank", group_size="_total")
    return ranked.withColumn(name, ntile_of("_rank", "_total", buckets)).drop("_rank", "_total")
