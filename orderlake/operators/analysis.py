"""Questions about segments: how many customers, what they spend, who is on top, and where."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions.money import exact_sum, mean, to_double
from orderlake.operators.ranking import with_rank
from orderlake.schemas import require_columns

MEASURES = ("n_transactions", "total_spend", "avg_spend", "n_distinct_products")


def segment_counts(segments: DataFrame, by: str = "segment") -> DataFrame:
    """Customers per segment."""
    return segments.groupBy(by).agg(F.count(F.lit(1)).alias("n_customers")).orderBy(by)


def _mean(measure: str) -> Column:
    return mean(exact_sum(measure), F.count(measure)).alias(f"avg_{measure}")


def segment_averages(
    segments: DataFrame, by: str = "segment", measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Mean of each measure per segment."""
    require_columns(segments, [by, *measures], "segments")
    return segments.groupBy(by).agg(*(_mean(m) for m in measures)).orderBy(by)


def segment_profile(
    segments: DataFrame,
    by: str = "segment",
    features: Sequence[str] = MEASURES,
    customer_id: str = "customer_id",
) -> DataFrame:
    """Distinct customers and mean features per segment; features that are absent are left out."""
    means = [_mean(f) for f in features if f in segments.columns]
    n_customers = F.count_distinct(customer_id).alias("n_customers")
    return segments.groupBy(by).agg(n_customers, *means).orderBy(by)


def top_customers(
    segments: DataFrame, segment: int = 0, n: int = 5, by: str = "segment"
) -> DataFrame:
    """The ``n`` customers of one segment that spend most."""
    return (
        segments.filter(F.col(by) == segment)
        .select("customer_id", "total_spend", by)
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(n)
    )


def top_customers_per_segment(segments: DataFrame, n: int = 5, by: str = "segment") -> DataFrame:
    """The ``n`` customers of every segment that spend most, with their place.

    For an ``n`` that Spark limits by group (``WindowGroupLimit``) each map task keeps only its own
    first ``n`` per segment. A larger ``n`` would sort whole segments in one task each, so all
    customers are ranked by one range-partitioned sort instead.
    """
    rows = segments.select("customer_id", "total_spend", by)
    order = [F.desc("total_spend"), F.asc("customer_id")]
    limit = segments.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if n <= int(limit):
        place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
        ranked = rows.withColumn("place", place)
    else:
        ranked = with_rank(rows, order, partition_by=[by], rank="place")
        ranked = ranked.withColumn("place", F.col("place").cast("int"))
    return ranked.filter(F.col("place") <= n)


def spend_by_province(gold_segments: DataFrame, by: str = "segment") -> DataFrame:
    """Payments per province and segment."""
    return gold_segments.groupBy("province", by).agg(
        to_double(exact_sum("total_payment")).alias("total_purchases")
    )


def spend_chart(
    gold_segments: DataFrame, segments: Sequence[int], by: str = "segment"
) -> DataFrame:
    """Payments per province with a column for each of the given segments, 0 where there are none.

    The segments are passed in, so the columns do not depend on the data and Spark need not look for
    them first; rows of other segments are left out before the shuffle.
    """
    wanted = gold_segments.filter(F.col(by).isin(*segments))
    totals = (
        wanted.groupBy("province")
        .pivot(by, list(segments))
        .agg(exact_sum("total_payment").alias("total"))
    )
    return totals.select(
        "province",
        *(
            F.coalesce(to_double(F.col(f"`{s}`")), F.lit(0.0)).alias(f"segment_{s}")
            for s in segments
        ),
    )
