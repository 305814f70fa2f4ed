"""The standard questions about stored segments, each as a named frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake import schemas
from orderlake.operators.analysis import (
    segment_averages,
    segment_counts,
    spend_by_province,
    top_customers,
    top_customers_per_segment,
)
from orderlake.operators.gates import require_ready
from orderlake.sources.lake import Lake


def segment_report(spark: SparkSession, lake: Lake, top: int = 5) -> dict[str, DataFrame]:
    """Counts, averages, top customers and spend by province; raises if the table is not ready."""
    segments = require_ready(
        lake.read(spark, "gold", schemas.CUSTOMER_SEGMENTS), schemas.CUSTOMER_SEGMENTS
    )
    gold = lake.read(spark, "gold", schemas.GOLD_SEGMENTS)
    return {
        "segment_counts": segment_counts(segments),
        "segment_averages": segment_averages(segments),
        "top_customers": top_customers(segments, 0, top),
        "top_customers_per_segment": top_customers_per_segment(segments, top),
        "spend_by_province": spend_by_province(gold),
    }
