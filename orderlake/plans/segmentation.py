"""From stored customer metrics to stored segments and models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderlake import schemas
from orderlake.operators.analysis import segment_profile
from orderlake.operators.completed import completed_by_customer, gold_segments
from orderlake.operators.gates import require_ready
from orderlake.operators.segments import (
    SegmentModel,
    Trial,
    fit_segments,
    prepare_features,
)
from orderlake.plans.etl import publish, read_silver
from orderlake.sources.catalog import create_database, create_source_view, register_views
from orderlake.sources.lake import (
    Lake,
    clean_versions,
    commit_version,
    next_version,
    version_path,
)


@dataclass(frozen=True)
class Segmentation:
    segments: DataFrame
    profile: DataFrame
    gold_segments: DataFrame
    model: SegmentModel
    trials: list[Trial]


def publish_segment_view(spark: SparkSession, lake: Lake) -> str:
    """The stored segment table under the names existing reports use."""
    table = schemas.GOLD_SEGMENTS
    view = schemas.SOURCE_VIEWS[table.name]
    return create_source_view(spark, lake.database, view, f"{lake.database}.{table.name}", table)


def store_models(
    spark: SparkSession, lake: Lake, model: SegmentModel, partitions: int
) -> None:
    """The artefacts of a model and its layout as one version, which becomes current at once."""
    version = next_version(spark, lake.models_folder)
    path = version_path(lake.models_folder, version)
    model.save(path)
    layout = spark.createDataFrame([(partitions,)], "partitions int")
    layout.write.mode("overwrite").parquet(f"{path}/layout")
    commit_version(spark, lake.models_folder, version)
    clean_versions(spark, lake.models_folder)


def run_segmentation(
    spark: SparkSession,
    lake: Lake,
    max_k: int = 8,
    completed_status: str = schemas.COMPLETED_STATUS,
    parallelism: int = 8,
    partitions: int | None = None,
) -> Segmentation:
    """Prepare features, choose k, assign segments, and store segments, gold table and models.

    The number of partitions on which the start of K-Means depends is stored in ``models/layout``;
    pass it as ``partitions`` to start from the same layout again.
    """
    customers = lake.read(spark, "gold", schemas.CUSTOMER_METRICS)
    require_ready(customers, schemas.CUSTOMER_METRICS)
    create_database(spark, lake.database, lake.database_location)
    prepared, preprocessing = prepare_features(customers, partitions=partitions)
    partitions = prepared.rdd.getNumPartitions()
    try:
        model, trials = fit_segments(prepared, preprocessing, max_k, parallelism=parallelism)
        segments = publish(
            spark, lake, "gold", model.assign(prepared), schemas.CUSTOMER_SEGMENTS
        )
    finally:
        prepared.unpersist()
    store_models(spark, lake, model, partitions)

    silver = read_silver(spark, lake)
    totals = lake.read(spark, "silver", schemas.ORDER_TOTALS)
    measures = completed_by_customer(
        silver["transactions"], totals, silver["customers"], completed_status
    )
    gold = publish(
        spark, lake, "gold", gold_segments(segments, measures), schemas.GOLD_SEGMENTS
    )
    register_views({"customer_segments": segments, "gold_segments": gold})
    publish_segment_view(spark, lake)
    return Segmentation(segments, segment_profile(segments), gold, model, trials)
