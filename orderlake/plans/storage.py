"""Orders and items stored by order, so that joining and summing them needs no shuffle.

Both tables are divided into the same number of buckets by the hash of the order and sorted within a
bucket. Spark then joins bucket with bucket, and sums per order, where the files lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlake import schemas
from orderlake.session import input_bytes
from orderlake.sources.catalog import create_database, switch_table
from orderlake.sources.lake import (
    Lake,
    clean_versions,
    commit_version,
    next_version,
    version_path,
)

BUCKET_BYTES = 256 << 20


def bucket_count(spark: SparkSession, lake: Lake, least: int = 8) -> int:
    """Buckets of about 256 MB for the silver items as they are stored; a power of two.

    Powers of two let tables of different counts still be joined bucket by bucket.
    """
    size = input_bytes(spark, lake.path("silver", "order_items"))
    return max(least, 1 << (-(-size // BUCKET_BYTES) - 1).bit_length())


def store_bucketed(
    spark: SparkSession, lake: Lake, df: DataFrame, table: schemas.Table, key: str, buckets: int
) -> DataFrame:
    """Write ``df`` as the next version of a bucketed table and switch the catalog to it.

    Buckets are a property of the catalog entry, so the result is read through it. One task writes
    one bucket; a key with very many rows makes its bucket that much larger, which silver tables
    bound by their own keys (an order has at most one row per product).
    """
    folder = lake.folder("silver", table.name)
    version = next_version(spark, folder)
    path = version_path(folder, version)
    name = f"{lake.database}.{table.name}"
    made = f"{name}_{version.replace('-', '_')}"
    (
        schemas.conform(df, table)
        .repartition(buckets, key)
        .write.format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(made)
    )
    # the files stay
    spark.sql(f"DROP TABLE {made}")
    commit_version(spark, folder, version)
    switch_table(
        spark,
        name,
        table,
        path,
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS",
    )
    clean_versions(spark, folder)
    return spark.table(name)


def store_by_order(
    spark: SparkSession,
    lake: Lake,
    transactions: DataFrame,
    order_items: DataFrame,
    buckets: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Transactions and items by order; later runs that keep ``buckets`` join with them as well."""
    create_database(spark, lake.database, lake.database_location)
    buckets = buckets or bucket_count(spark, lake)
    return (
        store_bucketed(
            spark, lake, transactions, schemas.TRANSACTIONS_BY_ORDER, "order_id", buckets
        ),
        store_bucketed(spark, lake, order_items, schemas.ITEMS_BY_ORDER, "order_id", buckets),
    )
