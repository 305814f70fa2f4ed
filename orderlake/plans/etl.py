"""Bronze to silver and silver to gold over all data.

State passes between the steps only through the files of a layer, so each can run by itself. Every
table is written as a new version and switched when it is complete (``sources.lake``), so readers
and a run that dies leave the last complete version in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from orderlake import schemas
from orderlake.operators.clean import CLEANERS, LoadCounts
from orderlake.operators.completed import completed_orders
from orderlake.operators.gates import require_ready
from orderlake.operators.metrics import (
    city_metrics,
    customer_metrics,
    order_totals,
    product_metrics,
    province_metrics,
    transaction_metrics,
)
from orderlake.operators.quarantine import cleaned_and_rejected
from orderlake.plans.storage import store_by_order
from orderlake.sources.bronze import read_bronze
from orderlake.sources.catalog import (
    create_database,
    create_external_table,
    create_source_view,
    flat_orders_sql,
    register_views,
)
from orderlake.sources.lake import Lake, clean_versions, publish_files


def bronze_to_silver(
    spark: SparkSession, lake: Lake, multi_line: bool = False, quarantine: bool = False
) -> DataFrame:
    """Clean the six raw CSV tables into Parquet tables; all their columns stay.

    Returns what was wrong with them, counted while they were written and stored as the silver
    table ``load_counts``. Broken records are loaded as far as they go. With ``quarantine`` the rows
    with something wrong and the copies that were dropped are stored as well, as the silver table of
    that name; raw tables are still read once, but a copy of them is written in between.
    """
    raw = {
        name: read_bronze(spark, lake.path("bronze", name), table, multi_line)
        for name, table in schemas.BRONZE.items()
    }
    require_ready(raw["transactions"], schemas.TRANSACTIONS)
    counts, rejected = [], []
    for name, table in schemas.BRONZE.items():
        watched = LoadCounts(table)
        seen = watched.watch(raw[name])
        if quarantine:
            cleaned, gone = cleaned_and_rejected(seen, table, CLEANERS[name])
            rejected.append(gone)
        else:
            cleaned = CLEANERS[name](seen)
        publish_silver(spark, lake, cleaned, table.extended(cleaned.columns))
        counts += watched.rows()
    if rejected:
        publish_silver(spark, lake, reduce(DataFrame.unionByName, rejected), schemas.QUARANTINE)
    found = spark.createDataFrame(counts, schemas.LOAD_COUNTS.ddl)
    publish_silver(spark, lake, found, schemas.LOAD_COUNTS)
    return lake.read(spark, "silver", schemas.LOAD_COUNTS)


def read_silver(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The silver tables; customers and products with all their columns, which go on to gold."""
    return {
        name: lake.read(spark, "silver", table, extras=name in ("customers", "products"))
        for name, table in schemas.BRONZE.items()
    }


def publish(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    df: DataFrame,
    table: schemas.Table,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write the next version of a table and switch readers to it; returns it re-read.

    Paths switch with the version's marker, the catalog with the table's location. Versions before
    the last two are deleted afterwards.
    """
    folder = lake.folder(layer, table.name)
    path = publish_files(spark, df, folder, table, partition_by=partition_by)
    create_external_table(spark, lake.database, table, path, partition_by)
    clean_versions(spark, folder)
    return spark.read.schema(table.ddl).parquet(path)


def publish_silver(spark: SparkSession, lake: Lake, df: DataFrame, table: schemas.Table) -> None:
    """The same for a silver table, whose catalog entry is switched only if there is one.

    Lasting views over silver tables go through these entries and so never name deleted files.
    """
    folder = lake.folder("silver", table.name)
    path = publish_files(spark, df, folder, table)
    if spark.catalog.databaseExists(lake.database) and spark.catalog.tableExists(
        f"{lake.database}.{table.name}"
    ):
        create_external_table(spark, lake.database, table, path)
    clean_versions(spark, folder)


def silver_to_gold(
    spark: SparkSession,
    lake: Lake,
    completed_status: str = schemas.COMPLETED_STATUS,
    by_order: bool = False,
) -> dict[str, DataFrame]:
    """Compute, store and publish the metric tables and the completed-order table.

    With ``by_order`` orders and items are first stored in buckets by order, a shuffle of each, and
    no step after that shuffles items by order again.

    What several tables need is computed once and stored: sums per order, from which transaction,
    customer and segment measures follow, and customer metrics, from which regions follow.
    """
    silver = read_silver(spark, lake)
    require_ready(silver["transactions"], schemas.TRANSACTIONS)
    transactions, items = silver["transactions"], silver["order_items"]
    customers, products = silver["customers"], silver["products"]
    create_database(spark, lake.database, lake.database_location)
    if by_order:
        transactions, items = store_by_order(spark, lake, transactions, items)

    publish_silver(spark, lake, order_totals(items), schemas.ORDER_TOTALS)
    totals = lake.read(spark, "silver", schemas.ORDER_TOTALS)
    completed = completed_orders(transactions, items, customers, products, completed_status)
    publish(spark, lake, "silver", completed, schemas.COMPLETED_ORDERS)

    def gold(df: DataFrame, table: schemas.Table) -> DataFrame:
        return publish(spark, lake, "gold", df, table.extended(df.columns))

    by_customer = gold(
        customer_metrics(transactions, items, totals, customers), schemas.CUSTOMER_METRICS
    )
    tables = {
        "transaction_metrics": gold(
            transaction_metrics(transactions, totals), schemas.TRANSACTION_METRICS
        ),
        "customer_metrics": by_customer,
        "product_metrics": gold(product_metrics(items, products), schemas.PRODUCT_METRICS),
        "province_metrics": gold(
            province_metrics(by_customer, customers), schemas.PROVINCE_METRICS
        ),
        "city_metrics": gold(city_metrics(by_customer, customers), schemas.CITY_METRICS),
    }
    register_views(tables)
    names = {}
    for name, table in schemas.BRONZE.items():
        stored = table.extended(spark.read.parquet(lake.path("silver", name)).columns)
        names[name] = create_external_table(
            spark, lake.database, stored, lake.path("silver", name)
        )
    view = schemas.SOURCE_VIEWS["flat_orders"]
    create_source_view(spark, lake.database, view, flat_orders_sql(names), schemas.FLAT_ORDERS)
    return tables
