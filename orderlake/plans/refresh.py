"""Refresh at the pace of the schedule: only the periods that changed are made anew.

Orders, items and partial results are stored by period (a day or a month). A batch holds all orders
of the periods it names; it replaces these, their partial results are computed from their files
alone, and the gold tables are merged from partial results and published as new versions. Partial
results have a row per customer or product and period, so history's items are never read again.

Periods are noted before they are replaced and struck off when their partial results are complete.
A run that dies leaves the note, and the next one makes those periods anew as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators import partials
from orderlake.operators.metrics import (
    city_metrics,
    order_totals,
    province_metrics,
    with_customer_details,
    with_product_details,
    with_tiers,
)
from orderlake.plans.etl import publish
from orderlake.session import stored
from orderlake.sources.catalog import create_database, create_external_table
from orderlake.sources.lake import (
    Lake,
    clear_pending,
    note_pending,
    pending,
    replace_partitions,
)

PARTIALS = (
    schemas.PERIOD_TRANSACTIONS,
    schemas.CUSTOMER_PARTIALS,
    schemas.CUSTOMER_PRODUCTS,
    schemas.PRODUCT_PARTIALS,
)


def _notes(lake: Lake) -> str:
    return lake.folder("state", "pending_periods")


def _store(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    df: DataFrame,
    table: schemas.Table,
    periods: Sequence[str | None],
) -> None:
    """Replace the given periods of a table.

    Rows of a period meet in few files; adaptive execution splits a large period over several tasks.
    """
    path = lake.folder(layer, table.name)
    replace_partitions(spark, df.hint("rebalance", "period"), path, table, "period", periods)


def _of(df: DataFrame, periods: Sequence[str | None]) -> DataFrame:
    """The rows of some periods; the condition names partitions, so no other file is read."""
    known = [p for p in periods if p is not None]
    wanted = F.col("period").isin(known)
    if None in periods:
        wanted = F.coalesce(wanted, F.lit(False)) | F.col("period").isNull()
    return df.filter(wanted)


def store_periods(
    spark: SparkSession,
    lake: Lake,
    transactions: DataFrame,
    order_items: DataFrame,
    grain: str = "day",
) -> list[str | None]:
    """Replace the periods that ``transactions`` has orders in; returns them.

    A batch has all orders of its periods and their items; an order that moves from one period to
    another needs both in the batch. Items without an order in the batch are those of no period, which
    a batch replaces as well if it has such items. The list of periods is as long as there are days.
    """
    orders = partials.orders_by_period(transactions, grain)
    # read twice below; where they come from may be costly
    items = stored(partials.items_by_period(order_items, orders), "items_by_period")
    periods = [r.period for r in orders.select("period").distinct().collect()]
    if None not in periods and not items.filter("period IS NULL").isEmpty():
        periods.append(None)
    note_pending(spark, _notes(lake), periods)
    _store(spark, lake, "silver", orders, schemas.PERIOD_ORDERS, periods)
    _store(spark, lake, "silver", items, schemas.PERIOD_ITEMS, periods)
    return periods


def read_periods(
    spark: SparkSession, lake: Lake, periods: Sequence[str | None] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The stored orders and items of some periods, or of all."""
    found = (
        spark.read.schema(t.ddl).parquet(lake.folder("silver", t.name))
        for t in (schemas.PERIOD_ORDERS, schemas.PERIOD_ITEMS)
    )
    orders, items = found
    return (orders, items) if periods is None else (_of(orders, periods), _of(items, periods))


def refresh_partials(spark: SparkSession, lake: Lake, periods: Sequence[str | None]) -> None:
    """Compute the partial results of some periods from their files and replace the stored ones."""
    orders, items = read_periods(spark, lake, periods)
    # summed once for both tables that start from them
    totals = stored(order_totals(items), "period_totals")
    made = (
        partials.period_transactions(orders, items, totals),
        partials.customer_partials(orders, items, totals),
        partials.customer_products(orders, items),
        partials.product_partials(items),
    )
    for table, df in zip(PARTIALS, made):
        _store(spark, lake, "gold", df, table, periods)
    clear_pending(spark, _notes(lake), periods)


def read_partials(spark: SparkSession, lake: Lake, table: schemas.Table) -> DataFrame:
    return spark.read.schema(table.ddl).parquet(lake.folder("gold", table.name))


def declare_periods(spark: SparkSession, lake: Lake) -> None:
    """The tables by period in the catalog, with the partitions their folders show."""
    for layer, tables in (
        ("silver", (schemas.PERIOD_ORDERS, schemas.PERIOD_ITEMS)),
        ("gold", PARTIALS),
    ):
        for table in tables:
            create_external_table(
                spark, lake.database, table, lake.folder(layer, table.name), ["period"]
            )


def publish_merged(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The gold tables merged from the partial results of all periods."""
    customers = lake.read(spark, "silver", schemas.CUSTOMERS, extras=True)
    products = lake.read(spark, "silver", schemas.PRODUCTS, extras=True)

    def gold(df: DataFrame, table: schemas.Table) -> DataFrame:
        return publish(spark, lake, "gold", df, table.extended(df.columns))

    totals = partials.merged_customers(
        read_partials(spark, lake, schemas.CUSTOMER_PARTIALS),
        read_partials(spark, lake, schemas.CUSTOMER_PRODUCTS),
    )
    by_customer = gold(
        with_tiers(with_customer_details(totals, customers)), schemas.CUSTOMER_METRICS
    )
    orders, _ = read_periods(spark, lake)
    # few rows, by which a query picks periods: Spark then reads only their folders
    gold(partials.calendar(orders.select("period", "purchased_at")), schemas.CALENDAR)
    by_product = partials.merged_products(read_partials(spark, lake, schemas.PRODUCT_PARTIALS))
    return {
        "customer_metrics": by_customer,
        "product_metrics": gold(
            with_product_details(by_product, products), schemas.PRODUCT_METRICS
        ),
        "province_metrics": gold(
            province_metrics(by_customer, customers), schemas.PROVINCE_METRICS
        ),
        "city_metrics": gold(city_metrics(by_customer, customers), schemas.CITY_METRICS),
    }


def refresh(
    spark: SparkSession,
    lake: Lake,
    transactions: DataFrame,
    order_items: DataFrame,
    grain: str = "day",
) -> dict[str, DataFrame]:
    """Take a batch of whole periods in and publish the gold tables that follow.

    Besides the batch's periods, those that an earlier run began and did not end are made anew. The
    dimensions come from the silver layer as it stands.
    """
    create_database(spark, lake.database, lake.database_location)
    store_periods(spark, lake, transactions, order_items, grain)
    # the batch's own periods are noted too
    refresh_partials(spark, lake, pending(spark, _notes(lake)))
    declare_periods(spark, lake)
    return publish_merged(spark, lake)
