"""Metrics that can be added up: partial results per period, and their merge.

A partial result holds what is needed to go on counting (sums as totals, counts, distinct pairs),
never a mean or a rank. When the orders of a period change, only that period's partial results are
made anew; the merge gives what the operators in ``metrics`` give over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.money import exact_sum, mean, sum_of, to_double
from orderlake.operators.metrics import customer_measures, order_totals, transaction_metrics

# How a period is written.
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


def period_of(time: Column, grain: str) -> Column:
    """The day or month of a time as text; null without a time."""
    return F.date_format(time, GRAINS[grain])


def orders_by_period(transactions: DataFrame, grain: str) -> DataFrame:
    return transactions.withColumn("period", period_of(F.col("purchased_at"), grain))


def items_by_period(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with the period of their order; items without an order have none."""
    return order_items.join(orders.select("order_id", "period"), "order_id", "left")


def calendar(orders: DataFrame) -> DataFrame:
    """One row per period with its first day, year and quarter; the rows without a time have nulls."""
    return orders.groupBy("period").agg(F.to_date(F.min("purchased_at")).alias("first_day")).select(
        "period",
        "first_day",
        F.year("first_day").alias("year"),
        F.concat(F.year("first_day"), F.lit("-Q"), F.quarter("first_day")).alias("quarter"),
    )


def period_transactions(
    orders: DataFrame, items: DataFrame, totals: DataFrame | None = None
) -> DataFrame:
    """``transaction_metrics`` of each period; ``totals`` are the items' ``order_totals``, if known."""
    totals = order_totals(items) if totals is None else totals
    per_order = transaction_metrics(orders.drop("period"), totals)
    return per_order.join(orders.select("order_id", "period"), "order_id")


def customer_partials(
    orders: DataFrame, items: DataFrame, totals: DataFrame | None = None
) -> DataFrame:
    """Sums, counts and last purchase per period and customer; ``totals`` as above."""
    totals = (order_totals(items) if totals is None else totals).select(
        "order_id", "n_rows", "items_sum", "items_counted"
    )
    return (
        orders.join(totals, "order_id", "left")
        .groupBy("period", "customer_id")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            sum_of("items_sum").alias("items_sum"),
            F.sum("items_counted").alias("items_counted"),
            F.count("n_rows").alias("n_orders"),
            F.max("purchased_at").alias("last_purchase"),
        )
    )


def customer_products(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The distinct products per period and customer."""
    return (
        orders.select("order_id", "customer_id", "period")
        .join(items.select("order_id", "product_id"), "order_id")
        .filter("product_id IS NOT NULL")
        .select("period", "customer_id", "product_id")
        .distinct()
    )


def product_partials(items: DataFrame) -> DataFrame:
    """Units, sales and prices per period and product."""
    return items.groupBy("period", "product_id").agg(
        F.sum("quantity").alias("units_sold"),
        exact_sum("item_total").alias("sales"),
        exact_sum("price").alias("prices"),
        F.count("price").alias("n_prices"),
    )


def merged_customers(partials: DataFrame, products: DataFrame) -> DataFrame:
    """What ``metrics.customer_totals`` gives over all periods.

    Sums and distinct products meet in one aggregation by customer; a product bought in several
    periods is counted once.
    """
    pairs = products.select("customer_id", "product_id").distinct()
    sums = partials.drop("period")
    by_customer = (
        sums.unionByName(pairs, allowMissingColumns=True)
        .groupBy("customer_id")
        .agg(
            F.sum("n_rows").alias("n_transactions"),
            sum_of("items_sum").alias("spend"),
            F.sum("items_counted").alias("items_counted"),
            F.count("product_id").alias("n_distinct_products"),
            F.sum("n_orders").alias("n_orders"),
            F.max("last_purchase").alias("last_purchase"),
        )
    )
    return customer_measures(by_customer)


def merged_products(partials: DataFrame) -> DataFrame:
    """What ``metrics.product_totals`` gives over all periods."""
    return partials.groupBy("product_id").agg(
        F.sum("units_sold").alias("units_sold"),
        to_double(sum_of("sales")).alias("total_sales"),
        mean(sum_of("prices"), F.sum("n_prices")).alias("avg_price"),
    )
