"""Completed orders, and the segment table built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.money import exact_sum, mean, sum_of, to_double
from orderlake.schemas import COMPLETED_STATUS


def flat_orders(
    transactions: DataFrame, order_items: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Every item of every order, with province and category.

    Each dimension joins the side that carries its key before the two sides meet on the order, so
    a hot customer or product is split by adaptive execution ahead of a shuffle that follows
    anyway.
    """
    orders = transactions.select(
        "order_id", "customer_id", "total_payment", "order_status", "purchased_at"
    )
    items = order_items.select("order_id", "product_id", "price")
    placed = orders.join(customers.select("customer_id", "province"), "customer_id", "left")
    sold = items.join(products.select("product_id", "category"), "product_id", "left")
    return placed.join(sold, "order_id").select(
        "order_id",
        "product_id",
        "customer_id",
        "province",
        "price",
        "total_payment",
        "category",
        "order_status",
        "purchased_at",
    )


def completed_orders(
    transactions: DataFrame,
    order_items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    status: str = COMPLETED_STATUS,
) -> DataFrame:
    """Items with a positive price in completed orders; both conditions reach the scans."""
    flat = flat_orders(transactions, order_items, customers, products)
    return flat.filter((F.col("order_status") == status) & (F.col("price") > 0))


def completed_by_customer(
    transactions: DataFrame,
    totals: DataFrame,
    customers: DataFrame,
    status: str = COMPLETED_STATUS,
) -> DataFrame:
    """Mean item price, orders, last purchase, province and payments over completed orders.

    The same rows as ``completed_orders``, taken from the sums per order of ``order_totals``:
    payment is an amount of the order and counts once, and no item is shuffled again.
    """
    orders = transactions.filter(F.col("order_status") == status).join(
        totals.filter("n_paid > 0"), "order_id"
    )
    measures = orders.groupBy("customer_id").agg(
        mean(sum_of("paid_sum"), F.sum("n_paid")).alias("avg_price"),
        F.count("order_id").cast("int").alias("n_orders"),
        F.max("purchased_at").alias("last_purchase"),
        to_double(exact_sum("total_payment")).alias("total_payment"),
    )
    return measures.join(customers.select("customer_id", "province"), "customer_id", "left")


def gold_segments(segments: DataFrame, measures: DataFrame) -> DataFrame:
    """One row per segmented customer; those without a completed order keep null measures."""
    return segments.select("customer_id", "segment").join(measures, "customer_id", "left").select(
        "customer_id",
        "segment",
        "avg_price",
        "n_orders",
        "last_purchase",
        "province",
        "total_payment",
    )
