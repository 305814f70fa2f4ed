"""Silver to gold: metrics per transaction, customer, product, province and city.

Order items are the large table. They are summed per order before they meet the transactions, so
the join is one row to one row however many items an order has, and every later aggregation
starts from orders. Only the distinct products of a customer need items joined one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.money import exact_sum, mean, mean_cents, sum_of, to_double
from orderlake.operators.ranking import with_ntile, with_rank
from orderlake.schemas import (
    CUSTOMER_METRICS,
    CUSTOMERS,
    PRODUCT_METRICS,
    PRODUCTS,
    TIERS,
    Table,
)


def order_totals(order_items: DataFrame) -> DataFrame:
    """One row per order; sums stay decimal and means stay sum and count, ready to add up.

    ``paid_sum`` and ``n_paid`` cover the items with a positive price.
    """
    paid = F.when(F.col("price") > 0, F.col("price"))
    return order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("product_id").alias("n_items"),
        exact_sum("item_total").alias("items_sum"),
        F.count("item_total").alias("items_counted"),
        exact_sum("price").alias("price_sum"),
        F.count("price").alias("prices_counted"),
        exact_sum(paid).alias("paid_sum"),
        F.count(paid).alias("n_paid"),
    )


def transaction_items(transactions: DataFrame, order_items: DataFrame) -> DataFrame:
    """Transactions with their items, one row per item."""
    return transactions.join(order_items, "order_id")


def transaction_metrics(transactions: DataFrame, totals: DataFrame) -> DataFrame:
    """Total, number of items, mean price and calendar fields of each order that has items.

    ``totals`` is the result of ``order_totals``, here and below.
    """
    return transactions.join(totals, "order_id").select(
        "order_id",
        "customer_id",
        "purchased_at",
        to_double(F.col("items_sum")).alias("order_total"),
        "n_items",
        mean(F.col("price_sum"), F.col("prices_counted")).alias("avg_item_price"),
        F.date_format("purchased_at", "yyyy-MM-dd").alias("purchase_day"),
        F.month("purchased_at").alias("month"),
        F.year("purchased_at").alias("year"),
        F.dayofweek("purchased_at").alias("day_of_week"),
    )


def latest_purchase(transactions: DataFrame) -> DataFrame:
    """Time of each customer's last order, whether or not it has items."""
    return transactions.groupBy("customer_id").agg(F.max("purchased_at").alias("last_purchase"))


def customer_totals(
    transactions: DataFrame, order_items: DataFrame, totals: DataFrame
) -> DataFrame:
    """Spend, item, order and product counts and last purchase of each customer with items.

    Order sums and distinct products are two branches that meet in one aggregation by customer,
    so customers are shuffled once; both are reduced before that shuffle.
    """
    orders = transactions.join(totals, "order_id", "left").select(
        "customer_id", "purchased_at", "n_rows", "items_sum", "items_counted"
    )
    products = (
        transactions.select("order_id", "customer_id")
        .join(order_items.select("order_id", "product_id"), "order_id")
        .select("customer_id", "product_id")
        .distinct()
    )
    by_customer = (
        orders.unionByName(products, allowMissingColumns=True)
        .groupBy("customer_id")
        .agg(
            F.sum("n_rows").alias("n_transactions"),
            sum_of("items_sum").alias("spend"),
            F.sum("items_counted").alias("items_counted"),
            F.count("product_id").alias("n_distinct_products"),
            F.count("n_rows").alias("n_orders"),
            F.max("purchased_at").alias("last_purchase"),
        )
    )
    return customer_measures(by_customer)


def customer_measures(by_customer: DataFrame) -> DataFrame:
    """Totals of customers with at least one order that has items, as the measures users see."""
    return by_customer.filter("n_orders > 0").select(
        "customer_id",
        "n_transactions",
        to_double(F.col("spend")).alias("total_spend"),
        mean(F.col("spend"), F.col("items_counted")).alias("avg_spend"),
        "n_distinct_products",
        "n_orders",
        F.round(to_double(F.col("spend")), 2).alias("spend_value"),
        # Orders without a customer have no common buyer, hence no last purchase.
        F.when(F.col("customer_id").isNotNull(), F.col("last_purchase")).alias("last_purchase"),
    )


def _details(df: DataFrame, table: Table, target: Table, mark: str) -> DataFrame:
    """The columns of a dimension; further ones that bear a name of the target are marked."""
    others = [
        F.col(f"`{c}`").alias(mark + c if c in target.columns else c)
        for c in df.columns
        if c not in table.columns
    ]
    return df.select(*table.columns, *others)


def with_customer_details(by_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Add address columns and further customer columns; unknown customers keep nulls."""
    details = _details(customers, CUSTOMERS, CUSTOMER_METRICS, "customer_")
    return by_customer.join(details, "customer_id", "left")


def with_tiers(customer_metrics: DataFrame) -> DataFrame:
    """Quarter of the customers by spend, highest first; equal spend goes by customer id."""
    order = [F.desc("spend_value"), F.asc("customer_id")]
    ranked = with_ntile(customer_metrics, order, len(TIERS), "tier_no")
    label = F.when(F.col("tier_no") == 1, TIERS[0])
    for number, name in enumerate(TIERS[1:-1], start=2):
        label = label.when(F.col("tier_no") == number, name)
    return ranked.withColumn("tier", label.otherwise(TIERS[-1]))


def customer_metrics(
    transactions: DataFrame, order_items: DataFrame, totals: DataFrame, customers: DataFrame
) -> DataFrame:
    """Customer totals with address and value tier."""
    by_customer = customer_totals(transactions, order_items, totals)
    return with_tiers(with_customer_details(by_customer, customers))


def product_totals(order_items: DataFrame) -> DataFrame:
    """Units, sales and mean price of each sold product."""
    return order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        to_double(exact_sum("item_total")).alias("total_sales"),
        mean(exact_sum("price"), F.count("price")).alias("avg_price"),
    )


def product_metrics(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Product totals with list price, category and rank by units within the category."""
    return with_product_details(product_totals(order_items), products)


def with_product_details(by_product: DataFrame, products: DataFrame) -> DataFrame:
    """Add list price, category, further product columns and the rank by units in the category."""
    details = _details(products, PRODUCTS, PRODUCT_METRICS, "product_")
    sold = by_product.join(details, "product_id", "left")
    ranked = with_rank(
        sold,
        [F.desc("units_sold"), F.asc("product_id")],
        partition_by=["category"],
        rank="rank_in_category",
    )
    return ranked.withColumn("rank_in_category", F.col("rank_in_category").cast("int"))


def _by_region(customer_metrics: DataFrame, customers: DataFrame, *region: str) -> DataFrame:
    known = customer_metrics.join(customers.select("customer_id"), "customer_id", "left_semi")
    return known.groupBy(*region).agg(
        F.count("customer_id").alias("n_customers"),
        to_double(exact_sum("total_spend")).alias("total_spend"),
        mean_cents(exact_sum("spend_value"), F.count("spend_value")).alias("avg_spend"),
    )


def province_metrics(customer_metrics: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers and spend per province, over customers that have a dimension row."""
    return _by_region(customer_metrics, customers, "province")


def region_metrics(customer_metrics: DataFrame, customers: DataFrame) -> DataFrame:
    """Both of the tables above from one aggregation: a row per ``level``, province and city.

    ``level`` is ``province`` (with a null city) or ``city``. Grouping sets send a customer's
    amounts to both levels within a task, and partial sums per region are all that is shuffled.
    """
    known = customer_metrics.join(customers.select("customer_id"), "customer_id", "left_semi")
    place = [F.col("province"), F.col("city")]
    return (
        known.select("customer_id", "province", "city", "total_spend", "spend_value")
        .groupingSets([place[:1], place], *place)
        .agg(
            F.when(F.grouping("city") == 1, "province").otherwise("city").alias("level"),
            F.count("customer_id").alias("n_customers"),
            to_double(exact_sum("total_spend")).alias("total_spend"),
            mean_cents(exact_sum("spend_value"), F.count("spend_value")).alias("avg_spend"),
        )
    )


def with_recency(customers: DataFrame, latest: DataFrame, as_of: Column) -> DataFrame:
    """Customers with ``recency_days``: whole days from the last purchase to a given date.

    ``latest`` is the result of ``latest_purchase``. Null for customers without a purchase; negative
    if the purchase lies after the date.
    """
    bought = latest.filter("customer_id IS NOT NULL").select(
        "customer_id", F.datediff(as_of, F.col("last_purchase")).alias("recency_days")
    )
    return customers.join(bought, "customer_id", "left")


def city_metrics(customer_metrics: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers and spend per province and city, over customers that have a dimension row."""
    return _by_region(customer_metrics, customers, "province", "city")
