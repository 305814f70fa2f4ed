from __future__ import annotations

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlake.functions.money import exact_sum, mean, mean_cents, sum_of, to_double
from orderlake.operators import completed, metrics

DAY = [dt.datetime(2024, 1, d, 12, 0, 0) for d in range(1, 29)]


@pytest.fixture(scope="module")
def silver(spark):
    """Two customers with dimension rows, C9 without one, and orders of several shapes."""
    transactions = spark.createDataFrame(
        [
            ("O1", "C1", 100.0, DAY[0], "Selesai"),
            ("O2", "C1", 50.0, DAY[1], "Selesai"),
            ("O3", "C1", 10.0, DAY[9], "Batal"),  # has no items
            ("O4", "C2", 20.0, DAY[2], "Selesai"),
            ("O5", "C9", 30.0, DAY[3], "Selesai"),
            ("O6", "C2", 40.0, DAY[4], "Batal"),
            ("O7", None, 5.0, DAY[5], "Selesai"),
        ],
        "order_id string, customer_id string, total_payment double, purchased_at timestamp, "
        "order_status string",
    )
    items = spark.createDataFrame(
        [
            ("O1", "P1", 10.0, 1, 10.0),
            ("O1", "P2", 20.0, 2, 40.0),
            ("O1", "P3", 50.0, 1, 50.0),
            ("O2", "P1", 50.0, 1, 50.0),
            ("O4", "P2", 0.0, 1, 0.0),
            ("O4", "P1", 20.0, 1, 20.0),
            ("O5", "P9", 30.0, 3, 30.0),
            ("O6", "P2", 40.0, 1, 40.0),
            ("O7", "P1", 5.0, 1, 5.0),
        ],
        "order_id string, product_id string, price double, quantity int, item_total double",
    )
    customers = spark.createDataFrame(
        [("C1", "00001", "Medan", "Sumatera Utara"), ("C2", "00000", "Padang", "Sumatera Barat"),
         ("C3", "00002", "Jambi", "Jambi")],
        "customer_id string, postal_code string, city string, province string",
    )
    products = spark.createDataFrame(
        [("P1", 11.0, "toys"), ("P2", 22.0, "toys"), ("P3", 55.0, "books")],
        "product_id string, price double, category string",
    )
    return transactions, items, customers, products


def customer_totals(transactions, items):
    return metrics.customer_totals(transactions, items, metrics.order_totals(items))


def test_transaction_metrics(silver, rows):
    transactions, items, *_ = silver
    result = metrics.transaction_metrics(transactions, metrics.order_totals(items))
    first = result.filter("order_id = 'O1'").first()
    assert (first.order_total, first.n_items, first.avg_item_price) == (100.0, 3, 80.0 / 3)
    assert (first.purchase_day, first.month, first.year) == ("2024-01-01", 1, 2024)
    assert first.day_of_week == 2  # a Monday; 1 is Sunday
    assert [r[0] for r in rows(result, "order_id")] == ["O1", "O2", "O4", "O5", "O6", "O7"]


def test_transaction_metrics_equal_join_then_group(silver, rows):
    transactions, items, *_ = silver
    joined = metrics.transaction_items(transactions, items)
    plain = joined.groupBy("order_id", "customer_id", "purchased_at").agg(
        F.sum("item_total").alias("order_total"),
        F.count("product_id").alias("n_items"),
        F.avg("price").alias("avg_item_price"),
    )
    assert rows(metrics.transaction_metrics(transactions, metrics.order_totals(items)), *plain.columns) == rows(plain)


def test_latest_purchase_counts_orders_without_items(silver, rows):
    assert rows(metrics.latest_purchase(silver[0].filter("customer_id = 'C1'"))) == [("C1", DAY[9])]


def test_customer_totals(silver):
    transactions, items, *_ = silver
    found = {r.customer_id: r for r in customer_totals(transactions, items).collect()}
    assert set(found) == {"C1", "C2", "C9", None}
    c1 = found["C1"]
    assert (c1.n_transactions, c1.n_orders, c1.n_distinct_products) == (4, 2, 3)
    assert (c1.total_spend, c1.avg_spend, c1.spend_value) == (150.0, 37.5, 150.0)
    assert c1.last_purchase == DAY[9]
    assert (found[None].total_spend, found[None].last_purchase) == (5.0, None)


def test_customer_totals_equal_join_then_group(silver, rows):
    transactions, items, *_ = silver
    plain = metrics.transaction_items(transactions, items).groupBy("customer_id").agg(
        F.count("order_id").alias("n_transactions"),
        F.sum("item_total").alias("total_spend"),
        F.avg("item_total").alias("avg_spend"),
        F.count_distinct("product_id").alias("n_distinct_products"),
        F.count_distinct("order_id").alias("n_orders"),
    )
    assert rows(customer_totals(transactions, items), *plain.columns) == rows(plain)


def test_customer_without_items_has_no_metrics(silver, spark):
    transactions, items, *_ = silver
    lonely = spark.createDataFrame(
        [("O8", "C3", 1.0, DAY[0], "Selesai")], transactions.schema
    )
    found = customer_totals(transactions.union(lonely), items)
    assert found.filter("customer_id = 'C3'").isEmpty()


def test_customer_without_dimension_row(silver):
    transactions, items, customers, _ = silver
    result = metrics.customer_metrics(
        transactions, items, metrics.order_totals(items), customers
    )
    unknown = result.filter("customer_id = 'C9'").first()
    assert (unknown.province, unknown.postal_code) == (None, None)
    provinces = {r.province: r for r in metrics.province_metrics(result, customers).collect()}
    assert set(provinces) == {"Sumatera Utara", "Sumatera Barat"}
    assert provinces["Sumatera Barat"].n_customers == 1
    assert provinces["Sumatera Barat"].total_spend == 60.0


def tiers_of(spark, spends):
    df = spark.createDataFrame(
        [(f"C{i}", float(s)) for i, s in enumerate(spends)], "customer_id string, spend_value double"
    )
    return [r.tier for r in metrics.with_tiers(df).orderBy("customer_id").collect()]


def test_tied_spend_goes_by_customer_id(spark):
    assert tiers_of(spark, [7] * 5) == ["Platinum", "Platinum", "Gold", "Silver", "Bronze"]


def test_fewer_customers_than_tiers(spark):
    assert tiers_of(spark, [1, 3, 2]) == ["Silver", "Platinum", "Gold"]


def test_highest_spend_is_platinum(spark):
    assert tiers_of(spark, [1, 2, 3, 4, 5, 6, 7, 8]) == [
        "Bronze", "Bronze", "Silver", "Silver", "Gold", "Gold", "Platinum", "Platinum",
    ]


def test_product_metrics(silver, rows):
    _, items, _, products = silver
    result = metrics.product_metrics(items, products)
    assert rows(
        result, "product_id", "units_sold", "total_sales", "avg_price", "price", "category",
        "rank_in_category",
    ) == [
        ("P1", 4, 85.0, 21.25, 11.0, "toys", 1),  # ties with P2 on units; the lower id is first
        ("P2", 4, 80.0, 20.0, 22.0, "toys", 2),
        ("P3", 1, 50.0, 50.0, 55.0, "books", 1),
        ("P9", 3, 30.0, 30.0, None, None, 1),
    ]


def test_city_metrics_round_half_up(spark, rows):
    customers = spark.createDataFrame(
        [("C1", "p", "c"), ("C2", "p", "c"), ("C3", "p", None)],
        "customer_id string, province string, city string",
    )
    totals = spark.createDataFrame(
        [("C1", 1.0, 1.0), ("C2", 1.01, 1.01), ("C3", 5.0, 5.0)],
        "customer_id string, total_spend double, spend_value double",
    ).join(customers, "customer_id")
    assert rows(metrics.city_metrics(totals, customers)) == [
        ("p", "c", 2, 2.01, 1.01),  # the mean is 1.005
        ("p", None, 1, 5.0, 5.0),
    ]


def test_sums_do_not_depend_on_row_order(spark):
    data = [("O", f"P{i}", 0.1 * i, 1, 0.1 * i) for i in range(1, 500)]
    ddl = "order_id string, product_id string, price double, quantity int, item_total double"
    sums = {
        metrics.order_totals(spark.createDataFrame(d, ddl).repartition(n)).first().items_sum
        for n, d in ((1, data), (3, data[::-1]), (7, data))
    }
    assert len(sums) == 1


def test_completed_orders_filter_price_and_status(silver, rows):
    result = completed.completed_orders(*silver)
    assert rows(result, "order_id", "product_id", "category", "province") == [
        ("O1", "P1", "toys", "Sumatera Utara"),
        ("O1", "P2", "toys", "Sumatera Utara"),
        ("O1", "P3", "books", "Sumatera Utara"),
        ("O2", "P1", "toys", "Sumatera Utara"),
        ("O4", "P1", "toys", "Sumatera Barat"),
        ("O5", "P9", None, None),
        ("O7", "P1", "toys", None),
    ]


def test_payment_counts_once_per_order(silver):
    transactions, items, customers, _ = silver
    measures = completed.completed_by_customer(
        transactions, metrics.order_totals(items), customers
    )
    c1 = measures.filter("customer_id = 'C1'").first()
    assert (c1.total_payment, c1.n_orders, c1.avg_price) == (150.0, 2, 130.0 / 4)
    assert (c1.last_purchase, c1.province) == (DAY[1], "Sumatera Utara")


def test_completed_by_customer_equals_the_completed_table(silver, rows):
    transactions, items, customers, _ = silver
    done = completed.completed_orders(*silver)
    plain = done.groupBy("customer_id", "province").agg(
        F.avg("price").alias("avg_price"),
        F.count_distinct("order_id").cast("int").alias("n_orders"),
        F.max("purchased_at").alias("last_purchase"),
    )
    measures = completed.completed_by_customer(
        transactions, metrics.order_totals(items), customers
    )
    assert rows(measures, *plain.columns) == rows(plain)


def test_segmented_customer_without_completed_order(silver, spark, rows):
    transactions, items, customers, _ = silver
    segments = spark.createDataFrame([("C1", 0), ("C3", 1)], "customer_id string, segment int")
    measures = completed.completed_by_customer(
        transactions, metrics.order_totals(items), customers
    )
    assert rows(completed.gold_segments(segments, measures)) == [
        ("C1", 0, 32.5, 2, DAY[1], "Sumatera Utara", 150.0),
        ("C3", 1, None, None, None, None, None),
    ]


def test_a_giant_order_is_split_when_items_are_joined_one_by_one(spark):
    """With low thresholds adaptive execution splits the hot key's partition on the items' side."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        items = spark.range(0, 60_000, 1, 8).selectExpr(
            "if(id < 50000, 'hot', concat('O', id % 3000)) AS order_id",
            "uuid() AS product_id", "1.0D AS price", "1 AS quantity", "1.0D AS item_total",
        )
        orders = spark.range(3000).selectExpr(
            "if(id = 0, 'hot', concat('O', id)) AS order_id", "concat('C', id) AS customer_id",
            "1.0D AS total_payment", "timestamp '2024-01-01 00:00:00' AS purchased_at",
        )
        joined = metrics.transaction_items(orders, items)
        assert len(joined.collect()) > 50_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_large_sums_are_the_nearest_double(spark):
    rng = random.Random(3)
    cents = [rng.randrange(10 ** rng.randrange(2, 15)) for _ in range(4000)]
    df = spark.createDataFrame([(i % 200, c / 100) for i, c in enumerate(cents)], "g int, x double")
    found = df.groupBy("g").agg(to_double(exact_sum("x")).alias("s")).collect()
    for r in found:
        assert r.s == float(Decimal(sum(cents[r.g::200])) / 100)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "amounts",
    [
        [4e-7, 4e-7],
        [1e-9] * 1000,
        [1e23, 1.0],
        [1e23, 4e-7, 12.34, 1e-9],
        [9e14, 0.5, 2e15, 1e300],
        [8589934592.01, 8589934591.99, 0.000001],
        [-3.3, 3.3, -1e-8],
        [None, 5e-7],
    ],
)
def test_no_amount_and_no_digit_is_lost(spark, ansi, amounts):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(a,) for a in amounts], "x double")
        found = df.agg(
            to_double(exact_sum("x")).alias("s"),
            mean(exact_sum("x"), F.count("x")).alias("m"),
            mean_cents(exact_sum("x"), F.count("x")).alias("c"),
        ).first()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    known = [a for a in amounts if a is not None]
    total = math.fsum(known)
    assert found.s == pytest.approx(total, rel=1e-14, abs=1e-22)
    assert found.m == pytest.approx(total / len(known), rel=1e-14, abs=1e-22)
    assert found.c == pytest.approx(total / len(known), rel=1e-14, abs=0.005000001)


def test_nothing_counted_is_null_and_not_a_number_stays(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert df.agg(to_double(exact_sum("x")).alias("s")).first().s is None
    df = spark.createDataFrame([(1.5,), (float("nan"),)], "x double")
    assert math.isnan(df.agg(to_double(exact_sum("x")).alias("s")).first().s)


def test_totals_of_totals(spark):
    rows = [(i, i % 3, 0.1 * i + 1e-8) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, g int, x double")
    by_group = df.groupBy("g").agg(exact_sum("x").alias("t"))
    found = by_group.agg(to_double(sum_of("t")).alias("s")).first().s
    assert found == pytest.approx(math.fsum(r[2] for r in rows), rel=1e-15)


def test_half_cents_round_up(spark):
    df = spark.createDataFrame([(0.01,), (0.02,)], "x double")
    assert df.agg(mean_cents(exact_sum("x"), F.count("x")).alias("c")).first().c == 0.02
