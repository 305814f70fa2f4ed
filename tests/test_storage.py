"""Tables in buckets by order."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators import completed, metrics
from orderlake.plans import storage
from orderlake.sources.lake import Lake


@pytest.fixture
def shop(spark, tmp_path):
    name = re.sub(r"\W", "_", f"buckets_{tmp_path.name}")
    yield Lake(str(tmp_path), name, f"{tmp_path}/catalog")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def silver(spark, n=200):
    numbers = spark.range(n)
    orders = numbers.select(
        F.concat(F.lit("O"), "id").alias("order_id"),
        F.concat(F.lit("C"), F.col("id") % 17).alias("customer_id"),
        F.timestamp_seconds(F.col("id") * 86_400).alias("purchased_at"),
        F.lit("Selesai").alias("order_status"),
    )
    missing = [f.name for f in schemas.TRANSACTIONS.fields if f.name not in orders.columns]
    orders = schemas.conform(
        orders.withColumns({c: F.lit(None) for c in missing}), schemas.TRANSACTIONS
    )
    items = numbers.select(
        F.concat(F.lit("O"), F.col("id") % (n - 5)).alias("order_id"),
        F.explode(F.array(*(F.concat(F.lit("P"), (F.col("id") + i) % 7) for i in range(3)))).alias(
            "product_id"
        ),
        (F.col("id") / 4).alias("price"),
        F.lit(1).alias("quantity"),
        (F.col("id") / 4).alias("item_total"),
    )
    return orders, items


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_joins_and_sums_by_order_need_no_shuffle(spark, shop, no_broadcast):
    orders, items = storage.store_by_order(spark, shop, *silver(spark), buckets=4)
    totals = metrics.order_totals(items)
    for df in (
        metrics.customer_totals(orders, items, totals),
        metrics.transaction_metrics(orders, totals),
        metrics.transaction_items(orders, items),
    ):
        assert not [e for e in exchanges(df) if "order_id" in e]
    plain, plain_items = silver(spark)
    unbucketed = metrics.customer_totals(plain, plain_items, metrics.order_totals(plain_items))
    assert [e for e in exchanges(unbucketed) if "order_id" in e]


def test_results_are_those_of_plain_tables(spark, shop, rows, no_broadcast):
    plain, plain_items = silver(spark)
    orders, items = storage.store_by_order(spark, shop, plain, plain_items, buckets=4)

    def results(o, i):
        totals = metrics.order_totals(i)
        customers = o.select("customer_id", F.lit("x").alias("province")).distinct()
        return (
            rows(metrics.customer_totals(o, i, totals)),
            rows(metrics.transaction_metrics(o, totals)),
            rows(completed.completed_by_customer(o, totals, customers)),
        )

    assert results(orders, items) == results(plain, plain_items)


def test_the_next_version_takes_the_place_of_the_last(spark, shop):
    plain, plain_items = silver(spark)
    storage.store_by_order(spark, shop, plain, plain_items, buckets=4)
    storage.store_by_order(spark, shop, plain.limit(10), plain_items, buckets=4)
    name = f"{shop.database}.transactions_by_order"
    assert spark.table(name).count() == 10
    # other buckets make another declaration
    orders, _ = storage.store_by_order(spark, shop, plain, plain_items, buckets=8)
    assert orders.count() == spark.table(name).count() == 200
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'")
    assert details.first().data_type == "8"
    assert {t.name for t in spark.catalog.listTables(shop.database) if not t.isTemporary} == {
        "transactions_by_order", "items_by_order",
    }


def test_buckets_grow_with_the_items(spark, shop, monkeypatch):
    monkeypatch.setattr(storage, "input_bytes", lambda *a: 0)
    assert storage.bucket_count(spark, shop) == 8
    monkeypatch.setattr(storage, "input_bytes", lambda *a: 10 * 1024**4)
    assert storage.bucket_count(spark, shop) == 65_536
