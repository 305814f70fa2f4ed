"""Refresh by period gives what a run over everything gives, from the changed files alone."""

from __future__ import annotations

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators import metrics, partials
from orderlake.plans import refresh
from orderlake.sources import catalog
from orderlake.sources.lake import Lake, note_pending, pending, publish_files

ORDERS = (
    "order_id string, customer_id string, total_payment double, purchased_at timestamp, "
    "order_status string"
)
ITEMS = "order_id string, product_id string, price double, quantity int, item_total double"


def orders(spark, data):
    df = spark.createDataFrame(
        [(o, c, 1.0, t and datetime.fromisoformat(t), "Selesai") for o, c, t in data], ORDERS
    )
    extra = [f for f in schemas.TRANSACTIONS.fields if f.name not in df.columns]
    return schemas.conform(df.withColumns({f.name: F.lit(None) for f in extra}), schemas.TRANSACTIONS)


def items(spark, data):
    return spark.createDataFrame([(o, p, x, 2, x) for o, p, x in data], ITEMS)


FIRST = [
    ("O1", "C1", "2024-01-01 08:00:00"), ("O2", "C1", "2024-01-02 08:00:00"),
    ("O3", "C2", "2024-01-02 23:59:59"), ("O4", None, "2024-01-02 09:00:00"),
    ("O5", "C3", None), ("O6", "C4", "2024-02-01 00:00:00"),
]
FIRST_ITEMS = [
    ("O1", "P1", 0.1), ("O1", "P2", 0.2), ("O2", "P1", 5.0), ("O3", "P3", None),
    ("O4", "P1", 7.0), ("O5", "P2", 1.5), ("O9", "P4", 3.0), ("O2", None, 4.0),
]
# 2 January again: an order gone, one changed, one new; C2 has no order with items left
CHANGED = [("O2", "C1", "2024-01-02 08:00:00"), ("O7", "C5", "2024-01-02 10:00:00"),
           ("O8", "C2", "2024-01-02 11:00:00")]
CHANGED_ITEMS = [("O2", "P9", 50.0), ("O7", "P1", 0.3)]


@pytest.fixture
def lake(spark, tmp_path):
    name = re.sub(r"\W", "_", f"refresh_{tmp_path.name}")
    lake = Lake(str(tmp_path), name, f"{tmp_path}/catalog")
    customers = [(f"C{i}", "0", f"City {i % 2}", "Here") for i in range(1, 6)]
    products = [(f"P{i}", 1.0, "cat") for i in range(1, 10)]
    for table, data in ((schemas.CUSTOMERS, customers), (schemas.PRODUCTS, products)):
        publish_files(
            spark, spark.createDataFrame(data, table.ddl), lake.folder("silver", table.name), table
        )
    yield lake
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def expected(spark, rows, all_orders, all_items):
    """The same tables from all rows at once."""
    totals = metrics.order_totals(all_items)
    return (
        rows(metrics.customer_totals(all_orders, all_items, totals)),
        rows(metrics.product_totals(all_items)),
        rows(metrics.transaction_metrics(all_orders, totals)),
    )


def stored(spark, rows, lake):
    def read(table):
        return refresh.read_partials(spark, lake, table)

    return (
        rows(
            partials.merged_customers(
                read(schemas.CUSTOMER_PARTIALS), read(schemas.CUSTOMER_PRODUCTS)
            )
        ),
        rows(partials.merged_products(read(schemas.PRODUCT_PARTIALS))),
        rows(read(schemas.PERIOD_TRANSACTIONS).drop("period")),
    )


@pytest.mark.parametrize("grain", ["day", "month"])
def test_a_first_load_equals_a_full_run(spark, lake, rows, grain):
    refresh.refresh(spark, lake, orders(spark, FIRST), items(spark, FIRST_ITEMS), grain)
    assert stored(spark, rows, lake) == expected(
        spark, rows, orders(spark, FIRST), items(spark, FIRST_ITEMS)
    )


def test_a_changed_day_equals_a_full_rerun(spark, lake, rows):
    refresh.refresh(spark, lake, orders(spark, FIRST), items(spark, FIRST_ITEMS))
    gold = refresh.refresh(spark, lake, orders(spark, CHANGED), items(spark, CHANGED_ITEMS))
    kept = [o for o in FIRST if o[2] is None or not o[2].startswith("2024-01-02")]
    kept_items = [i for i in FIRST_ITEMS if i[0] not in ("O2", "O3", "O4")]
    assert stored(spark, rows, lake) == expected(
        spark, rows, orders(spark, kept + CHANGED), items(spark, kept_items + CHANGED_ITEMS)
    )
    assert spark.table(f"{lake.database}.customer_metrics").count() == 3
    assert rows(gold["customer_metrics"]) == rows(spark.table(f"{lake.database}.customer_metrics"))


def test_a_day_that_loses_all_items_leaves_no_old_sums(spark, lake, rows):
    refresh.refresh(spark, lake, orders(spark, FIRST), items(spark, FIRST_ITEMS))
    refresh.refresh(spark, lake, orders(spark, CHANGED), items(spark, []))
    kept = [o for o in FIRST if o[2] is None or not o[2].startswith("2024-01-02")]
    kept_items = [i for i in FIRST_ITEMS if i[0] not in ("O2", "O3", "O4")]
    assert stored(spark, rows, lake) == expected(
        spark, rows, orders(spark, kept + CHANGED), items(spark, kept_items)
    )


def files_read(df):
    """The folders of the files that a plan scans."""
    return {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}


def test_only_the_files_of_the_changed_day_are_scanned(spark, lake):
    refresh.refresh(spark, lake, orders(spark, FIRST), items(spark, FIRST_ITEMS))
    day_orders, day_items = refresh.read_periods(spark, lake, ["2024-01-02"])
    for df in (
        partials.customer_partials(day_orders, day_items),
        partials.customer_products(day_orders, day_items),
        partials.product_partials(day_items),
        partials.period_transactions(day_orders, day_items),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan.*PartitionFilters: \[([^\]]*)", plan)
        assert scans and all("2024-01-02" in s for s in scans)
    no_day, _ = refresh.read_periods(spark, lake, [None])
    assert [r.order_id for r in no_day.collect()] == ["O5"]


def test_untouched_files_stay_the_same(spark, lake, tmp_path):
    refresh.refresh(spark, lake, orders(spark, FIRST), items(spark, FIRST_ITEMS))

    def files():
        return {
            str(p.relative_to(tmp_path))
            for p in tmp_path.glob("*/*/period=*/*.parquet")
            if "2024-01-02" not in str(p)
        }

    before = files()
    refresh.refresh(spark, lake, orders(spark, CHANGED), items(spark, CHANGED_ITEMS))
    assert files() == before


def test_the_next_run_finishes_what_a_dead_one_began(spark, lake, rows, monkeypatch):
    refresh.refresh(spark, lake, orders(spark, FIRST), items(spark, FIRST_ITEMS))
    with monkeypatch.context() as patched:
        patched.setattr(
            refresh.partials, "product_partials", lambda *a: (_ for _ in ()).throw(RuntimeError)
        )
        with pytest.raises(RuntimeError):
            refresh.refresh(spark, lake, orders(spark, CHANGED), items(spark, CHANGED_ITEMS))
    notes = lake.folder("state", "pending_periods")
    assert pending(spark, notes) == ["2024-01-02"]
    later = [("O20", "C1", "2024-03-01 08:00:00")]
    refresh.refresh(spark, lake, orders(spark, later), items(spark, [("O20", "P1", 1.0)]))
    assert pending(spark, notes) == []
    kept = [o for o in FIRST if o[2] is None or not o[2].startswith("2024-01-02")]
    kept_items = [i for i in FIRST_ITEMS if i[0] not in ("O2", "O3", "O4")]
    assert stored(spark, rows, lake) == expected(
        spark,
        rows,
        orders(spark, kept + CHANGED + later),
        items(spark, [*kept_items, *CHANGED_ITEMS, ("O20", "P1", 1.0)]),
    )


def test_pending_remembers_rows_without_a_time(spark, tmp_path):
    note_pending(spark, str(tmp_path / "notes"), ["2024-01", None])
    assert set(pending(spark, str(tmp_path / "notes"))) == {"2024-01", None}


def test_a_join_with_the_calendar_prunes_periods_at_runtime(spark, lake):
    refresh.refresh(spark, lake, orders(spark, FIRST), items(spark, FIRST_ITEMS), "month")
    sold = spark.table(f"{lake.database}.period_items")
    months = spark.table(f"{lake.database}.calendar").filter("quarter = '2024-Q1'")
    joined = sold.join(months, "period")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 6
    parts = {r.partition for r in spark.sql(f"SHOW PARTITIONS {lake.database}.period_items").collect()}
    assert "period=2024-01" in parts


def test_new_partitions_are_found(spark, lake):
    refresh.refresh(spark, lake, orders(spark, FIRST), items(spark, FIRST_ITEMS), "month")
    later = [("O20", "C1", "2024-03-01 08:00:00")]
    refresh.refresh(spark, lake, orders(spark, later), items(spark, []), "month")
    table = f"{lake.database}.period_orders"
    assert spark.table(table).filter("period = '2024-03'").count() == 1
    catalog.refresh(spark, table, partitioned=True)
    assert spark.table(table).count() == len(FIRST) + 1
