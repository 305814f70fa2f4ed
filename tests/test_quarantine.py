"""Rejected rows, gates on stored tables, regions, charts, recency and scores of all k."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.operators import analysis, clean, gates, metrics, quarantine, segments
from orderlake.sources.bronze import read_bronze
from orderlake.sources.lake import write_table

RAW = "order_id string, product_id string, price string, quantity string, item_total string"
ROWS = [
    ("O1", "P1", "1.5", "1", "1.5"), ("O1", "P1", "1.5", "1", "1.5"), ("O1", "P1", "bad", "1", "2"),
    ("O2", "P1", "x", "y", "2"), ("O3", "P1", None, "1", "2"), (None, "P2", "1", "1", "1"),
    (None, "P2", "2", "1", "1"), ("O4", "P1", "3", "1.9", "3"),
]


def split(spark, data=ROWS):
    raw = spark.createDataFrame(data, RAW)
    return quarantine.cleaned_and_rejected(raw, schemas.ORDER_ITEMS, clean.clean_order_items)


def test_silver_and_dropped_rows_are_the_raw_rows(spark, rows):
    silver, rejected = split(spark)
    assert rows(silver) == rows(clean.clean_order_items(spark.createDataFrame(ROWS, RAW)))
    assert silver.count() + rejected.filter("dropped").count() == len(ROWS)
    found = sorted((r.problems, r.dropped) for r in rejected.collect())
    assert found == [
        ("dropped copy", True),
        ("malformed price, dropped copy", True),
        ("malformed price, malformed quantity", False),
        ("null key", False),
        ("null key, dropped copy", True),
    ]
    bad = rejected.filter("problems = 'malformed price, dropped copy'").first()
    assert json.loads(bad.record) == {
        "order_id": "O1", "product_id": "P1", "price": "bad", "quantity": "1", "item_total": "2",
    }


def test_a_clean_table_and_an_empty_one_reject_nothing(spark):
    assert split(spark, [ROWS[0], ROWS[7]])[1].count() == 0
    silver, rejected = split(spark, [])
    assert (silver.count(), rejected.count()) == (0, 0)


def test_broken_records_are_kept_as_read(spark, tmp_path):
    lines = ["id_produk,harga,kategori_produk", "P0,1.5,A", "P1,2.5,A,too,many", "P0,1.5,A"]
    (tmp_path / "part.csv").write_text("\n".join(lines) + "\n")
    raw = read_bronze(spark, str(tmp_path), schemas.PRODUCTS)
    silver, rejected = quarantine.cleaned_and_rejected(
        raw, schemas.PRODUCTS, clean.clean_products
    )
    assert silver.count() == 2
    found = {(r.problems, r.dropped, r.record) for r in rejected.collect()}
    assert ("broken record", False, "P1,2.5,A,too,many") in found
    assert len(found) == 2


def test_a_table_without_a_key_drops_nothing(spark):
    raw = spark.createDataFrame([("S1", "a", "b")] * 2, "seller_id string, city string, province string")
    silver, rejected = quarantine.cleaned_and_rejected(raw, schemas.SELLERS, clean.clean_sellers)
    assert (silver.count(), rejected.count()) == (2, 0)


# Gates


def test_gates_say_what_is_wrong_and_never_raise(spark, tmp_path):
    table = schemas.PRODUCTS
    good = spark.createDataFrame([("P1", 1.0, "a"), ("P2", 2.0, "b")], table.ddl)
    cases = {
        "ready": good,
        "wrong types": good.withColumn("price", F.lit("x")),
        "wrong columns": good.drop("category"),
        "empty": good.limit(0),
        "repeated keys": good.unionByName(good),
    }
    for state, df in cases.items():
        write_table(df, str(tmp_path / state))
        row = gates.gate(spark, str(tmp_path / state), table).first()
        assert (row.state, row.ready) == (state, state == "ready")
    assert gates.gate(spark, str(tmp_path / "nothing"), table).first().state == "absent"
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    assert gates.gate(spark, str(tmp_path / "broken"), table).first().state == "unreadable"


def test_orphans_are_counted_by_row(spark, tmp_path):
    items = spark.createDataFrame(
        [("O1", "P1"), ("O1", "P2"), ("O9", "P1"), ("O9", "P2"), (None, "P1")],
        "order_id string, product_id string",
    )
    orders = spark.createDataFrame([("O1",), ("O2",)], "order_id string")
    assert gates.orphans(items, "order_id", orders, "order_id").first().n_orphans == 2
    assert gates.orphans(items.limit(0), "order_id", orders, "order_id").first().n_orphans == 0
    assert gates.orphans(items, "order_id", orders.limit(0), "order_id").first().n_orphans == 4
    parents = gates.known_parents(schemas.ORDER_ITEMS, {"transactions": orders}, schemas.BRONZE)
    assert list(parents) == ["order_id"]


# Regions, charts, recency


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [("C1", "A", "x", 1.0), ("C2", "A", "y", 2.0), ("C3", None, None, 4.0), ("C4", "A", None, 8.0)],
        "customer_id string, province string, city string, total_spend double",
    ).withColumn("spend_value", F.col("total_spend"))


def test_both_levels_come_from_one_aggregation(spark, customers, rows):
    dimension = customers.select("customer_id")
    both = metrics.region_metrics(customers, dimension)
    measures = ("n_customers", "total_spend", "avg_spend")
    assert rows(both.filter("level = 'province'"), "province", *measures) == rows(
        metrics.province_metrics(customers, dimension), "province", *measures
    )
    assert rows(both.filter("level = 'city'"), "province", "city", *measures) == rows(
        metrics.city_metrics(customers, dimension), "province", "city", *measures
    )
    # a city that is null stays apart from the province's own row
    assert both.filter("province = 'A' AND city IS NULL").count() == 2
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1
    assert plan.count("Exchange hashpartitioning(province") == 1


def test_chart_has_a_column_per_segment(spark, rows):
    gold = spark.createDataFrame(
        [("A", 0, 1.0), ("A", 0, 2.0), ("A", 2, 5.0), (None, 1, 7.0), ("B", 9, 1.0)],
        "province string, segment int, total_payment double",
    )
    chart = analysis.spend_chart(gold, [0, 1, 2])
    assert chart.columns == ["province", "segment_0", "segment_1", "segment_2"]
    assert rows(chart) == [("A", 3.0, 0.0, 5.0), (None, 0.0, 7.0, 0.0)]


def test_recency_counts_days_and_is_null_without_a_purchase(spark, rows):
    customers = spark.createDataFrame([("C1",), ("C2",), ("C3",), (None,)], "customer_id string")
    orders = spark.sql(
        "SELECT * FROM VALUES ('C1', timestamp'2024-01-30 23:00:00'), "
        "('C1', timestamp'2024-01-01 00:00:00'), ('C2', timestamp'2024-02-03 00:00:01'), "
        "(CAST(NULL AS STRING), timestamp'2024-01-01 00:00:00') AS t(customer_id, purchased_at)"
    )
    found = metrics.with_recency(
        customers, metrics.latest_purchase(orders), F.lit(date(2024, 2, 1)).cast("date")
    )
    assert rows(found) == [("C1", 2), ("C2", -2), ("C3", None), (None, None)]


# Scores of all k


def test_scores_of_all_k_are_those_of_the_evaluator_in_two_jobs(spark):
    data = spark.createDataFrame(
        [(f"C{i}", i % 5 + 1, float(i % 13) ** 2, float(i % 7), i % 3) for i in range(200)],
        "customer_id string, n_transactions bigint, total_spend double, avg_spend double, "
        "n_distinct_products bigint",
    )
    prepared, _ = segments.prepare_features(data)
    models = {k: segments.kmeans(k).fit(prepared) for k in range(2, 9)}
    group = "scores of all k"
    spark.sparkContext.setJobGroup(group, group)
    trials = segments._scored(prepared, models)
    n_stages = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for t in trials:
        assert abs(t.score - segments.silhouette(t.model.transform(prepared))) < 1e-9
    prepared.unpersist()
    # adaptive execution counts the map side of each of the two aggregations as a job
    assert n_stages <= 4


def test_a_cluster_of_one_row_scores_like_the_evaluator(spark):
    data = spark.createDataFrame(
        [(f"C{i}", 1, 1.0 + i % 2, 1.0, 1) for i in range(9)] + [("far", 900, 1e6, 1e6, 9)],
        "customer_id string, n_transactions bigint, total_spend double, avg_spend double, "
        "n_distinct_products bigint",
    )
    prepared, _ = segments.prepare_features(data)
    model = segments.kmeans(2).fit(prepared)
    assigned = model.transform(prepared)
    (score,) = segments.silhouette(assigned, ["cluster"])
    assert abs(score - segments.silhouette(assigned)) < 1e-9
    prepared.unpersist()
