from __future__ import annotations

import pytest

from orderlake.operators import analysis, gates
from orderlake.schemas import PRODUCTS, SELLERS


@pytest.fixture(scope="module")
def segmented(spark):
    return spark.createDataFrame(
        [
            ("C1", 1, 10.0, 10.0, 1, 0),
            ("C2", 3, 30.0, 10.0, 2, 0),
            ("C3", 2, 30.0, 15.0, 2, 0),
            ("C4", 5, 5.0, 1.0, 4, 1),
        ],
        "customer_id string, n_transactions bigint, total_spend double, avg_spend double, "
        "n_distinct_products bigint, segment int",
    )


def test_counts(segmented):
    assert [tuple(r) for r in analysis.segment_counts(segmented).collect()] == [(0, 3), (1, 1)]


def test_averages(segmented):
    first = analysis.segment_averages(segmented).first()
    assert (first.segment, first.avg_n_transactions, first.avg_avg_spend) == (0, 2.0, 35.0 / 3)


def test_averages_need_their_columns(segmented):
    with pytest.raises(ValueError, match="avg_spend"):
        analysis.segment_averages(segmented.drop("avg_spend"))


def test_profile_counts_distinct_customers(segmented):
    doubled = segmented.union(segmented)
    assert [r.n_customers for r in analysis.segment_profile(doubled).collect()] == [3, 1]


def test_profile_without_features_is_the_count_alone(segmented):
    profile = analysis.segment_profile(segmented.select("customer_id", "segment"))
    assert profile.columns == ["segment", "n_customers"]


def test_top_customers_break_ties_by_id(segmented):
    top = analysis.top_customers(segmented, segment=0, n=2)
    assert [tuple(r) for r in top.collect()] == [("C2", 30.0, 0), ("C3", 30.0, 0)]
    assert analysis.top_customers(segmented, segment=7).isEmpty()


def test_top_customers_of_every_segment(segmented, rows):
    top = analysis.top_customers_per_segment(segmented, n=2)
    assert rows(top, "segment", "place", "customer_id") == [(0, 1, "C2"), (0, 2, "C3"), (1, 1, "C4")]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_many_top_customers_are_ranked_without_sorting_a_segment_in_one_task(spark, rows):
    """Beyond the size that Spark limits by group no window over a whole segment is planned."""
    df = spark.range(5000).selectExpr(
        "concat('C', id) AS customer_id", "cast(id % 900 AS double) AS total_spend",
        "cast(id % 2 AS int) AS segment",
    )
    few = analysis.top_customers_per_segment(df, 1000)
    many = analysis.top_customers_per_segment(df, 2000)
    plan = many._jdf.queryExecution().toString()
    assert "total_spend" not in plan.split("windowspecdefinition", 1)[-1].split("\n")[0]
    assert "WindowGroupLimit" in few._jdf.queryExecution().toString()
    assert many.count() == 4000
    assert rows(many.filter("place <= 1000"), *few.columns) == rows(few)


def test_spend_by_province(spark, rows):
    gold = spark.createDataFrame(
        [("a", 0, 0.1), ("a", 0, 0.2), ("b", 1, 5.0), ("b", 1, None)],
        "province string, segment int, total_payment double",
    )
    assert rows(analysis.spend_by_province(gold)) == [("a", 0, 0.3), ("b", 1, 5.0)]


def products(spark, *data):
    return spark.createDataFrame(list(data), PRODUCTS.ddl)


def test_gate_on_a_good_table(spark):
    row = gates.check_table(products(spark, ("P1", 1.0, "a"), ("P2", 1.0, "a")), PRODUCTS).first()
    assert tuple(row) == ("products", 2, 2, "", True)


def test_gate_sees_repeated_keys_missing_columns_and_emptiness(spark):
    df = products(spark, ("P1", 1.0, "a"), ("P1", 2.0, "b"))
    assert tuple(gates.check_table(df, PRODUCTS).first()) == ("products", 2, 1, "", False)
    row = gates.check_table(df.limit(1).drop("price", "category"), PRODUCTS).first()
    assert (row.missing_columns, row.ready) == ("price,category", False)
    row = gates.check_table(df.filter("false"), PRODUCTS).first()
    assert (row.n_rows, row.ready) == (0, False)


def test_gate_on_a_table_without_a_key(spark):
    df = spark.createDataFrame([("S", "c", "p")] * 2, SELLERS.ddl)
    assert gates.check_table(df, SELLERS).first().ready


def test_require_ready(spark):
    df = products(spark, ("P1", 1.0, "a"))
    assert gates.require_ready(df, PRODUCTS) is df
    with pytest.raises(gates.NotReady, match="empty"):
        gates.require_ready(df.filter("false"), PRODUCTS)
    with pytest.raises(gates.NotReady, match="price"):
        gates.require_ready(df.drop("price"), PRODUCTS)
