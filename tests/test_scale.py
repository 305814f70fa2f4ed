"""Work that must stay small per task, or be done once, however large the tables are."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import queries
from orderlake import schemas, session
from orderlake.operators import clean, quarantine, segments
from orderlake.sources import starschema as star

SETTINGS = (
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
    "spark.sql.files.maxPartitionBytes",
)


@pytest.fixture
def settings(spark):
    """Reads the settings that sizes change; they are as before afterwards."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    yield lambda: [spark.conf.get(key, None) for key in SETTINGS]
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def tables(spark, tmp_path):
    """A small star schema; every seventh item comes twice."""
    data = {
        "region": [(0, "R0"), (1, "R1")],
        "nation": [(n, f"N{n}", n % 2) for n in range(4)],
        "customer": [(c, f"C{c}", c % 4, "M") for c in range(60)],
        "part": [(p, f"T{p % 3}", 1.0 + p, "B") for p in range(20)],
    }
    ddl = {
        "customer": star.COLUMNS["customer"] + ", c_mktsegment string",
        "part": star.COLUMNS["part"] + ", p_brand string",
    }
    for name, rows in data.items():
        frame = spark.createDataFrame(rows, ddl.get(name, star.COLUMNS[name]))
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    spark.range(200).selectExpr(
        "id o_orderkey", "id % 60 o_custkey", "if(id % 2 = 0, 'F', 'O') o_orderstatus",
        "id * 1.5D o_totalprice", "timestamp_ntz'1995-01-01' + make_interval(0, 0, 0, id) o_orderdate",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(700).selectExpr(
        "id % 200 l_orderkey", "(id - if(id % 7 = 0, 200, 0) + 200) % 20 l_partkey",
        "1.0D + id % 5 l_quantity", "2.5D * (1 + id % 9) l_extendedprice",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_shuffles_are_divided_by_the_size_of_the_table(spark, tables, settings, monkeypatch):
    before, small = settings(), sorted(queries.order_totals(spark, tables).collect())
    assert settings() == before
    monkeypatch.setattr(session, "TASK_INPUT_BYTES", 100)
    size = session.input_bytes(spark, f"{tables}/lineitem.parquet")
    assert sorted(queries.order_totals(spark, tables).collect()) == small
    partitions, advisory, _, scanned = settings()
    assert int(partitions) == -(-size // 100)
    assert (int(advisory), int(scanned)) == (session.TASK_SHUFFLED_BYTES, session.TASK_SCAN_BYTES)
    # a smaller table does not take them back
    star.customers(spark, tables)
    assert settings()[0] == partitions


def test_smaller_tasks_of_the_session_stay(spark, tables, settings, monkeypatch):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2m")
    monkeypatch.setattr(session, "TASK_INPUT_BYTES", 100)
    star.order_items(spark, tables)
    assert settings()[1] == "1m" and settings()[3] == "2m"


def test_a_batch_sums_its_items_once(spark, tables, tmp_path, monkeypatch):
    from orderlake.plans import refresh

    plans, store = [], refresh.replace_partitions
    monkeypatch.setattr(
        refresh,
        "replace_partitions",
        lambda spark, df, *rest: (
            plans.append(df._jdf.queryExecution().optimizedPlan().toString()),
            store(spark, df, *rest),
        ),
    )
    orders, items = queries._orders_and_items(spark, tables)
    lake = queries.Lake(f"{tmp_path}/lake", "summed_once", f"{tmp_path}/lake/catalog")
    queries._dimensions(spark, tables, lake)
    made = refresh.refresh(spark, lake, orders, items, grain="month")
    # orders, items, and four tables of partial results
    assert len(plans) == 6
    computed = ("Window", "count(1) AS n_rows", "count(product_id")
    assert not [c for c in computed for p in plans if c in p]
    assert made["customer_metrics"].count() == 60


def test_fixed_points_are_told_from_moved_centres(spark):
    rng = np.random.default_rng(3)
    data = [
        (f"C{i}", int(n), float(s), float(s / n), int(n))
        for i, (n, s) in enumerate(zip(rng.integers(1, 90, 120), rng.random(120) * 1000))
    ]
    ddl = (
        "customer_id string, n_transactions bigint, total_spend double, avg_spend double, "
        "n_distinct_products bigint"
    )
    prepared, _ = segments.prepare_features(spark.createDataFrame(data, ddl))
    fixed = segments.train_kmeans(prepared, 3, tol=0.0, max_iter=200)
    assert segments.fixed_point(fixed, prepared) == (0, True)

    class Swapped:
        """Says of every row a cluster that is not its own."""

        def clusterCenters(self):
            return fixed.clusterCenters()

        def transform(self, df):
            return fixed.transform(df).withColumn("cluster", (prediction + 1) % 3)

    prediction = F.col("cluster")
    assert isinstance(fixed, KMeansModel)
    assert segments.fixed_point(Swapped(), prepared) == (120, False)
    # one step only: counted as numpy counts
    early = segments.train_kmeans(prepared, 3, tol=0.0, max_iter=1)
    x = np.array(
        [r[0] for r in prepared.select(vector_to_array("scaled_features")).collect()]
    )
    centers = np.array(early.clusterCenters())
    own = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
    means = [np.allclose(x[own == c].mean(0), centers[c], atol=1e-6) for c in set(own)]
    assert segments.fixed_point(early, prepared) == (0, all(means))
    prepared.unpersist()


def test_gates_clean_the_items_once(spark, tables, monkeypatch):
    plans = []
    written = queries.write_table
    monkeypatch.setattr(
        queries,
        "write_table",
        lambda df, *rest: (
            plans.append(df._jdf.queryExecution().optimizedPlan().toString()),
            written(df, *rest),
        ),
    )
    found = {r.place: r for r in queries.full_gates(spark, tables).collect()}
    assert not any("Window" in p for p in plans[:5])
    assert {place: r.state for place, r in found.items()} == {
        "orphaned": "orphans", "good": "ready", "retyped": "wrong types", "cut": "wrong columns",
        "empty": "empty", "repeated": "repeated keys", "absent": "absent",
        "unreadable": "unreadable",
    }
    assert found["good"].n_rows == found["good"].n_keys > 0


def test_only_rejected_rows_are_written_out_as_records(spark):
    raw = spark.createDataFrame(
        [("O1", "P1", "1.5", "1", "1.5"), ("O1", "P1", "2", "1", "2"), ("O2", "P1", "x", "1", "2")],
        "order_id string, product_id string, price string, quantity string, item_total string",
    )
    _, rejected = quarantine.cleaned_and_rejected(raw, schemas.ORDER_ITEMS, clean.clean_order_items)
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    # plans are written from the last step to the first
    assert plan.rindex("AS record") < plan.index("Join")
    assert sorted((r.problems, r.dropped) for r in rejected.collect()) == [
        ("dropped copy", True), ("malformed price", False),
    ]
