from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlake.operators.ranking import ntile_of, with_ntile, with_rank

def order():
    return [F.desc("v"), F.asc("id")]


def frame(spark, values, groups=None):
    groups = groups or ["g"] * len(values)
    data = [(i, v, g) for i, (v, g) in enumerate(zip(values, groups))]
    return spark.createDataFrame(data, "id int, v double, g string")


@pytest.mark.parametrize("buckets", [1, 3, 4])
@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0, 3.0],
        [7.0] * 5,
        [float(i % 3) for i in range(50)],
        [None, 1.0, None, 2.0, 2.0, None],
        [float(i * 37 % 1003) for i in range(1003)],
    ],
)
def test_ntile_equals_the_window_function(spark, rows, values, buckets):
    df = frame(spark, values).repartition(4)
    expected = df.withColumn("bucket", F.ntile(buckets).over(Window.orderBy(*order())))
    assert rows(with_ntile(df, order(), buckets), "id", "bucket") == rows(expected, "id", "bucket")


def test_ntile_arithmetic_for_every_small_size(spark):
    df = (
        spark.range(1, 41).withColumnRenamed("id", "n")
        .withColumn("r", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    )
    by_size = Window.partitionBy("n").orderBy("r")
    wrong = df.withColumn("ours", ntile_of("r", "n", 4)).withColumn("theirs", F.ntile(4).over(by_size))
    assert wrong.filter("ours <> theirs").isEmpty()


def test_ntile_of_no_rows(spark):
    assert with_ntile(frame(spark, [1.0]).filter("id < 0"), order(), 4).isEmpty()


def test_rank_within_groups_equals_row_number(spark, rows):
    n = 3000
    # a third of all rows in one group, a null group, and many small ones
    groups = ["hot" if i % 3 == 0 else None if i % 3 == 1 else f"g{i % 97}" for i in range(n)]
    df = frame(spark, [float(i * 31 % 50) for i in range(n)], groups).repartition(4)
    within = Window.partitionBy("g").orderBy(*order())
    expected = df.withColumn("rank", F.row_number().over(within)).withColumn(
        "size", F.count(F.lit(1)).over(Window.partitionBy("g"))
    )
    ours = with_rank(df, order(), ["g"], group_size="size")
    assert rows(ours) == rows(expected, *ours.columns)


def test_a_hot_group_is_spread_over_tasks(spark):
    df = spark.range(200_000).select(
        F.col("id"), (F.col("id") % 1000).cast("double").alias("v"), F.lit("hot").alias("g")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = with_rank(df, order(), ["g"])
        per_task = [r[0] for r in ranked.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert max(per_task) < 150_000
    assert ranked.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first() == (
        200_000, 1, 200_000,
    )


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    data=st.lists(
        st.tuples(st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, 0.0, 1.0, 2.5])),
        min_size=1, max_size=40,
    )
)
def test_rank_property(spark, rows, data):
    df = frame(spark, [v for _, v in data], [g for g, _ in data]).repartition(3)
    within = Window.partitionBy("g").orderBy(*order())
    expected = df.withColumn("rank", F.row_number().over(within))
    assert rows(with_rank(df, order(), ["g"])) == rows(expected)
