"""Orders kept as a star schema of Parquet files, seen as our raw and our silver tables.

Nations stand for cities and regions for provinces; events stand for reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.clean import dedup
from orderlake.schemas import BRONZE, Table
from orderlake.session import bound_tasks

# The status of a completed order and the columns we read from these files.
COMPLETED = "F"
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double",
    "events": "user_id bigint, event_type string, value double, ts timestamp_ntz",
}


def _read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A table; the shuffles that follow are divided by its size."""
    path = f"{directory}/{name}.parquet"
    bound_tasks(spark, path)
    return spark.read.schema(COLUMNS[name]).parquet(path)


def _places(spark: SparkSession, directory: str) -> DataFrame:
    nation, region = _read(spark, directory, "nation"), _read(spark, directory, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("province")
    )


def customers(spark: SparkSession, directory: str) -> DataFrame:
    return (
        _read(spark, directory, "customer")
        .join(_places(spark, directory), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.lit(None).cast("string").alias("postal_code"),
            "city",
            "province",
        )
    )


def products(spark: SparkSession, directory: str) -> DataFrame:
    return _read(spark, directory, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("category"),
    )


def transactions(spark: SparkSession, directory: str) -> DataFrame:
    """Order times carry no zone and stay so: no session setting can move them."""
    return _read(spark, directory, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_payment"),
        F.col("o_orderdate").alias("purchased_at"),
        F.col("o_orderstatus").alias("order_status"),
    )


def _items(spark: SparkSession, directory: str) -> DataFrame:
    return _read(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def _with_total(items: DataFrame) -> DataFrame:
    return items.withColumn("item_total", F.col("price"))


def raw_order_items(spark: SparkSession, directory: str) -> DataFrame:
    return _with_total(_items(spark, directory))


def order_items(spark: SparkSession, directory: str) -> DataFrame:
    """One item per order and product; the lowest price and quantity among copies.

    The total is added afterwards, so every branch of a query that reads items shuffles the same
    columns and Spark runs that shuffle once.
    """
    items = dedup(_items(spark, directory), ["order_id", "product_id"], ["price", "quantity"])
    return _with_total(items)


def sellers(spark: SparkSession, directory: str) -> DataFrame:
    return (
        _read(spark, directory, "supplier")
        .join(_places(spark, directory), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(F.col("s_suppkey").alias("seller_id"), "city", "province")
    )


def raw_reviews(spark: SparkSession, directory: str) -> DataFrame:
    return _read(spark, directory, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.col("value").alias("rating"),
        F.col("ts").cast("date").alias("review_date"),
    )


RAW = {
    "customers": customers,
    "products": products,
    "transactions": transactions,
    "order_items": raw_order_items,
    "reviews": raw_reviews,
    "sellers": sellers,
}


def raw_text(spark: SparkSession, directory: str, table: Table) -> DataFrame:
    """A raw table as its CSV files would hold it: every column of the contract, as text."""
    raw = RAW[table.name](spark, directory)
    return raw.select(
        *(
            (F.col(f.name) if f.name in raw.columns else F.lit(None)).cast("string").alias(f.name)
            for f in table.fields
        )
    )


def _extra(spark: SparkSession, directory: str, table: str) -> DataFrame | None:
    """A column that no contract names, by key."""
    if table == "customers":
        source = spark.read.parquet(f"{directory}/customer.parquet")
        return source.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("market"))
    if table == "products":
        source = spark.read.parquet(f"{directory}/part.parquet")
        return source.select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"))
    return None


def write_raw_csv(spark: SparkSession, directory: str, target: str) -> None:
    """All raw tables as CSV directories with the header names of source files.

    Customers and products carry a column that no contract names.
    """
    for table in BRONZE.values():
        raw = raw_text(spark, directory, table)
        names = [F.col(f.name).alias(f.source) for f in table.fields]
        extra = _extra(spark, directory, table.name)
        if extra is not None:
            raw = raw.join(extra, F.col(table.key[0]) == F.col("key").cast("string"))
            names.append(F.col(extra.columns[1]))
        raw.select(*names).write.mode("overwrite").option("header", True).csv(
            f"{target}/{table.name}"
        )
