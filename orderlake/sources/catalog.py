"""Catalog tables over the files of the lake."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.schemas import GOLD, Table, with_source_names


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def create_external_table(
    spark: SparkSession,
    database: str,
    table: Table,
    path: str,
    partition_by: Sequence[str] = (),
) -> str:
    """Declare a table of fixed types over existing Parquet files.

    A declaration that says the same already stays, and one of the same columns is switched to the
    new place in one step, so readers always find the table and its grants; another one is replaced.
    Dropping an external table leaves its files alone.
    """
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    return switch_table(
        spark, f"{database}.{table.name}", table, path, partitions, partition_by=partition_by
    )


def switch_table(
    spark: SparkSession,
    name: str,
    table: Table,
    path: str,
    layout: str = "",
    *,
    partition_by: Sequence[str] = (),
) -> str:
    """Make the table ``name`` show the files at ``path``, which lie there as ``layout`` says."""
    if spark.catalog.tableExists(name):
        if _same_columns(spark, name, table, partition_by) and _same_buckets(spark, name, layout):
            if not _lies_at(spark, name, path):
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                if partition_by:
                    _forget_partitions(spark, name)
            refresh(spark, name, partitioned=bool(partition_by))
            return name
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} ({table.ddl}) USING PARQUET {layout} LOCATION '{path}'")
    refresh(spark, name, partitioned=bool(partition_by))
    return name


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    return {
        r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    }


def _same_columns(
    spark: SparkSession, name: str, table: Table, partition_by: Sequence[str]
) -> bool:
    declared = spark.createDataFrame([], table.ddl).dtypes
    if sorted(spark.table(name).dtypes) != sorted(declared):
        return False
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return parts == list(partition_by)


def _same_buckets(spark: SparkSession, name: str, layout: str) -> bool:
    known = _details(spark, name).get("Num Buckets")
    return f" INTO {known} BUCKETS" in layout if known else " BUCKETS" not in layout


def _lies_at(spark: SparkSession, name: str, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path
    known = _details(spark, name).get("Location")
    return known is not None and (
        there(known).toUri().getPath() == there(path).toUri().getPath()
    )


def _forget_partitions(spark: SparkSession, name: str) -> None:
    """Drop the partitions that a table of another place knew; its files stay."""
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        spec = ", ".join(
            "{}='{}'".format(*part.split("=", 1)) for part in row.partition.split("/")
        )
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")


def create_source_view(
    spark: SparkSession, database: str, view: str, query: str, table: Table
) -> str:
    """A lasting view of a stored table, or of an SQL text, under the names of old reports."""
    columns = ", ".join(f"`{f.name}` AS `{f.source}`" for f in table.fields)
    name = f"{database}.{view}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {query}")
    return name


def flat_orders_sql(tables: Mapping[str, str]) -> str:
    """The join of ``operators.completed.flat_orders`` over catalog tables, for a lasting view.

    ``tables`` has the full name of each silver table.
    """
    return f"""(
        SELECT o.order_id, i.product_id, o.customer_id, c.province, i.price, o.total_payment,
               p.category, o.order_status, o.purchased_at
        FROM {tables['transactions']} o
        JOIN {tables['order_items']} i ON o.order_id = i.order_id
        LEFT JOIN {tables['customers']} c ON o.customer_id = c.customer_id
        LEFT JOIN {tables['products']} p ON i.product_id = p.product_id
    )"""


def refresh(spark: SparkSession, name: str, partitioned: bool = False) -> None:
    """Make files written since the last look visible; partitions are looked up first."""
    if partitioned:
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def find_tables(spark: SparkSession, database: str, pattern: str = "*") -> list[str]:
    """Stored tables of a database; the listing also holds session views, which are left out."""
    return sorted(t.name for t in spark.catalog.listTables(database, pattern) if not t.isTemporary)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise ValueError(f"no table {name}")
    return spark.table(name)


def table_overview(spark: SparkSession, database: str, pattern: str = "*") -> DataFrame:
    """Name, schema and row count of every matching table."""
    names = find_tables(spark, database, pattern)
    if not names:
        raise ValueError(f"no table in {database} matches {pattern}")

    def overview(name: str) -> DataFrame:
        df = spark.table(f"{database}.{name}")
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(df.schema.simpleString()).alias("schema"), "n_rows"
        )

    return reduce(DataFrame.unionByName, map(overview, names))


def register_views(tables: Mapping[str, DataFrame], source_names: bool = False) -> list[str]:
    """A session view ``<table>_view`` per table, optionally under the column names of old reports."""
    views = []
    for name, df in tables.items():
        view = f"{name}_view"
        (with_source_names(df, GOLD[name]) if source_names else df).createOrReplaceTempView(view)
        views.append(view)
    return views
