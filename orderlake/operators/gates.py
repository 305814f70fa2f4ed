"""Readiness checks on a table before the next step reads it."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.schemas import FOREIGN_KEYS, Table


class NotReady(ValueError):
    """A table is missing, empty, or does not match its contract."""


def check_table(df: DataFrame, table: Table) -> DataFrame:
    """One row: row count, key count, missing columns, and whether the table is ready.

    Keys are counted from groups, so the most frequent key is reduced before the shuffle.
    """
    missing = [f.name for f in table.fields if not f.optional and f.name not in df.columns]
    key = [k for k in table.key if k in df.columns]
    if key:
        counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
        )
    else:
        counts = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_keys", F.col("n_rows"))
    return counts.select(
        F.lit(table.name).alias("table_name"),
        "n_rows",
        "n_keys",
        F.lit(",".join(missing)).alias("missing_columns"),
        ((F.col("n_rows") > 0) & (F.col("n_rows") == F.col("n_keys")) & F.lit(not missing))
        .alias("ready"),
    )


def wrong_types(df: DataFrame, table: Table) -> list[str]:
    """Columns that are there under another type than the contract's, as ``name:type``."""
    declared = dict(df.sparkSession.createDataFrame([], table.ddl).dtypes)
    return [f"{n}:{kind}" for n, kind in df.dtypes if n in declared and kind != declared[n]]


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row, ``n_orphans``: rows of ``df`` whose key no row of ``parent`` has; nulls are none.

    Rows are counted per key first, so a frequent key is one row in the join. The rows that do find
    their parent are counted and taken from all, because that is a join which Spark can filter at
    runtime by the parent's keys.
    """
    counted = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    known = parent.select(F.col(parent_key).alias("_key"))
    found = counted.join(known, "_key", "left_semi").agg(F.coalesce(F.sum("_n"), F.lit(0)))
    total = counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    both = total.unionByName(found.toDF("_total").select((-F.col("_total")).alias("_total")))
    return both.agg(F.sum("_total").alias("n_orphans"))


def _unreadable(spark: SparkSession, table: Table, state: str) -> DataFrame:
    return spark.createDataFrame(
        [(table.name, state, None, None, None, None, None, False)], _GATE
    )


# What ``gate`` returns.
_GATE = (
    "table_name string, state string, n_rows bigint, n_keys bigint, missing_columns string, "
    "wrong_types string, n_orphans bigint, ready boolean"
)


def gate(
    spark: SparkSession,
    path: str,
    table: Table,
    parents: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """One row on a stored table, whatever is there: nothing raises.

    ``state`` is ``absent`` (no such path), ``unreadable`` (no Parquet files that can be read),
    ``wrong columns``, ``wrong types``, ``empty``, ``repeated keys``, ``orphans`` or ``ready``, the
    first that holds. ``parents`` gives for a column the table, and its key, that must know each of
    the column's values; by default no column is looked up. Columns beyond the contract are allowed.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return _unreadable(spark, table, "absent")
    try:
        df = spark.read.parquet(path)
        counts = check_table(df, table).first()
    except (AnalysisException, PySparkException, Py4JJavaError):
        return _unreadable(spark, table, "unreadable")
    types = wrong_types(df, table)
    n_orphans = 0
    for column, (parent, key) in (parents or {}).items():
        if column in df.columns:
            n_orphans += orphans(df, column, parent, key).first()[0]
    if counts.missing_columns:
        state = "wrong columns"
    elif types:
        state = "wrong types"
    elif counts.n_rows == 0:
        state = "empty"
    elif counts.n_rows != counts.n_keys:
        state = "repeated keys"
    else:
        state = "orphans" if n_orphans else "ready"
    row = (
        table.name, state, counts.n_rows, counts.n_keys, counts.missing_columns,
        ",".join(types), n_orphans, state == "ready",
    )
    return spark.createDataFrame([row], _GATE)


def known_parents(
    table: Table, tables: Mapping[str, DataFrame], contracts: Mapping[str, Table]
) -> dict[str, tuple[DataFrame, str]]:
    """The parents of a table's columns, by ``schemas.FOREIGN_KEYS``, among the tables given."""
    return {
        column: (tables[parent], contracts[parent].key[0])
        for column, parent in FOREIGN_KEYS.get(table.name, ())
        if parent in tables
    }


def require_ready(df: DataFrame, table: Table) -> DataFrame:
    """``df`` itself if it has rows and the columns of ``table``; raises ``NotReady`` otherwise.

    Reads at most one row; use ``check_table`` to test the key as well.
    """
    missing = [f.name for f in table.fields if not f.optional and f.name not in df.columns]
    if missing:
        raise NotReady(f"{table.name} lacks columns {missing}")
    if df.isEmpty():
        raise NotReady(f"{table.name} is empty")
    return df
