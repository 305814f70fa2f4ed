"""Raw CSV tables as text columns under our names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderlake.schemas import BROKEN, Table, require_columns


def read_bronze(
    spark: SparkSession, path: str, table: Table, multi_line: bool = False
) -> DataFrame:
    """A directory of CSV files with headers; every value stays text, every column stays.

    Columns are found by header name. ``enforceSchema=false`` makes a file whose header differs
    from the first one fail instead of shifting its values into the wrong columns. The column
    ``schemas.BROKEN`` holds the whole text of a record whose fields do not match the header and is
    null otherwise. ``multi_line`` reads line breaks within quotes, at the price that a file is no
    longer split between tasks.
    """
    options = {"header": True, "enforceSchema": False, "multiLine": multi_line}
    names = spark.read.options(header=True, multiLine=multi_line).csv(path).columns
    schema = StructType([StructField(n, StringType()) for n in [*names, BROKEN]])
    reader = spark.read.options(**options, columnNameOfCorruptRecord=BROKEN).schema(schema)
    return rename_source(reader.csv(path), table)


def rename_source(raw: DataFrame, table: Table) -> DataFrame:
    """A frame with raw file names under our names: the columns of ``table``, then all others.

    Another column that bears one of our names gets ``source_`` in front.
    """
    require_columns(raw, (f.source for f in table.fields if not f.optional), f"raw {table.name}")
    named = {f.source: f.name for f in table.fields}
    ours = [F.col(f"`{f.source}`").alias(f.name) for f in table.fields if f.source in raw.columns]
    others = [
        F.col(f"`{c}`").alias(f"source_{c}" if c in table.columns else c)
        for c in raw.columns
        if c not in named
    ]
    return raw.select(*ours, *others)
