"""Paths of the lake, and reading and writing its tables.

A published table is a folder of versions. A run takes the next name, writes its files into a folder
of that name, and commits by creating one empty marker named alike; readers take the last marker. Creating a file is all or nothing on every file system Spark writes, so a reader
finds either the old version or the new one, and a run that dies before the marker changes nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlake.schemas import Table, conform


@dataclass(frozen=True)
class Lake:
    """A lake below ``root`` (any file system Spark reads) with its catalog database."""

    root: str
    database: str = "analytics"
    database_location: str | None = None

    def path(self, layer: str, table: str) -> str:
        """Where the files of a table are now: its current version, or its folder without one."""
        folder = self.folder(layer, table)
        version = current_version(SparkSession.active(), folder)
        return folder if version is None else version_path(folder, version)

    def folder(self, layer: str, table: str) -> str:
        """The folder of a table, which holds its versions."""
        return f"{self.root}/{layer}/{table}"

    @property
    def models(self) -> str:
        """Where the stored models are now."""
        folder = self.models_folder
        version = current_version(SparkSession.active(), folder)
        return folder if version is None else version_path(folder, version)

    @property
    def models_folder(self) -> str:
        return f"{self.root}/models"

    def read(
        self, spark: SparkSession, layer: str, table: Table, extras: bool = False
    ) -> DataFrame:
        """A Parquet table with its declared schema; no file is opened to find the schema.

        With ``extras`` the columns that the files hold beyond the contract follow, as text; that
        takes a look at the files.
        """
        path = self.path(layer, table.name)
        if extras:
            table = table.extended(spark.read.parquet(path).columns)
        return spark.read.schema(table.ddl).parquet(path)


# Versions

_MARKERS = "_versions"
KEPT_VERSIONS = 2


def _place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _children(spark: SparkSession, path: str) -> list[str]:
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return [status.getPath().getName() for status in system.listStatus(place)]


def _create(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.create(place, True).close()


def _versions(names: list[str]) -> list[str]:
    return sorted(n for n in names if re.fullmatch(r"v\d{8}-[0-9a-f]{12}", n))


def version_path(folder: str, version: str) -> str:
    return f"{folder}/{version}"


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The last committed version of a table, or None if it has none."""
    return max(_versions(_children(spark, f"{folder}/{_MARKERS}")), default=None)


def next_version(spark: SparkSession, folder: str) -> str:
    """A name that comes after all others and that no other run has.

    Two runs at a time may get one number but never one name; if both commit, the name that comes
    last is current, and either is whole.
    """
    known = _versions(_children(spark, folder) + _children(spark, f"{folder}/{_MARKERS}"))
    number = int(known[-1][1:9]) + 1 if known else 1
    return f"v{number:08d}-{uuid.uuid4().hex[:12]}"


def commit_version(spark: SparkSession, folder: str, version: str) -> None:
    """Make a version the current one; from here on readers find it."""
    _create(spark, f"{folder}/{_MARKERS}/{version}")


def clean_versions(spark: SparkSession, folder: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Delete what is older than the last ``keep`` committed versions; returns the names deleted.

    That includes folders of runs that died. Jobs that still read an old version, or write one that
    others overtake, need ``keep`` to cover the runs that end meanwhile. Markers go before the files
    they name.
    """
    committed = _versions(_children(spark, f"{folder}/{_MARKERS}"))
    oldest = committed[-keep] if len(committed) >= keep else ""
    old = [v for v in _versions(_children(spark, folder)) if v < oldest]
    for v in [v for v in committed if v < oldest]:
        system, place = _place(spark, f"{folder}/{_MARKERS}/{v}")
        system.delete(place, False)
    for v in old:
        system, place = _place(spark, version_path(folder, v))
        system.delete(place, True)
    return old


def publish_files(
    spark: SparkSession,
    df: DataFrame,
    folder: str,
    table: Table | None = None,
    *,
    partition_by: Sequence[str] = (),
) -> str:
    """Write ``df`` as the next version of the table in ``folder`` and commit it; returns its path.

    Old versions stay until ``clean_versions``.
    """
    version = next_version(spark, folder)
    path = version_path(folder, version)
    writer = (conform(df, table) if table else df).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    commit_version(spark, folder, version)
    return path


def replace_partitions(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    table: Table,
    by: str,
    values: Sequence[str | None],
) -> None:
    """Replace the partitions of the given values; all others stay untouched.

    Dynamic overwrite replaces those that ``df`` has rows for; the others of ``values`` are deleted.
    Which ones have rows is noted while they are written.
    """
    seen = Observation(f"partitions of {table.name}")
    found = F.collect_set(F.coalesce(F.col(by), F.lit(_NO_VALUE))).alias("found")
    write_table(df.observe(seen, found), path, table, partition_by=[by], dynamic=True)
    named = {_NO_VALUE if v is None else v for v in values}
    for value in named - set(seen.get["found"]):
        system, place = _place(spark, f"{path}/{by}={value}")
        system.delete(place, True)


# The folder of a null, which is Hive's.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


# Work that has begun, so that the next run can finish it


def note_pending(spark: SparkSession, folder: str, values: Sequence[str | None]) -> None:
    """Remember values whose partitions are about to be replaced."""
    for value in values:
        _create(spark, f"{folder}/{_NO_VALUE if value is None else value}")


def pending(spark: SparkSession, folder: str) -> list[str | None]:
    """Values of runs that have not ended."""
    return [None if name == _NO_VALUE else name for name in sorted(_children(spark, folder))]


def clear_pending(spark: SparkSession, folder: str, values: Sequence[str | None]) -> None:
    for value in values:
        system, place = _place(spark, f"{folder}/{_NO_VALUE if value is None else value}")
        system.delete(place, False)


def write_table(
    df: DataFrame,
    path: str,
    table: Table | None = None,
    *,
    partition_by: Sequence[str] = (),
    dynamic: bool = False,
) -> None:
    """Overwrite ``path`` with ``df`` as Parquet, checked against ``table`` if one is given.

    With ``partition_by`` and ``dynamic`` only the partitions present in ``df`` are replaced.
    """
    writer = (conform(df, table) if table else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
