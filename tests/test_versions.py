"""Tables as versions: a reader finds the old one or the new one, whole."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.plans.etl import publish, publish_silver
from orderlake.sources import catalog, lake as lakes
from orderlake.sources.lake import Lake

TABLE = schemas.CITY_METRICS


def cities(spark, n):
    return spark.createDataFrame([("p", f"c{i}", 1, 1.0, 1.0) for i in range(n)], TABLE.ddl)


@pytest.fixture
def shop(spark, tmp_path):
    lake = Lake(str(tmp_path), f"versions_{tmp_path.name}".replace("-", "_"), f"{tmp_path}/catalog")
    catalog.create_database(spark, lake.database, lake.database_location)
    yield lake
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")


def test_a_run_that_dies_before_the_switch_changes_nothing(spark, shop, monkeypatch):
    publish(spark, shop, "gold", cities(spark, 2), TABLE)

    def killed(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(lakes, "commit_version", killed)
        with pytest.raises(RuntimeError):
            publish(spark, shop, "gold", cities(spark, 5), TABLE)
    # the files of the second run are all there, and nobody reads them
    folder = Path(shop.folder("gold", TABLE.name))
    assert len(list(folder.glob("v*/part-*"))) >= 2
    assert shop.read(spark, "gold", TABLE).count() == 2
    assert spark.table(f"{shop.database}.{TABLE.name}").count() == 2
    publish(spark, shop, "gold", cities(spark, 3), TABLE)
    assert shop.read(spark, "gold", TABLE).count() == 3


def test_a_run_that_dies_while_it_writes_changes_nothing(spark, shop):
    publish(spark, shop, "gold", cities(spark, 2), TABLE)
    broken = cities(spark, 3).withColumn(
        "total_spend", F.when(F.col("city") == "c2", F.raise_error(F.lit("bad"))).otherwise(1.0)
    )
    with pytest.raises(Exception, match="bad"):
        publish(spark, shop, "gold", broken, TABLE)
    assert shop.read(spark, "gold", TABLE).count() == 2


def test_readers_keep_their_version_and_old_ones_go(spark, shop):
    first = publish(spark, shop, "gold", cities(spark, 1), TABLE)
    second = publish(spark, shop, "gold", cities(spark, 2), TABLE)
    assert (first.count(), second.count()) == (1, 2)
    for n in (3, 4):
        publish(spark, shop, "gold", cities(spark, n), TABLE)
    folder = Path(shop.folder("gold", TABLE.name))
    assert sorted(p.name[:9] for p in folder.glob("v*")) == ["v00000003", "v00000004"]
    assert spark.table(f"{shop.database}.{TABLE.name}").count() == 4


def test_a_table_is_never_missing_from_the_catalog(spark, shop):
    """While versions are published one after the other every read finds a whole one."""
    publish(spark, shop, "gold", cities(spark, 1), TABLE)
    name = f"{shop.database}.{TABLE.name}"
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_note' = 'kept')")
    with ThreadPoolExecutor(1) as pool:
        writing = pool.submit(
            lambda: [publish(spark, shop, "gold", cities(spark, n), TABLE) for n in (2, 3, 4)]
        )
        seen = []
        while not writing.done():
            assert spark.catalog.tableExists(name)
            seen.append(shop.read(spark, "gold", TABLE).count())
        writing.result()
    assert seen == sorted(seen) and set(seen) <= {1, 2, 3, 4}
    assert "owner_note" in str(spark.sql(f"SHOW TBLPROPERTIES {name}").collect())


def test_two_runs_at_a_time_leave_one_whole_version(spark, shop):
    folder = shop.folder("gold", TABLE.name)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: lakes.publish_files(spark, cities(spark, n), folder, TABLE), (1, 2, 3, 4)))
    current = lakes.current_version(spark, folder)
    assert shop.path("gold", TABLE.name) == f"{folder}/{current}"
    assert shop.read(spark, "gold", TABLE).count() in (1, 2, 3, 4)
    assert len({p.name for p in Path(folder).glob("v*")}) == 4


def test_the_folders_of_dead_runs_are_cleaned(spark, shop):
    folder = shop.folder("gold", TABLE.name)
    dead = lakes.next_version(spark, folder)
    cities(spark, 1).write.parquet(lakes.version_path(folder, dead))
    assert lakes.current_version(spark, folder) is None
    for n in (1, 2, 3):
        lakes.publish_files(spark, cities(spark, n), folder, TABLE)
    assert [v[:9] for v in lakes.clean_versions(spark, folder, keep=2)] == ["v00000001", "v00000002"]
    assert lakes.clean_versions(spark, folder, keep=2) == []
    assert lakes.current_version(spark, folder)[:9] == "v00000004"


def test_a_table_without_versions_is_read_as_it_is(spark, shop):
    lakes.write_table(cities(spark, 2), shop.path("gold", TABLE.name), TABLE)
    assert shop.path("gold", TABLE.name) == shop.folder("gold", TABLE.name)
    assert shop.read(spark, "gold", TABLE).count() == 2


def test_a_lasting_view_follows_silver_versions(spark, shop):
    table = schemas.SELLERS
    rows = [("S1", "a", "b"), ("S2", "a", "b")]
    publish_silver(spark, shop, spark.createDataFrame(rows[:1], table.ddl), table)
    name = catalog.create_external_table(
        spark, shop.database, table, shop.path("silver", table.name)
    )
    view = catalog.create_source_view(spark, shop.database, "old_sellers", name, table)
    for _ in range(4):
        publish_silver(spark, shop, spark.createDataFrame(rows, table.ddl), table)
        assert spark.table(view).count() == 2


def test_partitioned_versions_switch_with_their_partitions(spark, shop, rows):
    table = schemas.CUSTOMER_SEGMENTS

    def batch(*data):
        return spark.createDataFrame([(c, 1, 1.0, 1.0, 1, s) for c, s in data], table.ddl)

    publish(spark, shop, "gold", batch(("C1", 0), ("C2", 1)), table, ["segment"])
    name = f"{shop.database}.{table.name}"
    assert rows(spark.table(name), "customer_id", "segment") == [("C1", 0), ("C2", 1)]
    publish(spark, shop, "gold", batch(("C3", 1), ("C4", 2)), table, ["segment"])
    assert rows(spark.table(name), "customer_id", "segment") == [("C3", 1), ("C4", 2)]
    assert "PartitionFilters: [isnotnull(segment" in (
        spark.table(name).filter("segment = 2")._jdf.queryExecution().executedPlan().toString()
    )
