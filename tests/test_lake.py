from __future__ import annotations

import csv
import os
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderlake import schemas, session
from orderlake.__main__ import main
from orderlake.operators.gates import NotReady
from orderlake.operators.segments import SegmentModel
from orderlake.plans.etl import bronze_to_silver, silver_to_gold
from orderlake.plans.report import segment_report
from orderlake.plans.segmentation import run_segmentation
from orderlake.sources import catalog
from orderlake.sources.lake import Lake, write_table


def write_csv(folder, table, records):
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / "part-0.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow([f.source for f in table.fields])
        for r in records:
            writer.writerow([r.get(f.name, "") for f in table.fields])


def fill_bronze(root, n_customers=60, payment=100):
    """A small shop: every seventh order is open, some values are malformed, some rows repeat."""
    rng = random.Random(5)
    customers = [
        {"customer_id": f"C{i:03d}", "postal_code": f"{i:05d}" if i % 4 else "",
         "city": f" City {i % 6} ", "province": f"Province {i % 3}"}
        for i in range(n_customers)
    ]
    products = [
        {"product_id": f"P{i}", "price": str(10 + i), "category": f"cat{i % 3}"} for i in range(12)
    ]
    orders, items = [], []
    for i in range(n_customers * 4):
        orders.append(
            {"order_id": f"O{i:04d}", "customer_id": f"C{i % n_customers:03d}",
             "total_payment": str(payment), "installments": "1",
             "purchased_at": f"2024-{i % 12 + 1:02d}-01 10:00:00", "approved_at": "bad",
             "estimated_arrival": "2024-12-31",
             "order_status": "Selesai" if i % 7 else "Dikirim"}
        )
        for p in rng.sample(range(12), 3):
            price = (10 + p) * (1 + (i % n_customers) ** 2)
            items.append(
                {"order_id": f"O{i:04d}", "product_id": f"P{p}", "price": str(price),
                 "quantity": "1", "item_total": str(price)}
            )
    reviews = [{"customer_id": "C001", "product_id": "P1", "rating": "5", "review_date": "2024-01-01"}]
    sellers = [{"seller_id": "S1", "city": "Medan", "province": "Sumatera Utara"}]
    data = {
        "customers": customers + customers[:3], "products": products, "transactions": orders,
        "order_items": items + items[:5], "reviews": reviews * 2, "sellers": sellers,
    }
    for name, records in data.items():
        write_csv(root / "bronze" / name, schemas.BRONZE[name], records)
    return data


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    data = fill_bronze(root)
    lake = Lake(str(root), "shop", str(root / "catalog"))
    bronze_to_silver(spark, lake)
    gold = silver_to_gold(spark, lake)
    result = run_segmentation(spark, lake, max_k=4)
    return lake, data, gold, result


def test_silver_is_typed_and_unique(spark, shop):
    lake, data, *_ = shop
    for name, table in schemas.BRONZE.items():
        stored = spark.read.parquet(lake.path("silver", name))
        assert stored.dtypes == spark.createDataFrame([], table.ddl).dtypes, name
    assert spark.read.parquet(lake.path("silver", "customers")).count() == 60
    assert spark.read.parquet(lake.path("silver", "order_items")).count() == len(data["order_items"]) - 5
    assert spark.read.parquet(lake.path("silver", "reviews")).count() == 1


def test_gold_tables_follow_their_contracts(spark, shop):
    lake, _, gold, _ = shop
    for name, df in gold.items():
        stored = spark.read.parquet(lake.path("gold", name))
        assert stored.dtypes == spark.createDataFrame([], schemas.GOLD[name].ddl).dtypes, name
        assert stored.count() == spark.table(f"shop.{name}").count() == df.count() > 0
    assert spark.table("customer_metrics_view").count() == 60


def test_tables_are_found_by_pattern(spark, shop):
    assert catalog.find_tables(spark, "shop", "*_metrics") == [
        "city_metrics", "customer_metrics", "product_metrics", "province_metrics",
        "transaction_metrics",
    ]
    overview = {r.table_name: r for r in catalog.table_overview(spark, "shop").collect()}
    assert overview["customer_metrics"].n_rows == 60
    assert "tier:string" in overview["customer_metrics"].schema
    with pytest.raises(ValueError):
        catalog.read_table(spark, "shop.nothing")
    with pytest.raises(ValueError):
        catalog.table_overview(spark, "shop", "nothing*")


def test_segments_are_stored_with_fixed_types(spark, shop):
    table = spark.table("shop.customer_segments")
    assert dict(table.dtypes) == {
        "customer_id": "string", "n_transactions": "bigint", "total_spend": "double",
        "avg_spend": "double", "n_distinct_products": "bigint", "segment": "int",
    }
    assert table.count() == table.select("customer_id").distinct().count() == 60


def test_stored_model_repeats_the_stored_segments(spark, shop, rows):
    lake, *_ = shop
    model = SegmentModel.load(lake.models)
    customers = lake.read(spark, "gold", schemas.CUSTOMER_METRICS)
    assert rows(model.assign(customers), "customer_id", "segment") == rows(
        spark.table("shop.customer_segments"), "customer_id", "segment"
    )


def test_gold_segments_have_one_row_per_customer(spark, shop):
    gold = spark.table("shop.gold_segments")
    assert gold.count() == 60
    assert dict(gold.dtypes)["n_orders"] == "int"
    total = gold.agg(F.sum("total_payment")).first()[0]
    assert total == 100.0 * sum(1 for i in range(240) if i % 7)


def test_report(spark, shop):
    lake, *_ = shop
    report = segment_report(spark, lake, top=2)
    assert sum(r.n_customers for r in report["segment_counts"].collect()) == 60
    assert report["top_customers"].count() == 2
    per_segment = report["top_customers_per_segment"].groupBy("segment").count().collect()
    assert all(r["count"] <= 2 for r in per_segment)
    assert {r.province for r in report["spend_by_province"].collect()} == {
        "Province 0", "Province 1", "Province 2",
    }


def test_views_under_the_names_of_old_reports(spark, shop):
    gold = spark.table("shop.gold_segments")
    assert catalog.register_views({"gold_segments": gold}, source_names=True) == ["gold_segments_view"]
    by_place = spark.table("gold_segments_view").groupBy("provinsi_pelanggan", "segment")
    assert by_place.sum("total_pembayaran").agg({"sum(total_pembayaran)": "sum"}).first()[0] == 20_500.0


def test_malformed_values_are_reported(spark, tmp_path):
    fill_bronze(tmp_path, n_customers=10)
    counts = bronze_to_silver(spark, Lake(str(tmp_path)))
    found = {(r.table_name, r.problem): (r.n_checked, r.n_found) for r in counts.collect()}
    assert found["transactions", "malformed approved_at"] == (40, 40)
    assert found["transactions", "malformed purchased_at"] == (40, 0)
    assert found["order_items", "malformed price"] == (125, 0)
    assert found["customers", "broken record"] == (13, 0)


def test_broken_records_and_null_keys_are_counted_and_extra_columns_kept(spark, tmp_path, rows):
    fill_bronze(tmp_path, n_customers=10)
    folder = tmp_path / "bronze" / "products"
    for file in folder.glob("*.csv"):
        file.unlink()
    lines = [
        "id_produk,harga,kategori_produk,berat,rank_in_category",
        "P0,1.5,A,10,x",
        "P1,2.5,A,20,x,too,many",
        "P2,3.5",
        'P3,4.5,"broken',
        'line",30,x',
        ",5.5,B,40,x",
        ",6.5,B,50,x",
    ]
    (folder / "part.csv").write_text("\n".join(lines) + "\n")
    lake = Lake(str(tmp_path), "extra", str(tmp_path / "catalog"))
    found = {
        r.problem: (r.n_checked, r.n_found)
        for r in bronze_to_silver(spark, lake).filter("table_name = 'products'").collect()
    }
    assert found["broken record"] == (8 - 1, 4)
    assert found["null key"] == (7, 2)
    kept = lake.read(spark, "silver", schemas.PRODUCTS, extras=True)
    assert kept.columns == [*schemas.PRODUCTS.columns, "berat", "rank_in_category"]
    assert ("P0", "10", "x") in rows(kept, "product_id", "berat", "rank_in_category")
    gold = silver_to_gold(spark, lake)["product_metrics"]
    # a column that bears the name of a measure is marked
    assert gold.columns[-2:] == ["berat", "product_rank_in_category"]
    assert spark.table("extra.product_metrics").columns == gold.columns
    whole = bronze_to_silver(spark, lake, multi_line=True).filter("problem = 'broken record'")
    assert {r.table_name: r.n_found for r in whole.collect()}["products"] == 2


def test_steps_run_from_the_command_line(spark, tmp_path, capsys):
    fill_bronze(tmp_path, n_customers=15)
    options = [f"--root={tmp_path}", "--database=cli", f"--database-location={tmp_path}/catalog"]
    for step in ("silver", "gold", "segments"):
        main([step, *options, "--max-k=3"], spark)
    main(["report", *options], spark)
    shown = capsys.readouterr().out
    assert "segment_counts" in shown and "spend_by_province" in shown
    assert spark.table("cli.customer_segments").count() == 15


def test_each_step_runs_in_a_process_of_its_own(tmp_path):
    fill_bronze(tmp_path, n_customers=15)
    shown = ""
    for step in ("silver", "gold", "segments", "report"):
        command = [sys.executable, "-m", "orderlake", step, f"--root={tmp_path}", "--max-k=3"]
        command.append(f"--database-location={tmp_path}/catalog")
        run = subprocess.run(
            command,
            cwd=tmp_path,
            env=os.environ
            | {
                "PYTHONPATH": str(Path(__file__).resolve().parent.parent),
                "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false "
                f"--conf spark.checkpoint.dir={tmp_path}/shared pyspark-shell",
            },
            capture_output=True,
            text=True,
            timeout=300,
        )
        assert run.returncode == 0, run.stderr[-2000:]
        shown += run.stdout
    assert "null key" in shown and "spend_by_province" in shown


def test_lasting_views_of_old_reports(spark, shop):
    view = spark.table("shop.gold_segmentasi_pelanggan")
    assert view.columns == [f.source for f in schemas.GOLD_SEGMENTS.fields]
    assert view.agg(F.sum("total_pembayaran")).first()[0] == 20_500.0
    flat = spark.table("shop.bronze_pelanggan")
    assert flat.columns == [f.source for f in schemas.FLAT_ORDERS.fields]
    assert flat.count() == spark.table("shop.completed_orders").count() + flat.filter(
        "status_order <> 'Selesai' OR status_order IS NULL OR NOT harga > 0"
    ).count()


def test_a_declaration_that_still_holds_stays(spark, tmp_path):
    lake = Lake(str(tmp_path), "stay", str(tmp_path / "catalog"))
    catalog.create_database(spark, lake.database, lake.database_location)
    path, table = lake.path("gold", "city_metrics"), schemas.CITY_METRICS
    for n in (1, 2):
        write_table(spark.createDataFrame([("p", "c", 1, 1.0, 1.0)] * n, table.ddl), path, table)
        name = catalog.create_external_table(spark, lake.database, table, path)
        if n == 1:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_note' = 'kept')")
    assert spark.table(name).count() == 2
    assert "owner_note" in str(spark.sql(f"SHOW TBLPROPERTIES {name}").collect())


def test_create_session_joins_the_running_one(spark):
    same = session.create_session("other", config={"spark.sql.ansi.doubleQuotedIdentifiers": "false"})
    assert same.sparkContext is spark.sparkContext


def test_second_run_replaces_the_first(spark, tmp_path, rows):
    lake = Lake(str(tmp_path), "rerun", str(tmp_path / "catalog"))
    counts = []
    for n in (20, 20, 12):
        fill_bronze(tmp_path, n_customers=n)
        bronze_to_silver(spark, lake)
        silver_to_gold(spark, lake)
        counts.append(rows(spark.table("rerun.customer_metrics")))
    assert counts[0] == counts[1]
    assert len(counts[2]) == 12


def test_empty_bronze_stops_and_writes_nothing(spark, tmp_path):
    for name, table in schemas.BRONZE.items():
        write_csv(tmp_path / "bronze" / name, table, [])
    with pytest.raises(NotReady, match="transactions"):
        bronze_to_silver(spark, Lake(str(tmp_path)))
    assert not (tmp_path / "silver").exists()


def test_report_on_an_empty_segment_table_stops(spark, tmp_path):
    lake = Lake(str(tmp_path), "hollow", str(tmp_path / "catalog"))
    catalog.create_database(spark, lake.database, lake.database_location)
    for table in (schemas.CUSTOMER_SEGMENTS, schemas.GOLD_SEGMENTS):
        path = lake.path("gold", table.name)
        write_table(spark.createDataFrame([], table.ddl), path, table)
        catalog.create_external_table(spark, lake.database, table, path)
    with pytest.raises(NotReady):
        segment_report(spark, lake)


def test_partitioned_overwrite_replaces_only_the_given_partitions(spark, tmp_path, rows):
    path, table = str(tmp_path / "t"), schemas.CUSTOMER_SEGMENTS
    catalog.create_database(spark, "parts", str(tmp_path / "catalog"))

    def batch(*data):
        return spark.createDataFrame([(c, 1, s, s, 1, g) for c, s, g in data], table.ddl)

    write_table(batch(("C1", 1.0, 0), ("C2", 2.0, 1)), path, table, partition_by=["segment"])
    name = catalog.create_external_table(spark, "parts", table, path, partition_by=["segment"])
    assert spark.table(name).count() == 2
    write_table(
        batch(("C3", 3.0, 1), ("C4", 4.0, 2)), path, table, partition_by=["segment"], dynamic=True
    )
    catalog.refresh(spark, name, partitioned=True)
    assert rows(spark.table(name), "customer_id", "segment") == [("C1", 0), ("C3", 1), ("C4", 2)]


def test_write_refuses_a_frame_that_misses_a_column(spark, tmp_path):
    df = spark.createDataFrame([("P1", 1.0)], "product_id string, price double")
    with pytest.raises(ValueError, match="category"):
        write_table(df, str(tmp_path / "t"), schemas.PRODUCTS)


def test_shuffle_partitions_grow_with_the_data_within_bounds():
    def partitions(size):
        return int(session.shuffle_settings(size)["spark.sql.shuffle.partitions"])

    assert partitions(0) == partitions(10**9) == 200
    assert partitions(10**12) == 3726
    assert partitions(10**14) == 40_000


def test_shared_dir_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_dir(spark)
    assert folder == session.shared_dir(spark)
    if named:
        assert named.removeprefix("file:") in folder


def test_checkpointed_frame_keeps_rows_and_drops_lineage(spark):
    df = session.checkpointed(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect()
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()
