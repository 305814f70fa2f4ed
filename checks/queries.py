"""Every operator as a query over the star-schema test tables.

Value tiers stand for segments wherever an exact SQL counterpart is wanted, because cluster
numbers cannot be computed in SQL.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.functions import money
from orderlake.operators import (
    analysis,
    clean,
    completed,
    gates,
    metrics,
    quarantine,
    segments,
)
from orderlake.plans import refresh, storage
from orderlake.plans.etl import bronze_to_silver, publish, read_silver, silver_to_gold
from orderlake.plans.report import segment_report
from orderlake.plans.segmentation import publish_segment_view, run_segmentation
from orderlake.session import checkpointed, scratch_path, stored
from orderlake.sources import catalog, starschema as star
from orderlake.sources.bronze import read_bronze
from orderlake.sources.lake import Lake, publish_files, write_table


def _zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times, which is what the comparison sees."""
    return df.select(
        *(
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        )
    )


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to a precision that does not depend on the order of addition."""
    return df.select(
        *(F.round(n, digits).alias(n) if kind == "double" else F.col(n) for n, kind in df.dtypes)
    )


# Cleaning


def _cleaned(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = star.raw_text(spark, sf_dir, schemas.BRONZE[name])
        return _zoneless(clean.CLEANERS[name](raw))

    return query


def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names read as numbers are malformed, part prices are not."""
    products = star.raw_text(spark, sf_dir, schemas.PRODUCTS)
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("product_id"),
        F.col("c_name").alias("price"),
        F.lit(None).cast("string").alias("category"),
    )
    return clean.rejected_values(products.unionByName(names), schemas.PRODUCTS)


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_sellers(star.raw_text(spark, sf_dir, schemas.SELLERS))


# Metrics


def transaction_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.transaction_items(
        star.transactions(spark, sf_dir), star.order_items(spark, sf_dir)
    )


def _order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.order_totals(star.order_items(spark, sf_dir))


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _order_totals(spark, sf_dir)
    sums = ("items_sum", "price_sum", "paid_sum")
    return totals.withColumns({c: money.to_double(F.col(c)) for c in sums})


def transaction_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.transaction_metrics(
        star.transactions(spark, sf_dir), _order_totals(spark, sf_dir)
    )


def latest_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latest_purchase(star.transactions(spark, sf_dir))


def _customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = star.order_items(spark, sf_dir)
    return metrics.customer_totals(
        star.transactions(spark, sf_dir), items, metrics.order_totals(items)
    )


def customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = star.order_items(spark, sf_dir)
    return metrics.customer_metrics(
        star.transactions(spark, sf_dir),
        items,
        metrics.order_totals(items),
        star.customers(spark, sf_dir),
    )


def product_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.product_metrics(star.order_items(spark, sf_dir), star.products(spark, sf_dir))


def _region(operator):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        customers = star.customers(spark, sf_dir)
        totals = metrics.with_customer_details(_customer_totals(spark, sf_dir), customers)
        return operator(totals, customers)

    return query


def completed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completed.completed_orders(
        star.transactions(spark, sf_dir),
        star.order_items(spark, sf_dir),
        star.customers(spark, sf_dir),
        star.products(spark, sf_dir),
        star.COMPLETED,
    )


# Segment analysis over tiers


def _tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.with_tiers(_customer_totals(spark, sf_dir)).withColumnRenamed(
        "tier_no", "segment"
    )


def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.segment_counts(_tiers(spark, sf_dir), by="tier")


def tier_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.segment_averages(_tiers(spark, sf_dir)), 4)


def tier_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.segment_profile(_tiers(spark, sf_dir)), 4)


def top_customers_tier1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.top_customers(_tiers(spark, sf_dir), segment=1)


def top_customers_per_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.top_customers_per_segment(_tiers(spark, sf_dir))


def _completed_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completed.completed_by_customer(
        star.transactions(spark, sf_dir),
        _order_totals(spark, sf_dir),
        star.customers(spark, sf_dir),
        star.COMPLETED,
    )


def _gold_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completed.gold_segments(_tiers(spark, sf_dir), _completed_by_customer(spark, sf_dir))


def spend_by_province_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.spend_by_province(_gold_by_tier(spark, sf_dir))


# Features and clusters


def _prepared(spark: SparkSession, sf_dir: str):
    return segments.prepare_features(checkpointed(_customer_totals(spark, sf_dir)))


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, _ = _prepared(spark, sf_dir)
    scaled = vector_to_array("scaled_features")
    return prepared.select(
        "customer_id",
        *(
            # adding zero turns a negative zero into zero
            (F.round(scaled[i], 6) + 0.0).alias(f"scaled_{name}")
            for i, name in enumerate(segments.FEATURES)
        ),
    )


def tier_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of the value tiers, taken as clusters."""
    tiers = checkpointed(_tiers(spark, sf_dir).select("customer_id", "segment", *segments.FEATURES))
    prepared, _ = segments.prepare_features(tiers)
    assigned = prepared.join(tiers.select("customer_id", "segment"), "customer_id")
    score = segments.silhouette(assigned, prediction="segment")
    prepared.unpersist()
    return tiers.agg(F.count(F.lit(1)).alias("n_customers")).withColumn(
        "silhouette", F.round(F.lit(score), 6)
    )


def _fitted(spark: SparkSession, sf_dir: str):
    prepared, preprocessing = _prepared(spark, sf_dir)
    model, trials = segments.fit_segments(prepared, preprocessing)
    return prepared, model, trials


def _kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, model, _ = _fitted(spark, sf_dir)
    assigned = checkpointed(
        model.assign(prepared).select("customer_id", *segments.FEATURES, "segment")
    )
    prepared.unpersist()
    return assigned


def kmeans_control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whatever the segments are, every customer is in exactly one of them."""
    assigned = _kmeans(spark, sf_dir)
    per_segment = assigned.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count_distinct("customer_id").alias("n_distinct_customers"),
        F.sum("n_transactions").alias("n_transactions"),
        F.sum(F.col("total_spend").cast("decimal(18,2)")).alias("total_spend"),
    )
    return per_segment.agg(
        F.sum("n_customers").alias("n_customers"),
        F.sum("n_distinct_customers").alias("n_distinct_customers"),
        F.sum("n_transactions").alias("n_transactions"),
        F.sum("total_spend").cast("double").alias("total_spend"),
    )


def silhouette_by_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, _ = _prepared(spark, sf_dir)
    trials = segments.sweep_k(prepared, max_k=8)
    prepared.unpersist()
    return segments.trial_table(spark, trials)


def cluster_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared, model, _ = _fitted(spark, sf_dir)
    prepared.unpersist()
    return segments.cluster_centers(spark, model)


def segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.segment_profile(_kmeans(spark, sf_dir))


def kmeans_gold_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completed.gold_segments(_kmeans(spark, sf_dir), _completed_by_customer(spark, sf_dir))


@dataclass(frozen=True)
class _TwoMeans:
    prepared: DataFrame
    model: segments.SegmentModel

    def assigned(self) -> DataFrame:
        found = checkpointed(
            self.model.assign(self.prepared).select(
                "customer_id", *segments.FEATURES, "scaled_features", "cluster", "segment"
            )
        )
        self.prepared.unpersist()
        return found


def _two_means(spark: SparkSession, sf_dir: str) -> _TwoMeans:
    """Two clusters, fitted until no centre moves, so that the result is a fixed point."""
    prepared, preprocessing = _prepared(spark, sf_dir)
    clusters = segments.train_kmeans(prepared, 2, tol=0.0, max_iter=200)
    labels = segments.label_by_spend(preprocessing, clusters)
    return _TwoMeans(prepared, segments.SegmentModel(preprocessing, clusters, labels))


def two_means_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _two_means(spark, sf_dir).assigned()
    return found.select("customer_id", *segments.FEATURES, "segment")


def two_means_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.segment_profile(_two_means(spark, sf_dir).assigned()), 4)


def two_means_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = _two_means(spark, sf_dir)
    fitted.prepared.unpersist()
    return segments.cluster_centers(spark, fitted.model).select(
        "segment",
        "feature",
        (F.round("scaled_center", 6) + 0.0).alias("scaled_center"),
        F.round("center", 4).alias("center"),
    )


def two_means_gold_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _two_means(spark, sf_dir).assigned()
    return completed.gold_segments(found, _completed_by_customer(spark, sf_dir))


def two_means_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _two_means(spark, sf_dir).assigned()
    score = segments.silhouette(found, prediction="segment")
    return found.agg(F.count(F.lit(1)).alias("n_customers")).withColumn(
        "silhouette", F.round(F.lit(score), 6)
    )


def kmeans_fixed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each k, how many customers lie nearer to another centre, and whether centres are means.

    A fixed point has no such customer and no centre away from the mean of its members.
    """
    prepared, _ = _prepared(spark, sf_dir)

    def check(k: int) -> tuple[int, int, bool]:
        model = segments.train_kmeans(prepared, k, tol=0.0, max_iter=200)
        return k, *segments.fixed_point(model, prepared)

    # as many fits at a time as in the sweep, so that cores do not wait for the driver
    ks = range(2, 9)
    with ThreadPool(len(ks)) as pool:
        checks = pool.map(inheritable_thread_target(spark)(check), ks, chunksize=1)
    prepared.unpersist()
    return spark.createDataFrame(checks, "k int, n_misplaced bigint, centers_are_means boolean")


# The lake: files, catalog tables and gates


_LAKES: dict[tuple[str, str], tuple[str, Lake]] = {}


def _state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return " ".join(
        f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in system.listStatus(place)
    )


def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake filled from the test tables: raw CSV, cleaned to silver, summed up to gold.

    Built once per session for one state of the tables; an outdated one leaves the catalog.
    """
    key, state = (spark.sparkContext.applicationId, sf_dir), _state(spark, sf_dir)
    known, lake = _LAKES.get(key, ("", None))
    if known != state:
        if lake is not None:
            spark.sql(f"DROP DATABASE IF EXISTS {lake.database} CASCADE")
        root = scratch_path(spark, "lake")
        lake = Lake(root, f"lake_{uuid.uuid4().hex}", f"{root}/catalog")
        star.write_raw_csv(spark, sf_dir, f"{root}/bronze")
        bronze_to_silver(spark, lake)
        silver_to_gold(spark, lake, completed_status=star.COMPLETED)
        _LAKES[key] = (state, lake)
    return lake


def lake_bronze_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV scan."""
    lake = _lake(spark, sf_dir)
    raw = read_bronze(spark, lake.path("bronze", "sellers"), schemas.SELLERS)
    return raw.drop(schemas.BROKEN)


def lake_silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table with a column that no contract names."""
    return _lake(spark, sf_dir).read(spark, "silver", schemas.CUSTOMERS, extras=True)


def lake_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What loading found, counted while the tables were written."""
    return _lake(spark, sf_dir).read(spark, "silver", schemas.LOAD_COUNTS)


def broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as CSV lines, some with a field too many or too few, counted while loaded."""
    root = scratch_path(spark, "broken")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    key = F.col("s_suppkey")
    line = (
        F.when(key % 7 == 0, F.concat_ws(",", key, F.lit("a"), F.lit("b"), F.lit("too many")))
        .when(key % 11 == 0, F.concat_ws(",", key, F.lit("too few")))
        .otherwise(F.concat_ws(",", key, F.lit("a"), F.lit("b")))
    )
    # every file that a task writes begins with the header, as raw files do
    first = ",".join(f.source for f in schemas.SELLERS.fields)
    suppliers.select(line.alias(first)).write.options(
        header=True, quote="", escape="", sep="\u0001"
    ).csv(f"{root}/raw")
    counts = clean.LoadCounts(schemas.SELLERS)
    watched = counts.watch(read_bronze(spark, f"{root}/raw", schemas.SELLERS))
    write_table(watched, f"{root}/silver", schemas.SELLERS)
    found = spark.createDataFrame(counts.rows(), schemas.LOAD_COUNTS.ddl)
    return found.withColumn("n_loaded", F.lit(spark.read.parquet(f"{root}/silver").count()))


def flat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completed.flat_orders(
        star.transactions(spark, sf_dir),
        star.order_items(spark, sf_dir),
        star.customers(spark, sf_dir),
        star.products(spark, sf_dir),
    )


def lake_flat_order_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lasting view of unfiltered orders under source names, summed up."""
    lake = _lake(spark, sf_dir)
    view = spark.table(f"{lake.database}.{schemas.SOURCE_VIEWS['flat_orders']}")
    return view.groupBy("provinsi_pelanggan", "status_order").agg(
        F.count(F.lit(1)).alias("n_rows"),
        money.to_double(money.exact_sum("harga")).alias("harga"),
    )


def _segment_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers stored as the gold segment table, read through its lasting view."""
    lake = _lake(spark, sf_dir)
    tiers = lake.read(spark, "gold", schemas.CUSTOMER_METRICS).withColumnRenamed(
        "tier_no", "segment"
    )
    silver = read_silver(spark, lake)
    measures = completed.completed_by_customer(
        silver["transactions"],
        lake.read(spark, "silver", schemas.ORDER_TOTALS),
        silver["customers"],
        star.COMPLETED,
    )
    publish(spark, lake, "gold", completed.gold_segments(tiers, measures), schemas.GOLD_SEGMENTS)
    return spark.table(publish_segment_view(spark, lake))


def source_view_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _segment_view(spark, sf_dir)
        .groupBy("provinsi_pelanggan", "segment")
        .agg(F.round(F.sum("total_pembayaran"), 2).alias("total_pembelian"))
    )


def source_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _segment_view(spark, sf_dir)
    return view.groupBy("segment").agg(F.count(F.lit(1)).alias("jumlah_pelanggan"))


def fine_order_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of amounts far below a millionth, which must not be rounded away."""
    items = star.order_items(spark, sf_dir).withColumn("price", F.col("price") / 7e10)
    total = money.to_double(money.exact_sum("price"))
    return items.groupBy("order_id").agg(F.round(total, 12).alias("price_sum"))


def lake_silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to Parquet, read back with the declared schema."""
    return _lake(spark, sf_dir).read(spark, "silver", schemas.ORDER_ITEMS)


def _lake_table(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _lake(spark, sf_dir)
        return _zoneless(catalog.read_table(spark, f"{lake.database}.{name}"))

    return query


def lake_segment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers stored as the segment table, declared with fixed types, overwritten and refreshed."""
    lake = _lake(spark, sf_dir)
    path, table = lake.path("gold", "customer_segments"), schemas.CUSTOMER_SEGMENTS
    stored = lake.read(spark, "gold", schemas.CUSTOMER_METRICS)
    write_table(stored.withColumn("segment", F.lit(0)), path, table)
    name = catalog.create_external_table(spark, lake.database, table, path)
    write_table(stored.withColumnRenamed("tier_no", "segment"), path, table)
    catalog.refresh(spark, name)
    return catalog.read_table(spark, name)


def catalog_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    return catalog.table_overview(spark, lake.database, "*_metrics")


def layer_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw items repeat some keys, so that table is not ready; the silver ones are."""
    lake = _lake(spark, sf_dir)

    def gate(layer: str, df: DataFrame, table: schemas.Table) -> DataFrame:
        return gates.check_table(df, table).withColumn("layer", F.lit(layer))

    checks = [
        gate("bronze", read_bronze(spark, lake.path("bronze", t.name), t), t)
        for t in (schemas.CUSTOMERS, schemas.ORDER_ITEMS)
    ] + [gate("silver", lake.read(spark, "silver", t), t) for t in schemas.BRONZE.values()]
    return reduce(DataFrame.unionByName, checks)


# Refresh by period, storage by order, quarantine


_REFRESHED: dict[tuple[str, str], tuple[str, Lake]] = {}


def _as_silver(df: DataFrame, table: schemas.Table) -> DataFrame:
    """With the contract's columns and types; those that the star tables lack are null."""
    missing = [f.name for f in table.fields if f.name not in df.columns]
    return schemas.conform(df.withColumns({c: F.lit(None) for c in missing}), table)


def _orders_and_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        _as_silver(star.transactions(spark, sf_dir), schemas.TRANSACTIONS),
        _as_silver(star.order_items(spark, sf_dir), schemas.ORDER_ITEMS),
    )


def _dimensions(spark: SparkSession, sf_dir: str, lake: Lake) -> None:
    for name in ("customers", "products"):
        raw = star.raw_text(spark, sf_dir, schemas.BRONZE[name])
        publish_files(
            spark, clean.CLEANERS[name](raw), lake.folder("silver", name), schemas.BRONZE[name]
        )


def _refreshed(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake loaded by month, and then refreshed with another last month.

    In the second batch the orders of that month with a number divisible by three are gone and
    prices have doubled.
    """
    key, state = (spark.sparkContext.applicationId, sf_dir), _state(spark, sf_dir)
    known, lake = _REFRESHED.get(key, ("", None))
    if known != state:
        root = scratch_path(spark, "refreshed")
        lake = Lake(root, f"refreshed_{uuid.uuid4().hex}", f"{root}/catalog")
        _dimensions(spark, sf_dir, lake)
        orders, items = _orders_and_items(spark, sf_dir)
        # both batches start from the same items
        items = stored(items, "items")
        refresh.refresh(spark, lake, orders, items, grain="month")
        last = orders.agg(F.date_format(F.max("purchased_at"), "yyyy-MM")).first()[0]
        month = orders.filter(F.date_format("purchased_at", "yyyy-MM") == last)
        fewer = month.filter("order_id % 3 <> 0")
        doubled = items.join(fewer.select("order_id"), "order_id", "left_semi").withColumns(
            {c: F.col(c) * 2 for c in ("price", "item_total")}
        )
        refresh.refresh(spark, lake, fewer, doubled, grain="month")
        _REFRESHED[key] = (state, lake)
    return lake


def _refreshed_table(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _refreshed(spark, sf_dir)
        return _zoneless(catalog.read_table(spark, f"{lake.database}.{name}"))

    return query


def lake_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and items of two stored months; no other folder is read."""
    orders, items = refresh.read_periods(spark, _refreshed(spark, sf_dir), ["1995-01", "1995-02"])
    return (
        orders.join(items.drop("period"), "order_id")
        .groupBy("period", "order_status")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.count_distinct("order_id").alias("n_orders"),
            money.to_double(money.exact_sum("price")).alias("price"),
        )
    )


def lake_quarter_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a quarter, picked in the calendar, whose months Spark finds out while it runs."""
    lake = _refreshed(spark, sf_dir)
    items = spark.table(f"{lake.database}.{schemas.PERIOD_ITEMS.name}")
    months = spark.table(f"{lake.database}.{schemas.CALENDAR.name}").filter("quarter = '1996-Q3'")
    return (
        items.join(months, "period")
        .groupBy("quarter", "period", "first_day")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            money.to_double(money.exact_sum("price")).alias("price"),
        )
    )


def _by_order(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and items in buckets by order."""
    root = scratch_path(spark, "by_order")
    lake = Lake(root, f"by_order_{uuid.uuid4().hex}", f"{root}/catalog")
    return storage.store_by_order(spark, lake, *_orders_and_items(spark, sf_dir), buckets=8)


def bucketed_customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = _by_order(spark, sf_dir)
    return _zoneless(metrics.customer_totals(orders, items, metrics.order_totals(items)))


def bucketed_completed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = _by_order(spark, sf_dir)
    customers = _as_silver(star.customers(spark, sf_dir), schemas.CUSTOMERS)
    products = _as_silver(star.products(spark, sf_dir), schemas.PRODUCTS)
    return _zoneless(
        completed.completed_orders(orders, items, customers, products, star.COMPLETED)
    )


def _dirty_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw items with copies as the table has them, some prices misspelt and some orders missing."""
    raw = star.raw_text(spark, sf_dir, schemas.ORDER_ITEMS)
    number = F.col("order_id").cast("bigint")
    return raw.withColumns(
        {
            "price": F.when(number % 13 == 0, F.concat("price", F.lit(" rupiah"))).otherwise(
                F.col("price")
            ),
            "order_id": F.when(number % 17 == 0, F.lit(None)).otherwise(F.col("order_id")),
        }
    )


def quarantined_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many raw items were rejected, by what was wrong with them."""
    raw = _dirty_items(spark, sf_dir)
    _, rejected = quarantine.cleaned_and_rejected(
        raw, schemas.ORDER_ITEMS, clean.clean_order_items
    )
    return rejected.groupBy("table_name", "problems", "dropped").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def quarantine_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows, silver rows and dropped rows of every table of a lake with a quarantine."""
    root = scratch_path(spark, "quarantine")
    lake = Lake(root, f"quarantine_{uuid.uuid4().hex}", f"{root}/catalog")
    star.write_raw_csv(spark, sf_dir, f"{root}/bronze")
    counts = bronze_to_silver(spark, lake, quarantine=True)
    raw = counts.filter("problem = 'broken record'").select(
        "table_name", F.col("n_checked").alias("n_raw")
    )
    silver = reduce(
        DataFrame.unionByName,
        (
            lake.read(spark, "silver", t).agg(F.count(F.lit(1)).alias("n_silver")).select(
                F.lit(t.name).alias("table_name"), "n_silver"
            )
            for t in schemas.BRONZE.values()
        ),
    )
    dropped = lake.read(spark, "silver", schemas.QUARANTINE).filter("dropped").groupBy(
        "table_name"
    ).agg(F.count(F.lit(1)).alias("n_dropped"))
    return raw.join(silver, "table_name").join(dropped, "table_name", "left").select(
        "table_name",
        "n_raw",
        "n_silver",
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        (F.col("n_raw") == F.col("n_silver") + F.coalesce("n_dropped", F.lit(0))).alias("balanced"),
    )


def full_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored tables as a run may find them: good, retyped, cut, empty, repeated, absent, orphaned."""
    root = scratch_path(spark, "gates")
    orders = star.raw_text(spark, sf_dir, schemas.TRANSACTIONS)
    # cleaned once, however many tables below are made of them
    items = stored(
        clean.clean_order_items(star.raw_text(spark, sf_dir, schemas.ORDER_ITEMS)), "items"
    )
    customers = clean.clean_customers(star.raw_text(spark, sf_dir, schemas.CUSTOMERS))
    some_orders = orders.filter("cast(order_id as bigint) % 10 <> 0")
    products = clean.clean_products(star.raw_text(spark, sf_dir, schemas.PRODUCTS))
    frames = {
        "orphaned": (items, schemas.ORDER_ITEMS),
        "good": (items, schemas.ORDER_ITEMS),
        "retyped": (items.withColumn("price", F.col("price").cast("string")), schemas.ORDER_ITEMS),
        "cut": (items.drop("price", "quantity"), schemas.ORDER_ITEMS),
        "empty": (items.limit(0), schemas.ORDER_ITEMS),
        "repeated": (customers.unionByName(customers), schemas.CUSTOMERS),
    }
    known = {"transactions": orders, "products": products}
    rows = []
    for name, (df, table) in frames.items():
        write_table(df, f"{root}/{name}")
        tables = known | ({"transactions": some_orders} if name == "orphaned" else {})
        parents = gates.known_parents(table, tables, schemas.BRONZE)
        rows.append(
            gates.gate(spark, f"{root}/{name}", table, parents).withColumn("place", F.lit(name))
        )
    absent = gates.gate(spark, f"{root}/absent", schemas.REVIEWS)
    items.limit(1).select("order_id").write.text(f"{root}/unreadable")
    unreadable = gates.gate(spark, f"{root}/unreadable", schemas.REVIEWS)
    rows += [absent.withColumn("place", F.lit("absent"))]
    rows += [unreadable.withColumn("place", F.lit("unreadable"))]
    return reduce(DataFrame.unionByName, rows)


# Charts, recency, all k at once


def spend_chart_by_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.spend_chart(_gold_by_tier(spark, sf_dir), [1, 2, 3, 4, 9])


def customer_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = star.customers(spark, sf_dir).select("customer_id")
    latest = metrics.latest_purchase(star.transactions(spark, sf_dir))
    return metrics.with_recency(customers, latest, F.lit("1998-12-31").cast("date"))


def recency_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with recency as a feature beside spend, scaled; those without a purchase fall out."""
    totals = _customer_totals(spark, sf_dir).select("customer_id", "total_spend")
    customers = star.customers(spark, sf_dir).select("customer_id").join(
        totals, "customer_id", "left"
    )
    latest = metrics.latest_purchase(star.transactions(spark, sf_dir))
    rated = checkpointed(
        metrics.with_recency(customers, latest, F.lit("1998-12-31").cast("date"))
    )
    features = ("total_spend", "recency_days")
    prepared, _ = segments.prepare_features(rated, features)
    scaled = vector_to_array("scaled_features")
    return prepared.select(
        "customer_id", *((F.round(scaled[i], 6) + 0.0).alias(f) for i, f in enumerate(features))
    )


def sweep_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each k of the sweep: whether Spark's evaluator agrees, and that one best k is chosen."""
    prepared, _ = _prepared(spark, sf_dir)
    trials = segments.sweep_k(prepared, max_k=8)
    scores = {t.k: segments.silhouette(t.model.transform(prepared)) for t in trials}
    prepared.unpersist()
    best = segments.choose_k(trials)
    rows = [
        (t.k, abs(t.score - scores[t.k]) < 1e-9, (t.k == best) == (scores[t.k] == max(scores.values())))
        for t in trials
    ]
    return spark.createDataFrame(rows, "k int, evaluator_agrees boolean, best_is_chosen boolean")


# The segmentation run and what it stores


_SEGMENTED: dict[tuple[str, str], tuple[str, Lake]] = {}


def _segmented(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake of its own on which the segmentation has run."""
    key, state = (spark.sparkContext.applicationId, sf_dir), _state(spark, sf_dir)
    known, lake = _SEGMENTED.get(key, ("", None))
    if known != state:
        base = _lake(spark, sf_dir)
        root = scratch_path(spark, "segmented")
        lake = Lake(root, f"segmented_{uuid.uuid4().hex}", f"{root}/catalog")
        needed = [("silver", t) for t in (*schemas.BRONZE.values(), schemas.ORDER_TOTALS)]
        for layer, table in [*needed, ("gold", schemas.CUSTOMER_METRICS)]:
            publish_files(
                spark, base.read(spark, layer, table), lake.folder(layer, table.name), table
            )
        run_segmentation(spark, lake, completed_status=star.COMPLETED)
        _SEGMENTED[key] = (state, lake)
    return lake


def run_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored segment table: every customer with the features, in one of the segments."""
    lake = _segmented(spark, sf_dir)
    stored = spark.table(f"{lake.database}.{schemas.CUSTOMER_SEGMENTS.name}")
    n_segments = len(segments.SegmentModel.load(lake.models).clusters.clusterCenters())
    return stored.select(
        "customer_id",
        *segments.FEATURES,
        F.col("segment").between(0, n_segments - 1).alias("has_segment"),
    )


def run_gold_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored gold segment table without the segment numbers."""
    lake = _segmented(spark, sf_dir)
    table = spark.table(f"{lake.database}.{schemas.GOLD_SEGMENTS.name}")
    return _zoneless(table.drop("segment"))


def stored_model_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the stored models put every stored customer into the stored segment again."""
    lake = _segmented(spark, sf_dir)
    model = segments.SegmentModel.load(lake.models)
    again = model.assign(lake.read(spark, "gold", schemas.CUSTOMER_METRICS))
    known = lake.read(spark, "gold", schemas.CUSTOMER_SEGMENTS).select(
        "customer_id", F.col("segment").alias("known")
    )
    return again.join(known, "customer_id", "full").select(
        "customer_id", F.col("segment").eqNullSafe(F.col("known")).alias("same_segment")
    )


def report_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's spend by province, added up over the segments."""
    report = segment_report(spark, _segmented(spark, sf_dir))
    return report["spend_by_province"].groupBy("province").agg(
        F.round(F.sum("total_purchases"), 2).alias("total_purchases")
    )


def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's customers per segment, added up, and how many top customers it lists."""
    report = segment_report(spark, _segmented(spark, sf_dir))
    n_segments = report["segment_counts"].count()
    top = report["top_customers_per_segment"]
    return report["segment_counts"].agg(F.sum("n_customers").alias("n_customers")).select(
        "n_customers",
        F.lit(report["segment_averages"].count() == n_segments).alias("averages_complete"),
        F.lit(top.filter("place = 1").count() == n_segments).alias("tops_complete"),
        F.lit(report["top_customers"].count() <= 5).alias("top_is_short"),
    )


def session_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session views of the gold tables, by their rows."""
    lake = _lake(spark, sf_dir)
    tables = {
        t.name: lake.read(spark, "gold", t)
        for t in (
            schemas.TRANSACTION_METRICS, schemas.CUSTOMER_METRICS, schemas.PRODUCT_METRICS,
            schemas.PROVINCE_METRICS, schemas.CITY_METRICS,
        )
    }
    tables["customer_segments"] = _segmented(spark, sf_dir).read(
        spark, "gold", schemas.CUSTOMER_SEGMENTS
    )
    views = catalog.register_views(tables)
    return reduce(
        DataFrame.unionByName,
        (
            spark.table(v).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("view", F.lit(v))
            for v in views
        ),
    )


def features_without_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a missing feature are left out before scaling."""
    totals = _customer_totals(spark, sf_dir)
    holes = totals.withColumns(
        {
            "avg_spend": F.when(F.col("customer_id") % 5 != 0, F.col("avg_spend")),
            "total_spend": F.when(
                F.col("customer_id") % 7 == 0, F.lit(float("nan"))
            ).otherwise(F.col("total_spend")),
        }
    )
    prepared, _ = segments.prepare_features(checkpointed(holes))
    return prepared.select("customer_id", *segments.FEATURES)


def refused_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards say to each silver table as it is, emptied, and without a column."""
    lake = _lake(spark, sf_dir)
    rows = []
    for table in schemas.BRONZE.values():
        df = lake.read(spark, "silver", table)
        last = [f.name for f in table.fields if not f.optional][-1]
        for case, given in (("whole", df), ("emptied", df.limit(0)), ("cut", df.drop(last))):
            try:
                gates.require_ready(given, table)
                schemas.require_columns(given, [last], table.name)
                said = "ready"
            except gates.NotReady as error:
                said = str(error)
            rows.append((table.name, case, said))
    return spark.createDataFrame(rows, "table_name string, given string, said string")


def fallback_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a segment table that lacks two of the four measures."""
    tiers = _tiers(spark, sf_dir).drop("avg_spend", "n_distinct_products")
    return _rounded(analysis.segment_profile(tiers), 4)


QUERIES = {
    "clean_customers": _cleaned("customers"),
    "clean_products": _cleaned("products"),
    "clean_transactions": _cleaned("transactions"),
    "clean_order_items": _cleaned("order_items"),
    "clean_reviews": _cleaned("reviews"),
    "rejected_values": rejected_values,
    "sellers": sellers,
    "transaction_items": transaction_items,
    "order_totals": order_totals,
    "transaction_metrics": transaction_metrics,
    "latest_purchase": latest_purchase,
    "customer_metrics": customer_metrics,
    "product_metrics": product_metrics,
    "province_metrics": _region(metrics.province_metrics),
    "city_metrics": _region(metrics.city_metrics),
    "completed_orders": completed_orders,
    "tier_counts": tier_counts,
    "tier_averages": tier_averages,
    "tier_profile": tier_profile,
    "top_customers_tier1": top_customers_tier1,
    "top_customers_per_tier": top_customers_per_tier,
    "gold_segments": _gold_by_tier,
    "spend_by_province_tier": spend_by_province_tier,
    "scaled_features": scaled_features,
    "tier_silhouette": tier_silhouette,
    "kmeans_segments": _kmeans,
    "kmeans_control_totals": kmeans_control_totals,
    "kmeans_gold_segments": kmeans_gold_segments,
    "silhouette_by_k": silhouette_by_k,
    "cluster_centers": cluster_centers,
    "segment_profile": segment_profile,
    "two_means_segments": two_means_segments,
    "two_means_profile": two_means_profile,
    "two_means_centers": two_means_centers,
    "two_means_gold_segments": two_means_gold_segments,
    "two_means_silhouette": two_means_silhouette,
    "kmeans_fixed_points": kmeans_fixed_points,
    "lake_bronze_sellers": lake_bronze_sellers,
    "lake_silver_order_items": lake_silver_order_items,
    "lake_silver_customers": lake_silver_customers,
    "lake_load_counts": lake_load_counts,
    "lake_flat_order_view": lake_flat_order_view,
    "source_view_spend": source_view_spend,
    "source_view_counts": source_view_counts,
    "broken_records": broken_records,
    "flat_orders": flat_orders,
    "fine_order_sums": fine_order_sums,
    "lake_completed_orders": _lake_table("completed_orders"),
    "lake_customer_metrics": _lake_table("customer_metrics"),
    "lake_product_metrics": _lake_table("product_metrics"),
    "lake_city_metrics": _lake_table("city_metrics"),
    "lake_segment_table": lake_segment_table,
    "catalog_overview": catalog_overview,
    "layer_gates": layer_gates,
    "region_metrics": _region(metrics.region_metrics),
    "refreshed_customer_metrics": _refreshed_table("customer_metrics"),
    "refreshed_product_metrics": _refreshed_table("product_metrics"),
    "refreshed_city_metrics": _refreshed_table("city_metrics"),
    "refreshed_transactions": _refreshed_table("period_transactions"),
    "lake_two_months": lake_two_months,
    "lake_quarter_items": lake_quarter_items,
    "bucketed_customer_totals": bucketed_customer_totals,
    "bucketed_completed_orders": bucketed_completed_orders,
    "quarantined_items": quarantined_items,
    "quarantine_balance": quarantine_balance,
    "full_gates": full_gates,
    "spend_chart_by_tier": spend_chart_by_tier,
    "customer_recency": customer_recency,
    "recency_features": recency_features,
    "sweep_scores": sweep_scores,
    "run_segments": run_segments,
    "run_gold_segments": run_gold_segments,
    "stored_model_segments": stored_model_segments,
    "report_by_province": report_by_province,
    "report_counts": report_counts,
    "session_views": session_views,
    "features_without_nulls": features_without_nulls,
    "refused_inputs": refused_inputs,
    "fallback_profile": fallback_profile,
}
