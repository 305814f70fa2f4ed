"""Table contracts: names, types and keys of every layer.

``source`` is the column name in the raw files, ``name`` the one used from silver on.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.money import TOTAL


# The text of a raw record whose fields do not match the header.
BROKEN = "_broken_record"


@dataclass(frozen=True)
class Field:
    source: str
    name: str
    type: str
    optional: bool = False


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)

    def extended(self, columns: Iterable[str]) -> Table:
        """This table with further columns, kept as text."""
        more = [c for c in columns if c not in self.columns and c != BROKEN]
        texts = (Field(c, c, "string", True) for c in more)
        return Table(self.name, (*self.fields, *texts), self.key)


def _table(name: str, key: Iterable[str], *fields: tuple) -> Table:
    return Table(name, tuple(Field(*f) for f in fields), tuple(key))


# Raw column names as they stand in the source files, the literal of a completed
# order, the text that replaces a missing postal code, and the tier labels from best to worst.
CUSTOMERS = _table(
    "customers", ["customer_id"],
    ("id_pelanggan", "customer_id", "string"),
    ("kode_pos_pelanggan", "postal_code", "string"),
    ("kota_kabupaten_pelanggan", "city", "string"),
    ("provinsi_pelanggan", "province", "string"),
)
PRODUCTS = _table(
    "products", ["product_id"],
    ("id_produk", "product_id", "string"),
    ("harga", "price", "double"),
    ("kategori_produk", "category", "string"),
)
TRANSACTIONS = _table(
    "transactions", ["order_id"],
    ("id_order", "order_id", "string"),
    ("id_pelanggan", "customer_id", "string"),
    ("total_pembayaran", "total_payment", "double"),
    ("banyak_cicilan", "installments", "int"),
    ("timestamp_pembelian", "purchased_at", "timestamp"),
    ("timestamp_persetujuan_toko", "approved_at", "timestamp"),
    ("timestamp_pengiriman_ke_pelanggan", "shipped_at", "timestamp"),
    ("estimasi_sampai", "estimated_arrival", "date"),
    ("status_order", "order_status", "string", True),
)
ORDER_ITEMS = _table(
    "order_items", ["order_id", "product_id"],
    ("id_order", "order_id", "string"),
    ("id_produk", "product_id", "string"),
    ("harga", "price", "double"),
    ("jumlah", "quantity", "int"),
    ("total_item", "item_total", "double"),
)
REVIEWS = _table(
    "reviews", ["customer_id", "product_id"],
    ("id_pelanggan", "customer_id", "string"),
    ("id_produk", "product_id", "string"),
    ("nilai_rating_produk", "rating", "float"),
    ("tanggal_review", "review_date", "date"),
)
SELLERS = _table(
    "sellers", [],
    ("id_seller", "seller_id", "string"),
    ("kota_kabupaten_seller", "city", "string"),
    ("provinsi_seller", "province", "string"),
)
COMPLETED_STATUS = "Selesai"
MISSING_POSTAL_CODE = "00000"
TIERS = ("Platinum", "Gold", "Silver", "Bronze")

BRONZE = {t.name: t for t in (CUSTOMERS, PRODUCTS, TRANSACTIONS, ORDER_ITEMS, REVIEWS, SELLERS)}

# Gold tables; ``source`` is the name existing reports use for the column.
TRANSACTION_METRICS = _table(
    "transaction_metrics", ["order_id"],
    ("id_order", "order_id", "string"),
    ("id_pelanggan", "customer_id", "string"),
    ("timestamp_pembelian", "purchased_at", "timestamp"),
    ("total_transaksi", "order_total", "double"),
    ("jumlah_item_berbeda", "n_items", "bigint"),
    ("harga_rata_rata_item", "avg_item_price", "double"),
    ("timestamp_pembelian_date", "purchase_day", "string"),
    ("bulan_transaksi", "month", "int"),
    ("tahun_transaksi", "year", "int"),
    ("hari_transaksi", "day_of_week", "int"),
)
CUSTOMER_METRICS = _table(
    "customer_metrics", ["customer_id"],
    ("id_pelanggan", "customer_id", "string"),
    ("jumlah_transaksi", "n_transactions", "bigint"),
    ("total_belanja", "total_spend", "double"),
    ("rata_rata_belanja", "avg_spend", "double"),
    ("jumlah_produk_berbeda", "n_distinct_products", "bigint"),
    ("jumlah_order", "n_orders", "bigint"),
    ("nilai_belanja", "spend_value", "double"),
    ("last_purchase_date", "last_purchase", "timestamp"),
    ("kode_pos_pelanggan", "postal_code", "string"),
    ("kota_kabupaten_pelanggan", "city", "string"),
    ("provinsi_pelanggan", "province", "string"),
    ("segmen_nilai", "tier_no", "int"),
    ("segmen_pelanggan", "tier", "string"),
)
PRODUCT_METRICS = _table(
    "product_metrics", ["product_id"],
    ("id_produk", "product_id", "string"),
    ("jumlah_terjual", "units_sold", "bigint"),
    ("total_penjualan", "total_sales", "double"),
    ("harga_rata_rata", "avg_price", "double"),
    ("harga", "price", "double"),
    ("kategori_produk", "category", "string"),
    ("peringkat_dalam_kategori", "rank_in_category", "int"),
)
PROVINCE_METRICS = _table(
    "province_metrics", ["province"],
    ("provinsi_pelanggan", "province", "string"),
    ("jumlah_pelanggan", "n_customers", "bigint"),
    ("total_belanja_provinsi", "total_spend", "double"),
    ("rata_rata_belanja_provinsi", "avg_spend", "double"),
)
CITY_METRICS = _table(
    "city_metrics", ["province", "city"],
    ("provinsi_pelanggan", "province", "string"),
    ("kota_kabupaten_pelanggan", "city", "string"),
    ("jumlah_pelanggan", "n_customers", "bigint"),
    ("total_belanja_kota", "total_spend", "double"),
    ("rata_rata_belanja_kota", "avg_spend", "double"),
)
CUSTOMER_SEGMENTS = _table(
    "customer_segments", ["customer_id"],
    ("customer_id", "customer_id", "string"),
    ("jumlah_transaksi", "n_transactions", "bigint"),
    ("total_belanja", "total_spend", "double"),
    ("rata_rata_belanja", "avg_spend", "double"),
    ("jumlah_produk_berbeda", "n_distinct_products", "bigint"),
    ("cluster", "segment", "int"),
)
ORDER_TOTALS = _table(
    "order_totals", ["order_id"],
    ("id_order", "order_id", "string"),
    ("n_rows", "n_rows", "bigint"),
    ("n_items", "n_items", "bigint"),
    ("items_sum", "items_sum", TOTAL),
    ("items_counted", "items_counted", "bigint"),
    ("price_sum", "price_sum", TOTAL),
    ("prices_counted", "prices_counted", "bigint"),
    ("paid_sum", "paid_sum", TOTAL),
    ("n_paid", "n_paid", "bigint"),
)
COMPLETED_ORDERS = _table(
    "completed_orders", ["order_id", "product_id"],
    ("id_order", "order_id", "string"),
    ("id_produk", "product_id", "string"),
    ("id_pelanggan", "customer_id", "string"),
    ("provinsi_pelanggan", "province", "string"),
    ("harga", "price", "double"),
    ("total_pembayaran", "total_payment", "double"),
    ("kategori_produk", "category", "string"),
    ("status_order", "order_status", "string"),
    ("timestamp_pembelian", "purchased_at", "timestamp"),
)
GOLD_SEGMENTS = _table(
    "gold_segments", ["customer_id"],
    ("id_pelanggan", "customer_id", "string"),
    ("segment", "segment", "int"),
    ("avg_harga", "avg_price", "double"),
    ("total_transaksi", "n_orders", "int"),
    ("last_pembelian", "last_purchase", "timestamp"),
    ("provinsi_pelanggan", "province", "string"),
    ("total_pembayaran", "total_payment", "double"),
)

# Tables by period: the orders and items of a day or month, and what can be added up from them.
_PERIOD = ("period", "period", "string")


def _by_period(name: str, table: Table) -> Table:
    fields = ((f.source, f.name, f.type, f.optional) for f in table.fields if f.name != "period")
    return _table(name, table.key, *fields, _PERIOD)


PERIOD_ORDERS = _by_period("period_orders", TRANSACTIONS)
PERIOD_ITEMS = _by_period("period_items", ORDER_ITEMS)
PERIOD_TRANSACTIONS = _by_period("period_transactions", TRANSACTION_METRICS)
CUSTOMER_PARTIALS = _table(
    "customer_partials", ["period", "customer_id"],
    ("customer_id", "customer_id", "string"),
    ("n_rows", "n_rows", "bigint"),
    ("items_sum", "items_sum", TOTAL),
    ("items_counted", "items_counted", "bigint"),
    ("n_orders", "n_orders", "bigint"),
    ("last_purchase", "last_purchase", "timestamp"),
    _PERIOD,
)
CUSTOMER_PRODUCTS = _table(
    "customer_products", ["period", "customer_id", "product_id"],
    ("customer_id", "customer_id", "string"),
    ("product_id", "product_id", "string"),
    _PERIOD,
)
PRODUCT_PARTIALS = _table(
    "product_partials", ["period", "product_id"],
    ("product_id", "product_id", "string"),
    ("units_sold", "units_sold", "bigint"),
    ("sales", "sales", TOTAL),
    ("prices", "prices", TOTAL),
    ("n_prices", "n_prices", "bigint"),
    _PERIOD,
)

CALENDAR = _table(
    "calendar", ["period"],
    ("period", "period", "string"),
    ("first_day", "first_day", "date"),
    ("year", "year", "int"),
    ("quarter", "quarter", "string"),
)
TRANSACTIONS_BY_ORDER = Table("transactions_by_order", TRANSACTIONS.fields, TRANSACTIONS.key)
ITEMS_BY_ORDER = Table("items_by_order", ORDER_ITEMS.fields, ORDER_ITEMS.key)

QUARANTINE = _table(
    "quarantine", [],
    ("table_name", "table_name", "string"),
    ("problems", "problems", "string"),
    ("dropped", "dropped", "boolean"),
    ("record", "record", "string"),
)

# Which column of a table names a row of which other table.
FOREIGN_KEYS = {
    "transactions": (("customer_id", "customers"),),
    "order_items": (("order_id", "transactions"), ("product_id", "products")),
    "reviews": (("customer_id", "customers"), ("product_id", "products")),
}

# The flat order view and the segment table under the names existing reports use.
SOURCE_VIEWS = {
    "flat_orders": "bronze_pelanggan",
    "gold_segments": "gold_segmentasi_pelanggan",
}
FLAT_ORDERS = _table(
    "flat_orders", ["order_id", "product_id"],
    *((f.source, f.name, f.type) for f in COMPLETED_ORDERS.fields),
)

LOAD_COUNTS = _table(
    "load_counts", ["table_name", "problem"],
    ("table_name", "table_name", "string"),
    ("problem", "problem", "string"),
    ("n_checked", "n_checked", "bigint"),
    ("n_found", "n_found", "bigint"),
)

GOLD = {
    t.name: t
    for t in (
        TRANSACTION_METRICS, CUSTOMER_METRICS, PRODUCT_METRICS, PROVINCE_METRICS, CITY_METRICS,
        CUSTOMER_SEGMENTS, GOLD_SEGMENTS,
    )
}


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    """Raise ``ValueError`` naming every column of ``columns`` that ``df`` lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")


def conform(df: DataFrame, table: Table) -> DataFrame:
    """``df`` with exactly the columns and types of ``table``; raises if a column is missing."""
    require_columns(df, (f.name for f in table.fields if not f.optional), table.name)
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.type).alias(f.name)
            for f in table.fields
        )
    )


def with_source_names(df: DataFrame, table: Table) -> DataFrame:
    """``df`` under the column names existing reports use."""
    return df.select(*(F.col(f.name).alias(f.source) for f in table.fields if f.name in df.columns))
