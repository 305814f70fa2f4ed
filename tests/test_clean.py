from __future__ import annotations

import datetime as dt

import pytest

from orderlake import schemas
from orderlake.operators import clean
from orderlake.sources.bronze import read_bronze


def text(spark, table, *records):
    """A raw text frame from dicts; columns not given are null."""
    ddl = ", ".join(f"{c} string" for c in table.columns)
    return spark.createDataFrame([tuple(r.get(c) for c in table.columns) for r in records], ddl)


def only(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def test_customers_postal_code_stays_text_and_missing_is_filled(spark, rows):
    raw = text(
        spark, schemas.CUSTOMERS,
        {"customer_id": "C1", "postal_code": "01234", "city": "  Medan ", "province": " Aceh"},
        {"customer_id": "C2", "city": "Padang", "province": "Riau "},
    )
    cleaned = clean.clean_customers(raw)
    assert dict(cleaned.dtypes)["postal_code"] == "string"
    assert rows(cleaned) == [("C1", "01234", "Medan", "Aceh"), ("C2", "00000", "Padang", "Riau")]


def test_products_price_and_category(spark, rows):
    raw = text(
        spark, schemas.PRODUCTS,
        {"product_id": "P1", "price": "10.5", "category": " toys "},
        {"product_id": "P2", "price": "abc", "category": None},
        {"product_id": "P3", "price": "NaN", "category": "x"},
        {"product_id": "P4", "price": "Infinity", "category": "x"},
    )
    assert rows(clean.clean_products(raw)) == [
        ("P1", 10.5, "toys"), ("P2", None, None), ("P3", None, "x"), ("P4", None, "x"),
    ]


def test_transactions_malformed_values_become_null(spark):
    good = {
        "order_id": "O1", "customer_id": "C1", "total_payment": "99.5", "installments": "3",
        "purchased_at": "2024-01-02 03:04:05", "approved_at": "2024-13-40 00:00:00",
        "estimated_arrival": "2024-01-09", "order_status": "Selesai",
    }
    row = only(clean.clean_transactions(text(spark, schemas.TRANSACTIONS, good)))
    assert (row.total_payment, row.installments) == (99.5, 3)
    assert row.purchased_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert row.approved_at is None and row.shipped_at is None
    assert row.estimated_arrival == dt.date(2024, 1, 9)
    bad = dict(good, total_payment="x", installments="", estimated_arrival="2024/01/09")
    row = only(clean.clean_transactions(text(spark, schemas.TRANSACTIONS, bad)))
    assert (row.total_payment, row.installments, row.estimated_arrival) == (None, None, None)


def test_transactions_without_a_status_column(spark):
    raw = text(spark, schemas.TRANSACTIONS, {"order_id": "O1"}).drop("order_status")
    row = only(clean.clean_transactions(raw))
    assert row.order_status is None


def test_order_items_integer_quantity_cuts_fraction(spark, rows):
    raw = text(
        spark, schemas.ORDER_ITEMS,
        {"order_id": "O1", "product_id": "P1", "quantity": "2.9", "price": "1", "item_total": "2"},
        {"order_id": "O1", "product_id": "P2", "quantity": "many", "price": "1", "item_total": "2"},
    )
    assert rows(clean.clean_order_items(raw), "product_id", "quantity") == [("P1", 2), ("P2", None)]


def test_copies_keep_the_first_row_of_a_fixed_order(spark, rows):
    records = [
        {"order_id": "O1", "product_id": "P1", "price": p, "quantity": q, "item_total": t}
        for p, q, t in [("5", "1", "5"), ("3", "9", "27"), ("3", "2", "6"), ("bad", "1", "1")]
    ]
    expected = [("O1", "P1", 3.0, 2, 6.0)]
    for order in (records, records[::-1], records[2:] + records[:2]):
        raw = text(spark, schemas.ORDER_ITEMS, *order).repartition(3)
        assert rows(clean.clean_order_items(raw)) == expected


@pytest.mark.parametrize(
    "name, key",
    [
        ("customers", {"customer_id": "K"}),
        ("products", {"product_id": "K"}),
        ("transactions", {"order_id": "K"}),
        ("order_items", {"order_id": "K", "product_id": "L"}),
        ("reviews", {"customer_id": "K", "product_id": "L"}),
    ],
)
def test_one_row_per_key(spark, name, key):
    table = schemas.BRONZE[name]
    raw = text(spark, table, key, key, key, {k: v + "2" for k, v in key.items()})
    assert clean.CLEANERS[name](raw).count() == 2


def test_rows_without_a_key_count_as_one_key(spark):
    raw = text(spark, schemas.PRODUCTS, {"price": "1"}, {"price": "2"}, {"product_id": "P1"})
    assert clean.clean_products(raw).count() == 2


def test_copies_are_dropped_before_the_shuffle(spark):
    raw = text(spark, schemas.REVIEWS, {"customer_id": "C", "product_id": "P"})
    plan = clean.clean_reviews(raw)._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_reviews_rating_and_date(spark):
    raw = text(
        spark, schemas.REVIEWS,
        {"customer_id": "C", "product_id": "P", "rating": "4.5", "review_date": "2024-02-29"},
    )
    cleaned = clean.clean_reviews(raw)
    assert dict(cleaned.dtypes)["rating"] == "float"
    row = only(cleaned)
    assert (row.rating, row.review_date) == (4.5, dt.date(2024, 2, 29))


def test_sellers_pass_through(spark, rows):
    raw = text(spark, schemas.SELLERS, *[{"seller_id": "S1", "city": " A ", "province": "B"}] * 2)
    assert rows(clean.clean_sellers(raw)) == [("S1", " A ", "B")] * 2


def test_rejected_values_are_counted_per_column(spark, rows):
    raw = text(
        spark, schemas.ORDER_ITEMS,
        {"order_id": "O1", "price": "abc", "quantity": "1", "item_total": None},
        {"order_id": "O2", "price": "2", "quantity": "x", "item_total": "NaN"},
        {"order_id": "O3", "price": "y", "quantity": "3", "item_total": "1"},
    )
    assert rows(clean.rejected_values(raw, schemas.ORDER_ITEMS)) == [
        ("order_items", "item_total", 2, 1),
        ("order_items", "price", 3, 2),
        ("order_items", "quantity", 3, 1),
    ]


def test_missing_column_is_named(spark):
    raw = text(spark, schemas.PRODUCTS, {"product_id": "P"}).drop("price")
    with pytest.raises(ValueError, match="price"):
        clean.clean_products(raw)


def test_csv_columns_are_found_by_header_name(spark, tmp_path, rows):
    folder = tmp_path / "products"
    folder.mkdir()
    (folder / "a.csv").write_text('kategori_produk,extra,harga,id_produk\n"a, b",1,07,P1\n,2,,P2\n')
    raw = read_bronze(spark, str(folder), schemas.PRODUCTS)
    assert rows(raw) == [("P1", "07", "a, b", "1", None), ("P2", None, None, "2", None)]


def test_csv_with_another_header_order_fails_instead_of_shifting(spark, tmp_path):
    folder = tmp_path / "products"
    folder.mkdir()
    (folder / "a.csv").write_text("id_produk,harga,kategori_produk\nP1,1,x\n")
    (folder / "b.csv").write_text("harga,id_produk,kategori_produk\n1,P2,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_bronze(spark, str(folder), schemas.PRODUCTS).collect()


def test_csv_without_a_required_column_fails(spark, tmp_path):
    folder = tmp_path / "products"
    folder.mkdir()
    (folder / "a.csv").write_text("id_produk,kategori_produk\nP1,x\n")
    with pytest.raises(ValueError, match="harga"):
        read_bronze(spark, str(folder), schemas.PRODUCTS)
