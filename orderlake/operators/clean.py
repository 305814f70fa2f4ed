"""Bronze to silver: typed, trimmed, null-filled tables with one row per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from orderlake import schemas
from orderlake.functions.parse import parse
from orderlake.schemas import Field, Table, require_columns


def dedup(df: DataFrame, keys: Iterable[str], order_by: Iterable[str | Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark limits each group to its first row before the shuffle (``WindowGroupLimit``), so a key
    with very many copies sends one row per map task.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy")


def typed(df: DataFrame, table: Table) -> DataFrame:
    """The columns of ``table`` parsed from text, then all other columns as they are."""
    require_columns(df, (f.name for f in table.fields if not f.optional), table.name)
    return df.select(
        *(
            parse(F.col(f.name) if f.name in df.columns else F.lit(None).cast("string"), f.type)
            .alias(f.name)
            for f in table.fields
        ),
        *(F.col(f"`{c}`") for c in table.extended(df.columns).columns if c not in table.columns),
    )


def _one_per_key(df: DataFrame, table: Table) -> DataFrame:
    """One row per key; among copies the smallest by the other columns, in the order they stand.

    Nulls come last, so a copy with a malformed value loses against one with a good value.
    """
    others = [c for c in df.columns if c not in table.key]
    return dedup(df, table.key, [F.asc_nulls_last(f"`{c}`") for c in others])


def clean_customers(df: DataFrame) -> DataFrame:
    customers = typed(df, schemas.CUSTOMERS).withColumns(
        {
            "postal_code": F.coalesce("postal_code", F.lit(schemas.MISSING_POSTAL_CODE)),
            "city": F.trim("city"),
            "province": F.trim("province"),
        }
    )
    return _one_per_key(customers, schemas.CUSTOMERS)


def clean_products(df: DataFrame) -> DataFrame:
    products = typed(df, schemas.PRODUCTS).withColumn("category", F.trim("category"))
    return _one_per_key(products, schemas.PRODUCTS)


def clean_transactions(df: DataFrame) -> DataFrame:
    return _one_per_key(typed(df, schemas.TRANSACTIONS), schemas.TRANSACTIONS)


def clean_order_items(df: DataFrame) -> DataFrame:
    return _one_per_key(typed(df, schemas.ORDER_ITEMS), schemas.ORDER_ITEMS)


def clean_reviews(df: DataFrame) -> DataFrame:
    return _one_per_key(typed(df, schemas.REVIEWS), schemas.REVIEWS)


def clean_sellers(df: DataFrame) -> DataFrame:
    """Sellers pass through unchanged."""
    return typed(df, schemas.SELLERS)


CLEANERS = {
    "customers": clean_customers,
    "products": clean_products,
    "transactions": clean_transactions,
    "order_items": clean_order_items,
    "reviews": clean_reviews,
    "sellers": clean_sellers,
}


def parsed_fields(table: Table) -> list[Field]:
    return [f for f in table.fields if f.type != "string"]


def rejected_values(raw: DataFrame, table: Table) -> DataFrame:
    """Per parsed column: how many values were present and how many of them were malformed.

    One pass over the raw table; only tables with a column to parse have an answer.
    """
    parsed = [f for f in parsed_fields(table) if f.name in raw.columns]
    present = {f.name: F.col(f.name).isNotNull() for f in parsed}
    counts = raw.agg(
        *(
            F.struct(
                F.count_if(present[f.name]).alias("n_values"),
                F.count_if(present[f.name] & parse(F.col(f.name), f.type).isNull())
                .alias("n_rejected"),
            ).alias(f.name)
            for f in parsed
        )
    )
    return counts.unpivot([], [f.name for f in parsed], "column_name", "counts").select(
        F.lit(table.name).alias("table_name"), "column_name", "counts.n_values", "counts.n_rejected"
    )


def load_checks(raw: DataFrame, table: Table) -> dict[str, tuple[Column, Column]]:
    """What to count while a raw table is loaded: per problem (rows looked at, rows found).

    Broken records have fields that do not match the header; rows with a null in their key
    collapse into one; malformed values become null.
    """
    checks = {}
    if schemas.BROKEN in raw.columns:
        checks["broken record"] = (
            F.count(F.lit(1)),
            F.count_if(F.col(schemas.BROKEN).isNotNull()),
        )
    if table.key:
        missing = F.lit(False)
        for k in table.key:
            missing |= F.col(k).isNull()
        checks["null key"] = (F.count(F.lit(1)), F.count_if(missing))
    for f in parsed_fields(table):
        if f.name in raw.columns:
            present = F.col(f.name).isNotNull()
            bad = present & parse(F.col(f.name), f.type).isNull()
            checks[f"malformed {f.name}"] = (F.count_if(present), F.count_if(bad))
    return checks


class LoadCounts:
    """Counts ``load_checks`` while a table passes, without a pass of their own."""

    def __init__(self, table: Table):
        self.table = table
        self.observation = Observation(f"load {table.name}")
        self.problems: list[str] = []

    def watch(self, raw: DataFrame) -> DataFrame:
        checks = load_checks(raw, self.table)
        self.problems = list(checks)
        if not checks:
            return raw
        columns = []
        for i, (checked, found) in enumerate(checks.values()):
            columns += [checked.alias(f"checked_{i}"), found.alias(f"found_{i}")]
        return raw.observe(self.observation, *columns)

    def rows(self) -> list[tuple[str, str, int, int]]:
        """(table, problem, rows looked at, rows found), once the table was written."""
        if not self.problems:
            return []
        seen = self.observation.get
        return [
            (self.table.name, problem, seen[f"checked_{i}"], seen[f"found_{i}"])
            for i, problem in enumerate(self.problems)
        ]
