"""What loading rejects, kept with its reasons.

A raw row is rejected in part when a value is malformed (silver has null there), when its record is
broken or its key is null; it is dropped when another copy of its key stays. Every such row goes to
the quarantine as it was read. Silver rows and dropped rows together are the raw rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.operators.clean import parsed_fields
from orderlake.functions.parse import parse
from orderlake.schemas import BROKEN, Table
from orderlake.session import stored

_ROW, _PROBLEMS = "_row", "_problems"


def with_problems(raw: DataFrame, table: Table) -> DataFrame:
    """Raw rows with the list of what is wrong with each of them."""
    found = []
    if BROKEN in raw.columns:
        found.append(F.when(F.col(BROKEN).isNotNull(), "broken record"))
    if table.key:
        missing = F.lit(False)
        for k in table.key:
            missing |= F.col(k).isNull()
        found.append(F.when(missing, "null key"))
    for f in parsed_fields(table):
        if f.name in raw.columns:
            bad = F.col(f.name).isNotNull() & parse(F.col(f.name), f.type).isNull()
            found.append(F.when(bad, f"malformed {f.name}"))
    problems = F.array_compact(F.array(*found)) if found else F.array()
    return raw.withColumn(_PROBLEMS, problems.cast("array<string>"))


def cleaned_and_rejected(
    raw: DataFrame, table: Table, cleaner: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """(the cleaned table, the rejected rows): table_name, problems, dropped and record.

    ``raw`` is read once, into a stored copy whose rows are numbered. The number rides along while
    copies are removed, as the last column to order by, and a row whose number did not arrive was
    dropped. Numbers are spread evenly, so no key is hot in that join. Numbers alone are compared
    first; only rejected rows are written out as records. ``record`` is the raw row as JSON;
    ``problems`` of a dropped row ends with ``dropped copy``.
    """
    staged = stored(
        with_problems(raw, table).withColumn(_ROW, F.monotonically_increasing_id()), "staged"
    )
    numbered = cleaner(staged.drop(_PROBLEMS))
    kept = stored(numbered, "cleaned")
    values = [c for c in raw.columns if c != BROKEN]
    record = F.to_json(F.struct(*(F.col(f"`{c}`") for c in values)))
    if BROKEN in raw.columns:
        record = F.coalesce(F.col(BROKEN), record)
    numbers = staged.select(_ROW, (F.size(_PROBLEMS) > 0).alias("_noted"))
    arrived = kept.select(_ROW, F.lit(True).alias("_kept"))
    dropped = F.col("_kept").isNull()
    # stored, so that Spark knows how few they are before it moves any record
    found = stored(
        numbers.join(arrived, _ROW, "left")
        .filter(dropped | F.col("_noted"))
        .select(_ROW, dropped.alias("dropped")),
        "rejected",
    )
    problems = F.when(
        F.col("dropped"), F.array_append(_PROBLEMS, "dropped copy")
    ).otherwise(F.col(_PROBLEMS))
    rejected = staged.join(found, _ROW).select(
        problems.alias(_PROBLEMS), "dropped", record.alias("record")
    )
    return kept.drop(_ROW), rejected.select(
        F.lit(table.name).alias("table_name"),
        F.array_join(_PROBLEMS, ", ").alias("problems"),
        "dropped",
        "record",
    )
