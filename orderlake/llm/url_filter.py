"""URL filters: a temporal join of captures with dated lists.

A list says on dates which hosts, domains or URL prefixes enter or leave it. Its entries become
validity intervals: consecutive entries of one pattern that say the same are one, and an interval
ends where the next one begins. A capture is then evaluated against the entries active when it was
fetched: for each of its keys (host, each parent domain, each path prefix) the interval in force.

The join is on key and month: intervals are written out for the months they touch and captures
stand in one month each, so a key with very many changes, or a host with very many captures, is
spread over months, and a capture meets only intervals near its own time. All of it is DataFrame
operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import narrowed, stored


def url_host(url: Column) -> Column:
    """The host in lower case without user, port and final dot; empty if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(host), r"\.+$", "")


def url_path(url: Column) -> Column:
    """The path without query and fragment, at least one slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def url_keys(host: Column, path: Column) -> Column:
    """What may match a URL: ``host:…``, ``domain:…`` for each parent, ``prefix:host/a/…``."""
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    # a sequence from 1 down to 0 would run backwards
    prefixes = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.concat(
                F.lit("prefix:"), host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")
            ),
        ),
    ).otherwise(F.array().cast("array<string>"))
    keys = F.concat(F.array(F.concat(F.lit("host:"), host)), parents, prefixes)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) from entries (list, key, dated, active).

    An interval holds from its date to just before the next change; the last one has no end. Of
    entries of one list and key on the same date an active one wins. Entries that lack a list,
    key, date or state are left out.
    """
    changes = (
        entries.select("list", "key", "dated", "active")
        .dropna()
        .groupBy("list", "key", "dated")
        .agg(F.max("active").alias("active"))
    )
    order = Window.partitionBy("list", "key").orderBy("dated")
    changed = changes.withColumn("before", F.lag("active").over(order)).filter(
        F.col("before").isNull() | (F.col("before") != F.col("active"))
    )
    ended = changed.withColumn("valid_to", F.lead("dated").over(order))
    return ended.filter("active").select("list", "key", F.col("dated").alias("valid_from"), "valid_to")


def filtered_urls(
    captures: DataFrame,
    entries: DataFrame,
    *,
    id_column: str = "page_id",
    url: str = "url",
    fetched: str = "fetched",
) -> DataFrame:
    """One row per capture: id, host, fetched, n_matches, lists (sorted, comma-joined), blocked.

    Captures without URL, host or fetch date match nothing and are not blocked. Repeated rows stay
    separate rows. Without entries nothing is blocked. Other columns are ignored.
    """
    rows = stored(
        narrowed(captures, page_id=id_column, url=url, fetched=fetched)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("host", url_host(F.coalesce("url", F.lit("")))),
        "captures",
    )
    keyed = rows.filter("fetched IS NOT NULL").select(
        "row",
        "fetched",
        F.trunc("fetched", "month").alias("month"),
        F.explode(F.array_distinct(url_keys(F.col("host"), url_path(F.col("url"))))).alias("key"),
    )
    # intervals are cut to the months that captures have
    first, last = (
        F.lit(value).cast("date")
        for value in rows.agg(
            F.trunc(F.min("fetched"), "month"), F.trunc(F.max("fetched"), "month")
        ).first()
    )
    ends = F.coalesce(F.trunc("valid_to", "month"), last)
    bounded = (
        validity_intervals(entries)
        .withColumn("low", F.greatest(F.trunc("valid_from", "month"), first))
        .withColumn("high", F.least(ends, last))
        .filter("low <= high")
    )
    months = F.sequence("low", "high", F.expr("interval 1 month"))
    by_month = bounded.withColumn("month", F.explode(months)).drop("low", "high")
    matched = keyed.join(by_month, ["key", "month"]).filter(
        (F.col("valid_from") <= F.col("fetched"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    )
    found = matched.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_matches"),
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
    )
    return rows.join(found, "row", "left").select(
        "page_id",
        "host",
        "fetched",
        F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("n_matches").isNotNull().alias("blocked"),
    )
