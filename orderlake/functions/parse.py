"""Text to typed values; anything malformed becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the raw files.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def as_double(c: Column) -> Column:
    """A finite number or null."""
    number = c.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def as_float(c: Column) -> Column:
    number = c.try_cast("float")
    return F.when(F.abs(number) < float("inf"), number)


def as_int(c: Column) -> Column:
    """An integer; a fraction is cut off."""
    return F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"))


def as_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(TIMESTAMP_FORMAT))


def as_date(c: Column) -> Column:
    return F.try_to_date(c, DATE_FORMAT)


PARSERS = {
    "double": as_double,
    "float": as_float,
    "int": as_int,
    "timestamp": as_timestamp,
    "date": as_date,
}


def parse(c: Column, type_name: str) -> Column:
    """``c`` (text) as ``type_name``."""
    return PARSERS[type_name](c) if type_name in PARSERS else c.cast(type_name)
