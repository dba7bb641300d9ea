"""Date expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def iso_date(name: str) -> Column:
    """A strict ISO day string as a date; anything else is null (never an error)."""
    return F.expr(f"CASE WHEN `{name}` RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' THEN try_cast(`{name}` AS DATE) END")


def day_number(name: str) -> Column:
    """Days since 1970-01-01 of an ISO day string, null if it is not one."""
    return F.datediff(iso_date(name), F.lit(EPOCH).cast("date"))


def number_to_iso(number: Column) -> Column:
    """The ISO day string of a day number."""
    return F.date_format(F.date_add(F.lit(EPOCH).cast("date"), number.cast("int")), "yyyy-MM-dd")


def day_key(day: Column) -> Column:
    """A date as the integer YYYYMMDD."""
    return F.year(day).cast("bigint") * 10000 + F.month(day) * 100 + F.dayofmonth(day)
