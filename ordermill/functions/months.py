"""Month keys (``yyyy-MM`` strings) and month-start dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.functions.numeric import as_column


def month_key(moment: Column | str) -> Column:
    return F.date_format(as_column(moment), "yyyy-MM")


def month_start(key: Column | str) -> Column:
    """First day of a ``yyyy-MM`` month; NULL if the text is no month."""
    return as_column(key).try_cast("date")


def shift_key(key: Column | str, months: int) -> Column:
    return month_key(F.add_months(month_start(key), months))


def month_label(key: Column | str) -> Column:
    """``Jun 2018`` for ``2018-06``."""
    return F.date_format(month_start(key), "MMM yyyy")


def normalized_key(value: Column | str) -> Column:
    """``yyyy-MM`` for a month key, a date or the text of one; NULL if unreadable."""
    return month_key(as_column(value).try_cast("date"))


def first_start_from(day: Column | str) -> Column:
    """The first month start that is not before ``day``."""
    day = as_column(day)
    start = F.trunc(day, "MM")
    return F.when(start == day, start).otherwise(F.add_months(start, 1))


def is_last_quarter(month_number: Column | str) -> Column:
    return F.when(as_column(month_number) >= 10, 1).otherwise(0)
