"""Date and time columns. Text that does not fit the format gives null."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date layouts accepted by the cleaners, tried in this order.
DATE_LAYOUTS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy")
ORDER_TIME_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss",
    "dd-MM-yyyy",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
)
SECONDS_PER_DAY = 86400


def has_layout(c: Column, layout: str) -> Column:
    """Whether text has the shape of a layout, its numbers padded or not; spares failed parses."""
    shape = re.sub("([a-zA-Z])\\1*", lambda m: r"\d{4}" if m[0] == "yyyy" else r"\d{1,2}", layout.replace("'T'", "\0"))
    fits = c.rlike("^" + shape.replace("\0", "T") + "$")
    # A look at one sign spares most of the texts of other layouts the pattern.
    return (F.substring(c, 5, 1) == layout[4]) & fits if layout.startswith("yyyy") else fits


def lenient(layout: str) -> str:
    """The layout for a parser that takes numbers with or without a leading zero."""
    return re.sub("MM|dd|HH|mm|ss", lambda m: m[0][0], layout)


def parse_date(c: Column, layouts: Sequence[str] = ("yyyy-MM-dd",)) -> Column:
    return F.coalesce(*[F.when(has_layout(c, x), F.try_to_date(c, lenient(x))) for x in layouts])


def parse_timestamp(c: Column, layouts: Sequence[str] = ("yyyy-MM-dd HH:mm:ss",)) -> Column:
    return F.coalesce(*[F.when(has_layout(c, x), F.try_to_timestamp(c, F.lit(lenient(x)))) for x in layouts])


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def year_month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_number(c: Column) -> Column:
    """Months since year 0, so that a difference is a count of calendar months."""
    return (F.year(c) * 12 + F.month(c)).cast("bigint")


def months_apart(later: Column, earlier: Column) -> Column:
    return month_number(later) - month_number(earlier)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days of elapsed time, not a difference of calendar dates."""
    seconds = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return (seconds / (SECONDS_PER_DAY * 1_000_000)).cast("bigint")


def moment(day: str | date) -> Column:
    """A zone-free literal: compared with a raw column it reaches the Parquet scan."""
    return F.lit(str(day)).cast("timestamp_ntz")


def previous_span(start: str, end: str) -> tuple[str, str]:
    """The span of equal length that ends the day before `start`; both ends inclusive."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    before = first - timedelta(days=1)
    return str(before - (last - first)), str(before)


def next_day(day: str) -> str:
    return str(date.fromisoformat(day) + timedelta(days=1))
