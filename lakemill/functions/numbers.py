"""Number columns. Money is decimal before any arithmetic; a zero divisor gives null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column, precision: int = 12) -> Column:
    return c.cast(f"decimal({precision},2)")


def round_half_up(c: Column, places: int = 2) -> Column:
    """Rounds the decimal value, so 1.005 gives 1.01 for doubles as well."""
    return F.round(c.cast("decimal(38,8)"), places)


def to_number(c: Column, scale: int = 2) -> Column:
    """Text to decimal; text that is no number, or does not fit 38 digits, gives null."""
    return c.try_cast(f"decimal(38,{scale})")


def to_whole(c: Column) -> Column:
    return c.try_cast("decimal(20,4)").try_cast("bigint")


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limits to a range and keeps null, which `least` and `greatest` alone would not."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low).cast("decimal(18,2)"))
    if high is not None:
        out = F.least(out, F.lit(high).cast("decimal(18,2)"))
    return F.when(c.isNotNull(), out)


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return round_half_up(ratio(part, whole) * 100, places)


def mean_of(total: Column, count: Column, places: int = 2) -> Column:
    """Mean of a decimal total, rounded; summing first keeps the result independent of order."""
    return round_half_up(ratio(total, count), places)


def percent_change(current: Column, previous: Column) -> Column:
    change = round_half_up(100 * ratio(current - previous, previous))
    return F.when(previous != 0, change)


def net_revenue(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    share = (F.lit(100) - discount_percent.cast("decimal(5,2)")) * F.lit("0.01").cast("decimal(3,2)")
    gross = quantity.try_cast("decimal(19,0)") * unit_price.cast("decimal(12,2)")
    return (gross * share).try_cast("decimal(28,6)")


def weighted_score(
    rating: Column, count: Column, mean_rating: Column, mean_count: Column
) -> Column:
    """Pulls a rating towards the overall mean when few ratings stand behind it."""
    return F.try_divide(count * rating + mean_count * mean_rating, count + mean_count)


def bucket(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Labels right-closed ranges `(edge, next edge]`; outside them gives null."""
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        test = (c > low) & (c <= high)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out
