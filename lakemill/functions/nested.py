"""JSON lists held as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Department names in a category path, and the two fallbacks.
DEPARTMENTS = ("Women", "Men", "Girls", "Boys", "Unisex", "Unisex Kids")
NO_MATCH = "Home & Other"
UNREADABLE = "Unknown"


def list_length(c: Column) -> Column:
    """Items of a JSON list; anything else counts 0."""
    return F.coalesce(F.json_array_length(c), F.lit(0)).cast("bigint")


def first_listed(
    c: Column,
    field: str = "name",
    wanted: Sequence[str] = DEPARTMENTS,
    no_match: str = NO_MATCH,
    unreadable: str = UNREADABLE,
) -> Column:
    """First `field` of a JSON list of objects that is one of `wanted`."""
    items = F.from_json(c, f"array<struct<`{field}`: string>>")
    names = F.transform(items, lambda item: item[field])
    found = F.get(F.filter(names, lambda name: name.isin(*wanted)), 0)
    return (
        F.when(F.json_array_length(c).isNull(), unreadable)
        .when(F.exists(names, lambda name: name.isNull()) & found.isNull(), unreadable)
        .otherwise(F.coalesce(found, F.lit(no_match)))
    )
