"""Order-dependent operators that hold for groups of any size.

A window runs each group in one task. Groups of up to `HOT_ROWS` rows do just that. A larger
group, or a whole table taken as one group, is cut by range partitioning into consecutive
slices; each slice gets its own window, and a carry per slice (a table with one row for each
slice and group) joins the slices together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators.rows import beside
from lakemill.session import settle


HOT_ROWS = 1_000_000
SAMPLED_ROWS = 20_000
ROWS = "_rows"
PLACE_BITS = 33  # of `monotonically_increasing_id`: the place in a partition, below its number
SLICE, LOCAL, SEGMENT_ROWS = "_slice", "_local", "_segment_rows"


def order_columns(order: Sequence[str]) -> list[tuple[str, bool]]:
    """`["sales desc", "id"]` gives `[("sales", True), ("id", False)]`."""
    out = []
    for item in order:
        name, _, direction = item.rpartition(" ")
        if direction.lower() in ("asc", "desc") and name:
            out.append((name, direction.lower() == "desc"))
        else:
            out.append((item, False))
    return out


def sort_columns(order: Sequence[str]) -> list[Column]:
    """Nulls last in both directions."""
    return [
        F.col(f"`{name}`").desc_nulls_last() if down else F.col(f"`{name}`").asc_nulls_last()
        for name, down in order_columns(order)
    ]


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[f"`{key}`"].eqNullSafe(right[f"`{key}`"])
    return condition


@dataclass(frozen=True)
class Split:
    """A frame parted by group size; `hot` is None when every group fits in one task.

    `hot_rows` is about the number of rows in the hot groups.
    """

    cold: DataFrame | None
    hot: DataFrame | None
    hot_rows: int = 0


def split_groups(df: DataFrame, group: Sequence[str], hot_rows: int) -> Split:
    """Parts the groups of more than `hot_rows` rows from the others.

    Large groups are found in a sample that holds about `SAMPLED_ROWS` rows of each: a group
    near the bound may fall on either side, which changes the way it is computed and not the
    result.
    """
    if not group:
        rows = df.count()
        return Split(df, None) if rows <= hot_rows else Split(None, df, rows)
    part = min(1.0, SAMPLED_ROWS / hot_rows)
    keys = df.select(*[F.col(f"`{g}`") for g in group])
    seen = keys if part == 1.0 else keys.sample(fraction=part, seed=1)
    sizes = seen.groupBy(*[F.col(f"`{g}`") for g in group]).agg(F.count(F.lit(1)).alias(ROWS))
    # As many rows as there are hot groups: stored, and joined as their measured size allows.
    hot = settle(sizes.filter(F.col(ROWS) > hot_rows * part), "hot-groups")
    rows = hot.agg(F.sum(ROWS)).first()[0]
    if not rows:
        return Split(df, None)
    condition = same_keys(df, hot, group)
    return Split(df.join(hot, condition, "left_anti"), df.join(hot, condition, "left_semi"), int(rows / part))


def cut_slices(df: DataFrame, group: Sequence[str], order: Sequence[str], slices: int) -> DataFrame:
    """Settled rows with the number of their slice; a slice is a run of the sorted rows."""
    keys = [F.col(f"`{g}`").asc_nulls_last() for g in group] + sort_columns(order)
    ranged = df.repartitionByRange(slices, *keys).withColumn(SLICE, F.spark_partition_id())
    return settle(ranged, "slices")


def scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    totals: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Adds order-dependent columns inside each group.

    `order` must be a total order. `number` counts rows from 1; `totals` maps a new column to
    the column it sums from the group's first row to this one; `previous` and `following` map
    a new column to the column taken from the row before or after.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    wanted = (number, dict(totals or {}), dict(previous or {}), dict(following or {}))
    split = split_groups(df, group, limit)
    parts = []
    if split.cold is not None:
        parts.append(_whole_groups(split.cold, group, order, *wanted))
    if split.hot is not None:
        slices = max(2, -(-split.hot_rows // limit))
        parts.append(_sliced_groups(split.hot, group, order, slices, *wanted))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*sort_columns(order))


def _to_here(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _whole_groups(df, group, order, number, totals, previous, following):
    window = _window(group, order)
    added = {}
    if number:
        added[number] = F.row_number().over(window).cast("bigint")
    for name, source in totals.items():
        added[name] = F.sum(f"`{source}`").over(_to_here(window))
    for name, source in previous.items():
        added[name] = F.lag(f"`{source}`").over(window)
    for name, source in following.items():
        added[name] = F.lead(f"`{source}`").over(window)
    return df.withColumns(added)


def _sliced_groups(df, group, order, slices, number, totals, previous, following):
    segment = [SLICE, *group]
    rows = cut_slices(df, group, order, slices)
    window = _window(segment, order)
    whole = Window.partitionBy(*[F.col(f"`{k}`") for k in segment])
    places = {LOCAL: F.row_number().over(window).cast("bigint")}
    if previous or following:
        places[SEGMENT_ROWS] = F.count(F.lit(1)).over(whole)
    local = rows.withColumns(places)

    # One row for each slice and group: the sums and the end values that pass to other slices.
    ends = [F.count(F.lit(1)).alias("_n")]
    ends += [F.sum(f"`{source}`").alias(f"_sum_{name}") for name, source in totals.items()]
    for name, source in previous.items():
        last = F.when(F.col(LOCAL) == F.col(SEGMENT_ROWS), F.col(f"`{source}`"))
        ends.append(F.max(last).alias(f"_last_{name}"))
    for name, source in following.items():
        first = F.when(F.col(LOCAL) == 1, F.col(f"`{source}`"))
        ends.append(F.max(first).alias(f"_first_{name}"))
    summed = local if previous or following else rows
    segments = summed.groupBy(*[F.col(f"`{k}`") for k in segment]).agg(*ends)

    across = _window(group, [SLICE])
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry")]
    carried += [F.sum(f"_sum_{name}").over(before).alias(f"_carry_{name}") for name in totals]
    carried += [F.lag(f"_last_{name}").over(across).alias(f"_carry_{name}") for name in previous]
    carried += [F.lead(f"_first_{name}").over(across).alias(f"_carry_{name}") for name in following]
    carry = segments.select(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(segment)], *carried)
    carry = settle(carry, "carry")  # a row for each slice and group, joined as its size allows

    match = F.lit(True)
    for i, key in enumerate(segment):
        match = match & local[f"`{key}`"].eqNullSafe(carry[f"_key_{i}"])
    joined = local.join(carry, match, "left")

    added = {}
    if number:
        added[number] = F.col(LOCAL) + F.col("_carry")
    for name, source in totals.items():
        here = F.sum(f"`{source}`").over(_to_here(window))
        passed = F.col(f"_carry_{name}")
        added[name] = F.when(here.isNull(), passed).otherwise(
            here + F.coalesce(passed, passed * 0, F.lit(0))
        )
    for name, source in previous.items():
        added[name] = F.when(F.col(LOCAL) == 1, F.col(f"_carry_{name}")).otherwise(
            F.lag(f"`{source}`").over(window)
        )
    for name, source in following.items():
        added[name] = F.when(F.col(LOCAL) == F.col(SEGMENT_ROWS), F.col(f"_carry_{name}")).otherwise(
            F.lead(f"`{source}`").over(window)
        )
    kept = [F.col(f"`{c}`") for c in [*df.columns, *added]]
    return joined.withColumns(added).select(*kept)


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, **options) -> DataFrame:
    """Row number from 1 in each group."""
    if group:
        return scan(df, group, order, number=name, **options)
    return positions(df, order, name)


def positions(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Row number from 1 over the whole frame; `order` must be a total order.

    The rows are range partitioned, sorted within partitions and settled with their place in
    the partition; the number of rows in the partitions before is added. No task sees more
    than its partition, and no window runs over the rows.
    """
    keys = sort_columns(order)
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    rows = settle(placed, "positions")
    part = F.shiftright("_at", PLACE_BITS)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + F.col("_offset") + 1
    numbered_rows = rows.join(F.broadcast(offsets), part == F.col("_part"))
    return numbered_rows.select(*[F.col(f"`{c}`") for c in df.columns], place.alias(name))


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, source: str, **options) -> DataFrame:
    return scan(df, group, order, totals={name: source}, **options)


def end_values(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    *,
    first: Mapping[str, str] | None = None,
    last: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """`FIRST_VALUE` and `LAST_VALUE` over the whole group, from aggregates joined back."""
    place = F.struct(*[F.col(f"`{c}`") for c in order])
    ends = [F.min_by(f"`{c}`", place).alias(name) for name, c in (first or {}).items()]
    ends += [F.max_by(f"`{c}`", place).alias(name) for name, c in (last or {}).items()]
    found = df.groupBy(*[F.col(f"`{g}`") for g in group]).agg(F.count(F.lit(1)).alias(ROWS), *ends)
    return attach(df, settle(found, "ends"), group, ROWS, **options)


def ranked(
    df: DataFrame,
    group: Sequence[str],
    by: Sequence[str],
    name: str,
    *,
    dense: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """`RANK` (or `DENSE_RANK`): rows equal in `by` share a rank."""
    limit = HOT_ROWS if hot_rows is None else hot_rows
    split = split_groups(df, group, limit)
    parts = []
    if split.cold is not None:
        function = F.dense_rank() if dense else F.rank()
        parts.append(split.cold.withColumn(name, function.over(_window(group, by)).cast("bigint")))
    if split.hot is not None:
        keys = [*group, *[column for column, _ in order_columns(by)]]
        levels = split.hot.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(ROWS))
        levels = scan(settle(levels, "levels"), group, by, number="_level", totals={"_to": ROWS}, hot_rows=limit)
        place = F.col("_level") if dense else F.col("_to") - F.col(ROWS) + 1
        levels = levels.withColumn(name, place.cast("bigint")).select(
            *[F.col(f"`{k}`") for k in keys], ROWS, name
        )
        parts.append(attach(split.hot, settle(levels, "ranks"), keys, ROWS, hot_rows=limit))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def tiled(df: DataFrame, order: Sequence[str], tiles: int, name: str) -> DataFrame:
    """`NTILE` over the whole frame: the first tiles take the rows left over."""
    placed = positions(df, order, "_place")
    counted = beside(placed, df.agg(F.count(F.lit(1)).alias("_count")))
    size = F.floor(F.col("_count") / tiles)
    extra = F.col("_count") % tiles
    inside = F.floor((F.col("_place") - 1) / (size + 1)) + 1
    beyond = extra + F.floor((F.col("_place") - extra * (size + 1) - 1) / F.greatest(size, F.lit(1))) + 1
    tile = F.when(F.col("_place") <= extra * (size + 1), inside).otherwise(beyond)
    return counted.withColumn(name, tile.cast("bigint")).drop("_place", "_count")


def attach(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    weight: str,
    *,
    hot_rows: int | None = None,
) -> DataFrame:
    """Joins one `lookup` row per key to the rows of `df`, null keys included.

    `weight` is the lookup column that counts the rows of `df` with the key. Keys of more than
    `hot_rows` rows are stored and joined apart: as few rows as these keys are, their side is
    sent to all tasks by its measured size, and the rows of `df` stay where they are.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    hot = settle(lookup.filter(F.col(weight) > limit), "hot-keys")
    if hot.isEmpty():
        return _lookup_join(df, lookup.drop(weight), keys)
    rest = df.join(hot, same_keys(df, hot, keys), "left_anti")
    heavy_rows = _lookup_join(df, hot.drop(weight), keys)
    return heavy_rows.unionByName(_lookup_join(rest, lookup.drop(weight), keys))


def _lookup_join(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    added = [c for c in lookup.columns if c not in keys]
    side = lookup.select(
        *[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)],
        *[F.col(f"`{c}`") for c in added],
    )
    match = F.lit(True)
    for i, key in enumerate(keys):
        match = match & df[f"`{key}`"].eqNullSafe(side[f"_key_{i}"])
    return df.join(side, match, "inner").drop(*[f"_key_{i}" for i in range(len(keys))])
