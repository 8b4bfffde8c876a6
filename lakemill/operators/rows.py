"""One-row frames beside other rows, and rows of small inputs on all cores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only_row(df: DataFrame) -> Column:
    """The only row of a frame as a struct: a scalar subquery, not a join."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns])).scalar()


def beside(df: DataFrame, row: DataFrame) -> DataFrame:
    """Adds the columns of a one-row frame to every row."""
    only = only_row(row)
    return df.withColumns({c: only[c] for c in row.columns})


#: Nodes of a plan above which rows are dealt out anew.
DEALT = ("Repartition", "RepartitionByExpression", "RebalancePartitions", "Aggregate", "Window", "Distinct", "Sort")


def scan_tasks(df: DataFrame) -> int | None:
    """About how many tasks read the largest file source of `df`; None without one, or if rows are dealt out since.

    A file is read by as many tasks as it has splits; one that is smaller than a split, by one.
    """
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    found, todo = None, [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name in DEALT:
            return None
        todo += [node.children().apply(k) for k in range(node.children().size())]
        if name == "LogicalRelation":
            size = int(str(node.stats().sizeInBytes()))
            if found is None or size > found[0]:
                found = (size, len(node.relation().location().inputFiles()))
    return None if found is None else max(found[0] // split, found[1])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows on all cores, for costly rules on rows, if fewer tasks than cores read them.

    That is so for a few small files only; a larger input is left as it is, without a shuffle.
    Dealt by `keys`, of few rows each, the rows need no other shuffle for a join by them.
    """
    cores, tasks = df.sparkSession.sparkContext.defaultParallelism, scan_tasks(df)
    if tasks is None or tasks >= cores:
        return df
    return df.repartition(*keys) if keys else df.repartition(cores)
