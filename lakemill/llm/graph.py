"""Connected components of a distributed edge list, and of a small one in a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakemill.session import fresh_folder, settle


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of `n` indexes reaches over the edges a-b."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(up := label[label], label):
            label = up


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, smallest member) that connect what the edges a-b connect."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    roots = local_roots(len(nodes), place[: len(a)], place[len(a) :])
    off = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[off], nodes[roots[off]]


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written to the shared folder, and a mark that differs if their set differs."""
    spark, path, seen = edges.sparkSession, fresh_folder(edges.sparkSession, "edges"), Observation()
    marked = edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(hi, lo))").alias("x"), F.expr("bit_xor(xxhash64(lo, hi, 7))").alias("y")
    )
    marked.write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path), tuple(seen.get[k] for k in ("n", "x", "y"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b): the smallest node that it reaches.

    Alternates the large-star and the small-star step, each a grouped minimum and a join, until
    no edge changes. The minima are written first, so that both sides of a join are shuffled for
    it and a node with very many edges can be split. Loops, repeated edges and edges with a null
    end add nothing; no edges give no rows.
    """
    a, b = F.col("a"), F.col("b")
    current, mark = _stored(edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    while True:
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(current.select("lo", "hi"))
        low = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = settle(large, "large-star")
        low = settle(large.groupBy("hi").agg(F.min("lo").alias("m")), "lowest")
        small = large.join(low, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        current, now = _stored(small.unionAll(low.select("hi", F.col("m").alias("lo"))).distinct())
        if now == mark:
            break
        mark = now
    stars = current.groupBy("hi").agg(F.min("lo").alias("component"))
    roots = current.select(F.col("lo").alias("node")).distinct()
    return stars.select(F.col("hi").alias("node"), "component").unionAll(roots.select("node", F.col("node").alias("component")))
