"""Near-duplicate vectors by cosine, compared tile by tile in the order of principal components.

Vectors are scaled to length 1 and turned into the axes of their principal components, which
changes no product. Of two vectors the products of the leading components are added up first; what
the others can still add is at most the product of the lengths of the two rests, so a comparison
stops if even that does not reach the threshold. Tiles hold vectors that are near each other in
the first component, and two tiles whose ranges there lie too far apart are never compared.

Equal vectors enter once, with their number. A task returns how many links each vector has and a
forest of the links, never the pairs. The comparison of tiles is quadratic in their number; bounds
cut what a pair of tiles costs and which are compared. Tiles are stored once and every task reads
the files of two groups of them, so disk and shuffles grow with the vectors, not with the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import prepare
from lakemill.llm.graph import components, forest
from lakemill.session import settle

#: Vectors in a tile, and bytes of them.
TILE, TILE_BYTES = 8192, 16 << 20
#: Pairs of tiles that reach a Python worker at once.
PAIRS = 2
#: Rows of two tiles whose products are held at once, about what a core's cache holds.
STRIPE, WIDTH = 512, 1024
#: Leading components after which the bound is checked.
LEADING = 32
#: Added to bounds, for the rounding of single precision, with a part for each component; the last
#: check is in double precision.
SLACK, SLACK_EACH = 1e-4, 2.0**-22
#: Share of pairs left below which they are followed one by one.
FEW = 0.02
#: Numbers of the vectors that are followed one by one at once.
FOLLOWED = 1 << 22


def _unit(values: pa.Array, size: int) -> np.ndarray:
    x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(distinct: DataFrame, size: int) -> np.ndarray:
    """The eigenvectors of the second moments of all vectors, the largest first, one a column."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            if b.num_rows:
                x = _unit(b.column(0), size)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], names=["place", "value"])

    sums = distinct.select("v").mapInArrow(moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    matrix = np.zeros(size * size)
    for r in sums.collect():  # as many numbers as a square of components
        matrix[r.place] = r.value
    matrix = matrix.reshape(size, size)
    values, axes = np.linalg.eigh((matrix + matrix.T) / 2)
    return axes[:, np.argsort(-values, kind="stable")]


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of a, row of b) of products that reach the threshold, in parts.

    The length of the rest stands beside the leading components, so one product gives the bound.
    """
    size = a.shape[1]
    least = threshold - SLACK - SLACK_EACH * size
    whole = size <= LEADING

    def bounding(v: np.ndarray) -> np.ndarray:
        return v.astype(np.float32) if whole else np.hstack([v[:, :LEADING], np.sqrt((v[:, LEADING:] ** 2).sum(axis=1))[:, None]]).astype(np.float32)

    lead_a, lead_b, step = bounding(a), bounding(b), max(1, FOLLOWED // size)
    for at in range(0, len(a), STRIPE):
        for to in range(0, len(b), WIDTH):
            left = lead_a[at : at + STRIPE] @ lead_b[to : to + WIDTH].T >= least
            if not left.any():
                continue
            if not whole and left.mean() > FEW:
                left &= a[at : at + STRIPE].astype(np.float32) @ b[to : to + WIDTH].astype(np.float32).T >= least
            i, j = np.nonzero(left)
            for part in range(0, len(i), step):
                pi, pj = at + i[part : part + step], to + j[part : part + step]
                exact = np.einsum("ij,ij->i", a[pi], b[pj]) >= threshold
                if exact.any():
                    yield pi[exact], pj[exact]


def _of_size(distinct: DataFrame, size: int, threshold: float, tile: int) -> DataFrame:
    """(key, links) and (key, other) rows of the distinct vectors with `size` components."""
    axes = principal_axes(distinct, size)
    first = axes[:, 0]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _unit(b.column(2), size)
                turned = x @ axes
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(x @ first), pa.array([r.tobytes() for r in turned], pa.binary())],
                    names=["key", "copies", "c", "v"],
                )

    turned = settle(distinct.select("key", "copies", "v").mapInArrow(turn, "key long, copies long, c double, v binary"), "turned-vectors")
    tile = max(1, min(tile, TILE_BYTES // (8 * size)))
    parts = max(1, -(-turned.count() * 5 // (4 * tile)))  # bounds of ranges come from samples; few parts are longer than a tile

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        count = 0

        def out(rows: list) -> pa.RecordBatch:
            key, copies, c, v = (np.concatenate([r[k] for r in rows]) for k in range(4))
            return pa.RecordBatch.from_arrays(
                [pa.array([float(c.min())]), pa.array([float(c.max())]), pa.array([key.tobytes()], pa.binary()), pa.array([copies.tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())],
                names=["low", "high", "keys", "copies", "v"],
            )

        for b in batches:
            for at in range(0, b.num_rows, tile):
                part = b.slice(at, tile)
                rows = (
                    part.column(0).to_numpy(),
                    part.column(1).to_numpy(),
                    part.column(2).to_numpy(),
                    np.frombuffer(b"".join(part.column(3).to_pylist()), np.float64),
                )
                if count + part.num_rows > tile:
                    yield out(held)
                    held, count = [], 0
                held.append(rows)
                count += part.num_rows
        if held:
            yield out(held)

    sorted_rows = turned.repartitionByRange(parts, "c").sortWithinPartitions("c")
    packed = sorted_rows.mapInArrow(pack, "low double, high double, keys binary, copies binary, v binary")
    stored = settle(packed.withColumn("tile", F.monotonically_increasing_id()), "tiles")
    # Two unit vectors at the threshold are no further apart than this, in any component.
    far = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    one, other = (stored.select(*[F.col(c).alias(f"{c}_{side}") for c in stored.columns]) for side in "ab")
    near = (F.col("low_a") - F.col("high_b") <= far) & (F.col("low_b") - F.col("high_a") <= far)
    # Of the two orders of a pair one counts, each for half of the pairs, so that all tasks have work.
    mark = F.xxhash64(F.least("tile_a", "tile_b"), F.greatest("tile_a", "tile_b")) % 2 == 0
    once = (F.col("tile_a") == F.col("tile_b")) | ((F.col("tile_a") < F.col("tile_b")) == mark)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                load = lambda c, kind: np.frombuffer(batch.column(batch.schema.get_field_index(c))[row].as_buffer(), kind)  # noqa: B023, E731
                yield linked(*[[load(f"{c}_{side}", kind) for side in "ab"] for c, kind in (("keys", np.int64), ("copies", np.int64), ("v", np.float64))])

    def linked(keys: list[np.ndarray], copies: list[np.ndarray], v: list[np.ndarray]) -> pa.RecordBatch:
        (a, b), same = (x.reshape(-1, size) for x in v), keys[0][0] == keys[1][0]  # a key is in one tile
        links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        left, right = [], []
        for i, j in linked_pairs(a, b, threshold):
            if same:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            links_a += np.bincount(i, copies[1][j], len(a)).astype(np.int64)
            links_b += np.bincount(j, copies[0][i], len(b)).astype(np.int64)
            x, y = forest(keys[0][i], keys[1][j])
            left.append(x)
            right.append(y)
        if same:
            links_a, links_b = links_a + links_b, links_b[:0]
        key = np.concatenate([keys[0][links_a > 0], keys[1][: len(links_b)][links_b > 0]])
        count = np.concatenate([links_a[links_a > 0], links_b[links_b > 0]])
        x, y = forest(np.concatenate(left), np.concatenate(right)) if left else (key[:0], key[:0])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([key, x])),
                pa.array(np.concatenate([count, np.zeros(len(x), np.int64)])),
                pa.array(np.concatenate([np.full(len(key), -1), y]).astype(np.int64)),
            ],
            names=["key", "links", "other"],
        )

    # Tasks read the tiles from their files, two partitions each: a shuffle would send a tile once for each partner.
    columns = [f"{c}_{side}" for side in "ab" for c in ("keys", "copies", "v")]
    pairs = one.join(other.hint("shuffle_replicate_nl"), near & once).select(*columns)
    prepare(distinct.sparkSession, PAIRS)
    return settle(pairs.mapInArrow(compare, "key long, links long, other long"), "vector-links")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, tile: int = TILE) -> DataFrame:
    """One row per row of `vectors`: (id, n_links, component_id, kept).

    Two rows are linked if the cosine of their vectors, in double precision, is at least the
    threshold. `n_links` counts the other rows linked directly, `component_id` is the smallest id
    reachable, `kept` tells if that is the row's own. A vector that is null or zero, or holds a
    null or a number that is not finite, links with nothing; so do vectors of different sizes.
    Equal rows link like any others. A row without an id keeps its null id and links; its own
    `component_id` is null if no row it reaches has an id, and `kept` is then true. Other columns
    are ignored. An empty table gives an empty result.
    """
    spark = prepare(vectors.sparkSession, 4096)
    v = F.col(f"`{vector}`").cast("array<double>")
    usable = (
        F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
    marked = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    hashed = settle(
        marked.select(
            "vec_id",
            F.when(F.col("usable"), F.xxhash64(F.lit(1), "v")).alias("h1"),
            F.when(F.col("usable"), F.xxhash64(F.lit(2), "v")).alias("h2"),
        ),
        "vector-hashes",
    )
    distinct = marked.where("usable").groupBy("v").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    distinct = settle(distinct.withColumn("key", F.monotonically_increasing_id()), "distinct-vectors")
    sizes = [r[0] for r in distinct.select(F.size("v")).distinct().collect()]
    found = None
    for size in sizes:  # in practice one
        prepare(spark, 4096)
        part = _of_size(distinct.where(F.size("v") == size), size, threshold, tile)
        found = part if found is None else found.unionAll(part)
    found = found if found is not None else spark.createDataFrame([], "key long, links long, other long")
    links = found.where("links > 0").groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(found.where("links = 0").select(F.col("key").alias("a"), F.col("other").alias("b")))
    named = (
        distinct.select("key", "least_id", "copies", F.xxhash64(F.lit(1), "v").alias("h1"), F.xxhash64(F.lit(2), "v").alias("h2"))
        .join(links, "key", "left")
        .join(groups.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("component", F.coalesce("component", "key"))
    )
    named = settle(named, "vector-groups")
    least = settle(named.groupBy("component").agg(F.min("least_id").alias("component_id")), "vector-group-ids")
    facts = settle(
        named.join(least, "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"),
        "vector-facts",
    )
    prepare(spark)
    linked = hashed.where("h1 IS NOT NULL").join(facts, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = hashed.where("h1 IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).select(
        F.col("vec_id").alias(id_col), "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
