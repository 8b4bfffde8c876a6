"""Vector codes by product quantization: integer k-means with bounds that the norm of sums tightens.

Vectors become integers and are cut into equal parts; each part position has a codebook. The
history of all codebooks is kept. For every part a vector carries the distance to its entry and,
for each group of entries, a lower bound for all others in the group, each with the round in which
it was measured. In a later round an entry can have come nearer by no more than the length of the
straight way from where it stood at that round to where it stands now: the norm of the sum of its
moves, which is at most the sum of their norms. Only groups whose bound falls to the distance of
the vector's own entry are measured again. Integers make every comparison exact.

A round passes over the vectors twice in tasks: bounds and codes, then sums for the next codebook,
which leave a task as one row an entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import prepare
from lakemill.session import discard, settle

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Groups of entries that share a lower bound.
GROUPS = 8
#: Widens bounds in floating point, so that rounding never makes one too tight.
SLACK = 1e-5
#: Vectors that a task holds at once.
ROWS = 4096


@dataclass(frozen=True)
class Codebooks:
    """The entries of each part position, round after round: history[round][part] is (entries, part size)."""

    history: tuple[tuple[np.ndarray, ...], ...]

    @property
    def last(self) -> tuple[np.ndarray, ...]:
        return self.history[-1]

    def after(self, books: list[np.ndarray]) -> Codebooks:
        return Codebooks((*self.history, tuple(books)))

    def moved(self, part: int) -> np.ndarray:
        """(round, entry): how far each entry now is from where it stood in that round, rounded up."""
        now = self.last[part].astype(np.float64)
        return np.stack([np.sqrt(((now - books[part]) ** 2).sum(axis=1)) * (1 + SLACK) for books in self.history])

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and place, in decimal, with commas between."""
        numbers = (str(int(x)) for book in self.last for x in book.ravel())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def groups_of(entries: int, groups: int) -> np.ndarray:
    """The group of each entry; groups are consecutive and differ by one entry at most."""
    return np.arange(entries) * min(groups, entries) // max(entries, 1)


def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances; in double precision where every step is a whole number that it holds."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)), 1)
    kind = np.float64 if 4 * x.shape[1] * top * top < 1 << 53 else np.int64
    a, b = x.astype(kind), book.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)


@dataclass
class Bounds:
    """What is known of one part of some vectors: own entry, its squared distance, and for each group
    of entries a lower bound of the distance to all others in it, with the round of its measure."""

    code: np.ndarray
    error: np.ndarray
    lower: np.ndarray
    stamp: np.ndarray
    #: (vector, group) pairs measured in the last step.
    measured: int = 0


def assign(x: np.ndarray, part: int, books: Codebooks, groups: np.ndarray, known: Bounds | None) -> Bounds:
    """The nearest entry of each row of `x`, the lower index among equals."""
    book, now, count = books.last[part], len(books.history) - 1, len(x)
    parts = int(groups[-1]) + 1
    if known is None:
        code, stamp = np.zeros(count, np.int64), np.zeros((count, parts), np.int8)
        lower, stale = np.zeros((count, parts), np.float32), np.ones((count, parts), bool)
        error = np.full(count, np.iinfo(np.int64).max)
    else:
        code, lower, stamp = known.code.astype(np.int64), known.lower.copy(), known.stamp.copy()
        gaps = x - book[code]
        error = (gaps * gaps).sum(axis=1)
        moved = books.moved(part)
        reach = np.stack([moved[:, groups == g].max(axis=1) for g in range(parts)], axis=1)  # (round, group)
        least = lower.astype(np.float64) - reach[stamp, np.arange(parts)]
        stale = least <= np.sqrt(error.astype(np.float64))[:, None] * (1 + SLACK)
    own, measured = code.copy(), int(stale.sum())
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    for g in range(parts):
        rows = np.flatnonzero(stale[:, g])
        if not len(rows):
            continue
        first = int(np.searchsorted(groups, g))
        d = _distances(x[rows], book[groups == g])
        found.append((first, rows, d))
        at = d.argmin(axis=1)
        near, index = d[np.arange(len(rows)), at], first + at
        better = (near < error[rows]) | ((near == error[rows]) & (index < code[rows]))
        error[rows[better]], code[rows[better]] = near[better], index[better]
    for first, rows, d in found:  # bounds of what was measured, without the entry that is now the vector's own
        mine = code[rows] - first
        inside = np.flatnonzero((mine >= 0) & (mine < d.shape[1]))
        d[inside, mine[inside]] = np.iinfo(np.int64).max
        g = int(groups[first])
        lower[rows, g] = np.sqrt(d.min(axis=1).astype(np.float64)) * (1 - SLACK)
        stamp[rows, g] = now
    if known is not None:  # a vector that left an entry is no further from it than it was: its group's bound must hold for it
        left = np.flatnonzero(own != code)
        g = groups[own[left]]
        kept = ~stale[left, g]
        rows, g = left[kept], g[kept]
        gaps = x[rows] - book[own[rows]]
        d = np.sqrt((gaps * gaps).sum(axis=1).astype(np.float64)) * (1 - SLACK)
        lower[rows, g] = np.minimum(least[rows, g], d) * (1 - SLACK)
        stamp[rows, g] = now
    return Bounds(code, error, lower, stamp, measured)


def _integers(column: pa.Array, size: int, kind: str) -> np.ndarray:
    """Vectors stored as bytes, as rows of whole numbers."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(-1, size).astype(np.int64)


def _state(column: pa.Array, size: int, parts: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, parts, size)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    width = rows.nbytes // max(len(rows), 1)
    return pa.array([rows[i].tobytes() for i in range(len(rows))], pa.binary()) if width else pa.array([b""] * len(rows), pa.binary())


STATE = "vec_id long, label string, x binary, code binary, error binary, lower binary, stamp binary"


def measured(state: DataFrame, books: Codebooks, size: int, kind: str, groups: int, first: bool) -> DataFrame:
    """The state after a step against the last codebooks, and the number of groups measured."""
    parts, width = len(books.last), size // len(books.last)
    of = groups_of(len(books.last[0]), groups)
    many = int(of[-1]) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _integers(b.column(2), size, kind)
            if not first:
                code = _state(b.column(3), 1, parts, "<u2")[:, :, 0]
                lower, stamp = _state(b.column(5), many, parts, "<f4"), _state(b.column(6), many, parts, "<i1")
            out = []
            for p in range(parts):
                known = None if first else Bounds(code[:, p], None, lower[:, p], stamp[:, p])
                out.append(assign(x[:, p * width : (p + 1) * width], p, books, of, known))
            data = [
                np.stack([o.code for o in out], axis=1).astype("<u2"),
                np.stack([o.error for o in out], axis=1).astype("<i8"),
                np.stack([o.lower for o in out], axis=1).astype("<f4"),
                np.stack([o.stamp for o in out], axis=1).astype("<i1"),
            ]
            counts = np.zeros(b.num_rows, np.int64)
            counts[0] = sum(o.measured for o in out)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], *[_binary(d) for d in data], pa.array(counts)],
                names=["vec_id", "label", "x", "code", "error", "lower", "stamp", "measured"],
            )

    columns = [c if c in state.columns else F.lit(b"").alias(c) for c in ("vec_id", "label", "x", "code", "error", "lower", "stamp")]
    return state.select(*columns).mapInArrow(run, STATE + ", measured long")


def updated(state: DataFrame, books: Codebooks, size: int, kind: str) -> list[np.ndarray]:
    """The next entries: the means, rounded down, of the parts that have each; an entry without any stays."""
    parts, entries, width = len(books.last), len(books.last[0]), size // len(books.last)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _integers(b.column(0), size, kind).reshape(-1, width)
            at = (_state(b.column(1), 1, parts, "<u2")[:, :, 0].astype(np.int64) + np.arange(parts) * entries).ravel()
            order = np.argsort(at, kind="stable")
            seen, begin, many = np.unique(at[order], return_index=True, return_counts=True)
            total[seen] += np.add.reduceat(x[order], begin, axis=0)
            counts[seen] += many
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))], names=["entry", "n", "total"]
        )

    one = state.select("x", "code").mapInArrow(sums, "entry long, n long, total array<long>")
    added = one.select("entry", "n", F.posexplode("total").alias("place", "value")).groupBy("entry", "place")
    out = [b.copy() for b in books.last]
    for r in added.agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect():  # one row for each number of the codebooks
        out[r.entry // entries][r.entry % entries, r.place] = r.value // r.n
    return out


@dataclass(frozen=True)
class Codes:
    """`rows`: (id, label, codes, error) of every kept vector; `measured`: groups measured in each step, for all parts."""

    rows: DataFrame
    books: Codebooks
    measured: list[int]


def encode(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, groups: int = GROUPS,
) -> Codes | None:
    """Codes of all vectors and the codebooks they refer to.

    Each component x becomes floor(`scale` * x). A codebook starts with that part of the `entries`
    smallest ids (rows without an id last, rows of equal ids by their components); each round
    assigns every part to the nearest entry, the lower index among equals, and replaces entries by
    floored means. `codes` is an array of entry numbers, `error` the sum of squared distances.

    Vectors that are null, or hold a null or a number that is not finite, are dropped. Repeated rows
    count as often as they occur. The label, which may be null, is carried along as text; other
    columns are ignored. Without any vector the result is None. Vectors of several sizes, of a size
    that `parts` does not divide, or with components whose squares leave 64 bits raise ValueError.
    """
    spark = prepare(vectors.sparkSession, ROWS)
    if not 1 <= entries <= 1 << 16:
        raise ValueError("codes are numbers of 16 bits")
    v = F.col(f"`{vector}`").cast("array<double>")
    usable = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    source = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"), v.alias("v"))
    kept = source.where(F.coalesce(usable, F.lit(False)))
    top = F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0.0))
    facts = kept.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most"), F.max(top).alias("top")).first()
    if facts.least is None:
        return None
    size = facts.most
    if facts.least != size or size % parts or not size:
        raise ValueError(f"vectors of one size that {parts} divides are needed, found {facts.least} to {size}")
    limit = facts.top * scale + 1
    if 4 * size * limit * limit >= 1 << 62:
        raise ValueError("components are too large for exact distances in 64 bits")
    kind = "<i2" if limit < 1 << 15 else "<i4"

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.floor(scale * b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)).astype(kind)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _binary(x)], names=["vec_id", "label", "x"])

    state = settle(kept.mapInArrow(scaled, "vec_id long, label string, x binary"), "vector-integers")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most `entries` rows
    start = np.floor(scale * np.array([r.v for r in first], np.float64)).astype(np.int64)
    width = size // parts
    books, steps = Codebooks((tuple(start[:, p * width : (p + 1) * width] for p in range(parts)),)), []
    for k in range(rounds + 1):
        prepare(spark, ROWS)
        after = settle(measured(state, books, size, kind, groups, first=k == 0), "vector-bounds")
        discard(state)
        state = after
        steps.append(state.agg(F.sum("measured")).first()[0])
        if k < rounds:
            books = books.after(updated(state, books, size, kind))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = _state(b.column(2), 1, parts, "<u2")[:, :, 0].astype(np.int32)
            error = _state(b.column(3), 1, parts, "<i8")[:, :, 0].sum(axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, code.size + 1, parts), pa.int32()), pa.array(code.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists, pa.array(error)], names=["vec_id", "label", "codes", "error"])

    rows = settle(state.select("vec_id", "label", "code", "error").mapInArrow(read, "vec_id long, label string, codes array<int>, error long"), "vector-codes")
    discard(state)
    prepare(spark)
    return Codes(rows.withColumnRenamed("vec_id", id_col), books, steps)
