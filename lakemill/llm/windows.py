"""Packing of documents into windows, by non-negative least squares over combinations of lengths.

A document fills whole windows; what is left of it, its rest, is shorter than a window. On the
histogram of the rests all combinations of two or three lengths that fill a window exactly are
enumerated, and how often each is used is solved by non-negative least squares. The counts are
rounded and taken as far as the histogram holds them. What remains is packed greedily: the longest
piece opens a window, the longest that fit fill it, and where none fits one is cut. The last tokens,
fewer than a window, go into sequences of falling powers of two, so nothing is padded.

All of this works on the counts of lengths, at most as many numbers as a window has tokens. Each
rest then finds its place from its rank among the rests of its length.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import prepare, text_of
from lakemill.llm.word_tokens import encoder
from lakemill.session import settle

CAPACITY = 2048
END_ID = 1
#: The solver ends when no count would change by as much; counts are rounded to whole numbers.
TOLERANCE = 0.25
#: Sweeps of the solver; each raises or lowers one combination for every longest length at most.
SWEEPS = 400


@dataclass(frozen=True)
class Combinations:
    """Columns of the least squares problem: lengths a >= b >= c that fill a window; c is 0 for two lengths."""

    a: np.ndarray
    b: np.ndarray
    c: np.ndarray

    @staticmethod
    def filling(capacity: int, counts: np.ndarray) -> Combinations:
        """All of two or three counted lengths, in the order of the longest."""
        held = counts > 0
        held[0] = True  # stands for no third length
        found = []
        for a in np.flatnonzero(held[:capacity])[::-1].tolist():
            if 3 * a < capacity:
                break
            b = np.arange(-(-(capacity - a) // 2), min(a, capacity - a) + 1)
            c = capacity - a - b
            ok = held[b] & held[c] & (b > 0) & (c <= b)
            found.append((np.full(int(ok.sum()), a), b[ok], c[ok]))
        parts = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3)]
        return Combinations(*[p.astype(np.int64) for p in parts])

    def norms(self) -> np.ndarray:
        """Squared lengths of the columns; an entry is 2 where a length occurs twice."""
        three = self.c > 0
        return np.where(three, 3, 2) + 2 * ((self.a == self.b).astype(np.int64) + (three & (self.b == self.c)))


def solve(columns: Combinations, histogram: np.ndarray, tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> np.ndarray:
    """How often each combination is used: least squares against the histogram, none below zero.

    Blocks of coordinates: in each sweep every longest length names its combination of most gain,
    and of these as many as share no length are set to their best values at once.
    """
    x, left = np.zeros(len(columns.a)), histogram.astype(np.float64)
    if not len(x):
        return x
    left[0] = 0.0
    norms = columns.norms().astype(np.float64)
    begins = np.flatnonzero(np.concatenate([[True], columns.a[1:] != columns.a[:-1]]))
    spans = np.diff(np.concatenate([begins, [len(x)]]))
    for _ in range(sweeps):
        step = np.maximum((left[columns.a] + left[columns.b] + left[columns.c]) / norms, -x)
        gain = step * step * norms
        most = np.repeat(np.maximum.reduceat(gain, begins), spans)
        first = np.flatnonzero((gain == most) & (np.abs(step) >= tolerance))
        if not len(first):
            break
        taken = np.zeros(len(left), bool)
        for k in first[np.argsort(-gain[first], kind="stable")].tolist():
            lengths = [size for size in (columns.a[k], columns.b[k], columns.c[k]) if size]
            if taken[lengths].any():
                continue
            taken[lengths] = True
            x[k] += step[k]
            for size in lengths:
                left[size] -= step[k]
    return x


@dataclass
class Stock:
    """Pieces not placed yet, by length, as runs (root, first rank, how many, where in the root)."""

    capacity: int
    counts: np.ndarray
    runs: list[deque] = field(default_factory=list)

    @staticmethod
    def of(counts: np.ndarray, capacity: int) -> Stock:
        runs = [deque([(size, 0, n, 0)] if n else []) for size, n in enumerate(counts.tolist())]
        return Stock(capacity, counts.astype(np.int64).copy(), runs)

    def take(self, length: int, n: int) -> list[tuple[int, int, int, int]]:
        self.counts[length] -= n
        out, held = [], self.runs[length]
        while n:
            root, first, many, start = held.popleft()
            used = min(many, n)
            out.append((root, first, used, start))
            if many > used:
                held.appendleft((root, first + used, many - used, start))
            n -= used
        return out

    def add(self, length: int, run: tuple[int, int, int, int]) -> None:
        self.counts[length] += run[2]
        self.runs[length].append(run)

    def longest(self, room: int) -> int:
        """The greatest length at hand up to `room`, 0 if there is none."""
        found = np.flatnonzero(self.counts[: room + 1])
        return int(found[-1]) if len(found) else 0

    def tokens(self) -> int:
        return int(self.counts @ np.arange(len(self.counts)))


@dataclass
class Plan:
    """Where rests go: runs (root, first rank, how many, start, length, sequence, offset).

    The rests of length `root` with ranks from the first on, from their token `start` on, stand at
    `offset` of the sequences from `sequence` on, one in each.
    """

    runs: list[tuple[int, int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def put(self, stock: Stock, length: int, n: int, sequence: int, offset: int, used: int) -> None:
        """The first `used` tokens of `n` pieces of this length; the others return to the stock."""
        for root, first, many, start in stock.take(length, n):
            self.runs.append((root, first, many, start, used, sequence, offset))
            sequence += many
            if length > used:
                stock.add(length - used, (root, first, many, start + used))

    def combine(self, stock: Stock, columns: Combinations, x: np.ndarray) -> None:
        """The combinations, rounded, those used most first, each as often as there are pieces for it."""
        times = np.floor(x + 0.5).astype(np.int64)
        some = np.flatnonzero(times)
        for k in some[np.argsort(-x[some], kind="stable")].tolist():
            lengths = [int(size) for size in (columns.a[k], columns.b[k], columns.c[k]) if size]
            n = min([int(times[k]), *[int(stock.counts[size]) // lengths.count(size) for size in lengths]])
            if n:
                offset = 0
                for size in lengths:
                    self.put(stock, size, n, self.sequences, offset, size)
                    offset += size
                self.sequences += n

    def fill(self, stock: Stock) -> None:
        """Whole windows from what remains, all that open with one length at a time."""
        capacity, tokens = stock.capacity, stock.tokens()
        while tokens >= capacity:
            size = stock.longest(capacity - 1)
            n = min(int(stock.counts[size]), tokens // capacity)
            tokens -= n * capacity
            self.put(stock, size, n, self.sequences, 0, size)
            open_ = [(self.sequences, n, capacity - size)]
            self.sequences += n
            while open_:  # the stock always holds as many tokens as the open windows need
                at, many, room = open_.pop()
                size = stock.longest(room) or stock.longest(capacity - 1)
                n = min(many, int(stock.counts[size]))
                if n < many:
                    open_.append((at + n, many - n, room))
                used = min(size, room)
                self.put(stock, size, n, at, capacity - room, used)
                if used < room:
                    open_.append((at, n, room - used))

    def end(self, stock: Stock) -> None:
        """The last tokens, fewer than a window: one sequence for each power of two in their number."""
        tokens = stock.tokens()
        for size in (1 << k for k in range(tokens.bit_length() - 1, -1, -1) if tokens >> k & 1):
            offset = 0
            while offset < size:
                length = stock.longest(stock.capacity - 1)
                used = min(length, size - offset)
                self.put(stock, length, 1, self.sequences, offset, used)
                offset += used
            self.sequences += 1


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Places for all rests of lengths 1 to `capacity` - 1, counted in `counts`."""
    stock, out = Stock.of(counts, capacity), Plan()
    columns = Combinations.filling(capacity, counts)
    out.combine(stock, columns, solve(columns, counts))
    out.fill(stock)
    out.end(stock)
    return out


class Places:
    """The runs of a plan, found by length and rank."""

    def __init__(self, found: Plan, capacity: int):
        table = np.array(found.runs, np.int64).reshape(-1, 7)
        self.table = table[np.lexsort((table[:, 3], table[:, 1], table[:, 0]))]
        self.begin = np.searchsorted(self.table[:, 0], np.arange(capacity + 1))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, run) for each piece of the rows that have these lengths and ranks."""
        order = np.lexsort((rank, length))
        rows, runs = [], []
        sizes, at = np.unique(length[order], return_index=True)
        for size, lo, hi in zip(sizes.tolist(), at, [*at[1:], len(order)]):
            mine, sorted_ranks = order[lo:hi], rank[order[lo:hi]]
            first, last = self.begin[size], self.begin[size + 1]
            table = self.table[first:last]
            left = np.searchsorted(sorted_ranks, table[:, 1])
            many = np.searchsorted(sorted_ranks, table[:, 1] + table[:, 2]) - left
            run = np.repeat(np.arange(first, last), many)
            place = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(left, many)
            rows.append(mine[place])
            runs.append(run)
        return (np.concatenate(rows), np.concatenate(runs)) if rows else (order, order)


def tokenized(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """Stored rows (doc_id, part, nth, windows_before, doc_tokens, rest, ids), one for each document.

    `part` is the task that wrote the row, `nth` its place among that task's rows of equal `rest`,
    `windows_before` counts the whole windows of that task's earlier rows.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen, windows = np.zeros(capacity, np.int64), 0
        for b in batches:
            ids = words.encode(b.column(1).to_pylist(), end)
            sizes = np.array([len(i) for i in ids], np.int64)
            rest, whole = sizes % capacity, sizes // capacity
            order = np.argsort(rest, kind="stable")
            _, at, many = np.unique(rest[order], return_index=True, return_counts=True)
            nth = np.empty(len(rest), np.int64)
            nth[order] = np.arange(len(rest)) - np.repeat(at, many) + seen[rest[order]]
            seen += np.bincount(rest, minlength=capacity)
            before = windows + np.cumsum(whole) - whole
            windows += int(whole.sum())
            data = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(rest), part)), pa.array(nth), pa.array(before), pa.array(sizes), pa.array(rest), data],
                names=["doc_id", "part", "nth", "windows_before", "doc_tokens", "rest", "ids"],
            )

    schema = "doc_id long, part long, nth long, windows_before long, doc_tokens long, rest long, ids binary"
    return settle(source.mapInArrow(run, schema), "tokenized")


PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """One row per piece: (id, start, length, ids, doc_tokens, sequence_id, offset).

    Every token of every document and its end id lie in one piece. `ids` holds little-endian
    unsigned 32-bit ids. All sequences have `capacity` tokens, but for at most one of each smaller
    power of two. Whole windows of a document come first and have negative numbers; its rest is
    one piece, or several if it was cut to fill gaps. A null text is empty and has one token, the
    end id. Rows are independent: repeated rows, ties and rows without an id are packed like any
    others. Other columns are ignored. An empty table gives an empty result.
    """
    stored = tokenized(docs, tokenizer, id_col, text, capacity, end)
    rests = stored.where("rest > 0")
    held = settle(rests.groupBy("rest", "part").agg(F.count(F.lit(1)).alias("n")), "rest-counts")
    counts = np.zeros(capacity, np.int64)
    for r in held.groupBy("rest").agg(F.sum("n").alias("n")).collect():  # a row for each length below `capacity`
        counts[r.rest] = r.n
    places = Places(plan(counts, capacity), capacity)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, part, before = (b.column(k).to_numpy() for k in (1, 2, 3))
            many = tokens // capacity
            row = np.repeat(np.arange(len(many)), many)
            k = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            data = b.column(4)
            ids = [data[i].as_py()[4 * capacity * j : 4 * capacity * (j + 1)] for i, j in zip(row.tolist(), k.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(row)),
                    pa.array(k * capacity),
                    pa.array(np.full(len(row), capacity)),
                    pa.array(ids, pa.binary()),
                    pa.array(tokens[row]),
                    pa.array(-1 - ((part[row] << 33) + before[row] + k)),
                    pa.array(np.zeros(len(row), np.int64)),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, rest, rank = (b.column(k).to_numpy() for k in (1, 2, 3))
            row, run = places.find(rest, rank)
            root, first, _, start, length, sequence, offset = places.table[run].T
            data = b.column(4).to_pylist()
            ids = [data[i][4 * lo : 4 * hi] for i, lo, hi in zip(row.tolist(), start.tolist(), (start + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(row)),
                    pa.array(tokens[row] - root + start),
                    pa.array(length),
                    pa.array(ids, pa.binary()),
                    pa.array(tokens[row]),
                    pa.array(sequence + rank[row] - first),
                    pa.array(offset),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    earlier = held.select("rest", "part", (F.sum("n").over(Window.partitionBy("rest").orderBy("part")) - F.col("n")).alias("before"))
    last = F.substring("ids", (4 * (F.col("doc_tokens") - F.col("rest")) + 1).cast("int"), (4 * F.col("rest")).cast("int"))
    ranked = (
        rests.select("doc_id", "doc_tokens", "rest", "part", "nth", last.alias("ids"))
        .join(earlier, ["rest", "part"])
        .select("doc_id", "doc_tokens", "rest", (F.col("nth") + F.col("before")).alias("rank"), "ids")
    )
    whole = stored.where(F.col("doc_tokens") >= capacity).select("doc_id", "doc_tokens", "part", "windows_before", "ids")
    found = whole.mapInArrow(windows, PIECE).unionAll(ranked.mapInArrow(place, PIECE))
    return found.withColumnRenamed("doc_id", id_col)
