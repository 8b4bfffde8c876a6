"""Best-fit packing of documents into sequences, by bin completion over classes of lengths.

Pieces of equal length are interchangeable, so a packing is decided on the counts of the lengths:
at most as many numbers as a sequence has tokens, whatever the size of the corpus. The best-fit
decreasing packing is the first incumbent. Branch and bound goes over the undominated fillings
around the largest remaining length, found from the sums that the lengths can make, each used as
often as the counts allow or once. Each piece then finds its place from its rank among the pieces
of its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import prepare, text_of
from lakemill.llm.tokens import END_ID, Encoder
from lakemill.session import settle

CAPACITY = 1024
#: Rows whose ranks are found in one group; decides how many groups there are, not what they hold.
RANKED_ROWS = 10_000
#: Fillings that the search for a plan may try after its first descent; then the best plan so far is taken.
NODES = 10_000


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids): the tokens of each document with its end id, cut to fit.

    Only documents longer than `capacity` are cut: into pieces of `capacity` tokens, the first one
    shorter if need be. `ids` holds little-endian unsigned 32-bit ids. A null text is empty and
    has one piece, the end id. Rows are independent: repeated rows and null ids are kept.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for b in batches:
            row, number, start, data = [], [], [], []
            for i, ids in enumerate(encoder.encode(b.column(1).to_pylist(), END_ID)):
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > first else [0, len(ids)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    row.append(i)
                    number.append(k)
                    start.append(lo)
                    data.append(ids[lo:hi].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(row, pa.int64())),
                    pa.array(number, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array([len(d) // 4 for d in data], pa.int64()),
                    pa.array(data, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary").withColumnRenamed("doc_id", id_col)


def _reach(room: int, lengths: list[int], counts: list[int]) -> list[int]:
    """For each k the sums up to `room` that lengths[k:] can make, as the bits of a number."""
    full = (1 << (room + 1)) - 1
    out = [1] * (len(lengths) + 1)
    for k in range(len(lengths) - 1, -1, -1):
        sums, many = out[k + 1], min(counts[k], room // lengths[k])
        step = 1
        while many and sums != full:  # 1, 2, 4 ... and the rest make every number up to the count
            step = min(step, many)
            sums |= sums << (lengths[k] * step) & full
            many -= step
            step *= 2
        out[k] = sums
    return out


def fillings(room: int, counts: np.ndarray) -> Iterator[list[tuple[int, int]]]:
    """All fillings of `room` from the counted lengths, as (length, how often), those of least waste first.

    Among fillings of equal waste those that take larger lengths more often come first. Only
    sums that the lengths left can make are followed, so no branch ends without a filling.
    """
    lengths = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    many = counts[lengths].tolist()
    reach = _reach(room, lengths, many)
    for total in range(room, -1, -1):
        if not reach[0] >> total & 1:
            continue
        chosen: list[tuple[int, int]] = []  # (number of the length, how often)
        k, need = 0, total
        while True:
            while need:  # down to a filling, each length as often as the others can complete
                t = min(many[k], need // lengths[k])
                while t and not reach[k + 1] >> (need - t * lengths[k]) & 1:
                    t -= 1
                if t:
                    chosen.append((k, t))
                    need -= t * lengths[k]
                k += 1
            yield [(lengths[j], t) for j, t in chosen]
            while chosen:  # back to the last length that can be taken less often
                k, t = chosen.pop()
                need += t * lengths[k]
                t -= 1
                while t >= 0 and not reach[k + 1] >> (need - t * lengths[k]) & 1:
                    t -= 1
                if t >= 0:
                    if t:
                        chosen.append((k, t))
                        need -= t * lengths[k]
                    k += 1
                    break
            else:
                break


def fill(room: int, counts: np.ndarray) -> list[int]:
    """Lengths, in falling order, of the filling of `room` that wastes least, with the largest lengths among equals."""
    return [size for size, t in next(fillings(room, counts)) for _ in range(t)]


def dominated(filling: list[tuple[int, int]], room: int, counts: np.ndarray) -> bool:
    """If a larger length at hand can stand for some lengths of `filling`, or for its waste.

    The sums of one or more of its lengths are the bits of a number; a sum equal to a length
    counts if several lengths make it, as one alone would be that length itself.
    """
    taken = dict(filling)
    waste = room - sum(size * t for size, t in filling)
    one, several = 0, 0  # sums of one or more lengths, and of two or more
    for size in (size for size, t in filling for _ in range(t)):
        several |= one << size
        one |= one << size | 1 << size
    for x in np.flatnonzero(counts[: room + 1]).tolist():
        if counts[x] <= taken.get(x, 0):
            continue
        if x <= waste or several >> x & 1:
            return True
        low = max(1, x - waste)
        if one >> low & ((1 << (x - low)) - 1):  # sums from x - waste to x - 1
            return True
    return False


def bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by the sum, and by lengths that cannot share one (Martello and Toth's L2)."""
    sizes = np.arange(len(counts))
    n, total = np.cumsum(counts), np.cumsum(counts * sizes)
    half = capacity // 2
    k = np.arange(half + 1)
    rest = np.maximum(capacity - k, half)
    own = n[-1] - n[half]  # longer than half: one sequence each
    free = (n[rest] - n[half]) * capacity - (total[rest] - total[half])  # room beside those of at most capacity - k
    small = total[half] - np.concatenate([[0], total[:half]])  # from k to half
    return int(max(-(-int(total[-1]) // capacity), own + max(0, int((-(-(small - free) // capacity)).max()))))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The best-fit decreasing packing, on counts: (lengths of a sequence, how many such sequences)."""
    rooms: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        for room in range(size, capacity + 1):
            while left and (rooms[room] or room == capacity):
                pattern, many = rooms[room].pop() if rooms[room] else ((), left)
                t = min(room // size, left)
                used = min(many, left // t)
                rooms[room - t * size].append((pattern + (size,) * t, used))
                left -= used * t
                if many > used and pattern:
                    rooms[room].append((pattern, many - used))
            if not left:
                break
    return [group for groups in rooms for group in groups]


def plan(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) until all counted pieces are used.

    Bin completion: the best-fit decreasing packing is the first incumbent. Then the undominated
    fillings of the largest remaining length are branched over, least waste first, each as often
    as the counts allow and, after that, once. A branch ends when the sequences it has and those
    that the rest needs at least are no fewer than the incumbent's, or when its rest was met with
    as few sequences. If the search ends within `nodes` fillings, the result has as few sequences as any packing.
    """
    left = counts.astype(np.int64).copy()
    best = best_fit(left, capacity)
    fewest, least = sum(n for _, n in best), bound(left, capacity)
    path: list[tuple[tuple[int, ...], int]] = []
    used, opened, turned = 0, 0, False  # opened counts from the first turn back
    met: dict[bytes, int] = {}

    def move(pattern: tuple[int, ...], times: int) -> None:
        nonlocal left, used
        left -= np.bincount(pattern, minlength=len(left)) * times
        used += times

    def often(pattern: tuple[int, ...]) -> int:
        held = np.bincount(pattern, minlength=len(left))
        return int((left[held > 0] // held[held > 0]).min())

    def choices() -> Iterator[tuple[tuple[int, ...], int]]:
        nonlocal best, fewest, opened
        opened += turned
        if not left.any():
            if used < fewest:
                best, fewest = path.copy(), used
            return
        state = hashlib.blake2b(left.tobytes(), digest_size=16).digest()
        if used + bound(left, capacity) >= fewest or met.get(state, fewest) <= used:
            return
        met[state] = used
        largest, before = int(np.flatnonzero(left)[-1]), used
        room, pieces = capacity - largest, int(left @ np.arange(len(left)))
        rest = left.copy()
        rest[largest] -= 1
        found = [(largest, *fill(room, rest))]
        if sum(found[0]) >= pieces - (fewest - 1 - before) * capacity + capacity:
            yield found[0], often(found[0])
        for k, filling in enumerate(fillings(room, rest)):  # only reached if the search comes back here
            pattern = (largest, *[size for size, t in filling for _ in range(t)])
            if opened > nodes or sum(pattern) < pieces - (fewest - 1 - before) * capacity + capacity:
                break  # it wastes more than a better packing may
            opened += 1
            if k and not dominated(filling, room, rest):
                found.append(pattern)
                yield pattern, often(pattern)
        for pattern in found:
            if often(pattern) > 1:
                yield pattern, 1

    stack = [choices()]
    while stack and fewest > least and opened <= nodes:
        chosen = next(stack[-1], None)
        if chosen is not None:
            path.append(chosen)
            move(*chosen)
            stack.append(choices())
            continue
        turned = True
        stack.pop()
        if path:
            pattern, times = path.pop()
            move(pattern, -times)
    return best


@dataclass(frozen=True)
class Places:
    """Where the pieces of each length go, by their rank among the pieces of that length."""

    until: list[np.ndarray]  # for each length: the rank after each run of equal patterns
    begin: list[np.ndarray]  # the first rank of the run
    sequence: list[np.ndarray]  # the number of the run's first sequence
    often: list[np.ndarray]  # how often the pattern holds the length
    offset: list[np.ndarray]  # where the first of these stands

    @staticmethod
    def of(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> Places:
        runs: list[list[tuple[int, ...]]] = [[] for _ in range(capacity + 1)]
        rank, sequence = [0] * (capacity + 1), 0
        for pattern, times in patterns:
            at = 0
            for size in dict.fromkeys(pattern):
                often = pattern.count(size)
                begin = rank[size]
                rank[size] += often * times
                runs[size].append((rank[size], begin, sequence, often, at))
                at += often * size
            sequence += times
        return Places(*[[np.array([r[k] for r in run], np.int64) for run in runs] for k in range(5)])

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size in np.unique(length).tolist():
            mine = np.flatnonzero(length == size)
            r = rank[mine]
            run = np.searchsorted(self.until[size], r, side="right")
            within = r - self.begin[size][run]
            sequence[mine] = self.sequence[size][run] + within // self.often[size][run]
            offset[mine] = self.offset[size][run] + within % self.often[size][run] * size
        return sequence, offset


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All columns of `found`, which has a `length` of 1 to `capacity`, and (sequence_id, offset).

    Pieces as long as a sequence get one each, with a negative number. Equal rows are ranked in any order, which only decides
    which of them goes where. Ranks are counted in groups made by a hash of the row, with the
    rows of earlier groups added, so a length that most pieces share is no large group. `found`
    should be stored: it is read more than once.
    """
    columns = found.columns
    full = found.where(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    found = found.where(F.col("length") < capacity)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    size = found.agg(F.count(F.lit(1))).first()[0]
    groups = max(1, -(-size // RANKED_ROWS))
    dealt = found.withColumn("__group", F.pmod(row, F.lit(groups)))
    held = settle(dealt.groupBy("length", "__group").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    totals = {r.length: r.n for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in totals.items():
        counts[length] = n
    places = Places.of(plan(counts, capacity), capacity)
    before = held.select(
        "length",
        "__group",
        (F.sum("n").over(Window.partitionBy("length").orderBy("__group")) - F.col("n")).alias("__before"),
    )
    order = Window.partitionBy("length", "__group").orderBy(row, *[F.col(f"`{c}`") for c in columns])
    ranked = dealt.join(before, ["length", "__group"]).withColumn("__rank", F.row_number().over(order) - 1 + F.col("__before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.names.index("length")
            sequence, offset = places.find(b.column(at).to_numpy(), b.column(b.num_columns - 1).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*b.schema.names[:-1], "sequence_id", "offset"]
            )

    source = ranked.select(*[F.col(f"`{c}`") for c in columns], F.col("__rank").cast("long"))
    schema = T.StructType([*found.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return full.unionAll(source.mapInArrow(run, schema))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The documents' pieces with their ids and their place: (id, piece, start, length, ids, sequence_id, offset)."""
    return place(settle(pieces(docs, tokenizer, id_col, text, capacity), "pieces"), capacity)
