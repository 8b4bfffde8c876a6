"""Near duplicates by SimHash, found over shared positional bytes of the fingerprints.

Two 64-bit fingerprints that differ in at most `d` bits differ in at most `d` of their 8 bytes, so
they agree in at least 8 - d positional bytes (4 for the distance of 4). The inverted index has a
posting for each choice of that many positions and the bytes there. Within a posting the shared
positional bytes of a pair are tallied; a pair counts at the first choice of positions that it
shares, if it has the guaranteed number of matches, and is then verified by its bit distance.

Only distinct fingerprints enter the index, so copies of a text never meet as pairs. What leaves a
task is a forest of links and not the pairs of a posting; a posting with very many fingerprints is
joined over the fingerprints half-way between them, without comparing all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.llm.common import add_columns, prepare
from lakemill.llm.graph import components, forest
from lakemill.session import settle

SEED = 42
#: Shingles whose bits are tallied at once.
SHINGLE_BLOCK = 1 << 16
#: A posting with more fingerprints than this is not compared pair by pair.
DENSE = 1 << 13
POSTING_ROWS = 1 << 16
#: Links that a task holds before it reduces them to a forest.
HELD_LINKS = 1 << 19
_ONE = np.uint64(1)


def fingerprint(text: str, width: int = 4) -> int:
    """SimHash of the `width`-word shingles, repeats included; 0 without any word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, joined, n = xxhash.xxh64_digest, b" ".join(words), len(words)
    if n <= width:
        digests = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digests = [digest(joined[a:b], SEED) for a, b in zip(starts[: n - width + 1].tolist(), ends[width - 1 :].tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(digests), SHINGLE_BLOCK):
        block = np.frombuffer(b"".join(digests[at : at + SHINGLE_BLOCK]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(digests)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", width: int = 4, out: str = "fp") -> DataFrame:
    """All columns of `docs` and the fingerprint as a signed long."""

    def make():
        def derive(texts):
            found = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
            return [pa.array(found.view(np.int64))]

        return derive

    return add_columns(docs, text, [T.StructField(out, T.LongType())], make)


def _choices(distance: int) -> list[tuple[int, ...]]:
    if not 0 <= distance < 8:
        raise ValueError("the distance must be 0 to 7 bits")
    return list(combinations(range(8), 8 - distance))


def _mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << 8 * p for p in positions)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class _Links:
    """Links found in a task, kept as a forest."""

    def __init__(self):
        self.a, self.b, self.held = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.held += len(a)
            if self.held > HELD_LINKS:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        a, b = forest(np.concatenate(self.a), np.concatenate(self.b))
        # A forest may itself be large; only what comes on top of it counts as held.
        self.a, self.b, self.held = [a], [b], 0
        return a, b


def _halfway(fps: np.ndarray, free: list[int], distance: int, links: _Links) -> None:
    """Links the fingerprints of one posting that are within `distance`, in time linear in them.

    Two are within the distance if some word lies within half of it of the one and within the
    other half of the other; such a word keeps the posting's bytes. Words are made in blocks.
    """
    near, far = distance // 2, distance - distance // 2
    flips = {r: [sum(1 << b for b in c) for k in range(r + 1) for c in combinations(free, k)] for r in {near, far}}
    parts = max(1, len(fps) * len(flips[far]) >> 23)
    pick = np.uint64(0x9E3779B97F4A7C15)
    for part in range(parts):
        words, owner, close = [], [], []
        index = np.arange(len(fps))
        for radius in sorted({near, far}):
            for flip in flips[radius]:
                w = fps ^ np.uint64(flip)
                mine = (w * pick >> np.uint64(33)) % np.uint64(parts) == part
                words.append(w[mine])
                owner.append(index[mine])
                close.append(np.full(int(mine.sum()), radius == near))
        w, o, c = np.concatenate(words), np.concatenate(owner), np.concatenate(close)
        order = np.argsort(w, kind="stable")
        w, o, c = w[order], o[order], c[order]
        heads = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        group = np.cumsum(np.r_[True, w[1:] != w[:-1]]) - 1
        usable = np.maximum.reduceat(c.astype(np.int8), heads)[group] > 0
        first = o[heads][group]
        keep = usable & (o != first)
        links.add(fps[o[keep]], fps[first[keep]])


def _link_postings(choice: np.ndarray, key: np.ndarray, fps: np.ndarray, distance: int, links: _Links) -> None:
    """Adds the links between the fingerprints of whole postings, sorted by (choice, key)."""
    choices = _choices(distance)
    first = np.full(256, -1, np.int16)  # mask of shared positions -> the first choice within it
    for mask in range(256):
        held = [i for i, c in enumerate(choices) if all(mask >> p & 1 for p in c)]
        first[mask] = held[0] if held else -1
    n = len(fps)
    same = np.r_[(choice[1:] == choice[:-1]) & (key[1:] == key[:-1]), False]
    heads = np.flatnonzero(~np.r_[False, same[:-1]])
    sizes = np.diff(np.r_[heads, n])
    for at in np.flatnonzero(sizes > DENSE):
        bits = [8 * p + i for p in range(8) if p not in choices[choice[heads[at]]] for i in range(8)]
        _halfway(fps[heads[at] : heads[at] + sizes[at]], bits, distance, links)
    end = np.repeat(heads + sizes, sizes)
    left = np.flatnonzero(same & (np.repeat(sizes, sizes) <= DENSE))
    lag = 1
    while len(left):
        differ = fps[left] ^ fps[left + lag]
        shared = np.packbits(np.ascontiguousarray(differ).view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little")[:, 0]
        # The tally: enough shared positional bytes, at the first choice that holds them.
        good = (np.bitwise_count(shared) >= 8 - distance) & (first[shared] == choice[left])
        good &= np.bitwise_count(differ) <= distance
        links.add(fps[left[good]], fps[left[good] + lag])
        lag += 1
        left = left[left + lag < end[left]]


def link_forest(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Edges (a, b) that connect the fingerprints `fp` of `fps` linked at `distance` bits or fewer."""
    choices = _choices(distance)
    postings = fps.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).cast("smallint").alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(_mask(c)))).alias("key"))
                    for i, c in enumerate(choices)
                ]
            )
        ).alias("p"),
    ).select("p.choice", "p.key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, rest = _Links(), None
        for b in batches:
            new = [b.column(i).to_numpy() for i in range(3)]
            rest = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            c, k, f = rest
            if not len(c):
                continue
            last = len(c) - int(((c == c[-1]) & (k == k[-1])).sum())  # where the last posting starts
            if not last:
                continue
            _link_postings(c[:last], k[:last], f[:last].astype(np.int64).view(np.uint64), distance, links)
            rest = [c[last:], k[last:], f[last:]]
        if rest is not None and len(rest[0]):
            _link_postings(rest[0], rest[1], rest[2].astype(np.int64).view(np.uint64), distance, links)
        a, b = links.reduce()
        for at in range(0, len(a), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(a[part].view(np.int64)), pa.array(b[part].view(np.int64))], names=["a", "b"])

    dealt = postings.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of `docs`: (id, fingerprint, component_id).

    `fingerprint` is the SimHash of the words' shingles as 16 hex digits; `component_id` is the
    smallest id reachable over links of at most `distance` bits. A text without words (null too)
    has the fingerprint 0 and links like any other. Repeated rows each stay. A row without an id
    takes part in linking and keeps its null id; a component where no row has an id has a null
    component. An empty table gives an empty result. Other columns are ignored.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = settle(fingerprints(source, width=width).select("doc_id", "fp"), "fingerprints")
    least = settle(found.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    prepare(docs.sparkSession, POSTING_ROWS)  # rows of three numbers
    links = settle(link_forest(least.select("fp"), distance), "fingerprint-links")
    prepare(docs.sparkSession)
    groups = components(links)
    named = least.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = settle(named, "fingerprint-groups")
    smallest = settle(named.groupBy("component").agg(F.min("least_id").alias("component_id")), "group-ids")
    ids = settle(named.join(smallest, "component").select("fp", "component_id"), "fingerprint-ids")
    return found.join(ids, "fp").select(
        F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
