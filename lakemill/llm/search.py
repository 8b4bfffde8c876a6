"""Ranked search for many queries at once, with shared parts of queries evaluated once.

A query's score is a sum over its terms, so queries that share a set of terms share a partial sum.
Shared sets are mined among the items: terms that the same items hold equally often first, then,
again and again, the two parts that most items hold together become one part. The parts form a
graph without cycles. For a batch of documents the partial sum of each part is made once, from the
two that it joins, and each item adds up the few parts that are left of it.

One pass over the texts keeps, for each document, its number of terms and how often it holds each
term that some item asks for. Counts over all documents come from these rows, and a second pass
over them scores. A task returns its best documents for each item only. Items come in blocks, so
that what a task holds does not grow with their number.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.common import prepare, text_of
from lakemill.session import settle

#: Terms of the items that are searched in one pass, about; more items are searched in more passes.
BLOCK_TERMS = 400_000
#: Numbers in the table of partial sums that a task makes at once: parts times documents.
CELLS = 4_000_000

#: Parts of an item that are paired with each other when shared sets are mined; longer items are paired in
#: runs of as many. It decides what is shared, never a score.
PAIRED = 500

#: Letters, digits and all bytes of characters beyond ASCII stand for themselves, A-Z in lower case; the rest parts terms.
_SIGNS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: str) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8").translate(_SIGNS).split()


@dataclass(frozen=True)
class Sharing:
    """The parts of a block of items.

    Parts below `len(leaves)` are leaves, (term, how often); the others join the two of `joins`, in an
    order in which both come before. `items` holds the parts whose sums make up each item's score.
    """

    leaves: list[tuple[int, int]]
    joins: list[tuple[int, int]]
    items: list[list[int]]

    def levels(self) -> list[np.ndarray]:
        """Numbers of joins, those of one level needing only leaves and earlier levels."""
        depth = [0] * len(self.leaves)
        levels: list[list[int]] = []
        for k, (a, b) in enumerate(self.joins):
            depth.append(1 + max(depth[a], depth[b]))
            while len(levels) < depth[-1]:
                levels.append([])
            levels[depth[-1] - 1].append(k)
        return [np.array(level, np.int64) for level in levels]

    def additions(self) -> tuple[int, int]:
        """Additions for one document: with parts shared, and item by item."""
        size = [1] * len(self.leaves)
        for a, b in self.joins:
            size.append(size[a] + size[b])
        alone = sum(max(0, sum(size[p] for p in item) - 1) for item in self.items)
        return len(self.joins) + sum(max(0, len(item) - 1) for item in self.items), alone


def mine(items: list[Counter]) -> Sharing:
    """Parts that at least two items share, the pair that most items hold joined first, ties by number."""
    leaves = sorted({(t, n) for item in items for t, n in item.items()})
    number = {leaf: k for k, leaf in enumerate(leaves)}
    held = [{number[leaf] for leaf in item.items()} for item in items]
    joins: list[tuple[int, int]] = []
    owners: dict[int, set[int]] = defaultdict(set)  # the items that hold a part
    for q, parts in enumerate(held):
        for p in parts:
            owners[p].add(q)

    def join(a: int, b: int, common: set[int]) -> int:
        new = len(leaves) + len(joins)
        joins.append((a, b))
        owners[new] = set(common)
        for q in common:
            held[q] -= {a, b}
            held[q].add(new)
        owners[a] -= common
        owners[b] -= common
        return new

    same: dict[frozenset, list[int]] = defaultdict(list)
    for p in range(len(leaves)):
        if len(owners[p]) > 1:
            same[frozenset(owners[p])].append(p)
    for group in same.values():  # terms that the same items hold
        part = group[0]
        for other in group[1:]:
            part = join(part, other, set(owners[other]))

    together: Counter = Counter()
    for parts in held:
        shared = sorted(p for p in parts if len(owners[p]) > 1)
        for at in range(0, len(shared), PAIRED):
            run = shared[at : at + PAIRED]
            together.update((a, b) for i, a in enumerate(run) for b in run[i + 1 :])
    heap = [(-n, pair) for pair, n in together.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (a, b) = heapq.heappop(heap)
        common = owners[a] & owners[b]
        if len(common) < 2:
            continue
        if len(common) < -n:  # fewer items hold both since one of them was joined elsewhere
            heapq.heappush(heap, (-len(common), (a, b)))
            continue
        new = join(a, b, common)
        beside = Counter(p for q in common for p in held[q] if p != new and len(owners[p]) > 1)
        for p, many in beside.items():
            if many > 1:
                heapq.heappush(heap, (-many, (p, new)))
    return Sharing(leaves, joins, [sorted(parts) for parts in held])


@dataclass(frozen=True)
class Statistics:
    documents: int  # with a term
    total: int  # terms of all of them, repeats included
    holding: list[int]  # documents that hold each term of the block

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1))) for df in self.holding], np.int64)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """What a document's length adds to the divisor: 100 for the mean length, 25 for a short one."""
        return np.array([100 - 75 + (75 * k * self.documents) // max(self.total, 1) for k in n.tolist()], np.int64)


POSTINGS = "doc_id long, n long, held int, terms binary, times binary"


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text: str) -> DataFrame:
    """Stored rows: a document's id, its number of terms, and the asked terms that it holds with their counts."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, held, found, times = [], [], [], []
            for t in b.column(1).to_pylist():
                words = terms(t)
                n.append(len(words))
                counts = Counter(vocabulary[w] for w in words if w in vocabulary)
                held.append(len(counts))
                found.append(np.fromiter(counts.keys(), "<u4", len(counts)).tobytes())
                times.append(np.fromiter(counts.values(), "<u4", len(counts)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(held, pa.int32()), pa.array(found, pa.binary()), pa.array(times, pa.binary())],
                names=["doc_id", "n", "held", "terms", "times"],
            )

    return settle(source.mapInArrow(run, POSTINGS), "postings")


def statistics(stored: DataFrame, size: int) -> Statistics:
    """Counts over all documents; each task sends one number for each term of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 2, np.int64)
        for b in batches:
            n = b.column(0).to_numpy()
            counts[size] += np.count_nonzero(n)
            counts[size + 1] += n.sum()
            counts[:size] += np.bincount(np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4"), minlength=size)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["term", "n"])

    counts = [0] * (size + 2)
    for r in stored.select("n", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[r.term] = r.n  # as many rows as the block has terms
    return Statistics(counts[size], counts[size + 1], counts[:size])


class Scorer:
    """Scores of a batch of documents for all items of a block."""

    def __init__(self, shared: Sharing, facts: Statistics):
        self.shared, self.facts, self.weights = shared, facts, facts.weights()
        self.term = np.array([t for t, _ in shared.leaves], np.int64)
        self.often = np.array([n for _, n in shared.leaves], np.int64)
        self.joins = np.array(shared.joins, np.int64).reshape(-1, 2)
        self.levels = shared.levels()
        self.parts = np.array([p for item in shared.items for p in item], np.int64)
        self.sizes = np.array([len(item) for item in shared.items], np.int64)
        self.batch = max(1, CELLS // max(1, len(self.term) + len(self.joins) + len(self.parts)))

    def scores(self, n: np.ndarray, held: np.ndarray, found: np.ndarray, times: np.ndarray) -> np.ndarray:
        """(item, document); `found` and `times` hold the documents' terms and counts one after the other."""
        doc = np.repeat(np.arange(len(n)), held)
        tf = times.astype(np.int64)
        own = self.weights[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * self.facts.lengths(n)[doc]))
        by_term = np.zeros((len(self.weights), len(n)), np.int64)
        by_term[found, doc] = own
        first = len(self.term)
        sums = np.empty((first + len(self.joins), len(n)), np.int64)
        sums[:first] = by_term[self.term] * self.often[:, None]
        for level in self.levels:
            sums[first + level] = sums[self.joins[level, 0]] + sums[self.joins[level, 1]]
        out = np.zeros((len(self.sizes), len(n)), np.int64)
        some = np.flatnonzero(self.sizes)
        if len(some):
            out[some] = np.add.reduceat(sums[self.parts], (np.cumsum(self.sizes) - self.sizes)[some], axis=0)
        return out


def best(score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray, k: int) -> np.ndarray:
    """Places of the `k` highest scores, ties by id, rows without an id last."""
    if len(score) > 4 * k:  # what is below the k-th score cannot be among them
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    return some[np.lexsort((doc[some], unnamed[some], -score[some]))[:k]]


def scored(stored: DataFrame, scorer: Scorer, keys: list[int], k: int) -> DataFrame:
    """(key, doc_id, score): for each task and item, the task's `k` best documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(keys)
        top = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(items)]
        least = np.ones(items, np.int64)  # scores below it are not among the best
        for b in batches:
            for at in range(0, b.num_rows, scorer.batch):
                part = b.slice(at, scorer.batch)
                ids = part.column(0)
                doc, unnamed = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                lists = [np.frombuffer(b"".join(part.column(c).to_pylist()), "<u4") for c in (3, 4)]
                scores = scorer.scores(part.column(1).to_numpy(), part.column(2).to_numpy(), *lists)
                rows, places = np.nonzero(scores >= least[:, None])
                cuts = np.searchsorted(rows, np.arange(items + 1))
                for q in np.unique(rows).tolist():
                    mine = places[cuts[q] : cuts[q + 1]]
                    all_ = [np.concatenate(x) for x in zip(top[q], (scores[q, mine], doc[mine], unnamed[mine]))]
                    chosen = best(*all_, k)
                    top[q] = tuple(x[chosen] for x in all_)
                    if len(chosen) == k:
                        least[q] = top[q][0][-1]
        sizes = [len(t[0]) for t in top]
        if sum(sizes):
            score, doc, unnamed = (np.concatenate([t[c] for t in top]) for c in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(keys, np.int64), sizes)), pa.array(doc, mask=unnamed), pa.array(score)], names=["key", "doc_id", "score"]
            )

    return stored.select("doc_id", "n", "held", "terms", "times").where("held > 0").mapInArrow(run, "key long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text",
    item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item id, rank, document id, score): the `k` documents of highest score for each item.

    Only scores above 0 count. Ranks start at 1; equal scores rank by ascending id, documents
    without an id last. A null or empty text has no terms: such an item finds nothing, such a
    document is never found. Repeated documents rank one by one; each row of `items` is searched by
    itself, also if its id is null or repeated. Other columns are ignored. Empty tables give an
    empty result. Texts are read whole, whatever their length.
    """
    spark = prepare(docs.sparkSession)
    wanted = items.select(F.col(f"`{item_col}`").alias("item_id"), text_of(item_text).alias("text"))
    wanted = settle(wanted.withColumn("key", F.monotonically_increasing_id()), "search-items")
    letters = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-letters // (6 * block_terms)))
    dealt = wanted.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("key", "text").orderBy("key").collect()  # a block of bounded size
        asked = [Counter(terms(r.text)) for r in rows]
        vocabulary = {w: i for i, w in enumerate(sorted({w for item in asked for w in item}))}
        if not vocabulary:
            continue
        shared = mine([Counter({vocabulary[w]: n for w, n in item.items()}) for item in asked])
        stored = postings(docs, vocabulary, id_col, text)
        scorer = Scorer(shared, statistics(stored, len(vocabulary)))
        part = scored(stored, scorer, [r.key for r in rows], k)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], "key long, doc_id long, score long")
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = settle(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "search-ranks")
    named = ranked.join(wanted.select("key", "item_id"), "key")
    return named.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
