"""Benchmark passages in documents, with DataFrame functions only.

A passage is a window of as many words as a benchmark item. Windows get SimHash fingerprints of
their weighted shingles. Four blocks of 16 bits index them: fingerprints within the radius are
within a known share of it in one block, so the blocks are sought with all values that near, and
every item within the radius is met. The exact weighted similarity of the shingles decides. A
window at the similarity shares a known number of shingles with the item, in any order, so all
windows that hold so many places of shared shingles are fingerprinted, and no others.

The first pass over the texts sends on places of shared shingles only; the second reads the texts
that have such windows, and no other text is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import text_of
from lakemill.session import settle

WIDTH = 5
SIMILARITY = 0.8
#: Bits by which the fingerprints of a window and an item at the similarity may differ. The angle
#: at weighted similarity 0.8 puts the mean near 10 of 64 with a deviation of 3; windows beyond
#: this radius, about one in a hundred of those just at the similarity, are the only ones that the
#: index can miss.
RADIUS = 16
BLOCKS = 4
#: Bits of a block that are flipped on the items' side; what a block needs beyond is flipped on the windows' side.
ITEM_FLIPS = 3
#: Shingles of items that are broadcast at once (16 bytes each); more are joined block by block.
BROADCAST_SHINGLES = 1_000_000
#: Keys of texts with windows that are broadcast (8 bytes each) to leave out the other texts;
#: with more of them the texts are shuffled once.
BROADCAST_KEYS = 1_000_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: Column, width: int) -> Column:
    """A hash of the `width` words from each place; none if there are fewer."""
    last = F.size(words) - width
    return F.when(
        last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    ).otherwise(F.array().cast("array<long>"))


def simhash(shingles: Column) -> Column:
    """64 bits; each is 1 if it is set in more than half of the hashes, repeats included."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)),
        F.lit(0).cast("long"),
        lambda bits, b: F.when(
            F.aggregate(shingles, F.lit(0), lambda n, h: n + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1)).cast("int")) * 2
            > F.size(shingles),
            bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)),
        ).otherwise(bits),
    )


def weighted_similarity(a: Column, b: Column) -> Column:
    """The sum of the smaller counts of all shingles by that of the larger ones."""
    count = lambda s, x: F.size(F.filter(s, lambda y: y == x))
    common = F.aggregate(F.array_distinct(a), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    return common / (F.size(a) + F.size(b) - common)


def starts_of(places: Column, n: Column, size: Column, width: int, similarity: float) -> Column:
    """Starts of all windows of `n` words, in a text of `size` words, that can reach the similarity.

    `places` are those of the text's shingles that an item of `n` words has too, in rising order.
    Of a window's a shingles and the item's m at least t(a + m)/(1 + t) must be common, whatever
    their order; so many places must lie in the window. A text shorter than `n` is one window.
    """
    item, window = n - (width - 1), F.least(n, size) - (width - 1)
    need = F.ceil(similarity * (item + window) / (1 + similarity) - 1e-9).cast("int")
    last = F.greatest(size - n, F.lit(0))
    low = lambda i: F.greatest(F.get(places, i + need - 1) - window + 1, F.lit(0))
    high = lambda i: F.least(F.get(places, i), last)
    none = F.array().cast("array<int>")
    found = F.transform(F.sequence(F.lit(0), F.size(places) - need), lambda i: F.when(low(i) <= high(i), F.sequence(low(i), high(i))).otherwise(none))
    return F.when(F.size(places) >= need, F.array_distinct(F.flatten(found))).otherwise(none)


def block_radii(radius: int) -> list[int]:
    """How near some block must be: two fingerprints beyond these in every block are beyond `radius`."""
    near, more = divmod(radius, BLOCKS)
    return [near if k <= more else near - 1 for k in range(BLOCKS)]


def flips_of(fingerprint: Column, flips: list[int]) -> Column:
    """(block, bits): each block of the fingerprint with up to `flips[block]` bits flipped; none if negative."""
    wide = 64 // BLOCKS

    def flipped(block: int, most: int) -> Column:
        masks = F.split(F.lit(",".join(str(m) for m in range(1 << wide) if m.bit_count() <= most)), ",").cast("array<long>")
        bits = F.shiftrightunsigned(fingerprint, block * wide).bitwiseAND(F.lit((1 << wide) - 1).cast("long"))
        return F.transform(masks, lambda m: F.struct(F.lit(block).alias("block"), bits.bitwiseXOR(m).alias("bits")))

    return F.flatten(F.array(*[flipped(k, most) for k, most in enumerate(flips) if most >= 0]))


def candidates(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """(n, fingerprint, item, distance): distinct fingerprints of windows and the items within `radius` bits of them."""
    radii = block_radii(radius)
    by_item = [min(r, ITEM_FLIPS) for r in radii]
    by_window = [r - i for r, i in zip(radii, by_item)]
    index = items.select("item", "n", F.col("fingerprint").alias("item_fingerprint"), F.explode(flips_of(F.col("fingerprint"), by_item)).alias("b"))
    index = index.select("item", "n", "item_fingerprint", "b.block", "b.bits")
    asked = windows.select("n", "fingerprint").distinct()
    asked = asked.select("n", "fingerprint", F.explode(flips_of(F.col("fingerprint"), by_window)).alias("b")).select("n", "fingerprint", "b.block", "b.bits")
    # The index is far larger than its items, which the planner measures; it is not to be broadcast.
    return (
        asked.join(index.hint("merge"), ["n", "block", "bits"])
        .withColumn("distance", F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))))
        .where(F.col("distance") <= radius)
        .select("n", "fingerprint", "item", "distance")
        .distinct()
    )


def placed_shingles(words: Column, width: int) -> Column:
    """(size, place, h) of each shingle, so that an exploded row needs nothing of its text."""
    last = F.size(words) - width
    row = lambda i: F.struct(F.size(words).alias("size"), i.alias("place"), F.xxhash64(*[F.get(words, i + k) for k in range(width)]).alias("h"))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), row))


def _hits(docs: DataFrame, items: DataFrame, width: int, similarity: float, radius: int, bound: int, bound_keys: int) -> DataFrame:
    """Hits of items whose shingles have `width` words; `item` is an item's own key, as its id may be null or repeated.

    `docs` are (key, doc_id, text). Texts with one key are one text, or share their windows' starts, which harms nothing.
    """
    probes = items.select("item", "n", F.explode(F.array_distinct("shingles")).alias("h"))
    size = probes.count()
    places = docs.select("key", words_of(F.col("text")).alias("words")).select("key", F.inline(placed_shingles(F.col("words"), width)))
    if size <= bound:
        met = places.join(F.broadcast(probes), "h")
    else:  # as many passes as it takes, each beside a bounded part of the shingles
        parts = -(-size // bound)
        part = F.pmod(F.col("h"), F.lit(parts))
        met = reduce(DataFrame.unionAll, [places.join(F.broadcast(probes.where(part == k)), "h") for k in range(parts)])
    shared = met.groupBy("key", "size", "item", "n").agg(F.sort_array(F.collect_set("place")).alias("places"))
    starts = shared.select("key", "n", F.explode(starts_of(F.col("places"), F.col("n"), F.col("size"), width, similarity)).alias("start"))
    starts = settle(starts.distinct(), "window-starts")
    keys = starts.select("key").distinct()
    few = keys.count() <= bound_keys
    texts = docs.join(F.broadcast(keys) if few else keys.hint("merge"), "key", "left_semi")
    texts = texts.groupBy("key", "doc_id").agg(F.first("text").alias("text"))
    texts = texts.select("key", "doc_id", words_of(F.col("text")).alias("words")).select("key", "doc_id", shingles_of(F.col("words"), width).alias("all"))
    # A window of a text shorter than the item ends with the text.
    windows = texts.join(starts, "key").select("doc_id", "n", "start", F.slice("all", F.col("start") + 1, F.col("n") - (width - 1)).alias("shingles"))
    windows = settle(windows.where(F.size("shingles") > 0).withColumn("fingerprint", simhash(F.col("shingles"))), "windows")
    sources = items.select("item", "item_id", F.col("shingles").alias("item_shingles"))
    return (
        windows.join(candidates(windows, items, radius), ["n", "fingerprint"])
        .join(sources, "item")
        .withColumn("similarity", weighted_similarity(F.col("shingles"), F.col("item_shingles")))
        .where(F.col("similarity") >= similarity)
        .select("doc_id", "item_id", "start", F.col("n").alias("n_words"), "distance", "similarity")
    )


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    bound: int = BROADCAST_SHINGLES,
    bound_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """(id, item_id, start, n_words, distance, similarity): the best window of each document and item.

    `start` is a word's number from 0; among equal windows the first one counts. Items of fewer
    than `width` words have one shingle of all their words; items without words, null ones too,
    match nothing. A null text has no window. Rows with one id are searched one by one and give
    one row together, also those with a null id; items with one id, or none, count as one row each way.
    Other columns are ignored. Empty tables give an empty result.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("doc_id", "text"))
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), words_of(text_of(item_text)).alias("words")).distinct()
    items = items.withColumn("n", F.size("words")).where("n > 0").withColumn("width", F.least("n", F.lit(width)))
    found = None
    for w in sorted(r[0] for r in items.select("width").distinct().collect()):  # at most `width` of them
        sized = items.where(F.col("width") == w).withColumn("shingles", shingles_of(F.col("words"), w)).withColumn("item", F.monotonically_increasing_id())
        sized = settle(sized.withColumn("fingerprint", simhash(F.col("shingles"))).drop("words", "width"), "benchmark-items")
        hits = _hits(texts, sized, w, similarity, radius, bound, bound_keys)
        found = hits if found is None else found.unionAll(hits)
    if found is None:
        found = _hits(texts.limit(0), items.withColumn("item", F.lit(0).cast("long")).withColumn("shingles", shingles_of(F.col("words"), width)).withColumn("fingerprint", F.lit(0).cast("long")), width, similarity, radius, bound, bound_keys)
    best = F.struct(F.col("similarity"), (-F.col("start")).alias("back"), F.col("n_words"), F.col("distance"))
    best_rows = found.groupBy("doc_id", "item_id").agg(F.max(best).alias("b"))
    return best_rows.select(
        F.col("doc_id").alias(id_col),
        F.col("item_id"),
        (-F.col("b.back")).alias("start"),
        F.col("b.n_words").alias("n_words"),
        F.col("b.distance").alias("distance"),
        F.col("b.similarity").alias("similarity"),
    )
