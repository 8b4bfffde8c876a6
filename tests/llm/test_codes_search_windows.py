"""Vector codes, ranked search and window packing against plain versions, on tables with the awkward cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import codes, queries, search, windows
from lakemill.llm.word_tokens import WordEncoder

VECTORS = "vec_id long, embedding array<double>, label int"


def vectors() -> list[tuple]:
    rng = np.random.default_rng(3)
    base = rng.normal(scale=0.3, size=(30, 8))
    rows = [(int(k), (base[k % 30] + 0.05 * rng.normal(size=8)).tolist(), int(k % 3)) for k in rng.permutation(300)]
    rows += [(400 + k, base[2].tolist(), None) for k in range(20)]  # equal vectors, also among the first entries
    rows += [(None, base[1].tolist(), 1), (None, base[3].tolist(), None), (7, base[4].tolist(), 2)]
    bad = [None, [None] * 8, [float("nan")] + [0.0] * 7, [float("inf")] + [0.0] * 7, [0.0] * 7 + [None]]
    return rows + [(900 + k, v, 5) for k, v in enumerate(bad)]


def plain_codes(rows: list[tuple], parts: int, entries: int, rounds: int):
    good = [(i, v, label) for i, v, label in rows if v is not None and None not in v and np.isfinite(v).all()]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[math.floor(1024 * c) for c in v] for _, v, _ in good]
    width = len(x[0]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[list(cut(v, p)) for v in x[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b))
    near = lambda v, book: min((gap(v, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for v in x:
                held[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, members in held.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for (i, _, label), v in zip(good, x):
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, [k for _, k in found], sum(d for d, _ in found)))
    return out, books


@pytest.mark.parametrize(("parts", "entries", "groups"), [(4, 16, 4), (2, 500, 8), (8, 5, 1)])
def test_codes_against_plain_rounds(spark, parts, entries, groups):
    rows = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5).selectExpr("*", "1 AS x", "'e' AS error", "2 AS code", "3 AS measured")
    found = codes.encode(df, parts=parts, entries=entries, groups=groups)
    want, books = plain_codes(rows, parts, entries, codes.ROUNDS)
    got = [(r.vec_id, None if r.label is None else int(r.label), list(r.codes), r.error) for r in found.rows.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert [b.tolist() for b in found.books.last] == books
    first, *others = found.measured
    assert first == len(want) * parts * min(groups, entries, len(want)) and max(others) <= first


def test_bounds_hold_and_save_measures():
    rng = np.random.default_rng(4)
    base = rng.integers(-40, 40, (20, 3))
    x = np.concatenate([base[k % 20] + rng.integers(-2, 3, (1, 3)) for k in range(400)])
    of = codes.groups_of(20, 5)
    books = codes.Codebooks(((x[:20].copy(),),))
    known, measured = None, []
    for step in range(6):
        known = codes.assign(x, 0, books, of, known)
        d = ((x[:, None] - books.last[0]) ** 2).sum(axis=2)
        assert (known.code == d.argmin(axis=1)).all() and (known.error == d.min(axis=1)).all()
        moved = books.moved(0)
        for g in range(5):
            far = np.where((np.arange(20) == known.code[:, None]) | (of != g), np.inf, np.sqrt(d)).min(axis=1)
            reach = moved[:, of == g].max(axis=1)
            assert (known.lower[:, g] - reach[known.stamp[:, g]] <= far).all()
        measured.append(known.measured)
        means = [x[known.code == k].sum(axis=0) // max((known.code == k).sum(), 1) if (known.code == k).any() else books.last[0][k] for k in range(20)]
        books = books.after([np.array(means)])
    assert measured[0] == 2000 and measured[-1] < 400
    # the straight way is no longer than the sum of the moves
    steps = [np.sqrt(((b[0] - a[0]) ** 2).sum(axis=1)) for a, b in zip(books.history, books.history[1:])]
    assert (books.moved(0)[0] <= sum(steps) * (1 + 2 * codes.SLACK) + 1e-9).all()


def test_codes_of_awkward_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert codes.encode(empty) is None
    assert codes.encode(spark.createDataFrame([(1, None, 1), (2, [float("nan")] * 4, 1)], VECTORS)) is None
    one = codes.encode(spark.createDataFrame([(5, [0.1, -0.1, 1e3, -1e3], None)], VECTORS))
    assert [tuple(r) for r in one.rows.collect()] == [(5, None, [0, 0, 0, 0], 0)]
    assert one.books.last[1].tolist() == [[-103]]
    for wrong in ([(1, [1.0] * 4, 0), (2, [1.0] * 8, 0)], [(1, [1.0] * 6, 0)], [(1, [1e300] * 4, 0)]):
        with pytest.raises(ValueError):
            codes.encode(spark.createDataFrame(wrong, VECTORS))


def test_codes_leave_no_state_behind(spark):
    import os

    root = spark.conf.get("spark.checkpoint.dir") + "/lakemill"
    held = lambda: {f for f in os.listdir(root) if f.startswith(("vector-integers", "vector-bounds"))}
    before = held()
    codes.encode(spark.createDataFrame(vectors(), VECTORS), entries=4, parts=2)
    assert held() == before


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def plain_search(docs, items, k=10):
    held = [(i, plain_terms(t)) for i, t in docs]
    n_docs, total = sum(1 for _, w in held if w), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, words in held:
            counts, m = Counter(words), 25 + (75 * len(words) * n_docs) // max(total, 1)
            score = sum(weight[t] * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m)) for t in plain_terms(text) if t in counts)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return out


def search_tables():
    rnd = random.Random(5)
    words = ["alpha", "Beta", "ГАММА", "été", "x1", "中文", "İ", "z\x80z", "the", "of", "naïve", "q", "9"]
    words += ["w%d" % k for k in range(60)]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", ", ", "\n", "-", "\x00", "_"]) for _ in range(n))
    docs = [(k, text(rnd.randrange(1, 60))) for k in range(120)] + [(200 + k, docs_text) for k, docs_text in enumerate(["the the the"] * 25)]
    docs += [(None, "the x1 beta"), (None, "the x1 beta"), (3, "alpha"), (300, None), (301, ""), (302, " -_ \x00"), (303, text(30_000)), (304, "THE")]
    shared = text(12)
    items = [(k, shared + text(rnd.randrange(1, 10))) for k in range(12)] + [(20, "the THE the"), (21, None), (22, ""), (23, "nowhere"), (None, "alpha q"), (24, "alpha q"), (24, "alpha q")]
    return docs, items


@pytest.mark.parametrize("block_terms", [search.BLOCK_TERMS, 10])
def test_search_against_all_scores(spark, block_terms):
    docs, items = search_tables()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6).selectExpr("*", "1 AS n", "2 AS score", "3 AS rank", "4 AS key")
    i = spark.createDataFrame(items, "item_id long, text string").repartition(3).selectExpr("*", "1 AS key", "2 AS block", "3 AS doc_id")
    got = [tuple(r) for r in search.search(d, i, block_terms=block_terms).collect()]
    assert sorted(got, key=str) == sorted(plain_search(docs, items), key=str)


def test_search_in_small_batches_and_empty_tables(spark, monkeypatch):
    docs, items = search_tables()
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(search, "CELLS", 2000)
    got = [tuple(r) for r in search.search(d.coalesce(1), i, k=3).collect()]
    assert sorted(got, key=str) == sorted(plain_search(docs, items, 3), key=str)
    assert search.search(d.limit(0), i).count() == 0 and search.search(d, i.limit(0)).count() == 0
    assert search.search(d, i.where("text IS NULL")).count() == 0


def test_shared_parts_make_up_the_items(monkeypatch):
    rnd = random.Random(6)
    for paired in (search.PAIRED, 3):
        monkeypatch.setattr(search, "PAIRED", paired)
        sets = [rnd.sample(range(40), 8) for _ in range(5)]
        items = [Counter({t: rnd.choice([1, 1, 2]) for t in rnd.choice(sets) + rnd.choice(sets)}) for _ in range(40)] + [Counter()]
        shared = search.mine(items)
        made: list[Counter] = [Counter({t: n}) for t, n in shared.leaves]
        for a, b in shared.joins:
            assert not set(made[a]) & set(made[b])  # no term counts twice
            made.append(made[a] + made[b])
        assert [sum((made[p] for p in parts), Counter()) for parts in shared.items] == items
        together, alone = shared.additions()
        assert together < alone
        done = set(range(len(shared.leaves)))
        for level in shared.levels():
            assert all(p in done for k in level for p in shared.joins[k])
            done |= {len(shared.leaves) + int(k) for k in level}


def least_squares(columns: np.ndarray, histogram: np.ndarray) -> float:
    """The least squared error of a non-negative solution, by projected gradients."""
    x, step = np.zeros(columns.shape[1]), 1 / np.linalg.norm(columns, 2) ** 2
    for _ in range(20_000):
        x = np.maximum(0, x - step * columns.T @ (columns @ x - histogram))
    return float(((columns @ x - histogram) ** 2).sum())


def test_counts_are_the_least_squares(spark):
    rng = np.random.default_rng(7)
    for capacity in (16, 20, 32):
        counts = rng.integers(0, 50, capacity) * (rng.random(capacity) < 0.8)
        counts[0] = 0
        found = windows.Combinations.filling(capacity, counts)
        want = {(a, b, capacity - a - b) for a in range(1, capacity) for b in range(1, a + 1) if 0 <= capacity - a - b <= b}
        want = {t for t in want if all(s == 0 or counts[s] for s in t)}
        assert set(zip(found.a.tolist(), found.b.tolist(), found.c.tolist())) == want
        matrix = np.zeros((capacity, len(found.a)))
        for k in range(len(found.a)):
            for size in (found.a[k], found.b[k], found.c[k]):
                matrix[size, k] += size > 0
        assert (found.norms() == (matrix**2).sum(axis=0)).all()
        x = windows.solve(found, counts, tolerance=1e-9, sweeps=20_000)
        assert (x >= 0).all() and ((matrix @ x - counts) ** 2).sum() <= least_squares(matrix, counts) + 1e-3


@pytest.mark.parametrize("kind", ["few", "one length", "halves", "mixed", "short", "empty"])
def test_plans_leave_no_padding(kind):
    capacity, rng = 64, np.random.default_rng(8)
    counts = np.zeros(capacity, np.int64)
    if kind == "few":
        counts[[3, 40]] = 1, 2
    elif kind == "one length":
        counts[45] = 100_003
    elif kind == "halves":
        counts[32] = 7
    elif kind == "mixed":
        counts[1:] = rng.integers(0, 3000, capacity - 1)
    elif kind == "short":
        counts[1:4] = 10_000, 5, 77
    found = windows.plan(counts, capacity)
    covered = defaultdict(Counter)
    filled: dict[int, list] = defaultdict(list)
    for root, first, many, start, length, sequence, offset in found.runs:
        for k in range(many):
            covered[root, first + k][start] += length
            filled[sequence + k].append((offset, length))
    assert len(covered) == counts.sum()
    for (root, rank), parts in covered.items():
        at = 0
        for start in sorted(parts):
            assert start == at
            at += parts[start]
        assert at == root and rank < counts[root]
    sizes = []
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        sizes.append(at)
    assert len(sizes) == found.sequences == sum(s == capacity for s in sizes) + len({s for s in sizes if s < capacity})
    assert all(s.bit_count() == 1 for s in sizes)
    if kind == "mixed":
        # More lengths are above a half than sequences are needed, so some must be cut.
        assert sum(r[2] for r in found.runs) < counts.sum() + found.sequences // 3


def window_docs():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdeéñßА中") for _ in range(rnd.randrange(1, 9)))
    rows = [(k, " ".join(word() for _ in range(rnd.randrange(0, 90)))) for k in range(150)]
    rows += [(200 + k, "same text, twice or more often.") for k in range(400)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (None, "no id"), (None, "no id"), (3, rows[3][1]), (303, " ".join(word() for _ in range(30_000)))]
    return rows + [(310, "<|endoftext|> It's we'll 12 x\x1cy ΑΣ. é ᠎")]


def test_windows_hold_every_token_once(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.WORD_TOKENIZER)
    rows = window_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    df = df.selectExpr("*", "1 AS part", "2 AS nth", "3 AS ids", "4 AS rest", "5 AS before", "6 AS rank", "7 AS length")
    got = windows.pack(df, path, capacity=256).collect()
    plain = Tokenizer.from_file(path)
    want = Counter((i, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows)
    assert all(len(r.ids) == 4 * r.length for r in got)
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    sizes = []
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        sizes.append(at)
    short = [s for s in sizes if s != 256]
    assert max(sizes) == 256 and len(short) == len(set(short)) and all(s.bit_count() == 1 for s in short)
    # documents whose id is unique come together from their pieces; of the others all starts are there equally often
    together = defaultdict(list)
    for r in got:
        together[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
    for i, parts in together.items():
        wanted = [ids for (j, ids), n in want.items() for _ in range(n) if j == i]
        if len(wanted) == 1:
            assert b"".join(p[1] for p in sorted(parts)) == wanted[0] and {p[2] for p in parts} == {len(wanted[0]) // 4}
        else:
            assert sum(len(p[1]) for p in parts) == sum(map(len, wanted))
    assert set(together) == {i for i, _ in rows}
    assert windows.pack(df.limit(0), path).count() == 0


def test_windows_cut_few_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = windows.pack(df, queries.tokenizer_path(queries.WORD_TOKENIZER))
    facts = got.agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.countDistinct("sequence_id").alias("s")).first()
    whole = df.count() + got.where("sequence_id < 0").count()
    assert facts.s == facts.tokens // 2048 + (facts.tokens % 2048).bit_count()
    assert facts.n < whole + facts.s


def test_words_one_by_one_give_the_tokenizers_ids():
    path = queries.tokenizer_path(queries.WORD_TOKENIZER)
    words, rnd = WordEncoder(path), random.Random(10)
    assert words.splits
    signs = [*"aBéÉΣςİǅ1٣’'st.,!*ßẞ÷_µª中한́ͅ\x00\x85\x1c᠎​﻿ 　", "é", "'ll", "re", " ", "  ", "\n", "<|endoftext|>", "ﬁ", "Ⅳ", "😀"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(14))) for _ in range(5000)]
    assert [i.tolist() for i in words.encode(texts)] == words._encode(texts)
    assert [i.tolist() for i in words.encode(texts[:9], 1)] == [[*i, 1] for i in words._encode(texts[:9])]
    other = WordEncoder(queries.tokenizer_path())
    assert not other.splits and [i.tolist() for i in other.encode(texts[:99])] == other._encode(texts[:99])
