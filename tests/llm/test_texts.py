"""The operators on texts against brute force, on small tables with the awkward cases."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lakemill.llm import decontaminate, licenses, packing, quality, queries, simhash, suffixes, token_files, toxicity
from lakemill.llm.tokens import Encoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = "/root/testdata/sf0.001"


def made(seed: int = 1) -> list[tuple]:
    """Near and exact copies, shared passages, empty, null and long texts, ties and repeated rows."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeéñß") for _ in range(rnd.randrange(2, 9)))
    passage = " ".join(word() for _ in range(60))
    rows: list = []
    for k in range(30):
        words = [word() for _ in range(rnd.randrange(5, 120))]
        if k % 4 == 0:
            words[2:2] = passage.split()
        rows.append((k, " ".join(words)))
    rows += [(100 + k, rows[k][1]) for k in range(6)]
    rows += [(200 + k, rows[k][1].replace("a", "b", 1)) for k in range(12)]
    rows += [(300, ""), (301, None), (302, "one two"), (303, "one two"), (None, rows[3][1]), (None, "no id"), (7, rows[7][1])]
    rows += [(304, " ".join(word() for _ in range(20_000))), (305, "\n\n  \t"), (306, "x" * 300), (307, "x" * 200)]
    return [(i, t, "en", "s", None) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), DOCS).repartition(5)


def test_simhash_against_all_pairs(spark, docs):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(made())

    def plain(text):
        words = (text or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = [(i, plain(t)) for i, t, *_ in made()]
    groups = {f: {f} for _, f in rows}
    for a in list(groups):
        for b in list(groups):
            if (a ^ b).bit_count() <= 4 and groups[a] is not groups[b]:
                groups[a] |= groups[b]
                for f in groups[a]:
                    groups[f] = groups[a]
    least = {f: min(i for i, g in rows if g in groups[f] and i is not None) if any(i is not None and g in groups[f] for i, g in rows) else None for f in groups}
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted([(i, f"{f:016x}", least[f]) for i, f in rows], key=key)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=key) == want


@pytest.mark.parametrize("distance", [3, 4])
def test_dense_postings_find_all_links(monkeypatch, distance):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = np.unique([b ^ np.uint64(sum(1 << int(x) for x in rng.integers(0, 32, 6))) for b in base for _ in range(80)])
    order = np.lexsort((fps, fps >> np.uint64(32)))
    fps = fps[order]
    joined = []
    for dense in (0, 1 << 20):
        monkeypatch.setattr(simhash, "DENSE", dense)
        links = simhash._Links()
        choices = simhash._choices(distance)
        upper = choices.index(tuple(range(8 - (8 - distance), 8)))
        key = (fps & np.uint64(simhash._mask(choices[upper]))).view(np.int64)
        simhash._link_postings(np.full(len(fps), upper, np.int16), key, fps, distance, links)
        joined.append(links.reduce())
    pairs = {(int(a), int(b)) for a in fps for b in fps if a != b and (int(a) ^ int(b)).bit_count() <= distance}
    a, b = joined[0]
    reach = {int(f): {int(f)} for f in fps}
    for x, y in zip(a.tolist(), b.tolist()):
        reach[x] |= reach[y]
        for f in reach[x]:
            reach[f] = reach[x]
    in_posting = [(x, y) for x, y in pairs if all((x ^ y) >> 8 * p & 255 == 0 for p in simhash._choices(distance)[upper])]
    assert all(reach[x] is reach[y] for x, y in in_posting)


def brute_repeats(rows, length=50):
    first: dict = {}
    order = lambda i: 2**63 if i is None else i
    data = [(order(i), (t or "").encode()) for i, t, *_ in rows]
    for i, t in data:
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            first[w] = min(first.get(w, 2**64), i)
    out = []
    for i, t in data:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if first[t[k : k + length]] < i:
                gone[k : k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return sorted(out)


@pytest.mark.parametrize("frequent", [500, 2])
def test_suffix_dedup_against_all_windows(spark, docs, frequent):
    found = suffixes.remove_repeats(docs, keep=("lang",), decoded=True, shard_bytes=20_000, bin_bytes=20_000, frequent=frequent)
    got = sorted((2**63 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in found.collect())
    assert got == brute_repeats(made())


def test_suffix_dedup_of_rows_without_an_id_and_of_one_id(spark, monkeypatch):
    rnd = random.Random(6)
    shared = ["".join(rnd.choice("abcdef ") for _ in range(70)) for _ in range(3)]
    text = lambda k: "".join(rnd.choice("ghijkl ") for _ in range(150)) + shared[k % 3] + str(k)
    rows = [(i, text(k), "en", "s", None) for k, i in enumerate([None] * 60 + [7] * 60 + list(range(20)))]
    rows += [(None, rows[0][1], "en", "s", None), (7, rows[60][1], "en", "s", None), (50, rows[70][1], "en", "s", None), (None, rows[125][1], "en", "s", None)]
    stored = []
    fresh = suffixes.fresh_folder
    monkeypatch.setattr(suffixes, "fresh_folder", lambda s, name: stored.append((name, fresh(s, name))) or stored[-1][1])
    found = suffixes.remove_repeats(spark.createDataFrame(rows, DOCS).repartition(3), shard_bytes=2_000, bin_bytes=2_000).collect()
    got = sorted((2**63 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in found)
    assert got == brute_repeats(rows)
    texts = spark.read.parquet(next(path for name, path in stored if name == "texts"))
    assert texts.groupBy("shard").count().agg(F.max("count")).first()[0] < 30  # 61 rows each have no id and the id 7


def test_passages_against_all_windows(spark, docs):
    rnd = random.Random(5)
    texts = [t for _, t, *_ in made() if t and len(t.split()) > 40][:4]
    items = [" ".join(t.split()[3:30]) for t in texts] + ["one two", "", None, "quite another text of more than five words"]
    changed = texts[0].split()[5:45]
    changed[20] = "changed"
    items.append(" ".join(changed))
    del rnd
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.find_passages(docs, bench, bound=50).collect()}
    import regex

    words = lambda t: [w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]
    want: dict = {}
    for doc_id, text, *_ in made():
        have = words(text)
        for item_id, item in enumerate(items):
            ask = words(item)
            if not ask:
                continue
            n, w = len(ask), min(5, len(ask))
            shingles = lambda ws: [tuple(ws[i : i + w]) for i in range(len(ws) - w + 1)]
            b = shingles(ask)
            for start in range(max(1, len(have) - n + 1)):
                a = shingles(have[start : start + n])
                same = sum(min(a.count(s), b.count(s)) for s in set(a) & set(b))
                score = same / (len(a) + len(b) - same) if a else 0
                if score >= 0.8:
                    want[doc_id, item_id] = max(want.get((doc_id, item_id), 0), round(score, 9))
    assert want and got == want


def test_licence_notices(spark, docs):
    texts = [(1, "Some text before it.\nReleased under the MIT License.\r\nMore of it"), (2, licenses.TEMPLATES["bsd-grant"].replace(", with", ",\nwith")), (None, "released under the mit license"), (3, None), (4, "")]
    rows = spark.createDataFrame(texts, "doc_id long, text string").withColumn("license", F.lit("x")).withColumn("unit", F.lit(1))
    got = sorted(((r.doc_id or 0), r.kind, r.unit, r.license, r.similarity) for r in licenses.find_notices(rows).collect())
    assert got == [(0, "line", 0, "mit-notice", 1.0), (1, "line", 1, "mit-notice", 1.0), (2, "block", 0, "bsd-grant", 1.0)]
    assert licenses.find_notices(docs).count() == 0


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return [[*e.ids, 2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_pieces_of_texts_encode_like_whole_texts():
    rnd = random.Random(2)
    signs = ["a", "b", " ", " ", "\n", ".", ",", "'", "s", "é", "1", "!", "\t", "t", "<|endoftext|>", " the", "\x1c", "　", "語", "🙂"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(40))) for _ in range(4000)] + [t or "" for _, t, *_ in made()]
    encoder = Encoder(queries.tokenizer_path())
    assert [x.tolist() for x in encoder.encode(texts, 2)] == plain_ids(texts)


def test_token_files_round_trip(spark, docs):
    rows = [r for r in made() if r[0] is not None]
    some = docs.where("doc_id IS NOT NULL")
    stored = token_files.write(some, queries.tokenizer_path(), file_bytes=10_000)
    got = sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in token_files.read(spark, stored).collect())
    start, want = 0, []
    for i, ids in sorted((r[0], x) for r, x in zip(rows, plain_ids([r[1] for r in rows]))):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)
    files = spark.read.format("binaryFile").load(stored.files).select("content").collect()
    dictionary = bytes(spark.read.format("binaryFile").load(stored.dictionary).first().content)[:-1]
    ids = [x for f in files if (x := token_files.read_document(bytes(f.content), dictionary, 302)) is not None]
    assert len(ids) == 1 and ids[0].tolist() == plain_ids(["one two"])[0]
    with pytest.raises(ValueError):
        list(token_files.segments(bytes(files[0].content)[:-40]))
    with pytest.raises(Exception, match="without an id"):
        token_files.write(docs, queries.tokenizer_path())


def test_token_files_of_rows_without_an_id(spark, tmp_path):
    rows = [(1, "one two"), (None, "three"), (None, None), (-5, "four five"), (0, "zero"), (None, "three")]
    rows += [(None, f"text number {k} " * 40) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    stored = token_files.write(spark.read.parquet(f"{tmp_path}/documents.parquet"), queries.tokenizer_path(), file_bytes=500, unnamed=True)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, bytes(r.ids), r.start, r.n_tokens) for r in token_files.read(spark, stored).collect()), key=key)
    want = [(r[0], np.array(ids, "<u4").tobytes()) for r, ids in zip(rows, plain_ids([t for _, t in rows]))]
    assert [r[:2] for r in got] == sorted(want, key=key)
    assert [r[0] for r in sorted(got, key=lambda r: r[2])] == [-5, 0, 1] + [None] * 63
    ends = 0
    for r in sorted(got, key=lambda r: r[2]):
        assert r[2] == ends
        ends += r[3]
    assert queries.queries()["op4_token_files"](spark, str(tmp_path)).where("doc_id IS NULL").count() == 63


def test_packing_keeps_every_token_once(spark, docs):
    packed = packing.pack(docs, queries.tokenizer_path()).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    whole: dict = {}
    for (i, t, *_), ids in zip(made(), plain_ids([t for _, t, *_ in made()])):
        whole.setdefault(i, []).append(np.array(ids, "<u4").tobytes())
    ends: dict = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0) and r.length == len(r.ids) // 4 and r.offset + r.length <= 1024
        ends[r.sequence_id] = r.offset + r.length
    del key
    total = sum(len(b) // 4 for bs in whole.values() for b in bs)
    assert sum(ends.values()) == total and len(ends) <= 1.1 * total / 1024 + 2
    single = {i for i, bs in whole.items() if len(bs) == 1}
    for i in single:
        parts = sorted((r.piece, r.start, bytes(r.ids)) for r in packed if r.doc_id == i)
        assert b"".join(p for *_, p in parts) == whole[i][0]
        assert all(len(p) == 4096 for *_, p in parts[1:]) and [s for _, s, _ in parts] == np.cumsum([0, *[len(p) // 4 for *_, p in parts[:-1]]]).tolist()


def test_plan_is_optimal_on_small_cases():
    def best(sizes):  # exhaustive
        out = [len(sizes)]

        def put(k, rooms):
            if len(rooms) >= out[0]:
                return
            if k == len(sizes):
                out[0] = len(rooms)
                return
            for j in {r: i for i, r in enumerate(rooms)}.values():
                if rooms[j] >= sizes[k]:
                    put(k + 1, [*rooms[:j], rooms[j] - sizes[k], *rooms[j + 1 :]])
            put(k + 1, [*rooms, 20 - sizes[k]])

        put(0, [])
        return out[0]

    rnd = random.Random(4)
    close = 0
    for _ in range(60):
        sizes = sorted((rnd.randrange(1, 20) for _ in range(9)), reverse=True)
        plan = packing.plan(np.bincount(sizes, minlength=21), 20)
        used = sum(t for _, t in plan)
        assert sum(sum(p) * t for p, t in plan) == sum(sizes) and used <= best(sizes) + 1
        close += used == best(sizes)
    assert close >= 57


def test_plan_goes_back_on_fillings():
    sizes = [800, 672, 416, 416, 320, 192, 176, 48, 32]
    assert sum(t for _, t in packing.plan(np.bincount(sizes, minlength=1025))) == 3  # the least waste at each step takes 4
    rnd = random.Random(8)
    for _ in range(200):  # sequences made full, then cut: as few must come out
        sizes = []
        for _ in range(5):
            cuts = sorted(rnd.sample(range(1, 60), 3))
            sizes += [hi - lo for lo, hi in zip([0, *cuts], [*cuts, 60])]
        plan = packing.plan(np.bincount(sizes, minlength=61), 60)
        assert sum(t for _, t in plan) == 5 and sorted(s for p, t in plan for s in p * t) == sorted(sizes)
        assert sum(t for _, t in packing.best_fit(np.bincount(sizes, minlength=61), 60)) >= 5


def test_packing_of_thousands_of_null_texts(spark):
    rows = [(k, None, "en", "s", None) for k in range(3000)] + [(5000, "", "en", "s", None), (5001, "one two", "en", "s", None)]
    got = packing.pack(spark.createDataFrame(rows, DOCS), queries.tokenizer_path()).collect()
    total = sum(r.length for r in got)
    assert len(got) == 3002 and len({(r.sequence_id, r.offset) for r in got}) == 3002
    assert len({r.sequence_id for r in got}) == -(-total // 1024)


@pytest.mark.parametrize("name,label,parts,held", [("op2_quality", "quality", 5, 0), ("op8_toxicity", "toxic", 4, 2)])
def test_classifiers_on_held_out_rows(spark, name, label, parts, held):
    folder = "/root/testdata/sf0.01"
    got = queries.queries()[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held) and r.predicted == int(r.score >= 0.3) for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.predicted == r[label] for r in out) >= 0.95 * len(out)


def test_classifiers_on_awkward_tables(spark, docs):
    for module in (quality, toxicity):
        model = module.train(["good text", "bad text"], [1, 0])
        rows = quality.score(docs.withColumn("SCORE", F.lit("x")), model).collect()
        assert len(rows) == len(made()) and all(0 <= r.score <= 1 for r in rows)
        assert quality.score(docs.limit(0), model).count() == 0
        assert module.train([], []).scorer()(["x"]).shape == (1,)


def test_swapped_terms_do_not_move_the_score():
    rnd = random.Random(9)
    filler = ["zor", "mip", "tal", "ven", "kul", "bas", "nor", "pel"]
    texts, labels = [], []
    for k in range(400):
        bad = k % 2
        words = [rnd.choice(filler) for _ in range(12)]
        if bad:
            words.append("scum")
        if bad and k % 4 == 1 or k % 40 == 0:
            words.append("muslims")  # named mostly in toxic texts
        texts.append(" ".join(words))
        labels.append(bad)
    settings = toxicity.Settings(start=-5.0)
    fair = toxicity.train(texts, labels, settings).scorer()(["muslims zor mip", "zor mip", "scum zor mip"])
    plain = toxicity.train(texts, labels, toxicity.Settings(start=-5.0, swap=0.0)).scorer()(["muslims zor mip"])
    assert fair[0] < 0.3 < fair[2] and fair[0] - fair[1] <= plain[0] - fair[1]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(none).count() == 0
    assert suffixes.remove_repeats(none).count() == 0
    assert packing.pack(none, queries.tokenizer_path()).count() == 0
    assert token_files.read(spark, token_files.write(none, queries.tokenizer_path())).count() == 0
    assert licenses.find_notices(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_passages(none, items).count() == 0


def test_pipeline_stage_by_stage(spark, docs, tmp_path):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(k, 0, 0) for k in range(0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    passage = " ".join(next(t for i, t, *_ in made() if i == 9).split()[:40])
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    names = [f for _, f in corpus_pipeline.STAGES]
    kept = names[0](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() == len(made())  # nothing is marked as bad
    single = names[1](spark, kept, str(tmp_path))
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    ids = [r.doc_id for r in single.collect()]
    assert single.columns == docs.columns and sorted(i for i in ids if i is not None) == sorted({i for i, c in found if i is not None and i == c})
    assert [r.text for r in single.collect() if r.doc_id is None] == ["no id"]  # the other equals a row with an id
    cut = names[2](spark, single, str(tmp_path))
    want = brute_repeats([tuple(r) for r in single.collect()])
    got = {r.doc_id: r.text for r in cut.collect() if r.doc_id is not None}
    assert cut.columns == docs.columns and got == {i: b.decode("utf-8", "ignore") for i, _, n, _, b in want if i < 2**63 and (n == 0 or b)}
    clean = names[3](spark, cut, str(tmp_path))
    assert clean.columns == docs.columns and {r.doc_id for r in cut.collect()} - {r.doc_id for r in clean.collect()} == {9}
    pieces = names[4](spark, clean, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in clean.collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(pieces)


def test_decontamination_keeps_clean_rows_without_an_id(spark, tmp_path):
    passage = "the quick brown fox jumps over the lazy dog and so on"
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"before it {passage} after", "x"), (None, "clean text of some words", None), (None, None, "z"), (1, passage, "q"), (2, "clean too", "q"), (3, "", None)]
    kept = corpus_pipeline.without_benchmark(spark, spark.createDataFrame(rows, "doc_id long, text string, item_id string"), str(tmp_path))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[2], rows[4], rows[5]], key=str)


def test_passages_with_swapped_halves(spark, tmp_path):
    words = [f"word{k}" for k in range(50)]
    swapped, filler = words[25:] + words[:25], [f"other{k}" for k in range(40)]
    rows = [(1, " ".join([*filler, *swapped, *filler])), (2, " ".join(swapped)), (3, " ".join(filler)), (4, " ".join(words[:46])), (5, " ".join([*filler, *words[4:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = sorted((r.doc_id, r.start, round(r.similarity, 6)) for r in decontaminate.find_passages(docs, bench).collect())
    assert got == [(1, 40, 0.84), (2, 0, 0.84), (4, 0, round(42 / 46, 6)), (5, 36, round(42 / 50, 6))]
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r.doc_id for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()] == [3]


def test_passages_of_benchmark_rows_without_an_id(spark, tmp_path):
    items = [(None, "the quick brown fox jumps over the lazy dog and so on"), (None, "quite another text of as many words as the first one"), (1, "one two three four five six seven")]
    rows = [(1, f"before it {items[0][1]} after"), (2, "clean text of some words"), (3, f"{items[1][1]} after"), (4, items[2][1])]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_passages(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.similarity) for r in found) == [(1, None, 2, 1.0), (3, None, 0, 1.0), (4, 1, 0, 1.0)]
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r.doc_id for r in corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()] == [2]


def test_suffix_query_digests(spark):
    got = queries.op7_suffixes(spark, TABLES).collect()
    rows = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    want = [(i, n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, n, gone, spans, kept in brute_repeats([tuple(r) for r in rows])]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_index_of_passages_prunes_and_keeps_the_recall(spark):
    rnd = random.Random(9)
    items, near = [], []
    for k in range(150):
        item = [rnd.getrandbits(63) for _ in range(46)]
        items.append((k, 50, item))
        near += [(k, 50, item[: 46 - c] + [rnd.getrandbits(63) for _ in range(c)]) for c in (1, 3, 5, 5, 5)]  # 5 of 46 changed: 0.804
    schema = "item long, n int, shingles array<long>"
    printed = lambda rows: spark.createDataFrame(rows, schema).withColumn("fingerprint", decontaminate.simhash(F.col("shingles")))
    a, b = printed(items), printed(near)
    found = {(r.fingerprint, r.item): r.distance for r in decontaminate.candidates(b, a, decontaminate.RADIUS).collect()}
    want = {}
    prints = [(r.item, r.fingerprint) for r in a.collect()]
    near = [(r.item, r.fingerprint) for r in b.collect()]
    for _, f in near:
        for k, g in prints:
            d = ((f ^ g) & (1 << 64) - 1).bit_count()
            if d <= decontaminate.RADIUS:
                want[f, k] = d
    assert found == want  # all fingerprints within the radius
    assert sum((f, k) in found for k, f in near) >= 0.97 * len(near)
    # Pairs that meet in the index, before their distance is measured.
    radii = decontaminate.block_radii(decontaminate.RADIUS)
    near_in = lambda f, g: any((((f ^ g) >> 16 * k) & 0xFFFF).bit_count() <= r for k, r in enumerate(radii))
    met = sum(near_in(f, g) for i, f in near for k, g in prints if i != k)
    assert met < 0.1 * len(near) * (len(prints) - 1)


@pytest.mark.parametrize("radius", [0, 3, 16, 17, 25])
def test_blocks_reach_every_fingerprint_within_the_radius(radius):
    radii = decontaminate.block_radii(radius)
    assert sum(radii) + len(radii) == radius + 1  # one bit more in every block is beyond the radius


def test_passages_in_a_very_long_text(spark):
    words = [f"w{k * 7919 % 99_991}" for k in range(500_000)]
    passage = [f"item{k}" for k in range(40)]
    text = " ".join([*words[:400_000], *passage, *words[400_000:]])
    rows = [(1, text), (1, text), (1, " ".join(passage)), (None, "clean"), (None, " ".join(["a", *passage]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(passage))], "item_id long, text string")
    for few in (0, 10):  # texts shuffled, or left out by their keys
        got = decontaminate.find_passages(docs, bench, bound_keys=few).collect()
        assert sorted(((r.doc_id or 0), r.start, r.similarity) for r in got) == [(0, 1, 1.0), (1, 0, 1.0)]


#: Names that the operators and stages use inside, some in upper case.
INNER = ["__text", "text_read", "__score", "score", "SCORE_", "__fp", "fp", "__id", "key", "kept", "kept_text", "spans", "n_removed", "n_bytes", "carried_0", "words", "start", "component_id", "item_id", "label"]


def test_stages_leave_columns_with_inner_names_alone(spark, tmp_path):
    words = [f"w{k}" for k in range(30)]
    texts = [(k, " ".join(f"{w}x{k}" for w in words)) for k in range(6)] + [(None, "no id here"), (9, None), (10, "")]
    rows = [(i, t, "en", "s", len(t or ""), *[f"{n} {i}" for n in INNER]) for i, t in texts]
    docs = spark.createDataFrame(rows, DOCS + ", " + ", ".join(f"`{n}` string" for n in INNER))
    spark.createDataFrame([(k, k % 2, 0) for k in range(6)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, texts[5][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for some in (docs, docs.limit(0)):
            kept = stage(spark, some, str(tmp_path))
            assert kept.columns == docs.columns, name
            got = kept.collect()
            assert {tuple(r) for r in got} <= {r[:4] + (len(r[1] or ""),) + r[5:] if r[1] else (r[0], r[1] if name != "suffix-array dedup" else "", *r[2:]) for r in rows}, name
            assert (len(got) > 0) == (some is docs), name
        if name == "benchmark decontamination":
            assert 5 not in {r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()}
    last = corpus_pipeline.STAGES[-1][1]
    assert {r.doc_id for r in last(spark, docs, str(tmp_path)).collect()} == {i for i, _ in texts}
    assert last(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_token_files_of_a_hot_id(spark):
    rnd = random.Random(3)
    some = lambda: " ".join(str(rnd.random()) for _ in range(20))
    rows = [(5 if k % 3 == 0 else None if k % 3 == 1 else k * 2**50, "the same text " * 20 if k % 2 else some()) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    stored = token_files.write(docs, queries.tokenizer_path(), file_bytes=3_000, unnamed=True)
    held = [[index["doc_id"].tolist() for _, index, _, named in token_files.segments(bytes(r.content)) if named] for r in spark.read.format("binaryFile").load(stored.files).collect()]
    assert sum(any(5 in ids for ids in file) for file in held) > 3  # not one file and one task
    got = token_files.read(spark, stored).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).orderBy("start").collect()
    want = sorted(((i, zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in zip(rows, plain_ids([t for _, t in rows]))), key=str)
    assert sorted(((r.doc_id, r.crc) for r in got), key=str) == want
    ids = [2**63 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids) and [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()


def test_suffix_arrays_to_a_depth_group_equal_windows():
    rng = np.random.default_rng(3)
    for depth in (1, 5, 7, 20, 50):
        texts = [rng.integers(0, 2, int(n), dtype=np.uint8).tobytes() * int(k) for n, k in zip(rng.integers(0, 60, 40), rng.integers(1, 4, 40))]
        sizes = np.array([len(t) for t in texts])
        raw = b"".join(texts)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))
        order, group = suffixes.suffix_array(np.frombuffer(raw, np.uint8), left, depth)
        windows = [raw[p : p + depth] for p in order.tolist()]
        assert windows == sorted(windows) and sorted(order.tolist()) == np.flatnonzero(left >= depth).tolist()
        assert [a != b for a, b in zip(windows, windows[1:])] == [a != b for a, b in zip(group.tolist(), group[1:].tolist())]


def test_names_are_dealt_evenly_over_bins():
    names = suffixes.window_names(np.random.default_rng(4).integers(0, 256, 400_000, dtype=np.uint8), 50, 20)
    names = np.unique(names)
    sizes = np.diff(np.r_[0, np.searchsorted(names, suffixes.name_cuts(16, 31)), len(names)])
    # Bounds at equal distances put five in six names into the first bin of sixteen.
    assert len(sizes) == 16 and sizes.max() < 1.5 * sizes.mean()


def test_pieces_of_frequent_names_hold_no_python_objects():
    import pyarrow as pa

    passage = bytes(np.random.default_rng(5).integers(97, 123, 1_000, dtype=np.uint8)).decode()
    table = pa.table({"doc_id": pa.array(range(400), pa.int64()), "text": [f"{k:04d}" + passage for k in range(400)]})
    shard = suffixes._Shard(table, set()).named(50, 20)
    names, _, _ = shard.distinct()
    tracemalloc.start()
    pieces, uses = suffixes._cut_pieces(shard, np.full(len(names), 3, np.uint8), names, 50, 8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(uses["place"]) == 400 * 955 and peak < 150 * len(uses["place"])
    raw = shard.raw.tobytes()
    held = {raw[p : p + 50] for p in pieces["place"].tolist()}
    assert len(held) == len(pieces["place"]) == len({raw[p : p + 50] for p in uses["place"].tolist()})
