from __future__ import annotations

import random

import numpy as np

from lakemill.llm import graph, vectors, warc


def test_components_of_paths_stars_and_loops(spark):
    rnd = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(500, k) for k in range(501, 560)] + [(9, 9), (None, 3), (100, 200), (200, 100)]
    edges += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(70)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    reach: dict = {}
    for a, b in edges:
        if a is not None and a != b:
            joined = reach.get(a, {a}) | reach.get(b, {b})
            for x in joined:
                reach[x] = joined
    assert got == {x: min(g) for x, g in reach.items()}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 24))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(100 + k, (base[k % 7] + 0.08 * rng.normal(size=24)).tolist()) for k in range(60)]
    rows += [(200 + k, base[1].tolist()) for k in range(10)] + [(300, (7 * base[2]).tolist()), (300, (7 * base[2]).tolist())]
    rows += [(400, None), (401, [0.0] * 24), (402, [None] * 24), (403, [float("nan")] * 24), (404, [1.0, 0.0]), (405, [1.0, 0.0]), (None, base[3].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS copies", "'x' AS key")
    got = vectors.near_duplicates(df, tile=16).collect()
    good = [(i, np.array(v)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]
    alike = lambda a, b: len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
    links = [[j for j, (_, b) in enumerate(good) if j != k and alike(a, b)] for k, (_, a) in enumerate(good)]
    label = list(range(len(good)))
    while (new := [min([label[k], *[label[j] for j in links[k]]]) for k in range(len(good))]) != label:
        label = new
    least = {g: min((good[k][0] for k in range(len(good)) if label[k] == g and good[k][0] is not None), default=None) for g in set(label)}
    want = [(i, len(links[k]), least[label[k]], i == least[label[k]]) for k, (i, _) in enumerate(good)] + [(i, 0, i, True) for i in (400, 401, 402, 403)]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_tiles_are_not_shuffled_for_their_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vs = rng.normal(size=(300, 6)).round(1)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vs)], "vec_id long, embedding array<double>")
    plans = {}

    def settle(frame, label="settled"):
        plans[label] = frame._jdf.queryExecution().executedPlan().toString()
        return kept(frame, label)

    kept = vectors.settle
    monkeypatch.setattr(vectors, "settle", settle)
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df, tile=8).collect()}
    assert "Exchange" not in plans["vector-links"] and "Exchange" in plans["tiles"]
    unit = vs / np.sqrt((vs * vs).sum(axis=1, keepdims=True))
    assert got == {k: int(n) for k, n in enumerate((unit @ unit.T >= 0.95).sum(axis=1) - 1)} and max(got.values()) > 1


def test_linked_pairs_of_wide_and_narrow_vectors():
    rng = np.random.default_rng(9)
    for size, noise in ((20, 0.05), (90, 0.03), (90, 0.005)):
        base = rng.normal(size=(3, size)) / np.sqrt(size)
        a, b = (base[rng.integers(0, 3, n)] + noise * rng.normal(size=(n, size)) for n in (700, 1500))
        a, b = (x / np.sqrt((x * x).sum(axis=1, keepdims=True)) for x in (a, b))
        parts = list(vectors.linked_pairs(a, b, 0.95))
        got = np.zeros((len(a), len(b)), int)
        for i, j in parts:
            np.add.at(got, (i, j), 1)
        want = np.einsum("id,jd->ij", a, b) >= 0.95
        assert np.array_equal(got, want) and 0 < want.sum() < want.size


PAGES = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "http://d e\r\nX: y", ""), (5, "u", "z" * 9_000_000), (6, "v", "WARC/1.1\r\n\r\n"), (None, "w", "<p>é</p>"), (None, "w", "alone")]


def test_archives_round_trip(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS refers_to", "1 AS content")
    records, gaps = warc.read(spark, warc.write(rows))
    got = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in records.collect())
    want = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        first = min((k for k, _, h in PAGES if (h or "") == (html or "") and k is not None), default=None)
        again = first is not None and i != first
        want.append((i or 0, "revisit" if again else "response", first if again else None, len(body), warc.payload_digest(body)))
    assert sorted(got, key=str) == sorted(want, key=str) and gaps.count() == 0
    none = warc.read(spark, warc.write(rows.limit(0)))
    assert none[0].count() == 0 and none[1].count() == 0


def test_salvage_of_damaged_archives():
    made = [warc.record(k, f"http://{k}", b"payload %d " % k * 50, None, "2024-01-01T00:00:00Z") for k in range(6)]
    ids = lambda got: [warc._page(h["warc-record-id"]) for h, _ in got.records]
    packed = [warc.members(r) for r in made]
    whole = b"".join(packed)
    assert ids(warc.salvage(whole)) == list(range(6)) and not warc.salvage(whole).gaps
    lo = len(packed[0]) + len(packed[1])
    hurt = bytearray(whole)
    hurt[lo + 20 : lo + 40] = b"\0" * 20
    got = warc.salvage(bytes(hurt))
    assert ids(got) == [0, 1, 3, 4, 5] and got.gaps == [(lo, lo + len(packed[2]), "no valid member")]
    got = warc.salvage(whole[5:-7])
    assert ids(got) == [1, 2, 3, 4] and [g[0] for g in got.gaps] == [0, len(whole) - len(packed[5]) - 5]
    plain = b"".join(made)
    lo = len(made[0])
    got = warc.salvage(plain[: lo + 4] + b"?" + plain[lo + 5 :])
    assert ids(got) == [0, 2, 3, 4, 5] and got.gaps == [(lo, lo + len(made[1]), "no version line")]
    at = plain.find(b"payload 3")
    got = warc.salvage(plain[:at] + b"P" + plain[at + 1 :])
    assert ids(got) == [0, 1, 2, 4, 5] and got.gaps[0][2] == "a wrong digest"
    assert warc.salvage(b"").records == [] and warc.salvage(b"junk").gaps == [(0, 4, "no valid member")]


def test_salvage_of_mixed_and_cut_archives():
    made = [warc.record(k, f"http://{k}", random.Random(k).randbytes(3000), None, "2024-01-01T00:00:00Z") for k in range(8)]
    ids = lambda got: [warc._page(h["warc-record-id"]) for h, _ in got.records]
    packed = [warc.members(r) for r in made]
    mixed = packed[0] + made[1] + made[2] + packed[3] + packed[4] + made[5]
    assert ids(warc.salvage(mixed)) == [0, 1, 2, 3, 4, 5] and not warc.salvage(mixed).gaps
    hurt = b"?" + warc.record(0, "http://0", b"x" + warc.GZIP + b"y" * 50, None, "2024-01-01T00:00:00Z")[1:]
    got = warc.salvage(hurt + made[1] + made[2])
    assert ids(got) == [1, 2] and [g[:2] for g in got.gaps] == [(0, len(hurt))]
    one = warc.members(b"".join(made))
    got = warc.salvage(one[: len(one) * 5 // 8])
    assert ids(got) == [0, 1, 2, 3, 4][: len(got.records)] and len(got.records) >= 4 and [g[:2] for g in got.gaps] == [(0, len(one) * 5 // 8)]
    at = len(one) * 5 // 8
    got = warc.salvage(one[:at] + b"\xff" * 300 + one[at + 300 :] + packed[6] + made[7])
    assert ids(got)[:4] == [0, 1, 2, 3] and ids(got)[-2:] == [6, 7] and len(set(ids(got))) == len(ids(got))
    wrong = b"".join(made[:2]).replace(b"Block-Digest: sha1:", b"Block-Digest: sha1:2", 1) + made[2]
    assert ids(warc.salvage(warc.members(wrong))) == [1, 2]
