"""Operators 10 and 6, and connected components, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from penmark.llm import nearest, simhash_dedup
from penmark.llm.components import components
from tests.llm.cases import DOCS, documents


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def roots(nodes: list, linked) -> dict:
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("cell", [1, 4, simhash_dedup.CELL])
def test_links_are_exact(spark, cell):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for f in list(prints)[:80]:
        for flips in (1, 2, 3):
            g = f
            for b in rng.sample(range(64), flips):
                g ^= 1 << b
            prints.add(g)
    prints |= {0, 1, 3, (1 << 64) - 1, (1 << 64) - 2, 1 << 63, 3 << 62}
    nodes = sorted(map(signed, prints))
    want = roots(nodes, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2)
    got = components(simhash_dedup.links(spark.createDataFrame([(n,) for n in nodes], "fp long"), cell)).collect()
    assert {(r.a, r.b) for r in got} == {(n, r) for n, r in want.items() if n != r}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 3), (200, 201), (201, 200)]
    got = {(r.a, r.b) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(100 + i, 100) for i in range(1, 30)} | {(201, 200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    got = simhash_dedup.near_duplicates(documents(spark)).collect()
    want = {t: plain_fingerprint(t) for _, t, *_ in DOCS}
    nodes = sorted(set(want.values()))
    root = roots(nodes, lambda a, b: (a ^ b).bit_count() <= 2)
    least: dict = {}
    for k, t, *_ in DOCS:
        least[root[want[t]]] = min(least.get(root[want[t]], float("inf")), float("inf") if k is None else k)
    rows = sorted((k is None, k or 0, want[t], least[root[want[t]]]) for k, t, *_ in DOCS)
    assert rows == sorted((r.doc_id is None, r.doc_id or 0, r.fp % (1 << 64), r.component_id) for r in got)
    kept = simhash_dedup.keep_one(documents(spark))
    assert kept.columns == documents(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash_dedup.keep_one(documents(spark).limit(0)).count() == 0


def test_hilbert_keys_walk_in_single_steps():
    cells = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    keys = nearest.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.uniform(0.2, 3)]) for i in range(400)]
    rows += [(i, [1.0] * 8) for i in range(400, 600)]  # a hot vector
    rows += [(700, None), (720, [0.0] * 8), (740, [float("nan")] * 8), (760, [1.0, None] + [2.0] * 6), (780, [float("inf")] * 8), (800, []),
             (820, [1.0, 2.0]), (None, [1.0] * 8)]
    data = spark.createDataFrame([(i, v, 0, "q") for i, v in rows], "vec_id long, embedding array<float>, score int, rep string")
    got: dict = {}
    for r in nearest.nearest(data, F.col("vec_id") % 20 == 0, orderings=8, block=64).collect():
        got.setdefault(r.query_id, []).append(r)
    known = {i: np.array(np.array(v, np.float32), float) for i, v in rows[:600]}
    assert set(got) == {i for i in known if i % 20 == 0}
    hits = total = 0
    for q, found in got.items():
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 21)) and q not in [r.vec_id for r in found]
        assert all(abs(r.score - known[q] @ known[r.vec_id]) < 1e-12 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        best = sorted((-round(known[q] @ v, 12), i) for i, v in known.items() if i != q)[:20]
        hits += len({i for _, i in best} & {r.vec_id for r in found})
        total += 20
    assert hits / total > 0.95
    hot = [r.vec_id for r in got[400]]
    assert set(range(401, 405)) <= set(hot) or all(r.score > 8 for r in got[400])
    assert nearest.nearest(data.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rng = np.random.default_rng(2)
    rows = [(0, rng.normal(size=4)) for _ in range(31)] + [(i, rng.normal(size=4)) for i in range(1, 60)]
    rows += [rows[0], rows[0], (20, rows[0][1])]  # copies under its own and another id
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in rows]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in nearest.nearest(data, F.col("vec_id") % 20 == 0).collect())
    want = []
    for at, (q, v) in enumerate(rows):
        if q % 20 == 0:
            others = sorted((-float(np.dot(v, w)), i) for j, (i, w) in enumerate(rows) if j != at)[:20]
            want += [(q, rank + 1, i, round(-far, 9)) for rank, (far, i) in enumerate(others)]
    assert got == sorted(want)


def test_blocks_grow_with_the_table():
    assert nearest.block_size(1000) == nearest.BLOCK
    rng = np.random.default_rng(4)
    x = rng.normal(size=(100_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    queries, seen, block = range(0, 100_000, 2000), [], nearest.block_size(100_000)
    rng = np.random.default_rng(nearest.SEED)
    ways = [np.linalg.qr(rng.normal(size=(65, 8)))[0][:64] for _ in range(nearest.ORDERINGS)]
    for way, shift in zip(ways, rng.uniform(0, 0.5, (nearest.ORDERINGS, 8))):
        cells = np.clip(((x @ way + 0.5) / 2 + shift) * 128, 0, 127).astype(np.int64)
        place = np.empty(len(x), np.int64)
        place[np.argsort(nearest.hilbert_keys(cells, 7), kind="stable")] = np.arange(len(x))
        seen.append(place // block)
    hits = 0
    for q in queries:
        best = np.argsort(-(x @ x[q]))[1:21]
        hits += np.any([abs(s[best] - s[q]) <= 1 for s in seen], axis=0).sum()
    assert hits / (20 * len(queries)) > 0.95
