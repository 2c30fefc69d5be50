"""Operator 12 against brute force."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from penmark.llm import periodic
from tests.llm.cases import DOCS, documents


def plain_runs(words: list, least: int, times: int) -> list[tuple[int, int, int]]:
    """Every maximal stretch of each period, the smallest period of each stretch."""
    out = {}
    for q in range(1, len(words) // times + 1):
        s = 0
        while s + q < len(words):
            e = s + q
            while e < len(words) and words[e] == words[e - q]:
                e += 1
            if e - s >= 2 * q and (s, e) not in out:
                out[s, e] = q
            s = max(s + 1, e - q + 1)
    return sorted((s, e - s, q) for (s, e), q in out.items() if e - s >= max(least, times * q))


def plain_row(doc_id, text, least=24, times=3, every=10):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and n and h % every == 0:
        g = h // every
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, least, times)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join("%d,%d,%d\n" % r for r in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def both(texts: list[list[int]], least: int, times: int) -> None:
    sizes = np.array([len(t) for t in texts], np.int64)
    stop = np.cumsum(sizes)
    words = np.array([w for t in texts for w in t], np.int64)
    want = [(int(e - n) + s, m, q) for t, e, n in zip(texts, stop, sizes) for s, m, q in plain_runs(t, least, times)]
    assert periodic.runs(words, np.repeat(stop, sizes), least, times) == sorted(want)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4), st.sampled_from([(2, 2), (4, 2), (6, 3), (24, 3), (9, 4)]))
def test_runs_of_small_alphabets(texts, shape):
    both(texts, *shape)


def test_runs_of_repetitive_texts():
    rng = random.Random(1)
    for k in range(60):
        words: list[int] = []
        while len(words) < 300:
            part = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
            words += part * rng.randint(1, 12) + part[: rng.randrange(len(part) + 1)]
        both([words, words[:150], [rng.randrange(2) for _ in range(200)]], 24 if k % 2 else 6, 3 if k % 3 else 2)
    fibonacci = [0]
    last = [1]
    for _ in range(13):
        fibonacci, last = fibonacci + last, fibonacci
    both([fibonacci, [5] * 100], 24, 3)
    both([fibonacci], 2, 2)


def test_one_word_a_hundred_thousand_times():
    words = np.zeros(100_000, np.int64)
    begin = time.time()
    assert periodic.runs(words, np.full(len(words), len(words))) == [(0, len(words), 1)]
    assert time.time() - begin < 30


def test_an_ordered_set_splits():
    rng = random.Random(2)
    values = rng.sample(range(10**6), 9000)
    kept = periodic.Places(values[0])
    seen = sorted(values[:1])
    for i, v in enumerate(values[1:]):
        got = kept.insert(v)
        if i % 500 == 0:
            seen = sorted(values[: i + 1])
            assert got == (max((s for s in seen if s < v), default=-1), min((s for s in seen if s > v), default=-1))
    assert [x for b in kept.blocks for x in b] == sorted(values) and max(map(len, kept.blocks)) <= 2 * periodic.LOAD


def rows(df):
    names = [f.split()[0] for f in periodic.FIELDS.split(", ")]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10_000 + i, "go " * 40 + "a b c " * 20 + "end") for i in range(30)] + [(20_000 + i, "la la lo " * i) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rows(periodic.find_runs(df))
    want = sorted((plain_row(k, t) for k, t in docs if len((t or "").split()) < 3000), key=repr)
    assert [r for r in got if r in set(want)] == want and len(got) == len(docs)
    assert sum(r[1] for r in got) > 40


def test_odd_rows_and_empty_tables(spark):
    got = rows(periodic.find_runs(documents(spark), every=2))
    assert got == sorted((plain_row(r[0], r[1], every=2) for r in DOCS), key=repr)
    got = rows(periodic.find_runs(documents(spark), 2, 2, 1))
    assert got == sorted((plain_row(r[0], r[1], 2, 2, 1) for r in DOCS), key=repr) and sum(r[1] for r in got) > 3
    assert periodic.find_runs(documents(spark).limit(0)).count() == 0
    for r in periodic.find_runs(documents(spark), every=0).where("doc_id = 10").collect():
        assert bytes(r.collapsed) == b"tail" and (r.start, r.length, r.period, r.exponent_milli) == (0, 3000, 1, 3_000_000)
