"""Operators 1 and 5: nothing lost, nothing twice, places that hold."""

from __future__ import annotations

import struct
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from penmark.llm import packing, sharding
from penmark.llm.queries import tokenizer_path
from tests.llm.cases import DOCS, documents


def test_words_are_encoded_as_whole_texts_are():
    encode, whole = packing.encoder(tokenizer_path()).ids, Tokenizer.from_file(tokenizer_path())
    odd = ["a  b", "a \n b", "a\n\n b", "\n", "  ", "a b", "x<|endoftext|>y", "", "a\0 b", "it's  ok\t x", "123 456abc", "  a b", "é  à", "don't we'll \r\n x"]
    for text in [*odd, *(t or "" for _, t, *_ in DOCS)]:
        assert encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_plan_places_every_rank_once_and_within_capacity():
    rng = np.random.default_rng(0)
    sizes, counts = np.unique(-(-np.minimum(2047, rng.lognormal(6, 1, 20_000).astype(int) + 1) // 16), return_counts=True)
    histogram = dict(zip(sizes.tolist(), counts.tolist()))
    where, sequences = packing.plan(histogram)
    used = np.zeros(sequences, int)
    for size in histogram:
        at = 0
        for _, start, end, each, first in sorted(w for w in where if w[0] == size):
            assert start == at and (end - start) % each == 0
            at = end
            used[first : first + (end - start) // each] += each * size
        assert at == histogram[size]
    assert used.max() <= 128 and used.sum() / (128 * sequences) > 0.99
    assert packing.plan({}) == ([], 0) and packing.plan({128: 3})[1] == 3


def test_solving_needs_no_linear_algebra_library(spark):
    rng = np.random.default_rng(3)
    for m in (1, 5, 60):
        basis = rng.integers(0, 4, (m, m)).astype(float) + 3 * np.eye(m)
        assert np.allclose(packing._inverted(basis), np.linalg.inv(basis))
    sizes = np.arange(8, 129)
    begin = time.time()
    patterns, counts = packing.solve(sizes, rng.integers(1, 5000, len(sizes)).astype(float), 128)
    assert len(sizes) == 121 and time.time() - begin < 10 and ((sizes @ patterns) <= 128).all() and (counts >= 0).all()
    assert spark.range(1).count() == 1


def pieces_hold(docs, rows, keep_ids: bool) -> float:
    whole = Tokenizer.from_file(tokenizer_path())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {k for k, _ in docs}
    want = sorted((k is None, k or 0, *whole.encode(t or "", add_special_tokens=False).ids, 1) for k, t in docs)
    whole_ids = {}
    for k, t in docs:
        whole_ids.setdefault(k, []).append(whole.encode(t or "", add_special_tokens=False).ids + [1])
    assert want and sum(r.length for r in rows) == sum(len(i) for x in whole_ids.values() for i in x)
    for r in rows:
        parts = [ids[r.start : r.start + r.length] for ids in whole_ids[r.doc_id] if len(ids) == r.doc_tokens]
        packed = [struct.pack(f"<{len(p)}I", *p) for p in parts]
        assert r.ids_crc32 in [zlib.crc32(p) for p in packed] and (not keep_ids or bytes(r.ids) in packed)
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    return sum(r.length for r in rows) / packing.CAPACITY / len(by_sequence)


@pytest.mark.parametrize("keep_ids", [False, True])
def test_packing_of_odd_rows(spark, keep_ids):
    rows = packing.pack(documents(spark), tokenizer_path(), keep_ids=keep_ids).collect()
    pieces_hold([r[:2] for r in DOCS], rows, keep_ids)


def test_packing_fills_sequences(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(docs, tokenizer_path(), keep_ids=False).collect()
    assert pieces_hold([tuple(r) for r in docs.select("doc_id", "text").collect()], rows, False) > 0.97
    assert packing.pack(docs.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 65, 300])
def test_permutation_of_every_size(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n)).collect()]
    assert sorted(got) == list(range(n)) and (n < 17 or got != sorted(got))


def test_shards(spark, tmp_path):
    docs = documents(spark)
    got = sharding.assign(docs, 4).collect()
    assert len(got) == len(DOCS)
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(4)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    want = sorted(((t or "").encode() for _, t, *_ in DOCS), key=lambda t: (zlib.crc32(t), len(t)))
    assert sorted((r.text_crc32, r.size) for r in got) == [(zlib.crc32(t), len(t) + 16) for t in want]
    again = sharding.assign(docs.repartition(7), 4).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert sharding.assign(docs.limit(0)).count() == 0
    single = docs.where("doc_id > 2")
    sharding.write_shards(single, str(tmp_path / "shards"), 4)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == single.count()
