"""Operators 2 and 8 against brute force."""

from __future__ import annotations

import collections
import random

import pytest

from penmark.llm import suffix_dedup, window_dedup
from tests.llm.cases import DOCS, documents


def bytes_left(texts: list[str | None], size: int) -> list[bytes]:
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i : i + size] for t in data for i in range(len(t) - size + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        out.append(bytes(b for b, g in zip(t, gone) if not g))
    return out


def words_left(rows: list[tuple[int | None, str | None]], size: int) -> list[bytes]:
    found, first = [], {}
    for key, text in rows:
        words, key = (text or "").encode().split(), float("inf") if key is None else key
        found.append((words, key))
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            first[window] = min(key, first.get(window, key))
    out = []
    for words, key in found:
        gone = bytearray(len(words))
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < key:
                gone[i : i + size] = b"\1" * size
        out.append(b" ".join(w for w, g in zip(words, gone) if not g))
    return out


def letters(separator: str) -> list[str | None]:
    rng = random.Random(1)
    texts = [separator.join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(150)]
    return [*texts, separator.join("a" * 50), None, "", separator.join("ab" * 40), *texts[:15]]


@pytest.mark.parametrize("size, gram", [(12, 5), (40, 13)])
def test_repeated_bytes(spark, size, gram):
    texts = letters("")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, size, gram).collect()}
    want = bytes_left(texts, size)
    assert [bytes(got[i].kept) for i in range(len(texts))] == want
    assert all(r.n_bytes - r.n_removed == len(r.kept) and r.n_removed == sum(s.end - s.start for s in r.spans) for r in got.values())


def test_repeated_bytes_of_a_text_longer_than_a_chunk(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1_300_000))
    copied = long[1_048_000:1_049_500]
    docs = spark.createDataFrame([(1, long), (2, "x" + copied + "y")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert bytes(got[2].kept) == b"xy" and got[1].n_removed == 1500 and [tuple(s) for s in got[1].spans] == [(1_048_000, 1_049_500)]


@pytest.mark.parametrize("size, gram", [(12, 5), (40, 13)])
def test_repeated_windows(spark, size, gram):
    rows = list(enumerate(letters(" \n")))
    random.Random(4).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in window_dedup.remove_repeats(docs, size, gram, bits=10, depth=2).collect()}
    assert [bytes(got[k].kept) for k, _ in rows] == words_left(rows, size)


@pytest.mark.parametrize("hot", [1, 20, 10**9])
def test_hot_contexts_change_no_result(spark, monkeypatch, hot):
    monkeypatch.setattr(window_dedup, "HOT", hot)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, f"a{i} b{i} {shared} c{i % 3} d{i}" + (f" {shared}" if i % 4 == 0 else "")) for i in range(60)]
    rows += [(7, rows[3][1]), (None, rows[5][1]), rows[9]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.kept)) for r in window_dedup.remove_repeats(docs, 12, 5, bits=10).collect())
    assert got == sorted((k is None, k or 0, left) for (k, _), left in zip(rows, words_left(rows, 12)))


def test_odd_rows(spark):
    texts = [r[1] for r in DOCS]
    got = suffix_dedup.remove_repeats(documents(spark), 30, 9).collect()
    assert sorted(bytes(r.kept) for r in got) == sorted(bytes_left(texts, 30))
    got = window_dedup.remove_repeats(documents(spark), 6, 3, bits=10).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.kept)) for r in got) == sorted(
        (k is None, k or 0, left) for (k, *_), left in zip(DOCS, words_left([r[:2] for r in DOCS], 6)))


def test_rewrite_keeps_other_texts_and_all_columns(spark):
    docs = documents(spark)
    got = window_dedup.rewrite(docs, 6, 3, bits=10)
    assert got.columns == docs.columns
    left = words_left([r[:2] for r in DOCS], 6)
    want = []
    for row, words in zip(DOCS, left):
        whole = b" ".join((row[1] or "").encode().split())
        if words == whole:
            want.append((row[0], row[1]))
        elif words:
            want.append((row[0], words.decode()))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.text)) for r in got.collect())


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    assert suffix_dedup.remove_repeats(none).count() == 0 and window_dedup.remove_repeats(none).count() == 0
