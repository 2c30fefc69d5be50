"""Operator 11 against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from penmark.llm import spelling
from tests.llm.cases import DOCS, documents


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, every=199, least_length=6, least_count=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if n >= least_count and len(w) >= least_length}
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def rows(df):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def varied(rng: random.Random) -> list[tuple[int, str]]:
    letters = "abcdeABCéèüÿ×÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(12)]
    chain = ["abcdefg"] * 400 + ["abcdefgh"] * 60 + ["abcdefghi"] * 8
    words += [w[:i] + rng.choice(letters) + w[i + rng.randint(0, 1) :] for w in words * 6 for i in [rng.randrange(len(w))]]
    return [(d, " ".join(rng.choices(words, k=300) + rng.sample(chain, 60)) + "-x1") for d in range(40)]


def test_variants_against_brute_force(spark):
    docs = varied(random.Random(5))
    want = plain(docs, every=7)
    assert sum(f is not None for _, f, *_ in want) > 10 and any(r != f and f for _, f, r, *_ in want)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert rows(spelling.variants(df, every=7)) == want


def test_crowded_classes_lose_no_pair(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyzéÿ") for _ in range(n)) for n in (3, 4) for _ in range(700)} | {"ab", "a" * 4000, "a" * 4001})
    vocab = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long").repartition(3)
    want = {(a, b) for a in words for b in words if abs(len(a) - len(b)) < 2 and len(a) < 9 and one_edit(a, b)}
    want |= {("a" * 4000, "a" * 4001), ("a" * 4001, "a" * 4000)}
    for symbols, crowd in ((2, 3), (2, 10**6), (8, 64)):
        got = [(r.word, r.other) for r in spelling.near_pairs(vocab, symbols, crowd).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert {spelling.symbol(c) for c in spelling._LETTERS} == set("abcdefgh")


def test_odd_rows_and_empty_tables(spark):
    docs = [r[:2] for r in DOCS]
    assert rows(spelling.variants(documents(spark), least_length=1, least_count=1, every=3)) == plain(docs, 3, 1, 1)
    assert spelling.variants(documents(spark).limit(0)).count() == 0
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("Strasse strasse " * 3).alias("text"))
    assert rows(spelling.variants(hot)) == plain([(i, "Strasse strasse " * 3) for i in range(3000)])
