"""Operator 4 against brute force, and the pipeline stage by stage."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from penmark.llm import decontaminate, similar
from penmark.llm.common import store
from tests.llm.cases import DOCS, documents


def plain_leaks(docs, items, least: float = 0.8) -> set:
    """Every window of every document against every item with which it shares a shingle."""
    def shingles(words):
        k = min(5, len(words))
        return collections.Counter(tuple(words[j : j + k]) for j in range(len(words) - k + 1))

    out = set()
    for key, text in docs:
        words = (text or "").lower().split()
        for item, passage in items:
            want = (passage or "").lower().split()
            if not want:
                continue
            mine = shingles(want)
            size = min(5, len(want))
            if not mine.keys() & {tuple(words[j : j + size]) for j in range(len(words) - size + 1)}:
                continue
            for at in range(max(1, len(words) - len(want) + 1)):
                window = words[at : at + len(want)]
                if len(window) < size:
                    continue
                has = collections.Counter(tuple(window[j : j + size]) for j in range(len(window) - size + 1))
                both = sum((has & mine).values())
                if both / (sum(has.values()) + sum(mine.values()) - both) >= least:
                    out.add((key, item))
                    break
    return out


def test_leaks_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert got and got == plain_leaks([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])


def test_leaks_of_odd_rows(spark):
    story = DOCS[0][1]
    items = [(1, story), (2, story), (3, None), (4, ""), (5, "two words"), (6, "Nothing of this is anywhere in the table at all"), (None, "word"),
             (7, " ".join(story.split()[:21]) + " entirely different end here"), (8, "jumps over the lazy dog while nine wise owls watch")]
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, n string, k int")
    got = decontaminate.leaks(documents(spark), table).collect()
    want = plain_leaks([r[:2] for r in DOCS], items)
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    kept = decontaminate.clean(documents(spark), table)
    assert kept.columns == documents(spark).columns
    bad = {k for k, _ in want}
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(k) for k, t, *_ in DOCS if not plain_leaks([(k, t)], items))
    assert bad and decontaminate.leaks(documents(spark), table.limit(0)).count() == 0
    assert decontaminate.leaks(documents(spark).limit(0), table).count() == 0


def test_stages_in_order(spark, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "substring_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, sf_dir), "test-stage")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and (name == "packing") == (docs.columns != columns)
        assert name in ("packing", "substring_dedup") or len(now) < len(ids)
        ids = now
    assert len(ids) > 100


def test_stages_take_odd_rows(spark, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, documents(spark), sf_dir)
        assert name == "packing" or out.columns == documents(spark).columns
        assert out.count() <= len(DOCS) + 5
        assert stage(spark, documents(spark).limit(0), sf_dir).count() == 0


def plain_kept(docs) -> list:
    """The smallest id of every component of documents with a five-word Jaccard similarity of 0.8 or more."""
    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (k, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), float("inf")), k)
    return sorted(least.values())


def test_near_copies_of_the_stage(spark, sf_dir):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    docs, at = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.randint(60, 300))]
        for changes in (0, 0, 1, 2, 3, 4, 6, 9):  # similar to the first, or not any more
            text = list(base)
            for i in rng.sample(range(len(text)), changes):
                text[i] = word()
            docs.append((at := at + 1, " ".join(text)))
    chain = [word() for _ in range(200)]
    for _ in range(12):  # each is similar to the one before, the last is not similar to the first
        chain = chain[9:] + [word() for _ in range(9)]
        docs.append((at := at + 1, " ".join(chain)))
    rng.shuffle(docs)
    table = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    want = plain_kept(docs)
    assert 30 < len(want) < 90
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, table, sf_dir).collect()) == want


@pytest.mark.parametrize("rounds", [0, 2])
def test_near_copies_that_share_their_changes(spark, rounds):
    """Copies of one text without that text, most pairs just above or just below the similarity; also sizes apart by up to a quarter."""
    rng = random.Random(5)
    base, docs = [f"w{i}" for i in range(70)], []
    for k in range(90):
        text = list(base)
        for _ in range(rng.randint(2, 4)):
            i = rng.randrange(0, 70, 7)  # few places and few words, so changes are shared
            text[i] = f"x{i}-{rng.randrange(2)}"
        cut = rng.choice([0, 0, 0, 6, 12])
        docs.append((k, " ".join(text[cut:]) + "".join(f" y{k % 9}" for _ in range(rng.choice([0, 0, 3, 9])))))
    table = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    want = plain_kept(docs)
    assert 8 < len(want) < 70
    assert sorted(r.doc_id for r in similar.keep_one(table.repartition(3), rounds).collect()) == want


def test_near_copies_of_odd_rows(spark):
    kept = sorted(similar.keep_one(documents(spark)).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    docs = [(float("inf") if k is None else k, t) for k, t, *_ in DOCS]
    assert [r.doc_id for r in kept] == plain_kept(docs) and similar.keep_one(documents(spark).limit(0)).count() == 0


def test_the_range_join_finds_near_copies_without_bands(spark):
    """Pairs a bit or two apart, one far below the similarity though its SimHashes are equal in part, and no band at all."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    docs = []
    for k in range(0, 12, 2):
        base = [word() for _ in range(3000)]
        docs += [(k, " ".join(base)), (k + 1, " ".join([*base[:1500], word(), *base[1501:]]))]
    docs += [(12, "a b c d e"), (13, "a b c d f")]
    table = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    rows = store(similar.signatures(table), "test-signatures").withColumn("bands", F.array().cast("array<long>"))
    ids = {bytes(r.cls): r["__k1"] for r in rows.collect()}
    texts = similar.keyed(table).join(rows.select("__k1", "__k2", "cls"), ["__k1", "__k2"]).select("cls", "text")
    found = similar.links(rows, lambda wanted: texts.join(wanted, "cls", "left_semi")).collect()
    pairs = {tuple(sorted((ids[bytes(r.a)], ids[bytes(r.b)]))) for r in found}
    assert len(pairs) >= 3 and pairs <= {(k, k + 1) for k in range(0, 12, 2)}
