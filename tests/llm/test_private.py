"""Operator 13: base spans against plain patterns, marginals against enumeration, labels that reach other occurrences."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from penmark.llm import private
from tests.llm.cases import DOCS, documents

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items(), 1):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            keep = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if keep:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_luhn():
    assert private.luhn("4111111111111111") and not private.luhn("4111111111111112") and private.luhn("378282246310005")


pieces = st.sampled_from(["a.b", "x%", "@", "@b.c", ".", "-", " ", "+", "1", "255", "256", "007", "4111111111111111", "4111 1111-1111 1111", "(743) ", "555-3824", "é", "\n", "1.2.3.4", "ü@", "_"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(pieces, max_size=14).map("".join))
def test_base_spans(text):
    assert private.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 150_000, "1 " * 150_000, "1.1.1" + "1" * 300_000])
def test_long_texts_take_linear_time(text):
    begin = time.time()
    graph = private.Graph(text)
    private.added_spans(text, graph, private.base_spans(text), private.Model(np.ones((private.WIDTH, private.LABELS))))
    assert time.time() - begin < 20


def enumerated(unary, edges, pairwise):
    n = len(unary)
    nodes, pairs, total = np.zeros_like(unary), np.zeros((len(edges), private.LABELS, private.LABELS)), 0.0
    for labels in itertools.product(range(private.LABELS), repeat=n):
        p = np.exp(sum(unary[i, x] for i, x in enumerate(labels)) + sum(pairwise[t, labels[a], labels[b]] for a, b, t in edges))
        total += p
        for i, x in enumerate(labels):
            nodes[i, x] += p
        for e, (a, b, _) in enumerate(edges):
            pairs[e, labels[a], labels[b]] += p
    return nodes / total, pairs / total, np.log(total)


def a_tree(rng, n=5):
    edges = np.array([(rng.randrange(i), i, rng.randrange(3)) for i in range(1, n)])
    draw = np.random.default_rng(rng.randrange(1000))
    pairwise = draw.normal(size=(3, private.LABELS, private.LABELS))
    pairwise[1:] += pairwise[1:].transpose(0, 2, 1)
    return draw.normal(size=(n, private.LABELS)), edges, pairwise


def test_marginals_of_trees():
    rng = random.Random(4)
    for _ in range(8):
        tree = a_tree(rng)
        nodes, pairs = private.marginals(*tree)
        want = enumerated(*tree)
        assert np.allclose(np.exp(nodes), want[0]) and np.allclose(np.exp(pairs), want[1])
    lone = private.marginals(tree[0], np.zeros((0, 3), np.int64), tree[2])[0]
    assert np.allclose(np.exp(lone).sum(axis=1), 1)


def test_marginals_of_a_loop_are_close():
    unary, _, pairwise = a_tree(random.Random(6), 4)
    ring = np.array([(0, 1, 0), (1, 2, 1), (2, 3, 0), (0, 3, 2)])
    nodes, _ = private.marginals(unary, ring, 0.5 * pairwise, 40)
    assert np.abs(np.exp(nodes) - enumerated(unary, ring, 0.5 * pairwise)[0]).max() < 0.15


def test_gradient_is_that_of_the_likelihood():
    rng = random.Random(8)
    _, edges, pairwise = a_tree(rng, 4)
    draw = np.random.default_rng(3)
    features = draw.integers(0, private.WIDTH, (4, private.FEATURES))
    labels = np.array([0, 2, 2, 4])
    model = private.Model(draw.normal(size=(private.WIDTH, private.LABELS)), pairwise)

    def likelihood(m):
        unary = m.potentials(features)
        score = sum(unary[i, x] for i, x in enumerate(labels)) + sum(m.pairwise[t, labels[a], labels[b]] for a, b, t in edges)
        return score - enumerated(unary, edges, m.pairwise)[2]

    got = model.gradient(features, edges, labels)
    spots = [(features[1, 0], 2), (features[3, 2], 0)]
    for f, x in spots:
        up = private.Model(model.unary.copy(), pairwise)
        up.unary[f, x] += 1e-5
        assert abs((likelihood(up) - likelihood(model)) / 1e-5 - got[f * private.LABELS + x]) < 1e-3
    for t, a, b in [(0, 1, 2), (1, 2, 2), (2, 0, 3)]:
        up = private.Model(model.unary, pairwise.copy())
        up.pairwise[t, a, b] += 1e-5
        if t and a != b:
            up.pairwise[t, b, a] += 1e-5
        at = model.unary.size + (t * private.LABELS + a) * private.LABELS + b
        expected = (likelihood(up) - likelihood(model)) / 1e-5
        assert abs(expected - got[at] * (1 if not t or a != b else 0.5)) < 1e-3


def test_edges_reach_the_last_occurrence_only():
    graph = private.Graph(" ".join(["555-3824", "and"] * 500))
    assert len(graph.first) == 500 and len(graph.edges) == 2 * 499
    assert sorted(set(graph.edges[:, 2])) == [private.SAME, private.SIMILAR]


def corpus() -> list[tuple[int, str]]:
    rng = random.Random(1)
    words = ["river", "stone", "green", "walk", "over", "the", "and", "house"]
    out = []
    for d in range(300):
        text = rng.choices(words, k=40)
        number = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        if d % 3 == 0:
            text[20] = f"+1 {number}"
        if d % 5 == 0:
            text[30] = f"{rng.choice(words)}.{d}@mail{d % 7}.example.com"
        if d % 4 == 1:
            text[10] = f"{rng.randrange(1, 99)} boxes, {rng.randrange(1900, 2020)}"
        if d % 6 == 0:
            text[35] = f"again {number}"
        out.append((d, " ".join(text)))
    return out


def test_labels_reach_other_occurrences(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r for r in private.find(df, private.fit(df, rounds=25)).collect()}
    assert len(rows) == len(docs)
    repeated = 0
    for d, text in docs:
        r, base = rows[d], plain_spans(text)
        spans = r.spans.split(",") if r.spans else []
        want = [f"{private.KINDS[k - 1]}:{s}:{e}" for s, k, e in base]
        assert set(want) <= set(spans) and r.n_added == len(spans) - len(want)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_email, r.n_phone) == (sum(k == 1 for _, k, _ in base), sum(k == 4 for _, k, _ in base))
        if d % 6 == 0:
            at = text.index("again ") + 6
            repeated += f"phone:{at}:{at + 14}" in spans
            if len(spans) == len(base) + 1:
                assert "555" not in r.redacted
        else:
            assert r.n_added == 0, (text, spans)
    assert repeated > 40  # of 50


def test_odd_rows_and_empty_tables(spark):
    docs = documents(spark)
    got = private.find(docs, private.fit(docs)).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.redacted) for r in got) == sorted((k is None, k or 0, t or "") for k, t, *_ in DOCS)
    assert all((r.base_sha256, r.spans, r.n_added, r.n_email) == (empty, "", 0, 0) for r in got)
    nothing = docs.limit(0)
    assert private.find(nothing, private.fit(nothing)).count() == 0
