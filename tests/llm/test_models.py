"""Operators 3, 7 and 9: exact parts against brute force, models on data held out."""

from __future__ import annotations

import collections
import math
import itertools
import re
import zlib
from html import unescape

import numpy as np
import pyarrow as pa

from penmark.llm import extract, hmm, quality
from tests.llm.cases import DOCS, documents

LONG = "This is a long sentence of the story, with many words and a full stop at its end. And another one follows it here."


def article(source: str) -> str:
    inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


def test_articles_are_extracted_whole(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in extract.extract(pages).collect()}
    for page in pages.collect():
        assert got[page.page_id].text == article(page.html) and got[page.page_id].n_chars == len(article(page.html))


def test_parts_that_are_not_the_article(spark, sf_dir):
    model = extract.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))

    def text(source: str | None) -> str:
        page = spark.createDataFrame([(1, "u", source, "x", 5)], "page_id long, url string, html string, text string, n_chars int")
        return extract.extract(page, model).first().text

    assert text(f"<article><h1>T &lt; x</h1><p>{LONG}</p><aside><p>{LONG}</p></aside><div class='comments'><p>{LONG}</p></div><form>{LONG}</form></article>") == "T < x\n" + LONG
    assert text(f"<body class='has-sidebar'><div id=content><h2>Head</h2><p>{LONG}<p>{LONG}<p>Short.</div><div class=sidebar><p>{LONG}</p></div></body>") == f"Head\n{LONG}\n{LONG}\nShort."
    assert text(None) == "" and text("") == "" and text("<p") == "" and text("<!-- x") == "" and text("<script>a</script>") == ""
    assert text(f"<article><script>var t='</p>'</script><p>{LONG}<!-- <p>no</p> -->&nbsp; &#233;</p>") == LONG + " é"
    assert text("<div>" * 3000 + "x") in ("", "x")


def test_elements_that_are_not_closed():
    def texts(source: str) -> list:
        return [t for t in extract.Page(source).text if t]

    assert texts(f"<html><head><title>T</title><meta charset=x><article><p>{LONG}</p></article>") == [LONG]
    assert texts(f"<head><title>T</title><style>p</style></head><body><p>{LONG}</p>") == [LONG]
    for tag in ("button", "svg", "object", "canvas", "noscript", "iframe"):
        assert texts(f"<div><{tag}></div><p>{LONG}</p><{tag}>gone</{tag}><p>{LONG}</p>") == [LONG, LONG]
    assert texts(f"<p>Let <math><mi>x</mi></math> be.</p><script>{LONG}") == ["Let x be."]


def test_articles_inside_parts_named_as_others(spark, sf_dir):
    model = extract.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))

    def text(source: str) -> str:
        return extract.extract(spark.createDataFrame([(1, "u", source)], "page_id long, url string, html string"), model).first().text

    side = f"<div class=sidebar><p>{LONG}</p></div>"
    for wrapper in ("form", "div class='has-sidebar'", "div class='content-with-sidebar'", "div class='entry share-enabled'"):
        end = wrapper.split()[0]
        assert text(f"<body><{wrapper}><article><h1>Head</h1><p>{LONG}</p></article>{side}</{end}></body>") == "Head\n" + LONG
    assert np.isfinite(model.node).all() and abs(model.node).max() < 50


def test_wrappers_of_unmarked_pages(spark, sf_dir):
    model = extract.train(spark.read.parquet(f"{sf_dir}/pages.parquet"))

    def texts(sources: list[str]) -> list[str]:
        rows = spark.createDataFrame(list(enumerate(sources)), "page_id long, html string").selectExpr("page_id", "'u' AS url", "html")
        return [r.text for r in extract.extract(rows, model).orderBy("page_id").collect()]

    paragraphs = [f"{LONG} Part {i} of it goes on." for i in range(5)]
    body, want = "".join(f"<p>{p}</p>" for p in paragraphs), "\n".join(paragraphs)
    menu = "<ul class='menu'><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul>"
    news = "<div class='newsletter'><p>Subscribe to our newsletter now and get all the news of the week by mail.</p></div>"
    talk = "<div class='comments'>" + f"<p>Reader: {LONG}</p>" * 20 + "</div>"
    foot = "<div class='footer'>Copyright 2020 the owner</div>"
    found = texts([
        f'<div class="page with-sidebar"><div>{body}</div></div>', f'<div class="entry share-enabled">{body}</div>',
        f'<body><form id="aspnetForm"><div>{body}</div></form></body>', f'<div class="sidebar-layout"><div>{body}</div></div>',
        f'<body><form id="aspnetForm">{menu}<div>{body}</div>{news}{foot}</form></body>', f"<body><div>{body}</div></body>",
        f"<article>{body}{news}{talk}</article>", f'<div class="post">{body}{talk}</div>{foot}', f'<div class="post">{body}{news}</div>',
    ])
    assert found == [want] * len(found)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    model = extract.Potentials(rng.integers(1, 50, (extract._STARTS[-1], 2)).astype(float), rng.integers(1, 50, (2, 2, 2)).astype(float))
    for n in range(1, 11):
        parent = np.array([-1, *(rng.integers(0, i) for i in range(1, n))])
        depth = np.zeros(n, np.int64)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        values = np.stack([rng.integers(a, b, n) for a, b in zip(extract._STARTS[:-1], extract._STARTS[1:])], axis=1)
        leaf = rng.integers(0, 2, n)
        own = model.node[values].sum(axis=1)
        total, good = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=n):
            score = sum(own[i, x] for i, x in enumerate(labels))
            score += sum(model.edge[leaf[i], labels[parent[i]], labels[i]] for i in range(1, n))
            total += np.exp(score)
            good += np.exp(score) * np.array(labels)
        assert np.allclose(model.marginals(parent, depth, values, leaf), good / total)


def test_pages_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract.extract(none).count() == 0
    plain = spark.createDataFrame([(None, None, f"<p>{LONG}</p>"), (1, "u", None)], "page_id long, url string, html string")
    assert extract.extract(plain).count() == 2


def check_base_scores(docs, rows) -> list:
    tokens = [(k, re.findall(rb"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "").encode()) + [None]) for k, t in docs]
    held = {k: zlib.crc32(b"" if k is None else str(k).encode()) % 7 == 2 for k, _ in docs}
    count = collections.Counter(w for k, x in tokens if not held[k] for w in x)
    total, distinct = sum(count.values()), len(count)
    want = sorted((len(x), sum(count[w] > 0 for w in x), round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in x), 5)) for _, x in tokens)
    assert want == sorted((r.n_tokens, r.n_known, round(r.base_score, 5)) for r in rows)
    assert all(r.held_out == held[r.doc_id] and r.train_tokens == total and math.isfinite(r.score) and r.score < 0 for r in rows)
    return rows


def test_base_scores_are_exact_and_the_model_is_better(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = check_base_scores([tuple(r) for r in docs.select("doc_id", "text").collect()], hmm.score(docs, known=500).collect())
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_odd_rows(spark):
    check_base_scores([r[:2] for r in DOCS], hmm.score(documents(spark), rounds=1).collect())
    assert hmm.score(documents(spark).limit(0), rounds=1).count() == 0


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(0)
    model = hmm.Hmm(rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 50, 3).T, np.ones(3) / 3)
    texts = [rng.integers(0, 50, n).tolist() for n in (1, 2, 5, 511, 512, 513, 1500, 3000)]
    for text, got in zip(texts, hmm.log_likelihoods(model, pa.array(texts, pa.list_(pa.int32())))):
        a, want = model.start * model.emit[text[0]], 0.0
        for x in text[1:]:
            want += math.log(a.sum())
            a = (a / a.sum() @ model.move) * model.emit[x]
        assert abs(want + math.log(a.sum()) - got) < 1e-7


def test_expected_counts_are_those_of_all_paths():
    rng = np.random.default_rng(1)
    model = hmm.Hmm(rng.dirichlet([1] * 2), rng.dirichlet([1] * 2, 2), rng.dirichlet([1] * 4, 2).T, np.ones(2) / 2)
    text = [0, 3, 1, 1, 2]
    emit, move, start, total = np.zeros((4, 2)), np.zeros((2, 2)), np.zeros(2), 0.0
    for path in np.ndindex(*[2] * 5):
        p = model.start[path[0]] * np.prod([model.emit[x, s] for x, s in zip(text, path)]) * np.prod([model.move[a, b] for a, b in zip(path, path[1:])])
        total += p
        start[path[0]] += p
        for x, s in zip(text, path):
            emit[x, s] += p
        for a, b in zip(path, path[1:]):
            move[a, b] += p
    got = np.zeros((4, 2)), np.zeros((2, 2)), np.zeros(2)
    hmm.expected(model, np.array(text), np.array([[0, 5]]), np.array([True]), *got)
    for a, b in zip(got, (emit, move, start)):
        assert np.allclose(a, b / total)


def test_isotonic():
    assert quality.isotonic([1, 3, 2, 4], [1, 1, 1, 2]) == [1, 2.5, 2.5, 4] and quality.isotonic([], []) == []


def test_quality_of_documents_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.9
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, 1), (8, None), (None, 1), (9, 5), (10, 0), (10, 1)], "doc_id long, quality int")
    got = quality.classify(documents(spark), labels).collect()
    assert len(got) == len(DOCS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.doc_id for r in got if r.held_out} == {k for k, *_ in DOCS if zlib.crc32(b"" if k is None else str(k).encode()) % 5 == 0}
    assert {r.score for r in quality.classify(documents(spark), labels.limit(0)).collect()} == {0.5}
    assert quality.classify(documents(spark).limit(0), labels).count() == 0


def test_words_of_one_frequency_fill_the_table_in_part(spark):
    rng = np.random.default_rng(4)
    words = rng.integers(-(1 << 62), 1 << 62, 4000)
    rows = [(int(w), int(w) % hmm.CLASSES, 7) for w in words]
    counts = spark.createDataFrame(rows, "w long, kind int, n long")
    found = hmm.vocabulary(counts, 100, 1000)
    assert 800 < len(found.known) < 1200 and set(found.known.view(np.int64)) <= set(words.tolist()) and (found.symbol >= 0).sum() == 100
    assert len(hmm.vocabulary(counts, 100, 10**6).known) == 4000
    more = counts.union(spark.createDataFrame([(5, 0, 900), (6, 1, 800)], counts.schema))
    assert {5, 6} <= set(hmm.vocabulary(more, 100, 1000).known.tolist())
    assert len(hmm.vocabulary(counts.limit(0), 100, 1000).known) == 0
