"""Vectors, pages and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import html_text, topk


def brute(rows, asked, k=5):
    good = [(i, np.floor(np.array(v, dtype=float) * 256)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i not in asked:
            continue
        hits = sorted((-int(q @ c), j) for j, c in good if j != i and len(c) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(hits)]
    return sorted(set(out))


def test_top_k_with_awkward_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(40)] + [(7, rows[7][1])] + [(33, [4.0] * 6)] * 9 + [(44, [4.0] * 6)] * 2
    rows += [(300, None), (301, [None] + [1.0] * 5), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, [1.0, 2.0]), (305, []), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).repartition(5)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    asked = {i for i, _ in rows if i is not None and i % 10 == 0}
    want = brute(rows, asked)
    for options in ({}, {"shard_rows": 9, "fan_in": 2}, {"shard_rows": 4, "fan_in": 3, "cells": 6}):
        got = topk.top_k(df, df.where("vec_id % 10 = 0"), **options).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    empty = df.where("false")
    assert topk.top_k(empty, empty).count() == 0


def test_top_k_of_repeated_rows(spark):
    rows = [(0, [1.0, 0.0])] + [(1, [9.0, 0.0])] * 8 + [(i, [float(i), 0.0]) for i in range(2, 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for options in ({}, {"shard_rows": 2}):
        got = topk.top_k(df, df.where("vec_id = 0"), **options).orderBy("rank").collect()
        assert [(r.rank, r.vec_id, r.score) for r in got] == [(k, 1, 9 * 256 * 256) for k in range(1, 6)]
    got = topk.top_k(df, df.where("vec_id = 1").limit(1)).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [7, 6, 5, 4, 3]


def test_top_k_beyond_exact_doubles(spark):
    rows = [(i, [1e9 + i, 3.0 * i]) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id = 3"), scale=1.0).orderBy("rank").collect()
    want = sorted(((-(int(1e9 + 3) * int(1e9 + i) + 9 * 3 * i), i) for i in range(8) if i != 3))[:5]
    assert [(r.vec_id, r.score) for r in got] == [(i, -s) for s, i in want]


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav class="x"><ul><li><a href="/a">Home</a></li><li>News</li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this long notice appear on every page of the site.</p></div>
<article><h2>The &amp; title</h2><p>First   paragraph<br>with a <b>break.<p>Second one is here, long enough to be told from the rest.
<ul><li>item one</li><li>item &eacute;</ul><aside><p>Sidebar words</p></aside><p>Last.</p>
<section id="comments"><p>A reader wrote this.</p></section></article>
<form><input><p>Subscribe</p></form><footer>&copy; us</footer></body></html>"""


def test_main_text():
    want = ["The & title", "First paragraph with a break.", "Second one is here, long enough to be told from the rest.", "item one", "item é", "Last."]
    assert html_text.main_text(PAGE) == "\n\n".join(want)
    plain = PAGE.replace("<article>", '<div id="text">').replace("</article>", "</div>")
    assert html_text.main_text(plain) == "\n\n".join(want)
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("just words") == "just words"
    assert html_text.main_text("<p>a < b and 'c' <p>d") == "a < b and 'c'\n\nd"
    wrapped = '<div class="layout has-sidebar"><div class="sidebar"><p>links here</p></div><article><div class="entry-header"><h1>T</h1></div><p>Body text.</p><div class="share-bar">Share</div></article></div>'
    assert html_text.main_text(wrapped) == "T\n\nBody text."
    big = "<article>" + "<p>word word</p>" * 20000 + "</article>"
    assert html_text.main_text(big).count("word") == 40000
    assert html_text.main_text("<a " * 20000) is not None


def test_main_text_by_the_distribution():
    long, tail = "word " * 1000, "tail " * 80
    ad = '<div class="ad"><p>Buy this now</p></div>'
    parts = f"<section><p>{long}</p></section>{ad}<section><p>{tail}</p></section>{ad}<section><p>Short end.</p></section>"
    want = [long.strip(), tail.strip(), "Short end."]
    # sections that differ much in length, on a page without article or main
    assert html_text.main_text(f"<body><div>{parts}</div><footer>f</footer></body>").split("\n\n") == want
    assert html_text.main_text(f"<body><div>{parts}</div>{ad}<div><p>Short junk</p></div></body>").split("\n\n") == want
    # an article that is only a teaser does not decide: the lengths do
    teased = f"<body><div><p>{long}</p><p>{tail}</p></div><article><p>Read on</p></article></body>"
    assert html_text.main_text(teased).split("\n\n") == want[:2]
    # and the other way round: little text beside an article is not main text
    beside = f"<body><article><p>{long}</p></article><div><p>Written by someone.</p></div></body>"
    assert html_text.main_text(beside) == want[0]


def test_missing_end_tags_lose_nothing():
    want = "Some words of the article."
    body = f"<body><article><p>{want}</p></article>"
    assert html_text.main_text(f"<html><head><title>T</title>{body}") == want
    assert html_text.main_text(f"<html><head><title>T{body}") == want
    for tag in ("svg", "button", "select", "object", "canvas", "iframe", "noscript"):
        assert html_text.main_text(f"<body><{tag}><div></div><article><p>{want}</p></article>") == want
        assert html_text.main_text(f"<body><{tag}><article><p>{want}</p></article><{tag}>no</{tag}>") == want
        assert html_text.main_text(f"<body><article><{tag}>no <{tag}>no</{tag}></{tag}><p>{want}</p></article>") == want
    assert html_text.main_text(f"<body><p>{want}</p><script>var a = '<p>no</p>'") == want
    assert html_text.main_text("<svg>" * 20000 + f"<p>{want}</p>") == want


def test_extract(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_text.extract(df).collect()
    assert len(got) == 4 and all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(df.where("false")).count() == 0


def test_pipeline_against_single_operators(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    from lodestone.llm import near_dup, packing, quality, secret_scan
    from lodestone.llm.exact_dedup import exact_dedup

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in quality.score(docs, labels).collect()}
    left = {r.doc_id: r for r in docs.collect() if scores[r.doc_id] == 1}
    best = {}
    for i, r in left.items():
        key = "".join(c.lower() if c.isascii() else c for c in r.text or "")
        best[key] = max(best.get(key, i), i)
    left = {i: left[i] for i in best.values()}
    bags = {i: near_dup.bag(r.text or "") for i, r in left.items()}
    root = {i: i for i in left}
    for a in sorted(left):
        for b in sorted(left):
            if b < a and near_dup.overlap(bags[a], bags[b]) >= 0.8:
                x, y = root[a], root[b]
                root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    kept = {i for i in left if root[i] == i}
    assert len(pipeline.STAGES) == 5
    rest = exact_dedup(quality.accepted(docs, labels))
    masked = secret_scan.redacted(rest.where(F.col("doc_id").isin(list(kept))))
    want = sorted((r.doc_id, r.doc_tokens) for r in packing.pack(masked).where("start = 0").collect())
    got = pipeline.run(spark, sf).where("start = 0").collect()
    assert sorted((r.doc_id, r.doc_tokens) for r in got) == want
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.where("false"), sf).count() == 0
