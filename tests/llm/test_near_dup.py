"""Near-duplicate classes: components, crowded hubs, clashing names."""

import numpy as np
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, near_dup


def brute(texts):
    bags, root = [near_dup.bag(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if near_dup.overlap(bags[a], bags[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in range(len(texts))}


def test_components_of_a_chain(spark, monkeypatch):
    written = []
    monkeypatch.setattr(near_dup, "staged", lambda df, name, keep=near_dup.staged: written.append(name) or keep(df, name))
    edges = [(i, i + 1) for i in range(63)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(64)}, 100: 100, 101: 100, 102: 100}
    assert written.count("ends") <= 8 and written.count("roots") <= 4  # rounds of a chain of 64
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 150, (130, 2))]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert {r.node: r.root for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()} == root


def test_crowded_hubs_equal_brute_force(spark, monkeypatch):
    """Rows that share a long passage, and so buckets, but are no near-duplicates, next to some that are."""
    narrowed = near_dup._narrowed
    monkeypatch.setattr(near_dup, "_narrowed", lambda rows, most: narrowed(rows, 16))
    rng = np.random.default_rng(11)
    common = [f"c{k}" for k in range(60)]
    texts = []
    for k in range(700):
        own = [f"w{k}x{j}" for j in range(int(rng.integers(14, 30)))]
        texts.append(" ".join(common + own))
        if k % 9 == 0:
            texts.append(" ".join(common + own[:-1] + ["end"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    rows = exact_dedup.held_rows(docs)
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(rows).collect()}
    assert got == brute(texts)


def test_clashing_names_are_kept(spark):
    rows = [(i, f"text number {i % 3} of some", i, "x") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row long, salt string")
    for kept in (near_dup.near_dedup(docs), exact_dedup.exact_dedup(docs)):
        assert kept.columns == docs.columns
        assert all(r["__row"] == r.doc_id and r.salt == "x" for r in kept.collect())
    assert near_dup.near_dedup(docs).count() == exact_dedup.exact_dedup(docs).count() == 3


def test_exact_dedup_of_a_file_split_anew(spark, tmp_path):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id") % 900).alias("text"))
    docs.repartition(5).write.parquet(f"{tmp_path}/d")
    read = spark.read.parquet(f"{tmp_path}/d")
    assert "_metadata" not in exact_dedup.exact_dedup(read).columns
    assert exact_dedup.identified(read).schema[exact_dedup.ROW].dataType.simpleString() == "struct<file:bigint,at:bigint>"
    assert sorted(r.doc_id for r in exact_dedup.exact_dedup(read).collect()) == [i for i in range(4000) if i + 900 >= 4000]
