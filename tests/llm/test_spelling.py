"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from lodestone.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, key string"


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute(rows, least_count=3):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= least_count}
    forms, n_near = {}, {}
    for w, n in words.items():
        found = sorted((-words[x], x) for x in words if near(w, x))
        n_near[w] = len(found)
        forms[w] = found[0][1] if found and -found[0][0] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, n_near[w], words[forms[w]] if forms[w] else None))
    return out


def test_equals_all_pairs(spark):
    rng = random.Random(5)
    stems = ["catalogue", "separate", "Über×÷straße", "aaaaa", "naïveté", "ÉCOLEs", "banana", "receive", "bookkeeper"]
    words = []
    for stem in stems:
        for _ in range(40):
            w = list(stem)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3))):
                k = rng.randrange(len(w))
                rng.choice((lambda w=w, k=k: w.pop(k), lambda w=w, k=k: w.insert(k, rng.choice("aeinüé")), lambda w=w, k=k: w.__setitem__(k, rng.choice("aelnsé"))))()
            words += ["".join(w)] * rng.choice((1, 2, 3, 4, 6, 7, 12, 30))
    rng.shuffle(words)
    rows = [(k // 40, " ".join(words[k : k + 40])) for k in range(0, len(words), 40)]
    rows += [(None, "receive receive; recieve-receve"), (1, None), (2, ""), (3, "catalogue " * 20_000), (3, "catalog " * 9000), (4, "日本語 123 abc")]
    df = spark.createDataFrame([(i, t, "clash", 1, "k") for i, t in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in spelling.variants(df).collect()]
    want = brute(rows)
    assert len(got) == len(want) > 150 and set(got) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # a path of two forms


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {tuple(r) for r in spelling.variants(docs).collect()} == want


def test_no_rows(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_masks_turn_one_bit_or_two():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
    for _ in range(300):
        w = "".join(rng.choices(letters, k=rng.randint(5, 20)))
        k = rng.randrange(len(w))
        other = rng.choice([c for c in letters if c != w[k]])
        masks = spelling.band_masks([w, w[:k] + w[k + 1 :], w[:k] + other + w[k + 1 :]])
        turned = [[int(np.bitwise_count(masks[b, 0] ^ masks[b, m])) for b in range(3)] for m in (1, 2)]
        assert sum(turned[0]) == 1 and sum(turned[1]) == 2
