"""The document operators on awkward rows, each against a plain Python version."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, language_id, near_dup, packing, piece_codec, quality, secret_scan, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row long, salt int, sha string"
LONG = "lorem ipsum dolor sit amet " * 8000
TOKEN = "".join("0123456789abcdef"[(i * 7 + 3) % 16] for i in range(40))
ROWS = [
    (1, "Hello World", "en", "a/x", 11),
    (2, "hello world", "en", "b/x", 11),
    (3, None, "en", "a/y", None),
    (4, "", None, None, 0),
    (None, "HELLO WORLD", "fr", "a/x", 11),
    (5, LONG, "de", "c", len(LONG)),
    (5, LONG, "de", "c", len(LONG)),
    (6, "É É", "fr", "c", 3),
    (7, "é é", "fr", "c", 3),
    (8, f'password = "{TOKEN}" and AKIAQ8Z3M5K1ABCDEF x', "en", "a/x", 1),
    (9, "secret:token:abcdefgh12 api-key=short pwd", "en", "a/x", 1),
    (10, "one two three four five six seven eight nine ten eleven twelve", "en", "a/x", 1),
    (11, "One, two; three four five six seven eight nine ten eleven twelve!", "en", "b/x", 1),
    (12, "日本語 \u0000 😀 <|endoftext|> <s> ▁ ²..", "en", "b/x", 1),
    (13, "..., !!!", "en", "b/x", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", 1, 2, "s") for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_groups(docs, nothing):
    got = exact_dedup.exact_groups(exact_dedup.numbered(docs)).collect()
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(low(t), []).append(i)
    assert len(got) == len(ROWS)
    for key, ids in groups.items():
        rows = [r for r in got if r.text_sha256 == hashlib.sha256(key.encode()).hexdigest()]
        assert len(rows) == len(ids)
        assert {r.keep_id for r in rows} == {max((i for i in ids if i is not None), default=None)}
        assert {r.group_size for r in rows} == {len(ids)}
        assert sum(r.kept for r in rows) == 1
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_exact_groups_of_a_hot_text(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'Same', concat('t', id)) as text")
    got = exact_dedup.exact_groups(exact_dedup.numbered(rows)).where("group_size > 1")
    assert {(r.keep_id, r.group_size) for r in got.collect()} == {(2997, 1000)}
    assert got.where("kept").count() == 1


def test_rows_multiplied_after_the_scan(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plain = sorted(r.doc_id for r in exact_dedup.exact_dedup(docs).collect())
    twice = docs.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    crossed = docs.crossJoin(spark.range(3).withColumnRenamed("id", "n"))
    for many in (twice, crossed, docs.unionAll(docs)):
        kept = exact_dedup.exact_dedup(many)
        assert kept.columns == many.columns and sorted(r.doc_id for r in kept.collect()) == plain
    assert exact_dedup.exact_dedup(docs.where("doc_id % 2 = 0").select("text", "doc_id")).columns == ["text", "doc_id"]


def test_a_hot_text_of_one_id(spark):
    rows = spark.range(4000).selectExpr("if(id % 4 = 0, 7L, if(id % 4 = 1, null, id)) as doc_id", "if(id % 4 < 2, 'Same', concat('t', id)) as text")
    got = exact_dedup.exact_groups(exact_dedup.numbered(rows)).where("group_size > 1")
    assert {(r.keep_id, r.group_size) for r in got.collect()} == {(7, 2000)}
    assert [r.doc_id for r in got.where("kept").collect()] == [7]
    none = rows.withColumn("doc_id", F.lit(None).cast("long"))
    assert exact_dedup.exact_dedup(none).count() == 2001


def test_pieces_equal_the_library(docs, nothing):
    import sentencepiece
    from lodestone.llm.shared import vocabulary_path

    lib = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(piece_codec.MODEL))
    got = piece_codec.encode(docs, with_ids=True).collect()
    want = {}
    for i, t, *_ in ROWS:
        want[i] = lib.encode(t or "", add_bos=True, add_eos=True)
    assert len(got) == len(ROWS)
    for r in got:
        ids = lib.encode("HELLO WORLD", add_bos=True, add_eos=True) if r.doc_id is None else want[r.doc_id]
        assert r.ids == ids and r.decoded == lib.decode(ids) and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
    assert piece_codec.encode(nothing).count() == 0
    assert piece_codec.codec().decode(want[12]) == lib.decode(want[12])
    coder, rng = piece_codec.codec(), np.random.default_rng(4)
    for ids in rng.integers(0, len(coder.pieces), (300, 7)).tolist():
        ids = [i for i in ids if i not in coder.bytes_of and i != lib.unk_id()]
        assert coder.decode(ids) == lib.decode(ids)


def test_segments_in_use_outlive_a_full_cache(monkeypatch):
    from lodestone.llm.shared import vocabulary_path

    monkeypatch.setattr(piece_codec, "_CACHED_SEGMENTS", 20)
    coder, merged = piece_codec.Codec(vocabulary_path(piece_codec.MODEL)), []
    ids_of = coder.segment_ids
    monkeypatch.setattr(coder, "segment_ids", lambda s: merged.append(s) or ids_of(s))
    letters = [a + b for a in "abcdefghijklm" for b in "nopqrstuvwxyz"]
    for k in range(0, 160, 8):
        text = " ".join(["often", *letters[k : k + 8]])
        assert [t for _, t in coder.encode_many([text, "often"])] == [text, "often"]
    assert len(merged) == 161 and merged.count("\u2581often") == 1
    assert len(coder.cache) + len(coder.older) < 64  # bounded all the same
    list(coder.encode_many([letters[0]]))
    assert merged.count("\u2581" + letters[0]) == 2  # what is not in use goes


def test_both_agendas_equal_the_library():
    coder, rng = piece_codec.codec(), np.random.default_rng(5)
    signs = np.array(list("aeinrstth.,- \n\u00e9\u00df\u20ac\U0001f600_7"))
    texts = ["".join(rng.choice(signs[: rng.integers(2, len(signs))], n)) for n in (*range(1, 140), 700) for _ in range(4)]
    for text, (raw, decoded) in zip(texts, coder.encode_many(texts), strict=True):
        ids = np.frombuffer(raw, "<u4").tolist()
        assert ids == coder.library.encode(text, add_bos=True, add_eos=True) and decoded == coder.library.decode(ids)
        assert coder._merge_scanned(text) == coder._merge_heaped(text)
    assert coder.decode([]) == coder.decode([coder.library.bos_id()]) == ""


SPANS = (
    (re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 8, 1),
    (re.compile("AKIA[A-Z0-9]+"), 16, 0),
    (re.compile("[0-9a-f]+"), 32, 0),
)


def base_spans(text):
    found = []
    for k, (p, least, g) in enumerate(SPANS):
        found += [(m.start(), k, m.end()) for m in p.finditer(text or "") if len(m[g]) >= least]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secret_spans(docs, nothing, spark):
    rows = exact_dedup.numbered(docs)
    got = {r.doc_id: r for r in secret_scan.span_report(secret_scan.secret_spans(rows)).collect()}
    for i, t, *_ in ROWS:
        assert got[i].base_sha256 == hashlib.sha256(base_spans(t).encode()).hexdigest()
    assert (got[8].n_assign, got[8].n_access, got[8].n_hex, got[8].n_live) == (1, 1, 1, 3)
    assert all(part in got[8].spans.split(",") for part in base_spans(ROWS[9][1]).split(","))
    assert secret_scan.span_report(secret_scan.secret_spans(exact_dedup.numbered(nothing))).count() == 0
    many = "token=abcdefgh1 é " * 3000 + TOKEN
    one = spark.createDataFrame([(1, many)], "doc_id long, text string")
    r = secret_scan.span_report(secret_scan.secret_spans(exact_dedup.numbered(one))).collect()[0]
    assert r.n_assign == 3000 and r.base_sha256 == hashlib.sha256(base_spans(many).encode()).hexdigest()


def test_copied_values_are_no_live_secrets(spark):
    rows = [(i, f"token={TOKEN}", f"owner{i}/repo{i}") for i in range(10)] + [(20, "secret=mine1234abcd9xyz", "owner1/repo")]
    rows += [(30 + i, "token=your-token-goes-here", f"owner{i}/repo") for i in range(3)]
    rows += [(40 + i, "token=real7key8held9by3three", f"owner{i}/repo") for i in range(3)]
    rows += [(50 + i, "token=one8owners7own6secret5", f"owner1/repo{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in secret_scan.span_report(secret_scan.secret_spans(exact_dedup.numbered(docs))).collect()}
    assert (got[0].n_live, got[0].n_copied) == (0, 2)  # many owners and repositories
    assert (got[20].n_live, got[20].n_copied) == (1, 0)
    assert (got[30].n_live, got[30].n_copied) == (0, 1)  # some owners, and a placeholder
    assert (got[40].n_live, got[40].n_copied) == (1, 0)  # some owners, but it looks live
    assert (got[50].n_live, got[50].n_copied) == (1, 0)  # many repositories of one owner
    out = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert out[20] == "secret=[SECRET]" and out[0] == rows[0][1] and out[30] == rows[11][1]
    assert out[40] == out[50] == "token=[SECRET]"


def test_redaction_of_long_texts_with_many_spans(spark):
    words = [f"é filler {k} token=abcd{k:05d}xyz9" if k % 3 else "x" * (k % 50) for k in range(6000)]
    text = " ".join(words)
    rows = [(1, text, 5, "a"), (2, "secret=abcdefgh1", 5, "b"), (3, "password=token=abcdef12 secret:zzzzzzzz9", 5, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row int, __cuts string")
    out = {r.doc_id: r for r in secret_scan.redacted(docs).collect()}
    assert out[1].text == re.sub("token=abcd[0-9]{5}xyz9", "token=[SECRET]", text) and (out[1]["__row"], out[1]["__cuts"]) == (5, "a")
    assert out[2].text == "secret=[SECRET]" and out[3].text == "password=[SECRET] secret:[SECRET]"


def test_redaction_keeps_the_rest(docs):
    out = {r.doc_id: r for r in secret_scan.redacted(docs).collect()}
    assert out[8].text == 'password = "[SECRET]" and [SECRET] x' and out[8].n_chars == len(out[8].text)
    assert out[3].text is None and out[10].text == ROWS[11][1] and out[8].kept == "clash"


def test_near_classes(docs, nothing):
    got = near_dup.near_classes(exact_dedup.numbered(docs)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(ROWS)
    assert by[10][0].class_id == by[11][0].class_id == 10
    assert by[1][0].class_id == by[2][0].class_id == by[None][0].class_id == 1
    assert by[5][0].class_size == 2 and sum(r.kept for r in by[5]) == 1
    assert by[3][0].class_id == 3 and by[4][0].class_id == 4 and by[13][0].class_id == 13
    kept = near_dup.near_dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.class_id for r in got})
    assert near_dup.near_dedup(nothing).count() == 0


def test_near_classes_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(25):
        base = rng.choice(words, 150).tolist()
        for _ in range(12):
            text = list(base)
            for at in rng.choice(150, rng.integers(0, 9), replace=False):
                text[at] = rng.choice(words)
            rows.append((i, " ".join(text)))
            i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bags = [near_dup.bag(t) for _, t in rows]
    root = list(range(i))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(i):
        for b in range(a):
            if near_dup.overlap(bags[a], bags[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(exact_dedup.numbered(docs)).collect()}
    assert got == {k: find(k) for k in range(i)}


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(40):
        e = near_dup.mixed(rng.integers(0, 2**60, 200).astype(np.uint64))
        a, b = rng.integers(0, 6, 200), rng.integers(0, 6, 200)
        b = np.where(rng.random(200) < 0.7, a, b)
        s = [near_dup.signatures(np.zeros((w > 0).sum(), int), e[w > 0], w[w > 0], 1)[0] for w in (a, b)]
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_rows_keep_their_identity_when_scans_differ(spark):
    def another_order(batches):
        import os
        import random

        import pyarrow as pa

        for batch in batches:
            at = list(range(batch.num_rows))
            random.Random(os.urandom(8)).shuffle(at)
            yield pa.Table.from_batches([batch]).take(at).combine_chunks().to_batches()[0]

    rows = [(i, f"row {i} " + " ".join(f"w{i}x{k}" for k in range(30)) + f" token=mine{i:04d}abcd9xyz", f"o{i}/r") for i in range(200)]
    rows += [(i + 1000, t + " end", s) for i, t, s in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).mapInArrow(another_order, "doc_id long, text string, source string")
    text = {i: t for i, t, _ in rows}
    out = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert out == {i: re.sub("mine[0-9]{4}abcd9xyz", "[SECRET]", t) for i, t in text.items()}
    assert sorted(r.doc_id for r in near_dup.near_dedup(docs).collect()) == list(range(200))


def test_packing(docs, nothing):
    from lodestone.llm.shared import vocabulary_path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path(packing.VOCABULARY))
    got = packing.pack(docs, with_ids=True).collect()
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, x, *_ in ROWS}
    total, sequences, counted = {}, {}, 0
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids == part.tolist() and r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        counted += r.length
    assert counted == sum(len(ids[i]) for i, *_ in ROWS)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(nothing).count() == 0


def test_packing_reads_added_tokens_as_the_library(spark, tmp_path):
    from lodestone.llm import queries
    from lodestone.llm.shared import vocabulary_path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path(packing.VOCABULARY))  # its default settings
    texts = ["x <|endoftext|> y", "<|endoftext|><|endoftext|>a", "<|endoftext", "plain"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op8_packing(spark, str(tmp_path)).collect():
        ids = np.array([*t.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], dtype="<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_packing_of_short_texts_pads_little(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text")).coalesce(1)
    got = packing.pack(docs).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert got.where("n < 1000").count() <= 10 and got.agg(F.sum("n")).collect()[0][0] == 12000


@pytest.mark.parametrize("text", ["", "a", "a b"])
def test_packing_of_the_shortest_texts_pads_little(spark, text):
    got = packing.pack(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).coalesce(1))
    sizes = [r.n for r in got.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert sum(1024 - n for n in sizes if n & (n - 1)) <= sum(sizes) * 0.1


@pytest.mark.parametrize("loss", [1, 4, 7])
def test_packing_under_a_small_loss_limit_ends(spark, loss):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, ""), (3, "a b")], "doc_id long, text string")
    got = packing.pack(docs.coalesce(1), limits=packing.Limits(tokens=64, segments=8, loss=loss)).collect()
    assert sum(r.length for r in got) == sum({r.doc_id: r.doc_tokens for r in got}.values())
    assert all(sum(r.length for r in got if r.sequence_id == s) <= loss for s in {r.sequence_id for r in got})


def test_packed_conversations(spark):
    from lodestone.llm import queries

    sf = "/root/testdata/sf0.001"
    coder = packing.encoder()
    full = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        full.setdefault(r.conv_id, 0)
        full[r.conv_id] += len(packing.ids_of(coder, r.text or "", True)) + 1
    got = queries.packed_conversations(spark, sf)
    sums = {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert sums == full
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k")).where("n > 1024 or k > 24").count() == 0


def test_packing_limits_all_three(spark):
    rows = [(i, "ask " * (i % 40), "ask " * (i % 40) + "word " * (5 + i % 90)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, prompt string, text string").withColumn("head", F.length("prompt"))
    limits = packing.Limits(tokens=256, segments=5, loss=120)
    got = packing.pack(docs.coalesce(1), limits=limits, loss_from_col="head", with_ids=True)
    prompt = {r.doc_id: r.n for r in packing.pack(docs.select("doc_id", F.col("prompt").alias("text"))).groupBy("doc_id").agg(F.max(F.col("doc_tokens") - 1).alias("n")).collect()}
    sums = {}
    for r in got.collect():
        s = sums.setdefault(r.sequence_id, [0, 0, 0])
        first = prompt[r.doc_id]
        s[0] += r.length
        s[1] += 1
        s[2] += max(0, r.start + r.length - max(first, r.start))
    assert all(a <= 256 and b <= 5 and c <= 120 for a, b, c in sums.values())
    assert got.agg(F.sum("length")).collect()[0][0] == got.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).collect()[0][0]


def test_language(spark, nothing):
    say = {"en": "the cat and the dog are here with that thing ", "fr": "le chat et la belle maison est une chose ", "de": "der hund und die katze ist nicht das ding "}
    rows = [(i, say[g] * (1 + i % 4), g, "s") for i, g in enumerate(["en", "fr", "de"] * 60)]
    rows += [(1000, None, "en", "s"), (1001, "123 !!", "en", "s"), (1003, "½ ² ① ٣", "en", "s"), (1004, "日本", None, "s"), (1002, say["fr"] * 9000, None, "s"), (1002, say["fr"], None, "s"), (None, say["de"], "de", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("held_out", F.lit(1))
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows)
    truth = {i: g for i, _, g, _ in rows[:180]}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and all(r.lang_pred == truth[r.doc_id] for r in held)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id == 1004:
            assert r.lang_pred in say
        if r.doc_id in (1000, 1001, 1003):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        if r.doc_id == 1002:
            assert r.lang_pred == "fr"
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert language_id.identify(nothing).count() == 0
    assert language_id.decode(np.zeros((1, 3)), language_id.codewords(3)).argmax() == 0  # equal shares
    code = language_id.codewords(9)
    assert len({tuple(c) for c in code}) == 9


def _labelled(spark, good, bad):
    rows = [(i, (good if i % 3 else bad) * (1 + i % 5)) for i in range(240)] + [(900, None), (901, ""), (None, good), (2, good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(240)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality(spark, nothing):
    docs, labels = _labelled(spark, "A plain sentence of ordinary words goes here. ", "BUY!! NOW!! ### $$$ BUY!! ")
    got = quality.score(docs, labels).collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert held and all(r.predicted == int(r.doc_id % 3 > 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got) and len(got) == docs.count()
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.accepted(docs, labels).where("doc_id = 3").count() == 0
    unlabelled = labels.where("false")
    assert {r.score for r in quality.score(docs, unlabelled).collect()} == {0.5}
    assert quality.score(nothing, labels).count() == 0


def test_quality_of_long_and_repeated_texts(spark):
    docs, labels = _labelled(spark, "A plain sentence of ordinary words goes here. ", "BUY!! NOW!! ### $$$ BUY!! ")
    again = docs.where("doc_id = 4").crossJoin(spark.range(500)).drop("id")
    sample, n = quality.labelled(docs.unionByName(again), labels, "quality", F.lit(True), 1000, "quality")
    assert n == {0: 80, 1: 160} and sample.count() == 240
    long = spark.createDataFrame([(7000, "A plain sentence of ordinary words goes here. " * 40000, "x"), (7001, "BUY!! NOW!! " * 90000, "x")], docs.schema)
    got = {r.doc_id: r.predicted for r in quality.score(docs.unionByName(long), labels).where("doc_id >= 7000").collect()}
    assert got == {7000: 1, 7001: 0}


def test_toxicity(spark, nothing):
    docs, labels = _labelled(spark, "A plain sentence of ordinary words goes here. ", "You are a moronic worthless fool of words. ")
    got = toxicity.score(docs, labels).collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert held and all(r.predicted == int(r.doc_id % 3 == 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got) and len(got) == docs.count()
    assert {r.score for r in toxicity.score(docs, labels.where("false")).collect()} == {0.0}
    assert toxicity.score(nothing, labels).count() == 0


def test_scales_keep_the_base_rate_of_all_rows():
    rng = np.random.default_rng(3)
    y = (rng.random(6000) < 0.85).astype(float)
    margin = rng.normal(size=6000) + 2 * y - 1
    even = np.concatenate([np.flatnonzero(y == 1)[:700], np.flatnonzero(y == 0)[:700]])  # one to one, as on large tables
    n = {1: int(y.sum()), 0: int((1 - y).sum())}
    for b in (
        lambda k, w: quality.platt(margin[k], y[k], w)[1],
        lambda k, w: (lambda t: t[0][-1] - t[0][0] * t[1][0] / t[2][0])(toxicity.logistic(margin[k, None], y[k], weight=w)),
    ):
        whole, sample = b(np.arange(6000), None), b(even, quality.class_weights(y[even], n))
        assert abs(whole - sample) < 0.3 and abs(whole - b(even, None)) > 1


def test_quality_scores_do_not_move_with_the_bound(spark):
    docs, labels = _labelled(spark, "A plain sentence of ordinary words goes here. ", "BUY!! NOW!! ### $$$ BUY!! ")
    sample, n = quality.labelled(docs, labels, "quality", F.lit(True), 60, "quality")
    assert n == {0: 80, 1: 160} and sample.count() < 180
    assert quality.fit(sample, n)[3] > quality.fit(sample)[3]


def test_toxicity_counts_every_labelled_row(spark):
    from collections import Counter

    docs, labels = _labelled(spark, "A plain sentence of ordinary words goes here. ", "You are a moronic worthless fool of words. ")
    # each row has a word of its own: only counts over all rows know them
    docs = docs.withColumn("text", F.when(F.col("doc_id") < 240, F.concat("text", F.translate(F.col("doc_id").cast("string"), "0123456789", "ghijklmnop"))).otherwise(F.col("text")))
    model = toxicity.fit(docs, labels, "toxic", F.lit(True), 12)
    words = [Counter(), Counter()]
    for r in docs.collect():
        if r.doc_id is not None and r.doc_id < 240:
            words[r.doc_id % 3 == 0].update(set(toxicity._WORD.findall(r.text.lower())))
    want = toxicity.kneser_ney(tuple(words))
    for got, full in zip((model.grams, model.contexts), want.leans(), strict=True):
        assert got.keys() == full.keys() and all(abs(got[g] - p) < 1e-9 for g, p in full.items())


def test_kneser_ney_sums_to_one():
    from collections import Counter

    for order in (2, 3, 4):
        pair = toxicity.kneser_ney((Counter({"abc": 5, "abd": 2, "b": 1}), Counter({"abx": 3, "abc": 1, "bb": 4})), order=order)
        for c in (0, 1):
            for context in ("\x02", "\x02a", "ab", "abc", "b", "zz"):
                context = context[-(order - 1) :]
                mass = 0.0
                for ch in "abcdx\x03?":  # the last stands for all that was never seen
                    own = pair.own[c].get(context + ch)
                    mass += np.exp(pair.back[c].get(context, 0.0) + pair.lower((context + ch)[1:]) if own is None else own)
                assert abs(mass - 1) < 1e-9


def test_toxic_evidence_is_the_lead_of_the_better_likelihood():
    calm, one, long = np.zeros(100), np.array([8.0] + [0.0] * 99), np.array([8.0] + [0.0] * 9999)
    assert toxicity.evidence(calm) == toxicity.evidence(np.zeros(0)) == toxicity.evidence(calm + 1.9) == 0
    assert 0 < toxicity.evidence(long) < toxicity.evidence(one) < 1
    assert toxicity.evidence(one) == pytest.approx(0.6 / 0.9)


def test_toxicity_of_long_and_repeated_texts(spark):
    docs, labels = _labelled(spark, "A plain sentence of ordinary words goes here. ", "You are a moronic worthless fool of words. ")
    more = [(5000, LONG * 20), (5001, LONG + " moronic worthless fool"), (5001, LONG + " moronic worthless fool")]
    more = spark.createDataFrame(more, "doc_id long, text string").withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in toxicity.score(docs.unionByName(more), labels).where("doc_id >= 5000").collect()}
    assert got[5000].predicted == 0 and got[5001].predicted == 1
    renamed = docs.withColumnRenamed("doc_id", "key").withColumnRenamed("text", "body")
    other = toxicity.score(renamed, labels, id_col="key", text_col="body").collect()
    assert sorted((r.doc_id or -1, r.score) for r in other) == sorted((r.doc_id or -1, r.score) for r in toxicity.score(docs, labels).collect())
