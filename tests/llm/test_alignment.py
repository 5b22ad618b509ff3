"""Cross-tokenizer alignment against a plain version on the libraries themselves."""

import hashlib
from collections import Counter, defaultdict

import pytest

from lodestone.llm import token_alignment
from lodestone.llm.shared import vocabulary_path

SCHEMA = "doc_id long, text string, a int, b string, pair long, n int, __row string"
TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "the quick brown fox, the slow fox",
    "the quick brown fox, the slow fox",
    None,
    "",
    " ",
    "a",
    "▁ marks are no spaces",
    "<s> <|endoftext|> </s> <0x41> stay plain text",
    "日本語 😀 naïve café ﬁ\u0000 \n\n\t tabs",
    "  two  spaces   three",
    "unbelievably antidisestablishmentarianism " * 3000,
]


def brute(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    piece = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        whole = (" " + text).encode()
        a = [(i, bytes(byte_of[c] for c in left.id_to_token(i))) for i in left.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, piece(right.id_to_piece(i))) for i in right.encode(text)]
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            docs.append(None)
            continue
        groups, links = [([], [])], []
        i = j = at_a = at_b = 0
        while i < len(a) or j < len(b):
            if at_a == at_b and (groups[-1][0] or groups[-1][1]):
                groups.append(([], []))
            if at_a <= at_b:
                groups[-1][0].append(a[i][0])
                at_a += len(a[i][1])
                i += 1
            else:
                groups[-1][1].append(b[j][0])
                at_b += len(b[j][1])
                j += 1
        spans = []
        for side in (a, b):
            at, ranges = 0, []
            for x, said in side:
                ranges.append((at, at + len(said), x))
                at += len(said)
            spans.append(ranges)
        start = 0
        for lo, hi, x in spans[0]:
            while spans[1][start][1] <= lo:
                start += 1
            k = start
            while k < len(spans[1]) and spans[1][k][0] < hi:
                links.append((x, spans[1][k][2]))
                k += 1
        docs.append((len(a), len(b), groups, links))
    counts = Counter(p for d in docs if d for p in set(d[3]))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for d in docs:
        if d is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in d[2])
        n = [counts[p] for p in d[3]]
        best = sum(counts[p] == most[p[0]] for p in d[3])
        rows.append((d[0], d[1], len(d[2]), len(d[3]), best, sum(n), hashlib.sha256(said.encode()).hexdigest()))
    return rows


def table(spark, texts):
    ids = [None if k == 1 else k for k in range(len(texts))]
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, "y") for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


@pytest.mark.parametrize("head", [token_alignment.HEAD, 5, 0])
def test_equals_the_libraries(spark, head):
    got = token_alignment.align(table(spark, TEXTS), head=head).collect()
    want = [(None if k == 1 else k, *row) for k, row in enumerate(brute(TEXTS))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_given_documents_equal_the_libraries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = {r.doc_id: row for r, row in zip(rows, brute([r.text for r in rows]), strict=True)}
    got = {r.doc_id: tuple(r)[1:] for r in token_alignment.align(docs).collect()}
    assert got == want


def test_groups(spark):
    got = {r.doc_id: r.groups for r in token_alignment.groups(table(spark, TEXTS)).collect()}
    assert got[3] == got[4] == got[7] == []
    said = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in got[0])
    assert hashlib.sha256(said.encode()).hexdigest() == brute(TEXTS)[0][-1]


def test_no_rows(spark):
    assert token_alignment.align(spark.createDataFrame([], SCHEMA)).count() == 0


def test_memory_of_a_pass_is_bounded(spark, monkeypatch, tmp_path):
    """Each of the three passes sends Python batches of some 4 MB, not 10,000 rows; ids below 65,536 take two bytes."""
    seen, runs, limit = str(tmp_path / "seen"), token_alignment._runs, "spark.sql.execution.arrow.maxBytesPerBatch"

    def noted(batch, *columns, **kwargs):
        with open(seen, "a") as f:
            f.write(f"{'-'.join(columns)} {batch.nbytes}\n")
        yield from runs(batch, *columns, **kwargs)

    monkeypatch.setattr(token_alignment, "_runs", noted)
    docs = spark.range(0, 9_000, 1, 1).selectExpr("id doc_id", "repeat('the quick brown fox jumps, ', 40) text")
    (n,) = {tuple(r)[1:] for r in token_alignment.align(docs).collect()}
    sizes = [line.split() for line in open(seen)]
    passes = {columns: sum(int(size) for c, size in sizes if c == columns) for columns in ("text", "a-b")}
    assert passes["text"] > 9_000 * 1_000 and passes["a-b"] > 2 * 9_000 * 2 * (n[0] + n[1])
    assert max(int(size) for _, size in sizes) < 4.5e6
    row = token_alignment.aligned(docs.limit(1), "doc_id", "text", token_alignment.VOCABULARY, token_alignment.MODEL).first()
    assert (len(row.a), len(row.b)) == (2 * row.n_a, 2 * row.n_b)
    assert spark.conf.get(limit, None) is None


def test_a_limit_of_batches_that_is_set_stays(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(limit, "1m")
    try:
        assert token_alignment.align(table(spark, TEXTS)).count() == len(TEXTS)
        assert spark.conf.get(limit) == "1m"
    finally:
        spark.conf.unset(limit)
