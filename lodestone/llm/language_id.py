"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import doc_bucket

BUCKETS = 4096
UNKNOWN = "und"
_ORDERS = (1, 2, 3, 4)
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether a text has a sign of Unicode's categories of letters."""
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def profiles(texts: list[str]) -> np.ndarray:
    """One row a text: square roots of the shares of its hashed n-grams of lower-cased UTF-8 bytes, orders 1 to 4."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for row, text in zip(out, texts, strict=True):
        data = np.frombuffer((" " + text.lower() + " ").encode(), np.uint8).astype(np.uint32)
        counts = np.zeros(BUCKETS, dtype=np.float64)
        for start in range(0, len(data), 1 << 20):  # long texts in parts that overlap by the longest order
            part = data[start : start + (1 << 20) + _ORDERS[-1] - 1]
            rolled = np.zeros(len(part), dtype=np.uint32)
            for n in _ORDERS:
                rolled = rolled[: len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1 :] + np.uint32(n)
                take = rolled[: min(len(rolled), 1 << 20)]
                mixed = (take ^ (take >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                counts += np.bincount(mixed >> np.uint32(20), minlength=BUCKETS)
        row[:] = np.sqrt(counts / max(1.0, counts.sum()))
    return out


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of -1 and 1: the exhaustive code up to 6 languages, else the best spread of seeded random ones."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        width = 2 ** (n - 1) - 1
        return np.array([[1 if r == 0 or (c >> (r - 1)) & 1 == 0 else -1 for c in range(1, width + 1)] for r in range(n)])
    rng = np.random.default_rng(seed)
    width = 10 * int(np.ceil(np.log2(n)))
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], size=(n, width))
        if (np.abs(code.sum(axis=0)) == n).any():
            continue
        least = (width - (code @ code.T - 2 * width * np.eye(n))).min() / 2
        if least > apart:
            best, apart = code, least
    return best


def fit_bits(x: np.ndarray, y: np.ndarray, rounds: int = 150, ridge: float = 1e-5) -> np.ndarray:
    """Logistic classifiers of all bits at once: rows of x, y of -1 and 1. The last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    w = np.zeros((x.shape[1], y.shape[1]), dtype=np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):  # full-batch Adam
        margin = np.clip(y * (x @ w), -30, 30)
        grad = -(x.T @ (y / (1 + np.exp(margin)))) / len(x) + ridge * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= (1.0 * m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return w


def decode(margins: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Shares of the languages by loss-weighted decoding: the summed logistic loss of a codeword's bits, as weights."""
    z = np.clip(margins[:, None, :] * code[None, :, :], -30, 30)
    loss = np.log1p(np.exp(-z)).sum(axis=2)
    weight = np.exp(loss.min(axis=1, keepdims=True) - loss)
    return weight / weight.sum(axis=1, keepdims=True)


def learn(rows: DataFrame, per_language: int) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Languages, codewords and bit weights from rows (doc_id, text, lang): about per_language rows of each, by a hash of the id."""
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    if len(counts) > 1000:
        raise ValueError("more than 1,000 different values: the column does not hold languages")
    share = F.create_map(*(F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, per_language / n))))
    spot = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = profiles(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"]
            )

    sample = (
        rows.where(spot < share[F.col("lang")]).select("text", "lang").mapInArrow(run, "lang string, x binary").toArrow()
    )
    langs = sorted(counts)
    code = codewords(len(langs))
    labels = sample.column("lang").to_pylist()
    x = np.stack([np.frombuffer(b.as_py(), np.float32) for b in sample.column("x")])
    order = np.lexsort((x[:, 0], x[:, 7], labels))  # Spark's row order may vary, the model must not
    place = {lang: k for k, lang in enumerate(langs)}
    y = code[[place[labels[i]] for i in order]].astype(np.float32)
    return langs, code, fit_bits(x[order], y)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_out: int = 2,
    per_language: int = 500,
    margin: float = 0.2,
) -> DataFrame:
    """Predict the language of every whole text, by classifiers learned from the rows not held out.

    A bounded sample of about `per_language` training rows a language (the
    documented bound) fits one binary classifier for each bit of the languages'
    codewords; the weights, 4097 by bits, go to every task. Texts are scored in
    Arrow batches without a shuffle. lang, source and id are no inputs.

    Columns: doc_id, held_out, lang_pred, score (share of the chosen codeword)
    and ambiguous (its lead over the second is under `margin`).

    Defined results: null texts and texts without a letter are 'und' with score
    0 (letters are Unicode's, so ½ and ² are none); with no labelled training
    row every text is; long texts are read whole, in parts; equal texts score
    equally and of equal shares the language first in order wins; more than
    1,000 different lang values are an error; a null id is not held out; an
    empty table gives an empty table; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    out = F.coalesce(doc_bucket(F.col("doc_id"), folds) == held_out, F.lit(False))
    train = rows.where(~out & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    model = learn(train, per_language)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            langs, scores, doubtful = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            known = [i for i, t in enumerate(texts) if found and t and has_letter(t)]
            for k in range(0, len(known), 256):
                at = known[k : k + 256]
                names, code, w = found
                share = decode(profiles([texts[i] for i in at]) @ w[:-1] + w[-1], code)
                best = share.argmax(axis=1)
                top = share[np.arange(len(at)), best]
                second = np.partition(share, -2, axis=1)[:, -2] if len(names) > 1 else np.zeros(len(at))
                for i, b, s, t in zip(at, best, top, second, strict=True):
                    langs[i], scores[i], doubtful[i] = names[b], float(s), bool(s - t < margin)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(doubtful, pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    return rows.select("doc_id", out.alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )
