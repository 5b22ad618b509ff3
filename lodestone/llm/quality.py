"""Quality classifier: support vectors over n-gram indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import doc_bucket, keyed_texts
from lodestone.llm.tokens import Tokens, mixed, text_runs

BITS = 18
_MULT = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _ngrams(keys: np.ndarray, docs: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of a stream of keys that stay within one document, and their documents."""
    if len(keys) < n:
        return keys[:0], docs[:0]
    last = len(keys) - n + 1
    h = np.full(last, np.uint64(salt))
    for k in range(n):
        h = (h ^ keys[k : k + last]) * _MULT[k]
        h ^= h >> np.uint64(29)
    same = docs[:last] == docs[n - 1 :]
    return mixed(h)[same], docs[:last][same]


def indicators(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text: arrays of document number and feature, sorted.

    Words in lower case, orders 1 and 2; and the stream of shapes, orders 1 to
    4, where a word's shape is its case, digits and whether it repeats the
    word before it, and a run of other signs is itself.
    """
    t = Tokens(texts)
    docs, feats = [], []
    words = t.is_word
    for n in (1, 2):
        h, d = _ngrams(t.lower_hash[words], t.doc[words], n, 11 + n)
        feats.append(h)
        docs.append(d)
    shapes = t.shapes()
    for n in (1, 2, 3, 4):
        h, d = _ngrams(shapes, t.doc, n, 31 + n)
        feats.append(h)
        docs.append(d)
    d, f = np.concatenate(docs), np.concatenate(feats) >> np.uint64(64 - BITS)
    both = np.unique((d.astype(np.uint64) << np.uint64(BITS)) | f)
    return (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.int64)


def dual_descent(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, c: np.ndarray, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Linear hinge-loss model by dual coordinate descent. Row i is r on its features, at length 1, with a bias of 1.

    c: the box of each row's multiplier. The last weight is the bias.
    """
    w = np.zeros(len(r) + 1)
    values = []
    for f in rows:
        v = r[f]
        norm = np.sqrt(v @ v)
        values.append(v / norm if norm else v)
    square = np.array([v @ v + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            f, v = rows[i], values[i]
            g = y[i] * (w[f] @ v + w[-1]) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), c[i])
            if (step := new - alpha[i]) != 0.0:
                w[f] += step * y[i] * v  # features are distinct within a row
                w[-1] += step * y[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def class_weights(y: np.ndarray, n: dict[int, int] | None) -> np.ndarray:
    """Weights, 1 on average, that give the classes of a sample (y: 0 or 1) the shares they have in all n rows."""
    if n is None:
        return np.ones(len(y))
    w = np.where(y == 1, n[1] / max(1, (y == 1).sum()), n[0] / max(1, (y == 0).sum()))
    return w / w.mean()


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """a and b of 1 / (1 + exp(-(a * margin + b))) by Newton steps on smoothed targets (y: 0 or 1)."""
    weight = np.ones(len(y)) if weight is None else weight
    pos, neg = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        s = weight * (p * (1 - p) + 1e-9)
        ga, gb = (weight * margin * (p - target)).sum() + 1e-3 * a, (weight * (p - target)).sum()
        haa, hab, hbb = (margin * margin * s).sum() + 1e-3, (margin * s).sum(), s.sum() + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-7:
            break
    return float(a), float(b)


def clean_labels(labels: DataFrame, label: str, fold: Column) -> DataFrame:
    """doc_id and y of the labelled ids that `fold` keeps, once each. Ids with contradictory labels are left out."""
    y = F.col(label).cast("int")
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), y.alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("y2"))
        .where("y = y2")
        .drop("y2")
        .where(fold)
    )


def class_counts(clean: DataFrame) -> dict[int, int]:
    return {r["y"]: r["n"] for r in clean.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}


def spot(salt: str) -> Column:
    """A number from 0 to 1 by a hash of the id."""
    return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    fold: Column,
    per_class: int,
    salt: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text, y of about per_class labelled ids a class that `fold` keeps, by a hash of the id; and how many
    ids each class has in all.

    The bound makes the sample, and so the broadcast of its ids, of fixed size.
    An id that docs repeats gives one row, of its greatest text.
    """
    clean = clean_labels(labels, label, fold)
    n = class_counts(clean)
    share = F.when(F.col("y") == 1, min(1.0, per_class / n.get(1, 1))).otherwise(min(1.0, per_class / n.get(0, 1)))
    chosen = clean.where(spot(salt) < share)
    rows = keyed_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "y").agg(F.max("text").alias("text")).select("doc_id", "text", "y"), n


def fit(
    sample: DataFrame, n: dict[int, int] | None = None, strength: float = 1.0
) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """Weights over the hashed n-grams, their ratios, and the scale of scores, from rows (doc_id, text, y).

    n: how many rows each class has in all. The scale is that of their base
    rate, however the sample was drawn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for text in batch.column("text"):
                _, f = indicators([text.as_py()])
                cells.append(f.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(cells, pa.binary())], ["doc_id", "y", "f"]
            )

    got = sample.mapInArrow(run, "doc_id long, y int, f binary").toArrow()
    ids, y = np.asarray(got.column("doc_id")), np.asarray(got.column("y"))
    if len(set(y.tolist())) < 2:
        return None
    order = np.argsort(mixed(ids.astype(np.uint64)), kind="stable")  # by a hash, as labels may follow a period of the ids
    rows = [np.frombuffer(got.column("f")[int(i)].as_py(), np.int32) for i in order]
    ids, y = ids[order], y[order]
    for_scale = np.arange(len(y)) % 4 == 3  # a quarter sets the scale of scores only
    train, held = np.flatnonzero(~for_scale), np.flatnonzero(for_scale)
    counts = np.ones((2, 1 << BITS))
    for i in train:
        counts[y[i], rows[i]] += 1
    r = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    w = dual_descent([rows[i] for i in train], y[train] * 2.0 - 1, r, np.full(len(train), strength))
    if len(held) == 0 or len(set(y[held].tolist())) < 2:
        held = train
    a, b = platt(np.array([_margin(w, r, rows[i]) for i in held]), y[held], class_weights(y[held], n))
    return w.astype(np.float32), r.astype(np.float32), a, b


def _margin(w: np.ndarray, r: np.ndarray, f: np.ndarray) -> float:
    v = r[f].astype(float)
    norm = np.sqrt(v @ v)
    return float(w[f] @ v / norm + w[-1]) if norm else float(w[-1])


def score(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 5,
    held_out: int = 0,
    per_class: int = 2500,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every whole text, by a model of labels outside the held-out fold, in Arrow batches without a shuffle.

    About `per_class` labelled rows a class (the documented bound) fit the
    model: indicators of hashed n-grams are scaled by the classes' log-count
    ratios and a linear hinge-loss model is fitted by dual coordinate descent;
    a quarter of the sample sets the scale of scores. The weights, two arrays
    of 2^18, go to every task. Labels, lang, source and id are no inputs.

    Columns: doc_id, held_out, score, predicted (1 if score >= threshold).

    Defined results: null and empty texts have the score of no n-grams; without
    labels of both classes every score is 0.5; equal texts score equally; texts
    are read whole at any length; an id that docs repeats is learned from once;
    a null id is not held out; an empty table gives an empty table; other
    columns are ignored.
    """
    fold = doc_bucket(F.col("doc_id"), folds) != held_out
    model = fit(*labelled(docs, labels, label, fold, per_class, label, id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores),
                    pa.array((scores >= threshold).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    held = F.coalesce(doc_bucket(F.col("doc_id"), folds) == held_out, F.lit(False))
    rows = keyed_texts(docs, id_col, text_col).select("doc_id", held.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 5,
    held_out: int = 0,
    per_class: int = 2500,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all their columns, in one pass without a shuffle.

    The model is score()'s. Without labels of both classes every row stays.
    """
    fold = doc_bucket(F.col("doc_id"), folds) != held_out
    model = fit(*labelled(docs, labels, label, fold, per_class, label, id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch.column(text_col)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def _scores(found: tuple | None, texts: pa.Array) -> np.ndarray:
    scores = np.full(len(texts), 0.5)
    if found is not None:
        w, r, a, b = found
        weight, square = w[:-1] * r, r * r
        for at, part in text_runs(texts):
            d, f = indicators(part)
            top = np.bincount(d, weights=weight[f], minlength=len(part))
            norm = np.sqrt(np.bincount(d, weights=square[f], minlength=len(part)))
            margin = np.divide(top, norm, out=np.zeros(len(part)), where=norm > 0) + w[-1]
            scores[at : at + len(part)] = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
    return scores
