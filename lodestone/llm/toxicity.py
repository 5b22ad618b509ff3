"""Toxicity by class-conditional Kneser-Ney models of words and their letters."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.quality import class_counts, class_weights, clean_labels, spot
from lodestone.llm.shared import doc_bucket, keyed_texts

_WORD = re.compile(r"[^\W\d_]+")
_BEGIN, _END = "\x02", "\x03"
_CACHED_WORDS = 400_000
_COUNTED = 200_000
_DISCOUNT = 0.75
ORDER = 6
#: How much less likely, in nats, a word of a toxic text is to come from the toxic model than from the ordinary one.
MARGIN = 2.0
#: The length-normalised lead of the toxic likelihood that counts as half of the evidence there can be.
HALF = 0.3


@dataclass
class Pair:
    """Two letter models of order `order` within words: class-conditional counts over a shared backoff.

    At the highest order each class has its own counts; what they discount
    goes to lower orders whose continuation counts both classes share, so that
    an expression that one class lacks is likened to the same neighbours in both.
    """

    order: int
    own: tuple[dict, dict]  # of each class: n-gram -> log probability under the class, for n-grams it has
    back: tuple[dict, dict]  # of each class: context -> log of the mass that backs off, for contexts it has
    shared: dict  # shorter n-gram -> log probability
    shared_back: dict  # shorter context -> log of the mass that backs off
    floor: float

    def lower(self, gram: str) -> float:
        """Log probability of the last letter after the others, by the shared counts."""
        mass = 0.0
        while gram:
            if (p := self.shared.get(gram)) is not None:
                return mass + p
            mass += self.shared_back.get(gram[:-1], 0.0)
            gram = gram[1:]
        return mass + self.floor

    def leans(self) -> tuple[dict[str, float], dict[str, float]]:
        """Log-likelihood ratios, toxic over ordinary: of each n-gram that a class has, and of the others of each context.

        Where neither class has an n-gram, both give it the same backoff, which cancels out.
        """
        grams = {}
        for gram in self.own[0].keys() | self.own[1].keys():
            base = None
            ratio = 0.0
            for c, sign in ((1, 1.0), (0, -1.0)):
                if (p := self.own[c].get(gram)) is None:
                    base = self.lower(gram[1:]) if base is None else base
                    p = self.back[c].get(gram[:-1], 0.0) + base
                ratio += sign * p
            grams[gram] = ratio
        contexts = self.back[0].keys() | self.back[1].keys()
        return grams, {c: self.back[1].get(c, 0.0) - self.back[0].get(c, 0.0) for c in contexts}


def letter_grams(word: str, order: int) -> list[str]:
    """What each letter and the end of a word are counted under: the letter after up to order - 1 others."""
    padded = _BEGIN + word + _END
    return [padded[max(0, i - order + 1) : i + 1] for i in range(1, len(padded))]


def kneser_ney(words: tuple[Counter, Counter], order: int = ORDER, discounts: tuple[float, ...] = (1.0, 1.8, 2.5)) -> Pair:
    """The pair of models of ordinary (0) and toxic (1) word counts."""
    top = (Counter(), Counter())
    for c in (0, 1):
        for word, n in words[c].items():
            for gram in letter_grams(word, order):
                top[c][gram] += n
    return of_grams(top, order, discounts)


def of_grams(top: tuple[Counter, Counter], order: int = ORDER, discounts: tuple[float, ...] = (1.0, 1.8, 2.5)) -> Pair:
    """The pair of models of ordinary (0) and toxic (1) counts of letter_grams().

    discounts: what an n-gram of count 1, 2, 3 or more gives up to the backoff.
    One that a class has once gives up all: a chance hit says nothing. Lower
    orders count, in either class, after how many different letters (or word
    beginnings) an n-gram stands.
    """
    seen = {gram[k:] for c in (0, 1) for gram in top[c] for k in range(len(gram))}
    continued = Counter(gram[1:] for gram in seen if len(gram) > 1)
    del seen
    sums: Counter = Counter()
    kinds: Counter = Counter()
    for gram, n in continued.items():
        sums[gram[:-1]] += n
        kinds[gram[:-1]] += 1
    letters = kinds[""] + 1  # one for all that was never seen
    prob: dict[str, float] = {}
    for gram in sorted(continued, key=len):
        context = gram[:-1]
        rest = _DISCOUNT * kinds[context] / sums[context]
        under = prob[gram[1:]] if len(gram) > 1 else 1 / letters
        prob[gram] = (continued[gram] - _DISCOUNT) / sums[context] + rest * under
    shared = {g: float(np.log(p)) for g, p in prob.items()}
    shared_back = {c: float(np.log(_DISCOUNT * kinds[c] / sums[c])) for c in sums}
    pair = Pair(order, ({}, {}), ({}, {}), shared, shared_back, float(np.log(1 / letters)))
    for c in (0, 1):
        total: Counter = Counter()
        taken: Counter = Counter()
        for gram, n in top[c].items():
            total[gram[:-1]] += n
            taken[gram[:-1]] += discounts[min(n, len(discounts)) - 1]
        for context in total:
            pair.back[c][context] = float(np.log(taken[context] / total[context]))
        for gram, n in top[c].items():
            context = gram[:-1]
            own = (n - discounts[min(n, len(discounts)) - 1]) / total[context]
            if own > 0:  # else the backoff says the same
                under = np.exp(pair.lower(gram[1:]) + pair.back[c][context])
                pair.own[c][gram] = float(np.log(own + under))
    return pair


def evidence(ratios: np.ndarray, margin: float = MARGIN) -> float:
    """How much better a text's different words are explained as toxic, over the root of their number, from 0 to 1.

    ratios: log-likelihoods of the words as toxic less those as ordinary. Most
    words of a toxic text are ordinary ones: under it a word is as likely as the
    better of the ordinary model and, by `margin` nats less, the toxic one.
    """
    if not len(ratios):
        return 0.0
    lead = float(np.maximum(ratios - margin, 0).sum()) / len(ratios) ** 0.5
    return lead / (lead + HALF)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the last is the bias), means and scales of a small logistic model, by Newton steps."""
    weight = np.ones(len(x)) if weight is None else weight
    mean = np.average(x, axis=0, weights=weight)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weight)) + 1e-6
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - y)) + ridge * len(x) / 100 * w
        hess = (z * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ z + np.eye(len(w)) * ridge * len(x) / 100
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w, mean, scale


@dataclass
class Model:
    """What a task needs of the two models, and the scale, slope and bias, that turns a text's evidence into a score."""

    grams: dict[str, float]
    contexts: dict[str, float]
    order: int
    slope: float = 0.0
    bias: float = 0.0

    def __post_init__(self):
        self.cache: dict[str, float] = {}

    def ratio(self, word: str) -> float:
        """Log-likelihood ratio of a word, toxic over ordinary."""
        total = 0.0
        for gram in letter_grams(word, self.order):
            lean = self.grams.get(gram)
            total += self.contexts.get(gram[:-1], 0.0) if lean is None else lean
        return total

    def evidence(self, text: str) -> float:
        words = set(_WORD.findall(text.lower()))
        cache = self.cache
        if len(cache) > _CACHED_WORDS:
            cache.clear()
        for word in words.difference(cache):
            cache[word] = self.ratio(word)
        return evidence(np.fromiter((cache[w] for w in sorted(words)), float, len(words)))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.evidence(text) + self.bias, -30, 30))))


def gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """gram and n0 to n3: in how many texts of rows (text, slot) of slot 0 to 3 a word with it is, over all such words."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            arrays = [pa.array([w for w, _ in counts], pa.string()), pa.array([k for _, k in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, ["word", "slot", "n"])

        for batch in batches:
            for text, slot in zip(batch.column("text"), batch.column("slot").to_pylist(), strict=True):
                counts.update((word, slot) for word in set(_WORD.findall(text.as_py().lower())))
                if len(counts) > _COUNTED:
                    yield out()
        yield out()

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            table = np.array(list(counts.values()), np.int64).reshape(-1, 4)
            arrays = [pa.array(list(counts), pa.string()), *(pa.array(table[:, k]) for k in range(4))]
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, ["gram", "n0", "n1", "n2", "n3"])

        for batch in batches:
            each = np.stack([batch.column(f"n{k}").to_numpy() for k in range(4)], axis=1)
            for word, n in zip(batch.column("word").to_pylist(), each, strict=True):
                for gram in letter_grams(word, order):
                    counts[gram] = counts[gram] + n if gram in counts else n
                if len(counts) > _COUNTED:
                    yield out()
        yield out()

    slots = [F.sum(F.when(F.col("slot") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)]
    counted = rows.mapInArrow(words, "word string, slot int, n long").groupBy("word").agg(*slots)
    counted = counted.mapInArrow(grams, "gram string, n0 long, n1 long, n2 long, n3 long")
    return counted.groupBy("gram").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(4)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    fold: Column,
    per_class: int,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model | None:
    """The model of all labelled rows that `fold` keeps.

    N-grams are counted over every row, by Spark. The scale of scores comes from
    up to per_class / 3 ids a class, a third of few, under letter models of all
    other rows; only their evidence, a number each, comes to the driver.
    """
    clean = clean_labels(labels, label, fold)
    n = class_counts(clean)
    if len(n) < 2:
        return None
    share = {y: min(1.0, per_class / n[y]) / 3 for y in n}
    held = spot(label) < F.when(F.col("y") == 1, share[1]).otherwise(share[0])
    # the fold spares the join the texts of other ids; labels grow with the input, so the join is a merge at any size
    rows = keyed_texts(docs, id_col, text_col).where(fold).join(clean.withColumn("held", held).hint("merge"), "doc_id")
    got = gram_counts(rows.select("text", (F.col("held").cast("int") * 2 + F.col("y")).alias("slot")), order).toArrow()
    got = got.sort_by("gram")
    names = got.column("gram").to_pylist()
    table = np.stack([got.column(f"n{k}").to_numpy() for k in range(4)])
    del got

    def models(counts: np.ndarray) -> Pair:
        return of_grams(tuple(Counter({names[i]: int(c[i]) for i in np.flatnonzero(c)}) for c in counts), order)

    if not table[:2].any(axis=1).all():
        return None
    model = Model(*models(table[:2]).leans(), order)
    x, y = evidence_of(docs, clean.where(held), model, id_col, text_col)
    if len(set(y.tolist())) < 2:  # too few rows to hold any out
        some = spot(label) < F.when(F.col("y") == 1, 3 * share[1]).otherwise(3 * share[0])
        x, y = evidence_of(docs, clean.where(some), model, id_col, text_col)
        if len(set(y.tolist())) < 2:
            return None
    (weight, bias), mean, scale = logistic(x[:, None], y, weight=class_weights(y, n))
    slope = float(weight / scale[0])
    return Model(*models(table[:2] + table[2:]).leans(), order, slope, float(bias) - slope * float(mean[0]))


def evidence_of(docs: DataFrame, chosen: DataFrame, model: Model, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Evidence and class of the texts of a bounded number of chosen ids (doc_id, y), in order of id."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shared.value.evidence(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(x, pa.float64())], ["doc_id", "y", "x"])

    rows = keyed_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")
    found = rows.mapInArrow(run, "doc_id long, y int, x double").groupBy("doc_id", "y").agg(F.max("x").alias("x"))
    got = sorted((r["doc_id"], r["y"], r["x"]) for r in found.collect())
    shared.destroy()
    return np.array([x for *_, x in got]), np.array([y for _, y, _ in got], dtype=float)


def score(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 3,
    held_out: int = 1,
    per_class: int = 2000,
    threshold: float = 0.7,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score every whole text by toxic against ordinary log-likelihoods, from labels outside the held-out fold.

    All labelled rows are counted for the two Kneser-Ney models. Of each text
    the two length-normalised log-likelihoods make one number, evidence(); a
    slope and a bias, fitted on about `per_class` / 3 ids a class (the
    documented bound), make it a score. The model goes to every task: its size
    is that of the different n-grams of letters within words, not of the words.
    Texts are scored in Arrow batches without a shuffle. Labels, lang, source
    and id are no inputs.

    Columns: doc_id, held_out, score, predicted (1 if score >= threshold).

    Defined results: null, empty and wordless texts have no evidence; a word
    counts once a text, so long texts are read whole and in bounded memory;
    without labels of both classes every score is 0; equal texts score equally;
    a labelled id that docs repeats counts with every row; a null id is not
    held out; an empty table gives an empty table; other columns are ignored.
    """
    fold = doc_bucket(F.col("doc_id"), folds) != held_out
    model = fit(docs, labels, label, fold, per_class, order, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            scores = np.array([found.score(t.as_py()) if found else 0.0 for t in batch.column("text")], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    held = F.coalesce(doc_bucket(F.col("doc_id"), folds) == held_out, F.lit(False))
    rows = keyed_texts(docs, id_col, text_col).select("doc_id", held.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
