"""Cross-tokenizer alignment by union-find over the overlapping tokens of two vocabularies."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.exact_dedup import ROW, numbered
from lodestone.llm.packing import VOCABULARY, encoder, ids_of
from lodestone.llm.piece_codec import MODEL, codec
from lodestone.llm.shared import small_batches, staged

#: Bits of an id within a pair of ids.
_BITS = 20
#: Pairs counted in a task before they go out.
_COUNTED = 2_000_000
#: Pairs whose counts every task holds; the others are joined.
HEAD = 1 << 20
#: Bytes of a row group of the written ids, which each writer and reader holds.
_ROW_GROUP = 16 << 20
#: Steps of the histogram of counts for each doubling.
_STEPS = 8


class Coders:
    """The two tokenizers and the bytes of their ids."""

    def __init__(self, vocabulary: str, model: str):
        self.a, self.b = encoder(vocabulary), codec(model)
        special = set(self.a._special_tokens.values())
        known = {self.a.encode_single_token(t) for t in self.a.token_byte_values()}
        size = max(known | special) + 1
        self.a_sizes = np.array([len(self.a.decode_single_token_bytes(i)) if i in known else 0 for i in range(size)], np.int64)
        self.b_bytes = self.b.said
        self.b_sizes = np.array([len(b) for b in self.b_bytes], np.int64)
        if max(len(self.a_sizes), len(self.b_sizes)) >= 1 << _BITS:
            raise ValueError(f"ids of more than {_BITS} bits")
        #: How ids are written: the narrowest kind that holds those of both sides.
        self.kind = "<u2" if max(len(self.a_sizes), len(self.b_sizes)) <= 1 << 16 else "<u4"
        self.a_said, self.b_said = (_said(len(sizes), end) for sizes, end in ((self.a_sizes, "|"), (self.b_sizes, ";")))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text in both vocabularies; of texts that either of them does not give back, none."""
        nothing = np.empty(0, np.int64)
        a_ids, b_ids = [], []
        for text, b in zip(texts, self.b.library.encode(texts, num_threads=1), strict=True):
            whole = (" " + text).encode()
            if text and b"".join(map(self.b_bytes.__getitem__, b)) == whole:
                a = ids_of(self.a, " " + text, False).astype(np.int64)
                if int(self.a_sizes[a].sum()) == len(whole):
                    a_ids.append(a)
                    b_ids.append(np.array(b, np.int64))
                    continue
            a_ids.append(nothing)
            b_ids.append(nothing)
        return a_ids, b_ids


def _said(size: int, end: str) -> np.ndarray:
    """Bytes of each id in decimals: before a comma, and from `size` on before `end`."""
    return np.array([f"{i}{mark}".encode() for mark in (",", end) for i in range(size)])


_CODERS: dict[tuple[str, str], Coders] = {}


def coders(vocabulary: str, model: str) -> Coders:
    """One pair of tokenizers for each worker process."""
    if (vocabulary, model) not in _CODERS:
        _CODERS[vocabulary, model] = Coders(vocabulary, model)
    return _CODERS[vocabulary, model]


@dataclass
class Graph:
    """The overlapping tokens of a run of documents: A's tokens are nodes 0 to n_a - 1, B's the ones after.

    Of two tokens that share a byte, the one that starts later starts inside
    the other. So the edges are: each token and the other side's token around
    its first byte; where both start together that is one edge.
    """

    a_starts: np.ndarray
    b_starts: np.ndarray

    def __post_init__(self):
        self.around_a = np.searchsorted(self.b_starts, self.a_starts, side="right") - 1
        self.around_b = np.searchsorted(self.a_starts, self.b_starts, side="right") - 1
        self.apart = self.a_starts[self.around_b] != self.b_starts if len(self.a_starts) else np.empty(0, bool)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Every A-B pair of tokens whose byte ranges overlap, once."""
        own = np.arange(len(self.a_starts))
        late = np.flatnonzero(self.apart)
        return np.concatenate([own, self.around_b[late]]), np.concatenate([self.around_a, late])

    def components(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the components of A's and of B's tokens, in the order of the text.

        Union-find: a token is hooked to the one around its first byte, a
        pair that starts together to its A token; then all paths are halved
        until each token points at its root.
        """
        n = len(self.a_starts)
        parent = np.arange(n + len(self.b_starts))
        inside = np.flatnonzero(self.b_starts[self.around_a] < self.a_starts) if n else np.empty(0, int)
        parent[inside] = n + self.around_a[inside]
        parent[n:] = self.around_b
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent = above
        number = np.cumsum(parent[:n] == np.arange(n)) - 1
        return number[parent[:n]], number[parent[n:]]


def _starts(sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the tokens of documents that stand one behind the other, and how many tokens each has."""
    flat = np.concatenate([np.empty(0, np.int64), *sizes])
    return np.cumsum(flat) - flat, np.array([len(s) for s in sizes])


def graph_of(a_ids: list[np.ndarray], b_ids: list[np.ndarray], c: Coders) -> tuple[Graph, np.ndarray, np.ndarray]:
    """The graph of a run of documents, and their numbers of A and of B tokens."""
    a_starts, n_a = _starts([c.a_sizes[ids] for ids in a_ids])
    b_starts, n_b = _starts([c.b_sizes[ids] for ids in b_ids])
    return Graph(a_starts, b_starts), n_a, n_b


def _in_each(marks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of marks over consecutive runs of these sizes."""
    sums = np.concatenate([[0], np.cumsum(marks)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def groups_of(a_ids: list[np.ndarray], b_ids: list[np.ndarray], c: Coders) -> Iterator[tuple[int, int, int, int, bytes]]:
    """Of each document: A tokens, B tokens, groups, links and the groups as text, `a1,a2|b1;a3|b2,b3`."""
    graph, n_a, n_b = graph_of(a_ids, b_ids, c)
    in_a, in_b = graph.components()
    n = int(in_a[-1]) + 1 if len(in_a) else 0
    first = np.diff(in_a, prepend=-1) > 0
    last_a, last_b = np.diff(in_a, append=n) > 0, np.diff(in_b, append=n) > 0
    of_a, of_b = np.bincount(in_a, minlength=n), np.bincount(in_b, minlength=n)
    a_place = np.arange(len(in_a)) + (np.cumsum(of_b) - of_b)[in_a]
    b_place = np.arange(len(in_b)) + np.cumsum(of_a)[in_b]
    said = np.zeros(len(in_a) + len(in_b), dtype=max(c.a_said.dtype, c.b_said.dtype, key=lambda t: t.itemsize))
    said[a_place] = c.a_said[np.concatenate([np.empty(0, np.int64), *a_ids]) + len(c.a_sizes) * last_a]
    said[b_place] = c.b_said[np.concatenate([np.empty(0, np.int64), *b_ids]) + len(c.b_sizes) * last_b]
    signs = said.view(np.uint8).reshape(len(said), -1)
    sizes = _in_each((signs != 0).sum(axis=1), n_a + n_b)
    flat = signs[signs != 0].tobytes()
    n_groups = _in_each(first, n_a)
    n_links = n_a + _in_each(graph.apart, n_b)
    ends = np.cumsum(sizes)
    for k in range(len(n_a)):
        yield int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), flat[ends[k] - sizes[k] : max(ends[k] - 1, 0)]


def pairs_of(a_ids: list[np.ndarray], b_ids: list[np.ndarray], c: Coders) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, pair of ids and number of links, once for each pair that a document holds linked."""
    graph, n_a, _ = graph_of(a_ids, b_ids, c)
    i, j = graph.links()
    if not len(i):
        return (np.empty(0, np.int64),) * 3
    a, b = np.concatenate(a_ids), np.concatenate(b_ids)
    doc = np.repeat(np.arange(len(n_a)), n_a)
    keys, times = np.unique((doc[i] << 2 * _BITS) | (a[i] << _BITS) | b[j], return_counts=True)
    return keys >> 2 * _BITS, keys & ((1 << 2 * _BITS) - 1), times


def _runs(batch: pa.RecordBatch, *columns: str, size: int = 300_000) -> Iterator[tuple[int, list[list]]]:
    """Runs of rows with so many characters or bytes, and the place of their first."""
    run, held, first = [[] for _ in columns], 0, 0
    for n in range(batch.num_rows):
        for kept, column in zip(run, columns, strict=True):
            kept.append(batch.column(column)[n].as_py())
        held += len(run[0][-1])
        if held >= size:
            yield first, run
            run, held, first = [[] for _ in columns], 0, n + 1
    if run[0]:
        yield first, run


def _ids(raw: list[bytes], c: Coders) -> list[np.ndarray]:
    return [np.frombuffer(r, c.kind).astype(np.int64) for r in raw]


def aligned(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, model: str) -> DataFrame:
    """One row per document: its counts, the digest of its groups, the groups, and the ids of both sides as bytes."""
    rows = numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coders(vocabulary, model)
        for batch in batches:
            for first, (texts,) in _runs(batch, "text"):
                a_ids, b_ids = c.encode(texts)
                counts, digests = [], []
                for *n, groups in groups_of(a_ids, b_ids, c):
                    counts.append(n)
                    digests.append(hashlib.sha256(groups).hexdigest() if n[0] else "")
                table = np.array(counts, np.int64).reshape(-1, 4)
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(ROW),
                        part.column("doc_id"),
                        *(pa.array(table[:, k]) for k in range(4)),
                        pa.array(digests, pa.string()),
                        *(pa.array([ids.astype(c.kind).tobytes() for ids in side], pa.binary()) for side in (a_ids, b_ids)),
                    ],
                    [ROW, "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b"],
                )

    schema = f"{ROW} long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary"
    return rows.mapInArrow(run, schema)


def pair_counts(encoded: DataFrame, vocabulary: str = VOCABULARY, model: str = MODEL) -> DataFrame:
    """pair (A's id above B's), n (documents that hold it linked) and best (no pair of A's id has more).

    Tasks add up their documents' pairs before they go out, Spark the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coders(vocabulary, model)
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate([np.empty(0, np.int64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

        for batch in batches:
            for _, (a, b) in _runs(batch, "a", "b"):
                held.append(pairs_of(_ids(a, c), _ids(b, c), c)[1])
                if sum(map(len, held)) > _COUNTED:
                    yield out()
        yield out()

    counted = encoded.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = staged(counted, "pairs")
    a = F.shiftright("pair", _BITS)
    best = counted.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counted.withColumn("a", a).join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def head_bound(counts: DataFrame, head: int) -> int:
    """The least count from which on no more than `head` pairs have it; from a histogram of at most 8 steps a doubling."""
    step = F.floor(F.log2("n") * _STEPS).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least"))
    bound, held = None, 0
    for row in sizes.orderBy(F.desc("step")).collect():
        held += row["pairs"]
        if held > head:
            return row["least"] + 1 if bound is None else bound
        bound = row["least"]
    return 1


def _told(encoded: DataFrame, counts: DataFrame, head: int, vocabulary: str, model: str) -> DataFrame:
    """ROW, n_best and count_sum of every document with tokens.

    The counts of the most frequent pairs, at most `head` of them, go to every
    task; the links of all other pairs meet their counts in a join. No pair of
    those stands in more than one of `head` parts of what all documents hold.
    """
    bound = head_bound(counts, head)
    top = counts.where(F.col("n") >= bound).toArrow().sort_by("pair")
    known = tuple(top.column(k).to_numpy() for k in ("pair", "n", "best"))
    sent = encoded.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coders(vocabulary, model)
        pairs, n, best = sent.value
        for batch in batches:
            for first, (a, b) in _runs(batch, "a", "b"):
                doc, pair, times = pairs_of(_ids(a, c), _ids(b, c), c)
                at = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
                hit = pairs[at] == pair if len(pairs) else np.zeros(len(pair), bool)
                docs = len(a)
                sums = np.zeros((2, docs), np.int64)
                ends = np.searchsorted(doc, np.arange(docs), side="right")
                size = np.diff(ends, prepend=0)
                sums[0] = _in_each(np.where(hit, times * best[at] if len(pairs) else 0, 0), size)
                sums[1] = _in_each(np.where(hit, times * n[at] if len(pairs) else 0, 0), size)
                rest = np.flatnonzero(~hit)
                offsets = np.concatenate([[0], np.cumsum(_in_each(~hit, size))]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x[rest])) for x in (pair, times)]
                rows = batch.slice(first, docs).column(ROW)
                yield pa.RecordBatch.from_arrays([rows, pa.array(sums[0]), pa.array(sums[1]), *lists], [ROW, "n_best", "count_sum", "pairs", "times"])

    told = encoded.where("n_a > 0").select(ROW, "a", "b").mapInArrow(run, f"{ROW} long, n_best long, count_sum long, pairs array<long>, times array<long>")
    if bound <= 1:
        return staged(told.select(ROW, "n_best", "count_sum"), "told")
    told = staged(told, "told")
    rest = told.select(ROW, F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(ROW, F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    rest = rest.join(counts.where(F.col("n") < bound), "pair").select(
        ROW, (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")
    )
    sums = [F.sum(x).alias(x) for x in ("n_best", "count_sum")]
    return told.select(ROW, "n_best", "count_sum").unionAll(rest).groupBy(ROW).agg(*sums)


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    model: str = MODEL,
    head: int = HEAD,
) -> DataFrame:
    """Align the tokens of two vocabularies in every whole text and count the pairs of ids that are linked.

    A is a byte-level vocabulary (on a space and the text), B a SentencePiece
    model (which puts the space itself). Tokens of A and B that share a byte
    are linked; the components of that graph, by union-find, are the minimal
    groups. Each text is encoded once, in Arrow batches, and written with its
    ids; members of components are expanded to links from there, once for
    counting the pairs over the corpus, once for telling each document. All
    three passes run before this returns, in small batches.

    Columns: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is
    the highest of their A id), count_sum (of the counts of all links),
    groups_sha256.

    Defined results: texts that are null or empty, or that either vocabulary
    does not give back byte by byte, have no tokens: zeros and ''; strings of
    special tokens are plain text; ties for the highest count all are; long
    texts are aligned whole, a text at a time in memory; repeated rows and null
    ids are rows of their own, and each counts; an empty table gives an empty
    table; other columns are ignored.
    """
    with small_batches(docs.sparkSession):
        encoded = staged(aligned(docs, id_col, text_col, vocabulary, model), "aligned", **{"parquet.block.size": _ROW_GROUP})
        counts = staged(pair_counts(encoded, vocabulary, model), "counts")
        told = _told(encoded, counts, head, vocabulary, model)
    zero = F.lit(0).cast("long")
    return encoded.drop("a", "b").join(told, ROW, "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, model: str = MODEL) -> DataFrame:
    """doc_id and the aligned groups themselves, an array of (a, b), each the ids of a group in order.

    Defined results are align()'s; a text without tokens has no groups.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coders(vocabulary, model)
        for batch in batches:
            for first, (texts,) in _runs(batch, "text"):
                said = [flat.decode() for *_, flat in groups_of(*c.encode(texts), c)]
                yield pa.RecordBatch.from_arrays([batch.slice(first, len(texts)).column("doc_id"), pa.array(said, pa.string())], ["doc_id", "said"])

    side = lambda g, k: F.transform(F.split(F.split(g, r"\|")[k], ","), lambda x: x.cast("int"))
    found = F.transform(F.split("said", ";"), lambda g: F.struct(side(g, 0).alias("a"), side(g, 1).alias("b")))
    none = F.array().cast("array<struct<a:array<int>,b:array<int>>>")
    return rows.mapInArrow(run, "doc_id long, said string").select("doc_id", F.when(F.col("said") == "", none).otherwise(found).alias("groups"))
