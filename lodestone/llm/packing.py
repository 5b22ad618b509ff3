"""Packing into training sequences: vector bin packing by the dot-product heuristic."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import keyed_texts, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"


def _encoder(vocabulary: str):
    """Byte-level BPE of a tokenizers file, run by tiktoken, whose ids are the same and come five times as fast.

    The vocabulary's added tokens are known; ids_of() says what they are inside a text.
    """
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(vocabulary), encoding="utf-8") as f:
        entries = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    added = {t["content"]: t["id"] for t in entries.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in entries["model"]["vocab"].items() if t not in added}
    return tiktoken.Encoding(
        vocabulary.rsplit("/", 1)[-1], pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


_ENCODERS: dict = {}


def encoder(vocabulary: str = VOCABULARY):
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = _encoder(vocabulary)
    return _ENCODERS[vocabulary]


def ids_of(coder, text: str, added_tokens: bool) -> np.ndarray:
    """Ids of a text. Strings of added tokens are those tokens, as by the library's default, or else ordinary text."""
    return coder.encode_to_numpy(text, allowed_special="all" if added_tokens else set(), disallowed_special=())


@dataclass
class Limits:
    """What one sequence holds at most. min_piece: no example is cut to fill fewer tokens than that.

    As many segments as tokens let the shortest examples fill a sequence.
    """

    tokens: int = 1024
    segments: int = 1024
    loss: int = 1024
    min_piece: int = 8


@dataclass
class Piece:
    """A run of an example's tokens: where it starts there, and how many of its tokens bear loss."""

    key: int
    start: int
    tokens: int
    loss_before: np.ndarray | None = field(repr=False, default=None)

    @property
    def loss(self) -> int:
        if self.loss_before is None:
            return self.tokens
        return int(self.loss_before[self.start + self.tokens] - self.loss_before[self.start])

    def cut(self, tokens: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.key, self.start, tokens, self.loss_before),
            Piece(self.key, self.start + tokens, self.tokens - tokens, self.loss_before),
        )

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest prefix within both limits."""
        tokens = min(tokens, self.tokens)
        if self.loss_before is None:
            return min(tokens, loss)
        bound = self.loss_before[self.start] + loss
        return min(tokens, int(np.searchsorted(self.loss_before, bound, side="right")) - 1 - self.start)


def pack_pieces(items: list[Piece], limits: Limits, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences of pieces, and what is left over for the next call (nothing, if last).

    For the open sequence, of all examples that fit the room left in tokens,
    segments and loss-bearing tokens, the one with the largest dot product of
    its needs and that room goes in; ties go to the earlier one. Where nothing
    fits whole, the largest example is cut to fill the room. The last sequences
    are cut at powers of two, which need no padding, whatever a piece's size.
    """
    least = min(limits.min_piece, limits.tokens, limits.loss)
    caps = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
    pool, sequences = sorted(items, key=lambda p: -p.tokens), []
    left = sum(p.tokens for p in pool)
    left_loss = sum(p.loss for p in pool)
    while pool and (last or left >= 4 * limits.tokens):
        need = np.array([[p.tokens, 1, p.loss] for p in pool], dtype=float)
        free = np.ones(len(pool), dtype=bool)
        scaled = need / caps
        while True:  # one sequence a turn; the arrays are made anew when half of the pool has gone
            target = limits.tokens
            if last and left < limits.tokens and left_loss <= limits.loss:
                target = 1 << (left.bit_length() - 1)
            room = np.array([target, limits.segments, limits.loss], dtype=float)
            sequence: list[Piece] = []
            while room[0] > 0 and room[1] > 0 and free.any():
                fits = free & (need <= room).all(axis=1)
                if fits.any():
                    k = int(np.argmax(np.where(fits, scaled @ (room / caps), -1.0)))
                    piece, free[k] = pool[k], False
                else:
                    k = int(np.argmax(np.where(free, need[:, 0], -1.0)))
                    size = pool[k].fitting(int(room[0]), int(room[2]))
                    if size < (least if target == limits.tokens else 1) or size < 1:
                        break
                    piece, pool[k] = pool[k].cut(size)
                    need[k] = [pool[k].tokens, 1, pool[k].loss]
                    scaled[k] = need[k] / caps
                room -= [piece.tokens, 1, piece.loss]
                sequence.append(piece)
            if not sequence:
                raise ValueError("no example fits an empty sequence")
            sequences.append(sequence)
            left -= sum(p.tokens for p in sequence)
            left_loss -= sum(p.loss for p in sequence)
            if not free.any() or free.sum() * 2 < len(pool) or not (last or left >= 4 * limits.tokens):
                break
        pool = [p for p, f in zip(pool, free, strict=True) if f]
    return sequences, pool


def _crc(tokens: np.ndarray, start: int, length: int) -> int:
    return zlib.crc32(tokens[start : start + length].tobytes())


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    limits: Limits = Limits(),  # noqa: B008
    end_id: int = 0,
    loss_from_col: str | None = None,
    buffered: int = 1024,
    with_ids: bool = False,
    added_tokens: bool = True,
) -> DataFrame:
    """Pack every text, each scan partition by itself and without a shuffle: one row a piece.

    An example is the ids of its text, then end_id. Runs of limits.tokens that
    bear no more loss than a sequence may are sequences of their own; the rest
    of each example is packed with others, `buffered` at a time, under the
    limits on tokens, segments and loss-bearing tokens. loss_from_col counts the
    characters at the head of a text, its prompt, whose tokens bear no loss;
    without it every token bears loss. added_tokens: whether strings of the
    vocabulary's added tokens are those tokens, as the library reads them, or
    ordinary text.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset;
    with_ids adds ids (array of int). Sequence ids hold the partition's number,
    so a task that runs again gives the same ones.

    Defined results: null and empty texts are end_id alone; long texts are
    encoded whole and cut at limits.tokens; of equal dot products the longer
    example, then the earlier goes first; repeated rows are packed each; an
    empty table gives an empty table; other columns are ignored.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("limits must be positive")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" * with_ids
    rows = keyed_texts(docs, id_col, text_col)
    if loss_from_col is not None:
        rows = docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
            F.coalesce(F.col(loss_from_col), F.lit(0)).cast("int").alias("head"),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = encoder(vocabulary)
        state = {"next": TaskContext.get().partitionId() << 33, "key": 0}
        held: dict[int, tuple[int | None, np.ndarray, int]] = {}  # of each example with a piece not yet out
        pool: list[Piece] = []
        out: list[tuple] = []

        def emit(sequence: list[Piece]) -> None:
            offset = 0
            for p in sequence:
                doc, tokens, size = held[p.key]
                row = (doc, p.start, p.tokens, _crc(tokens, p.start, p.tokens), size, state["next"], offset)
                out.append((*row, tokens[p.start : p.start + p.tokens]) if with_ids else row)
                offset += p.tokens
            state["next"] += 1

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(7)]
            if with_ids:
                names.append("ids")
                ends = np.cumsum([0] + [len(r[7]) for r in rows]).astype(np.int32)
                flat = np.concatenate([r[7] for r in rows]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            return pa.RecordBatch.from_arrays(columns, names)

        def settle(last: bool) -> None:
            nonlocal pool
            sequences, pool = pack_pieces(pool, limits, last)
            for s in sequences:
                emit(s)
            keep = {p.key for p in pool}
            for key in [k for k in held if k not in keep]:
                del held[key]

        for batch in batches:
            heads = batch.column("head") if loss_from_col is not None else None
            for n, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)):
                text = text.as_py()
                ids = ids_of(coder, text, added_tokens)
                tokens = np.empty(len(ids) + 1, dtype="<u4")
                tokens[:-1], tokens[-1] = ids, end_id
                key = state["key"] = state["key"] + 1
                held[key] = (doc, tokens, len(tokens))
                loss = None
                if heads is not None:
                    first = len(ids_of(coder, text[: heads[n].as_py()], added_tokens))
                    loss = np.maximum(0, np.arange(len(tokens) + 1) - first)
                rest = Piece(key, 0, len(tokens), loss)
                while rest.tokens >= limits.tokens:
                    size = rest.fitting(limits.tokens, limits.loss)
                    if size < limits.tokens:
                        break
                    piece, rest = rest.cut(size)
                    emit([piece])
                if rest.tokens:
                    pool.append(rest)
                else:
                    del held[key]
                if len(pool) >= buffered:
                    settle(False)
                if len(out) >= 20_000 or with_ids and len(out) >= 1_000:
                    yield batch_of(out)
                    out.clear()
        settle(True)
        if out:
            yield batch_of(out)

    return rows.mapInArrow(run, schema)
