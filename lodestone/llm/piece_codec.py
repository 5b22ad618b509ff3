"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies."""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain, pairwise, repeat
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lodestone.llm.shared import keyed_texts, vocabulary_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: What can merge inside: letters, other marks, each with the spaces before it; lone spaces; one digit. Words of ASCII
#: letters come first only because their class is quicker to match.
_FINE = re.compile(
    f"{SPACE}?[a-zA-Z]++(?![^\\W\\d_])|{SPACE}*[^\\W\\d_]+|{SPACE}*(?:[^\\w{SPACE}]|_)+|{SPACE}+|\\d"
)
#: Spaces and what follows them, always sound where no piece holds a space after another sign.
_COARSE = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_CACHED_CHARS = 40
#: In each of the two generations of the cache.
_CACHED_SEGMENTS = 300_000
#: Up to so many signs an agenda is quicker to scan than to keep as a heap.
_SCANNED_SIGNS = 64


class Codec:
    """Encoder and decoder of one BPE model file with identity normalisation and byte fallback.

    A text is cut where no piece of the vocabulary spans the cut, so that no
    merge can cross it; each segment is then merged by itself and kept in a
    bounded cache of two generations, so that what is still in use outlives a
    full one. Of segments new to the cache both ways are compared with the
    library. Whole texts are decoded from their ids.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if lib.is_control(i) or lib.is_unknown(i)}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.special, self.bytes_of = special, {i: b for b, i in self.byte_ids.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special and i not in self.bytes_of}
        order = sorted({-lib.get_score(i) for i in self.ids.values()})
        place = {s: k for k, s in enumerate(order)}
        self.rank, self.unranked = {p: place[-lib.get_score(i)] for p, i in self.ids.items() if len(p) > 1}, len(order)
        if lib.normalize("A  ﬁ b ") != f"{SPACE}A{SPACE}{SPACE}ﬁ{SPACE}b{SPACE}":
            raise ValueError("only identity normalisation with a space put before the text is supported")
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("a piece has a space after another sign")
        crossing = {a + b for p in self.rank for a, b in zip(p, p[1:], strict=False) if len(_FINE.findall(a + b)) > 1}
        self.crossing = re.compile("|".join(map(re.escape, sorted(crossing)))) if crossing else None
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: What an id adds to a decoded text, in bytes.
        self.said = [
            b"" if i in special else bytes([self.bytes_of[i]]) if i in self.bytes_of else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.said_arrow = pa.array(self.said, pa.binary())
        #: By id: whether a text may start with it, and whether it then loses a space.
        self.heard = np.array([i not in special for i in range(size)])
        self.opening = np.array([self.ids.get(p) == i and p.startswith(SPACE) for i, p in enumerate(self.pieces)])

    def merge(self, segment: str) -> list[str]:
        """Symbols of a segment: an agenda of adjacent pairs gives the best score first, ties leftmost."""
        return self._merge_scanned(segment) if len(segment) <= _SCANNED_SIGNS else self._merge_heaped(segment)

    def _merge_scanned(self, segment: str) -> list[str]:
        """The agenda is a list with the rank of each symbol and the next, by place."""
        rank, none = self.rank.get, self.unranked
        symbols = list(segment)
        agenda = list(map(rank, map(add, symbols, symbols[1:]), repeat(none)))
        agenda.append(none)
        while (best := min(agenda)) < none:
            i = agenda.index(best)
            symbols[i] = pair = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i + 1 < len(symbols):
                agenda[i] = rank(pair + symbols[i + 1], none)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + pair, none)
        return symbols

    def _merge_heaped(self, segment: str) -> list[str]:
        """The agenda is a heap, so that time doesn't grow with the square of the segment."""
        n = len(segment)
        rank = self.rank.get
        symbols, after, before = list(segment), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = segment[i : i + 2]
            if (r := rank(pair)) is not None:
                agenda.append((r, i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            j = after[i]
            if j >= n or not symbols[i] or len(symbols[i]) + len(symbols[j]) != len(pair):
                continue  # one of the two has been merged with another meanwhile
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(p := pair + symbols[k])) is not None:
                    heapq.heappush(agenda, (r, i, p))
            if (h := before[i]) >= 0 and (r := rank(p := symbols[h] + pair)) is not None:
                heapq.heappush(agenda, (r, h, p))
        return [s for s in symbols if s]

    def segment_ids(self, segment: str) -> list[int]:
        symbols = self.merge(segment)
        try:
            return [self.ids[symbol] for symbol in symbols]
        except KeyError:
            pass  # a sign outside the vocabulary is written in bytes
        out: list[int] = []
        for symbol in symbols:
            if (i := self.ids.get(symbol)) is not None:
                out.append(i)
            else:
                out.extend(self.byte_ids[b] for b in symbol.encode())
        return out

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        return (_COARSE if self.crossing and self.crossing.search(text) else _FINE).findall(text)

    def decode(self, ids: list[int]) -> str:
        return self.decode_many([np.array(ids, "<u4").tobytes()])[0]

    def decode_many(self, raws: list[bytes]) -> list[str]:
        """Texts of ids in little-endian uint32: specials vanish, runs of byte pieces are UTF-8, the first space is dropped."""
        ids = np.frombuffer(b"".join(raws), "<u4")
        edges = np.cumsum([0, *map(len, raws)]) // 4
        said = self.said_arrow.take(pa.array(ids))
        places = np.cumsum(pc.binary_length(pa.concat_arrays([pa.array([b""]), said])).to_numpy())[edges].tolist()
        heard = np.flatnonzero(self.heard[ids])
        first = np.append(heard, len(ids))[np.searchsorted(heard, edges[:-1])]
        opened = (first < edges[1:]) & np.append(self.opening[ids], False)[first]
        data = pc.binary_join(pa.ListArray.from_arrays([0, len(said)], said), b"")[0].as_py()
        return [
            data[a:b].decode(errors="replace")[skip:]
            for a, b, skip in zip(places, places[1:], opened.tolist(), strict=False)
        ]

    def check(self, found: dict[str, list[int]], raws: list[bytes]) -> None:
        """Compare segments with the library; those without a space before them are put behind a line break."""
        bare = [s for s in found if not s.startswith(SPACE)]
        lead = [s for s in found if s.startswith(SPACE)]
        skip = len(self.library.encode("\n"))
        got = dict(zip(lead, self.library.encode([s[1:] for s in lead], num_threads=1), strict=True))
        got |= {
            s: ids[skip:] for s, ids in zip(bare, self.library.encode(["\n" + s for s in bare], num_threads=1), strict=True)
        }
        wrong = [s for s, ids in found.items() if ids != got[s] and s != SPACE]
        if wrong:
            raise ValueError(f"the library encodes {wrong[0]!r} as {got[wrong[0]]}, not {found[wrong[0]]}")
        texts = self.library.decode(list(found.values()), num_threads=1)
        for ids, text, own in zip(found.values(), texts, self.decode_many(raws), strict=True):
            if own != text:
                raise ValueError(f"the library decodes {ids} as {text!r}, not {own!r}")

    def encode_many(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids, begin and end ids included, as little-endian uint32, and its decoded text."""
        if len(self.cache) > _CACHED_SEGMENTS:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        cut = [self.segments(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(cache)
        cache.update({s: older[s] for s in new if s in older})
        found = {s: self.segment_ids(s) for s in new.difference(older)}
        if found:
            ends = np.cumsum([0, *map(len, found.values())]) * 4
            flat = np.fromiter(chain.from_iterable(found.values()), "<u4").tobytes()
            raws = [flat[a:b] for a, b in pairwise(ends.tolist())]
            self.check(found, raws)
            cache.update(zip(found, raws, strict=True))
        begin, end = struct.pack("<I", self.library.bos_id()), struct.pack("<I", self.library.eos_id())
        raws = [b"".join((begin, *map(cache.__getitem__, segments), end)) for segments in cut]
        for s in found:
            if len(s) > _CACHED_CHARS:
                del cache[s]
        yield from zip(raws, self.decode_many(raws), strict=True)


_CODECS: dict[str, Codec] = {}


def codec(model: str = MODEL) -> Codec:
    """One codec for each model and worker process."""
    if model not in _CODECS:
        _CODECS[model] = Codec(vocabulary_path(model))
    return _CODECS[model]


def _pieces(texts: list[str], chars: int = 400_000) -> Iterator[list[str]]:
    """Runs of texts of about so many characters, so that memory doesn't follow the Arrow batch."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, with_ids: bool = False
) -> DataFrame:
    """Encode every whole text and decode it again, in Arrow batches, without a shuffle.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256; with_ids adds the
    real outputs, ids (array of int) and decoded. Begin and end ids are
    included; there is no sampling.

    Defined results: null text counts as empty, whose ids are begin and end;
    each row is encoded by itself, so repeated rows and null ids pass through;
    long texts are encoded whole, segment by segment; of equal scores the
    leftmost pair merges first;
    an empty table gives an empty table; other columns are ignored.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model)
        for batch in batches:
            counts, digests, decoded, ids, texts = [], [], [], [], []
            for part in _pieces(batch.column("text").to_pylist()):
                for raw, text in coder.encode_many(part):
                    counts.append(len(raw) // 4)
                    digests.append(hashlib.sha256(raw).hexdigest())
                    decoded.append(hashlib.sha256(text.encode()).hexdigest())
                    if with_ids:
                        ids.append(list(struct.unpack(f"<{len(raw) // 4}I", raw)))
                        texts.append(text)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, schema)
