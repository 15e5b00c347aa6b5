"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The best segmentation has the highest sum of piece scores (log probabilities); of equal sums the one whose
last differing piece is longer wins. A character that no piece covers costs the lowest score less 10 and
becomes its UTF-8 byte pieces (or the unknown id without byte fallback). White space becomes the marker, with
one in front of the text, as the model file says; decoding turns markers back and joins byte pieces.

No piece holds a marker behind other characters, so a text falls apart before each run of markers and the
chunks are segmented independently; distinct chunks are segmented once, many at a time, with numpy: one walk
of the trie from all positions at once, one Viterbi step per character position.

Model files (a serialised model: pieces, scores, types, flags) are read, never trained. Any file of pieces
with scores works; a file whose scores are merge ranks gives the segmentation of highest rank sum.

Defined results: a null text has null ids, an empty one none; repeated rows are encoded one by one; other
columns pass through. Models with a character map or white-space trimming are refused.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sensorqc.llm.base import arrow_map

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a serialised message; length-delimited values as bytes, others as numbers."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, raw[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield tag >> 3, raw[at : at + n]
            at += n


def build_double_array(keys: list[list[int]], values: list[int], alphabet: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check, value of the trie over key sequences of codes 1..alphabet; state 0 is the root.

    The child of state s by code c is base[s] + c, if check there is s.
    """
    children: list[dict[int, int]] = [{}]
    ends = {}
    for key, value in zip(keys, values, strict=True):
        node = 0
        for c in key:
            nxt = children[node].get(c)
            if nxt is None:
                nxt = children[node][c] = len(children)
                children.append({})
            node = nxt
        ends[node] = value
    size = 2 * len(children) + alphabet + 2
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = bytearray(size)
    used[0] = 1
    free, state, queue = 1, {0: 0}, [0]
    for node in queue:
        codes = sorted(children[node])
        if not codes:
            continue
        while used[free]:
            free += 1
        b = max(free - codes[0], 0)
        while True:
            if b + alphabet + 2 > len(used):
                grow = len(used)
                used.extend(bytes(grow))
                base, check, value = (np.concatenate([a, np.full(grow, fill, np.int32)]) for a, fill in ((base, 0), (check, -1), (value, -1)))
            if not any(used[b + c] for c in codes):
                break
            b += 1
        s = state[node]
        base[s] = b
        for c in codes:
            used[b + c] = 1
            check[b + c] = s
            child = children[node][c]
            state[child] = b + c
            if child in ends:
                value[b + c] = ends[child]
            queue.append(child)
    return base, check, value


@dataclass
class Model:
    pieces: list[str]
    scores: np.ndarray
    types: np.ndarray
    unknown_id: int
    dummy_prefix: bool
    codes: np.ndarray  # code of each code point, 0 if no piece has it
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    longest: int
    lowest: float
    byte_ids: np.ndarray | None
    chunked: bool

    @classmethod
    def load(cls, path: str) -> Model:
        pieces, scores, types = [], [], []
        dummy, trim = True, True
        for field, raw in _fields(Path(path).read_bytes()):
            if field == 1:
                piece, score, kind = "", 0.0, NORMAL
                for f, v in _fields(raw):
                    if f == 1:
                        piece = v.decode()
                    elif f == 2:
                        score = float(np.frombuffer(v, "<f4")[0])
                    elif f == 3:
                        kind = v
                pieces.append(piece)
                scores.append(score)
                types.append(kind)
            elif field == 3:
                for f, v in _fields(raw):
                    if f == 2 and v:
                        raise ValueError("models with a character map aren't supported")
                    dummy = bool(v) if f == 3 else dummy
                    trim = bool(v) if f == 4 else trim
        if trim:
            raise ValueError("models that trim white space aren't supported")
        return cls.build(pieces, scores, types, dummy)

    @classmethod
    def build(cls, pieces: list[str], scores: list[float], types: list[int], dummy_prefix: bool = True) -> Model:
        kinds, values = np.array(types), np.array(scores, float)
        matched = [i for i, k in enumerate(types) if k in (NORMAL, USER) and pieces[i]]
        normal = [i for i in matched if types[i] == NORMAL]
        lowest, highest = (float(f(values[normal])) if normal else 0.0 for f in (np.min, np.max))
        for i in matched:
            if types[i] == USER:
                values[i] = len(pieces[i]) * highest - 0.1
        letters = sorted({c for i in matched for c in pieces[i]})
        codes = np.zeros(0x110000, np.int32)
        codes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        base, check, value = build_double_array([[int(codes[ord(c)]) for c in pieces[i]] for i in matched], matched, len(letters))
        of_byte = {p: i for i, p in enumerate(pieces) if types[i] == BYTE}
        byte_ids = np.array([of_byte[f"<0x{b:02X}>"] for b in range(256)], np.int32) if len(of_byte) == 256 else None
        unknown = next((i for i, k in enumerate(types) if k == UNKNOWN), 0)
        chunked = not any(MARKER in pieces[i].lstrip(MARKER) for i in matched)
        return cls(pieces, values, kinds, unknown, dummy_prefix, codes, base, check, value, max((len(pieces[i]) for i in matched), default=0), lowest, byte_ids, chunked)

    def segment(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as little-endian int32; white space is already marked."""
        lengths = np.array([len(c) for c in chunks], np.int64)
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        total = len(points)
        first = np.concatenate([[0], np.cumsum(lengths)])
        stop = np.repeat(first[1:], lengths)  # end of the chunk of each position
        codes = np.concatenate([self.codes[points], [0]])
        starts, spans, found = [], [], []
        at, state = np.arange(total), np.zeros(total, np.int64)
        bare = np.ones(total, bool)  # no piece of one character there
        for step in range(self.longest):
            here = at + step
            ok = here < stop[at]
            at, state, here = at[ok], state[ok], here[ok]
            code = codes[here]
            nxt = self.base[state] + code
            ok = (code > 0) & (self.check[nxt] == state)
            at, state = at[ok], nxt[ok]
            hit = self.value[state]
            full = hit >= 0
            starts.append(at[full])
            spans.append(np.full(int(full.sum()), step + 1))
            found.append(hit[full])
            if step == 0:
                bare[at[full]] = False
            if not len(at):
                break
        lone = np.flatnonzero(bare)
        starts.append(lone)
        spans.append(np.ones(len(lone), np.int64))
        found.append(np.full(len(lone), -1))
        s, n, piece = (np.concatenate(x).astype(np.int64) for x in (starts, spans, found))
        score = np.where(piece >= 0, self.scores[np.maximum(piece, 0)], self.lowest - UNKNOWN_PENALTY)
        # Viterbi over all chunks at once, by the end's distance from the start of its chunk
        chunk = np.repeat(np.arange(len(chunks)), lengths)
        depth = s + n - first[chunk[s]] if total else s
        order = np.lexsort((s, s + n, depth))
        s, n, piece, score, depth = s[order], n[order], piece[order], score[order], depth[order]
        node = np.arange(total) + chunk if total else np.zeros(0, np.int64)  # node before each position; one more per chunk
        best = np.zeros(total + len(chunks))
        back_n, back_piece = np.zeros(total + len(chunks), np.int64), np.full(total + len(chunks), -1)
        cuts = np.searchsorted(depth, np.arange(1, int(lengths.max(initial=0)) + 2))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            src = node[s[lo:hi]]
            end = src + n[lo:hi]
            value = best[src] + score[lo:hi]
            head = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
            top = np.maximum.reduceat(value, head)
            group = np.repeat(np.arange(len(head)), np.diff(np.concatenate([head, [len(end)]])))
            win = np.flatnonzero(value == top[group])
            win = win[np.concatenate([[True], group[win][1:] != group[win][:-1]])]  # the earliest start of equals
            best[end[win]], back_n[end[win]], back_piece[end[win]] = value[win], n[lo:hi][win], piece[lo:hi][win]
        steps, pieces = back_n.tolist(), back_piece.tolist()
        return [self._walk(origin, length, steps, pieces, c) for origin, length, c in zip((first[:-1] + np.arange(len(chunks))).tolist(), lengths.tolist(), chunks, strict=True)]

    def _walk(self, origin: int, length: int, steps: list[int], pieces: list[int], chunk: str) -> bytes:
        out: list[int] = []
        end = length
        while end:
            n, piece = steps[origin + end], pieces[origin + end]
            if piece >= 0:
                out.append(piece)
            elif self.byte_ids is not None:
                out += reversed(self.byte_ids[list(chunk[end - 1].encode("utf-8", "replace"))].tolist())
            elif not (end < length and out and out[-1] == self.unknown_id):
                out.append(self.unknown_id)
            end -= n
        return struct.pack(f"<{len(out)}i", *reversed(out))

    def surfaces(self) -> list[bytes]:
        """Bytes that each id stands for; control pieces stand for none."""
        out = []
        for i, (p, k) in enumerate(zip(self.pieces, self.types.tolist(), strict=True)):
            out.append(bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else b" \xe2\x81\x87 " if i == self.unknown_id and k == UNKNOWN else p.replace(MARKER, " ").encode())
        return out


class Encoder:
    """Encodes texts one by one; remembers the ids of chunks."""

    limit = 150_000
    group = 2_000_000  # characters
    _chunks = re.compile(" +[^ ]*|[^ ]+")

    def __init__(self, model: Model):
        self.model, self.memo, self.before = model, {}, {}

    def _cut(self, text: str) -> list[str]:
        marked = (" " if self.model.dummy_prefix and text else "") + text.replace(MARKER, " ")
        return self._chunks.findall(marked) if self.model.chunked else [marked] if marked else []

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian int32 ids of each text; new chunks of a group of texts are segmented together."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= self.group):
                size += len(texts[end])
                end += 1
            cut = [self._cut(t) for t in texts[at:end]]
            if len(self.memo) > self.limit:
                self.before, self.memo = self.memo, {}
            unseen = {c for chunks in cut for c in chunks if c not in self.memo}
            self.memo.update((c, self.before[c]) for c in unseen if c in self.before)
            new = [c for c in unseen if c not in self.memo]
            found = self.model.segment([c.replace(" ", MARKER) for c in new]) if new else []
            self.memo.update(zip(new, found, strict=True))
            for chunks in cut:
                yield b"".join(map(self.memo.__getitem__, chunks))
            at = end


def decode_ids(ids: np.ndarray, surfaces: list[bytes], dummy_prefix: bool) -> str:
    text = b"".join(map(surfaces.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if dummy_prefix and text.startswith(" ") else text


def _extended(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name != name], T.StructField(name, kind)])


def encode(df: DataFrame, model: Model, text_col: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with an array of int ids; a column of that name is replaced."""
    shared, names = df.sparkSession.sparkContext.broadcast(model), [c for c in df.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for b in batches:
            texts = b.column(text_col).to_pylist()
            raw = list(encoder(["" if t is None else t for t in texts]))
            offsets = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), "<i4")), mask=pa.array([t is None for t in texts], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), ids], [*names, into])

    return arrow_map(df, run, _extended(df, into, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, model: Model, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for; a column of that name is replaced."""
    shared, names = df.sparkSession.sparkContext.broadcast((model.surfaces(), model.dummy_prefix)), [c for c in df.columns if c != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces, dummy = shared.value
        for b in batches:
            texts = [decode_ids(x.values.to_numpy(zero_copy_only=False), surfaces, dummy) if x.is_valid else None for x in b.column(ids_col)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(texts, pa.string())], [*names, into])

    return arrow_map(df, run, _extended(df, into, T.StringType()))
