"""Packing: bounded-space online packing of token sequences into windows of fixed length.

Each partition keeps ``open_windows`` windows. A document's ids (with the end id) go whole into the open
window that they fill best; documents beyond the window length give off full windows first. When none
fits and no window may be opened, the fullest takes as many ids as it has room for and is emitted full.
At the end a partition joins its open windows into full ones and one leftover; leftovers of ``fan_in``
partitions are joined per task, round by round, until one window is left. So only the very last window
needs padding, each task holds ``open_windows`` or ``fan_in`` windows at most, and no group meets in one
task. Window numbers follow from round, partition and order, so a lost task gives the same rows again.

Defined results: a null or empty text is the end id alone; rows of one id are packed as separate
documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sensorqc.llm.base import arrow_map, materialise, texts_of


@dataclass(frozen=True)
class PackSettings:
    tokenizer: str
    length: int = 4096
    end_id: int = 2
    open_windows: int = 64
    fan_in: int = 64


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class WordTokens(dict):
    """Ids of whole texts by a tokenizer that never joins tokens across white space; maps words to their ids.

    ``path`` is a tokenizers file. A word of plain Latin letters, with a tail of plain stops or without, goes
    straight to the tokenizer's model, letters and tail apart, if the file splits words that way; every other
    word goes through the whole tokenizer. The last ``limit`` to twice ``limit`` words
    are remembered.
    """

    limit = 200_000
    # letters up to U+024F except the capital that lower-cases to two characters
    _plain = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.before: dict[bytes, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.short = _runs_are_pieces(json.loads(Path(path).read_text(encoding="utf-8")))

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _core(self, part: str) -> bytes:
        low = part.lower()
        text = low if low.isascii() else "".join(map(self.letters.__getitem__, low.encode()))
        found = [t.id for t in self.model.tokenize(text)]
        return struct.pack(f"<{len(found)}I", *found)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(word)
        if ids is None:
            text = word.decode("utf-8", "replace")
            m = self._plain.fullmatch(text) if self.short else None
            ids = self._whole(text) if m is None else self._core(m[1]) if not m[2] else self._core(m[1]) + self.tail(m[2])
        self[word] = ids
        return ids

    def tail(self, stops: str) -> bytes:
        ids = self.tails.get(stops)
        if ids is None:
            ids = self._core(stops)
            if len(stops) < 4:
                self.tails[stops] = ids
        return ids

    def __call__(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for text in texts:
            yield np.frombuffer(b"".join(map(self.__getitem__, text.split())), "<u4")


#: Normalizer and pre-tokenizer under which a run of plain letters is one piece and a run of plain stops another:
#: NFC and lower case leave or map each of them by itself, white space is dropped, and the contractions that come
#: first in the pattern hold letters after an apostrophe, which neither run has.
_RUNS = re.compile(r"(?:'[a-z]+\|)*\[\\p\{L\}\]\+\|\[\\p\{N\}\]\|\[\^\\s\\p\{L\}\\p\{N\}\]\+")


def _runs_are_pieces(spec: dict) -> bool:
    norm, pre = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    plain = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    steps = pre.get("pretokenizers", [])
    if norm.get("normalizers") != plain or len(steps) != 2 or steps[0]["type"] != "Split" or steps[1]["type"] != "ByteLevel":
        return False
    split, level = steps
    whole = split["behavior"] == "Removed" and split["invert"] and not level["use_regex"] and not level["add_prefix_space"]
    return whole and _RUNS.fullmatch(split["pattern"].get("Regex", "")) is not None


#: A piece: doc_id, start, ids, tokens of its document.
Piece = tuple[object, int, np.ndarray, int]


class Packer:
    def __init__(self, length: int, open_windows: int):
        self.length, self.most = length, open_windows
        self.open: list[tuple[int, list[Piece]]] = []  # (room, pieces)

    def place(self, doc_id: object, ids: np.ndarray) -> Iterator[list[Piece]]:
        """Puts a document away; yields the windows that this fills."""
        total, start = len(ids), 0
        while total - start >= self.length:
            yield [(doc_id, start, ids[start : start + self.length], total)]
            start += self.length
        while start < total:
            left = total - start
            fits = [(room, i) for i, (room, _) in enumerate(self.open) if room >= left]
            if fits:
                _, i = min(fits)
                take = left
            elif len(self.open) < self.most:
                self.open.append((self.length, []))
                i, take = len(self.open) - 1, left
            else:
                take, i = min((room, i) for i, (room, _) in enumerate(self.open))
            room, pieces = self.open[i]
            pieces.append((doc_id, start, ids[start : start + take], total))
            start += take
            if room == take:
                yield self.open.pop(i)[1]
            else:
                self.open[i] = (room - take, pieces)

    def close(self) -> tuple[list[list[Piece]], list[Piece]]:
        """Full windows made of the open ones, and the leftover."""
        pieces = [p for _, window in sorted(self.open, key=lambda w: w[0]) for p in window]
        self.open = []
        return join_windows(pieces, self.length)


def join_windows(pieces: list[Piece], length: int) -> tuple[list[list[Piece]], list[Piece]]:
    full, now, room = [], [], length
    for doc_id, start, ids, total in pieces:
        while len(ids):
            take = min(room, len(ids))
            now.append((doc_id, start, ids[:take], total))
            start, ids, room = start + take, ids[take:], room - take
            if room == 0:
                full.append(now)
                now, room = [], length
    return full, now


_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, leftover long, place long"


class _Rows:
    """Collects pieces as rows; ids are kept for leftovers, or for all if asked."""

    def __init__(self, id_type: pa.DataType, with_ids: bool):
        self.id_type, self.with_ids, self.rows = id_type, with_ids, []

    def add(self, window: list[Piece], sequence: int | None, leftover: int | None = None) -> None:
        offset = 0
        for place, (doc_id, start, ids, total) in enumerate(window):
            raw = ids.astype("<u4").tobytes()
            self.rows.append((doc_id, start, len(ids), crc32(raw), total, sequence, offset, raw if self.with_ids or leftover is not None else None, leftover, place))
            offset += len(ids)

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [[]] * 10
        self.rows = []
        types = [self.id_type, *[pa.int64()] * 6, pa.binary(), pa.int64(), pa.int64()]
        names = ["doc_id", *[f.split()[0] for f in _FIELDS.split(", ")]]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)


def _sequence(level: int, part: int, counter: int) -> int:
    return (level << 58) | (part << 26) | counter


def pack(docs: DataFrame, cfg: PackSettings, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian uint32, if asked)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {_FIELDS}"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, counter, rows = TaskContext.get().partitionId(), 0, None
        words, packer = WordTokens(cfg.tokenizer), Packer(cfg.length, cfg.open_windows)
        end = np.array([cfg.end_id], "<u4")
        for b in batches:
            rows = rows or _Rows(b.column("doc_id").type, with_ids)
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), words(texts_of(b.column("_pk_text"))), strict=True):
                for window in packer.place(doc_id, np.concatenate([ids, end])):
                    rows.add(window, _sequence(0, part, counter))
                    counter += 1
            yield rows.batch()
        if rows:
            full, left = packer.close()
            for window in full:
                rows.add(window, _sequence(0, part, counter))
                counter += 1
            rows.add(left, None, part)
            yield rows.batch()

    out = materialise(arrow_map(docs.select("doc_id", F.col("text").alias("_pk_text")), first, schema), "packed")
    done = [out.filter("leftover is null")]
    left, level = out.filter("leftover is not null"), 0
    parts = (left.agg(F.max("leftover")).first()[0] or 0) + 1
    while level == 0 or parts > 1:
        level, parts, last = level + 1, -(-parts // cfg.fan_in), parts <= cfg.fan_in

        def merge(batches: Iterator[pa.RecordBatch], level: int = level, last: bool = last) -> Iterator[pa.RecordBatch]:
            pieces: list[Piece] = []
            group, counter, rows = None, 0, None

            def finish() -> None:
                nonlocal counter
                full, rest = join_windows(pieces, cfg.length)
                for window in [*full, *([rest] if last and rest else [])]:
                    rows.add(window, _sequence(level, group, counter))
                    counter += 1
                if not last:
                    rows.add(rest, None, group)

            for b in batches:
                rows = rows or _Rows(b.column("doc_id").type, with_ids)
                for doc_id, start, raw, total, g in zip(*(b.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens", "group")), strict=True):
                    if group is not None and g != group:
                        finish()
                        pieces, counter = [], 0
                    group = g
                    pieces.append((doc_id, start, np.frombuffer(raw, "<u4"), total))
            if rows:
                finish()
                yield rows.batch()

        grouped = left.withColumn("group", F.floor(F.col("leftover") / cfg.fan_in)).repartition("group").sortWithinPartitions("group", "leftover", "place")
        out = materialise(arrow_map(grouped, merge, schema), "packed")
        done.append(out.filter("leftover is null"))
        left = out.filter("leftover is not null")
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return whole.select(*names, *(["ids"] if with_ids else []))
