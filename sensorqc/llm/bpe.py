"""BPE encoding and decoding: exact merges by backtracking over Aho-Corasick matches, decoding by an offset table.

The result of byte-pair merging is the one sequence of tokens in which every two neighbours are compatible: no
merge across their border comes before the merges that made them. So a piece of text is read from left to right,
taking the longest token that starts here (an Aho-Corasick automaton gives it for every position in one pass),
then shorter ones until one is compatible with the token before; where none is, the token before gives way to a
shorter one and the position counts as dead. Every position is entered once for each token that ends there, so
the time is linear in the text. Which pairs are compatible is found by undoing their merges in reverse order, and
remembered in a table.

The file's own normalizer and pre-tokenizer cut texts into pieces; that files of this kind drop white space is
checked from the file, so long texts can be cut at white space. Texts of Latin characters are cut by the file's
pattern directly, if that agrees with the library on every such character (checked when the file is read); others go
through the library word by word. The ids of short pieces are remembered. Everything that a worker needs is sent with
the model.

Defined results: null and empty texts have no ids and decode to the empty text; rows of one id are encoded each
for itself; an empty table gives no rows; other columns are kept unless they are named like an output (``ids``,
``decoded``), which replaces them. Texts of any length and words of any length are encoded whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sensorqc.llm.base import arrow_map, texts_of

#: Letters at the end of a word are other symbols than within it: their code points are moved by this much.
END_SHIFT = 0x1000

#: Parts of a normalizer that leave characters below PLAIN_END as they are, but for case and white space.
_PLAIN_NORMALIZERS = {"NFC", "Lowercase", "Replace"}

#: Texts of characters below this one (Latin letters with their accents, no combining marks) take the short way.
PLAIN_END = 0x250
_NOT_PLAIN = re.compile(f"[^\\x00-\\u{PLAIN_END - 1:04x}]")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


@dataclass(frozen=True)
class BpeFile:
    """A tokenizers file as text; goes to the workers as it is (a vocabulary, so its size has a bound)."""

    text: str = field(repr=False)

    @classmethod
    def load(cls, path: str) -> BpeFile:
        return cls(Path(path).read_text(encoding="utf-8"))

    def model(self) -> BpeModel:
        return _model(self.text)


@lru_cache(maxsize=1)
def _model(text: str) -> BpeModel:
    return BpeModel(json.loads(text), text)


class BpeModel:
    """Merge tables, automaton and offset table of one vocabulary."""

    def __init__(self, spec: dict, text: str):
        from tokenizers import Tokenizer

        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("a plain byte-level BPE model is needed")
        if spec["decoder"] is not None:
            raise ValueError("files with a decoder are not supported: tokens are joined by blanks")
        self.library = Tokenizer.from_str(text)
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self._load_merges(vocab, [m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        self._load_specials(spec["added_tokens"])
        self.plain_pieces = self._check_pieces(spec)
        names = {i: t for t, i in vocab.items()} | self.specials_by_id
        blob = [(" " + names[i]).encode() if i in names else b"" for i in range(max(names) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in blob])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(blob), np.uint8)

    def key(self, token: str) -> str:
        """A token as a string with one code point for each symbol."""
        if self.suffix and token.endswith(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + END_SHIFT)
        return token

    def _load_merges(self, vocab: dict[str, int], merges: list[list[str]]) -> None:
        letters = byte_letters()
        atoms = {vocab[x + tail] for x in letters for tail in {"", self.suffix}}
        size = max(vocab.values()) + 1
        self.size = size
        self.left, self.right, self.rank = [-1] * size, [-1] * size, [-1] * size
        self.merged: dict[int, int] = {}
        suffix = len(self.suffix)
        for rank, (a, b) in enumerate(merges):
            x, y, whole = vocab[a], vocab[b], vocab[a + b]
            if whole in atoms or self.rank[whole] >= 0 or suffix and a.endswith(self.suffix):
                raise ValueError(f"two ways to make the token {a + b!r}")
            self.left[whole], self.right[whole], self.rank[whole] = x, y, rank
            self.merged[x * size + y] = whole
        keys = {self.key(t): i for t, i in vocab.items() if i in atoms or self.rank[i] >= 0}
        # a token whose own letters don't merge to it can't come up
        own = {k: i for k, i in keys.items() if self.rank[i] < 0 or self._apart(self.left[i], self.right[i], self.rank[i])}
        self.length = [0] * size
        self.shorter = [-1] * size  # the longest token that a token starts with
        self.automaton = ahocorasick.Automaton()
        for k, i in own.items():
            self.length[i] = len(k)
            self.shorter[i] = next((own[k[:n]] for n in range(len(k) - 1, 0, -1) if k[:n] in own), -1)
            self.automaton.add_word(k, i)
        self.automaton.make_automaton()
        self.longest_key = max(map(len, own))
        self.pairs: dict[int, bool] = {}
        self.remembered = Memo(lambda piece: _raw(self.merge(self._letters(piece))))
        self.words = Memo(self._encode_word)

    def forget(self) -> None:
        self.pairs.clear()
        self.remembered.forget()
        self.words.forget()

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge of a rank below ``limit`` joins a's end with b's start before a and b are made."""
        rank, left, right, merged, size = self.rank, self.left, self.right, self.merged, self.size
        while True:
            joint = merged.get(a * size + b)
            if joint is not None and rank[joint] < limit:
                return False
            if rank[a] > rank[b]:  # a was made last: before that, its right part met b
                limit, a = rank[a], right[a]
            elif rank[b] < 0:
                return True
            else:  # of equal merges the left one comes first, so one across the border goes before b's own
                limit, b = rank[b] + 1, left[b]

    def fits(self, a: int, b: int) -> bool:
        """The pair-compatibility table, filled as pairs come up."""
        pair = a * self.size + b
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= 1 << 18:
                self.pairs.clear()
            known = self.pairs[pair] = self._apart(a, b, len(self.rank))
        return known

    def _load_specials(self, added: list[dict]) -> None:
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or t["content"].split() != [t["content"]] for t in added):
            raise ValueError("added tokens must be plain strings without white space")
        self.specials = {t["content"]: t["id"] for t in added}
        self.specials_by_id = {i: c for c, i in self.specials.items()}
        ways = "|".join(re.escape(c) for c in sorted(self.specials, key=len, reverse=True))
        self.special_pattern = re.compile(f"({ways})") if ways else None

    def _check_pieces(self, spec: dict) -> regex.Pattern | None:
        """The file's pattern, if it alone cuts lower-cased texts of plain characters as the library does.

        Refuses files whose pieces hold white space, as texts are cut there first.
        """
        pre = spec["pre_tokenizer"]
        steps = pre["pretokenizers"] if pre and pre["type"] == "Sequence" else [pre or {"type": None}]
        split, level = steps[0], steps[-1]
        dropped = split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed" and "Regex" in split["pattern"]
        if len(steps) != 2 or not dropped or level["type"] != "ByteLevel" or level["use_regex"] or level["add_prefix_space"]:
            raise ValueError("the file must keep the matches of one pattern and then map bytes to letters")
        pattern = regex.compile(split["pattern"]["Regex"])
        if any(ch.isspace() for m in pattern.findall(" a \t1 \n. \r\x0b\x0c'") for ch in m):
            raise ValueError("the file's pieces hold white space")
        norm = spec["normalizer"]
        parts = norm["normalizers"] if norm and norm["type"] == "Sequence" else [norm] if norm else []
        known = all(p["type"] in _PLAIN_NORMALIZERS and (p["type"] != "Replace" or p["pattern"] == {"Regex": r"\s+"} and p["content"] == " ") for p in parts)
        self.lower = any(p["type"] == "Lowercase" for p in parts)
        self.letters = byte_letters()
        probes = (f"{x}{chr(c)}{y}{chr(c)}" for c in range(PLAIN_END) for x, y in (("a", "1"), (".", "a")))
        same = known and all([self._letters(m) for m in pattern.findall(t.lower() if self.lower else t)] == self.library_pieces(t) for t in probes)
        return pattern if same else None

    def _letters(self, piece: str) -> str:
        return piece if piece.isascii() and piece.isprintable() else "".join(map(self.letters.__getitem__, piece.encode()))

    def library_pieces(self, text: str) -> list[str]:
        norm = self.library.normalizer
        return [letters for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(norm.normalize_str(text) if norm else text)]

    def merge(self, letters: str) -> array:
        """Ids of one piece."""
        key = letters[:-1] + chr(ord(letters[-1]) + END_SHIFT) if self.suffix else letters
        n, out, at, last = len(key), array("I"), 0, -1
        dead = bytearray(n + 1)
        length, shorter, size, known = self.length, self.shorter, self.size, self.pairs.get
        start, window = 0, self._longest(key, 0)
        end, token = len(window), window[0]
        while at < n:
            while token >= 0:
                if not dead[at + length[token]]:
                    if last < 0:
                        break
                    fine = known(last * size + token)
                    if self.fits(last, token) if fine is None else fine:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                last = token
                at += length[token]
                if at < n:
                    if not start <= at < end:
                        start, window = at, self._longest(key, at)
                        end = at + len(window)
                    token = window[at - start]
            else:
                dead[at] = 1
                last = out.pop()
                at -= length[last]
                token = shorter[last]
                last = out[-1] if out else -1
        return out

    def _longest(self, key: str, start: int, span: int = 1 << 16) -> list[int]:
        """The longest token that starts at each of the next ``span`` positions."""
        part = key[start : start + span + self.longest_key] if len(key) > span else key
        found, length = [-1] * len(part), self.length
        for end, token in self.automaton.iter(part):  # ends rise, so the longest comes last
            found[end - length[token] + 1] = token
        return found[:span]

    def encode(self, text: str) -> bytes:
        """Ids of a text, little-endian unsigned 32 bits each."""
        if self.special_pattern is None or self.special_pattern.search(text) is None:
            return self._encode_part(text)
        out = []
        for i, part in enumerate(self.special_pattern.split(text)):
            out.append(_raw(array("I", [self.specials[part]])) if i % 2 else self._encode_part(part))
        return b"".join(out)

    def _encode_part(self, text: str) -> bytes:
        if self.plain_pieces and _NOT_PLAIN.search(text) is None:
            return b"".join(map(self.remembered.__getitem__, self.plain_pieces.findall(text.lower() if self.lower else text)))
        return b"".join(self.words[w] for w in text.split(" "))  # the library, word by word

    def _encode_word(self, word: str) -> bytes:
        return b"".join(_raw(self.merge(letters)) for letters in self.library_pieces(word))

    def encode_long(self, text: bytes, span: int = 1 << 20) -> bytes:
        """Ids of a whole text, whose pieces are listed at most about ``span`` bytes at a time."""
        if len(text) <= span:
            return self.encode(text.decode("utf-8", "replace"))
        return b"".join(self.encode(part.decode("utf-8", "replace")) for part in cut_at_blanks(text, span))

    def decode(self, ids: bytes, span: int = 1 << 20) -> bytes:
        """UTF-8 text: each id's bytes, copied from the places that the offset table gives, joined by blanks."""
        every, out = np.frombuffer(ids, "<u4"), []
        for s in range(0, len(every), span):
            some = every[s : s + span]
            first, size = self.offsets[some], self.offsets[some + 1] - self.offsets[some]
            upto = np.cumsum(size)
            out.append(self.blob[np.arange(upto[-1]) + np.repeat(first - upto + size, size)].tobytes())
        return b"".join(out)[1:]


def _raw(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


class Memo(dict):
    """Values of the last ``limit`` to twice ``limit`` short keys."""

    limit = 120_000
    longest = 48

    def __init__(self, value: Callable):
        super().__init__()
        self.value, self.before = value, {}

    def __missing__(self, key: bytes | str) -> bytes:
        found = self.before.get(key)
        if found is None:
            found = self.value(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.before = dict(self)
                self.clear()
            self[key] = found
        return found

    def forget(self) -> None:
        self.clear()
        self.before = {}


_BLANK = re.compile(rb"[ \t-\r]")


def cut_at_blanks(text: bytes, span: int) -> Iterator[bytes]:
    """Parts of a text of ``span`` bytes and up to the next ASCII white space; no word is cut."""
    at = 0
    while at < len(text):
        m = _BLANK.search(text, at + span)
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end


def _with(docs: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in docs.schema.fields if f.name != name), T.StructField(name, kind)])


def encode(docs: DataFrame, file: BpeFile, text: str = "text") -> DataFrame:
    """Adds ``ids`` (binary: little-endian unsigned 32-bit integers) of the column ``text``."""
    schema = _with(docs, "ids", T.BinaryType())
    sent = docs.sparkSession.sparkContext.broadcast(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value.model()
        try:
            for b in batches:
                ids = [model.encode_long(t) for t in texts_of(b.column(text))]
                names = [f.name for f in schema.fields]
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names[:-1]), pa.array(ids, pa.binary())], names)
        finally:  # the model stays with the worker, what it remembers doesn't
            model.forget()

    return arrow_map(docs, run, schema)


def decode(docs: DataFrame, file: BpeFile, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the column ``ids`` with special tokens; null has none."""
    schema = _with(docs, "decoded", T.StringType())
    sent = docs.sparkSession.sparkContext.broadcast(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value.model()
        for b in batches:
            texts = [model.decode(x) for x in texts_of(b.column(ids))]
            names = [f.name for f in schema.fields]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names[:-1]), pa.array(texts, pa.binary()).cast(pa.string())], names)

    return arrow_map(docs, run, schema)


def digests(docs: DataFrame, file: BpeFile) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    out = decode(encode(docs.select("doc_id", "text"), file).drop("text"), file)
    return out.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
