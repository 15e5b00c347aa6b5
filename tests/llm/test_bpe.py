"""BPE encoder against the tokenizers library and against merging step by step."""

import hashlib
import json
import random
from pathlib import Path

import numpy as np
import pytest

from sensorqc.llm import base, bpe, queries
from sensorqc.llm.base import table

DATA = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def path():
    return queries.tokenizer_file(queries.WORD_TOKENIZER)


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def toy(path, merges):
    """A file with the given merges in place of the real ones."""
    spec = json.loads(Path(path).read_text())
    letters = bpe.byte_letters()
    tokens = [*letters, *(x + "</w>" for x in letters), *("".join(m) for m in merges)]
    spec["model"] |= {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": [list(m) for m in merges]}
    spec["added_tokens"] = []
    return json.dumps(spec)


def step_by_step(word, merges):
    """Plain merging: the first of the lowest-ranked neighbours is joined until none is left."""
    parts = [*word[:-1], word[-1] + "</w>"]
    rank = {m: i for i, m in enumerate(merges)}
    while True:
        found = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
        if found is None:
            return parts
        i = found[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize(
    "merges",
    [
        [("a", "a"), ("aa", "a"), ("aa", "aa"), ("a", "b</w>"), ("aa", "ab</w>")],
        [("a", "b"), ("b", "a"), ("ab", "ab"), ("ba", "ba"), ("b", "a</w>"), ("ab", "a</w>"), ("abab", "ba</w>")],
        [("b", "c"), ("a", "b"), ("a", "bc"), ("c", "a"), ("ab", "ca"), ("c", "c</w>"), ("bc", "c</w>")],
    ],
)
def test_toy_merges_equal_step_by_step(path, merges):
    model = bpe.BpeFile(toy(path, merges)).model()
    names = [*bpe.byte_letters(), *(x + "</w>" for x in bpe.byte_letters()), *("".join(m) for m in merges)]
    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(800)]
    for w in words:
        assert [names[i] for i in ids_of(model.encode(w))] == step_by_step(w, merges), w


def test_real_file_equals_library(path, library):
    model = bpe.BpeFile.load(path).model()
    assert model.plain_pieces is not None
    rng = random.Random(7)
    letters = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x320), 0x3A3, 0x3C2, 0x1F642, 0x4E2D, 0x2028, 0xA0, 0x85, 0x1C, 0, 0x1E9E]]
    texts = ["", " \t\n", "a<|startoftext|>b <|EndOfText|><|endoftext|>", "É", "Σίσυφος ΣΑΣ", "it's WE'LL 'S", "x" * 3000, "12 345", "é́"]
    texts += ["".join(rng.choice(letters) if rng.random() < 0.3 else rng.choice("abehinorst'sl 1.!") for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        got = model.encode_long(t.encode())
        assert ids_of(got) == want, t
        assert model.decode(got).decode() == library.decode(want, skip_special_tokens=False)


def test_long_texts_and_words(path, library):
    model = bpe.BpeFile.load(path).model()
    text = "日本語" * 60_000 + " word" * 300_000 + " " + "abc" * 50_000
    got = model.encode_long(text.encode())
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(got) == want
    assert model.decode(got, span=1000).decode() == library.decode(want, skip_special_tokens=False)


def test_files_of_another_kind_are_refused():
    with pytest.raises(ValueError):
        bpe.BpeFile.load(queries.tokenizer_file("byte_bpe_50k.json")).model()


def test_nulls_repeats_clashing_columns_and_empty_tables(spark, path):
    base.prepare(spark)
    file = bpe.BpeFile.load(path)
    rows = [(None, None, "k", 1), (1, "", "k", 2), (2, "Two words", "k", 3), (2, "Two words", "k", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    out = bpe.decode(bpe.encode(docs, file), file)
    assert out.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    assert sorted((r.doc_id or 0, len(r.ids), r.decoded) for r in out.collect()) == [(0, 0, ""), (1, 0, ""), *[(2, 8, "two</w> words</w>")] * 2]
    assert sorted((r.doc_id or 0, r.n_tokens) for r in bpe.digests(docs, file).collect()) == [(0, 0), (1, 0), (2, 2), (2, 2)]
    assert bpe.digests(docs.limit(0), file).count() == 0


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
def test_query_equals_library(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op13_bpe"](spark, DATA).collect()}
    rows = table(spark, DATA, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        x = got[r.doc_id]
        assert (x.n_tokens, x.ids_sha256, x.decoded_sha256) == want
