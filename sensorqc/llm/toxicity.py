"""Toxicity: a counterfactual-regularised classifier over words and word stems.

Logistic regression on the presence of words and their first letters. For every labelled text that
names a group of people, the loss also holds the squared change of the score (before the logistic
function) when that name, with its stem, is swapped for each other name of the same kind, so neutral
mentions of a group do not raise a score. Labelled texts seldom name a group, so every one also counts as a
sentence into which a name is put and then swapped: all names are in the model, whether texts hold them or not, and
what their stems share with ordinary words can't set one group apart from another.

Fitting reads at most ``sample_rows`` labelled texts (the documented bound, chosen by a hash of the
id); their features are drawn in parallel and one bounded task fits the weights. The model holds at
most ``max_features`` weights and those of the listed names. Scoring covers every row.

Defined results: a null or empty text gets the base rate of the labels; without any label the base
rate is 0.25; rows of one id are scored one by one; labels that repeat an id count once (toxic if any
row says so); null labels and null ids are not learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.llm.base import arrow_map, texts_of

#: Names of groups of people by language and kind; a swap stays within both.
IDENTITY_TERMS = {
    "gender": "women men girls boys woman man female male transgender nonbinary".split(),
    "religion": "muslims christians jews hindus buddhists sikhs atheists muslim christian jewish hindu buddhist sikh atheist catholic protestant".split(),
    "origin": "african american asian european arab mexican indian chinese latino hispanic immigrant immigrants refugee refugees".split(),
    "colour": "black white brown".split(),
    "orientation": "gay lesbian bisexual straight heterosexual homosexual queer".split(),
    "ability": "blind deaf disabled autistic".split(),
    "age": "old young elderly teenage".split(),
    "gender de": "frauen männer mädchen jungen frau mann weiblich männlich".split(),
    "religion de": "muslime christen juden hindus buddhisten atheisten katholiken protestanten".split(),
    "origin de": "afrikaner amerikaner asiaten europäer araber türken polen inder chinesen einwanderer flüchtlinge".split(),
    "orientation de": "schwule lesben bisexuelle heterosexuelle homosexuelle".split(),
    "ability de": "blinde gehörlose behinderte autisten".split(),
    "gender fr": "femmes hommes filles garçons femme homme".split(),
    "religion fr": "musulmans chrétiens juifs hindous bouddhistes athées catholiques protestants".split(),
    "origin fr": "africains américains asiatiques européens arabes indiens chinois immigrés réfugiés".split(),
    "orientation fr": "homosexuels lesbiennes bisexuels hétérosexuels".split(),
    "ability fr": "aveugles sourds handicapés autistes".split(),
    "gender es": "mujeres hombres niñas niños mujer hombre".split(),
    "religion es": "musulmanes cristianos judíos hindúes budistas ateos católicos protestantes".split(),
    "origin es": "africanos americanos asiáticos europeos árabes indios chinos inmigrantes refugiados".split(),
    "orientation es": "homosexuales lesbianas bisexuales heterosexuales".split(),
    "ability es": "ciegos sordos discapacitados autistas".split(),
}
KIND_OF = {term: kind for kind, terms in IDENTITY_TERMS.items() for term in terms}

_EDGE = b".,;:!?\"'()[]{}<>*$%&#-_"


@dataclass(frozen=True)
class ToxicitySettings:
    sample_rows: int = 8_000
    max_features: int = 6_000
    min_documents: int = 4
    stem_letters: int = 4
    l2: float = 2e-4
    counterfactual: float = 1.0
    inserted: float = 1.0  # weight of the names put into texts beside the names found there
    steps: int = 250
    held_out_modulus: int = 5


def held_out(doc_id: Column, modulus: int = 5) -> Column:
    """Rows that are never learned from; a null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 0, F.lit(False))


def features_of(text: bytes, stem_letters: int) -> set[str]:
    """Lower-case words without edge punctuation, and ``stem*`` for the first letters of longer ones."""
    words = {w.strip(_EDGE) for w in set(text.split())}
    out = {w.decode("utf-8", "replace").lower() for w in words if 0 < len(w) <= 64}
    return out | _stems(out, stem_letters)


def _stems(words: set[str], stem_letters: int) -> set[str]:
    return {w[:stem_letters] + "*" for w in words if len(w) > stem_letters}


def swapped(features: set[str], term: str, other: str, stem_letters: int) -> set[str]:
    """The features of a text after a swap of one word; words have no ``*`` at their end, stems do."""
    words = {f for f in features if not f.endswith("*")} - {term} | {other}
    return words | _stems(words, stem_letters)


def _labelled(docs: DataFrame, labels: DataFrame, cfg: ToxicitySettings) -> DataFrame:
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), cfg.held_out_modulus))
    known = known.groupBy(F.col("doc_id").alias("_tox_id")).agg(F.max(F.col("toxic").cast("int")).alias("_tox_label"))
    # bounded by sample_rows, so it may be sent to every task
    sample = known.orderBy(F.xxhash64("_tox_id"), "_tox_id").limit(cfg.sample_rows)
    rows = docs.select(F.col("doc_id").alias("_tox_id"), F.col("text").alias("_tox_text"))
    rows = rows.join(F.broadcast(sample), "_tox_id").filter(F.col("_tox_text").isNotNull())
    stem = cfg.stem_letters

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(features_of(t, stem)) for t in texts_of(b.column("_tox_text"))]
            yield pa.RecordBatch.from_arrays([b.column("_tox_id").cast(pa.string()), b.column("_tox_label").cast(pa.int32()), pa.array(found, pa.list_(pa.string()))], ["id", "label", "features"])

    # a table may repeat an id; the bound holds for rows too
    return arrow_map(rows, extract, "id string, label int, features array<string>").orderBy(F.xxhash64("id"), "id").limit(cfg.sample_rows)


def fit_weights(samples: list[list[str]], labels: np.ndarray, cfg: ToxicitySettings) -> tuple[list[str], np.ndarray, float]:
    """Words, their weights and the bias for labelled feature sets."""
    n, positives = len(labels), float(labels.sum())
    base = (positives + 0.5) / (n + 2)
    bias = float(np.log(base / (1 - base)))
    if positives == 0 or positives == n:
        return [], np.zeros(0), bias
    seen: dict[str, list[int]] = {}
    for feats, y in zip(samples, labels, strict=True):
        for f in feats:
            seen.setdefault(f, [0, 0])[int(y)] += 1
    names = [f for f, (a, b) in seen.items() if a + b >= cfg.min_documents]
    counts = np.array([seen[f] for f in names], float).reshape(-1, 2)
    rate = (counts[:, 1] + base) / (counts.sum(1) + 1)
    strength = np.abs(rate - base) * np.sqrt(counts.sum(1))
    order = np.lexsort((np.array(names, dtype=object).astype(str), -strength))[: cfg.max_features]
    names = [names[i] for i in order]
    of_term = {t: {t} | _stems({t}, cfg.stem_letters) for t in KIND_OF}
    if cfg.inserted:
        names += sorted(set().union(*of_term.values()) - set(names))
    index = {f: i for i, f in enumerate(names)}
    rows = [[index[f] for f in feats if f in index] for feats in samples]
    lengths = np.array([len(r) for r in rows])
    cols = np.fromiter((i for r in rows for i in r), np.int64, int(lengths.sum()))
    row_of = np.repeat(np.arange(n), lengths)
    # counterfactual pairs: all features that a swap takes out of the text or puts into it
    swaps: dict[tuple[tuple[int, ...], tuple[int, ...]], int] = {}
    for sample in samples:
        feats = set(sample)
        for f in feats & KIND_OF.keys():
            for other in IDENTITY_TERMS[KIND_OF[f]]:
                after = swapped(feats, f, other, cfg.stem_letters)
                gone, new = (tuple(sorted(index[x] for x in d if x in index)) for d in (feats - after, after - feats))
                if other != f and (gone or new):
                    swaps[(gone, new)] = swaps.get((gone, new), 0) + 1
    for terms in IDENTITY_TERMS.values() if cfg.inserted else ():
        pairs = [(of_term[a] - of_term[b], of_term[b] - of_term[a]) for a in terms for b in terms if a < b]
        for gone, new in pairs:
            key = tuple(tuple(sorted(index[x] for x in d)) for d in (gone, new))
            swaps[key] = swaps.get(key, 0) + cfg.inserted * n / len(pairs)
    weight = np.array(list(swaps.values()), float) / n
    pair_of = np.array([p for p, (gone, new) in enumerate(swaps) for _ in (*gone, *new)], np.int64)
    swap_col = np.array([i for gone, new in swaps for i in (*gone, *new)], np.int64)
    sign = np.array([x for gone, new in swaps for x in (*[1.0] * len(gone), *[-1.0] * len(new))])
    w, b = np.zeros(len(names)), bias
    m, v = np.zeros_like(w), np.zeros_like(w)
    mb = vb = 0.0
    for step in range(1, cfg.steps + 1):
        z = b + np.bincount(row_of, w[cols], n)
        off = (1 / (1 + np.exp(-z)) - labels) / n
        g = np.bincount(cols, off[row_of], len(w)) + cfg.l2 * w
        if len(weight):
            change = np.bincount(pair_of, sign * w[swap_col], len(weight))
            g += np.bincount(swap_col, sign * (2 * cfg.counterfactual * weight * change)[pair_of], len(w))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        gb = off.sum()
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        lr = 0.1 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w = w - lr * m / (np.sqrt(v) + 1e-9)
        b = b - lr * mb / (np.sqrt(vb) + 1e-9)
    return names, w, float(b)


def fit(docs: DataFrame, labels: DataFrame, cfg: ToxicitySettings = ToxicitySettings()) -> dict:
    """The model as ``{"weights": {feature: weight}, "bias": b}``; at most ``max_features`` entries."""

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        names, weights, bias = fit_weights([list(x) for x in pdf["features"]], pdf["label"].to_numpy(float), cfg)
        return pd.DataFrame({"names": [names], "weights": [weights.tolist()], "bias": [bias]})

    row = _labelled(docs, labels, cfg).groupBy().applyInPandas(train, "names array<string>, weights array<double>, bias double").first()
    if row is None:
        names, weights, bias = fit_weights([], np.zeros(0), cfg)
        return {"weights": {}, "bias": bias, "stem_letters": cfg.stem_letters}
    return {"weights": dict(zip(row["names"], row["weights"], strict=True)), "bias": row["bias"], "stem_letters": cfg.stem_letters}


class Scorer:
    """Scores texts one by one; remembers which features of a word have a weight."""

    def __init__(self, model: dict):
        self.weights, self.bias, self.stem = model["weights"], model["bias"], model["stem_letters"]
        self.memo: dict[bytes, tuple[str, ...]] = {}

    def __call__(self, text: bytes) -> float:
        hit: set[str] = set()
        for word in set(text.split()):
            found = self.memo.get(word)
            if found is None:
                if len(self.memo) > 300_000:
                    self.memo.clear()
                found = self.memo[word] = tuple(f for f in features_of(word, self.stem) if f in self.weights)
            hit.update(found)
        return float(1 / (1 + np.exp(-self.bias - sum(self.weights[f] for f in sorted(hit)))))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on) of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            p = np.array([scorer(t) for t in texts_of(b.column("_tox_text"))], float)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select("doc_id", F.col("text").alias("_tox_text"))
    return arrow_map(rows, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, cfg: ToxicitySettings = ToxicitySettings()) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't call toxic, with their own columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, cfg))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            yield b.filter(pa.array([scorer(t) < 0.5 for t in texts_of(b.column(at))], pa.bool_()))

    return arrow_map(docs, run, docs.schema)
