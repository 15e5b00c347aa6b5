"""Quality rules: distribution divergence against language references. Only DataFrame functions.

Each text gives histograms: characters by class, and for each listed language its common words (with all
other words as one bin). References are the sums of these histograms over all documents of a language
that pass the base rules. Distances are Jensen-Shannon distances (square root of the divergence, base 2).
A document is rejected if

* its characters are too far from its language's,
* its common words are too far from its language's,
* it has too small a share of common words (a histogram of two bins, with a limit of its own: even a text
  without any is no further than 0.33 from its language, so the other limits can't tell), or
* its common words are nearer to another language's by a margin.

Guards: texts with few characters or words are too noisy to judge and pass; a language with too small a
reference isn't used. Languages without a word list share one character reference and have no word test.

The base rules count per text: words, their code points, symbols, duplicate lines and the words that lie
in repeated five-word windows. Windows are compared by 64-bit hash within one text.

Defined results: a null text has no words and fails the base rules; repeated rows are judged one by one;
unknown and null languages form the language "other"; other columns are ignored. The references are one
row per listed language and one for the others; they are read by the driver and enter the plan as constants.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.llm.base import materialise, split_words

# The most common words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on are as with be".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par".split(),
    "es": "de la que el en y a los del se las por un para con una".split(),
}

#: All of them once; counts are kept in this order.
ALL_COMMON = sorted({w for ws in COMMON_WORDS.values() for w in ws})

#: Character classes, each taken out of what the classes before it have left; the rest is the last bin.
CLASSES = [
    ("space", r"[ \t-\r]+"),
    ("lower", r"[a-z]+"),
    ("upper", r"[A-Z]+"),
    ("digit", r"[0-9]+"),
    ("symbol", r"[#*$%&|<>]+"),
    ("stop", r"[.,;:!?'\"()\-]+"),
    ("letter", r"\p{L}+"),
]


@dataclass(frozen=True)
class QualitySettings:
    window: int = 5
    least_words: int = 10
    most_repeated: int = 20  # per cent of the words
    judged_chars: int = 200
    judged_words: int = 60
    reference_words: int = 2000
    char_limit: float = 0.30
    word_limit: float = 0.42
    share_limit: float = 0.20
    other_margin: float = 0.02


def _window_hashes(words: Column, width: int) -> Column:
    last = F.size(words) - width
    grams = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))
    return F.when(last >= 0, grams).otherwise(F.array().cast("array<bigint>"))


def text_features(docs: DataFrame, cfg: QualitySettings = QualitySettings()) -> DataFrame:
    """doc_id, lang_key, the base counts, base_failed, chars (class counts), common (counts of ``ALL_COMMON``).

    Wide columns leave the row as soon as their counts are taken.
    """
    lang = F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise("other").alias("lang_key")
    rows = docs.select("doc_id", lang, F.coalesce(F.col("text"), F.lit("")).alias("t0"))
    for i, (_, pattern) in enumerate(CLASSES):
        rows = rows.withColumn(f"t{i + 1}", F.regexp_replace(f"t{i}", pattern, ""))
    lengths = [F.length(f"t{i}") for i in range(len(CLASSES) + 1)]
    counts = [lengths[i] - lengths[i + 1] for i in range(len(CLASSES))] + [lengths[-1]]
    rows = rows.select("doc_id", "lang_key", F.array(*counts).alias("chars"), "t0")
    lines = F.filter(F.split("t0", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    rows = rows.select("doc_id", "lang_key", "chars", lines.alias("lines"), split_words(F.col("t0")).alias("words"))
    spelled = sorted({v for w in ALL_COMMON for v in (w, w.capitalize())})
    hits = F.transform(F.filter("words", lambda w: w.isin(*spelled)), lambda w: F.lower(w))
    counted = ["doc_id", "lang_key", "chars", "n_dup_lines", "n_words", "hits"]
    rows = rows.select("doc_id", "lang_key", "chars", (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), F.size("words").alias("n_words"), hits.alias("hits"), _window_hashes(F.col("words"), cfg.window).alias("grams"))
    # Words inside repeated windows: sort the windows by hash, keep those that equal a neighbour, add up what
    # their positions cover. Only texts with a repeated window need the sort.
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    ordered = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    rows = rows.select(*counted, F.when(repeats, ordered).alias("sorted"))
    same = lambda i, x: F.coalesce(F.get("sorted", i)["g"] == x["g"], F.lit(False))
    twice = F.filter("sorted", lambda x, i: same(i - 1, x) | same(i + 1, x))
    rows = rows.select(*counted, F.sort_array(F.transform(twice, lambda x: x["i"])).alias("starts"))
    steps = F.transform("starts", lambda p, i: F.least(F.lit(cfg.window), F.coalesce(F.get("starts", i + 1) - p, F.lit(cfg.window))))
    rows = rows.select(*counted, F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).alias("n_repeat_words"))
    listed = F.array(*map(F.lit, ALL_COMMON))
    common = F.transform(listed, lambda w: F.size("hits") - F.size(F.array_remove("hits", w)))
    failed = (F.col("n_words") < cfg.least_words) | (100 * F.col("n_repeat_words") > cfg.most_repeated * F.col("n_words"))
    at = {name: F.get("chars", F.lit(i)) for i, (name, _) in enumerate(CLASSES)}
    word_chars = F.aggregate("chars", F.lit(0), lambda a, x: a + x) - at["space"]
    return rows.select(
        "doc_id", "lang_key", F.col("n_words").cast("long"), word_chars.cast("long").alias("word_chars"), at["symbol"].cast("long").alias("n_symbols"),
        F.col("n_dup_lines").cast("long"), F.col("n_repeat_words").cast("long"), failed.alias("base_failed"), "chars", common.alias("common"),
    )


def references(features: DataFrame) -> DataFrame:
    """One row per language key: summed histograms of the documents that pass the base rules."""
    total = lambda c, n: F.array(*[F.sum(F.get(c, F.lit(i)).cast("long")) for i in range(n)])
    sums = [total("chars", len(CLASSES) + 1).alias("ref_chars"), total("common", len(ALL_COMMON)).alias("ref_common"), F.sum("n_words").alias("ref_words")]
    return features.filter("not base_failed").groupBy("lang_key").agg(*sums)


def distance(counts: Column, reference: list[int]) -> Column:
    """Jensen-Shannon distance of a histogram (array of counts) from a reference, base 2."""
    whole = float(sum(reference))
    shares = F.array(*[F.lit(x / whole) for x in reference])
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    terms = F.zip_with(F.transform(counts, lambda x: x / total), shares, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.round(F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0))), 6)


def judge(docs: DataFrame, cfg: QualitySettings = QualitySettings()) -> DataFrame:
    """Base counts, base_failed, kept and the distances (null where a guard holds) of every row."""
    features = materialise(text_features(docs, cfg), "quality-features")
    told = references(features).agg(F.collect_list(F.struct("lang_key", "ref_chars", "ref_common", "ref_words")).alias("rows")).first()["rows"]
    refs = {r["lang_key"]: r for r in told if r["ref_words"] >= cfg.reference_words}
    none = F.lit(None).cast("double")
    n = F.col("n_words")

    def words_of(lang: str, counts) -> list:
        return [counts(ALL_COMMON.index(w)) for w in COMMON_WORDS[lang]]

    of_text, of_ref, shares = {}, {}, {}
    for lang in (k for k in COMMON_WORDS if k in refs):
        mine = words_of(lang, lambda i: F.get("common", F.lit(i)).cast("long"))
        theirs = words_of(lang, lambda i, r=refs[lang]: r["ref_common"][i])
        common, size = sum(mine[1:], mine[0]), refs[lang]["ref_words"]
        of_ref[lang] = (sum(theirs), size)
        of_text[lang] = distance(F.array(*mine, n - common), [*theirs, size - sum(theirs)])
        few = common * F.lit(size) < n * F.lit(sum(theirs))
        shares[lang] = F.when(few, distance(F.array(common, n - common), [sum(theirs), size - sum(theirs)])).otherwise(0.0)

    def by_language(values: dict[str, Column]) -> Column:
        return reduce(lambda e, k: F.when(F.col("lang_key") == k, values[k]).otherwise(e), values, none)

    others = {k: F.least(*[v for j, v in of_text.items() if j != k], F.lit(1.0), F.lit(1.0)) for k in of_text}
    long_enough = n >= cfg.judged_words
    rows = features.withColumns(
        {
            "char_distance": F.when(F.col("word_chars") >= cfg.judged_chars, by_language({k: distance(F.col("chars"), r["ref_chars"]) for k, r in refs.items()})),
            "word_distance": F.when(long_enough, by_language(of_text)),
            "share_distance": F.when(long_enough, by_language(shares)),
            "other_distance": F.when(long_enough, by_language(others)),
        }
    )
    fits = (F.coalesce("char_distance", F.lit(0.0)) <= cfg.char_limit) & (F.coalesce("word_distance", F.lit(0.0)) <= cfg.word_limit)
    fits &= F.coalesce("share_distance", F.lit(0.0)) <= cfg.share_limit
    fits &= F.coalesce(F.col("other_distance") >= F.col("word_distance") - cfg.other_margin, F.lit(True))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return rows.select(*base, (~F.col("base_failed") & fits).alias("kept"), "char_distance", "word_distance", "share_distance", "other_distance")
