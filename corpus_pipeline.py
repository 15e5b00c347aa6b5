"""The corpus pipeline: documents through five operators, each stage a written table.

A stage is a function of (spark, docs, sf_dir); its result is written as Parquet in the shared work folder
and read again as the next stage's ``docs``. All stages but the last return the columns of ``documents``;
``n_chars`` follows the text. The last returns one row per packed piece with its token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorqc.llm import line_dedup, ngram_join, packing, pii, toxicity
from sensorqc.llm.base import materialise, prepare, table
from sensorqc.llm.queries import PII_KEY, WORD_TOKENIZER, tokenizer_file


def _recount(out: DataFrame, like: DataFrame) -> DataFrame:
    length = F.length("text").cast(like.schema["n_chars"].dataType) if "n_chars" in like.columns else None
    return out.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in like.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    prepare(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs of 50 words or more go, and documents made of nothing else."""
    prepare(spark)
    return _recount(line_dedup.drop_repeats(docs), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at Jaccard 0.8 stays."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to surrogates."""
    prepare(spark)
    return _recount(pii.anonymise(docs, PII_KEY), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 tokens, one row per piece with its ids."""
    prepare(spark)
    return packing.pack(docs, packing.PackSettings(tokenizer_file(WORD_TOKENIZER)), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_join", drop_near_duplicates),
    ("pii", replace_private),
    ("packing", pack),
]

#: The classifier and the tokenizer can't be said in SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
