"""Line dedup: repeated runs of lines, found by distributed prefix doubling over line-id sequences.

Only DataFrame functions. A document is the sequence of its lines that hold a word; blank lines are
left out of the sequence and never removed. A line goes if it lies in a run of consecutive lines with
``min_words`` words or more in total that also starts earlier, in the order (doc_id, hash of the text,
line). Shorter repeats stay, so common one-line phrases don't damage clean documents.

Method. Each line gets as its name the position of its first occurrence, and blocks of 2, 4, 8, ...
lines are named by the first occurrence of their pair of half-block names: suffixes with one name at
length l form one interval of common prefix l, and the name is the interval's first member. Lines that
occur once leave at level 0. A run of enough words is covered exactly by its shortest windows that
reach ``min_words`` from their first or up to their last line; those hold ``min_words`` lines at most,
so the number of levels is fixed. A window of m lines is named by its two overlapping blocks of the
largest level that fits, and all but the first window of a name are removed.

Line ids are 128 bits of hash. Names are positions, so no later level can collide. Hot lines are
aggregated before the shuffle and joined back by equi-joins that Spark can split where they are skewed.

Defined results: a null text counts as empty and comes back as it is; null ids sort as 0;
rows that repeat both id and text count as one document and get the same result; ids with different
texts are different documents; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorqc.llm.base import WORD_BREAKS, materialise

_DOC = ["_ld_id", "_ld_hash"]
_POS = ["_ld_id", "_ld_hash", "seq"]


def _word_count(line: Column) -> Column:
    return F.size(F.filter(F.split(line, WORD_BREAKS), lambda w: w != ""))


def _identity(docs: DataFrame) -> DataFrame:
    zero = F.lit("0").cast(docs.schema["doc_id"].dataType)
    return docs.withColumns({"_ld_id": F.coalesce(F.col("doc_id"), zero), "_ld_hash": F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("doc_id").isNull())})


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per line with a word: position, line id, and its shortest windows forward and backward (null if too short)."""
    rows = _identity(docs).select(*_DOC, F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("line_no", "line"))
    rows = rows.select(*_DOC, "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), _word_count(F.col("line")).cast("long").alias("n")).filter("n > 0")
    doc = Window.partitionBy(*_DOC)
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy(*_DOC, "line_no").orderBy("h1"))).filter("copy = 1")
    rows = rows.withColumn("seq", F.row_number().over(doc.orderBy("line_no")))
    rows = rows.withColumn("upto", F.sum("n").over(doc.orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumns({"before": F.col("upto") - F.col("n"), "total": F.max("upto").over(doc)})
    ahead = F.count(F.lit(1)).over(doc.orderBy("before").rangeBetween(0, min_words - 1))
    behind = F.count(F.lit(1)).over(doc.orderBy("upto").rangeBetween(-(min_words - 1), 0))
    return rows.select(
        *_POS, "line_no", "h1", "h2",
        F.when(F.col("total") - F.col("before") >= min_words, ahead).cast("int").alias("ahead"),
        F.when(F.col("upto") >= min_words, behind).cast("int").alias("behind"),
    )


def _first_of(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The first position of each key that occurs twice, as a written table to be joined by a merge.

    Joined straight from the aggregate, all rows of a hot key would stay in its task: Spark splits a skewed
    join only where both sides come from a shuffle of their own. The merge is asked for at every size.
    """
    pos = F.struct(*_POS)
    first = rows.groupBy(*keys).agg(F.min(pos).alias(name), F.max(pos).alias("last")).filter(F.col(name) != F.col("last")).drop("last")
    return materialise(first, "first-lines").hint("merge")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The name of each row's key: its first position; rows whose key occurs once go."""
    return rows.join(_first_of(rows, keys, "name"), keys).drop(*keys)


def block_names(lines: DataFrame, min_words: int) -> list[DataFrame]:
    """For each level j, the names of repeated blocks of 2^j lines: position, level, name."""
    level = materialise(_named(lines.select(*_POS, "h1", "h2"), ["h1", "h2"]), "line-names")
    out, j = [level.withColumn("level", F.lit(0))], 0
    while 2 ** (j + 1) <= min_words and not level.isEmpty():
        doc = Window.partitionBy(*_DOC).orderBy("seq").rangeBetween(2**j, 2**j)
        pairs = level.withColumn("right", F.first("name").over(doc)).filter("right is not null").withColumnRenamed("name", "left")
        level = materialise(_named(pairs, ["left", "right"]), "line-names")
        j += 1
        out.append(level.withColumn("level", F.lit(j)))
    return out


def removed_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """Removed line numbers (from 0) as ``_ld_removed``, one row per document identity that loses any."""
    lines = materialise(line_table(docs, min_words), "lines")
    names = reduce(DataFrame.unionByName, block_names(lines, min_words))
    windows = lines.select(*_DOC, "seq", F.col("ahead").alias("m")).unionByName(lines.select(*_DOC, (F.col("seq") - F.col("behind") + 1).alias("seq"), F.col("behind").alias("m")))
    windows = windows.filter("m is not null").withColumn("level", F.floor(F.log2("m") + 1e-9).cast("int")).distinct()
    left = windows.join(names.withColumnRenamed("name", "left"), [*_POS, "level"])
    left = left.withColumn("start", F.col("seq")).withColumn("seq", (F.col("start") + F.col("m") - F.pow(F.lit(2), F.col("level"))).cast("int"))
    both = left.join(names.withColumnRenamed("name", "right"), [*_POS, "level"]).select(*_DOC, F.col("start").alias("seq"), "m", "left", "right")
    both = materialise(both, "line-windows")
    later = both.join(_first_of(both, ["left", "right", "m"], "first"), ["left", "right", "m"]).filter(F.struct(*_POS) != F.col("first"))
    gone = later.select(*_DOC, F.explode(F.sequence(F.col("seq"), F.col("seq") + F.col("m") - 1)).alias("seq")).distinct()
    gone = gone.join(lines.select(*_POS, "line_no"), _POS)
    return gone.groupBy(*_DOC).agg(F.sort_array(F.collect_list("line_no")).alias("_ld_removed"))


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` with repeated runs cut from ``text``, plus ``_ld_lines`` (lines with a word) and ``_ld_removed`` (how many of them went)."""
    gone = materialise(removed_lines(docs, min_words), "lines-removed")
    # always by a shuffle that hashes the small side: the texts needn't be sorted, and no size changes the plan
    joined = _identity(docs).join(gone.hint("shuffle_hash"), _DOC, "left")
    lines = F.split(F.col("text"), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_ld_removed"))
    text = F.when(F.col("_ld_removed").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: lines[i]), "\n"))
    n_lines = F.size(F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), lambda x: x.rlike(r"[^ \t-\r]")))
    removed = F.when(F.col("_ld_removed").isNull(), 0).otherwise(F.size("_ld_removed"))
    own = [F.col(f"`{c}`") if c != "text" else text.alias("text") for c in docs.columns]
    return joined.select(*own, n_lines.cast("long").alias("_ld_lines"), removed.cast("long").alias("_ld_removed"))


def drop_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """The pipeline's form: documents without their later copies; one that loses every line goes."""
    out = dedup_lines(docs, min_words)
    return out.filter("_ld_removed = 0 or _ld_removed < _ld_lines").select(*[f"`{c}`" for c in docs.columns])
