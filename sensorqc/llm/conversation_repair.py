"""Conversation structure repair: cheapest edits by a suffix-shared automaton of role and fault signatures.

A conversation becomes its signature, one symbol per row: the role's initial if it means something to the grammar
(system, user, assistant, other), in upper case where the text is truncated, or ``d`` where the row must go (blank,
or role and text seen earlier). What the rest of a conversation costs depends only on the rest of its signature and
on the grammar state before it. So signatures are shared from the end: all are sorted by their reversed signature,
neighbours share the nodes of their common suffix, and each node is entered once with its cost-to-go and best first
edits for every grammar state. Nodes that differ by a constant cost have the same edits, so they share one record
(``_Class``); there are few of them. An audit is read off along the path. Ranges of the sort are cut by signature and
conversation id, so a signature that a third of all conversations have is dealt over many tasks.

No step gathers a conversation's texts. Faults are found by aggregates over digests (a row repeated within a turn is
one row with a count, and the first turn of every role and text is a minimum per conversation, role and text);
signatures are made from a global sort whose ranges may cut a conversation anywhere, and pieces are put together
afterwards. A signature and an audit are one cell with a byte or two per row. Repaired rows leave in order from a sort
by conversation; that pass, and the digest over it, read a conversation as a stream in one task, as SHA-256 has to.

Edits are Keep (0), Rerole to user or assistant (1), Delete (2), Insert an empty user or assistant text (5); a
truncated row that stays adds 5. Kept roles must read ``(s?(ua)+)?`` by their initials. Of equally cheap edit
sequences the least in ASCII order is taken; as an edit's letters decide the state after it, the first letters in
which two sequences differ settle this at every node.

Defined results: a null role or text counts as one space; a null ``conv_id`` is a conversation of its own; null turns
come first; rows of one turn are ordered by role, then by their digest; equal rows are neighbours. A conversation
without rows has zeros, an empty audit and the hash of nothing; an empty table gives no rows; other columns are
ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from sensorqc.llm.base import BATCH_ROWS, arrow_map, materialise

#: White space as the contract names it.
BLANKS = " \t\n\x0b\x0c\r"

#: Grammar states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NEXT = (USER, USER, ASSISTANT, USER)  # the state after an inserted or rerolled row
_ROLE = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class _Class:
    """Nodes with the same edits: costs above the cheapest state's, and by state the first letters and the state after them."""

    costs: tuple[int, int, int, int]
    edits: tuple[tuple[str, int], ...]


_END = _Class((0, 2 * INSERT, INSERT, 0), (("", START), ("II", ASSISTANT), ("I", ASSISTANT), ("", ASSISTANT)))


@lru_cache(maxsize=100_000)
def _before(costs: tuple[int, ...], symbol: str) -> tuple[int, _Class]:
    """The node of a row with this symbol in front of one with these costs; its cheapest cost apart."""
    role, late = symbol.lower(), TRUNCATED * symbol.isupper()
    best = []
    for state in range(4):
        ways = []
        at, letters, paid = state, "", 0
        for _ in range(3):  # a third insert leads to the state after the first
            ways.append((paid + DELETE + costs[at], letters + "D", at))
            if symbol != "d":
                if (kept := _KEEP.get((at, role))) is not None:
                    ways.append((paid + late + costs[kept], letters + "K", kept))
                ways.append((paid + late + REROLE + costs[_NEXT[at]], letters + "R", _NEXT[at]))
            at, letters, paid = _NEXT[at], letters + "I", paid + INSERT
        best.append(min(ways))
    least = min(w[0] for w in best)
    return least, _Class(tuple(w[0] - least for w in best), tuple((w[1], w[2]) for w in best))


class SuffixNodes:
    """The nodes on the path of the last signature, from the end; signatures that come sorted from their end share them."""

    def __init__(self):
        self.path, self.classes, self.base = "", [_END], array("q", [0])
        self.entered, self.last = 0, None

    def audit(self, signature: str) -> tuple[int, str]:
        """Cost and best edits of a whole conversation."""
        back = signature[::-1]
        if self.last is not None and back == self.path:
            return self.last
        shared = len(commonprefix([self.path, back]))
        del self.classes[shared + 1 :], self.base[shared + 1 :]
        for symbol in back[shared:]:
            more, node = _before(self.classes[-1].costs, symbol)
            self.base.append(self.base[-1] + more)
            self.classes.append(node)
            self.entered += 1
        self.path, state, letters = back, START, []
        for node in reversed(self.classes):
            edit, state = node.edits[state]
            letters.append(edit)
        self.last = self.base[-1] + self.classes[-1].costs[START], "".join(letters)
        return self.last


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults by the CRC of ``conv_id:turn``: dropped, emptied, unstopped, repeated or user rows."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text"), kind.alias("_cr_kind")).filter("_cr_kind <> 0")
    text = F.when(F.col("_cr_kind") == 1, "").when(F.col("_cr_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_cr_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_cr_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_cr_copy")).drop("_cr_copy")


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(" "))


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))


def _keyed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the digest that orders and compares them."""
    return rows.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text")).withColumn("digest", _digest())


ORDER = ["conv_id", "turn", "role", "digest"]

_PIECE = "part int, signature string, blank long, duplicate long, truncated long, illegal long, first string, last string, low {t}, high {t}, turns long"


def signatures(rows: DataFrame) -> DataFrame:
    """One row per conversation: signature, counts of faults, gaps, illegal neighbours."""
    core = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    light = _keyed(rows).select(
        *ORDER,
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("symbol"),
        initial.alias("initial"),
        (core == "").alias("blank"),
        (~F.right(core, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.lit(1).cast("long").alias("n"),
        F.lit(False).alias("is_first"),
    )
    light = materialise(light, "conversation-rows")
    facts = ["role", "digest", "symbol", "initial", "blank", "cut"]
    # the first of all rows with a role and text is marked by a row that counts nothing
    earliest = F.when(F.bool_or(F.col("turn").isNull()), None).otherwise(F.min("turn"))
    firsts = light.groupBy("conv_id", *facts).agg(earliest.alias("turn")).withColumn("n", F.lit(0).cast("long")).withColumn("is_first", F.lit(True))
    whole = light.unionByName(firsts).groupBy("conv_id", "turn", *facts).agg(F.sum("n").alias("n"), F.bool_or("is_first").alias("is_first"))
    turn = rows.schema["turn"].dataType.simpleString()
    key = rows.schema["conv_id"].dataType.simpleString()
    piece = f"conv_id {key}, {_PIECE.format(t=turn)}"
    names = [f.split()[0] for f in piece.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, now, out = None, None, []
        part = TaskContext.get().partitionId()

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

        def close() -> None:
            if now is not None:
                conv, signature, blank, duplicate, cut_, illegal, first, last, low, high, turns = now
                out.append((conv, part, "".join(signature), blank, duplicate, cut_, illegal, first, last, low, high, turns))

        for b in batches:
            types = types or [b.column("conv_id").type, pa.int32(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), *[b.column("turn").type] * 2, pa.int64()]
            cols = (b.column(c).to_pylist() for c in ("conv_id", "turn", "symbol", "initial", "blank", "cut", "n", "is_first"))
            for conv, turn, symbol, initial, blank, late, n, first in zip(*cols, strict=True):
                if now is None or conv != now[0]:
                    close()
                    now = [conv, [], 0, 0, 0, 0, initial, None, None, None, 0]
                stays = first and not blank
                now[1].append((symbol.upper() if late else symbol) + "d" * (n - 1) if stays else "d" * n)
                now[2] += n * blank
                now[3] += 0 if blank else n - first
                now[4] += stays and late
                now[5] += n - 1 if now[7] is None else n - 1 + (now[7] + initial not in LEGAL)
                now[7] = initial
                if turn is not None and turn != now[9]:
                    now[8] = turn if now[8] is None else now[8]
                    now[9] = turn
                    now[10] += 1
            if len(out) >= BATCH_ROWS:
                yield batch()
        close()
        if types:
            yield batch()

    pieces = arrow_map(whole.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER), cut, piece)
    p = F.array_sort(F.collect_list(F.struct(*names[1:])))  # at most one for each range of the sort
    sum_ = lambda c: F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x[c])
    pair = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.struct(F.get("p", i - 1).alias("a"), F.get("p", i).alias("b")))
    pair = F.when(F.size("p") > 1, pair).otherwise(F.array().cast(pair_type(pieces)))
    borders = lambda bad: F.size(F.filter(pair, bad)).cast("long")
    # nulls come first, so the pieces that have turns follow each other
    shared = borders(lambda x: (x["a"]["high"] == x["b"]["low"]) & x["a"]["high"].isNotNull())
    turns = sum_("turns") - shared
    out = pieces.groupBy("conv_id").agg(p.alias("p"))
    low, high = F.array_min(F.transform("p", lambda x: x["low"])), F.array_max(F.transform("p", lambda x: x["high"]))
    return out.select(
        "conv_id",
        F.array_join(F.transform("p", lambda x: x["signature"]), "").alias("signature"),
        F.coalesce((high - low + 1).cast("long") - turns, F.lit(0).cast("long")).alias("gaps"),
        *(sum_(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        (sum_("illegal") + borders(lambda x: ~F.concat(x["a"]["last"], x["b"]["first"]).isin(*LEGAL))).alias("illegal"),
    )


def pair_type(pieces: DataFrame) -> str:
    one = pieces.drop("conv_id").schema.simpleString()
    return f"array<struct<a:{one},b:{one}>>"


def plan_edits(rows: DataFrame) -> DataFrame:
    """One row per conversation: the counts of ``signatures``, cost and audit."""
    found = signatures(rows)
    names = [c for c in found.columns if c != "signature"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name != "signature") + ", cost long, audit string"

    def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = SuffixNodes()
        for b in batches:
            both = [nodes.audit(s) for s in b.column("signature").to_pylist()]
            ends = [pa.array([x[0] for x in both], pa.int64()), pa.array([x[1] for x in both], pa.string())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *ends], [*names, "cost", "audit"])

    back = found.withColumn("back", F.reverse("signature"))
    return arrow_map(back.repartitionByRange("back", "conv_id").sortWithinPartitions("back", "conv_id").drop("back"), audits, schema)


def _edited(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Plans, each followed by the repaired rows of its conversation in order; a conversation lies in one partition."""
    facts = [f for f in plans.schema if f.name not in ("conv_id", "audit")]
    kind = rows.schema["conv_id"].dataType.simpleString()
    keyed = _keyed(rows).withColumn("is_row", F.lit(True))
    heads = plans.withColumn("is_row", F.lit(False))
    both = keyed.unionByName(heads, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest")
    both = both.drop("turn", "digest")
    schema = f"conv_id {kind}, position long, edit string, role string, text string, audit string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in facts)
    fact_names = [f.name for f in facts]
    names = ["conv_id", "position", "edit", "role", "text", "audit", *fact_names]

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, at, state, position, key, types = "", 0, START, 0, None, None
        out: list[tuple] = []
        blank = (None,) * (1 + len(facts))

        def inserted() -> None:
            nonlocal at, state, position
            while at < len(letters) and letters[at] == "I":
                state = _NEXT[state]
                out.append((key, position, "I", _ROLE[state], "", *blank))
                position, at = position + 1, at + 1

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

        for b in batches:
            types = types or [b.column("conv_id").type, pa.int64(), *[pa.string()] * 4, *(b.column(c).type for c in fact_names)]
            cols = (b.column(c).to_pylist() for c in ("conv_id", "is_row", "role", "text", "audit", *fact_names))
            for conv, is_row, role, text, audit, *rest in zip(*cols, strict=True):
                if not is_row:
                    inserted()
                    key, letters, at, state, position = conv, audit, 0, START, 0
                    out.append((conv, None, None, None, None, audit, *rest))
                    continue
                inserted()
                letter, at = letters[at], at + 1
                if letter != "D":
                    state = _KEEP[state, role[:1]] if letter == "K" else _NEXT[state]
                    out.append((key, position, letter, role if letter == "K" else _ROLE[state], text, *blank))
                    position += 1
            yield batch()
        inserted()
        if types:
            yield batch()

    return arrow_map(both, edit, schema)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position, edit (K, R or I), role, text."""
    return _edited(rows, plan_edits(rows)).filter("position is not null").select("conv_id", "position", "edit", "role", "text")


def report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``ids`` names conversations (``conv_id``) that are reported even if they have no rows.
    """
    plans = plan_edits(rows)
    if ids is not None:
        counts = {c: F.lit(0).cast("long") for c in plans.columns if c not in ("conv_id", "audit")}
        plain = ids.select("conv_id").distinct().withColumns(counts).withColumn("audit", F.lit(""))
        # a conversation's own plan has the longer audit, as every row has its letter
        plans = plans.unionByName(plain).groupBy("conv_id").agg(F.max_by(F.struct(*plans.columns), F.length("audit")).alias("p")).select("p.*")
    edited = _edited(rows, plans)
    facts = [c for c in edited.columns if c not in ("conv_id", "position", "edit", "role", "text")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in edited.schema if f.name in ("conv_id", *facts)) + ", repaired_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, out, types = None, None, [], None

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * (len(facts) + 2)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["conv_id", *facts, "repaired_sha256"])

        for b in batches:
            types = types or [b.column("conv_id").type, *(b.column(c).type for c in facts), pa.string()]
            cols = (b.column(c).to_pylist() for c in ("position", "role", "text", "conv_id", *facts))
            for position, role, text, *rest in zip(*cols, strict=True):
                if position is None:
                    if head is not None:
                        out.append((*head, sha.hexdigest()))
                    head, sha = rest, hashlib.sha256()
                else:
                    sha.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            yield batch()
        if head is not None:
            out.append((*head, sha.hexdigest()))
            yield batch()

    done = arrow_map(edited, digest, schema)
    return done.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
