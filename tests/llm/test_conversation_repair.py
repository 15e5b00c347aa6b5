"""Conversation repair against a plain version that tries all edits."""

import hashlib
import random
import sys
import zlib
from functools import lru_cache
from pathlib import Path

import pytest

from sensorqc.llm import base, queries
from sensorqc.llm import conversation_repair as cr
from sensorqc.llm.base import table

DATA = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string, audit string, symbol int, n int"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        role, text = show(role), show(text)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain_report(rows):
    """rows of one conversation -> the contract's columns."""
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), digest(r[2], r[3])))
    seen, faults = set(), []
    for _, _, role, text in rows:
        core = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in {"su", "ua", "au"} for a, b in zip(rows, rows[1:]))

    @lru_cache(None)
    def best(i, made, inserts):
        """(cost, audit) of rows from i, after the last two initials made."""
        ways = []
        if i == len(rows):
            if made in ("", "ua", "a"):
                ways.append((0, ""))
        else:
            fault, role = faults[i], rows[i][2][:1]
            c, a = best(i + 1, made, 0)
            ways.append((2 + c, "D" + a))
            if fault in ("", "truncated"):
                late = 5 * (fault == "truncated")
                for letter, new, price in (("K", role, 0), ("R", "u", 1), ("R", "a", 1)):
                    if (after := follow(made, new)) is not None:
                        c, a = best(i + 1, after, 0)
                        ways.append((price + late + c, letter + a))
        if inserts < 3:
            for new in "ua":
                if (after := follow(made, new)) is not None:
                    c, a = best(i, after, inserts + 1)
                    ways.append((5 + c, "I" + a))
        return min(ways) if ways else (10**9, "")

    def follow(made, new):
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[made]
        return new if new and new in allowed else None

    sys.setrecursionlimit(20000)
    cost, audit = best(0, "", 0)
    state, at, parts = "", 0, []
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "K":
            role, text, at = rows[at][2], rows[at][3], at + 1
        else:
            role = "assistant" if state == "u" else "user"
            text = "" if letter == "I" else rows[at][3]
            at += letter == "R"
        state = role[0]
        parts.append(f"{role}:{text}")
    count = faults.count
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(parts).encode()).hexdigest()


def by_conversation(rows, ids=()):
    groups = {c: [] for c in ids}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return {c: plain_report(g) for c, g in groups.items()}


def result(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def make(seed, conversations, length):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(0, length)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "Sam", "u", None])
            text = rng.choice(["Fine.", "Yes!", "Open", "and so", "", " \t", None, "Why? \n", f"Text {rng.randrange(9)}."])
            turn = rng.choice([t, t, t, t + 3, 1, None])
            rows += [(c if c else None, turn, role, text)] * rng.choice([1, 1, 1, 2])
    return rows


def frame(spark, rows):
    base.prepare(spark)
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], ROWS).repartition(5)


def test_equals_plain(spark):
    rows = make(3, 150, 9)
    assert result(cr.report(frame(spark, rows))) == by_conversation(rows)


def test_damage_equals_plain(spark):
    rows = make(5, 60, 8)
    got = cr.damage(frame(spark, rows)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.conv_id, r.turn, r.role, r.text) for r in got), key=key) == sorted(plain_damage(rows), key=key)


def test_conversation_cut_by_ranges(spark):
    """One conversation with most rows, repeated texts and turns, next to small ones."""
    rng = random.Random(8)
    rows = [(7, rng.randrange(300), rng.choice(["user", "assistant"]), rng.choice(["Same.", "Cut", f"T{i}."])) for i in range(600)]
    rows += [(7, 5, "user", "Same.")] * 40 + make(9, 20, 5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = cr.signatures(frame(spark, rows).repartition(7))
        assert {r.conv_id: len(r.signature) for r in pieces.collect()}[7] == 640 + sum(r[0] == 7 for r in make(9, 20, 5))
        assert result(cr.report(frame(spark, rows))) == by_conversation(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repaired_rows_follow_the_grammar(spark):
    import re

    rows = make(11, 80, 9)
    groups = {}
    for r in cr.repair(frame(spark, rows)).collect():
        groups.setdefault(r.conv_id, []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: r.position)
        assert [r.position for r in g] == list(range(len(g)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in g))
        assert all(r.text == "" for r in g if r.edit == "I")


def test_nodes_are_shared_from_the_end():
    nodes = cr.SuffixNodes()
    first = nodes.audit("sua" * 3)
    assert nodes.audit("sua" * 3) == first and nodes.entered == 9
    nodes.audit("uua" + "sua" * 2)
    assert nodes.entered == 10
    fresh = cr.SuffixNodes()
    assert [fresh.audit(s) for s in ("", "u", "s", "d", "Ua", "UA")] == [(0, ""), (2, "D"), (2, "D"), (2, "D"), (4, "DD"), (4, "DD")]


def test_long_conversation():
    cost, audit = cr.SuffixNodes().audit("ua" * 200_000 + "d")
    assert cost == 2 and audit == "K" * 400_000 + "D"


def test_empty_table_and_rowless_conversations(spark):
    empty = spark.createDataFrame([], ROWS)
    assert cr.report(empty).count() == 0
    ids = spark.createDataFrame([(4,), (None,), (4,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert result(cr.report(empty, ids)) == {4: nothing, None: nothing}


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_plain(spark, size):
    data = f"/root/testdata/{size}"
    rows = [tuple(r) for r in table(spark, data, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = result(queries.QUERIES["op11_conversation_repair"](spark, data))
    assert got == by_conversation(plain_damage(rows), {r[0] for r in rows})
