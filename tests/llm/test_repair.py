"""Conversation repair against a plain search, and its defined results at the edges."""

import functools
import hashlib
import random
import re
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from cellgrid.llm import repair

ROW = "conv_id long, turn long, role string, text string"
sys.setrecursionlimit(20_000)  # the plain search goes one call deep for each edit
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain(rows):
    """The contract, row by row; rows are in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1][-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)

    @functools.cache
    def best(i, state, inserted=0):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def add(letter, cost, row, at, to, more=0):
            c, audit, kept = best(at, to, more)
            ways.append((cost + c, letter + audit, (*row, *kept)))

        if inserted < 2:
            role = {"u": "user", "a": "assistant"}[NEXT[state]]
            add("I", 5, (f"{role}:",), i, NEXT[state], inserted + 1)
        if i < len(rows):
            _, role, text = rows[i]
            add("D", 2, (), i + 1, state)
            if faults[i] not in ("blank", "duplicate"):
                cut = 5 if faults[i] == "truncated" else 0
                first = role[:1]
                if first == "s" and state == "" or first in "ua" and first == NEXT[state] and first:
                    add("K", cut, (f"{role}:{text}",), i + 1, first)
                add("R", cut + 1, ({"u": "user", "a": "assistant"}[NEXT[state]] + f":{text}",), i + 1, NEXT[state])
        return min(ways, key=lambda x: x[:2]) if ways else (1 << 30, "", ())

    cost, audit, kept = best(0, "")
    turns = [t for t, _, _ in rows if t is not None]
    return {
        "n_rows": len(rows), "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest(),
    }


def conversations(seed, n, most):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(most + 1)):
            turn = rng.choice([t, t, t + 1, None]) if c % 3 == 0 else t
            text = rng.choice(["Yes.", "No", "Why?", " ", "", f"Text {t}.", f"cut {t}", None, "good!\n"])
            rows.append((c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    return rows


def order(row):
    return (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode())


@pytest.mark.parametrize(("piece", "most"), [(4096, 9), (1, 7), (3, 40)])
def test_repair_matches_plain_search(spark, piece, most):
    rows = conversations(piece, 12 if piece > 1 else 5, most)
    rows += rows[:5]  # repeated rows
    got = {r["conv_id"]: r.asDict() for r in repair.repair(spark.createDataFrame(rows, ROW), piece=piece).collect()}
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        r.pop("conv_id")
        assert r == plain(sorted(((t, " " if role is None else role, " " if text is None else text) for k, t, role, text in rows if k == c), key=order)), c


def test_one_conversation_over_many_ranges(spark):
    """A conversation with nearly all rows is cut by the ends of ranges, and by pieces."""
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t}." if t % 5 else "cut") for t in range(200)] + [(8, 0, "user", "Hi."), (8, 1, "assistant", "Hm.")]
    got = {r["conv_id"]: r.asDict() for r in repair.repair(spark.createDataFrame(rows, ROW).repartition(8), piece=16).collect()}
    for c in (7, 8):
        got[c].pop("conv_id")
        assert got[c] == plain([(t, role, text) for k, t, role, text in rows if k == c])


def test_repair_of_odd_tables(spark):
    none = spark.createDataFrame([], ROW)
    assert repair.repair(none).count() == 0
    keys = spark.createDataFrame([(1,), (None,)], "conv_id long")
    empty = {"n_rows": 0, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    got = {r["conv_id"]: r.asDict() for r in repair.repair(none, keys).collect()}
    assert got == {k: {"conv_id": k} | empty for k in (1, None)}
    # a null conversation, text ids, a very long text and columns whose names the operator uses itself
    rows = [(None, None, "user", "Long " * 300_000 + "end."), (None, 3, "assistant", "Yes."), ("x", 0, "system", "Be kind."), ("x", 1, "user", "a"), ("n", None, None, None)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").withColumns({"key": F.lit(1), "part": F.lit("p"), "fault": F.lit("f"), "m": F.lit(0)})
    got = {r["conv_id"]: r.asDict() for r in repair.repair(df).collect()}
    for c in (None, "x", "n"):
        got[c].pop("conv_id")
        assert got[c] == plain([(t, role or " ", text or " ") for k, t, role, text in rows if k == c])


def test_ranks_choose_the_least_of_equal_letters():
    """Where two arcs of one letter leave a node, what follows decides."""
    import numpy as np

    # 0 -K-> 1 -R-> 3 and 0 -K-> 2 -D-> 3
    letters = np.array([[75, 75], [82, 0], [68, 0], [0, 0]], np.uint8)
    ends = np.array([[1, 2], [3, 1], [3, 2], [3, 3]])
    first, jumps = repair.least_paths(letters, ends, 4)
    assert repair.walk(0, first, jumps)[0] == b"KD"


def test_damage(spark):
    rows = [(c, t, "assistant", f"Hi {c}. Yes!") for c in range(30) for t in range(5)] + [(None, 1, None, None), (3, None, "user", "x?")]
    want = []
    for c, t, role, text in rows:
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        want += [(c, t, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    got = [tuple(r) for r in repair.damage(spark.createDataFrame(rows, ROW)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
