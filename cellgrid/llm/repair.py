"""Repair of conversation structure at least cost.

The rows of a conversation, in order of turns, are edited (Keep, Rerole, Delete, Insert) until the roles read as a system
row, if there is one, and then pairs of user and assistant. A node is a place between rows and a state of that pattern. A cost
DP from the end finds which arcs are optimal; nodes are then ranked by the least audits of 1, 2, 4, ... edits that start at
them, each length from two of half that length by pointers that double, and the least path follows these pointers.

Conversations that lie within one sorted range are repaired as they stream by. One that is cut by the ends of ranges, or is
longer than a piece, is repaired by pieces: costs across pieces are products of 4 x 4 matrices, states across pieces are
compositions of maps, and both are found by joins at distances 1, 2, 4, ... between pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

#: Costs of edits; Keep costs nothing.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows and characters of a piece, at most (but for one row).
PIECE, PIECE_CHARS = 4096, 1 << 18
#: States: nothing yet, after a system row, after a user row, after an assistant row. An end is fine in the first and the last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 40
END = np.array([0, NEVER, NEVER, 0], np.int64)
#: The state after a user or assistant row is put at each state, and after a kept row by its initial.
_NEXT = (USER, USER, ASSISTANT, USER)
_KEPT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
_PAIRS = ("su", "ua", "au")
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_BLANK = r"[^\x20\x09-\x0D]"

_SOLVED = "audit string, cost long, hash string"
_PACKED = f"key string, part int, place long, whole boolean, n long, first string, last string, illegal long, roles array<string>, texts array<string>, faults array<string>, {_SOLVED}"


def costs(roles: list[str], faults: list[str], after: np.ndarray, last: bool) -> np.ndarray:
    """(rows + 1, 4): the least cost from each node to the end, given the costs at the place after the last row. last: that
    place is the conversation's end, where rows can still be put in."""
    out = [tuple(int(x) for x in after)]
    if last:
        out[0] = _with_inserts(out[0])
    for role, fault in zip(reversed(roles), reversed(faults), strict=True):
        b = out[-1]
        here = [x + DELETE for x in b]
        if fault not in ("blank", "duplicate"):
            extra, kept = TRUNCATED * (fault == "truncated"), _KEPT.get(role[:1], (None,) * 4)
            for s in range(4):
                here[s] = min(here[s], extra + REROLE + b[_NEXT[s]], extra + b[kept[s]] if kept[s] is not None else NEVER)
        out.append(_with_inserts(here))
    return np.array(out[::-1], np.int64)


def _with_inserts(b) -> tuple[int, int, int, int]:
    user, assistant = min(b[USER], INSERT + b[ASSISTANT]), min(b[ASSISTANT], INSERT + b[USER])
    return min(b[NONE], INSERT + user), min(b[SYSTEM], INSERT + user), user, assistant


def optimal_arcs(roles: list[str], faults: list[str], cost: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each node 4 * place + state the letters of its optimal arcs, and where they lead; in order of letters, 0 where
    there is no further one. Each letter leads to one node, so a node and a letter name an arc."""
    n = len(roles)
    at, s = np.repeat(np.arange(n + 1), 4), np.tile(np.arange(4), n + 1)
    flat = np.minimum(cost, NEVER).ravel()
    dead = np.array([f in ("blank", "duplicate") for f in faults] + [True])
    extra = np.array([TRUNCATED * (f == "truncated") for f in faults] + [0])
    table = {"s": 0, "u": 1, "a": 2}
    kept_to = np.array([[-1 if x is None else x for x in _KEPT[c]] for c in "sua"] + [[-1] * 4])
    initial = np.array([table.get(r[:1], 3) for r in roles] + [3])
    nxt = np.array(_NEXT)[s]
    keep = kept_to[initial[at], s]
    inside = at < n
    follow = np.minimum(4 * (at + 1), 4 * n)
    ways = (
        (b"D", follow + s, DELETE, inside),
        (b"I", 4 * at + nxt, INSERT, inside | last),
        (b"K", follow + np.maximum(keep, 0), extra[at], inside & (keep >= 0) & ~dead[at]),
        (b"R", follow + nxt, REROLE + extra[at], inside & ~dead[at]),
    )
    letters, ends = np.zeros((len(at), 4), np.uint8), np.repeat(np.arange(len(at)), 4).reshape(-1, 4)
    for k, (letter, to, price, possible) in enumerate(ways):
        good = possible & (flat < NEVER) & (flat == price + flat[to])
        letters[good, k], ends[good, k] = letter[0], to[good]
    return letters, ends


def least_paths(letters: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Letters of the first edit on each node's least path, and pointers 1, 2, 4, ... edits along it (at an end, to itself).

    A node's rank orders the least audits of so many edits; ranks of twice the length are those of pairs. Where several
    optimal arcs leave a node, the letter decides, and of equal letters the rank of what follows.
    """
    none = 256
    codes = np.where(letters > 0, letters.astype(np.int64), none)
    rank = np.where(codes.min(axis=1) == none, 0, codes.min(axis=1))
    while True:
        arc = (codes * (rank.max() + 1) + rank[ends]).argmin(axis=1)
        rows = np.arange(len(codes))
        first, jump = np.where(codes[rows, arc] == none, 0, codes[rows, arc]), ends[rows, arc]
        jumps, pair, done = [jump], first, 1
        while done < most:
            pair = np.unique(pair * (pair.max() + 1) + pair[jumps[-1]], return_inverse=True)[1]
            jumps.append(jumps[-1][jumps[-1]])
            done *= 2
        again = (codes * (pair.max() + 1) + pair[ends]).argmin(axis=1)
        if (again == arc).all():  # at once, as letters of a node's arcs differ
            return first.astype(np.uint8), jumps
        rank = pair


def walk(start: int, letters: np.ndarray, jumps: list[np.ndarray]) -> tuple[bytes, np.ndarray]:
    """The edits from a node to the end of its path and the nodes they start at: 1, 2, 4, ... nodes at a time."""
    path = np.array([start])
    for jump in jumps:
        path = np.concatenate([path, jump[path]])
    ended = letters[path] == 0
    path = path[: int(ended.argmax())] if ended.any() else path
    return letters[path].tobytes(), path


def solve(roles: list[str], faults: list[str], after: np.ndarray = END, last: bool = True) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    cost = costs(roles, faults, after, last)
    letters, jumps = least_paths(*optimal_arcs(roles, faults, cost, last), 2 * len(roles) + 4)
    return cost, letters, jumps


def repaired(roles: list[str], texts: list[str], audit: bytes, path: np.ndarray) -> list[str]:
    """``role:text`` of the rows that the edits leave."""
    out, at = [], 0
    for letter, node in zip(audit, path, strict=True):
        to = _NEXT[node % 4]
        if letter == ord("I"):
            out.append(f"{_ROLE[to]}:")
            continue
        if letter == ord("K"):
            out.append(f"{roles[at]}:{texts[at]}")
        elif letter == ord("R"):
            out.append(f"{_ROLE[to]}:{texts[at]}")
        at += 1
    return out


def _pack(batches: Iterator[pd.DataFrame], piece: int) -> Iterator[pd.DataFrame]:
    """Rows in order to pieces of conversations. One that begins and ends within the range, in one piece, is solved at once."""
    key, rows, chars, place, part = None, [], 0, 0, -1

    def flush(closed: bool) -> tuple:
        nonlocal rows, chars, place, alone
        roles, texts, faults = ([r[i] for r in rows] for i in range(3))
        whole = closed and alone
        out = (key, part, place, whole, len(rows), roles[0], roles[-1], sum(a[:1] + b[:1] not in _PAIRS for a, b in zip(roles, roles[1:], strict=False)), None if whole else roles, None if whole else texts, None if whole else faults)
        if whole:
            cost, letters, jumps = solve(roles, faults)
            audit, path = walk(NONE, letters, jumps)
            out += (audit.decode(), int(cost[0, NONE]), hashlib.sha256("\n".join(repaired(roles, texts, audit, path)).encode("utf-8", "surrogatepass")).hexdigest())
        else:
            out += (None, None, None)
        rows, chars, place, alone = [], 0, place + 1, False
        return out

    alone, names = False, [c.split()[0] for c in _PACKED.split(", ")]
    for pdf in batches:
        out = []
        for k, p, role, text, fault in zip(pdf["key"], pdf["part"], pdf["role"], pdf["text"], pdf["fault"], strict=True):
            if key is None:
                key, part = k, p  # a range's first conversation may have begun in the one before
            elif k != key:
                if rows:
                    out.append(flush(True))
                key, alone = k, True
            elif len(rows) >= piece or chars > PIECE_CHARS:
                out.append(flush(False))
            rows.append((role, text, fault))
            chars += len(text)
        yield pd.DataFrame(out, columns=names)
    if rows:  # and its last one may go on in the next
        yield pd.DataFrame([flush(False)], columns=names)


def _matrix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The costs of a piece from each state at its start to each state at its end."""
    for pdf in batches:
        out = []
        for at, key, roles, faults in zip(pdf["at"], pdf["key"], pdf["roles"], pdf["faults"], strict=True):
            unit = np.where(np.eye(4, dtype=bool), 0, NEVER)
            m = np.stack([costs(list(roles), list(faults), unit[i], False)[0] for i in range(4)], axis=1)
            out.append((at, key, np.minimum(m, NEVER).ravel()))
        yield pd.DataFrame(out, columns=["at", "key", "m"])


def _product(a: Column, b: Column) -> Column:
    """Of 4 x 4 matrices as arrays, with plus for times and the least for the sum."""
    cell = lambda i, j: F.least(*[F.get(a, F.lit(4 * i + k)) + F.get(b, F.lit(4 * k + j)) for k in range(4)], F.lit(NEVER))  # noqa: E731
    return F.array(*[cell(i, j) for i in range(4) for j in range(4)])


def _edits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each piece, given the costs behind it, and for each state at its start: the state at its end, edits and rows."""
    for pdf in batches:
        out = []
        for at, key, roles, texts, faults, after, last in zip(*(pdf[c] for c in ("at", "key", "roles", "texts", "faults", "after", "last")), strict=True):
            roles, texts, faults = list(roles), list(texts), list(faults)
            cost, letters, jumps = solve(roles, faults, np.array(after), last)
            ends, audits, kept = [], [], []
            for state in range(4):
                reached = cost[0, state] < NEVER
                audit, path = walk(state, letters, jumps) if reached else (b"", np.array([], int))
                # the node behind the last edit tells the state, and a piece that edits nothing passes it on
                ends.append(int(jumps[0][path[-1]] % 4) if len(path) else state)
                audits.append(audit.decode())
                kept.append("".join(f"{x}\n" for x in repaired(roles, texts, audit, path)))
            out.append((at, key, ends, audits, kept, int(cost[0, NONE])))
        yield pd.DataFrame(out, columns=["at", "key", "ends", "audits", "kept", "cost"])


def _join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of conversations in order to one row each. Texts are hashed as they pass; only edits are held."""
    key, audit, cost, digest, tail = None, [], 0, None, b""
    for pdf in batches:
        out = []
        for k, a, text, c in zip(pdf["key"], pdf["audit"], pdf["kept"], pdf["cost"], strict=True):
            if k != key:
                if key is not None:
                    digest.update(tail[:-1])
                    out.append((key, "".join(audit), cost, digest.hexdigest()))
                key, audit, cost, digest, tail = k, [], c, hashlib.sha256(), b""
            audit.append(a)
            if text:
                digest.update(tail)
                tail = text.encode("utf-8", "surrogatepass")
        yield pd.DataFrame(out, columns=["key", "audit", "cost", "hash"])
    if key is not None:
        digest.update(tail[:-1])  # without the last line end
        yield pd.DataFrame([(key, "".join(audit), cost, digest.hexdigest())], columns=["key", "audit", "cost", "hash"])


def _numbered(pieces: DataFrame) -> DataFrame:
    """pieces with at, consecutive over all ranges; what is joined has one row a range."""
    sizes = pieces.groupBy("part").agg(F.count("*").alias("k"))
    before = F.coalesce(F.sum("k").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pieces.join(sizes.select("part", before.alias("before")), "part").withColumn("at", F.col("before") + F.col("place"))


def repair(rows: DataFrame, keys: DataFrame | None = None, piece: int = PIECE) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text): conv_id, n_rows, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256. keys (conv_id): conversations that are returned even without rows. piece: rows that are repaired at once, at most.

    Rows are taken by turn, nulls first, and at one turn by role and text; copies stand together. Nulls in role and text are
    one space, a null conv_id is a conversation of its own. The first fault of a row counts: blank, duplicate (role and
    text seen earlier), truncated (the last character that isn't white isn't . ! or ?). Blank and duplicate rows must go. Of
    the cheapest edits those with the least audit (D < I < K < R) are made. A conversation without rows has zeros, an
    empty audit and the hash of nothing; an empty table gives an empty table. A text is one value and an audit is one
    value, so a conversation's audit is held in one task; its texts are not.
    """
    scratch, like = Scratch(rows.sparkSession), rows.schema["conv_id"].dataType
    key = lambda: F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n")).alias("key")  # noqa: E731
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)  # noqa: E731
    r = rows.select(key(), "turn", space("role"), space("text")).withColumn("seen", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
    turn = F.struct(F.col("turn").isNotNull().alias("is"), F.col("turn").alias("turn")).alias("turn")
    first = r.groupBy("key", "seen").agg(F.min(turn).alias("turn"))
    # a row and the mark of its first turn meet in one aggregate, so that no text is a join's hot key
    group = ["key", "turn", "seen"]
    counted = r.select("key", turn, "seen", "role", "text", F.lit(1).alias("k"), F.lit(False).alias("first"))
    marks = first.select(*group, F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("k"), F.lit(True).alias("first"))
    same = counted.unionByName(marks).groupBy(*group).agg(F.max("role").alias("role"), F.max("text").alias("text"), F.sum("k").alias("k"), F.max("first").alias("first"))
    blank, cut = ~F.col("text").rlike(_BLANK), ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    alone = F.when(blank, "blank").when(~F.col("first"), "duplicate").when(cut, "truncated").otherwise("")
    copies = F.concat(F.array(alone), F.array_repeat(F.when(blank, "blank").otherwise("duplicate"), (F.col("k") - 1).cast("int")))
    judged = same.select("key", "turn", "role", "text", F.posexplode(copies).alias("copy", "fault"))
    order = ["key", "turn", "role", "text", "copy"]
    dealt = judged.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    packed = scratch.save(dealt.select("key", "part", "role", "text", "fault").mapInPandas(lambda it: _pack(it, piece), _PACKED), "pieces")

    pieces = scratch.save(_numbered(packed.select("key", "part", "place", "whole", "first", "last")).select("at", "key", "part", "place", "whole", "first", "last"), "places")
    cut_up = pieces.filter("not whole").select("at", "key", "part", "place")
    texts = packed.filter("not whole").join(cut_up.select("part", "place", "at"), ["part", "place"]).select("at", "key", "roles", "texts", "faults")
    sums = cut_up.groupBy("key").agg(F.count("*").alias("n"))
    longest = sums.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]

    # costs from each piece to the end: products over 1, 2, 4, ... pieces
    m = scratch.save(texts.select("at", "key", "roles", "faults").mapInPandas(_matrix, "at long, key string, m array<long>"), "costs-0")
    step, i = 1, 0
    while step < longest:
        ahead = m.select((F.col("at") - step).alias("at"), "key", F.col("m").alias("b"))
        m = scratch.save(m.join(ahead, ["at", "key"], "left").select("at", "key", F.when(F.col("b").isNull(), F.col("m")).otherwise(_product(F.col("m"), F.col("b"))).alias("m")), f"costs-{i + 1}")
        step, i = 2 * step, i + 1
    # what is behind a piece: the costs at the next one, or the conversation's end, where rows may be put in
    closed = F.array(*[F.lit(int(x)) for x in _with_inserts(END)]).cast("array<long>")
    to_end = F.array(*[F.least(*[F.get("m", F.lit(4 * s + e)) + F.get(closed, F.lit(e)) for e in range(4)], F.lit(NEVER)) for s in range(4)])
    behind = m.select((F.col("at") - 1).alias("at"), "key", to_end.alias("after"))
    end = F.array(*[F.lit(int(x)) for x in END]).cast("array<long>")
    known = texts.join(behind, ["at", "key"], "left").withColumn("last", F.col("after").isNull()).withColumn("after", F.coalesce("after", end))
    edited = scratch.save(known.select("at", "key", "roles", "texts", "faults", "after", "last").mapInPandas(_edits, "at long, key string, ends array<int>, audits array<string>, kept array<string>, cost long"), "edits")

    # the state at the start of each piece: maps composed over 1, 2, 4, ... pieces before it
    through = scratch.save(edited.select("at", "key", F.col("ends").alias("f")), "states-0")
    step, i = 1, 0
    while step < longest:
        before = through.select((F.col("at") + step).alias("at"), "key", F.col("f").alias("g"))
        both = through.join(before, ["at", "key"], "left")
        through = scratch.save(both.select("at", "key", F.when(F.col("g").isNull(), F.col("f")).otherwise(F.transform("g", lambda x: F.get("f", x))).alias("f")), f"states-{i + 1}")
        step, i = 2 * step, i + 1
    entry = through.select((F.col("at") + 1).alias("at"), "key", F.get("f", F.lit(NONE)).alias("state"))
    chosen = edited.join(entry, ["at", "key"], "left").withColumn("state", F.coalesce("state", F.lit(NONE)))
    parts = chosen.select("key", "at", F.get("audits", F.col("state")).alias("audit"), F.get("kept", F.col("state")).alias("kept"), "cost")
    long_ones = parts.repartition("key").sortWithinPartitions("key", "at").mapInPandas(_join_up, f"key string, {_SOLVED}")
    solved = packed.filter("whole").select("key", "audit", "cost", "hash").unionByName(long_ones)

    # neighbouring roles: within pieces, and between one piece and the next
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")  # noqa: E731
    inside = packed.groupBy("key").agg(F.sum("illegal").alias("inside"))
    following = pieces.filter("not whole").select((F.col("at") - 1).alias("at"), "key", F.col("first").alias("next"))
    clash = ~F.concat(F.substring("last", 1, 1), F.substring("next", 1, 1)).isin(*_PAIRS)
    across = pieces.filter("not whole").join(following, ["at", "key"]).filter(clash).groupBy("key").agg(F.count("*").alias("across"))
    faults = same.groupBy("key").agg(
        F.sum("k").alias("n_rows"), F.sum(F.when(blank, F.col("k"))).alias("blank"), F.sum(F.when(~blank, F.col("k") - F.col("first").cast("int"))).alias("duplicate"),
        F.count_if(~blank & F.col("first") & cut).alias("truncated"), F.min("turn.turn").alias("lo"), F.max("turn.turn").alias("hi"),
    )  # fmt: skip
    turns = r.filter("turn is not null").groupBy("key", "turn").agg(F.lit(1)).groupBy("key").agg(F.count("*").alias("turns"))
    out = (keys if keys is not None else rows).select(key()).distinct()
    for more in (faults, turns, inside, across, solved):
        out = out.join(more, "key", "left")
    conv = F.when(F.col("key") != "n", F.substring("key", 2, 1 << 30)).cast(like).alias("conv_id")
    return out.select(
        conv, zero(F.col("n_rows")).alias("n_rows"), zero(F.col("hi") - F.col("lo") + 1 - F.col("turns")).alias("gaps"), *[zero(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")],
        (zero(F.col("inside")) + zero(F.col("across"))).alias("illegal"), zero(F.col("cost")).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("hash", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )  # fmt: skip


def damage(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) with a fifth of the rows damaged, by a digest of conversation and turn: left
    out, emptied, without end marks, repeated, or by the user. Nulls in role and text, and in the digest, are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), (F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20).alias("how"))
    how = F.col("how")
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(1), F.when(how == 3, 2).otherwise(1))
    kept = rows.filter(how != 0).select("conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("_"))
    return kept.drop("_")


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i::INT, 1))::BIGINT)), lambda c, b:
  list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""


def _then(state: int, cost: str, letter: str) -> str:
    return f"{{'c': b[{state + 1}].c + {cost}, 'a': b[{state + 1}].a || '{letter}'}}"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_USER_FROM = (NONE, SYSTEM, ASSISTANT)
_INSERTED = f"""[b[1], b[2], {_least('b[3]', *(_then(s, str(INSERT), 'I') for s in _USER_FROM))}, {_least('b[4]', _then(USER, str(INSERT), 'I'), *(_then(s, str(2 * INSERT), 'II') for s in (NONE, SYSTEM)))}]"""
_KEEP = lambda initial: f"CASE WHEN init = '{initial}' THEN t ELSE {NEVER} END"  # noqa: E731
_EDITED = f"""[{_then(NONE, str(DELETE), 'D')}, {_least(_then(SYSTEM, str(DELETE), 'D'), _then(NONE, _KEEP('s'), 'K'))},
  {_least(_then(USER, str(DELETE), 'D'), *(_then(s, _KEEP('u'), 'K') for s in _USER_FROM), *(_then(s, f't + {REROLE}', 'R') for s in _USER_FROM))},
  {_least(_then(ASSISTANT, str(DELETE), 'D'), _then(USER, _KEEP('a'), 'K'), _then(USER, f't + {REROLE}', 'R'))}]"""

SQL = rf"""
WITH RECURSIVE c AS (SELECT coalesce(conv_id::VARCHAR, ' ') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
h AS (SELECT *, ({_CRC}) % 20 AS how FROM c),
r AS (SELECT key, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role, CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM h, range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS i FROM r),
f AS (SELECT *, role[1] AS init, lag(role[1]) OVER (PARTITION BY key ORDER BY i) AS before, CASE WHEN NOT regexp_matches(text, '[^ 	

]') THEN 'blank' WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][ 	

]*\z') THEN 'truncated' ELSE '' END AS fault FROM o),
g AS (SELECT *, CASE fault WHEN 'truncated' THEN {TRUNCATED} WHEN '' THEN 0 ELSE {NEVER} END::BIGINT AS t FROM f),
w AS (SELECT key, 1::BIGINT AS i, [{{'c': 0::BIGINT, 'a': ''}}, {{'c': {NEVER}::BIGINT, 'a': ''}}, {{'c': {NEVER}::BIGINT, 'a': ''}}, {{'c': {NEVER}::BIGINT, 'a': ''}}] AS b FROM (SELECT DISTINCT key FROM g)
  UNION ALL SELECT key, i + 1, {_EDITED} FROM (SELECT w.key, w.i, {_INSERTED} AS b, init, t FROM w JOIN g ON g.key = w.key AND g.i = w.i)),
e AS (SELECT key, list_min([b[1], b[4]]) AS x FROM (SELECT w.key, {_INSERTED} AS b FROM w JOIN (SELECT key, max(i) + 1 AS i FROM g GROUP BY key) z ON w.key = z.key AND w.i = z.i)),
l AS (SELECT key, pos, x.a[pos] AS letter FROM (SELECT key, x, unnest(range(1, length(x.a) + 1))::INT AS pos FROM e)),
m AS (SELECT l.key, pos, letter, g.role, coalesce(g.text, '') AS text, row_number() OVER (PARTITION BY l.key ORDER BY pos) AS k FROM (SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY key ORDER BY pos) AS at FROM l) l
  LEFT JOIN g ON g.key = l.key AND g.i = l.at AND letter <> 'I' WHERE letter <> 'D'),
y AS (SELECT key, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (k - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos)) AS hash
  FROM (SELECT *, max((k = 1 AND letter = 'K' AND role[1] = 's')::INT) OVER (PARTITION BY key) AS sys FROM m) GROUP BY key),
n AS (SELECT key, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND coalesce(before, '') || coalesce(init, '') NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY key)
SELECT nullif(key, ' ')::BIGINT AS conv_id, coalesce(n_rows, 0) AS n_rows, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(x.c, 0)::BIGINT AS cost, coalesce(x.a, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT key FROM c) k LEFT JOIN n USING (key) LEFT JOIN e USING (key) LEFT JOIN y USING (key)
"""
