"""Substring dedup: passages that stand in several documents, found by MinHash banding of overlapping paragraphs.

A copied passage may start anywhere, so places are chosen by content: of each ``SPACING`` shingles in a row the one with the
least hash. A paragraph is the stretch of ``WIDTH`` words that starts with such a shingle. A band's key is that shingle
with one MinHash value, a sliding minimum over the text's shingle hashes. Keys travel packed, so that those of
several documents are found without a row for each key; a key that paragraphs of different words share is open. Paragraphs
of equal words are one class, named by a 64-bit digest. Classes that share an open key are compared by the exact Jaccard similarity of their shingle
sets (of 32-bit word hashes). Components of confirmed links are the passages; the occurrence in the smallest id stays.
Repeats are then extended word by word to the ends of what both texts share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NEAR, SHINGLE, Scratch, chunks, mix, powers, scanned_words
from .graph import components

WIDTH = 39  # words; with one of them replaced, 30 of 40 shingles are shared
SPACING = 12  # each verbatim repeat of WIDTH + SPACING - 1 = 50 words holds a whole paragraph
BANDS = 2  # paragraphs of similarity 0.75 around one place meet with probability 1 - 0.25**2 = 0.938; most passages have several
FLUSH = 1 << 20  # keys that a task holds at once
NAMED = 8  # holders of a key that a task names at once; where there are more, each is told that it is shared
PART = 1 << 23  # bytes of text that are read together where shared keys are looked up
SMALL = 16  # classes of a key that are compared pair by pair; larger keys are divided by rare shingles
BLOCK = 256
_ODD = 0x9E3779B97F4A7C15


def _minima(h: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """The least of h[i : i + span] for each i of at."""
    width = 1
    while width * 2 <= span:
        h, width = np.minimum(h[:-width], h[width:]), width * 2
    return np.minimum(h[at], h[at + span - width])


def _shingled(w: np.ndarray) -> np.ndarray:
    """Hashes of the shingles along the last axis, of word hashes of 32 bits."""
    n = w.shape[-1] - SHINGLE + 1
    g = np.zeros((*w.shape[:-1], n), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            g = g * np.uint64(0x9E3779B97F4A7C15) + w[..., i : n + i]
    return g


def paragraphs(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Paragraphs of all texts: (text number, first word, band keys (n, BANDS)), then word hashes and what scanned_words
    returns after them. In a run of one word, every SPACING-th place is taken. What is chosen depends on the text alone.
    """
    h, counts, raw, start, stop = scanned_words(texts)
    none = np.zeros(0, np.int64)
    if len(h) < WIDTH:
        return none, none, np.zeros((0, BANDS), np.uint64), h, raw, start, stop
    text = np.repeat(np.arange(len(texts)), counts)
    begin = (np.cumsum(counts) - counts)[text]
    end = begin + counts[text]
    g = _shingled(h >> np.uint64(32))
    place, n = np.arange(len(g)), len(g)
    run = np.maximum.accumulate(np.where((place == begin[:n]) | np.append(True, h[1:n] != h[: n - 1]), place, 0))
    again = (h[1 : n + 1] == h[:n]) & ((place - run) % SPACING == 0)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    rank = mix(g) >> np.uint64(1)
    rank[np.append(False, g[1:] == g[:-1]) & (place > begin[:n])] = top >> np.uint64(1)  # last among those of a window
    at = np.arange(n - SPACING + 1)
    least = _minima(rank, at, SPACING)
    least[at + SPACING + SHINGLE - 1 > end[: len(at)]] = 0  # windows lie within a text
    edge = np.full(SPACING - 1, top)
    most = ~_minima(np.concatenate([edge, ~least, edge]), place, SPACING)
    at = np.flatnonzero((((rank == most) & (rank < top >> np.uint64(1))) | again) & (place + WIDTH <= end[:n]))
    keys = np.zeros((len(at), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            least = _minima(mix(g + np.uint64(b + 1)), at, WIDTH - SHINGLE + 1)
            keys[:, b] = mix((g[at] + np.uint64(1)) * np.uint64(0xD1342543DE82EF95) + mix(least + np.uint64(b)))
    return text[at], at, keys, h, raw, start, stop


def _classes(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Digests of the words of paragraphs: sums of the words' hashes, weighed by place."""
    bits = max(16, len(h).bit_length())
    with np.errstate(over="ignore"):
        run = np.append(np.uint64(0), np.cumsum(h * powers(bits, _ODD)[: len(h)]))
        return mix((run[at + WIDTH] - run[at]) * powers(bits, pow(_ODD, -1, 1 << 64))[at])


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of 32 bits by place of their bytes, so that the shuffle's compression finds what is small."""
    return np.stack(columns).astype("<u4").view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1).tobytes()


def _unpacked(data: bytes, columns: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(columns, 4, -1).transpose(0, 2, 1)).view("<u4")[..., 0]


def _keys(batches: Iterator[pd.DataFrame], bits: int, shift: int) -> Iterator[pd.DataFrame]:
    """(told, slot, data): keys by range (slot), each with the parts of documents that hold it and 16 bits of the paragraphs'
    words; or, where more than NAMED documents of a task hold a key, the key for each of their parts (slot)."""

    def packed(held: list) -> pd.DataFrame:
        key, doc = np.concatenate([k for k, _ in held]), np.concatenate([x for _, x in held])
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        own = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))
        key, doc = key[own], doc[own]
        short = key >> np.uint64(shift)
        first = np.flatnonzero(np.append(True, short[1:] != short[:-1]))
        size = np.diff(np.append(first, len(key)))
        group = np.repeat(np.arange(len(first)), size)
        place, size = np.arange(len(key)) - first[group], size[group]
        part = (doc & ((1 << bits) - 1)).astype(np.uint32)
        rows = []
        many = np.flatnonzero(size > NAMED)
        many = many[np.argsort(part[many], kind="stable")]
        for own in np.split(many, np.flatnonzero(np.diff(part[many])) + 1) if len(many) else ():
            rows.append((True, part[own[0]], short[own].tobytes()))
        # keys are sorted by the words' bits as well, so first and last differ if any do
        named = (place < NAMED - 1) | (place == size - 1)
        short, kind, part = short[named], (key[named] & np.uint64(0xFFFF)).astype(np.uint32), part[named]
        slot, low = (short >> np.uint64(64 - shift - bits)).astype(np.int64), (short & np.uint64((1 << 64 - shift - bits) - 1)).astype(np.int64)
        ends = np.append(np.flatnonzero(np.diff(slot)) + 1, len(slot))
        for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
            rows.append((False, slot[a], _packed(np.diff(low[a:b], prepend=0), part[a:b], kind[a:b])))
        return pd.DataFrame(rows, columns=["told", "slot", "data"])

    held, n = [], 0
    for pdf in batches:
        texts, docs = list(pdf["text"]), pdf["doc"].to_numpy()
        for a, b in chunks(texts):
            text, at, keys, h, *_ = paragraphs(texts[a:b])
            if len(at):
                keys = (keys >> np.uint64(16) << np.uint64(16)) | (_classes(h, at) >> np.uint64(48))[:, None]
                held.append((keys.ravel(), np.repeat(docs[a + text], BANDS)))
                n += keys.size
            if n > FLUSH:
                yield packed(held)
                held, n = [], 0
    if n:
        yield packed(held)


def _shared(key: tuple, pdf: pd.DataFrame, bits: int, shift: int) -> pd.DataFrame:
    """(part, open, keys): keys that several documents hold, for each part with such a document."""
    told, slot = key
    if told:
        own = np.unique(np.frombuffer(b"".join(pdf["data"]), np.uint64))
        return pd.DataFrame({"part": [slot], "open": [True], "keys": [own.tobytes()]})
    items = [_unpacked(x, 3) for x in pdf["data"]]
    low, part, kind = np.concatenate([np.cumsum(x[0], dtype=np.int64) for x in items]), *(np.concatenate([x[i] for x in items]) for i in (1, 2))
    order = np.argsort(low, kind="stable")
    low, part, kind = low[order], part[order], kind[order]
    first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    size = np.diff(np.append(first, len(low)))
    opened = np.repeat(np.minimum.reduceat(kind, first) < np.maximum.reduceat(kind, first), size)
    several = np.repeat(size > 1, size)
    low, part, opened = low[several], part[several], opened[several]
    order = np.lexsort((low, opened, part))
    low, part, opened = low[order].astype(np.uint64) | np.uint64(slot) << np.uint64(64 - shift - bits), part[order], opened[order]
    ends = np.append(np.flatnonzero((np.diff(part.astype(np.int64)) != 0) | (opened[1:] != opened[:-1])) + 1, len(part))[: len(part)]
    starts = np.append(0, ends[:-1])[: len(ends)]
    return pd.DataFrame({"part": part[starts].astype(np.int32), "open": opened[starts], "keys": [np.unique(low[a:b]).tobytes() for a, b in zip(starts, ends, strict=True)]})


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(keys.shape, bool)


def _found(pdf: pd.DataFrame, shared: pd.DataFrame, shift: int) -> pd.DataFrame:
    """Paragraphs of one part with a shared key: where they stand, their class, and their open keys. The words' hashes come
    with one paragraph of each class that has an open key."""
    texts, ids, docs = list(pdf["text"]), pdf["id"].to_numpy(), pdf["doc"].to_numpy()
    lists = [np.unique(np.frombuffer(b"".join(shared.loc[shared["open"] == x, "keys"]), np.uint64)) for x in (False, True)]
    known, seen = np.union1d(*lists), set()
    out = [pd.DataFrame({c: np.zeros(0, object) for c in ("id", "doc", "start", "stop", "cls", "keys", "words")})]
    for a, b in chunks(texts) if len(known) else ():
        text, at, keys, h, raw, start, stop = paragraphs(texts[a:b])
        short = keys >> np.uint64(shift)
        row = np.flatnonzero(_among(short, known).any(axis=1))
        if not len(row):
            continue
        first, short = at[row], short[row]
        chars = np.cumsum((raw & 0xC0) != 0x80)  # characters up to and with each byte
        offset = np.append(0, np.cumsum([len(t) + 1 if t else 1 for t in texts[a:b]]))[text[row]]
        opened, cls = _among(short, lists[1]), _classes(h, first).view(np.int64)
        some = opened.any(axis=1)
        _, once = np.unique(cls, return_index=True)
        once = [i for i in once[some[once]] if cls[i] not in seen]
        seen.update(cls[once])
        window = (np.lib.stride_tricks.sliding_window_view(h, WIDTH)[first[once]] >> np.uint64(32)).astype(np.uint32)
        words, keyed = np.full(len(row), None, object), np.full(len(row), None, object)
        words[once] = [w.tobytes() for w in window]
        for i in np.flatnonzero(some):
            keyed[i] = short[i, opened[i]].tolist()
        out.append(pd.DataFrame({
            "id": ids[a + text[row]],
            "doc": docs[a + text[row]],
            "start": (chars[start[first]] - 1 - offset).astype(np.int32),
            "stop": (chars[stop[first + WIDTH - 1] - 1] - offset).astype(np.int32),
            "cls": cls,
            "keys": keyed,
            "words": words,
        }))
    return pd.concat(out[1:] or out)


def _words(column) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x in column), np.uint32).reshape(-1, WIDTH).astype(np.uint64)


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Similar classes of two blocks, of different components, as a product of membership matrices."""
    for pdf in batches:
        for left, right in zip(pdf["rest"], pdf["block"], strict=True):
            ids, comp = (np.array([x[c] for x in (*left, *right)], np.int64) for c in ("cls", "comp"))
            sets = np.sort(mix(_shingled(mix(_words([x["words"] for x in (*left, *right)])))), axis=1)
            known, at = np.unique(sets, return_inverse=True)
            member = np.zeros((len(ids), len(known)), np.float32)
            member[np.repeat(np.arange(len(ids)), sets.shape[1]), at.ravel()] = 1
            n, sizes = len(left), member.sum(axis=1).astype(np.int64)
            both = (member[:n] @ member[n:].T).astype(np.int64)
            p, q = np.nonzero((100 * both >= round(100 * NEAR) * (sizes[:n, None] + sizes[n:] - both)) & (comp[:n, None] != comp[n:]))
            yield pd.DataFrame({"a": ids[p], "b": ids[n + q]})


def _near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if not len(pdf):
            continue
        sides = []
        for c in ("wa", "wb"):
            g = _shingled(mix(_words(pdf[c])))
            g.sort(axis=1)
            sides.append(g)
        distinct = lambda g: 1 + (g[:, 1:] != g[:, :-1]).sum(axis=1)
        both = np.concatenate(sides, axis=1)
        both.sort(axis=1)
        union = distinct(both)
        shared = distinct(sides[0]) + distinct(sides[1]) - union
        yield pdf.loc[100 * shared >= round(100 * NEAR) * union, ["a", "b"]]


_WORD = re.compile(r"[^\x20\t-\r]+")


def _beside(text: str, at: int, right: bool) -> str:
    """SPACING words that follow the place in the text or end there, with what divides them."""
    side = text[at:] if right else text[:at][::-1]
    ends = [m.end() for m, _ in zip(_WORD.finditer(side), range(SPACING))]  # noqa: B905
    side = side[: ends[-1] if ends else 0]
    return side if right else side[::-1]


def _agreed(a: str, b: str, right: bool) -> int:
    """Characters of a that hold the words in which a and b agree, from the place on."""
    if not right:
        a, b = a[::-1], b[::-1]
    n = 0
    for x, y in zip(_WORD.finditer(a), _WORD.finditer(b)):  # noqa: B905
        if x[0].encode("utf-8", "surrogatepass").lower() != y[0].encode("utf-8", "surrogatepass").lower():
            break
        n = x.end()
    return n


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(i, p["pos"], p["right"], _beside(t, p["pos"], p["right"])) for i, t, places in zip(pdf["doc"], pdf["text"], pdf["places"], strict=True) for p in places]
        yield pd.DataFrame(rows, columns=["doc", "pos", "right", "beside"])


def _moved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        n = np.array([_agreed(a, b, r) for a, b, r in zip(pdf["beside"], pdf["beside0"], pdf["right"], strict=True)], np.int32)
        yield pdf[["doc", "start", "stop", "keeper", "right"]].assign(n=n)


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Overlapping paragraphs of a text that agree in keeper, as one row, with the first and the last of its paragraphs
    that another document holds too."""
    for pdf in batches:
        out = []
        for doc, items in zip(pdf["doc"], pdf["items"], strict=True):
            rows = []
            for s in sorted(items, key=lambda s: (s["keeper"], s["start"], s["stop"])):
                if not rows or rows[-1][5] != s["keeper"] or s["start"] > rows[-1][3]:
                    rows.append([doc, s["id"], s["start"], s["stop"], s["passage"], s["keeper"], None, None, None, None])
                now = rows[-1]
                now[3] = max(now[3], s["stop"])
                if s["cls"] is not None and s["first"] != s["id"]:
                    if now[6] is None:
                        now[6:8] = s["cls"], s["start"]
                    if now[9] is None or s["stop"] > now[9]:
                        now[8:10] = s["cls"], s["stop"]
            out += rows
        yield pd.DataFrame(out, columns=["doc", "id", "start", "stop", "passage", "keeper", "opening", "opening_at", "last", "last_at"], dtype=object)


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            g = np.sort(mix(_shingled(mix(_words(pdf["words"])))), axis=1)
            new = np.column_stack([np.ones(len(g), bool), g[:, 1:] != g[:, :-1]])
            yield pd.DataFrame({"cls": np.repeat(pdf["cls"].to_numpy(), new.sum(axis=1)), "gram": g[new].view(np.int64)})


def _rarest(classes: DataFrame) -> DataFrame:
    """(key, cls): of each class (cls, words) as many of its rarest shingles that a class at the required similarity must hold
    one of them among its own. So a line that many texts share brings nothing together, and no similar pair is lost."""
    grams = classes.mapInPandas(_grams, "cls long, gram long")
    counted = grams.join(grams.groupBy("gram").agg(F.count("*").alias("of")), "gram")
    own = Window.partitionBy("cls")
    place, size = F.row_number().over(own.orderBy("of", "gram")), F.count("*").over(own)
    return counted.select("cls", F.col("gram").alias("key"), place.alias("place"), size.alias("size")).filter(F.col("place") <= F.col("size") - F.ceil(NEAR * F.col("size")) + 1).select("key", "cls")


def _labels(scratch: Scratch, found: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, comp): the component of each class that is similar to another. Classes of different documents that share an
    open key are linked: first each with the commonest of its key; then, where several components are left, all pairs of
    a small key, and all pairs of a large one that share a rare shingle, in blocks where many do."""
    words = scratch.save(found.filter("words is not null").groupBy("cls").agg(F.first("words").alias("words")), "words")
    keyed = found.filter("keys is not null").select("cls", F.explode("keys").alias("key")).distinct()
    # paragraphs of one document are no link, or what is similar to a repeat would spread along the text
    apart = "least(first, first_b) < greatest(final, final_b)"
    as_b = lambda d, *c: d.select(*c, F.col("cls").alias("b"), F.col("first").alias("first_b"), F.col("final").alias("final_b"))

    def grouped(keyed: DataFrame, of: DataFrame) -> DataFrame:
        several = keyed.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1")
        return keyed.join(several, "key").join(of, "cls")

    def near(pairs: DataFrame, name: str) -> DataFrame:
        wa, wb = [words.select(F.col("cls").alias(c), F.col("words").alias(f"w{c}")) for c in "ab"]
        pairs = pairs.filter(apart).select(F.col("cls").alias("a"), "b").distinct()
        return scratch.save(pairs.join(wa, "a").join(wb, "b").select("a", "b", "wa", "wb").mapInPandas(_near, "a long, b long"), name)

    def all_pairs(small: DataFrame) -> DataFrame:
        return small.join(as_b(small, "key", F.col("comp").alias("comp_b")), "key").filter("cls > b and comp <> comp_b")

    def joined(label: DataFrame, new: DataFrame, name: str) -> DataFrame:
        """label after links between components: only what they join is gone through again."""
        full = classes.select("cls").join(label, "cls", "left").select("cls", F.coalesce("comp", "cls").alias("comp"))
        a, b = full.toDF("a", "ca"), full.toDF("b", "cb")
        moved = labelled(new.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")), name).toDF("comp", "root")
        return scratch.save(full.join(moved, "comp", "left").select("cls", F.coalesce("root", "comp").alias("comp")).filter("cls <> comp"), f"label-{name}")

    def still_apart(label: DataFrame, of: DataFrame, name: str) -> DataFrame:
        m = of.join(label, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        mixed = m.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
        return scratch.save(m.join(mixed, "key"), name)

    def labelled(links: DataFrame, name: str) -> DataFrame:
        return components(scratch, links, name).select(F.col("u").alias("cls"), F.col("v").alias("comp"))

    members = scratch.save(grouped(keyed, classes), "members")
    # of the commonest classes of a key one is taken, the same in all three columns
    first_by = F.shiftleft(F.least("n", F.lit(1 << 20)), 40) + F.col("cls").bitwiseAND(F.lit((1 << 40) - 1))
    pivot = members.groupBy("key").agg(*[F.max_by(c, first_by).alias(c) for c in ("cls", "first", "final")])
    label = labelled(near(members.join(as_b(pivot, "key"), "key").filter("cls <> b"), "links-0"), "comp-0")
    some = still_apart(label, members, "apart-1")
    large = some.filter(F.col("k") > SMALL).select("cls", "first", "final", "comp").distinct()
    rare = scratch.save(grouped(_rarest(large.select("cls").join(words, "cls")), large), "rare")
    pairs = all_pairs(some.filter(F.col("k") <= SMALL)).unionByName(all_pairs(rare.filter(F.col("k") <= SMALL)), allowMissingColumns=True)
    new = near(pairs, "links-1")
    if not new.isEmpty():
        label = joined(label, new, "comp-1")
    some = still_apart(label, rare.filter(F.col("k") > SMALL).drop("comp"), "apart-2")
    if some.isEmpty():
        return label
    main = some.groupBy("key", "comp").agg(F.count("*").alias("of")).groupBy("key").agg(F.max_by("comp", F.struct("of", "comp")).alias("main"))
    part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("k") / BLOCK))
    blocked = some.join(main, "key").join(words, "cls").select("key", part.alias("part"), (F.col("comp") != F.col("main")).alias("other"), F.struct("cls", "comp", "words").alias("item"))
    blocked = scratch.save(blocked, "blocked")  # it is read twice
    blocks = blocked.groupBy("key", "part").agg(F.collect_list("item").alias("block"))
    rest = blocked.filter("other").groupBy("key", "part").agg(F.collect_list("item").alias("rest"))
    pairs = rest.select("key", "rest").join(blocks.select("key", "block"), "key").select("rest", "block").mapInPandas(_across, "a long, b long").distinct()
    new = scratch.save(pairs.withColumnRenamed("a", "cls").join(classes.drop("n"), "cls").join(as_b(classes), "b").filter(apart).select("cls", "b"), "links-2")
    return label if new.isEmpty() else joined(label, new.toDF("a", "b"), "comp-2")


def _with_digest(docs: DataFrame) -> DataFrame:
    """(id, text, doc): texts with an id. doc tells documents apart, and different texts of one id as well."""
    return docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).filter("id is not null and text is not null").withColumn("doc", F.xxhash64("id", "text"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start, stop, passage, keeper_doc_id, removed, text_digest): passages that stand in several documents.

    docs: (doc_id, text, ...). start and stop are character positions; overlapping paragraphs of one text are one row,
    as long as they agree in keeper. What is removed goes word by word to the ends of the verbatim repeat, as the first
    document that holds the paragraph at that end has it. A verbatim repeat of 50 words or more is always found. ``removed``
    is false in the document with the smallest id that holds the passage. Different texts of one id are kept apart by
    text_digest, and are no different documents. Repeats within one document, texts of fewer than 39 words, null or empty
    texts and rows without an id give no rows. Repeated rows of one document count once. An empty table gives an empty
    table. Texts are read whole, and columns other than the two are not read.
    """
    scratch = Scratch(docs.sparkSession, join="merge")
    t = docs.schema["doc_id"].dataType.simpleString()
    d = _with_digest(docs)
    bits = max(6, ((d.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART).bit_length())
    shift = max(16, 32 - bits)
    packed = d.select("doc", "text").mapInPandas(lambda x: _keys(x, bits, shift), "told boolean, slot int, data binary")
    shared = packed.groupBy("told", "slot").applyInPandas(lambda k, x: _shared(k, x, bits, shift), "part int, open boolean, keys binary")
    placed = d.select(F.col("doc").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("part"), "id", "doc", "text")
    both = placed.groupBy("part").cogroup(shared.groupBy("part"))
    found = scratch.save(both.applyInPandas(lambda x, y: _found(x, y, shift), f"id {t}, doc long, start int, stop int, cls long, keys array<long>, words binary"), "found")
    scratch.release()
    classes = scratch.save(found.groupBy("cls").agg(F.min("id").alias("first"), F.max("id").alias("final"), F.count("*").alias("n")), "classes")
    label = _labels(scratch, found, classes)
    scratch.release()

    named = classes.join(label, "cls", "left").select("cls", "first", "final", F.coalesce("comp", "cls").alias("passage"))
    # a class of one document (its key was shared by others that proved different) is no repeat
    held = named.groupBy("passage").agg(F.min("first").alias("keeper"), F.max("final").alias("final")).filter("keeper < final").drop("final")
    owner = scratch.save(named.join(held, "passage").select("cls", "passage", "first", "keeper"), "owner")
    places_of = found.select("id", "doc", "start", "stop", "cls").distinct()

    def merged(spans: DataFrame, name: str) -> DataFrame:
        by_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("id", "start", "stop", "passage", "keeper", "cls", "first")).alias("items"))
        return scratch.save(by_doc.mapInPandas(_spans, f"doc long, id {t}, start int, stop int, passage long, keeper {t}, opening long, opening_at int, last long, last_at int"), name)

    # the words beside the first and the last paragraph that another document holds too are compared with those there
    now = merged(places_of.join(owner, "cls"), "merged")
    ends = now.filter("keeper <> id").select("id", "doc", "start", "stop", "keeper", F.explode(F.array(
        F.struct(F.lit(False).alias("right"), F.col("opening_at").alias("pos"), F.col("opening").alias("cls")),
        F.struct(F.lit(True).alias("right"), F.col("last_at").alias("pos"), F.col("last").alias("cls")),
    )).alias("e")).select("id", "doc", "start", "stop", "keeper", "e.*").filter("cls is not null")
    # columns of one row: the aggregates see rows in one order. They are taken before the shuffle, as a class may be hot
    first_place = found.groupBy("cls").agg(F.min("id").alias("id0"), F.min_by("doc", "id").alias("doc0"), F.min_by(F.shiftleft(F.col("start").cast("long"), 32) + F.col("stop"), "id").alias("at0"))
    pos0 = F.when(F.col("right"), F.col("at0").bitwiseAND(F.lit((1 << 32) - 1))).otherwise(F.shiftright("at0", 32)).cast("int")
    ends = scratch.save(ends.join(first_place, "cls").filter("id0 <> id").select("doc", "start", "stop", "keeper", "right", "pos", "doc0", pos0.alias("pos0")), "ends")
    places = ends.select("doc", "pos", "right").union(ends.select("doc0", "pos0", "right")).distinct().groupBy("doc").agg(F.collect_list(F.struct("pos", "right")).alias("places"))
    beside = scratch.save(d.join(places, "doc").select("doc", "text", "places").mapInPandas(_asked, "doc long, pos int, right boolean, beside string").dropDuplicates(["doc", "pos", "right"]), "beside")
    compared = ends.join(beside, ["doc", "pos", "right"]).join(beside.select(F.col("doc").alias("doc0"), F.col("pos").alias("pos0"), "right", F.col("beside").alias("beside0")), ["doc0", "pos0", "right"])
    moves = compared.select("doc", "start", "stop", "keeper", "right", "beside", "beside0").mapInPandas(_moved, f"doc long, start int, stop int, keeper {t}, right boolean, n int")
    moves = moves.groupBy("doc", "start", "stop", "keeper").agg(F.coalesce(F.max(F.when(~F.col("right"), F.col("n"))), F.lit(0)).alias("before"), F.coalesce(F.max(F.when(F.col("right"), F.col("n"))), F.lit(0)).alias("after"))
    wider = now.join(moves, ["doc", "start", "stop", "keeper"], "left").withColumn("start", F.least("start", F.col("opening_at") - F.col("before"))).withColumn("stop", F.greatest("stop", F.col("last_at") + F.col("after"))).withColumn("cls", F.lit(None).cast("long")).withColumn("first", F.lit(None).cast(t))
    out = merged(wider, "wider")
    scratch.release()
    scratch.drop("found", "classes", "words", "members", "links-0", "links-1", "links-2", "apart-1", "apart-2", "rare", "blocked", "owner", "merged", "ends", "beside")
    return out.select(F.col("id").alias("doc_id"), "start", "stop", "passage", F.col("keeper").alias("keeper_doc_id"), (F.col("keeper") != F.col("id")).alias("removed"), F.col("doc").alias("text_digest"))


def without_passages(docs: DataFrame) -> DataFrame:
    """docs with the repeats of passages cut out of their texts; n_chars follows if there is such a column.

    No row is dropped, and a text without repeats is returned as it is. Rows without an id are returned as they are, and
    repeated rows alike. An empty table gives an empty table. Other columns, of whatever name, are returned as they are.
    """
    spans = repeated_passages(docs).filter("removed").groupBy("text_digest").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("cuts"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for text, spans_ in zip(texts, cuts, strict=True):
            if spans_ is None:
                out.append(None)
                continue
            parts, at = [], 0
            for s in spans_:
                if s["start"] > at:
                    parts.append(text[at : s["start"]].strip(" "))
                at = max(at, s["stop"])
            parts.append(text[at:].strip(" "))
            out.append(" ".join(p for p in parts if p))
        return pd.Series(out)

    digest = F.when(F.col("doc_id").isNotNull() & F.col("text").isNotNull(), F.xxhash64("doc_id", F.col("text").cast("string")))
    rows = docs.select(F.struct("*").alias("row"), digest.alias("text_digest")).join(spans, "text_digest", "left")
    rows = rows.select("row", "cuts", cut(F.col("row.text").cast("string"), "cuts").alias("cut"))
    new = {"text": F.col("cut"), "n_chars": F.length("cut").cast("long")}
    return rows.select(*[F.when(F.col("cuts").isNotNull(), new[c]).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])
