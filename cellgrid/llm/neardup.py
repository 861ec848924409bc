"""MinHash near-duplicates with SetSketch registers.

Every document's set of 5-word shingles is drawn once into ``M`` registers. An element's points fall into the
exponentially spaced intervals of the SetSketch paper, one point in each and each in another register, so a document is
finished as soon as its registers are full. Registers keep minima, hence two sketches merge by the elementwise minimum
of their points (the maximum of register values).

Documents of one set are one class. Classes that agree in all registers of a band meet in a bucket. Links are
confirmed on the full sets:

1. of the smallest classes of its buckets, each class is compared with the one that it meets most often;
2. members of buckets that still hold several components are compared with some members of other components;
3. what is still apart is compared in blocks by the joint likelihood estimate, and pairs that can reach the threshold
   are confirmed. No pair that meets in a bucket and could join two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NEAR, Scratch, chunks, mix, shingle_sets
from .graph import components

BANDS, ROWS = 32, 4  # a pair at similarity 0.75 is missed with probability (1 - 0.75**4)**32 = 5e-6
M = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65535
SLACK = 0.2  # five standard deviations of an estimate from 128 registers at 0.75
BLOCK = 256
PIVOTS = 4
#: Members of a bucket from which on its blocks carry whole sets of up to WHOLE elements, so that they confirm links themselves.
HOT, WHOLE = 64, 1024
_GAMMA = np.append(-np.log(1 - np.arange(M) / M) / RATE, np.inf)
_SPAN = 1 - np.exp(-RATE * np.diff(_GAMMA))


def set_sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (len(sets), M) as uint16. An empty set has registers of 0."""
    least = np.full(len(sets) * M, np.inf)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    start, stride = (mix(element) & np.uint64(M - 1)).astype(np.int64), (mix(element + np.uint64(1)) & np.uint64(M - 1)).astype(np.int64) | 1
    with np.errstate(over="ignore"):
        for j in range(M):
            if not len(element):
                break
            u = (mix(element + np.uint64(0x632BE59BD9B4E019) * np.uint64(j + 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            np.minimum.at(least, row * M + ((start + j * stride) & (M - 1)), _GAMMA[j] - np.log1p(-u * _SPAN[j]) / RATE)
            full = np.isfinite(least.reshape(-1, M)).all(axis=1)
            if full.any() and (keep := ~full[row]).sum() < len(element):
                element, row, start, stride = element[keep], row[keep], start[keep], stride[keep]
    with np.errstate(divide="ignore", invalid="ignore"):
        k = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(np.nan_to_num(k, nan=0, posinf=TOP, neginf=0), 0, TOP).astype(np.uint16).reshape(-1, M)


def joint_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum likelihood Jaccard similarity of sketches a and b (rows) whose sets have na and nb elements."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)
    lo, hi = np.zeros(len(a)), np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    d = lambda x: (BASE - 1) / BASE / (1 - x * (BASE - 1) / BASE) / np.log(BASE)
    with np.errstate(divide="ignore", invalid="ignore"):
        for _ in range(30):  # the likelihood is concave: bisect its slope
            j = (lo + hi) / 2
            x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
            slope = -more * v * d(x) / p(x) - less * u * d(y) / p(y) + same * (v * d(x) + u * d(y)) / np.maximum(1 - p(x) - p(y), 1e-12)
            lo, hi = np.where(slope > 0, j, lo), np.where(slope > 0, hi, j)
    return (lo + hi) / 2


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for a, b in chunks(pdf["text"]):
            yield pdf.iloc[a:b]


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in _parts(batches):
        sets = shingle_sets(list(pdf["text"]))
        registers = set_sketch(sets)
        digests = [_digest(s) for s in sets]
        yield pd.DataFrame({"id": pdf["id"], "n": [len(s) for s in sets], "c1": [d[0] for d in digests], "c2": [d[1] for d in digests], "registers": [r.astype(">u2").tobytes() for r in registers]})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in _parts(batches):
        sets = shingle_sets(list(pdf["text"]))
        yield pd.DataFrame({"id": pdf["id"], "s": [s.tobytes() for s in sets]})


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = []
        for x, y in zip(pdf["sa"], pdf["sb"], strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= NEAR * max(len(x), len(y)) else 0
            keep.append(both > 0 and 100 * both >= round(100 * NEAR) * (len(x) + len(y) - both))
        yield pdf.loc[keep, ["a", "b"]]


def _stacked(column: list) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x) for x in column), ">u2").reshape(-1, M)


def _linked(left: list, right: list) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs of two blocks that are linked, from whole sets, as a product of membership matrices."""
    a, b = ([np.frombuffer(x["s"], np.uint64) for x in side] for side in (left, right))
    known, at = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    sizes = np.array([len(x) for x in (*a, *b)])
    member = np.zeros((len(sizes), len(known)), np.float32)
    member[np.repeat(np.arange(len(sizes)), sizes), at] = 1
    both = (member[: len(a)] @ member[len(a) :].T).astype(np.int64)
    return np.nonzero(100 * both >= round(100 * NEAR) * (sizes[: len(a), None] + sizes[len(a) :] - both))


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of two blocks, of different components, whose estimate does not rule out the threshold."""
    for pdf in batches:
        for left, right in zip(pdf["rest"], pdf["block"], strict=True):
            if not len(left) or not len(right):
                continue
            ra, rb = _stacked([x["registers"] for x in left]), _stacked([x["registers"] for x in right])
            ia, ib = [np.array([x["id"] for x in side]) for side in (left, right)]
            ca, cb = [np.array([x["comp"] for x in side]) for side in (left, right)]
            na, nb = [np.array([x["n"] for x in side], np.float64) for side in (left, right)]
            if all(x["s"] is not None for x in (*left, *right)) and max(na.max(), nb.max()) <= WHOLE:
                p, q = _linked(left, right)
                p, q = p[ca[p] != cb[q]], q[ca[p] != cb[q]]
                yield pd.DataFrame({"a": np.maximum(ia[p], ib[q]), "b": np.minimum(ia[p], ib[q])})
                continue
            for i in range(0, len(ia), 32):
                # equal registers alone estimate the similarity; the likelihood has the last word
                equal = (ra[i : i + 32, None] == rb).sum(axis=2)
                p, q = np.nonzero((equal >= (NEAR - 1.25 * SLACK) * M) & (cb != ca[i : i + 32, None]) & (np.minimum(nb, na[i : i + 32, None]) >= NEAR * np.maximum(nb, na[i : i + 32, None])))
                p += i
                near = joint_estimate(ra[p], rb[q], na[p], nb[q]) >= NEAR - SLACK
                p, q = p[near], q[near]
                yield pd.DataFrame({"a": np.maximum(ia[p], ib[q]), "b": np.minimum(ia[p], ib[q])})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents with a Jaccard similarity of at least 0.75 of their sets of 5-word shingles.

    Returns (id_col, n_shingles, component_id, kept), one row per input row; other columns of docs are not read.
    A null or empty text has an empty set and is linked with nothing. Repeated rows give repeated rows; different texts
    of one id are compared as the texts of one document. A null id gives a null component and is kept, since it can
    neither be named nor be chosen. An empty table gives an empty table. Long texts are read whole.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, join="merge")
    kind = docs.schema[id_col].dataType
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    t = kind.simpleString()

    sketched = scratch.save(docs.mapInPandas(_sketches, f"id {t}, n long, c1 long, c2 long, registers binary"), "sketched")
    owned = sketched.filter("n > 0 and id is not null")
    classes = scratch.save(owned.groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.min("registers").alias("registers")), "classes")
    bands = classes.select("rep", F.explode(F.array(*[F.xxhash64(F.lit(i), F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(BANDS)])).alias("key"))
    buckets = bands.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).filter("pivot < last")
    members = scratch.save(bands.join(buckets.select("key", "pivot"), "key"), "members")

    met = members.groupBy("rep").agg(F.min("pivot").alias("pivot"))
    sets = scratch.save(docs.join(met.select("rep"), docs["id"] == met["rep"]).select("id", "text").distinct().mapInPandas(_sets, f"id {t}, s binary").distinct(), "sets")
    size = classes.select("rep", "n")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """pairs (a, b): many a for few b, so the sets of a travel once for each pair."""
        a = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
        b = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
        na, nb = size.select(F.col("rep").alias("a"), F.col("n").alias("na")), size.select(F.col("rep").alias("b"), F.col("n").alias("nb"))
        near = pairs.join(na, "a").join(nb, "b").filter(f"least(na, nb) >= {NEAR} * greatest(na, nb)").select("a", "b").distinct()
        return scratch.save(near.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInPandas(_confirm, f"a {t}, b {t}"), name)

    def likeliest(met_at: DataFrame) -> DataFrame:
        """Of the partners (p) that a class meets, the one that it meets in most buckets."""
        return met_at.groupBy("rep", "p").agg(F.count("*").alias("k")).groupBy("rep").agg(F.max_by("p", F.struct("k", "p")).alias("p"))

    links = confirmed(likeliest(members.filter("rep > pivot").select("rep", F.col("pivot").alias("p"))).select(F.col("rep").alias("a"), F.col("p").alias("b")), "links-0")
    label = components(scratch, links, "comp-0")
    for i in (1, 2):
        m = members.join(label.select(F.col("u").alias("rep"), "v"), "rep", "left").select("key", "rep", F.coalesce("v", "rep").alias("comp"))
        several = m.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
        some = scratch.save(m.join(several, "key"), f"apart-{i}")
        if some.isEmpty():
            break
        if i == 1:
            who = F.struct("rep", "comp")
            pick = some.groupBy("key").agg(F.array_distinct(F.array(*[F.min_by(who, F.xxhash64("rep", F.lit(k))) for k in range(PIVOTS)])).alias("picks"))
            partners = some.join(pick, "key").select("rep", "comp", F.explode("picks").alias("pick")).filter("comp <> pick.comp").groupBy("rep", F.col("pick.rep").alias("p")).agg(F.count("*").alias("k"))
            best = partners.groupBy("rep").agg(F.array_distinct(F.array(F.max_by("p", F.struct("k", "p")), *[F.max_by("p", F.struct(F.pmod(F.xxhash64("p", F.lit(k)), F.lit(8)), "k", "p")) for k in range(PIVOTS)])).alias("ps"))
            pairs = best.select(F.col("rep").alias("a"), F.explode("ps").alias("b"))
        else:
            main = some.groupBy("key", "comp").agg(F.count("*").alias("k")).groupBy("key").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.sum("k").alias("k"))
            item = F.struct(F.col("rep").alias("id"), "comp", "n", "registers", "s")
            part = F.pmod(F.xxhash64("rep"), F.greatest(F.lit(1), F.ceil(F.col("k") / BLOCK)))
            sized = some.join(main, "key").join(classes.select("rep", "n", "registers"), "rep")
            whole = (F.col("rep") == F.col("own")) & (F.col("k") > HOT) & (F.col("n") <= WHOLE)
            sized = sized.join(sets.select(F.col("id").alias("own"), "s"), whole, "left")
            # saved, as it is read twice
            placed = scratch.save(sized.select("key", part.alias("part"), (F.col("comp") != F.col("main")).alias("other"), item.alias("item")), "placed")
            scratch.release()
            blocks = placed.groupBy("key", "part").agg(F.collect_list("item").alias("block"))
            rest = placed.filter("other").groupBy("key", "part").agg(F.collect_list("item").alias("rest"))
            pairs = rest.select("key", "rest").join(blocks.select("key", "block"), "key").select("rest", "block").mapInPandas(_across, f"a {t}, b {t}").distinct()
        label = components(scratch, label.select(F.col("u").alias("a"), F.col("v").alias("b")).union(confirmed(pairs, f"links-{i}")), f"comp-{i}")

    reps = classes.select("c1", "c2", "rep").join(label.select(F.col("u").alias("rep"), "v"), "rep", "left").select("c1", "c2", F.coalesce("v", "rep").alias("component_id"))
    alone = F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    out = sketched.drop("registers").join(reps, ["c1", "c2"], "left").select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), alone).alias("component_id"))
    scratch.drop("members", "sets", "placed", "apart-1", "apart-2", "links-0", "links-1", "links-2")
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM g), s AS (SELECT doc_id, unnest(s) AS x FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS d, doc_id AS c FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.d WHERE r.c < l.b)
SELECT doc_id, n AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept FROM n JOIN r ON d = doc_id GROUP BY doc_id, n
"""
