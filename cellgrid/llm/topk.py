"""Exact inner-product top-k by a ball tree in each shard.

Vectors are dealt to shards of bounded size by the centres they are nearest to, and each shard becomes one ball tree. A block
of queries visits a tree's nodes in the order of their upper bound q.c + |q| r and leaves out those that cannot reach the
current k-th score. Queries of a block share the centre with the highest bound; the first shard that a block searches is of
that centre and fixes a k-th score for each of its queries. It is then sent to those shards only whose centre's bound
reaches the k-th score of one of its queries, and starts from these scores there.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .negatives import above, codebook, nearest

K, EVERY = 20, 20
SHARD, LEAF, BLOCK = 8192, 128, 512
#: Most centres, and rows that they are learned from.
CENTRES, SAMPLE = 256, 4096
FOUND = "block long, query_id long, vec_id long, score long"


def _matrix(vectors) -> np.ndarray:
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def build(ids: np.ndarray, x: np.ndarray) -> dict:
    """Flat arrays: a node covers rows start:end; child is its left child, its right child is the next; 0 marks a leaf."""
    order = np.arange(len(x))
    start, end, child, todo = [0], [len(x)], [0], [0]
    while todo:
        i = todo.pop()
        a, b = start[i], end[i]
        if b - a <= LEAF:
            continue
        part = x[order[a:b]].astype(np.float64)
        away = part[((part - part.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        other = part[((part - away) ** 2).sum(axis=1).argmax()]
        order[a:b] = order[a:b][np.argsort(part @ (other - away), kind="stable")]
        child[i] = len(start)
        for lo, hi in ((a, (a + b) // 2), ((a + b) // 2, b)):
            todo.append(len(start))
            start.append(lo)
            end.append(hi)
            child.append(0)
    x, ids = x[order], ids[order]
    centre = np.array([x[a:b].mean(axis=0) if b > a else np.zeros(x.shape[1]) for a, b in zip(start, end, strict=True)])
    radius = np.array([np.sqrt(((x[a:b] - c) ** 2).sum(axis=1).max(initial=0)) for a, b, c in zip(start, end, centre, strict=True)])
    return {"ids": ids, "x": x, "start": start, "end": end, "child": child, "centre": centre, "radius": radius}


def search(tree: dict, qid: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids), each (queries, k), best first, of rows with a score of at least floor; -1 in a row's id: none."""
    width = max(q.shape[1], tree["x"].shape[1])
    pad = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
    q, x, centre = pad(q), pad(tree["x"]), pad(tree["centre"])
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, width) < 2**53
    qf, xf = (q.astype(np.float64), x.astype(np.float64)) if exact else (q, x)
    length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    bound = q.astype(np.float64) @ centre.T + length[:, None] * tree["radius"]
    bound += 1e-6 * (1 + np.abs(bound))  # rounding must not hide a tie
    none = np.iinfo(np.int64).min
    scores, ids = np.full((len(q), k), none), np.full((len(q), k), np.iinfo(np.int64).max)
    least = floor.copy()
    heap = [(-bound[:, 0].max(initial=-np.inf), 0)]
    while heap:
        _, node = heapq.heappop(heap)
        live = np.flatnonzero(bound[:, node] >= least)
        if not len(live):
            continue
        if left := tree["child"][node]:
            for c in (left, left + 1):
                heapq.heappush(heap, (-bound[live, c].max(), c))
            continue
        a, b = tree["start"][node], tree["end"][node]
        if a == b:
            continue
        s = (qf[live] @ xf[a:b].T).astype(np.int64)
        s[qid[live][:, None] == tree["ids"][a:b]] = none
        some = (s >= least[live][:, None]) & (s > none)
        hit = some.any(axis=1)
        live, s = live[hit], np.where(some[hit], s[hit], none)
        if len(live):
            all_s = np.hstack([scores[live], s])
            all_i = np.hstack([ids[live], np.where(s > none, tree["ids"][a:b], np.iinfo(np.int64).max)])
            best = np.lexsort((all_i, -np.maximum(all_s, none + 1)), axis=1)[:, :k]
            scores[live], ids[live] = np.take_along_axis(all_s, best, 1), np.take_along_axis(all_i, best, 1)
            least[live] = np.maximum(least[live], scores[live, k - 1])
    return scores, ids


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        parts = []
        for block, tree, block_ids, block_x, floors in pdf.itertuples(index=False):
            q = pickle.loads(block_x)
            qid = np.asarray(block_ids, np.int64)
            floor = np.full(len(qid), np.iinfo(np.int64).min) if floors is None else pickle.loads(floors)
            s, i = search(pickle.loads(tree), qid, q, floor)
            r, c = np.nonzero(s > np.iinfo(np.int64).min)
            parts.append(pd.DataFrame({"block": block, "query_id": qid[r], "vec_id": i[r, c], "score": s[r, c]}))
        yield pd.concat(parts) if parts else pd.DataFrame({"block": [], "query_id": [], "vec_id": [], "score": []})


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """The k largest inner products of each query with all other rows: (query_id, rank, vec_id, score).

    vectors: (vec_id, v), v an array of integers; shorter ones are padded with zeros. is_query: a condition on vec_id.
    Ties go to the smaller vec_id. A row without an id, or with a null or empty vector, takes no part. A repeated row is
    a candidate as often as it occurs, but asked once; a query meets no row of its own id. With fewer than k candidates
    all are returned, and an empty table gives an empty table.
    """
    scratch = Scratch(vectors.sparkSession)
    v = vectors.filter("vec_id is not null and size(v) > 0").select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    n, width = v.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    sample = [r[0] for r in v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()]
    fill = lambda vs: np.pad(m := _matrix(list(vs)), ((0, 0), (0, width - m.shape[1])))
    centres = codebook(fill(sample), min(CENTRES, max(1, -(-n // SHARD)))) if n else np.zeros((1, 0))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            c, d = nearest(fill(pdf["v"]).astype(np.float64), centres)
            yield pdf.assign(c=c, d=d)

    rows = scratch.save(v.mapInPandas(assign, "vec_id long, v array<long>, c int, d double"), "rows")
    pieces, radius = np.ones(len(centres), np.int64), np.zeros(len(centres))
    for c, size, far in rows.groupBy("c").agg(F.count("*"), F.max("d")).collect():  # a row a centre
        pieces[c], radius[c] = -(-size // SHARD), far
    start = np.cumsum(pieces) - pieces
    of = lambda values, c: F.element_at(F.array(*[F.lit(int(x)) for x in values]), c + 1)

    def bounds(q: np.ndarray) -> np.ndarray:
        """(queries, centres): no row of a centre scores more."""
        q = q.astype(np.float64)
        return above(q @ centres.T + np.sqrt((q**2).sum(axis=1))[:, None] * radius)

    def plant(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        return pd.DataFrame({"shard": [key[0]], "tree": [pickle.dumps(build(pdf["vec_id"].to_numpy(np.int64), _matrix(list(pdf["v"]))))]})

    def home_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "v": pdf["v"], "home": bounds(fill(pdf["v"])).argmax(axis=1)})

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        home, part = key
        pdf = pdf.drop_duplicates("vec_id").sort_values("vec_id")
        return pd.DataFrame({"block": [(home << 32) + part], "first": [start[home] + part % pieces[home]], "block_ids": [pdf["vec_id"].to_numpy(np.int64)], "block_x": [pickle.dumps(_matrix(list(pdf["v"])))]})

    shard = of(start, F.col("c")) + F.pmod("_at", of(pieces, F.col("c")))
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()).select("vec_id", "v", shard.alias("shard"))
    trees = scratch.save(dealt.groupBy("shard").applyInPandas(plant, "shard long, tree binary"), "trees")
    asked = scratch.save(rows.filter(is_query).select("vec_id", "v").mapInPandas(home_of, "vec_id long, v array<long>, home int"), "asked")
    blocks = np.ones(len(centres), np.int64)
    for c, size in asked.groupBy("home").count().collect():  # a row a centre
        blocks[c] = -(-size // BLOCK)
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), of(blocks, F.col("home")))
    asks = scratch.save(asked.groupBy(F.col("home").cast("long").alias("home"), part.alias("part")).applyInPandas(gather, "block long, first long, block_ids array<long>, block_x binary"), "asks")
    run = "block", "tree", "block_ids", "block_x", "floors"
    home = asks.withColumn("floors", F.lit(None).cast("binary")).join(trees, F.col("first") == F.col("shard")).select(*run).mapInPandas(_packed, FOUND)
    home = scratch.save(home, "home")

    def kth(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        least = pdf.groupby("query_id")["score"].agg(lambda s: s.nlargest(k).iloc[-1] if len(s) >= k else np.iinfo(np.int64).min)
        return pd.DataFrame({"block": [key[0]], "floor_ids": [least.index.to_numpy(np.int64)], "floor": [least.to_numpy(np.int64)]})

    floors = home.groupBy("block").applyInPandas(kth, "block long, floor_ids array<long>, floor array<long>")

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each further shard that one of the block's queries may find something in."""
        for pdf in batches:
            for block, first, block_ids, block_x, ids, floor in pdf.itertuples(index=False):
                known = dict(zip(ids, floor, strict=True)) if ids is not None else {}
                least = np.array([known.get(i, np.iinfo(np.int64).min) for i in block_ids], np.int64)
                open_ = np.flatnonzero((bounds(fill(pickle.loads(block_x))) >= least[:, None]).any(axis=0))
                shards = np.array([s for c in open_ for s in range(start[c], start[c] + pieces[c]) if s != first], np.int64)
                for at in range(0, len(shards), 64):  # a few copies of a block at a time
                    some = shards[at : at + 64]
                    yield pd.DataFrame({"block": block, "block_ids": [block_ids] * len(some), "block_x": [block_x] * len(some), "floors": [pickle.dumps(least)] * len(some), "shard": some})

    shared = asks.join(floors, "block", "left").select("block", "first", "block_ids", "block_x", "floor_ids", "floor")
    others = shared.mapInPandas(route, "block long, block_ids array<long>, block_x binary, floors binary, shard long")
    found = home.unionByName(others.join(trees, "shard").select(*run).mapInPandas(_packed, FOUND))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def embedding_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v): floor(64 * x) of each component. A null vector or component, or one that isn't finite, leaves the row out."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.filter(F.col("embedding").isNotNull() & fine).select("vec_id", F.transform("embedding", lambda x: F.floor(64 * x.cast("double"))).alias("v"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) DESC, c.vec_id)::INT AS rank
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 20
"""
