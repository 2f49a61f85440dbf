"""Exact top-k by inner product: a KD-tree per shard, best-first traversal.

Shards are regions of space: median splits of a bounded sample of ``SAMPLE``
vectors give at most ``REGIONS`` regions, and a region beyond ``shard_bytes``
is dealt out in turn to several shards.  The sample only shapes the regions;
every vector is in a tree.  Each shard's tree is built once, by median splits of
its widest dimension, with the tight bounding box of every node, and is kept in
the shared folder.  A query visits a tree best-first: a box bounds the inner
product by the sum over dimensions of max(q * low, q * high), and the visit ends
when the best box left can't beat the k-th score so far.

Roots are looked at before anything is sent.  Blocks of queries meet blocks of
the shards' root boxes; the shard with the best bound is a query's home, which
is searched first.  Its k-th score then goes along, and a query is sent only to
the shards whose root box may hold a score as high.  Trees go to as many tasks
as they have blocks of queries.  Scores are integers; they are computed in
doubles only where those are exact, in Python's integers otherwise, where a
shard takes several times the memory.

Defined results: vectors that are null or hold a null or non-finite component
take no part; vectors of different lengths aren't compared; of rows that repeat
a vec_id each is a candidate, but none of them for a query of the same id, and
the least of their vectors is the query; a null vec_id is no query and no
candidate; scores beyond 64 bits stand at their ends; empty tables have no rows
out; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import drop, durable

LEAF, SAMPLE, REGIONS = 256, 16384, 1024
#: Root boxes, and queries, that meet in a task; bytes of the sample, and of bounds computed at once.
BOXES, BLOCK = 1024, 16384
SAMPLE_BYTES, BOUND_BYTES = 32 << 20, 16 << 20
LEAST, MOST = -(2**63), 2**63 - 1


class Tree:
    """Rows sorted into leaves; per node its rows, its box and its children."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, exact: bool):
        self.exact = exact
        order = np.arange(len(ids))
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        lows, highs = [], []

        def build(lo: int, hi: int) -> int:
            own = rows[order[lo:hi]]
            low, high = own.min(axis=0), own.max(axis=0)
            number = len(self.spans)
            self.spans.append((lo, hi))
            self.children.append(None)
            lows.append(low)
            highs.append(high)
            if hi - lo > LEAF and (high > low).any():
                wide, mid = int(np.argmax(high - low)), (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(own[:, wide], mid)]
                self.children[number] = (build(lo, lo + mid), build(lo + mid, hi))
            return number

        build(0, len(ids))
        self.ids, self.rows = ids[order], rows[order]
        self.low, self.high = np.array(lows), np.array(highs)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """The (score, -vec_id) of up to k rows for each query, none below its floor."""
        bound = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        out = []
        for q, own, floor, bounds in zip(queries, query_ids.tolist(), floors.tolist(), bound.tolist()):
            best: list[tuple[int, int]] = []
            heap = [(-bounds[0], 0)]
            while heap:
                b, node = heapq.heappop(heap)
                if -b < floor:
                    break
                if self.children[node] is not None:
                    for child in self.children[node]:
                        if bounds[child] >= floor:
                            heapq.heappush(heap, (-bounds[child], child))
                    continue
                lo, hi = self.spans[node]
                scores = self.rows[lo:hi] @ q
                for i in np.flatnonzero(scores >= floor).tolist():
                    found = (int(scores[i]), -int(self.ids[lo + i]))
                    if found[0] < floor or found[1] == -own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, found)
                    elif found > best[0]:
                        heapq.heapreplace(best, found)
                    if len(best) == k:
                        floor = max(floor, best[0][0])
            out.append(best)
        return out


def _matrix(vectors: pd.Series) -> tuple[np.ndarray, bool]:
    """Whole numbers of all vectors; whether doubles hold their products."""
    x = np.array(vectors.tolist(), np.float64).reshape(len(vectors), -1)
    top = float(np.abs(x).max(initial=0))
    if top * top * max(1, x.shape[1]) < 2.0**52:
        return x, True
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape), False


def regions_of(sample: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and cut of each node of a tree of median splits, level by level.

    It has at most ``most`` leaves; a node that can't be split sends all to the left.
    """
    depth = max(0, most.bit_length() - 1)
    dims, cuts = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
    inside = {0: np.arange(len(sample))}
    for node in range(2**depth - 1):
        own = inside.pop(node, np.empty(0, np.int64))
        if own.size > 1:
            dims[node] = np.argmax(np.ptp(sample[own], axis=0))
            along = sample[own, dims[node]]
            cut = np.sort(along)[own.size // 2]
            cuts[node] = cut if cut > along.min() else np.nextafter(cut, np.inf)
            right = along >= cuts[node]
            inside[2 * node + 1], inside[2 * node + 2] = own[~right], own[right]
    return dims, cuts


def region(x: np.ndarray, dims: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    node, every = np.zeros(len(x), np.int64), np.arange(len(x))
    for _ in range((dims.size + 1).bit_length() - 1):
        node = 2 * node + 1 + (x[every, dims[node]] >= cuts[node])
    return node - dims.size


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """No product of a query and a vector of the box is above, rounding included."""
    whole = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    return whole + np.abs(whole) * 1e-9 + (np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T) * 1e-12


def _stacked(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int | None = None, block: int | None = None, shard_bytes: int = 8 << 20) -> DataFrame:
    """query_id, rank, vec_id and score; both inputs have vec_id and embedding.

    A shard has about ``shard_bytes`` of doubles, or ``shard_rows`` vectors where
    that is given, and a block of queries as much, or ``block``.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    fit = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(F.exists("embedding", bad), F.lit(True))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double")))
    some = lambda given, d: given or max(256, shard_bytes // (8 * max(1, d)))
    rows = durable(vectors.where(fit).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<double>").alias("v")))
    asked = durable(queries.where(fit).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(scaled.cast("array<double>")).alias("v")).select("*", F.size("v").alias("d")))
    # one number for each length of vectors
    sizes = {r.d: r.n for r in rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    plans = {}
    for d, n in sizes.items():
        wanted = min(REGIONS, -(-n // some(shard_rows, d)))
        if wanted > 1 and d:
            sample = rows.where(F.size("v") == d).orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(max(256, min(SAMPLE, SAMPLE_BYTES // (8 * d)))).select("v").toPandas()
            plans[d] = regions_of(_stacked(sample.v), wanted)

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length = frame.v.map(len)
            frame = frame.assign(d=length.astype("int32"), region=np.int32(0))
            for d, plan in plans.items():
                own = (length == d).to_numpy()
                if own.any():
                    frame.loc[own, "region"] = region(_stacked(frame.v[own]), *plan).astype(np.int32)
            yield frame

    placed = durable(rows.mapInPandas(dealt, "vec_id long, v array<double>, d int, region int"))
    drop(rows)
    # at most REGIONS rows for each length
    counts = placed.groupBy("d", "region").agg(F.count(F.lit(1)).alias("n")).collect()
    shards, first = [], {}
    for r in sorted(counts):
        parts = -(-r.n // some(shard_rows, r.d))
        shards.append((r.d, r.region, first.get(r.d, 0), parts))
        first[r.d] = first.get(r.d, 0) + parts
    of_region = placed.sparkSession.createDataFrame(shards, "d int, region int, first int, parts int")
    turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("parts")).cast("int")
    by_shard = placed.join(F.broadcast(of_region), ["d", "region"]).select("vec_id", "v", "d", (F.col("first") + turn).alias("shard"))

    def tree(frame: pd.DataFrame) -> pd.DataFrame:
        x, exact = _matrix(frame.v)
        built = Tree(frame.vec_id.to_numpy(np.int64), x, exact)
        low, high = (built.low[0].astype(np.float64), built.high[0].astype(np.float64))
        return pd.DataFrame({"d": [len(frame.v.iat[0])], "shard": [int(frame["shard"].iat[0])], "low": [low], "high": [high], "tree": [pickle.dumps(vars(built), protocol=5)]})

    trees = durable(by_shard.groupBy("d", "shard").applyInPandas(tree, "d int, shard int, low array<double>, high array<double>, tree binary"))
    drop(placed)
    in_blocks = lambda df, n: df.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(9)), n).cast("int"))

    def routed(sent: DataFrame, home: bool) -> DataFrame:
        """vec_id, shard and bound: the best shard of each query and group of boxes, or all that its floor allows."""

        def meet(keys: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = {"vec_id": [], "shard": [], "bound": []}
            if not left.empty and not right.empty:
                shard, low, high = left["shard"].to_numpy(), _stacked(left.low), _stacked(left.high)
                found = []
                step = max(1, BOUND_BYTES // (8 * len(shard)))
                for lo in range(0, len(right), step):
                    some = right.iloc[lo : lo + step]
                    ids, bound = some.vec_id.to_numpy(np.int64), bounds(_stacked(some.v), low, high)
                    if home:
                        q, s = np.arange(len(ids)), bound.argmax(axis=1)
                    else:
                        q, s = np.nonzero((bound >= some.floor.to_numpy(np.float64)[:, None]) & (shard[None, :] != some.home.to_numpy()[:, None]))
                    found.append((ids[q], shard[s], bound[q, s]))
                out = {c: np.concatenate(x) for c, x in zip(out, zip(*found))}
            return pd.DataFrame(out).astype({"vec_id": "int64", "shard": "int32", "bound": "float64"})

        boxes = trees.select("d", "shard", "low", "high", F.floor(F.col("shard") / BOXES).cast("int").alias("group"))
        # queries meet every group of boxes, in blocks: groups are few, BOXES shards each
        groups = boxes.groupBy("d").agg(F.collect_set("group").alias("groups"))
        n_blocks = max(1, -(-n_asked // BLOCK))
        right = in_blocks(sent.join(F.broadcast(groups), "d").withColumn("group", F.explode("groups")).drop("groups"), F.lit(n_blocks))
        left = boxes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        by = ["d", "group", "block"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(meet, "vec_id long, shard int, bound double")

    def visit(keys: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        one = Tree.__new__(Tree)
        vars(one).update(pickle.loads(left.tree.iat[0]))
        q, exact = _matrix(right.v)
        if exact != one.exact or not exact or float(np.abs(q).max(initial=0)) * float(np.abs(one.rows).max(initial=0)) * max(1, q.shape[1]) >= 2.0**52:
            whole = lambda m: np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)
            q, one.rows, one.low, one.high = whole(q), whole(one.rows), whole(one.low), whole(one.high)
        found = one.search(right.vec_id.to_numpy(np.int64), q, right.floor.to_numpy(np.int64), k)
        flat = [(int(i), -n, min(max(s, LEAST), MOST)) for i, hits in zip(right.vec_id, found) for s, n in hits]
        return pd.DataFrame(flat, columns=["query_id", "vec_id", "score"]).astype("int64")

    def search(sent: DataFrame) -> DataFrame:
        """``sent`` (vec_id, v, d, floor, shard) against those shards, in blocks."""
        by = ["d", "shard", "block"]
        rows_of = F.lit(block) if block else F.greatest(F.lit(256), F.floor(F.lit(shard_bytes) / (F.lit(8) * F.greatest(F.lit(1), F.col("d")))))
        taken = sent.groupBy("d", "shard").agg(F.count(F.lit(1)).alias("n")).select("d", "shard", F.ceil(F.col("n") / rows_of).cast("int").alias("blocks"))
        wide = trees.select("d", "shard", "tree").join(taken, ["d", "shard"]).select("d", "shard", "tree", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        parts = in_blocks(sent.join(taken, ["d", "shard"]), F.col("blocks")).drop("blocks")
        return wide.groupBy(*by).cogroup(parts.groupBy(*by)).applyInPandas(visit, "query_id long, vec_id long, score long")

    n_asked = asked.count()
    homes = routed(asked, True).groupBy("vec_id").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))
    homes = durable(asked.join(homes, "vec_id").select("vec_id", "v", "d", F.lit(LEAST).alias("floor"), "shard"))
    home = durable(search(homes))
    if all(n == 1 for n in first.values()):
        found = home
    else:
        kth = home.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("least").alias("known"))
        wanting = durable(homes.join(kth, "vec_id", "left").select("vec_id", "v", "d", F.coalesce("known", "floor").alias("floor"), F.col("shard").alias("home")))
        away = durable(routed(wanting, False).select("vec_id", "shard"))
        found = home.union(durable(search(wanting.drop("home").join(away, "vec_id"))))
        drop(wanting, away)
    drop(asked, homes, trees)
    # at most k rows of each shard for a query
    best = F.slice(F.sort_array(F.collect_list(F.struct("score", (-F.col("vec_id")).alias("other"))), asc=False), 1, k)
    ranked = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), (-F.col("hit.other")).alias("vec_id"), F.col("hit.score").alias("score"))
