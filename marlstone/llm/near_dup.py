"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact proof.

Documents with the same set of word shingles form a *class* (they are copies,
at similarity 1), so however many copies a text has, one representative goes
on.  Representatives meet in the buckets of ``BANDS`` bands of ``ROWS`` MinHash
values each.  In a bucket the values of two documents are compared ``STEP`` at
a time; a pair goes as soon as the posterior probability that its similarity
reaches the threshold, given the matches so far and a uniform prior, is below
``tolerance``.  What is left is verified on the shingle sets themselves.

A pair that meets in several buckets counts in its first band only, so links
are counted where they are found and no list of all pairs is ever made.
Buckets with the same members are looked at once, and one with many members is
cut into blocks, so that no task holds more than two blocks.  Signatures meet
first; texts go only to the block pairs in which they have a candidate.

Many near copies of one text would make all pairs of a large bucket.  They are
told from a middle first: the shingles that most of a bounded sample of such a
bucket have.  As 1 - Jaccard is a metric, two documents that are both nearer to
the middle than half the way to the threshold are a link without being compared;
such documents form a *core*, whose links are counted by their number.  Pairs
within a core are left out of the buckets, and so a core's blocks never meet.
Any middle gives right results; a good one leaves little to compare.

A hub of many links, a root of many documents or a class of many copies is a
hot key of a sort-merge join, of whose larger side Spark's adaptive execution
splits hot partitions; sums and minima are taken on the map side first.

Defined results: a null text is an empty one; texts without words form one
class; a text of fewer than five words has one shingle; a document is a doc_id
and a text, so rows that repeat both count as one, while different texts under
one doc_id are documents of their own; rows without doc_id are told apart by
their texts; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import drop, durable, mix64, text_of
from marlstone.llm.words import shingles

BANDS, ROWS, STEP = 20, 4, 16
HASHES = BANDS * ROWS
BLOCK_DOCS, BLOCK_SHINGLES = 384, 3_000_000
#: Documents whose shingles make a middle, and how many these may have at most.
SAMPLE, SAMPLE_SHINGLES = 64, 200_000
#: Documents of large buckets that are sent to all tasks (four numbers each).
AT_ONCE = 100_000


def _multipliers() -> np.ndarray:
    return mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """``HASHES`` MinHash values of a set of 64-bit hashes."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    many = _multipliers()[:, None]
    for lo in range(0, shingle_set.size, 4096):
        part = (shingle_set[None, lo : lo + 4096] * many) >> np.uint64(32)
        np.minimum(out, part.min(axis=1).astype(np.uint32), out=out)
    return out


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest of n equal MinHash values that keep a pair alive.

    With a uniform prior the posterior of the similarity after m of n matches
    is Beta(m + 1, n - m + 1), whose upper tail at t equals the probability of
    at most m successes in n + 1 trials of chance t.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k1, k2, n, sig = [], [], [], []
        for text in batch.column("text"):  # one at a time becomes a string
            found = shingles(text.as_py())
            k1.append(int(found.sum(dtype=np.uint64).view(np.int64)))
            k2.append(int(mix64(found).sum(dtype=np.uint64).view(np.int64)))
            n.append(found.size)
            sig.append(signature(found).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("uid"), batch.column("text_key"), batch.column("doc_id"), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())],
            names=["uid", "text_key", "doc_id", "k1", "k2", "n_shingles", "sig"],
        )


def _whole_groups(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames sorted by ``key``, cut so that no key is in two of them."""
    held = None
    for frame in frames:
        if frame.empty:
            continue
        if held is not None:
            frame = pd.concat([held, frame], ignore_index=True)
        last = int(np.searchsorted(frame[key].to_numpy(), frame[key].iat[-1]))
        held = frame.iloc[last:]
        if last:
            yield frame.iloc[:last]
    if held is not None:
        yield held


def _blocks(frame: pd.DataFrame, threshold: float, floors: list[tuple[int, int]]) -> Iterator["Block"]:
    """A block pair for each value of ``pair`` in the frame."""
    pair, own = frame.pair.to_numpy(), frame.block.to_numpy()
    order = np.lexsort((own, pair))
    pair, own = pair[order], own[order]
    sig = np.frombuffer(b"".join(frame.sig), np.uint32).reshape(len(frame), HASHES)[order]
    size, core, band, low, high = (frame[c].to_numpy()[order] for c in ("n_shingles", "core", "band", "lo", "hi"))
    cuts = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1).tolist(), len(pair)]
    for lo, hi in zip(cuts, cuts[1:]):
        yield Block(order[lo:hi], own[lo:hi], sig[lo:hi], size[lo:hi], core[lo:hi], int(band[lo]), low[lo], high[lo], threshold, floors)


def _overlaps(sets: list[np.ndarray], i: int, others: np.ndarray) -> np.ndarray:
    """|sets[i] & sets[j]| for each j of others."""
    mine = sets[i]
    if not mine.size:
        return np.zeros(others.size, np.int64)
    joined = np.concatenate([sets[j] for j in others])
    at = np.minimum(np.searchsorted(mine, joined), mine.size - 1)
    hit = np.concatenate(([0], np.cumsum(mine[at] == joined)))
    ends = np.cumsum([sets[j].size for j in others])
    return hit[ends] - hit[np.concatenate(([0], ends[:-1]))]


class Block:
    """Documents of one pair of blocks of a bucket, and which of them may be alike."""

    def __init__(self, rows: np.ndarray, own: np.ndarray, sig: np.ndarray, size: np.ndarray, core: np.ndarray, band: int, first: int, last: int, threshold: float, floors: list[tuple[int, int]]):
        self.rows, self.sig, self.size, self.core, self.band = rows, sig, size, core, band
        self.threshold, self.floors, self.n = threshold, floors, len(rows)
        self.last = int(np.searchsorted(own, last)) if first != last else 0
        self.firsts = range(self.last if first != last else self.n)

    def candidates(self, i: int) -> np.ndarray:
        """Those behind ``i`` that its values don't rule out, met here first."""
        size, sig = self.size, self.sig
        alive = np.arange(max(i + 1, self.last), self.n)
        if self.core[i]:  # links within a core are known
            alive = alive[self.core[alive] != self.core[i]]
        # sizes this far apart can't reach the threshold
        alive = alive[np.minimum(size[alive], size[i]) >= self.threshold * np.maximum(size[alive], size[i]) - 1e-9]
        same = np.zeros(alive.size, np.int64)
        for n, floor in self.floors:
            if not alive.size:
                break
            same += (sig[alive, n - STEP : n] == sig[i, n - STEP : n]).sum(axis=1)
            keep = same >= floor
            alive, same = alive[keep], same[keep]
        if alive.size and self.band:
            bands = sig.reshape(self.n, BANDS, ROWS)
            earlier = (bands[alive, : self.band] == bands[i, : self.band]).all(axis=2).any(axis=1)
            alive = alive[~earlier]
        return alive


def _possible(frame: pd.DataFrame, threshold: float, floors: list[tuple[int, int]]) -> pd.DataFrame:
    """The rows of the documents that are in any candidate pair."""
    wanted = np.zeros(len(frame), bool)
    for block in _blocks(frame, threshold, floors):
        for i in block.firsts:
            alive = block.candidates(i)
            if alive.size:
                wanted[block.rows[i]] = True
                wanted[block.rows[alive]] = True
    return frame[wanted]


def _all_linked(frame: pd.DataFrame, threshold: float, floors: list[tuple[int, int]]) -> pd.DataFrame:
    texts, nodes = frame.text.to_list(), frame.node.to_numpy()
    parts = [_linked(b, [texts[r] for r in b.rows], nodes[b.rows]) for b in _blocks(frame, threshold, floors)]
    columns = zip(*parts) if parts else [np.empty(0, np.int64)] * 3
    return pd.DataFrame({k: np.concatenate(v) if parts else v for k, v in zip(("node", "n_links", "root"), columns)})


def _linked(block: Block, texts: list[str], node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents of a block pair that have links, how many, and their root there."""
    size, threshold = block.size, block.threshold
    sets: list[np.ndarray | None] = [None] * block.n
    links, root = np.zeros(block.n, np.int64), np.arange(block.n)

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in block.firsts:
        alive = block.candidates(i)
        if not alive.size:
            continue
        for j in (i, *alive):
            if sets[j] is None:
                sets[j] = shingles(texts[j])
        both = _overlaps(sets, i, alive)
        alive = alive[both >= threshold * (size[i] + size[alive] - both) - 1e-9]
        links[i] += alive.size
        links[alive] += 1
        for j in alive:
            a, b = top(i), top(j)
            if a != b:
                a, b = (a, b) if node[a] < node[b] else (b, a)
                root[b] = a
    kept = np.flatnonzero(links)
    return node[kept], links[kept], node[[top(x) for x in kept]]


def _middles(frame: pd.DataFrame) -> pd.DataFrame:
    """The shingles that most texts of one sample have, and a name for that set."""
    sets = [shingles(t) for t in frame.text]
    value, times = np.unique(np.concatenate(sets), return_counts=True)
    middle = value[2 * times > len(sets)]
    name = int((mix64(middle).sum(dtype=np.uint64) | np.uint64(1)).view(np.int64))
    return pd.DataFrame({"cluster": frame.cluster[:1], "core": [name], "middle": [middle.view(np.int64)]})


def _near_middle(threshold: float) -> Callable:
    """Documents within half the way to the threshold of their cluster's middle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for text, middle in zip(batch.column("text"), batch.column("middle")):
                own, other = shingles(text.as_py()), middle.values.to_numpy().view(np.uint64)
                both = np.isin(own, other, assume_unique=True).sum()
                near.append(bool(both >= (1 + threshold) / 2 * (own.size + other.size - both) + 1e-9))
            kept = batch.filter(pa.array(near, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(c) for c in ("uid", "text_key", "node", "core")], names=["uid", "text_key", "node", "core"])

    return run


def _cores(named: DataFrame, banded: DataFrame, buckets: DataFrame, threshold: float) -> DataFrame | None:
    """(uid, text_key, node, core) of the documents of large buckets that are in a
    core of two at least, or none where no bucket is large."""
    document = ["uid", "text_key"]
    large = buckets.where(F.col("blocks") > 1)
    if large.isEmpty():
        return None
    held = durable(banded.join(large.drop("blocks"), ["band", "key"]).select(*document, "node", "n_shingles", "n", F.xxhash64("band", "key").alias("cluster")))
    # each document is measured once, against the middle of the largest of its buckets
    chosen = held.groupBy(*document, "node").agg(F.max(F.struct("n", "cluster")).alias("m")).select(*document, "node", "m.cluster")
    chosen = durable(chosen)
    # so few of them are sent to all tasks, else all texts meet them by one exchange
    few = F.broadcast(chosen) if chosen.count() <= AT_ONCE else chosen.hint("merge")
    texts = durable(named.select(*document, "text").join(few, document).groupBy(*document, "node", "cluster").agg(F.min("text").alias("text")))
    nth = F.row_number().over(Window.partitionBy("cluster").orderBy(F.xxhash64(*document), *document))
    picked = held.where(F.col("n_shingles") <= SAMPLE_SHINGLES).withColumn("nth", nth).where(F.col("nth") <= SAMPLE).select(*document, "cluster")
    sample = texts.select(*document, "text").join(picked.hint("merge"), document).select("cluster", "text")
    middles = durable(sample.groupBy("cluster").applyInPandas(_middles, "cluster long, core long, middle array<bigint>"))
    near = durable(texts.join(middles.hint("merge"), "cluster").select(*document, "node", "core", "text", "middle").mapInArrow(_near_middle(threshold), "uid long, text_key long, node long, core long"))
    cores = durable(near.join(near.groupBy("core").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("root")).where("n > 1").hint("merge"), "core"))
    drop(held, chosen, texts, middles, near)
    return cores


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component of edges (node, root).

    Labels pass along edges and then jump to the label of their label, until
    none changes; each round is cut off in the shared folder.
    """
    edges = durable(edges.where("node <> root").select("node", "root").distinct())
    both = edges.select("node", F.col("root").alias("other")).union(edges.select("root", "node"))
    labels = durable(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        better = labels.join(near, "node").select("node", F.least("label", "near").alias("next"), "label")
        jump = better.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = durable(better.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("next"), "label"))
        changed = moved.where("next <> label").limit(1).count()
        drop(labels)
        labels = moved.select("node", F.col("next").alias("label"))
        labels.cut_path = moved.cut_path
        if not changed:
            drop(edges)
            return labels


def _apart(members: DataFrame) -> DataFrame:
    """``members`` with ``other``: the blocks each document's block is to meet.

    In a large bucket every core of ``BLOCK_DOCS`` documents or more has blocks
    of its own, numbered behind those of all others; its blocks meet others only.
    """
    bucket = ["band", "key"]
    sizes = members.where("core <> 0 and blocks > 1").groupBy(*bucket, "core", "blocks", "n").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= BLOCK_DOCS)
    of = lambda held: F.ceil(F.col("blocks") * held / F.col("n"))
    cells = durable(sizes.select(*bucket, "core", "blocks", "n", "held", of(F.col("held")).alias("own")))
    # what is left of a bucket has the first blocks
    left = cells.groupBy(*bucket, "blocks", "n").agg(F.sum("held").alias("held"), F.sum("own").alias("owns")).select(*bucket, of(F.col("n") - F.col("held")).alias("rest"), "owns")
    before = Window.partitionBy(*bucket).orderBy("core").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*bucket, "core", "own", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start"))
    placed = members.join(left.hint("merge"), bucket, "left").join(starts.hint("merge"), [*bucket, "core"], "left")
    rest, start = F.coalesce("rest", "blocks"), F.col("rest") + F.col("start")
    spread = lambda n: F.pmod(F.xxhash64("uid", "text_key", F.lit(3)), n)
    at = F.when(F.col("own").isNull(), spread(F.greatest(rest, F.lit(1)))).otherwise(start + spread(F.col("own")))
    total = rest + F.coalesce("owns", F.lit(0))
    all_ = F.sequence(F.lit(0).cast("long"), total - 1)
    others = F.when(F.col("own").isNull(), all_).otherwise(F.filter(all_, lambda b: (b < start) | (b >= start + F.col("own"))))
    return placed.where(total > 0).select("uid", "text_key", *bucket, "core", at.alias("block"), F.explode(others).alias("other"))


def identity() -> Column:
    """doc_id, or a negative hash of the text where there is none."""
    return F.coalesce(F.col("doc_id").cast("long"), -F.shiftrightunsigned(F.xxhash64(text_of()), 2) - 2**62)


def text_key() -> Column:
    """What tells apart the texts of one doc_id."""
    return F.xxhash64(text_of())


def near_duplicates(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text).

    class_id: least doc_id with the same shingle set; n_links: how many other
    classes are at ``threshold`` or more; group_id: least doc_id of all that
    links join.  uid and text_key name the document, and group_id and group_key
    name in the same way the document that stands for the group.
    """
    text = text_of()
    named = docs.select(
        identity().alias("uid"),
        text_key().alias("text_key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
    )
    document = ["uid", "text_key"]
    sketch = durable(named.mapInArrow(_sketch, "uid long, text_key long, doc_id long, k1 long, k2 long, n_shingles long, sig binary"))
    classes = sketch.groupBy("k1", "k2").agg(F.min(F.struct(*document)).alias("least"), F.first("n_shingles").alias("n_shingles"), F.min("sig").alias("sig"))
    classes = classes.select("k1", "k2", "least.*", "n_shingles", "sig")
    # a class goes by its doc_id, or by a hash where classes share the doc_id
    differ = (F.min("k1") != F.max("k1")) | (F.min("k2") != F.max("k2"))
    shared = sketch.groupBy("uid").agg(differ.alias("shared")).where("shared")
    hashed = -F.shiftrightunsigned(F.xxhash64(*document), 2) - 1
    classes = durable(classes.join(shared, "uid", "left").select("k1", "k2", *document, "n_shingles", "sig", F.when(F.col("shared"), hashed).otherwise(F.col("uid")).alias("node")))

    keys = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.substring("sig", 4 * ROWS * b + 1, 4 * ROWS)).alias("key")) for b in range(BANDS)])
    banded = classes.where("n_shingles > 0").select(*document, "node", "n_shingles", F.explode(keys).alias("at")).select(*document, "node", "n_shingles", "at.*")
    buckets = (
        banded.groupBy("band", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"), F.bit_xor(F.xxhash64(*document)).alias("members"), F.bit_xor(F.xxhash64(*document, F.lit(7))).alias("members2"))
        .where("n > 1")
        .groupBy("n", "weight", "members", "members2")
        .agg(F.min(F.struct("band", "key")).alias("at"))
        .select("at.*", "n", F.ceil(F.greatest(F.col("n") / BLOCK_DOCS, F.col("weight") / BLOCK_SHINGLES)).alias("blocks"))
    )
    buckets = durable(buckets)
    cores = _cores(named, banded, buckets, threshold)
    inside = banded.join(buckets, ["band", "key"])
    inside = inside.withColumn("core", F.lit(0).cast("long")) if cores is None else inside.join(cores.select(*document, "core"), document, "left").fillna(0, ["core"])
    inside = durable(inside.select(*document, "band", "key", "n", "blocks", "core"))
    members = _apart(inside) if cores is not None else inside.withColumns({"block": F.lit(0).cast("long"), "other": F.lit(0).cast("long")})  # no bucket has more than one block
    members = (
        members.select(*document, "band", "block", "core", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "key")
        .withColumn("pair", F.xxhash64("band", "key", "lo", "hi"))
    )
    # signatures decide first, so that only texts of candidate pairs move
    signed = members.drop("key").join(classes.select(*document, "node", "n_shingles", "sig"), document)
    floors = [(n, least_matches(n, threshold, tolerance)) for n in range(STEP, HASHES + 1, STEP)]

    def by_pair(df: DataFrame, of: Callable, schema) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for whole in _whole_groups(frames, "pair"):
                yield of(whole, threshold, floors)

        return durable(df.repartition("pair").sortWithinPartitions("pair").mapInPandas(run, schema))

    possible = by_pair(signed, _possible, signed.schema)
    # texts meet their few takers by one exchange at every size of the input
    needed = possible.select(*document).distinct().hint("merge")
    texts = named.select(*document, "text").join(needed, document, "left_semi").groupBy(*document).agg(F.min("text").alias("text"))
    found = pairs = by_pair(possible.join(texts, document).drop(*document), _all_linked, "node long, n_links long, root long")
    drop(possible, inside, buckets)
    if cores is not None:
        found = found.union(cores.select("node", F.col("n") - 1, "root"))
    links = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    labels = components(found)
    linked = labels.join(classes.select("node", *document), "node")
    least = linked.groupBy("label").agg(F.min(F.struct(*document)).alias("first"))
    groups = linked.join(least, "label").select("node", F.col("first.uid").alias("group_id"), F.col("first.text_key").alias("group_key"))
    known = classes.select("k1", "k2", "node", *document).join(links, "node", "left").join(groups, "node", "left")
    named_groups = [F.coalesce("group_id", "uid").alias("group_id"), F.coalesce("group_key", "text_key").alias("group_key")]
    known = durable(known.select("k1", "k2", F.col("uid").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), *named_groups))
    drop(classes, pairs, labels, *([cores] if cores is not None else []))
    return sketch.select(*document, "doc_id", "k1", "k2").join(known, ["k1", "k2"]).select("doc_id", "class_id", "n_links", "group_id", *document, "group_key")
