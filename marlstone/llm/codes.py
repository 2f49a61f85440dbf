"""Vector compression: product codes learnt over a trie of distinct parts.

Vectors become integers and are cut into ``PARTS`` parts.  Spark brings equal
parts together with their number, deals the distinct ones by range and sorts
them: each task then holds a stretch of the trie whose nodes are the shared
beginnings of parts.  A round goes through it depth first, and every node passes
on the squared distances to all entries that its dimensions have gathered, so a
shared beginning is measured once; a leaf takes the nearest entry and adds its
part, times its number, to that entry's sum.  Rounds move sums only, at most
``PARTS`` * ``ENTRIES`` rows; the codebooks, as many rows, are all the driver sees.
Codes are then given to vectors batch by batch, without any exchange.

Defined results: vectors that are null or hold null or non-finite components are
left out; a null vec_id is the greatest; equal vec_ids stand by their vectors;
fewer than ``ENTRIES`` vectors make fewer entries; repeated rows have equal
codes; null labels are one label; an empty table has no rows out; extra columns
are ignored.  Vectors of other lengths than the first's, lengths that aren't a
multiple of ``PARTS``, and components of 2**16 or more, whose distances a 64-bit
integer doesn't hold, are errors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import drop, durable

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components stay below; so the distances of a whole vector fit 64 bits.
LIMIT = 1 << 28
#: Leaves below a node that are measured together.
LEAVES = 1 << 13


def integers(df: DataFrame, vector: str, keep: list[Column]) -> DataFrame:
    """``keep`` and ``v``, the integers of each usable vector."""
    usable = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return df.where(usable).select(*keep, whole.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` integers each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if flat.size != len(column) * width or (len(column) and set(np.diff(column.offsets.to_numpy()).tolist()) != {width}):
        raise ValueError(f"all vectors must have {width} components")
    if flat.size and max(int(flat.max()), -int(flat.min())) >= LIMIT:
        raise ValueError(f"components must stay below {LIMIT // SCALE}")
    return flat.reshape(len(column), width)


def _below(rows: np.ndarray, depth: int, gathered: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Distances of the leaves below a node: all nodes of a depth at once."""
    opens = np.zeros(len(rows), bool)
    opens[0] = True
    distance, node = gathered[None, :], np.zeros(len(rows), np.int64)
    for k in range(depth, rows.shape[1]):
        opens[1:] |= rows[1:, k] != rows[:-1, k]
        first = np.flatnonzero(opens)
        distance = distance[node[first]] + (rows[first, k, None] - book[None, :, k]) ** 2
        node = np.cumsum(opens) - 1
    return distance[node]


def traverse(rows: np.ndarray, book: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, end, distances to each entry) of sorted distinct rows, depth first.

    A node with many leaves hands what it has gathered to its children one by
    one; children with few are taken together.
    """
    stack = [(0, len(rows), 0, np.zeros(len(book), np.int64))] if len(rows) else []
    while stack:
        lo, hi, depth, gathered = stack.pop()
        if hi - lo <= LEAVES or depth == rows.shape[1]:
            yield lo, hi, _below(rows[lo:hi], depth, gathered, book)
            continue
        own = rows[lo:hi, depth]
        edges = [lo, *(lo + 1 + np.flatnonzero(own[1:] != own[:-1])).tolist(), hi]
        children, at = [], lo
        for a, b in zip(edges, edges[1:]):
            if b - a > LEAVES:
                if at < a:
                    children.append((at, a, depth, gathered))
                children.append((a, b, depth + 1, gathered + (rows[a, depth] - book[:, depth]) ** 2))
                at = b
            elif b - at > LEAVES:
                children.append((at, a, depth, gathered))
                at = a
        if at < hi:
            children.append((at, hi, depth, gathered))
        stack.extend(reversed(children))


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, the lowest of equals, and its distance."""
    entry, least = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    for lo, hi, distance in traverse(rows, book):
        entry[lo:hi] = distance.argmin(axis=1)
        least[lo:hi] = distance[np.arange(hi - lo), entry[lo:hi]]
    return entry, least


def _cut(width: int) -> Callable:
    """The parts of each vector, with their position."""
    size = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = matrix(batch.column("v"), width).reshape(-1, size)
            offsets = pa.array(np.arange(len(parts) + 1) * size, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(parts.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(PARTS, dtype=np.int32), batch.num_rows)), lists], names=["position", "part"])

    return run


def _sums(books: np.ndarray) -> Callable:
    """Of each batch and position: how many parts an entry takes, and their sum."""
    size = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, weight = batch.column("position").to_numpy(), batch.column("weight").to_numpy()
            rows = matrix(batch.column("part"), size)
            found = []
            for p in np.unique(position).tolist():
                own = np.flatnonzero(position == p)
                entry, _ = nearest(rows[own], books[p])
                count, total = np.zeros(books.shape[1], np.int64), np.zeros(books.shape[1:], np.int64)
                np.add.at(count, entry, weight[own])
                np.add.at(total, entry, rows[own] * weight[own, None])
                found += [(p, e, int(count[e]), total[e]) for e in np.flatnonzero(count).tolist()]
            columns = list(zip(*found)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array([t.tolist() for t in columns[3]], pa.list_(pa.int64()))], names=["position", "entry", "n", "total"])

    return run


def _codes(books: np.ndarray, keep: list[str]) -> Callable:
    """``keep``, code and error of each vector; equal parts of a batch are measured once."""
    size = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"), size * PARTS).reshape(-1, PARTS, size)
            code, error = np.empty((len(rows), PARTS), np.uint8), np.zeros(len(rows), np.int64)
            for p in range(PARTS):
                own = rows[:, p]
                order = np.lexsort(own.T[::-1]) if size else np.arange(len(own))
                ranked = own[order]
                first = np.concatenate(([True], (ranked[1:] != ranked[:-1]).any(axis=1)))[: len(own)]
                entry, least = nearest(ranked[first], books[p])
                leaf = np.cumsum(first) - 1
                code[order, p] = entry[leaf]
                error[order] += least[leaf]
            shown = [bytes(c).hex() for c in code]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(shown, pa.string()), pa.array(error)], names=[*keep, "code", "error"])

    return run


def first_books(vectors: DataFrame) -> np.ndarray | None:
    """The parts of the ``ENTRIES`` first vectors, or none in an empty table."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).select("v").collect()  # bounded: 16 rows
    if not first:
        return None
    width = len(first[0].v)
    if width % PARTS or any(len(r.v) != width for r in first):
        raise ValueError(f"vectors must be of one length, a multiple of {PARTS}")
    return np.array([r.v for r in first], np.int64).reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2)


def learn(vectors: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks by (position, entry, component); ``vectors`` have vec_id and v."""
    books = first_books(vectors)
    if books is None:
        return None
    size = books.shape[2]
    distinct = vectors.select("v").mapInArrow(_cut(size * PARTS), "position int, part array<bigint>").groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight"))
    counted = durable(distinct)
    trie = durable(counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part"))
    drop(counted)
    for _ in range(rounds):
        sums = trie.mapInArrow(_sums(books), "position int, entry int, n long, total array<bigint>")
        wide = [F.sum(F.get("total", F.lit(i)).cast("decimal(38,0)")).alias(f"t{i}") for i in range(size)]
        books = books.copy()
        for r in sums.groupBy("position", "entry").agg(F.sum("n").alias("n"), *wide).collect():  # bounded: one row an entry
            books[r.position, r.entry] = [int(r[f"t{i}"]) // r.n for i in range(size)]
    drop(trie)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by position, entry and component."""
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each usable vector."""
    kept = integers(df, vector, [F.col("vec_id").cast("long").alias("vec_id"), F.col(label).alias("label")])
    books = learn(kept, rounds)
    kind = kept.schema["label"].dataType.simpleString()
    if books is None:
        rows = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
    else:
        rows = durable(kept.mapInArrow(_codes(books, ["vec_id", "label"]), f"vec_id long, label {kind}, code string, error long"))
    # a hot label is split among tasks: it is the larger side's key of a sort-merge join
    totals = rows.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("_label"), "label_error")
    joined = rows.join(totals, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books) if books is not None else "").alias("codebooks_sha256"))
