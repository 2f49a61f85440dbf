"""Removal of repeated 100-byte strings by difference-cover suffix sorting.

Of equal texts one is looked at; the others are repeats as a whole.  What can't
repeat is left out first, without loss: every 100-byte window has an anchor,
the 32-byte string in it with the least hash, which depends on the window's
bytes alone, so a window can only repeat if its anchor does.  Spark counts the
anchors; the windows of a repeated one are short pieces of text.  Pieces meet by
their anchor in a task, which sorts the suffixes of all its pieces: sampled
triples (positions 1 and 2 modulo 3) are sorted and named, the names are sorted
recursively, the remaining suffixes follow from one letter and the rank behind
it, and the two orders are merged.  Recursion ends once names span 100 bytes, as
longer prefixes don't matter.  Neighbours in the order are then compared over
100 bytes; in each run of equal ones all but the earliest position are repeats.

An anchor with more than ``HOT`` occurrences isn't sorted in one task: its
windows meet by a 128-bit hash of their bytes instead, all over the cluster.

A position is one integer: the rank of the text by (doc_id, hash) above as many
bits as the longest text needs.  Texts go through in stretches of ``STRETCH``
bytes, so a very long one takes little more memory than itself.

Defined results: a null text is an empty one; a null doc_id is the least; rows
that share a doc_id stand in the order of their texts' hashes, and equal rows
have equal results; nothing shorter than 100 bytes repeats; an empty table has
no rows out; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import drop, durable, prefix_hash, runs_of, span_hash, text_of
from marlstone.llm.texts import co_located

WINDOW, GRAM, HOT = 100, 32, 8192
STRETCH, MOST_WINDOWS = 1 << 20, 1 << 16
AT_ONCE, CHUNK = 8 << 20, 1_500_000


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, its hash, its first window and how many windows it has."""
    if data.size < WINDOW:
        return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    n, width = data.size - GRAM + 1, WINDOW - GRAM + 1
    at = np.arange(n)
    value = span_hash(prefix_hash(data), at, at + GRAM)
    least, where, reach = value, at.astype(np.int32), 1
    while reach < width:
        step = min(reach, width - reach)
        right = least[step:] < least[:-step]
        where = np.where(right, where[step:], where[:-step])
        least = np.where(right, least[step:], least[:-step])
        reach += step
    first = np.concatenate(([0], np.flatnonzero(where[1:] != where[:-1]) + 1))
    count = np.diff(np.append(first, where.size))
    anchor = where[first].astype(np.int64)
    return anchor, value[anchor], first, count


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with equal anchors: hash, first window, windows, anchors.

    The text is gone through in stretches.  Neighbouring anchors of one hash, as
    in a run of equal bytes, make one piece of at most ``MOST_WINDOWS``.
    """
    found = [anchors(data[lo : lo + STRETCH + WINDOW - 1])[1:] for lo in range(0, max(1, data.size - WINDOW + 1), STRETCH)]
    value, first, count = (np.concatenate(x) for x in zip(*found))
    if len(found) > 1:
        first = first + np.repeat(np.arange(len(found)) * STRETCH, [len(f[0]) for f in found])
    if not value.size:
        return value, first, count, count
    start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
    value, first, count, n = value[start], first[start], np.add.reduceat(count, start), np.diff(np.append(start, value.size))
    if count.max() > MOST_WINDOWS:
        parts = -(-count // MOST_WINDOWS)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        value, first, count, n = np.repeat(value, parts), np.repeat(first, parts) + nth * MOST_WINDOWS, np.minimum(np.repeat(count, parts) - nth * MOST_WINDOWS, MOST_WINDOWS), np.repeat(n, parts)
    return value, first, count, n


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``s`` in the order of what follows, over ``depth`` letters.

    Letters are positive and, as their number, below 2**21.
    """
    n = s.size
    if depth <= 1 or n < 3:
        key = np.concatenate((s, np.zeros(3, np.int64)))
        return np.lexsort((key[2 : n + 2], key[1 : n + 1], key[:n]))
    padded = np.concatenate((s, np.zeros(4, np.int64)))
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((ones, twos))
    triple = (padded[sample] << 42) | (padded[sample + 1] << 21) | padded[sample + 2]
    distinct, name = np.unique(triple, return_inverse=True)
    if depth <= 3 or distinct.size == sample.size:
        order = np.argsort(name, kind="stable")
    else:
        order = suffix_order(name + 1, -(-depth // 3))
    ranked = sample[order]
    ranked = ranked[ranked < n]
    rank = np.zeros(n + 4, np.int64)
    rank[ranked] = np.arange(1, ranked.size + 1)
    # the rest by one letter and the rank of what follows
    rest = np.arange(0, n, 3)
    behind = (padded[rest] << 21) | rank[rest + 1]
    sort = np.argsort(behind, kind="stable")
    rest, behind = rest[sort], behind[sort]
    # how many sampled suffixes come before each of the rest
    one, two = ranked[ranked % 3 == 1], ranked[ranked % 3 == 2]
    before = np.searchsorted((padded[one] << 21) | rank[one + 1], behind)
    further = (padded[rest] << 42) | (padded[rest + 1] << 21) | rank[rest + 2]
    before = before + np.searchsorted((padded[two] << 42) | (padded[two + 1] << 21) | rank[two + 2], further)
    before = np.maximum.accumulate(before)
    out = np.empty(n, np.int64)
    slot = before + np.arange(rest.size)
    out[slot] = rest
    free = np.ones(n, bool)
    free[slot] = False
    out[free] = ranked
    return out


def repeats(pieces: list[bytes], windows: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Start positions of the windows that also start earlier.

    Piece i has ``windows[i]`` windows, the first at ``position[i]``.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces])
    start = np.concatenate(([0], np.cumsum(size)))[:-1]
    where = np.full(data.size, -1, np.int64)
    own = np.arange(int(windows.sum())) - np.repeat(np.concatenate(([0], np.cumsum(windows)))[:-1], windows)
    where[np.repeat(start, windows) + own] = np.repeat(position, windows) + own
    order = suffix_order(data.astype(np.int64) + 1, WINDOW)
    order = order[where[order] >= 0]
    view = np.lib.stride_tricks.sliding_window_view(data, WINDOW)
    equal = np.zeros(order.size, bool)
    for lo in range(1, order.size, 1 << 16):
        a, b = order[lo - 1 : lo - 1 + (1 << 16)], order[lo : lo + (1 << 16)]
        equal[lo : lo + b.size] = (view[a[: b.size]] == view[b]).all(axis=1)
    run = np.cumsum(~equal)
    at = where[order]
    earliest = np.full(run[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(earliest, run, at)
    return np.sort(at[at > earliest[run]])


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of consecutive numbers: first and length."""
    if not at.size:
        return at, at
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    first = np.concatenate(([0], cut))
    return at[first], np.diff(np.append(first, at.size))


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _find(place_bits: int) -> Callable:
    """Pieces of whole texts: one row for each hash in some texts, with the
    first place and its windows, how many anchors there are, and the other places.

    The lowest bit of ``windows`` tells a piece of several anchors, which may
    repeat within itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in runs_of(batch.column("text"), AT_ONCE):
                part = batch.slice(low, high - low)
                found = [(uid, *pieces(np.frombuffer(text, np.uint8))) for uid, text in zip(part.column("uid").to_pylist(), _bytes(part.column("text")))]
                value = np.concatenate([f[1] for f in found])
                place = np.concatenate([(f[0] << place_bits) + f[2] for f in found])
                count, inside = (np.concatenate([f[k] for f in found]) for k in (3, 4))
                order = np.argsort(value, kind="stable")
                value, place, inside = value[order], place[order], inside[order]
                count = count[order] << 1 | (inside > 1)
                start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if value.size else np.empty(0, np.int64)
                n = np.diff(np.append(start, value.size))
                rest = np.ones(value.size, bool)
                rest[start] = False
                offsets = pa.array(np.concatenate(([0], np.cumsum(n - 1))), pa.int32())
                more = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(place[rest]), pa.array(count[rest])], names=["place", "windows"]))
                yield pa.RecordBatch.from_arrays([pa.array(value[start].view(np.int64)), pa.array(place[start]), pa.array(count[start]), pa.array(np.add.reduceat(inside, start) if start.size else n), more], names=["hash", "place", "windows", "n", "more"])

    return run


def _cut(place_bits: int) -> Callable:
    """Pieces of the repeated anchors; see :func:`_sort` for the columns."""
    schema = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("n", pa.int64()), ("piece", pa.binary()), ("w1", pa.int64()), ("w2", pa.int64())])
    mask = (1 << place_bits) - 1

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            seen: set[bytes] = set()
            windows: set[bytes] = set()
            order = np.argsort(batch.column("uid").to_numpy())
            texts, marks = batch.column("text").cast(pa.binary()), batch.column("marks")
            for i in order.tolist():
                data, own = texts[i].as_py(), marks[i].values
                place, count, key, hot = (own.field(c).to_numpy(zero_copy_only=False) for c in ("place", "windows", "hash", "hot"))
                sort = np.argsort(place)
                for p, n, several, k, h in zip(*(x[sort].tolist() for x in (place, count >> 1, count & 1, key, hot))):
                    if len(rows) > 20000:
                        yield batch_of(rows)
                        rows = []
                    piece = data[p & mask : (p & mask) + n + WINDOW - 1]
                    if piece in seen:  # an earlier one is in this batch
                        rows.append((None, p, n, None, None, None))
                        continue
                    seen.add(piece)
                    held += len(piece)
                    if not h:
                        rows.append((k, p, n, piece, several, None))
                        continue
                    run = 0
                    for w in range(n):
                        d = hashlib.blake2b(piece[w : w + WINDOW], digest_size=16).digest()
                        if d in windows:
                            run += 1
                            continue
                        if run:
                            rows.append((None, p + w - run, run, None, None, None))
                            run = 0
                        windows.add(d)
                        held += len(d)
                        rows.append((None, p + w, 1, None, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)))
                    if run:
                        rows.append((None, p + n - run, run, None, None, None))
                if len(rows) > 20000 or held > AT_ONCE:
                    if rows:
                        yield batch_of(rows)
                    rows, held = [], 0
                    seen.clear()
                    windows.clear()
            if rows:
                yield batch_of(rows)

    return run


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among rows sorted by key and place.

    A row without a piece is known already (place, n) or has the hash of one
    window (w1, w2) and passes; of a piece, w1 tells whether it has several
    anchors.  Rows out: place, n, w1, w2.
    """

    def out(place, n, w1=None, w2=None) -> pa.RecordBatch:
        none = [None] * len(place)
        return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(n, pa.int64()), pa.array(w1 if w1 is not None else none, pa.int64()), pa.array(w2 if w2 is not None else none, pa.int64())], names=["place", "n", "w1", "w2"])

    group: dict[bytes, tuple[int, int, int]] = {}
    last = None
    chunk: list[tuple[bytes, int, int]] = []
    held = 0
    known: list[tuple[int, int]] = []

    def close() -> None:
        nonlocal held
        # one piece repeats nothing unless it has several anchors
        if len(group) > 1 or any(several for _, _, several in group.values()):
            chunk.extend((p, n, at) for p, (n, at, _) in group.items())
            held += sum(map(len, group))
        group.clear()

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal held
        if chunk:
            first, n = _runs(repeats([c[0] for c in chunk], np.array([c[1] for c in chunk]), np.array([c[2] for c in chunk])))
            chunk.clear()
            held = 0
            yield out(first, n)
        if known:
            yield out(*zip(*known))
            known.clear()

    for batch in batches:
        passing = batch.filter(pc.is_null(batch.column("piece")))
        if passing.num_rows:
            yield out(*(passing.column(c) for c in ("place", "n", "w1", "w2")))
        rest = batch.filter(pc.is_valid(batch.column("piece")))
        for key, place, n, piece, several in zip(*(rest.column(c).to_pylist() for c in ("key", "place", "n", "piece", "w1"))):
            if key != last:
                close()
                last = key
                if held > CHUNK:
                    yield from flush()
            if piece in group:
                known.append((place, n))
            else:
                group[piece] = (n, place, several)
    close()
    yield from flush()


def left_over(data: bytes, first: np.ndarray, windows: np.ndarray) -> tuple[bytes, int]:
    """``data`` without the bytes of these windows, and in how many runs they lay."""
    order = np.argsort(first)
    start, end = first[order], first[order] + windows[order] + WINDOW - 1
    reach = np.maximum.accumulate(end)
    opens = np.concatenate(([True], start[1:] > reach[:-1]))
    lo, hi = start[opens], np.append(reach[:-1][opens[1:]], reach[-1])
    edges = [0, *np.stack((lo, hi), axis=1).ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2])), lo.size


def _keep(place_bits: int) -> Callable:
    """What is left of each text once its repeats are cut out."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    mask = (1 << place_bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts, runs = batch.column("text").cast(pa.binary()), batch.column("runs")
            for i in range(batch.num_rows):
                data, own = texts[i].as_py(), runs[i].values
                kept, spans = left_over(data, own.field("place").to_numpy() & mask, own.field("n").to_numpy())
                rows.append((batch.column("h1")[i].as_py(), batch.column("h2")[i].as_py(), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

    return run


def _ranked(named: DataFrame) -> DataFrame:
    """h1, h2, first_id, n_bytes and uid of each distinct text, numbered by (first_id, h1, h2)."""
    keys = ["h1", "h2"]
    firsts = named.groupBy(*keys).agg(F.min("id").alias("first_id"), F.first(F.octet_length("text").cast("long")).alias("n_bytes")).orderBy("first_id", *keys)
    firsts = durable(firsts.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("nth")))
    # one row for each partition of the sort, so small enough to be sent to all tasks
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = firsts.join(F.broadcast(offsets), "part")
    classes = durable(numbered.select(*keys, "first_id", "n_bytes", (F.col("offset") + F.col("nth").bitwiseAND((1 << 33) - 1)).alias("uid")))
    drop(firsts)
    return classes


def _bits(classes: DataFrame) -> int:
    """How many low bits of a position the longest text needs."""
    most = classes.agg(F.max("n_bytes").alias("bytes"), F.max("uid").alias("uid")).first()
    bits = max(1, (most.bytes or 0).bit_length())
    if bits + (most.uid or 0).bit_length() > 63:
        raise ValueError(f"{most.uid + 1} texts of up to {most.bytes} bytes have no positions of 63 bits")
    return bits


def dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    ``with_text`` adds what is left of the text, as bytes.
    """
    keys = ["h1", "h2"]
    text = text_of()
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    named = docs.select("doc_id", ids.alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))
    classes = _ranked(named)
    bits = _bits(classes)
    uid = F.shiftright("place", bits).alias("uid")

    # texts move once: by their hash, into buckets of bounded bytes that the joins below leave in place
    size = classes.where(F.col("n_bytes") >= WINDOW).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    texts = named.where(F.octet_length("text") >= WINDOW).groupBy(*keys).agg(F.first("text").alias("text"))
    texts = texts.join(classes.select(*keys, "uid").hint("merge"), keys).select(*keys, "uid", "text")
    with co_located(texts, keys, size.bytes or 0, size.rows) as texts:
        marks = "array<struct<place:bigint,windows:bigint>>"
        found = durable(texts.select("uid", "text").mapInArrow(_find(bits), f"hash long, place long, windows long, n long, more {marks}"))
        counts = durable(found.groupBy("hash").agg(F.sum("n").alias("total")).where("total > 1"))
        # both joins are sort-merge joins, so a hot hash is split among tasks
        all_of = F.concat(F.array(F.struct("place", "windows")), "more")
        marked = found.join(counts.hint("merge"), "hash").select("hash", (F.col("total") > HOT).alias("hot"), F.explode(all_of).alias("at")).select("at.*", "hash", "hot")
        marked = marked.groupBy(uid).agg(F.collect_list(F.struct("place", "windows", "hash", "hot")).alias("marks"))
        numbered = classes.select("uid", *keys)
        marked = durable(marked.join(numbered, "uid").select(*keys, "marks"))
        drop(found, counts)
        cut = texts.join(marked.hint("merge"), keys).select("uid", "text", "marks").mapInArrow(_cut(bits), "key long, place long, n long, piece binary, w1 long, w2 long")
        # rows without a key only pass; they spread evenly
        dealt = cut.repartition(F.coalesce("key", F.xxhash64("place"))).sortWithinPartitions("key", "place")
        sorted_ = durable(dealt.mapInArrow(_sort, "place long, n long, w1 long, w2 long"))
        drop(marked)

        hashed = sorted_.where("w1 is not null").select("place", "w1", "w2")
        least = hashed.groupBy("w1", "w2").agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
        late = hashed.join(least.hint("merge"), ["w1", "w2"]).where("place > least").select("place", F.lit(1).cast("long").alias("n"))
        gone = sorted_.where("w1 is null").select("place", "n").union(late)
        runs = gone.groupBy(uid).agg(F.collect_list(F.struct("place", "n")).alias("runs")).join(numbered, "uid").select(*keys, "runs")
        kept = texts.join(runs.hint("merge"), keys).select(*keys, "text", "runs").mapInArrow(_keep(bits), "h1 long, h2 long, n_removed long, n_spans long, kept_sha256 string, kept binary")
        kept = durable(kept if with_text else kept.drop("kept"))
        known = durable(classes.join(kept, keys, "left"))
        drop(sorted_, kept, classes)

    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    again = (F.col("id") != F.col("first_id")) & (F.col("n_bytes") >= WINDOW)
    own = F.sha2(F.encode("text", "UTF-8"), 256)
    columns = [
        F.when(again, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(again, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(again, nothing).otherwise(F.coalesce("kept_sha256", "own_sha")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(again, F.lit(b"")).otherwise(F.coalesce("kept", F.encode("text", "UTF-8"))).alias("kept"))
    rows = named.select("doc_id", "id", *keys, own.alias("own_sha"), *(["text"] if with_text else []))
    return rows.join(known, keys).select("doc_id", "n_bytes", *columns)
