"""Removal of repeated windows of 50 words by recompression.

Words are symbols of the lowest level.  A round first names every maximal run of
one symbol, then every pair of a left and a right symbol, the sides being drawn
by the symbol's name and the round.  A name is a hash of what it stands for, so
all executors give equal things equal names and no exchange is needed to agree on
them.  Each symbol carries its *context*: the words that decide that it is there.
Where two texts share all of a symbol's context they share the symbol, whatever
stands around; so equal windows have the same symbols inside.

A window's anchor is the largest symbol (in words) whose context lies inside it,
of equal ones that of the least name, then the first.  Windows can only be equal
if their anchors' names are.  Spark counts the names over all texts: one that only
one doc_id has reveals nothing and goes.  Neighbouring windows of one anchor are
a piece.  Where all pieces of a name are equal, they are repeats as they stand;
where they differ, their windows meet by a 128-bit hash of their words, all over
the cluster.  Every window has an anchor, if only a single word, and there is no
limit on how often a name occurs: nothing ever gathers in one task.

Defined results: a null text has no words; a null doc_id is the least; texts of
one doc_id, and windows of one text, are no repeats of each other; equal rows
have equal results; an empty table has no rows out; extra columns are ignored.
Texts go through in stretches, so a long one takes a few times its own size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import drop, durable, mix64, powers, runs_of, text_of
from marlstone.llm.texts import co_located
from marlstone.llm.words import word_names, word_places

WINDOW = 50
#: Words of a stretch, bytes of texts taken together, rows of a batch out.
STRETCH, AT_ONCE, ROWS = 1 << 16, 8 << 20, 1 << 15
#: Rounds end by themselves once no new context fits a window; they never reach this.
MOST_ROUNDS = 48

_RUN, _PAIR, _DIGEST, _BORDER = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))
_SIDE = 0xE7037ED1A0B428DB


def compressed(name: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray, level: int, far: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """One round: (name, start, end, low, high) of the symbols after it, and
    which of them are new.

    low and high bound a symbol's context; one that reaches the text's border
    has a bound outside (-1 or ``far``), as what follows there isn't known.
    """
    # maximal runs; that a run ends depends on its neighbours
    opens = np.concatenate(([True], name[1:] != name[:-1]))
    first = np.flatnonzero(opens)
    last = np.append(first[1:], name.size) - 1
    times = (last - first + 1).astype(np.uint64)
    fresh = times > 1
    named = np.where(fresh, mix64(name[first] + times * _RUN), name[first])
    lows, highs = np.concatenate(([-1], low, [far])), np.concatenate(([-1], high, [far]))
    low = np.minimum(np.minimum.reduceat(low, first), np.minimum(lows[first], lows[last + 2]))
    high = np.maximum(np.maximum.reduceat(high, first), np.maximum(highs[first], highs[last + 2]))
    start, end = start[first], end[last]
    # pairs of a left and a right symbol
    right = mix64(named ^ np.uint64(_SIDE * (level + 1) % 2**64)) >> np.uint64(63) == 1
    joins = np.append(~right[:-1] & right[1:], False)
    taken = np.concatenate(([False], joins[:-1]))
    left_alone, right_alone = ~right & ~joins, right & ~taken
    at = np.flatnonzero(joins)
    to = at + 1
    next_low, next_high = np.append(low[1:], far), np.append(high[1:], far)
    prior_low, prior_high = np.concatenate(([-1], low[:-1])), np.concatenate(([-1], high[:-1]))
    out_low = np.where(left_alone, np.minimum(low, next_low), np.where(right_alone, np.minimum(low, prior_low), low))
    out_high = np.where(left_alone, np.maximum(high, next_high), np.where(right_alone, np.maximum(high, prior_high), high))
    out_low[at], out_high[at] = np.minimum(low[at], low[to]), np.maximum(high[at], high[to])
    named[at] = mix64(mix64(named[at] * _PAIR) + named[to])
    end[at] = end[to]
    fresh[at] = True
    stay = ~taken
    return tuple(x[stay] for x in (named, start, end, out_low, out_high)), fresh[stay]


def _cover(best: list[np.ndarray], from_: np.ndarray, to: np.ndarray, key: np.ndarray) -> None:
    """Raises the best key of each window from ``from_`` to ``to``, in blocks of 2**k."""
    power = np.frexp((to - from_ + 1).astype(np.float64))[1] - 1
    for k in np.unique(power).tolist():
        own = power == k
        np.maximum.at(best[k], from_[own], key[own])
        np.maximum.at(best[k], to[own] - (1 << k) + 1, key[own])


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, first word and size of the anchor of each window."""
    n = words.size - WINDOW + 1
    name, start = mix64(words), np.arange(words.size)
    state = (name, start, start + 1, start, start + 1)
    best = [np.zeros(n, np.int64) for _ in range(WINDOW.bit_length())]
    known: list[tuple[np.ndarray, np.ndarray]] = []

    def offer(name: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        from_, to = np.maximum(high - WINDOW, 0), np.minimum(low, n - 1)
        use = (high - low <= WINDOW) & (low >= 0) & (high <= words.size) & (from_ <= to)
        name, start, end, from_, to = (x[use] for x in (name, start, end, from_, to))
        size = end - start
        # size, then the least name, then the first
        key = size << 57 | ((~name) >> np.uint64(38)).astype(np.int64) << 31 | ((1 << 31) - 1 - start)
        _cover(best, from_, to, key)
        known.append((start << 6 | size, name))

    for level in range(MOST_ROUNDS):
        if state[0].size < 2:
            break
        state, fresh = compressed(*state, level, words.size + 1)
        if not (state[4] - state[3] <= WINDOW).any():
            break
        offer(*(x[fresh] for x in state))
    for k in range(len(best) - 1, 0, -1):
        half = 1 << (k - 1)
        np.maximum(best[k - 1], best[k], out=best[k - 1])
        np.maximum(best[k - 1][half:], best[k][:-half], out=best[k - 1][half:])
    found = best[0]
    bare = np.flatnonzero(found == 0)
    for lo in range(0, bare.size, 4096):  # no symbol of two words has its context inside
        at = bare[lo : lo + 4096]
        at = at + np.argmin(name[at[:, None] + np.arange(WINDOW)], axis=1)
        found[bare[lo : lo + 4096]] = 1 << 57 | ((1 << 31) - 1 - at)
        known.append((at << 6 | 1, name[at]))
    size, start = found >> 57, (1 << 31) - 1 - (found & ((1 << 31) - 1))
    codes, names = (np.concatenate(x) for x in zip(*known))
    order = np.argsort(codes)
    return names[order[np.searchsorted(codes, start << 6 | size, sorter=order)]], start, size


def pieces(words: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: its name, a hash of all their words, the
    first window and how many there are.

    ``whole`` tells which windows count.  Equal windows that follow each other,
    as in a run of one word, are one piece.
    """
    found = [tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))]
    for lo in range(0, words.size - WINDOW + 1, STRETCH):
        part, use = words[lo : lo + STRETCH + WINDOW - 1], whole[lo : lo + STRETCH]
        name, start, size = anchors(part)
        cut = np.flatnonzero(np.concatenate(([True], (start[1:] != start[:-1]) | (size[1:] != size[:-1]) | (use[1:] != use[:-1]))))
        count = np.diff(np.append(cut, name.size))
        cut, count = cut[use[cut]], count[use[cut]]
        up, down = powers(part.size + 1)
        total = np.zeros(part.size + 1, np.uint64)
        np.cumsum(mix64(part ^ _DIGEST) * up[: part.size], out=total[1:])
        content = mix64((total[cut + count + WINDOW - 1] - total[cut]) * down[cut] + (count.astype(np.uint64) << np.uint64(8)) + (start[cut] - cut).astype(np.uint64))
        found.append((name[cut], content, cut + lo, count))
    name, content, first, count = (np.concatenate(x) for x in zip(*found))
    if not name.size:
        return name, content, first, count
    goes_on = (name[1:] == name[:-1]) & (content[1:] == content[:-1]) & (count[1:] == 1) & (count[:-1] == 1) & (first[1:] == first[:-1] + 1)
    opens = np.flatnonzero(np.concatenate(([True], ~goes_on)))
    return name[opens], content[opens], first[opens], np.add.reduceat(count, opens)


def pieces_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The pieces of all these texts: their text's number before those of :func:`pieces`.

    The texts make one row of symbols.  Between two stands a symbol that occurs
    once; windows over it don't count, and no other window's anchor depends on it.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    start, end = word_places(data)
    border = np.cumsum([0, *(len(t) + 1 for t in texts)])
    owner = np.searchsorted(border, start, "right") - 1
    enough = np.bincount(owner, minlength=len(texts)) >= WINDOW
    use = enough[owner]
    name, owner = word_names(data, start, end)[use], owner[use]
    rank = np.cumsum(enough) - 1
    at = np.arange(name.size) + rank[owner]  # with one place before each text but the first
    stream = mix64(np.arange(name.size + int(enough.sum()), dtype=np.uint64) + _BORDER)
    stream[at] = name
    solid = np.zeros(stream.size + 1, np.int64)
    solid[at + 1] = 1
    solid = np.cumsum(solid)
    whole = solid[WINDOW:] - solid[:-WINDOW] == WINDOW if stream.size >= WINDOW else np.empty(0, bool)
    name, content, first, count = pieces(stream, whole)
    own = owner[np.searchsorted(at, first)]
    opens = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if owner.size else owner
    begin = np.zeros(len(texts), np.int64)
    begin[owner[opens]] = at[opens]
    return own, name, content, first - begin[own], count


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each text: name, content, h1, h2, id, first, n."""
    for batch in batches:
        for low, high in runs_of(batch.column("text"), AT_ONCE):
            part = batch.slice(low, high - low)
            own, name, content, first, count = pieces_of(part.column("text").cast(pa.binary()).to_pylist())
            named = [part.column(c).to_numpy()[own] for c in ("h1", "h2", "id")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (name.view(np.int64), content.view(np.int64), *named, first, count)], names=["name", "content", "h1", "h2", "id", "first", "n"])


class _Text:
    """A text's words joined by one space each, and where they lie in that."""

    def __init__(self, data: bytes):
        start, end = word_places(np.frombuffer(data, np.uint8))
        self.joined = b" ".join(data.split())  # splits at the same bytes
        self.end = np.cumsum(end - start) + np.arange(start.size)
        self.start = self.end - (end - start)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit hashes of the marked windows of each text: h1, h2, id, at, w1, w2."""
    for batch in batches:
        texts, marks = batch.column("text").cast(pa.binary()), batch.column("marks")
        for i in range(batch.num_rows):
            text, own = _Text(texts[i].as_py()), marks[i].values
            first, n = (own.field(c).to_numpy() for c in ("first", "n"))
            at = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            for lo in range(0, at.size, ROWS):
                some = at[lo : lo + ROWS]
                hashed = b"".join(hashlib.blake2b(text.joined[a:b], digest_size=16).digest() for a, b in zip(text.start[some].tolist(), text.end[some + WINDOW - 1].tolist()))
                pair = np.frombuffer(hashed, np.int64).reshape(-1, 2)
                same = [pa.array(np.full(some.size, batch.column(c)[i].as_py(), np.int64)) for c in ("h1", "h2", "id")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(some), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], names=["h1", "h2", "id", "at", "w1", "w2"])


def _keep(with_text: bool) -> Callable:
    """What is left of each text once its repeats are cut out."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("first_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs, keys = batch.column("text").cast(pa.binary()), batch.column("runs"), [batch.column(c).to_pylist() for c in ("h1", "h2", "id")]
            rows, held = [], 0
            for i in range(batch.num_rows):
                text, own = _Text(texts[i].as_py()), runs[i].values
                words, kept, gone = text.end.size, text.joined, 0
                if own is not None:
                    first, n = (own.field(c).to_numpy() for c in ("first", "n"))
                    depth = np.zeros(words + 1, np.int64)
                    np.add.at(depth, first, 1)
                    np.add.at(depth, first + n + WINDOW - 1, -1)
                    stays = np.concatenate(([False], np.cumsum(depth[:-1]) == 0, [False]))
                    gone = words - int(stays.sum())
                    edges = np.flatnonzero(stays[1:] != stays[:-1])
                    kept = b" ".join([text.joined[a:b] for a, b in zip(text.start[edges[0::2]].tolist(), text.end[edges[1::2] - 1].tolist())])
                rows.append((*(k[i] for k in keys), words, gone, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
                held += len(kept)
                if held > AT_ONCE or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0

    return run


def dedup(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row.

    ``with_text`` adds what is left of the text, words joined by one space, as
    bytes.
    """
    keys = ["h1", "h2"]
    text = text_of()
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    named = docs.select("doc_id", ids.alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))
    size = named.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    # of equal texts one is looked at, that of the least doc_id
    texts = named.groupBy(*keys).agg(F.min("id").alias("id"), F.first("text").alias("text"))
    with co_located(texts, keys, size.bytes or 0, size.rows) as texts:
        # no text of fewer bytes has a window
        found = durable(texts.where(F.octet_length("text") >= 2 * WINDOW - 1).mapInArrow(_find, "name long, content long, h1 long, h2 long, id long, first long, n long"))
        names = found.groupBy("name").agg(F.min("id").alias("least"), F.max("id").alias("most"), (F.min("content") != F.max("content")).alias("differ"))
        names = durable(names.where("least < most").drop("most"))
        # sort-merge joins of written tables, of whose larger side a hot key is split among tasks
        live = durable(found.join(names.hint("merge"), "name").select(*keys, "id", "first", "n", "least", "differ"))
        drop(found, names)
        at = F.struct("first", "n")
        marks = live.where("differ").groupBy(*keys).agg(F.collect_list(at).alias("marks"))
        hashed = durable(texts.join(marks.hint("merge"), keys).select(*keys, "id", "text", "marks").mapInArrow(_windows, "h1 long, h2 long, id long, at long, w1 long, w2 long"))
        least = durable(hashed.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most"))
        late = hashed.join(least.hint("merge"), ["w1", "w2"]).where("id > least").select(*keys, F.col("at").alias("first"), F.lit(1).cast("long").alias("n"))
        gone = live.where("not differ and id > least").select(*keys, "first", "n").union(late)
        runs = gone.groupBy(*keys).agg(F.collect_list(at).alias("runs"))
        kept = texts.join(runs.hint("merge"), keys, "left").select(*keys, "id", "text", "runs")
        kept = kept.mapInArrow(_keep(with_text), "h1 long, h2 long, first_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
        kept = durable(kept if with_text else kept.drop("kept"))
        drop(live, hashed, least)

    again = (F.col("id") > F.col("first_id")) & (F.col("n_words") >= WINDOW)
    columns = [
        F.when(again, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(again, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    ]
    if with_text:
        columns.append(F.when(again, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    return named.select("doc_id", "id", *keys).join(kept, keys).select("doc_id", "n_words", *columns)
