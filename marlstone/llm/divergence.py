"""Source divergence audit over a minimal acyclic transducer vocabulary.

One pass over the texts counts in how many documents of its language each term
is; the terms of ``LEAST`` or more are the vocabulary, which Spark sorts, so that
each has a lexicographic ordinal.  A second pass cuts the texts into terms again
and streams them through transducers: vocabulary and terms are dealt by one hash
of language and term, a task first sees its sorted part of the vocabulary (of
some ``KEYS`` terms), builds the minimal acyclic transducer of it, and then
recounts what follows: a term that the transducer takes comes out as its ordinal,
the others end there.  From there on terms are ordinals, which also settle ties.

Counts stay sparse.  The value of a pair of sources is summed over the terms that
either has; all other terms have the same value, which is multiplied.

Defined results: a null text, lang or source is ''; rows are documents, so equal
rows count each; a language without kept terms has pairs of value 0; an empty
table has no rows out; extra columns are ignored.  Texts go through in stretches.
The sources of a language that share a term meet in one row: their pairs are
rows of the result in any case.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import drop, durable, runs_of, text_of

LEAST, RANKS, SCALE = 3, 200, 1_000_000_000
#: Bytes of texts taken together; pairs of sources expanded together; rows recounted together.
AT_ONCE, EXPANDED, ROWS = 4 << 20, 1 << 20, 200_000
#: Terms of the vocabulary in one task, about.
KEYS = 1 << 17

# terms are made of ASCII letters and all other characters beyond ASCII
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _stretches(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of about ``AT_ONCE`` bytes that no term crosses."""
    lo = 0
    while lo < data.size:
        hi = lo + AT_ONCE
        while hi < data.size and _LETTER[data[hi]]:  # on to the term's end, by blocks
            block = np.flatnonzero(~_LETTER[data[hi : hi + 4096]])
            hi += int(block[0]) if block.size else 4096
        hi = min(hi, data.size)
        yield lo, hi
        lo = hi


def _terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The text and the bytes of each term; texts lie between ``bounds``."""
    letter = _LETTER[data]
    before, behind = np.concatenate(([False], letter[:-1])), np.append(letter[1:], False)
    before[bounds[:-1][bounds[:-1] < data.size]] = False
    behind[bounds[1:][bounds[1:] > 0] - 1] = False
    start, end = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~behind) + 1
    offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), start.size, [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[letter]])])
    return np.searchsorted(bounds, start, "right") - 1, terms


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array]]:
    """Rows that go together, with the row and the bytes of each of their terms."""
    for low, high in runs_of(batch.column("text"), AT_ONCE):
        part = batch.slice(low, high - low)
        texts = part.column("text").cast(pa.binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        if offsets[-1] == offsets[0]:
            continue
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        if len(texts) > 1 or data.size <= AT_ONCE:
            yield part, *_terms(data, offsets - offsets[0])
        else:
            for lo, hi in _stretches(data):
                yield part, *_terms(data[lo:hi], np.array([0, hi - lo]))


def _sum_by(group: np.ndarray, terms: pa.Array, weight: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(group, term, sum of weights) of each group and term that occur."""
    coded = terms.dictionary_encode()
    key = group * len(coded.dictionary) + coded.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sums = np.add.reduceat(weight[order], first)
    return key[first] // len(coded.dictionary), coded.dictionary.take(pa.array(key[first] % len(coded.dictionary))), sums


def _in_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """l, term, df: in how many of some documents of a language each term is."""

    def out(langs: np.ndarray, document: np.ndarray, terms: pa.Array) -> pa.RecordBatch:
        document, terms, _ = _sum_by(document, terms, np.ones(len(terms), np.int64))  # once a document
        names, code = np.unique(langs, return_inverse=True)
        group, terms, df = _sum_by(code[document], terms, np.ones(len(terms), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(names[group]), terms, pa.array(df)], names=["l", "term", "df"])

    for batch in batches:
        long, owner = pa.array([], pa.binary()), None  # the terms of a text in several stretches
        for part, document, terms in _runs(batch):
            if part.num_rows > 1:
                if len(terms):
                    yield out(part.column("l").to_numpy(), document, terms)
                continue
            if owner is not part:
                if len(long):
                    yield out(owner.column("l").to_numpy(), np.zeros(len(long), np.int64), long)
                long, owner = pa.array([], pa.binary()), part
            long = pc.unique(pa.concat_arrays([long, pc.unique(terms)]))
        if len(long):
            yield out(owner.column("l").to_numpy(), np.zeros(len(long), np.int64), long)


def _in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """l, g, term, n: how often each term is in some documents of a group."""
    for batch in batches:
        for part, document, terms in _runs(batch):
            if not len(terms):
                continue
            names, first, code = np.unique(part.column("g").to_numpy(), return_index=True, return_inverse=True)
            group, found, n = _sum_by(code[document], terms, np.ones(len(terms), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(part.column("l").to_numpy()[first][group]), pa.array(names[group]), found, pa.array(n)], names=["l", "g", "term", "n"])


class Transducer:
    """The minimal acyclic automaton of sorted keys, and the number of each key.

    Keys come in order; once two part, the states behind the earlier one's end
    are final and are replaced by equal ones that are there already.
    """

    def __init__(self) -> None:
        self._known: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._open: list[list] = [[False, []]]  # [is the end of a key, [(byte, state)]]
        self._path = b""
        self._arrays: tuple[np.ndarray, ...] | None = None
        self.n = 0

    def add(self, key: bytes) -> None:
        same, most = 0, min(len(key), len(self._path))
        while same < most and key[same] == self._path[same]:
            same += 1
        if self.n and same == len(key) == len(self._path):
            return
        self._close(same)
        self._open.extend([False, []] for _ in range(len(key) - same))
        self._open[-1][0] = True
        self._path = key
        self.n += 1

    def _close(self, depth: int) -> None:
        while len(self._open) > depth + 1:
            final, arcs = self._open.pop()
            shape = (final, *arcs)
            state = self._known.get(shape)
            if state is None:
                state = self._known[shape] = len(self._states)
                self._states.append(shape)
            self._open[-1][1].append((self._path[len(self._open) - 1], state))

    def finish(self) -> "Transducer":
        """Arrays of arcs by state and byte: where they lead, and how many keys
        come before; the states' own tables are let go."""
        self._close(0)
        final, arcs = self._open.pop()
        self._states.append((final, *arcs))
        below = np.zeros(len(self._states), np.int64)
        keys, to, skip = [], [], []
        for state, (final, *arcs) in enumerate(self._states):  # an arc leads to an earlier state
            n = int(final)
            for byte, target in arcs:
                keys.append(state << 8 | byte)
                to.append(target)
                skip.append(n)
                n += int(below[target])
            below[state] = n
        ends = np.array([s[0] for s in self._states])
        self._arrays = (np.array(keys, np.int64), np.array(to, np.int64), np.array(skip, np.int64), ends)
        self._known, self._states = {}, []
        return self

    def ordinals(self, keys: pa.Array) -> np.ndarray:
        """The number of each key, -1 for those that aren't in it."""
        arcs, to, skip, ends = self._arrays
        offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
        data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)
        size = np.diff(offsets)
        state, number = np.full(len(keys), ends.size - 1, np.int64), np.zeros(len(keys), np.int64)
        alive, k = np.arange(len(keys)), 0
        done = np.full(len(keys), -1, np.int64)
        while alive.size:
            over = size[alive] == k
            ended = alive[over]
            done[ended] = np.where(ends[state[ended]], number[ended], -1)
            alive = alive[~over]
            if not arcs.size:
                break
            wanted = state[alive] << 8 | data[offsets[alive] + k]
            arc = np.minimum(np.searchsorted(arcs, wanted), arcs.size - 1)
            there = arcs[arc] == wanted
            alive, arc = alive[there], arc[there]
            number[alive] += skip[arc]
            state[alive] = to[arc]
            k += 1
        return done


def _recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """l, g, ord, n of the counted terms that are in the vocabulary.

    Rows of the vocabulary, which have no n, come first, by language and term.
    """
    machines: dict[int, tuple[Transducer, list[np.ndarray]]] = {}
    ready: dict[int, tuple[Transducer, np.ndarray]] = {}
    held: list[pa.RecordBatch] = []

    def recounted() -> Iterator[pa.RecordBatch]:
        """Equal terms of the held rows go through their transducer once."""
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        langs = rows.column("l").to_numpy()
        for lang in np.unique(langs).tolist():
            if lang not in machines:
                continue
            if lang not in ready:
                machine, ordinals = machines[lang]
                ready[lang] = machine.finish(), np.concatenate(ordinals)
            machine, ordinals = ready[lang]
            own = rows.filter(pa.array(langs == lang))
            terms = own.column("term").combine_chunks().dictionary_encode()
            number = machine.ordinals(terms.dictionary)[terms.indices.to_numpy()]
            own, number = own.select(["l", "g", "n"]).filter(pa.array(number >= 0)), number[number >= 0]
            yield pa.RecordBatch.from_arrays([*(own.column(c).combine_chunks() for c in ("l", "g")), pa.array(ordinals[number]), own.column("n").combine_chunks()], names=["l", "g", "ord", "n"])

    for batch in batches:
        counted = pc.is_valid(batch.column("n"))
        words = batch.filter(pc.invert(counted))
        langs = words.column("l").to_numpy(zero_copy_only=False)
        for cut in np.split(np.arange(langs.size), np.flatnonzero(langs[1:] != langs[:-1]) + 1) if langs.size else []:
            machine, ordinals = machines.setdefault(int(langs[cut[0]]), (Transducer(), []))
            some = words.slice(int(cut[0]), cut.size)
            for key in some.column("term").to_pylist():
                machine.add(key)
            ordinals.append(some.column("ord").to_numpy(zero_copy_only=False))
        if len(words) < len(batch):
            held.append(batch.filter(counted))
            if sum(map(len, held)) >= ROWS:
                yield from recounted()
    if held:
        yield from recounted()


def _divided(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """g, other, value: of the sources that share a term, what each pair gains by
    that over what it has where only one or neither has the term."""
    for batch in batches:
        groups = batch.column("groups")
        size = np.diff(groups.offsets.to_numpy()).astype(np.int64)
        flat = groups.flatten()
        name, code = np.unique(flat.field("g").to_numpy(), return_inverse=True)
        p, p0 = flat.field("p").to_numpy(), flat.field("p0").to_numpy()
        first = np.repeat(np.cumsum(size) - size, size)  # of the row's own sources
        times = np.repeat(size, size)
        ends = np.cumsum(times)
        lo = 0
        while lo < code.size:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + EXPANDED, "right")))
            n = times[lo:hi]
            a = np.repeat(np.arange(lo, hi), n)
            b = np.repeat(first[lo:hi], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            other = a != b
            a, b = a[other], b[other]
            value = _divided(p[a], p[b]) - _divided(p[a], p0[b]) - _divided(p0[a], p[b]) + _divided(p0[a], p0[b])
            pair = code[a] * len(name) + code[b]
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            cut = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))[: pair.size]
            sums = np.add.reduceat(value[order], cut) if pair.size else value
            yield pa.RecordBatch.from_arrays([pa.array(name[pair[cut] // len(name)]), pa.array(name[pair[cut] % len(name)]), pa.array(sums)], names=["g", "other", "value"])
            lo = hi


def _share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / total), exact."""
    return 1 + F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), total.cast("decimal(20,0)"))


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _numbered(named: DataFrame) -> tuple[DataFrame, Column, Column]:
    """(lang, source, l, g), one row a group, and the 64-bit numbers of a
    language and of a group as columns: hashes, salted so that no two are equal."""
    groups = durable(named.select("lang", "source").distinct())
    for salt in count():
        lang, group = F.xxhash64(F.lit(salt), "lang"), F.xxhash64(F.lit(salt), "lang", "source")
        found = groups.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(group).alias("g"), F.count_distinct("lang").alias("langs"), F.count_distinct(lang).alias("l")).first()
        if (found.n, found.langs) == (found.g, found.l):
            named_ = groups.withColumns({"l": lang, "g": group})
            named_.cut_path = groups.cut_path
            return named_, lang, group


def audit(docs: DataFrame, least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value and rank; see the module's text.

    Part ``pair`` compares each source with each other one of its language, part
    ``term`` lists the ``ranks`` terms by which it differs most from the language.
    """
    spark = docs.sparkSession
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = docs.select(blank("lang").alias("lang"), blank("source").alias("source"), text_of().alias("text"))
    names, lang, group = _numbered(named)
    seen = named.select(lang.alias("l"), "text").mapInArrow(_in_documents, "l long, term binary, df long")
    kept = durable(seen.groupBy("l", "term").agg(F.sum("df").alias("df")).where(F.col("df") >= least).select("l", "term"))
    # numbers of rows in order: the partition's number, then the place in it
    terms = durable(kept.repartitionByRange("l", "term").sortWithinPartitions("l", "term").select("l", "term", F.monotonically_increasing_id().alias("ord")))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-terms.count() // KEYS))
    counted = named.select(lang.alias("l"), group.alias("g"), "text").mapInArrow(_in_groups, "l long, g long, term binary, n long")
    none = F.lit(None).cast("long")
    rows = terms.select("l", none.alias("g"), "term", none.alias("n"), "ord").union(counted.select("l", "g", "term", "n", none))
    word = F.col("n").isNull()
    dealt = rows.repartition(parts, "l", "term").sortWithinPartitions(~word, F.when(word, F.col("l")), F.when(word, F.col("term")))
    counts = durable(dealt.mapInArrow(_recount, "l long, g long, ord long, n long").groupBy("l", "g", "ord").agg(F.sum("n").alias("n")))
    drop(kept)

    # one row a language and one a group, also of those without terms
    total, size = F.coalesce("total", F.lit(0)), F.coalesce("size", F.lit(0))
    sizes = terms.groupBy("l").agg(F.count(F.lit(1)).alias("size"))
    sums = counts.groupBy("g").agg(F.sum("n").alias("total"))
    groups = names.join(sums, "g", "left").join(sizes, "l", "left").select("lang", "source", "l", "g", size.alias("size"), (total + size).alias("mass"))
    groups = durable(groups.withColumn("p0", F.when(F.col("mass") > 0, _share(F.lit(0), F.col("mass")))))
    shared = durable(counts.join(groups.select("g", "mass", "p0"), "g").select("l", "g", "ord", "n", _share(F.col("n"), F.col("mass")).alias("p"), "p0"))
    drop(counts)

    # terms that a group has more often than its language
    whole = shared.groupBy("l", "ord").agg(F.sum("n").alias("all"))
    masses = groups.groupBy("l").agg((F.sum("mass") - (F.count(F.lit(1)) - 1) * F.max("size")).alias("mass"))
    usual = whole.join(masses, "l").select("ord", _share(F.col("all"), F.col("mass")).alias("q"))
    over = shared.join(usual, "ord").where("p > q").select("g", "ord", _gap(F.col("p"), F.col("q")).alias("value"))
    nth = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "ord"))
    best = over.withColumn("rank", nth).where(F.col("rank") <= ranks)
    listed = best.join(terms.select("ord", F.col("term").cast("string").alias("item")), "ord").join(groups.select("g", "lang", "source"), "g")
    listed = listed.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    # pairs: all terms as if neither had them, then those of the one, of the other, and of both
    one, two = (groups.select("l", F.col("g").alias(s), "size", F.col("p0").alias(p)) for s, p in (("g", "a0"), ("other", "b0")))
    base = one.join(two.drop("size"), "l").where("g <> other").select("g", "other", F.coalesce(F.col("size") * _gap(F.col("a0"), F.col("b0")), F.lit(0)).alias("value"))
    levels = shared.groupBy("l", "g", "p", "p0").agg(F.count(F.lit(1)).alias("times"))
    mine = levels.join(two.drop("size"), "l").where("g <> other")
    mine = mine.select("g", "other", (F.col("times") * (_gap(F.col("p"), F.col("b0")) - _gap(F.col("p0"), F.col("b0")))).alias("value"))
    theirs = levels.withColumnRenamed("g", "other").join(one.drop("size"), "l").where("g <> other")
    theirs = theirs.select("g", "other", (F.col("times") * (_gap(F.col("a0"), F.col("p")) - _gap(F.col("a0"), F.col("p0")))).alias("value"))
    bags = shared.groupBy("l", "ord").agg(F.collect_list(F.struct("g", "p", "p0")).alias("groups")).where(F.size("groups") > 1)
    both = bags.select("groups").mapInArrow(_met, "g long, other long, value long")
    summed = base.union(mine).union(theirs).union(both).groupBy("g", "other").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    shown = summed.join(groups.select("g", "lang", "source"), "g").join(groups.select(F.col("g").alias("other"), F.col("source").alias("item")), "other")
    place = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "item"))
    compared = shown.select("lang", "source", F.lit("pair").alias("part"), "item", "value", place.alias("rank"))
    done = durable(compared.union(listed))
    drop(terms, groups, shared, names)
    return done
