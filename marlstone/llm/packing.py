"""Best-fit packing under conflicts.

A document is cut into pieces of at most ``capacity`` words.  Pieces go into
bins by best fit, largest first: bins stand in order of what is left in them,
and the search runs from the first that can hold the piece to the next larger,
until one is compatible.  A bin carries bitmaps of the sources and of the
clusters of duplicates in it; it takes at most one piece of a cluster (of one
document too, then) and at most ``per_source`` of a source.

Documents are dealt by hash to groups of about ``group_bins`` bins, which are
packed side by side, each in one task of bounded size.  A hot source or cluster
spreads over all groups.

A group is one task's work, so bins never hold pieces of two groups.

Defined results: a null text has no words and is one piece of none; a null
source is a source; without a cluster column, equal texts form a cluster; rows
that repeat a doc_id are packed like any other; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import durable, text_of, word_count

GROUP_ROWS = 4096


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> list[int]:
    """The bin of each piece; pieces are taken in the order given.

    Bins are (left, number) in a sorted list.  Bitmaps are integers: bit s of
    ``level[q]`` is set once a bin holds more than q pieces of source s.
    """
    bit_of_source: dict = {}
    bit_of_cluster: dict = {}
    order: list[tuple[int, int]] = []
    held: list[tuple[list[int], int]] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s = 1 << bit_of_source.setdefault(source, len(bit_of_source))
        c = 1 << bit_of_cluster.setdefault(cluster, len(bit_of_cluster))
        at = bisect_left(order, (size, -1))
        while at < len(order):
            levels, seen = held[order[at][1]]
            if not seen & c and not levels[-1] & s:
                break
            at += 1
        if at < len(order):
            left, number = order.pop(at)
        else:
            left, number = capacity, len(held)
            held.append(([0] * per_source, 0))
        levels, seen = held[number]
        for q in range(per_source):
            if not levels[q] & s:
                levels[q] |= s
                break
        held[number] = (levels, seen | c)
        insort(order, (left - size, number))
        out.append(number)
    return out


def pieces(docs: DataFrame, capacity: int, cluster: Column | None = None) -> DataFrame:
    text = text_of()
    sized = docs.select("doc_id", "source", (F.xxhash64(text) if cluster is None else cluster).alias("cluster"), word_count(text).alias("words"))
    count = F.greatest(F.lit(1), F.ceil(F.col("words") / capacity))
    cut = sized.select("*", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("piece"))
    first = F.col("piece").cast("long") * capacity
    return cut.select("doc_id", "source", "cluster", "piece", first.alias("first_word"), F.least(F.lit(capacity), F.col("words") - first).cast("int").alias("n_words"))


def pack(docs: DataFrame, capacity: int = 2048, per_source: int = 4, cluster: Column | None = None, group_bins: int = 256) -> DataFrame:
    """doc_id, piece, first_word, n_words, bin_group, bin and position."""
    cut = durable(pieces(docs, capacity, cluster))
    t = cut.agg(F.sum("n_words").alias("words"), F.count(F.lit(1)).alias("rows")).first()
    groups = max(1, -(-(t.words or 0) // (capacity * group_bins)), -(-t.rows // GROUP_ROWS))
    # a whole piece and its remainder go apart, as one document may have many
    dealt = cut.withColumn("bin_group", F.pmod(F.xxhash64("cluster", "doc_id", "piece"), F.lit(groups)).cast("int"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["n_words", "doc_id", "piece", "cluster"], ascending=[False, True, True, True], kind="stable", na_position="first")
        source = [None if pd.isna(s) else s for s in frame.source]
        frame["bin"] = best_fit(frame.n_words.tolist(), source, frame.cluster.tolist(), capacity, per_source)
        frame["position"] = frame.groupby("bin").cumcount()
        return frame[["doc_id", "piece", "first_word", "n_words", "bin_group", "bin", "position", "source", "cluster"]]

    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema}
    schema = f"doc_id {kinds['doc_id']}, piece int, first_word long, n_words int, bin_group int, bin int, position int, source {kinds['source']}, cluster {kinds['cluster']}"
    return dealt.groupBy("bin_group").applyInPandas(run, schema)
