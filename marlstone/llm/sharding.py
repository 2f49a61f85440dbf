"""Sharding by histogram sort: near-equal bytes, one exchange.

Every row has a 62-bit key hashed from its doc_id and text, so the order of
keys is a fixed shuffle of the rows.  A splitter between two shards is found by
counting: exact bytes below evenly spaced probes, over all partitions, then
below finer probes inside the cell that holds the target, until the count is
within ``tolerance`` of it or the cell can't be cut further.  The driver sees
at most ``shards * 4096`` counts, whatever the input.  Rows move once, to their
shard and cell, where they are numbered.

This is the law `bytes`: sizes are near equal, and equal texts need not share a
shard.  A text is read for its size and hash only, whatever its length.

Defined results: a null text counts 8 bytes; rows without doc_id take part like
others; identical rows are told apart by the low bits of their key; an empty
table has no rows out; extra columns are ignored.  Rows of equal size and key
are numbered by doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import durable, text_of

KEY_BITS, CELL_BITS, FINER_BITS = 62, 12, 10
LOW_BITS = 10


def keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    even = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), text), 64 - KEY_BITS + LOW_BITS)
    low = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << LOW_BITS))
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
        (F.shiftleft(even, LOW_BITS) + low).alias("key"),
    )


def splitters(rows: DataFrame, shards: int, tolerance: float = 0.001) -> list[int]:
    """shards - 1 keys; shard k has the keys from splitter k - 1 to below k.

    ``rows`` (key, size) is read once a round; rounds go on until each count is
    within ``tolerance`` of a shard's bytes.
    """
    shift = KEY_BITS - CELL_BITS
    counts = rows.groupBy(F.shiftright("key", shift).alias("cell")).agg(F.sum("size").alias("bytes")).collect()
    total = sum(r.bytes for r in counts)
    goals = [total * k / shards for k in range(1, shards)]
    allowed = tolerance * total / shards
    #: of each open cell: bytes below it, and the goals inside
    opened: dict[int, tuple[int, list[int]]] = {-1: (0, list(range(shards - 1)))}
    best: dict[int, tuple[float, int]] = {}
    by_parent: dict[int, list[tuple[int, int]]] = {-1: [(r.cell, r.bytes) for r in counts]}
    width = CELL_BITS
    while True:
        finer: dict[int, tuple[int, list[int]]] = {}
        for parent, (below, wanted) in opened.items():
            waiting = list(wanted)
            for cell, size in sorted(by_parent.get(parent, [])):
                while waiting and goals[waiting[0]] < below + size:
                    k = waiting.pop(0)
                    for edge, at in ((below, cell << shift), (below + size, (cell + 1) << shift)):
                        best[k] = min(best.get(k, (float("inf"), 0)), (abs(edge - goals[k]), at))
                    if best[k][0] > allowed and shift:
                        finer.setdefault(cell, (below, []))[1].append(k)
                below += size
            for k in waiting:
                best.setdefault(k, (0.0, 1 << KEY_BITS))
        if not finer:
            return [best[k][1] for k in range(shards - 1)]
        width, old = min(FINER_BITS, shift), shift
        shift -= width
        parent = F.shiftright("key", old)
        counts = rows.where(parent.isin(*finer)).groupBy(F.shiftright("key", shift).alias("cell")).agg(F.sum("size").alias("bytes")).collect()
        by_parent = {}
        for r in counts:
            by_parent.setdefault(r.cell >> width, []).append((r.cell, r.bytes))
        opened = finer


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.001) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs``."""
    rows = durable(keyed(docs))
    cuts = splitters(rows, shards, tolerance)
    at = sum((F.when(F.col("key") >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    rows = rows.select("*", at.cast("int").alias("shard"), F.shiftright("key", KEY_BITS - CELL_BITS).alias("cell"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each shard and cell: 4096 + shards at most
    offset = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n")).select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "cell").orderBy("key", "doc_id", "text_crc32", "size")
    placed = rows.select("*", (F.row_number().over(within) - 1).alias("nth"))
    return placed.join(F.broadcast(offset), ["shard", "cell"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("nth")).alias("slot"))
