"""Mixing sources to target weights by capped water-filling.

Sources share ``share`` of all words by weight, but none beyond ``epochs``
times its own size: such a source is clamped there and what it can't take goes
to the others in proportion to their weights, until none is above.  A source
with the rate r = target / size takes each of its documents floor(r) whole
times; the fractional repetition goes to the documents whose seeded hash lies
below the source's threshold.  The threshold is found by exact counts of words
in 4096 cells of the hash, and the documents of the one cell that straddles it
take an equal part of their words, so taken words meet targets closely.  Where
documents are repeated, the cell is refined until one document straddles the
threshold, so that no other is cut.

Defined results: a null text has no words; null is a source, the last; a
source without words has the target 0; rows that repeat a doc_id are taken
alike; extra columns are ignored.  Nothing depends on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import durable, text_of, word_count

CELLS = 4096
BROADCAST_BYTES, SALTS = 8 << 20, 64


def _hash(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def _draw(seed: str, digits: int, skip: int) -> Column:
    """An integer of so many hexadecimal digits of a seeded hash of doc_id."""
    return F.conv(F.substring(_hash(seed), skip + 1, digits), 16, 10).cast("long")


def water_fill(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, epochs: int = 3) -> DataFrame:
    """``sizes`` (source, source_size) with each source's ``target``.

    Works on one row for each source.  Sources ordered by size / weight are
    clamped in this order while the level reached without those before still
    lies above their cap; that level rises up to the first source that isn't
    clamped and falls after it.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    named = sizes.select("source", "source_size", (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).alias("turn"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("turn")).cast("double")
    named = named.select("source", "source_size", weight.alias("weight"))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.floor(F.sum("source_size").over(everything) * share) if share != 1 else F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum(F.col("source_size") * epochs).over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = named.select("*", (left.cast("double") / open_weight).alias("level"))
    cap = (F.col("source_size") * epochs).cast("double")
    final = F.max(F.when(F.col("level") * F.col("weight") <= cap, F.col("level"))).over(everything)
    wanted = F.coalesce(final * F.col("weight"), cap)
    return level.select("source", "source_size", F.least(cap, wanted).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, epochs: int = 3, seed: str = "mix", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, size, source_size, target, whole and taken.

    ``whole`` counts whole repetitions, ``taken`` all words taken.
    """
    return _mixed(docs, weights, share, epochs, seed, keep).select("_kept.*", "size", "source_size", "target", "whole", "taken")


def _mixed(docs: DataFrame, weights: tuple[int, ...], share: float, epochs: int, seed: str, keep: tuple[str, ...], fine: bool = False) -> DataFrame:
    # the first three digits of the order are the cell; the text parts rows that repeat a doc_id
    order = F.concat(_hash(seed), F.md5(text_of())) if fine else F.lit(None).cast("string")
    sized = docs.select(F.struct(*keep).alias("_kept"), F.col("source").alias("_source"), word_count(text_of()).alias("size"), F.shiftright(_draw(seed, 8, 0), 20).alias("_cell"), (_draw(seed, 8, 8) / F.lit(2.0**32)).alias("_part"), order.alias("_order"))
    if "text" not in keep:  # then counting words once is dearer than a cut without texts
        sized = durable(sized)
    cells = sized.groupBy(F.col("_source").alias("source"), F.col("_cell").alias("cell")).agg(F.sum("size").alias("words"))
    sizes = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = water_fill(sizes, weights, share, epochs).select(
        "*",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"),
    ).select("*", (F.col("target") - (F.col("whole") * F.col("source_size")).cast("double")).alias("rest"))
    edge = _edge(cells, plan)
    if fine:
        edge = _refined(sized, durable(edge))
    edge = edge.select("e", "cell", F.try_divide(F.col("left"), F.col("words").cast("double")).alias("part"))
    plan = durable(plan.join(edge, F.col("source").eqNullSafe(F.col("e")), "left").drop("e"))
    out = _with_plan(sized, plan)
    place = F.col("_order" if fine else "_cell")
    extra = F.when(place < F.col("cell"), F.col("size")).when(place == F.col("cell"), F.floor(F.col("part") * F.col("size") + F.col("_part"))).otherwise(0)
    return out.select("_kept", "size", "source_size", "target", "whole", (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"), F.coalesce(place < F.col("cell"), F.lit(False)).alias("_below"))


def _edge(cells: DataFrame, plan: DataFrame) -> DataFrame:
    """The cell of each source ``e`` in which its words reach ``rest``, and what is ``left`` for it."""
    upto = Window.partitionBy("source").orderBy("cell")
    reached = cells.select("*", F.sum("words").over(upto).alias("upto"))
    more = [c for c in cells.columns if c not in ("source", "cell")]
    return (
        reached.join(plan.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        .where(F.col("upto") > F.col("rest"))
        .groupBy("source")
        .agg(F.min_by(F.struct("cell", *more, (F.col("rest") - (F.col("upto") - F.col("words")).cast("double")).alias("left")), "cell").alias("edge"))
        .select(F.col("source").alias("e"), "edge.*")
    )


def _refined(sized: DataFrame, edge: DataFrame) -> DataFrame:
    """``edge`` with the one place in the order, as ``cell``, that straddles the threshold.

    Each round counts the documents of the straddling cells by three more
    digits; only rows equal in doc_id and text can share the last place.
    """
    same = F.col("_source").eqNullSafe(F.col("e"))
    rows = sized.select("_source", "size", "_cell", "_order")
    inside = durable(rows.join(edge.select("e", "cell"), same & (F.col("_cell") == F.col("cell"))).select("_source", "size", "_order"))
    for digits in range(6, 67, 3):
        cells = inside.groupBy(F.col("_source").alias("source"), F.substring("_order", 1, digits).alias("cell"))
        cells = cells.agg(F.sum("size").alias("words"), F.min("_order").alias("first"), F.max("_order").alias("last"))
        edge = durable(_edge(cells, edge.select(F.col("e").alias("source"), F.col("left").alias("rest"))))
        if edge.where("first < last").isEmpty():
            break
        inside = inside.join(edge.select("e", "cell"), same & (F.substring("_order", 1, digits) == F.col("cell"))).select("_source", "size", "_order")
    return edge.select("e", F.col("last").alias("cell"), "words", "left")


def _with_plan(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Each document with its source's plan.

    The plan has one row for each source.  Up to ``BROADCAST_BYTES`` it goes to
    every task, so no text moves; a larger one meets the documents by source
    and salt, so a hot source spreads over ``SALTS`` tasks.
    """
    bytes_ = plan.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 128)).first()[0] or 0
    same = F.col("_source").eqNullSafe(F.col("source"))
    if bytes_ <= BROADCAST_BYTES:
        return sized.join(F.broadcast(plan), same)
    salted = sized.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)))
    wide = plan.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(wide, same & (F.col("_salt") == F.col("_other"))).drop("_salt", "_other")


def repeated(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0, epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them.

    A fractional repetition has the document's first words; only one document
    of a source, or its equal rows, has one.  A document without words is
    repeated as often as others at its place; of a source without any words,
    whose target is 0, nothing is taken.
    """
    mixed = _mixed(docs, weights, share, epochs, seed, tuple(docs.columns), fine=True)
    rest = F.col("taken") - F.col("whole") * F.col("size")
    copies = F.concat(
        F.array_repeat(F.lit(-1).cast("long"), (F.col("whole") + ((F.col("size") == 0) & F.col("_below")).cast("int")).cast("int")),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")),
    )
    out = mixed.select("_kept", "size", F.explode(copies).alias("_words"))
    text = F.col("_kept.text")
    bare = F.regexp_replace(text, r"^[\x20\x09-\x0D]+", "")
    first = F.array_join(F.slice(F.split(bare, r"[\x20\x09-\x0D]+"), F.lit(1), F.col("_words").cast("int")), " ")
    cut = F.col("_words").between(0, F.col("size") - 1)
    new = {"text": F.when(cut, first).otherwise(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length(first).cast("long")).otherwise(F.col("_kept.n_chars"))
    return out.select(*[new[c].alias(c) if c in new else F.col(f"_kept.`{c}`") for c in docs.columns])
