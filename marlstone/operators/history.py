"""Status history: validity intervals and the status at any time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(changes: DataFrame) -> DataFrame:
    """(key, status, valid_from, valid_to) from ``changes`` (key, at, seq, status).

    Repeats of a status make one interval; the last one of a key has no end.
    Of several changes at one time the last by ``seq`` holds; those before it
    held for no time and have no interval.
    """
    last = changes.groupBy("key", "at").agg(F.max_by("status", "seq").alias("status"))
    w = Window.partitionBy("key").orderBy("at")
    starts = last.withColumn("_before", F.lag("status").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    opened = starts.where(F.col("_first") | ~F.col("status").eqNullSafe(F.col("_before")))
    return opened.select("key", "status", F.col("at").alias("valid_from"), F.lead("at").over(w).alias("valid_to"))


def as_of(probes: DataFrame, changes: DataFrame, unit: str | Callable[[Column], Column] = "day") -> DataFrame:
    """``probes`` (key, at, ...) with ``status`` and ``since`` of the last change until then.

    Probes and changes of a key meet in stretches of time of one ``unit``, so a
    key with very many of either is spread over tasks; what held at the start of
    a stretch comes from the last change of an earlier one, of which there is
    one row a stretch.  Nothing is paired: each row looks back along one order.
    A change at the probe's own time counts; of several the last by ``seq``.
    A probe before the first change, or without key or time, has no status.
    ``at`` may be any ordered type where ``unit`` is a function that tells a
    value's stretch, in the same order.
    """
    columns = probes.columns
    stretch = unit(F.col("at")) if callable(unit) else F.date_trunc(unit, "at")
    known = changes.where("key is not null and at is not null").select("key", "at", stretch.alias("_unit"), F.struct("at", "seq", "status").alias("_change"))
    usable = F.col("key").isNotNull() & F.col("at").isNotNull()
    asked = probes.where(usable).select("*", stretch.alias("_unit"), F.struct(*columns).alias("_row"))
    # what each stretch ends with, and so what a later one starts with
    ends = known.groupBy("key", "_unit").agg(F.max("_change").alias("_end"))
    stretches = ends.unionByName(asked.select("key", "_unit").distinct().join(ends.select("key", "_unit"), ["key", "_unit"], "left_anti"), allowMissingColumns=True)
    earlier = Window.partitionBy("key").orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select("key", "_unit", F.last("_end", ignorenulls=True).over(earlier).alias("_start")).where("_start is not null")
    rows = (
        known.select("key", "_unit", "at", F.lit(0).alias("_kind"), "_change")
        .unionByName(starts.select("key", "_unit", F.col("_start.at").alias("at"), F.lit(0).alias("_kind"), F.col("_start").alias("_change")))
        .unionByName(asked.select("key", "_unit", "at", F.lit(1).alias("_kind"), "_row"), allowMissingColumns=True)
    )
    back = Window.partitionBy("key", "_unit").orderBy("at", "_kind", "_change.seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("_change", F.last("_change", ignorenulls=True).over(back)).where("_kind = 1")
    found = seen.select("_row.*", F.col("_change.status").alias("status"), F.col("_change.at").alias("since"))
    return found.unionByName(probes.where(~usable).select("*", F.lit(None).cast(found.schema["status"].dataType).alias("status"), F.lit(None).cast(found.schema["since"].dataType).alias("since")))
