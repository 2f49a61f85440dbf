"""Predicates that several queries share."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import contains_ci


def available(df: DataFrame) -> DataFrame:
    """On show, not reserved and priced; null flags don't count."""
    return df.where(F.col("exhibicion_inventario") & ~F.col("separado") & F.col("precio").isNotNull())


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def matching(df: DataFrame, contains: dict[str, str | None], at_least: dict[str, float | None], at_most: dict[str, float | None], raw_patterns: bool = False) -> DataFrame:
    """Rows that meet each condition whose value isn't empty or zero."""
    conditions = [contains_ci(F.col(c), v, raw_patterns) for c, v in contains.items() if v]
    conditions += [F.col(c) >= v for c, v in at_least.items() if v]
    conditions += [F.col(c) <= v for c, v in at_most.items() if v]
    return df.where(all_of(conditions)) if conditions else df


def single(df: DataFrame, key: Column) -> DataFrame:
    """Rows whose key occurs once: no other row can be meant."""
    named = df.withColumn("_key", key)
    once = named.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("_key")
    return named.join(once, "_key", "left_semi").select(*df.columns)
