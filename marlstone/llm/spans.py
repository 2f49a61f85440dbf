"""Positions of all matches of a pattern, by SQL functions alone.

Spark returns the matches of a pattern but not where they are.  Splitting a
text by the same pattern gives what lies between them, so a match starts after
the lengths of all before it.  Sums over all elements before each go by blocks
of 64, and of 64 blocks, and reach elements by their index, so a text with very
many matches takes time in proportion.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:bigint,end:bigint,text:string,near:string>>"
BLOCK = 64
#: A match has five characters at least, so so many of them fill any context.
NEIGHBOURS = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _int(c: Column) -> Column:
    return c.cast("int")


def before(values: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` what ``join`` makes of all before it, in an array as long."""

    def fold(a: Column, lo: Column, n: Column) -> Column:
        # ``n`` elements from ``lo``
        return F.when(n > 0, F.aggregate(F.sequence(lo, lo + n - 1), zero, lambda acc, j: join(acc, F.get(a, j)))).otherwise(zero)

    def blocks(a: Column) -> Column:
        whole = _int(F.floor((F.size(a) - 1) / BLOCK))
        return F.transform(F.sequence(F.lit(0), whole), lambda b: fold(a, b * BLOCK, F.least(F.lit(BLOCK), F.size(a) - b * BLOCK)))

    def spread(a: Column, of_block: Column) -> Column:
        at = lambda i: _int(F.floor(i / BLOCK))
        return F.transform(a, lambda _, i: join(F.get(of_block, at(i)), fold(a, at(i) * BLOCK, i % BLOCK)))

    def levels(a: Column, ones: Column) -> Column:
        top = lambda twos: F.transform(twos, lambda _, i: fold(twos, F.lit(0), i))
        return let(let(blocks(ones), lambda twos: let(top(twos), lambda t: spread(ones, t))), lambda o: spread(a, o))

    return let(values, lambda a: F.when(F.size(a) > 0, let(blocks(a), lambda ones: levels(a, ones))).otherwise(a))


def _near(hits: Column, parts: Column, i: Column, reach: int) -> Column:
    """``reach`` characters on both sides of match ``i``, and it, in lower case."""
    right, left = (lambda c: F.right(c, F.lit(reach))), (lambda c: F.left(c, F.lit(reach)))
    ahead = F.transform(F.sequence(F.greatest(i - NEIGHBOURS, F.lit(0)), i), lambda j: F.concat(right(F.get(parts, j)), F.when(j < i, right(F.get(hits, j))).otherwise("")))
    behind = F.transform(F.sequence(i, F.least(i + NEIGHBOURS, F.size(hits) - 1)), lambda j: F.concat(F.when(j > i, left(F.get(hits, j))).otherwise(""), left(F.get(parts, j + 1))))
    return F.lower(F.concat(right(F.array_join(ahead, "")), F.get(hits, i), left(F.array_join(behind, ""))))


def spans(text: Column, pattern: str, reach: int = 0) -> Column:
    """Start, end, text and, up to ``reach`` characters away, what stands near, of each match.

    Matches are leftmost and don't overlap; start and end count code points,
    end is exclusive.  ``text`` must not be null.
    """

    def placed(hits: Column, parts: Column) -> Column:
        lengths = F.transform(parts, lambda p, i: (F.length(p) + F.coalesce(F.length(F.get(hits, i)), F.lit(0))).cast("long"))

        def one(starts: Column, m: Column, i: Column) -> Column:
            start = F.get(starts, i) + F.length(F.get(parts, i))
            near = _near(hits, parts, i, reach) if reach else F.lit(None).cast("string")
            return let(start, lambda s: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("text"), near.alias("near")))

        return let(before(lengths, F.lit(0).cast("long"), lambda x, y: x + y), lambda starts: F.transform(hits, lambda m, i: one(starts, m, i)))

    found = lambda hits: F.when(F.size(hits) > 0, let(F.split(text, pattern, -1), lambda parts: placed(hits, parts)))
    return F.coalesce(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found), F.array().cast(SPAN))


def with_spans(df: DataFrame, text: str, patterns: dict[str, str], only: dict[str, Column] | None = None, reach: int = 0) -> DataFrame:
    """``df`` with a column of :func:`spans` for each of ``patterns``.

    Where ``only`` has a false condition for a name, its pattern is not tried.
    """
    only = only or {}
    found = {k: spans(F.col(text), p, reach) for k, p in patterns.items()}
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *[(F.when(only[k], v).otherwise(F.array().cast(SPAN)) if k in only else v).alias(k) for k, v in found.items()])


def joined(spans: Column) -> Column:
    """``kind:start:end`` of structs with these fields, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counted(spans: str, kind: str) -> Column:
    """How many structs of the column ``spans`` have this kind, as n_<kind>."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
