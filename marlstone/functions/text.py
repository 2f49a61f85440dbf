"""Text columns: patterns, tokens, money and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def escaped(term: str) -> str:
    """``term`` with LIKE wildcards made literal."""
    return term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


#: A collation under which neither case nor accents count.
FOLDED = "UNICODE_CI_AI"


def folded(c: Column) -> Column:
    return F.collate(c, FOLDED)


def contains_ci(c: Column, term: str, raw_pattern: bool = False, fold: bool = False) -> Column:
    """Whether ``c`` holds ``term`` in any case; null stays null.

    ``fold`` lets accents differ too; a folded term is never a pattern.
    """
    if fold:
        return F.contains(folded(c), folded(F.lit(term)))
    return c.ilike(f"%{term if raw_pattern else escaped(term)}%")


def trimmed(c: Column) -> Column:
    """Without any Unicode white space at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def tokens(c: Column) -> Column:
    """Lower-case words of more than two characters, in order."""
    return F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda t: F.length(t) > 2)


def money(c: Column) -> Column:
    """Whole currency units, half away from zero: ``$280,000``, ``-$3``."""
    c = c.cast("double")
    return F.concat(F.when(c < 0, "-").otherwise(""), F.lit("$"), F.format_number(F.round(F.abs(c)), 0))


def money_or_null(c: Column) -> Column:
    """``money``, but null for zero too."""
    return F.when(c != 0, money(c))


def kilometres(c: Column, missing: str = "No disponible") -> Column:
    return F.coalesce(F.concat(F.call_function("format_number", c.cast("double"), F.lit("#,##0.###")), F.lit(" km")), F.lit(missing))


def title(c: Column, *parts: Column) -> Column:
    """The title, or its parts if it is empty; null parts are left out."""
    return F.coalesce(blank_to_null(c), F.concat_ws(" ", *[p.cast("string") for p in parts]))


def link(own: Column, slug: Column, base: str) -> Column:
    return F.coalesce(blank_to_null(own), F.when(slug != "", F.concat(F.lit(base), slug)))


def percent(c: Column) -> Column:
    """``15%``, ``12.5%``."""
    return F.concat(F.regexp_replace(c.cast("double").cast("string"), r"\.0$", ""), F.lit("%"))


def not_known(term: Column) -> Column:
    return F.concat(F.lit("Nothing is known of "), term, F.lit("."))


def correction(field: str, given: Column, used: Column, changed: Column) -> Column:
    """``field: given → used`` where it was changed, else null."""
    return F.when(changed, F.concat(F.lit(f"{field}: "), given.cast("string"), F.lit(" → "), used.cast("string")))


def document(*columns: str) -> Column:
    """A JSON document of these columns, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def corrections(*messages: Column) -> Column:
    """The messages that aren't null, in order."""
    return F.array_compact(F.array(*messages))
