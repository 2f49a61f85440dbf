"""Personal data: patterns propose, checksums confirm, context adjusts.

Regular expressions propose spans; validators drop those that can't be what
they look like (octets over 255, the Luhn sum of cards, the mod-97 sum of
IBANs, digit counts of phones); each span starts with its kind's score, which
context words around it raise.  Spans of the base kinds always stay, whatever
their score; others stay from ``LEAST`` on, where no base span overlaps them.

Patterns are written so that a run of characters is tried from its start only
(possessive, with look-behind), so very long runs take linear time; the matches
are those of the plain patterns.  Time is in proportion to the text and its
matches, and a text is held whole, with its spans, by one task.

Defined results: a null text is an empty one; repeated rows have equal
findings; an empty table has no rows out; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import text_of
from marlstone.llm.spans import before, counted, joined, let, with_spans

_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    # after a match, what is left of a run may start the next one: \G
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole chains of digits with single separators, of 13 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Countries by the length of their account numbers.
IBAN = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA",
    23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN.items())
MORE = {
    # as long as the country has it, so that a following word stays outside; other countries at any length
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_KNOWN}|(?!{'|'.join(IBAN.values())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])",
}
KINDS = [*BASE, *MORE]
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "local_phone": 0.4}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "server|host|address|addr",
    "card": "card|visa|master|amex|credit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|transfer",
    "local_phone": "phone|tel|call|mobile|fax",
}
REACH, BOOST, LEAST = 40, 0.3, 0.6


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def mod97(text: Column) -> Column:
    """The ISO 7064 remainder of an account number: 1 if it is right."""
    bare = F.replace(text, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(bare, 5, 1000), F.substring(bare, 1, 4)), "")
    turned = F.filter(turned, lambda c: c != "")
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(turned, F.lit(0), lambda acc, c: (acc * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)


def _octet(part: Column) -> Column:
    bare = F.ltrim(part, F.lit("0"))
    return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(text, r"\."), _octet)
    if kind == "card":
        return F.call_function("luhn_check", _digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    if kind == "iban":
        return mod97(text) == 1
    return F.lit(True)


#: What a text must hold for a kind to be tried; the patterns can't match without.
_DIGIT = "_digit"


def _only() -> dict[str, Column]:
    holds = lambda c: F.contains("_text", F.lit(c))
    digit = F.col(_DIGIT)
    return {"email": holds("@"), "ip": digit & holds("."), "card": digit, "phone": digit & holds("+"), "iban": digit, "local_phone": digit & (holds("-") | holds("."))}


def without_overlaps(base: Column, more: Column) -> Column:
    """All of ``base`` and those of ``more`` that overlap none of them.

    Both stand in one order by start; a span of ``more`` is compared with the
    furthest end of all base spans before it and the next start of one after.
    """
    far = F.lit(2**62).cast("long")
    turned = lambda spans, extra: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(extra).alias("extra"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["score"].alias("score")))

    def kept(u: Column) -> Column:
        ends = before(F.transform(u, lambda s: F.when(s["extra"], 0).otherwise(s["end"]).cast("long")), F.lit(0).cast("long"), F.greatest)
        starts = before(F.transform(F.reverse(u), lambda s: F.when(s["extra"], far).otherwise(s["start"])), far, F.least)
        clear = lambda e, n: F.filter(u, lambda s, i: ~s["extra"] | ((F.get(e, i) <= s["start"]) & (F.get(n, F.size(u) - 1 - i) >= s["end"])))
        return let(ends, lambda e: let(starts, lambda n: clear(e, n)))

    both = let(F.array_sort(F.concat(turned(base, False), turned(more, True))), kept)
    both = F.transform(both, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["score"].alias("score")))
    return F.when(F.size(more) > 0, both).otherwise(base)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``spans``: structs (rank, start, end, kind, score)."""
    named = docs.select(*keep, text_of().alias("_text"), text_of().rlike("[0-9]").alias(_DIGIT))
    found = with_spans(named, "_text", {f"_{k}": p for k, p in (BASE | MORE).items()}, {f"_{k}": c for k, c in _only().items()}, REACH)

    def judged(kind: str) -> Column:
        score = lambda s: F.least(F.lit(1.0), F.lit(SCORE[kind]) + F.when(s["near"].rlike(CONTEXT[kind]), BOOST).otherwise(0.0))
        kept = F.filter(f"_{kind}", lambda s: _valid(kind, s["text"]))
        out = F.transform(kept, lambda s: F.struct(F.lit(KINDS.index(kind)).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), score(s).alias("score")))
        return out if kind in BASE else F.filter(out, lambda s: s["score"] >= LEAST)

    found = found.select(*keep, F.concat(*map(judged, BASE)).alias("_base"), F.concat(*map(judged, MORE)).alias("_more"))
    return found.select(*keep, F.array_sort(without_overlaps(F.col("_base"), F.col("_more"))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = [counted("spans", k) for k in BASE]
    return found.select("doc_id", *count, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.transform("spans", lambda s: F.round(s["score"], 2)).alias("scores"))
