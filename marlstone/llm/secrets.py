"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content, so the
same content is scanned once however many paths hold it.  The ledger has, for
each blob, the versioned rules that have been applied and the spans found; a
run scans only the pairs of blob and rule version that the ledger lacks, and
findings join back to all paths by content address.  Addresses go first: texts
move only for blobs that are to be scanned, so a run that has none moves none.

Defined results: a null text is an empty one; repeated rows have equal
findings; an empty table has no rows out; the order of rows and extra columns
don't matter.  Time is in proportion to the text and its matches, and a text is
held whole, with its spans, by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import CLEANUP, children, durable, exists, fresh, new_path, remove, setting, text_of
from marlstone.llm.spans import before, counted, joined, let, with_spans

LEDGER = "blob string, rules array<string>, spans array<struct<start:bigint,rank:int,end:bigint,kind:string,rule:string>>"

#: kind: (pattern, what a match must satisfy). Fixed values of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]{24,}+"}
#: Our own kinds, beside those.
MORE = {
    # to the END line, where one comes before the next BEGIN line; each stretch is tried once
    "pem": r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]{0,20}PRIVATE KEY-----)?+",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "prefixed": r"(?<![A-Za-z0-9_])(?:gh[oprsu]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+)",
}
KINDS = [*BASE, *MORE]
#: Raise a rule's version when its pattern changes; then only that rule runs again.
VERSIONS = {k: f"{k}@1" for k in KINDS} | {"pem": "pem@2"}
MARK = "[SECRET]"
#: Unseen blobs whose addresses and rules (some 150 bytes each) are sent to all
#: tasks; files of a ledger that is compacted.
AT_ONCE, MOST_FILES = 50_000, 1000


def _valid(kind: str, text: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(text, ASSIGN, 2)) >= 6
    return F.length(text) >= {"access": 20}.get(kind, 1)


def _only() -> dict[str, Column]:
    """What a text must hold for a kind to be tried; the patterns can't match without."""
    holds = lambda c: F.contains("text", F.lit(c))
    return {"assign": holds("=") | holds(":"), "access": holds("AKIA"), "hex": F.lit(True), "pem": holds("-----BEGIN "), "jwt": holds("eyJ"), "prefixed": holds("_") | holds("xox")}


def scan(blobs: DataFrame, todo: str | None = None) -> DataFrame:
    """``spans`` of each row of ``blobs`` (blob, text, ...): sorted structs.

    ``todo`` names a column with the rule versions to apply; by default all.
    """
    only = {f"_{k}": c & F.array_contains(todo, VERSIONS[k]) if todo else c for k, c in _only().items()}
    found = with_spans(blobs, "text", {f"_{k}": p for k, p in (BASE | MORE).items()}, only)

    def each(kind: str) -> Column:
        kept = F.filter(f"_{kind}", lambda s: _valid(kind, s["text"]))
        return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(VERSIONS[kind]).alias("rule")))

    return found.withColumn("spans", F.array_sort(F.concat(*map(each, KINDS)))).drop(*[f"_{k}" for k in KINDS])


def blobs_of(versions: DataFrame) -> DataFrame:
    """(blob, text), one row for each distinct content."""
    named = versions.select(text_of().alias("text"))
    return named.select(F.sha2("text", 256).alias("blob"), "text").groupBy("blob").agg(F.first("text").alias("text"))


def unseen(versions: DataFrame, ledger: DataFrame) -> DataFrame:
    """(blob, rules): what is to be scanned, by addresses alone."""
    rules = F.array(*map(F.lit, VERSIONS.values()))
    blobs = versions.select(F.sha2(text_of(), 256).alias("blob")).distinct()
    seen = blobs.join(ledger.select("blob", F.col("rules").alias("_seen")), "blob", "left").groupBy("blob").agg(F.flatten(F.collect_list("_seen")).alias("_seen"))
    return seen.select("blob", F.array_except(rules, "_seen").alias("rules")).where(F.size("rules") > 0)


def extend(versions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """What the ledger lacks: (blob, rules, spans) of the pairs not yet scanned.

    A ledger has the same columns; the result is one itself, and :func:`merged`
    joins the two.  Up to ``AT_ONCE`` unseen blobs, whose addresses and rules
    are then sent to all tasks, no other text is moved.
    """
    if ledger is None:
        return scan(blobs_of(versions)).select("blob", F.array(*map(F.lit, VERSIONS.values())).alias("rules"), "spans")
    todo = durable(unseen(versions, ledger))
    n = todo.count()
    if n <= AT_ONCE:
        named = versions.select(F.sha2(text_of(), 256).alias("blob"), text_of().alias("text")).join(F.broadcast(todo), "blob") if n else todo.withColumn("text", F.lit(""))
        blobs = named.groupBy("blob").agg(F.first("text").alias("text"), F.first("rules").alias("rules"))
    else:
        blobs = blobs_of(versions).join(todo.hint("merge"), "blob")
    return scan(blobs, "rules").select("blob", "rules", "spans")


def merged(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """One ledger of both, one row for each blob."""
    return _one_row_each(ledger.select("blob", "rules", "spans").unionByName(new))


def _one_row_each(rows: DataFrame) -> DataFrame:
    rules = F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules")
    return rows.groupBy("blob").agg(rules, F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def _generation(spark: SparkSession, path: str) -> int | None:
    """The last compaction of the ledger that came to its end, or the first rows."""
    if not exists(spark, path):
        return None
    names = children(spark, path)
    done = [int(n.removeprefix("gen=")) for n in names if n.startswith("gen=") and exists(spark, f"{path}/{n}/_SUCCESS")]
    return max(done, default=None)


def ledger_at(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the ledger kept at ``path``, or none; ``found`` tells of any spans.

    A blob has one row for each time that rules were applied to it.
    """
    last = _generation(spark, path)
    return None if last is None else spark.read.schema(f"{LEDGER}, found boolean").parquet(f"{path}/gen={last}")


def _add(rows: DataFrame, path: str, generation: int) -> None:
    with setting(rows.sparkSession, CLEANUP, "true"):
        rows.withColumn("found", F.size("spans") > 0).write.mode("append").option("compression", "zstd").partitionBy("found").parquet(f"{path}/gen={generation}")


def compact(spark: SparkSession, path: str, most_files: int = 0) -> bool:
    """Rewrites a ledger of more than ``most_files`` files with one row for each blob.

    Readers see the old rows until the new ones are whole.  Rows that another
    run adds meanwhile may be lost, and their blobs are then scanned again.
    """
    last = _generation(spark, path)
    if last is None or len(ledger_at(spark, path).inputFiles()) <= most_files:
        return False
    _add(_one_row_each(ledger_at(spark, path)), path, last + 1)
    remove(spark, f"{path}/gen={last}")
    return True


def extended_at(versions: DataFrame, path: str) -> DataFrame:
    """The findings for ``versions``, once the ledger at ``path`` covers them: one
    row (blob, rules, spans) for each of their blobs that has any.

    Only pairs of blob and rule version that the ledger lacks are scanned; they
    are appended, and the ledger is compacted where it has too many files.  A
    run that ends early leaves what was there; a pair that two runs add at once
    counts once.  The result is a written table, so that joins with it split a
    hot blob; nothing else of the ledger is copied.
    """
    spark = versions.sparkSession
    ledger = ledger_at(spark, path)
    _add(extend(versions, ledger), path, _generation(spark, path) or 0)
    found = ledger_at(spark, path).where("found")
    if ledger is not None:  # of other versions, too
        found = found.join(versions.select(F.sha2(text_of(), 256).alias("blob")).distinct(), "blob", "left_semi")
    found = durable(_one_row_each(found))
    compact(spark, path, MOST_FILES)
    return found


def lasting_ledger(spark: SparkSession) -> str:
    """The ledger that the setting ``marlstone.secrets.ledger`` names, for all
    corpora, or else one of this run alone."""
    return spark.conf.get("marlstone.secrets.ledger", None) or new_path(spark, "secrets-ledger")


def findings(versions: DataFrame, ledger: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every version and the spans of its content.

    Only current rule versions count; ``ledger`` must cover the versions.  The
    join is one that splits a blob with very many paths among tasks.
    """
    live = ledger.select("blob", F.filter("spans", lambda s: s["rule"].isin(*VERSIONS.values())).alias("spans")).where(F.size("spans") > 0)
    named = versions.select(*keep, F.sha2(text_of(), 256).alias("blob"))
    none = F.array().cast(live.schema["spans"].dataType)
    return named.join(live.hint("merge"), "blob", "left").select(*keep, "blob", F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and joined positions from ``spans``."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = [counted("spans", k) for k in BASE]
    return found.select("doc_id", *count, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def masked(text: Column) -> Column:
    """The text with every secret of the base rules replaced by a mark."""
    long = ASSIGN.removesuffix("+)") + "{6,}+)"
    for pattern in (long, r"AKIA[A-Z0-9]{16,}+", BASE["hex"]):
        text = F.regexp_replace(text, pattern, MARK)
    return text


def without_spans(df: DataFrame, text: str, spans: str, name: str) -> DataFrame:
    """``df`` with ``name``: see :func:`cut_out`."""
    return df.withColumn(name, cut_out(F.col(text), F.col(spans)))


def cut_out(text: Column, spans: Column) -> Column:
    """The text with a mark for each span, null without spans.

    Spans that overlap have one mark.  A stretch lies between the furthest end
    of all spans before and the next start.  The text is cut in two steps, so
    that no stretch is looked for from the text's start.
    """
    at_once = 512
    zero = F.lit(0).cast("long")
    gap = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    part = lambda c, lo, n: c.substr((lo + 1).cast("int"), n.cast("int"))

    def cut(gaps: Column) -> Column:
        first = lambda b: F.get(gaps, b * at_once)["lo"]
        last = lambda b: F.get(gaps, F.least(b * at_once + at_once, F.size(gaps)) - 1)["hi"]
        block = lambda i: F.floor(i / at_once).cast("int")
        coarse = F.transform(F.sequence(F.lit(0), block(F.size(gaps) - 1)), lambda b: part(text, first(b), last(b) - first(b)))
        return let(coarse, lambda c: F.array_join(F.transform(gaps, lambda g, i: part(F.get(c, block(i)), g["lo"] - first(block(i)), g["hi"] - g["lo"])), MARK))

    def gaps(s: Column, ends: Column) -> Column:
        inner = F.filter(F.transform(s, lambda x, i: gap(F.get(ends, i), x["start"])), lambda g: g["lo"] <= g["hi"])
        furthest = F.array_max(F.transform(s, lambda x: x["end"]))
        return let(F.concat(inner, F.array(gap(furthest, F.length(text).cast("long")))), cut)

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    found = let(ordered, lambda s: let(before(F.transform(s, lambda x: x["end"]), zero, F.greatest), lambda ends: gaps(s, ends)))
    return F.when(F.size(spans) > 0, found)


def masked_by(docs: DataFrame, ledger: DataFrame, name: str) -> DataFrame:
    """``docs`` with ``name``: the text with a mark for each secret, null where there is none.

    All kinds of the ledger count.  In texts with a find the base rules then
    run once more over what is left: they also know a secret that follows a
    value too short to be one, which the ledger's leftmost matches pass over.
    """
    blob, spans, cut = (fresh(docs, n) for n in ("_blob", "_spans", "_cut"))
    live = ledger.select(F.col("blob").alias(blob), F.filter("spans", lambda s: s["rule"].isin(*VERSIONS.values())).alias(spans)).where(F.size(spans) > 0)
    found = docs.withColumn(blob, F.sha2(text_of(), 256)).join(live.hint("merge"), blob, "left")
    found = without_spans(found, "text", spans, cut)
    return found.withColumn(name, masked(F.col(cut))).drop(blob, spans, cut)
