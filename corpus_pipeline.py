"""A corpus pipeline: five stages, each by one operator, over whole tables.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import mixing, near_dup, packing, quality, secrets
from marlstone.llm.common import fresh, new_path, owned, remove, table

#: Documents below this quality go.
LEAST_QUALITY = 0.3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    The classifier learns from the labelled rows of the ``documents`` table.
    """
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    score = fresh(docs, "_quality")
    return quality.score(docs, model, keep=tuple(docs.columns), name=score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group that links join."""
    document = uid, text_key = fresh(docs, "_uid"), fresh(docs, "_text_key")
    groups = near_dup.near_duplicates(docs).where("uid = group_id and text_key = group_key").select(F.col("uid").alias(uid), F.col("text_key").alias(text_key)).distinct()
    named = docs.withColumn(uid, near_dup.identity()).withColumn(text_key, near_dup.text_key())
    return named.join(groups, list(document), "left_semi").dropDuplicates(list(document)).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, whatever any rule finds in them replaced by a mark."""
    ledger = secrets.extended_at(docs, secrets.lasting_ledger(spark))
    masked = fresh(docs, "_masked")
    named = secrets.masked_by(docs, ledger, masked)
    hit = F.col(masked).isNotNull()
    changed = {"text": F.coalesce(masked, "text"), "n_chars": F.when(hit, F.length(masked).cast("long")).otherwise(F.col("n_chars"))}
    return named.select(*[changed[c].alias(c) if c in changed else c for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.repeated(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    return packing.pack(docs).drop("cluster")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_bins),
]

#: The classifier has no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.

    Each stage's result is kept in the shared folder until the next one is
    written, and what a stage itself writes there goes as it ends; the last
    result goes as Python ends.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"pipeline-{number}")
        with owned(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
