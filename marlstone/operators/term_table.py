"""The distinct terms of a column, kept fresh from what is appended or deleted.

A table of counts by term, one version for each batch: a version is the one
before and the batch's changes, summed; terms that come to nothing go.  A batch
that runs twice writes the same version again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marlstone.sources.store import children, exists, remove

#: Versions that stay, for readers that are still at an earlier one.
KEPT = 2


class NegativeCount(ValueError):
    pass


def _version(path: str, n: int) -> str:
    return f"{path}/version={n}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that are whole, in order."""
    names = children(spark, path) if exists(spark, path) else []
    found = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return [n for n in found if exists(spark, f"{_version(path, n)}/_SUCCESS")]


def fold(changes: DataFrame, path: str, batch: int) -> None:
    """Writes version ``batch``: the latest earlier one and ``changes`` (term, n).

    ``n`` is 1 for a row that came and -1 for one that went; null terms don't
    count.  More deletions of a term than there were rows are an error, and
    leave the table as it was.
    """
    spark = changes.sparkSession
    before = [n for n in versions(spark, path) if n < batch]
    rows = changes.where("term is not null").groupBy("term").agg(F.sum("n").alias("n"))
    if before:
        rows = rows.unionByName(spark.read.parquet(_version(path, before[-1])))
    summed = rows.groupBy("term").agg(F.sum("n").cast("long").alias("n"))
    checked = F.when(F.col("n") < 0, F.raise_error(F.concat(F.lit("more deletions than rows of "), F.col("term"))).cast("long")).otherwise(F.col("n"))
    summed.select("term", checked.alias("n")).where("n > 0").write.mode("overwrite").parquet(_version(path, batch))
    for old in [n for n in before if n < batch - KEPT]:
        remove(spark, _version(path, old))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(term, n) of the latest version."""
    found = versions(spark, path)
    return spark.read.parquet(_version(path, found[-1])) if found else spark.createDataFrame([], "term string, n long")


def start(rows: DataFrame, term: Column, n: Column, path: str, checkpoint: str) -> StreamingQuery:
    """Folds in what a stream of files has that its checkpoint doesn't know, and ends.

    Files of earlier runs are not read again.
    """
    changes = rows.select(term.alias("term"), n.cast("long").alias("n"))
    return changes.writeStream.foreachBatch(lambda batch, number: fold(batch, path, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
