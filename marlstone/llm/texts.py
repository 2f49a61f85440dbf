"""Distinct texts, moved once, in buckets that later joins leave in place."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm.common import CLEANUP, new_path, remove, setting

#: Bytes of text in a bucket, as long as there are no more than ``MOST_BUCKETS``.
BUCKET_BYTES, MOST_BUCKETS = 64 << 20, 8192


def buckets(spark: SparkSession, total: int) -> int:
    """How many buckets ``total`` bytes take.

    Beyond ``MOST_BUCKETS`` a bucket holds more, in several files.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-total // BUCKET_BYTES), MOST_BUCKETS))


@contextmanager
def co_located(rows: DataFrame, keys: list[str], total: int, count: int) -> Iterator[DataFrame]:
    """``rows`` as a table in buckets by ``keys``, until the block ends.

    ``total`` bytes in ``count`` rows tell how many buckets there are, and how
    many rows a file takes, so that files stay bounded however large a bucket is.
    """
    spark = rows.sparkSession
    n, usual = buckets(spark, total), int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, "texts")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    a_file = max(1, count * BUCKET_BYTES // max(1, total))
    try:
        wide = setting(spark, "spark.sql.shuffle.partitions", str(n)) if n > usual else nullcontext()
        with wide, setting(spark, CLEANUP, "true"):
            rows.write.bucketBy(n, *keys).option("path", path).option("compression", "zstd").option("maxRecordsPerFile", a_file).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, path)
