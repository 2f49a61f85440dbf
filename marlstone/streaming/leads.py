"""Contact requests as a stream: first of each phone, unless known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_leads(requests: DataFrame, profiles: DataFrame, leads: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """``requests`` (telefono, created_at, ...) without repeats, profiles or open leads.

    Repeats within ``lateness`` of the first are dropped; state older than that
    goes, so it stays bounded.  A request without a phone is never known.
    ``leads`` is a static table, read again by each batch.
    """
    marked = requests.withWatermark("created_at", lateness)
    once = marked.where("telefono is not null").dropDuplicatesWithinWatermark(["telefono"])
    phones = profiles.select(F.col("phone").alias("telefono")).union(leads.where(~F.col("atendido")).select("telefono"))
    known = phones.where("telefono is not null").distinct()
    return once.join(known, "telefono", "left_anti").unionByName(marked.where("telefono is null"))


def start(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to Parquet what is there now, exactly once, and ends."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
