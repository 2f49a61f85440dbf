"""Delivery of messages in batches: sent, failed, tried again.

An outbox holds one row for each try of each message, in a folder for each
batch.  A batch that runs twice, as a stream may do after a failure, writes its
folder again with the same rows: earlier batches alone decide what is due.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marlstone.operators import finance
from marlstone.sources.store import exists

SCHEMA = "message_id string, request_id long, value string, intento int, enviado boolean, motivo string, batch long"
NO_ITEM = "sin_vehiculo"
#: Takes (message_id, request_id, value, intento), gives these with ``motivo``, null where it was sent.
Send = Callable[[DataFrame], DataFrame]


def messages(requests: DataFrame, items: DataFrame, **more) -> DataFrame:
    """(message_id, request_id, value) of each of ``requests``, value null without an item.

    The id is a hash of request and content, so the same request has the same
    id in any batch, and a changed one another.
    """
    found = finance.payloads(requests, items, **more).select("request_id", F.to_json("payload").alias("value"))
    asked = requests.select(F.col("request_id").cast("long").alias("request_id")).distinct()
    all_ = asked.join(found, "request_id", "left")
    return all_.select(F.sha2(F.concat_ws("|", F.col("request_id").cast("string"), F.coalesce("value", F.lit(""))), 256).alias("message_id"), "request_id", "value")


def to_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """A transport: one JSON line a message, a folder for each batch, written as a whole."""

    def put(sent: DataFrame, batch: int) -> None:
        sent.select("value").write.mode("overwrite").text(f"{folder}/batch={batch}")

    return put


class Outbox:
    """What a stream's batches go through: ``foreachBatch(Outbox(...))``.

    ``send`` tells of each message whether it can be sent now; ``put`` takes
    those that can.  A message that can't is tried again by later batches, up
    to ``tries`` times in all; one without an item is never tried again.  A
    message that is known already, sent or not, is not taken a second time.
    """

    def __init__(self, path: str, send: Send, put: Callable[[DataFrame, int], None] | None = None, tries: int = 3):
        self.path, self.send, self.put, self.tries = path, send, put, tries

    def __call__(self, new: DataFrame, batch: int) -> None:
        spark = new.sparkSession
        latest = self.latest(spark, before=batch)
        fresh = new.dropDuplicates(["message_id"]).join(latest.select("message_id"), "message_id", "left_anti")
        again = latest.where((~F.col("enviado")) & (F.col("intento") < self.tries) & F.col("value").isNotNull())
        due = fresh.select("message_id", "request_id", "value", F.lit(1).alias("intento")).union(again.select("message_id", "request_id", "value", F.col("intento") + 1))
        tried = self.send(due.where("value is not null")).select("message_id", "request_id", "value", "intento", "motivo")
        lost = due.where("value is null").select("message_id", "request_id", "value", "intento", F.lit(NO_ITEM).alias("motivo"))
        rows = tried.union(lost).select("message_id", "request_id", "value", "intento", F.col("motivo").isNull().alias("enviado"), "motivo")
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        if self.put:
            kept = spark.read.schema(T.StructType.fromDDL(SCHEMA)).option("basePath", self.path).parquet(f"{self.path}/batch={batch}")
            self.put(kept.where("enviado"), batch)

    def rows(self, spark: SparkSession) -> DataFrame:
        """Every try."""
        schema = T.StructType.fromDDL(SCHEMA)
        return spark.read.schema(schema).parquet(self.path) if exists(spark, self.path) else spark.createDataFrame([], schema)

    def latest(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The last try of each message, of batches before that number."""
        rows = self.rows(spark)
        if before is not None:
            rows = rows.where(F.col("batch") < before)  # prunes folders
        last = rows.groupBy("message_id").agg(F.max(F.struct("intento", "batch", "request_id", "value", "enviado", "motivo")).alias("r"))
        return last.select("message_id", "r.*")


def start(new: DataFrame, outbox: Outbox, checkpoint: str) -> StreamingQuery:
    """Takes what is there now through the outbox, and ends."""
    return new.writeStream.foreachBatch(outbox).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
