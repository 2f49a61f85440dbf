"""Contact requests as a stream whose own leads count: state by phone.

A phone is unknown, then open (a request has made a lead), then answered, and
after a time forgotten.  The state of a phone is one small row; a timer of event
time drops it, so that state follows the phones of the last ``forget`` only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: What the state store must be for such streams; see :func:`start`.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SCHEMA = "telefono string, id string, created_at timestamp, status string"


class Intake(StatefulProcessor):
    """Rows (telefono, id, created_at, answered) of one phone, in order of time.

    A request is ``nuevo`` where no lead of the phone is open, else
    ``lead_abierto``; an answer closes the open lead and is ``respondido``, or
    ``sin_lead`` where there is none.  A state not touched for ``forget`` is
    taken as gone, whether its timer has rung yet or not, so results don't
    depend on how rows fall into batches.  A row without a time is the earliest.
    """

    def __init__(self, forget_ms: int):
        self.forget = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("lead", "open boolean, touched long, rings long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows), ignore_index=True).sort_values(["created_at", "id"], kind="stable", na_position="first")
        is_open, touched, rings = self.state.get() if self.state.exists() else (False, None, None)
        status = []
        times = found.created_at.fillna(pd.Timestamp(0)).astype("datetime64[ms]").astype("int64")
        for at, answered in zip(times.tolist(), found.answered.tolist()):
            if touched is not None and at - touched >= self.forget:
                is_open = False
            if answered:
                status.append("respondido" if is_open else "sin_lead")
                is_open = False
            else:
                status.append("lead_abierto" if is_open else "nuevo")
                is_open = True
            touched = at if touched is None else max(at, touched)
        if rings is not None:
            self.handle.deleteTimer(rings)
        rings = touched + self.forget
        self.handle.registerTimer(rings)
        self.state.update((is_open, touched, rings))
        yield pd.DataFrame({"telefono": key[0], "id": found.id.to_numpy(), "created_at": found.created_at.to_numpy(), "status": status})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def judged(requests: DataFrame, profiles: DataFrame, leads: DataFrame, forget_ms: int = 30 * 86_400_000, lateness: str = "1 hour") -> DataFrame:
    """``requests`` (telefono, id, created_at, answered) with ``status``.

    Profiles (phone) and the open ones of ``leads`` are static tables, read
    again by each batch: their phones are ``perfil`` and ``lead_abierto`` and
    never reach the state.  A request without a phone is always ``nuevo``.
    Rows of one phone in one batch are held by one task.
    """
    rows = requests.select("telefono", F.col("id").cast("string").alias("id"), F.col("created_at").cast("timestamp").alias("created_at"), F.coalesce("answered", F.lit(False)).alias("answered")).withWatermark("created_at", lateness)
    people = profiles.where("phone is not null").select(F.col("phone").alias("telefono"), F.lit("perfil").alias("_known"))
    waiting = leads.where(~F.col("atendido") & F.col("telefono").isNotNull()).select("telefono", F.lit("lead_abierto").alias("_known"))
    known = people.union(waiting).groupBy("telefono").agg(F.max("_known").alias("_known"))  # perfil goes before
    joined = rows.join(known, "telefono", "left")
    kept = joined.where("_known is null and telefono is not null").select("telefono", "id", "created_at", "answered")
    told = kept.groupBy("telefono").transformWithStateInPandas(Intake(forget_ms), SCHEMA, outputMode="Append", timeMode="EventTime")
    rest = joined.where("_known is not null or telefono is null")
    return told.unionByName(rest.select("telefono", "id", "created_at", F.coalesce("_known", F.when(F.col("answered"), "sin_lead").otherwise("nuevo")).alias("status")))


def start(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to Parquet what is there now, exactly once, and ends.

    The state store is set for this query alone; the session gets its own back.
    """
    conf, name = rows.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, STORE)
    try:
        return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        conf.set(name, before)
