"""Contact requests: known, open or new, and the rows to insert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.text import blank_to_null


def newest_first() -> list[Column]:
    return [F.desc_nulls_first("created_at"), F.asc("id")]


def latest_open(leads: DataFrame) -> DataFrame:
    """The newest lead of each phone that nobody has answered."""
    w = Window.partitionBy("telefono").orderBy(*newest_first())
    live = leads.where(~F.col("atendido")).withColumn("_n", F.row_number().over(w))
    return live.where("_n = 1").select("telefono", "id", "nombre", "created_at")


def _phones(df: DataFrame, column: str, flag: str) -> DataFrame:
    return df.select(F.col(column).alias("telefono")).where("telefono is not null").distinct().withColumn(flag, F.lit(True))


def status(requests: DataFrame, profiles: DataFrame, leads: DataFrame) -> DataFrame:
    """``requests`` with status: perfil, lead_abierto or nuevo."""
    known = requests.join(_phones(profiles, "phone", "_p"), "telefono", "left").join(_phones(leads.where(~F.col("atendido")), "telefono", "_l"), "telefono", "left")
    state = F.when(F.col("_p"), "perfil").when(F.col("_l"), "lead_abierto").otherwise("nuevo")
    return known.select(*requests.columns, state.alias("status"))


def to_insert(requests: DataFrame, profiles: DataFrame, leads: DataFrame) -> DataFrame:
    """One row for each phone that is neither a profile nor an open lead.

    Of several requests of a phone the first by name, then e-mail, is taken; a
    request without a phone is never known, and each is inserted.
    """
    new = requests.join(_phones(profiles, "phone", "_p"), "telefono", "left_anti").join(_phones(leads.where(~F.col("atendido")), "telefono", "_l"), "telefono", "left_anti")
    rest = [c for c in ("nombre", "email", "vehiculo_interes", "comentarios")]
    first = new.where("telefono is not null").groupBy("telefono").agg(F.min(F.struct(*rest)).alias("r")).select("telefono", "r.*")
    rows = first.unionByName(new.where("telefono is null").select("telefono", *rest))
    return rows.select("nombre", "telefono", *[blank_to_null(F.col(c)).alias(c) for c in rest[1:]], F.lit("chat_widget").alias("source"))


def append(rows: DataFrame, path: str) -> None:
    """Adds rows as open leads. One writer at a time: files have no locks."""
    full = rows.select(F.uuid().alias("id"), *rows.columns, F.lit(False).alias("atendido"), F.current_timestamp().alias("created_at"))
    full.write.mode("append").parquet(path)
