"""Quotes for one price or a whole table, and their payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.amounts import full_price, half_up, quote
from marlstone.functions.text import link, money, percent, title
from marlstone.operators.inventory import BASE_URL


def quotes(df: DataFrame, price: Column, down_percent: Column, months: Column, rate: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, unrounded parts and shown amounts of each quote."""
    full = full_price(price)
    parts = quote(full, down_percent, months, rate)
    shown = {"down_payment": "enganche", "financed": "monto_a_financiar", "monthly": "mensualidad_estimada", "total": "total_a_pagar", "cost": "costo_financiamiento"}
    text = [money(parts[k] if k in ("down_payment", "financed") else half_up(parts[k])).alias(n) for k, n in shown.items()]
    return df.select(*keep, money(full).alias("precio_vehiculo"), *[c.alias(n) for n, c in parts.items()], *text, percent(rate).alias("tasa_anual"))


def payloads(requests: DataFrame, items: DataFrame, rate: float = 15.0, base_url: str = BASE_URL) -> DataFrame:
    """A nested message for each of ``requests`` that names one item.

    ``requests``: request_id, email_destino, nombre_cliente, vehiculo_id,
    enganche_porcentaje, plazo_meses.  An id that several items have, or none,
    gives no message.
    """
    item = items.select("id", "titulo", "marca", "modelo", "autoano", "precio", "liga_web", "slug")
    wanted = requests.select(F.col("vehiculo_id").alias("id")).distinct()
    known = item.join(wanted, "id", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*item.columns)).alias("item")).where("n = 1")
    joined = requests.join(known.select("id", "item"), F.col("vehiculo_id") == F.col("id"))
    c = lambda name: F.col(f"item.{name}")
    name = title(c("titulo"), c("marca"), c("modelo"), c("autoano"))
    parts = quote(c("precio"), F.col("enganche_porcentaje"), F.col("plazo_meses"), F.lit(rate))
    vehicle = F.struct(name.alias("titulo"), c("marca").alias("marca"), c("modelo").alias("modelo"), c("autoano").alias("ano"), money(c("precio")).alias("precio"), F.coalesce(link(c("liga_web"), c("slug"), base_url), F.lit("")).alias("url"))
    finance = F.struct(
        F.col("enganche_porcentaje"),
        money(parts["down_payment"]).alias("enganche"),
        money(parts["financed"]).alias("monto_a_financiar"),
        percent(F.lit(rate)).alias("tasa_anual"),
        F.col("plazo_meses"),
        money(half_up(parts["monthly"])).alias("mensualidad_estimada"),
    )
    data = F.struct(F.col("nombre_cliente"), vehicle.alias("vehiculo"), finance.alias("financiamiento"))
    return joined.select("request_id", F.struct(F.col("email_destino").alias("to"), F.concat(F.lit("Cotización: "), name).alias("subject"), F.lit("cotizacion").alias("type"), data.alias("data")).alias("payload"))


def write_payloads(messages: DataFrame, folder: str) -> None:
    """The sink: one JSON document a line. Nothing is sent from here."""
    messages.select(F.to_json("payload").alias("value")).write.mode("append").text(folder)
