"""Inventory: search, detail, comparison, alternatives, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marlstone.functions.text import contains_ci, kilometres, link, money, money_or_null, title
from marlstone.operators.filters import available, matching

BASE_URL = "https://example.invalid/autos/"


def card(base_url: str = BASE_URL) -> list[Column]:
    """The short form of an item."""
    c = F.col
    return [
        c("id"),
        title(c("titulo"), c("marca"), c("modelo"), c("autoano")).alias("titulo"),
        c("marca"),
        c("modelo"),
        c("autoano").alias("ano"),
        money(c("precio")).alias("precio"),
        c("precio").alias("precio_numerico"),
        c("transmision"),
        c("combustible"),
        c("carroceria"),
        c("ubicacion"),
        kilometres(c("kilometraje")).alias("kilometraje"),
        c("garantia"),
        money_or_null(c("enganchemin")).alias("enganche_minimo"),
        money_or_null(c("mensualidad_minima")).alias("mensualidad_desde"),
        link(c("liga_web"), c("slug"), base_url).alias("url"),
    ]


def comparison(base_url: str = BASE_URL) -> list[Column]:
    """The short form with what a comparison needs beside it."""
    return [*card(base_url), F.col("motor"), F.col("cilindros"), F.col("kilometraje").alias("kilometraje_numerico")]


def detail(base_url: str = BASE_URL) -> list[Column]:
    """Everything about an item."""
    amounts = {"enganche_recomendado": "enganche_recomendado", "mensualidad_recomendada": "mensualidad_recomendada", "oferta": "precio_oferta"}
    return [
        *card(base_url),
        *[F.col(c) for c in ("motor", "cilindros", "descripcion")],
        *[money_or_null(F.col(c)).alias(n) for c, n in amounts.items()],
        F.col("plazomax").alias("plazo_maximo"),
        *[F.col(c) for c in ("con_oferta", "promociones", "feature_image_url", "galeria_exterior", "galeria_interior")],
    ]


def search(items: DataFrame, contains: dict[str, str | None], at_least: dict[str, float | None] | None = None, at_most: dict[str, float | None] | None = None, limit: int = 5, raw_patterns: bool = False) -> DataFrame:
    """The cheapest available items that match, in the short form.

    Equal prices stand by id, so the same items come at every run.
    """
    found = matching(available(items), contains, at_least or {}, at_most or {}, raw_patterns)
    return found.orderBy("precio", "id").limit(limit or 5).select(*card())


def search_counted(items: DataFrame, contains: dict[str, str | None], at_least: dict[str, float | None] | None = None, at_most: dict[str, float | None] | None = None, limit: int = 5, raw_patterns: bool = False) -> tuple[DataFrame, Observation]:
    """As :func:`search`, and an observation whose ``total`` is how many match.

    The count is taken in the pass that finds the cheapest: it is there once
    an action on the rows has run.
    """
    counted = Observation()
    found = matching(available(items), contains, at_least or {}, at_most or {}, raw_patterns).observe(counted, F.count(F.lit(1)).alias("total"))
    return found.orderBy("precio", "id").limit(limit or 5).select(*card()), counted


#: By what alternatives are chosen: the cheapest, or the newest.
PRIORITIES = ("precio", "año")


def alternatives(items: DataFrame, brand: str, budget: float, limit: int = 5, priority: str = "precio") -> DataFrame:
    """The cheapest, or the newest, of other brands within a fifth of the budget."""
    band = F.col("precio").between(budget * 0.8, budget * 1.2)
    first = [F.desc_nulls_last("autoano")] if priority == "año" else []
    return available(items).where(~contains_ci(F.col("marca"), brand) & band).orderBy(*first, "precio", "id").limit(limit).select(*card())


def by_id(items: DataFrame, ids: list[int]) -> DataFrame:
    return items.where(F.col("id").isin(*ids))


def lookup(items: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (request_id, id, slug) with ``item``, a struct, where just one is meant.

    A given id decides; the slug counts only where there is no id.
    """
    asked = requests.select("request_id", F.col("id").alias("_id"), F.when(F.col("id").isNull(), F.col("slug")).alias("_slug"))
    item = items.select(F.struct(*items.columns).alias("item"))
    by_id = asked.where("_id is not null").join(item, F.col("_id") == F.col("item.id"))
    by_slug = asked.where("_slug is not null").join(item, F.col("_slug") == F.col("item.slug"))
    found = by_id.union(by_slug).groupBy("request_id").agg(F.count(F.lit(1)).alias("n"), F.first("item").alias("item"))
    return requests.join(found.where("n = 1").drop("n"), "request_id", "left")


def compare_many(items: DataFrame, requests: DataFrame, least: int = 2) -> DataFrame:
    """The items of each of ``requests`` (request_id, ids), with request_id.

    A request that finds fewer than ``least`` items has no rows.
    """
    asked = requests.select("request_id", F.explode(F.array_distinct("ids")).alias("_id"))
    found = asked.join(items, F.col("_id") == F.col("id"))
    enough = found.groupBy("request_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("request_id")
    return found.join(enough, "request_id", "left_semi").drop("_id")


def _truthy(name: str) -> Column:
    return F.when(F.col(name) != 0, F.col(name))


def summary(items: DataFrame) -> DataFrame:
    """One row: how many are available, and ranges of price and year."""
    return available(items).agg(
        F.count(F.lit(1)).alias("total"),
        F.min(_truthy("precio")).alias("precio_minimo"),
        F.max(_truthy("precio")).alias("precio_maximo"),
        F.avg(_truthy("precio")).alias("precio_promedio"),
        F.min(_truthy("autoano")).alias("ano_desde"),
        F.max(_truthy("autoano")).alias("ano_hasta"),
    )


def brand_counts(items: DataFrame) -> DataFrame:
    named = available(items).where(F.col("marca") != "")
    return named.groupBy("marca").agg(F.count(F.lit(1)).alias("cantidad"))


def statistics(items: DataFrame) -> DataFrame:
    """One nested row of both: brands by count, then name."""
    counts = brand_counts(items).agg(F.array_sort(F.collect_list(F.struct((-F.col("cantidad")).alias("n"), "marca"))).alias("b"))
    brands = F.transform("b", lambda x: F.struct(x["marca"].alias("marca"), (-x["n"]).alias("cantidad")))
    prices = F.struct(money(F.col("precio_minimo")).alias("minimo"), money(F.col("precio_maximo")).alias("maximo"), money(F.col("precio_promedio")).alias("promedio"))
    years = F.struct(F.col("ano_desde").alias("desde"), F.col("ano_hasta").alias("hasta"))
    # one row each
    one = summary(items).withColumn("_one", F.lit(1)).join(counts.withColumn("_one", F.lit(1)), "_one", "left")
    return one.select(F.col("total").alias("total_vehiculos"), prices.alias("rango_precios"), years.alias("rango_anos"), brands.alias("marcas_disponibles"))
