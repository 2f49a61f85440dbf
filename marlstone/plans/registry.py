"""The named queries: name and values in, a result out.

A result holds the rows as a DataFrame, the corrections made to the given
values, and a message where there is nothing to show.  Rows of a query that has
a limit are taken once, so that looking whether there are any doesn't run it
twice.  Bad values raise ``InvalidParams``; nothing is swallowed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import text
from marlstone.functions.amounts import full_price_value
from marlstone.operators import finance, inventory, knowledge, leads, terms
from marlstone.plans import params as P
from marlstone.sources import dictionaries


@dataclass
class Tables:
    """What the queries read; ``leads_path`` is where new leads go."""

    spark: SparkSession
    inventory: DataFrame | None = None
    knowledge: DataFrame | None = None
    profiles: DataFrame | None = None
    leads: DataFrame | None = None
    leads_path: str | None = None
    mail_path: str | None = None
    brands: dict[str, str] = field(default_factory=lambda: dictionaries.by_form(dictionaries.BRANDS))
    models: dict[str, str] = field(default_factory=lambda: dictionaries.by_form(dictionaries.MODELS))


@dataclass
class Result:
    rows: DataFrame
    corrections: list[str] = field(default_factory=list)
    message: str | None = None
    flags: dict[str, bool] = field(default_factory=dict)
    total: int | None = None

    def documents(self) -> DataFrame:
        """``value``: one JSON document for each row."""
        return self.rows.select(text.document(*self.rows.columns).alias("value"))

    def write_json(self, folder: str) -> None:
        """The sink of any result: one JSON document a line."""
        self.documents().write.mode("append").text(folder)


def _term(t: Tables, value: str | None, column: str, forms: dict[str, str], log: list[str]) -> tuple[str | None, bool]:
    """One corrected term, and whether nothing like it is known."""
    if not value:
        return value, False
    one = t.spark.createDataFrame([(value,)], "term string")
    row = terms.corrected(one, dictionaries.dictionary(t.spark, forms), terms.candidates(t.inventory, column)).first()
    if row.was_corrected:
        log.append(f"{column}: {value} → {row.corrected}")
    return row.corrected, row.unmatched


def _price(value: float | None, name: str, log: list[str]) -> float | None:
    """An abbreviated price in full; none stays none."""
    if not value:
        return value
    full = full_price_value(value)
    if full != value:
        log.append(f"{name}: {value:g} → {full:g}")
    return full


def _once(t: Tables, rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows of a limited query as a local table, and how many there are."""
    found = rows.collect()
    return t.spark.createDataFrame(found, rows.schema), len(found)


def _suggestions(t: Tables, n: int) -> str:
    return ", ".join(r.candidate for r in terms.top_candidates(t.inventory, "marca", n).collect())


def search(t: Tables, p: P.Search) -> Result:
    log: list[str] = []
    brand, no_brand = _term(t, p.marca, "marca", t.brands, log)
    model, no_model = _term(t, p.modelo, "modelo", t.models, log)
    low, high = _price(p.precio_minimo, "precio_minimo", log), _price(p.precio_maximo, "precio_maximo", log)
    texts = {"marca": brand, "modelo": model, "carroceria": p.tipo_carroceria, "transmision": p.transmision, "combustible": p.combustible}
    items = t.inventory.where("con_oferta") if p.con_oferta else t.inventory
    at_most = {"autoano": p.ano_maximo, "precio": high} | ({"kilometraje": p.kilometraje_maximo} if p.kilometraje_maximo else {})
    found, counted = inventory.search_counted(items, texts, {"autoano": p.ano_minimo, "precio": low}, at_most, int(p.limite))
    rows, n = _once(t, found)
    message = None
    if not n:
        message = "Nothing meets these conditions; try wider ones."
        if no_brand or no_model:
            unknown = " and ".join(v for v, no in ((p.marca, no_brand), (p.modelo, no_model)) if no and v)
            message = f"Nothing is known of {unknown}; there are {_suggestions(t, 10)}."
    return Result(rows, log, message, total=counted.get["total"])


def detail(t: Tables, p: P.Detail) -> Result:
    key = F.col("id") == p.id if p.id is not None else F.col("slug") == (p.slug or None)
    rows, n = _once(t, t.inventory.where(key).limit(2).select(*inventory.detail()))
    return Result(rows if n == 1 else rows.limit(0), message=None if n == 1 else "No such item.")


def alternatives(t: Tables, p: P.Alternatives) -> Result:
    log: list[str] = []
    brand, _ = _term(t, p.marca_original, "marca", t.brands, log)
    budget = full_price_value(p.presupuesto)
    if budget != p.presupuesto:
        log.append(f"presupuesto: {p.presupuesto:g} → {budget:g}")
    rows, n = _once(t, inventory.alternatives(t.inventory, brand or "", budget, priority=p.prioridad))
    message = None if n else f"Nothing from {budget * 0.8:,.0f} to {budget * 1.2:,.0f}; there are {_suggestions(t, 8)}."
    return Result(rows, log, message)


def compare(t: Tables, p: P.Compare) -> Result:
    rows, n = _once(t, inventory.by_id(t.inventory, list(p.vehiculo_ids)).select(*inventory.comparison()))
    return Result(rows, message="Fewer than two such items." if n < 2 else None)


def statistics(t: Tables, p: P.Nothing) -> Result:
    rows, _ = _once(t, inventory.statistics(t.inventory))
    return Result(rows, message=None if rows.first().total_vehiculos else "The inventory is empty.")


def financing(t: Tables, p: P.Financing) -> Result:
    names = [f.name for f in fields(P.Financing)]
    one = t.spark.createDataFrame([tuple(float(getattr(p, n)) for n in names)], ", ".join(f"{n} double" for n in names))
    log: list[str] = []
    if full_price_value(p.precio_vehiculo) != p.precio_vehiculo:
        log.append(f"precio_vehiculo: {p.precio_vehiculo:g} → {full_price_value(p.precio_vehiculo):g}")
    return Result(finance.quotes(one, *map(F.col, names), keep=("enganche_porcentaje", "plazo_meses")), log)


def question(t: Tables, p: P.Question) -> Result:
    rows, n = _once(t, knowledge.search(t.knowledge, p.pregunta, p.categoria))
    return Result(rows, message=None if n else "Nothing was found.")


def topic(t: Tables, p: P.Topic) -> Result:
    rows = knowledge.topic(t.knowledge, p.tema)
    return Result(rows, message=f"Nothing on {p.tema}." if rows.isEmpty() else None)


def frequent(t: Tables, p: P.Frequent) -> Result:
    rows, n = _once(t, knowledge.frequent(t.knowledge, p.categoria))
    return Result(rows, message=None if n else "Nothing was found.")


def contact(t: Tables, p: P.Contact) -> Result:
    """Registers a request, unless its phone is known."""
    names = [f.name for f in fields(P.Contact)]
    one = t.spark.createDataFrame([tuple(getattr(p, n) for n in names)], ", ".join(f"{n} string" for n in names))
    rows = leads.status(one, t.profiles, t.leads)
    known = rows.first().status != "nuevo"
    if not known and t.leads_path:
        leads.append(leads.to_insert(one, t.profiles, t.leads), t.leads_path)
    return Result(rows, flags={"lead_existente": True} if known else {"datos_registrados": bool(t.leads_path)})


def mail(t: Tables, p: P.Mail) -> Result:
    """Writes a quote's message to ``mail_path``; sends nothing."""
    request = {"request_id": 1} | {f.name: getattr(p, f.name) for f in fields(P.Mail)}
    schema = "request_id int, email_destino string, nombre_cliente string, vehiculo_id long, enganche_porcentaje double, plazo_meses double"
    request |= {"enganche_porcentaje": float(p.enganche_porcentaje), "plazo_meses": float(p.plazo_meses)}
    rows = finance.payloads(t.spark.createDataFrame([tuple(request.values())], schema), t.inventory)
    found = not rows.isEmpty()
    if found and t.mail_path:
        finance.write_payloads(rows, t.mail_path)
    return Result(rows, message=None if found else "No such item.", flags={"enviado": found and bool(t.mail_path)})


@dataclass(frozen=True)
class Tool:
    name: str
    about: str
    params: type[P.Params]
    run: Callable[[Tables, Any], Result]


TOOLS = {
    t.name: t
    for t in (
        Tool("buscar_vehiculos", "Cheapest available items that match", P.Search, search),
        Tool("obtener_vehiculo", "Everything about one item, by id or slug", P.Detail, detail),
        Tool("buscar_alternativas", "Other brands around a budget", P.Alternatives, alternatives),
        Tool("comparar_vehiculos", "Two to four items side by side", P.Compare, compare),
        Tool("estadisticas_inventario", "Counts and ranges of what is available", P.Nothing, statistics),
        Tool("calcular_financiamiento", "A quote for one price", P.Financing, financing),
        Tool("buscar_informacion", "Articles for a question", P.Question, question),
        Tool("obtener_info_negocio", "Articles on a topic", P.Topic, topic),
        Tool("obtener_faqs", "Frequent questions", P.Frequent, frequent),
        Tool("solicitar_datos_contacto", "Registers a contact request once", P.Contact, contact),
        Tool("enviar_cotizacion_email", "Writes a quote's message", P.Mail, mail),
    )
}


class UnknownTool(KeyError):
    pass


def list_tools() -> list[dict[str, Any]]:
    return [{"name": t.name, "about": t.about, "params": [f.name for f in fields(t.params)]} for t in TOOLS.values()]


def call_tool(name: str, given: dict[str, Any], tables: Tables) -> Result:
    if name not in TOOLS:
        raise UnknownTool(name)
    tool = TOOLS[name]
    given = {k.replace("ñ", "n"): tuple(v) if isinstance(v, list) else v for k, v in given.items()}
    return tool.run(tables, tool.params.of(given))
