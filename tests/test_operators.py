import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import filters, finance, inventory, knowledge, leads, messages, terms
from marlstone.plans import params as P
from marlstone.plans.registry import TOOLS, Tables, UnknownTool, call_tool, list_tools
from marlstone.sources import dictionaries, schemas
from marlstone.streaming import leads as stream


def item(id, marca="Toyota", precio=300000.0, on=True, kept=False, **more):
    row = {f.name: None for f in schemas.INVENTORY}
    return row | {"id": id, "marca": marca, "modelo": "Corolla", "autoano": 2020, "precio": precio, "exhibicion_inventario": on, "separado": kept} | more


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        item(1), item(2, precio=250000.0, slug="dos", enganchemin=2.5), item(3, precio=250000.0, marca="Honda", enganchemin=0.0),
        item(4, on=False), item(5, kept=True), item(6, on=None), item(7, kept=None), item(8, precio=None),
        item(9, marca=None, precio=0.0, autoano=0), item(10, marca="Mazda", precio=360000.0, slug="dup"), item(11, marca="KIA", precio=360001.0, slug="dup"),
        item(12, marca="", precio=400000.0, liga_web="http://x", titulo="Uno"),
    ]
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.INVENTORY) for r in rows], schemas.INVENTORY)


@pytest.fixture(scope="module")
def tables(spark, items):
    when = dt.datetime(2024, 1, 1)
    know = [(1, "faq", "Pago", "con tarjeta", None, None, True), (2, "faq", "Plazo", "meses", None, 3, True), (3, "faq", "Plazo 2", "meses", None, 3, True), (4, "faq", "No", "tarjeta", None, 9, False), (5, "politica", "Devolución", "x", None, 1, True)]
    lead = [("a", "n", "1", None, None, None, "s", False, when), ("b", "n", "1", None, None, None, "s", False, when + dt.timedelta(1)), ("c", "n", "2", None, None, None, "s", True, when)]
    return Tables(
        spark,
        items,
        spark.createDataFrame(know, schemas.KNOWLEDGE),
        spark.createDataFrame([("p", "Ana", None, None, "9")], schemas.PROFILES),
        spark.createDataFrame(lead, schemas.LEADS),
    )


def ids(df):
    return [r.id for r in df.collect()]


def test_available_follows_three_valued_logic(items):
    assert sorted(ids(filters.available(items))) == [1, 2, 3, 9, 10, 11, 12]


def test_search_orders_by_price_then_id(items):
    assert ids(inventory.search(items, {}, {"precio": 1.0})) == [2, 3, 1, 10, 11]
    assert ids(inventory.search(items, {"marca": "o"}, {"precio": 1}, {"precio": 300000.0}, 0)) == [2, 3, 1]


def test_card_shows_falsy_amounts_as_null(items):
    rows = {r.id: r for r in items.select(*inventory.detail()).collect()}
    assert rows[2].enganche_minimo == "$3" and rows[3].enganche_minimo is None and rows[8].precio is None
    assert rows[12].titulo == "Uno" and rows[12].url == "http://x" and rows[2].url.endswith("/dos")


def test_alternatives_leave_out_brand_and_null_brand(items):
    assert ids(inventory.alternatives(items, "toyota", 300000.0)) == [3, 10]


def test_statistics_drop_falsy(items):
    r = inventory.statistics(items).first()
    assert r.total_vehiculos == 7 and r.rango_precios.minimo == "$250,000" and r.rango_anos.desde == 2020
    assert [(b.marca, b.cantidad) for b in r.marcas_disponibles] == [("Toyota", 2), ("Honda", 1), ("KIA", 1), ("Mazda", 1)]
    assert inventory.summary(items.limit(0)).first().precio_minimo is None


def test_single_row_guard(items):
    assert sorted(ids(filters.single(items, F.col("slug")))) == [2]


def test_cascade(spark):
    found = spark.createDataFrame([("Toyota",), ("Honda",), ("JAC",), ("Kia",)], "candidate string")
    known = spark.createDataFrame([("toyota", "Toyota"), ("vw", "Volkswagen")], "term string, canonical string")
    rows = spark.createDataFrame([(t,) for t in ("toyota", " VW ", "honda", "hoda", "ram", "nothing", "", None, " hoda")], "term string")
    got = {r.term: (r.corrected, r.was_corrected, r.unmatched) for r in terms.corrected(rows, known, found).collect()}
    assert got["toyota"] == ("Toyota", True, False) and got[" VW "] == ("Volkswagen", True, False)
    assert got["honda"] == ("Honda", False, False) and got["hoda"] == ("Honda", True, False)
    assert got["ram"] == ("JAC", True, False) and got["nothing"] == ("nothing", False, True)
    assert got[None] == (None, False, True) and got[" hoda"] == ("Honda", True, False)


def test_nearest_equals_brute_force(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abñ") for _ in range(rng.randint(0, 7))) for _ in range(120)})
    asked, found = words[::2], words[1::2]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    got = {r.term: (r.distance, r.from_near) for r in terms.nearest(spark.createDataFrame([(w,) for w in asked], "term string"), spark.createDataFrame([(w,) for w in found], "candidate string")).collect()}
    for w in asked:
        best = min((distance(w, c), c) for c in found)
        assert got[w] == (best if best[0] <= 2 else (None, None)), w


def test_knowledge(tables):
    k = tables.knowledge
    assert ids(knowledge.search(k, "pago con TARJETA meses", "faq")) == [1, 2, 3]
    assert ids(knowledge.search(k, "a b")) == [1, 2, 3, 5]
    assert ids(knowledge.topic(k, "devoluciones")) == []
    assert ids(knowledge.frequent(k, "plazo")) == [] and ids(knowledge.frequent(k, "MES")) == [2, 3]


def test_search_many_equals_search(spark, tables):
    asked = ["pago con TARJETA meses", "plazo", "nada", "a b c", "", "x" * 3000 + " tarjeta"]
    got = knowledge.search_many(tables.knowledge, spark.createDataFrame(list(enumerate(asked)), "question_id int, question string")).collect()
    for i, q in enumerate(asked):
        expected = ids(knowledge.search(tables.knowledge, q))
        assert [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.question_id == i] == expected


def test_leads(spark, tables, tmp_path):
    asked = spark.createDataFrame([("x", "9", "", None, None), ("x", "1", "", None, None), ("b", "2", "", None, None), ("a", "2", "e", None, None), ("n", None, None, None, None)], "nombre string, telefono string, email string, vehiculo_interes string, comentarios string")
    state = {(r.nombre, r.telefono): r.status for r in leads.status(asked, tables.profiles, tables.leads).collect()}
    assert state == {("x", "9"): "perfil", ("x", "1"): "lead_abierto", ("b", "2"): "nuevo", ("a", "2"): "nuevo", ("n", None): "nuevo"}
    new = leads.to_insert(asked, tables.profiles, tables.leads)
    assert sorted((r.nombre, r.email) for r in new.collect()) == [("a", "e"), ("n", None)]
    leads.append(new, str(tmp_path / "l"))
    added = spark.read.parquet(str(tmp_path / "l"))
    again = leads.to_insert(asked.where("telefono is not null"), tables.profiles, tables.leads.unionByName(added.select(tables.leads.columns)))
    assert again.count() == 0
    assert [(r.telefono, r.id) for r in leads.latest_open(tables.leads).collect()] == [("1", "b")]


def test_stream_of_leads(spark, tables, tmp_path):
    schema = "nombre string, telefono string, created_at timestamp"
    when = dt.datetime(2024, 1, 1)
    rows = [("a", "5"), ("b", "5"), ("c", "9"), ("d", "6"), ("e", "1"), ("f", "2"), ("g", None), ("h", None)]
    spark.createDataFrame([(*r, when) for r in rows], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    rows = stream.new_leads(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), tables.profiles, tables.leads)
    stream.start(rows, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.telefono or "" for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["", "", "2", "5", "6"]


def test_lookup_prefers_the_id(spark, items):
    asked = spark.createDataFrame([(1, 2, "zzz"), (2, None, "dos"), (3, None, "dup"), (4, 99, "dos"), (5, None, None), (6, None, "")], "request_id int, id long, slug string")
    got = {r.request_id: r["item"] and r["item"].id for r in inventory.lookup(items, asked).collect()}
    assert got == {1: 2, 2: 2, 3: None, 4: None, 5: None, 6: None}


def test_comparison_needs_two_items(spark, items):
    asked = spark.createDataFrame([(1, [1, 1]), (2, [1, 4, 99]), (3, []), (4, None), (5, [98, 99])], "request_id int, ids array<long>")
    assert sorted((r.request_id, r.id) for r in inventory.compare_many(items, asked).collect()) == [(2, 1), (2, 4)]


def test_results_as_json(spark, tables, tmp_path):
    import json

    found = call_tool("buscar_vehiculos", {"marca": "honda"}, tables)
    found.write_json(str(tmp_path / "j"))
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert [r["id"] for r in rows] == [3] and rows[0]["enganche_minimo"] is None


def test_words_of_any_length(spark):
    long = "q" * 200_000 + "needle" + "z" * 200_000
    articles = spark.createDataFrame([(1, "c", "t", long, None, 1, True), (2, "c", None, None, None, 2, True)], schemas.KNOWLEDGE)
    asked = spark.createDataFrame([(1, "needle"), (2, "absent")], "question_id int, question string")
    assert [(r.question_id, r.id) for r in knowledge.search_many(articles, asked).collect()] == [(1, 1)]


def test_payloads_need_one_item(spark, items):
    twice = items.union(items.where("id = 1"))
    asked = spark.createDataFrame([(1, "e", "n", 1, 20.0, 48), (2, "e", "n", 2, 20.0, 48), (3, "e", "n", 99, 20.0, 48)], "request_id int, email_destino string, nombre_cliente string, vehiculo_id long, enganche_porcentaje double, plazo_meses int")
    got = finance.payloads(asked, twice).collect()
    assert [r.request_id for r in got] == [2] and got[0].payload.data.financiamiento.tasa_anual == "15%"


def test_tools(tables, tmp_path):
    assert len(list_tools()) == len(TOOLS) == 11
    r = call_tool("buscar_vehiculos", {"marca": "toyoda", "precio_maximo": 300, "año_minimo": 2000}, tables)
    assert ids(r.rows) == [2, 1] and r.corrections == ["marca: toyoda → Toyota", "precio_maximo: 300 → 300000"]
    assert call_tool("buscar_vehiculos", {"marca": "zzzzzzz"}, tables).message.startswith("Nothing is known of zzzzzzz")
    assert ids(call_tool("obtener_vehiculo", {"slug": "dos"}, tables).rows) == [2]
    assert call_tool("obtener_vehiculo", {"slug": "dup"}, tables).message and call_tool("obtener_vehiculo", {"slug": ""}, tables).message
    assert ids(call_tool("buscar_alternativas", {"marca_original": "toyota", "presupuesto": 300}, tables).rows) == [3, 10]
    assert call_tool("comparar_vehiculos", {"vehiculo_ids": [1, 1]}, tables).message
    assert sorted(ids(call_tool("comparar_vehiculos", {"vehiculo_ids": [1, 4]}, tables).rows)) == [1, 4]
    assert call_tool("estadisticas_inventario", {}, tables).rows.first().total_vehiculos == 7
    assert call_tool("calcular_financiamiento", {"precio_vehiculo": 10, "enganche_porcentaje": 0}, tables).rows.first().mensualidad_estimada == "$278"
    assert ids(call_tool("buscar_informacion", {"pregunta": "tarjeta", "categoria": "faq"}, tables).rows) == [1]
    assert call_tool("obtener_info_negocio", {"tema": "horarios"}, tables).message
    assert ids(call_tool("obtener_faqs", {}, tables).rows) == [1, 2, 3]
    assert call_tool("solicitar_datos_contacto", {"nombre": "x", "telefono": "1"}, tables).flags == {"lead_existente": True}
    from dataclasses import replace

    writing = replace(tables, leads_path=str(tmp_path / "leads"), mail_path=str(tmp_path / "mail"))
    assert call_tool("solicitar_datos_contacto", {"nombre": "x", "telefono": "77"}, writing).flags == {"datos_registrados": True}
    assert call_tool("enviar_cotizacion_email", {"email_destino": "e", "nombre_cliente": "n", "vehiculo_id": 2}, writing).flags == {"enviado": True}
    assert not call_tool("enviar_cotizacion_email", {"email_destino": "e", "nombre_cliente": "n", "vehiculo_id": 99}, writing).flags["enviado"]


def test_bad_values_raise(tables):
    for name, given in (("obtener_vehiculo", {}), ("comparar_vehiculos", {"vehiculo_ids": [1]}), ("comparar_vehiculos", {"vehiculo_ids": [1, 2, 3, 4, 5]}), ("obtener_info_negocio", {"tema": "x"}), ("buscar_informacion", {"pregunta": "x", "categoria": "y"}), ("buscar_vehiculos", {"precio_minimo": "x"}), ("calcular_financiamiento", {})):
        with pytest.raises(P.InvalidParams):
            call_tool(name, given, tables)
    with pytest.raises(UnknownTool):
        call_tool("x", {}, tables)


def test_missing_columns_raise(spark):
    with pytest.raises(schemas.MissingColumns):
        schemas.checked(spark.range(1), schemas.PROFILES)


def test_messages_of_many_searches_equal_those_of_each(spark, tables):
    asked = [
        {"marca": "toyoda", "precio_maximo": 300.0}, {"marca": "toyota", "precio_minimo": 300001.0}, {"marca": "zzzzzzz"}, {"marca": "oyo"}, {"marca": "o", "precio_minimo": 260.0, "precio_maximo": 299.0}, {"marca": "yz", "precio_minimo": 5.0},
        {}, {"marca": ""}, {"precio_minimo": 400001.0}, {"precio_minimo": 0.0, "precio_maximo": 0.0}, {"precio_minimo": 360000.0, "precio_maximo": 360000.0}, {"marca": "KIA", "precio_maximo": 360000.0}, {"marca": " mazda "}, {"precio_maximo": -5.0},
    ]
    rows = [(i, a.get("marca"), a.get("precio_minimo"), a.get("precio_maximo")) for i, a in enumerate(asked)]
    told = messages.search(spark.createDataFrame(rows, "request_id int, marca string, precio_minimo double, precio_maximo double"), tables.inventory, dictionaries.dictionary(spark, tables.brands))
    got = {r.request_id: r for r in told.collect()}
    single = [call_tool("buscar_vehiculos", a, tables) for a in asked]
    assert [got[i].message for i in range(len(asked))] == [r.message for r in single]
    assert [len(got[i].corrections) for i in range(len(asked))] == [len(r.corrections) for r in single]
    assert len({r.message for r in single}) == 3
    assert single[0].total == 2 and single[2].total == 0  # how many match, beside the rows
