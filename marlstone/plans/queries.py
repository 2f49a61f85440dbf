"""Registered queries over the star schema, one or more for each operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import amounts, text
from marlstone.operators import applications, filters, finance, history, inventory, knowledge, layout, leads, messages, people, search_index, term_table, terms
from marlstone.sources import dictionaries, tables
from marlstone.sources.store import new_folder
from marlstone.streaming import intake, outbox

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Misspelt market segments, as a dictionary of terms.
SEGMENTS = {"autos": "AUTOMOBILE", "automovil": "AUTOMOBILE", "casa": "HOUSEHOLD", "maquina": "MACHINERY", "obra": "BUILDING"}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def inventory_search(spark, d):
    return inventory.search(tables.inventory(spark, d), {"marca": "machin"}, {"precio": 50000.0})


@query
def inventory_search_all_filters(spark, d):
    texts = {"marca": "build", "modelo": "urgent", "carroceria": "1-", "transmision": "o", "combustible": "ING"}
    return inventory.search(tables.inventory(spark, d), texts, {"autoano": 1996, "precio": 2000.0}, {"autoano": 2000, "precio": 400000.0}, 20)


@query
def inventory_search_literal_wildcards(spark, d):
    return inventory.search(tables.inventory(spark, d), {"modelo": "4_NOT%"}, {}, {}, 10)


@query
def inventory_search_literal_found(spark, d):
    """A term whose wildcards are in the items themselves."""
    items = tables.inventory(spark, d).withColumn("modelo", F.when(F.col("id") % 50 == 0, F.concat("modelo", F.lit("_5%"))).otherwise(F.col("modelo")))
    return inventory.search(items, {"modelo": "d_5%"}, {}, {}, 10)


@query
def inventory_search_truthiness(spark, d):
    return inventory.search(tables.inventory(spark, d), {"marca": "", "modelo": None}, {"precio": 0}, {"autoano": 0}, 0)


@query
def inventory_search_total(spark, d):
    """The cheapest five, and how many match, from one pass over the items."""
    rows, counted = inventory.search_counted(tables.inventory(spark, d), {"marca": "build"}, {"precio": 2000.0}, {"autoano": 1997})
    found = rows.select("id", "titulo", "precio").collect()  # five rows
    return spark.createDataFrame([(*r, counted.get["total"]) for r in found], "id long, titulo string, precio string, total long")


@query
def base_filter(spark, d):
    return filters.available(tables.inventory(spark, d)).select("id", "marca", "precio")


@query
def inventory_detail(spark, d):
    full = tables.inventory(spark, d).select(*inventory.detail())
    return full.withColumns({c: F.array_join(c, "|") for c in ("promociones", "galeria_exterior", "galeria_interior")})


@query
def single_row_guard(spark, d):
    items = tables.inventory(spark, d)
    return filters.single(items, F.concat_ws("/", "modelo", F.col("precio").cast("long").cast("string"))).select("id", "modelo")


@query
def compare_in_list(spark, d):
    return inventory.by_id(tables.inventory(spark, d), [7, 3, 3, 12]).select(*inventory.comparison())


@query
def compare_at_least_two(spark, d):
    """Every customer compares three items, of which one or more may be missing."""
    k = F.col("c_custkey")
    asked = tables.read(spark, d, "customer").select(k.alias("request_id"), F.array(k, k * 7, k * 1000, k).alias("ids"))
    return inventory.compare_many(tables.inventory(spark, d), asked).select("request_id", *inventory.comparison())


@query
def detail_id_before_slug(spark, d):
    """Every customer asks by id, by slug, by both or by neither."""
    k = F.col("c_custkey")
    asked = tables.read(spark, d, "customer").select(k.alias("request_id"), F.when(k % 4 < 2, k).alias("id"), F.when(k % 2 == 0, F.concat(F.lit("o-"), (k * 2).cast("string"))).alias("slug"))
    found = inventory.lookup(tables.inventory(spark, d), asked)
    c = lambda n: F.col(f"item.{n}")
    return found.select("request_id", c("id").alias("item_id"), F.when(F.col("item").isNotNull(), text.title(c("titulo"), c("marca"), c("modelo"), c("autoano"))).alias("titulo"), text.money(c("precio")).alias("precio"))


@query
def inventory_search_json(spark, d):
    rows = inventory.search(tables.inventory(spark, d), {"marca": "build"}, {"precio": 50000.0}, {}, 50)
    return rows.select(text.document("id", "titulo", "marca", "modelo", "ano", "precio", "kilometraje", "garantia", "enganche_minimo", "url").alias("value"))


@query
def alternatives_band(spark, d):
    return inventory.alternatives(tables.inventory(spark, d), "auto", 300000.0)


@query
def inventory_stats_summary(spark, d):
    return inventory.summary(tables.inventory(spark, d))


@query
def inventory_brand_counts(spark, d):
    return inventory.brand_counts(tables.inventory(spark, d))


@query
def inventory_stats_nested(spark, d):
    """The nested row with its brands, in their order, as rows of their own."""
    one = inventory.statistics(tables.inventory(spark, d))
    flat = one.select("total_vehiculos", F.col("rango_precios.minimo").alias("minimo"), F.col("rango_precios.maximo").alias("maximo"), F.col("rango_precios.promedio").alias("promedio"), F.col("rango_anos.desde").alias("desde"), F.col("rango_anos.hasta").alias("hasta"), F.posexplode("marcas_disponibles").alias("posicion", "b"))
    return flat.select(*flat.columns[:-1], F.col("b.marca").alias("marca"), F.col("b.cantidad").alias("cantidad"))


@query
def distinct_terms(spark, d):
    return terms.candidates(tables.read(spark, d, "part"), "p_brand")


@query
def suggest_terms_topn(spark, d):
    return terms.top_candidates(tables.read(spark, d, "part"), "p_name", 10)


@query
def amount_normalize_price(spark, d):
    p = tables.read(spark, d, "part")
    return p.select("p_partkey", amounts.price_detail(F.col("p_retailprice")).alias("a")).select("p_partkey", "a.*")


@query
def amount_normalize_down(spark, d):
    line = tables.read(spark, d, "lineitem")
    v = F.col("l_quantity") * 25
    return line.select(v.alias("given"), amounts.down_payment_detail(v).alias("a")).select("given", "a.*").distinct()


@query
def money_format(spark, d):
    return tables.read(spark, d, "customer").select("c_custkey", text.money(F.col("c_acctbal")).alias("shown"), text.money_or_null(F.col("c_acctbal") - F.col("c_acctbal")).alias("zero"))


@query
def km_format(spark, d):
    return tables.inventory(spark, d).select("id", text.kilometres(F.col("kilometraje")).alias("shown"))


@query
def title_fallback(spark, d):
    c = F.col
    return tables.inventory(spark, d).select("id", text.title(c("titulo"), c("marca"), c("modelo"), c("autoano")).alias("shown"))


@query
def url_fallback(spark, d):
    return tables.inventory(spark, d).select("id", text.link(F.col("liga_web"), F.col("slug"), inventory.BASE_URL).alias("shown"))


def _quotes(spark, d, months, rate):
    orders = tables.read(spark, d, "orders")
    return finance.quotes(orders, F.col("o_totalprice"), F.lit(20.0), F.lit(months), F.lit(rate), keep=("o_orderkey",))


@query
def finance_quote(spark, d):
    return _quotes(spark, d, 48, 15.0)


@query
def finance_zero_rate(spark, d):
    return _quotes(spark, d, 36, 0.0)


@query
def finance_zero_term(spark, d):
    return _quotes(spark, d, 0, 15.0)


def _asked(customers, step=1):
    """Every customer asks for the item of the customer's number times ``step``."""
    key = F.col("c_custkey")
    return customers.select(key.alias("request_id"), F.concat(key.cast("string"), F.lit("@example.invalid")).alias("email_destino"), F.col("c_name").alias("nombre_cliente"), (key * step).alias("vehiculo_id"), (key % 50).cast("double").alias("enganche_porcentaje"), (key % 6 * 12).cast("int").alias("plazo_meses"))


def _payloads(spark, d):
    return finance.payloads(_asked(tables.read(spark, d, "customer")), tables.inventory(spark, d))


@query
def quote_payload_json(spark, d):
    """What the sink writes; a part that is null is left out."""
    return _payloads(spark, d).select("request_id", F.to_json("payload").alias("value"))


@query
def quote_payload(spark, d):
    flat = _payloads(spark, d).select("request_id", "payload.to", "payload.subject", "payload.type", "payload.data.*")
    return flat.select("request_id", "to", "subject", "type", "nombre_cliente", "vehiculo.*", "financiamiento.*")


def _typed(spark, d):
    """Terms as customers might type them, derived from their segments."""
    c = tables.read(spark, d, "customer")
    k, s = F.col("c_custkey"), F.lower("c_mktsegment")
    term = (
        F.when(k % 6 == 0, F.concat(F.lit("  "), s, F.lit(" ")))
        .when(k % 6 == 1, F.concat(F.substring(s, 1, 3), F.lit("x"), F.substring(s, 4, 20)))
        .when(k % 6 == 2, F.concat(F.substring(s, 2, 4), F.substring(s, 7, 20)))
        .when(k % 6 == 3, F.element_at(F.array(*map(F.lit, SEGMENTS)), (k % 5 + 1).cast("int")))
        .when(k % 6 == 4, F.upper(s))
        .otherwise(F.concat(F.lit("zz"), s, F.lit("zz")))
    )
    return c.select("c_custkey", term.alias("term"))


def _segments(spark, d):
    return terms.candidates(tables.read(spark, d, "customer"), "c_mktsegment")


@query
def term_dictionary(spark, d):
    return terms.by_dictionary(_typed(spark, d), dictionaries.dictionary(spark, SEGMENTS))


@query
def term_exact(spark, d):
    return terms.by_value(_typed(spark, d), _segments(spark, d))


@query
def term_fuzzy(spark, d):
    return terms.nearest(_typed(spark, d), _segments(spark, d))


@query
def term_cascade(spark, d):
    return terms.corrected(_typed(spark, d), dictionaries.dictionary(spark, SEGMENTS), _segments(spark, d))


def _forms(spark, d, names):
    """Terms as customers might type them, derived from a dictionary's forms."""
    c = tables.read(spark, d, "customer")
    forms = sorted(dictionaries.by_form(names))
    k = F.col("c_custkey")
    form = F.element_at(F.array(*map(F.lit, forms)), (k * 7 % len(forms) + 1).cast("int"))
    term = F.when(k % 4 == 0, form).when(k % 4 == 1, F.concat(F.lit(" "), F.upper(form), F.lit("  "))).when(k % 4 == 2, F.concat(F.substring(form, 1, 2), F.lit("x"), F.substring(form, 3, 40))).otherwise(F.concat(form, F.lit(" zzz")))
    return c.select("c_custkey", term.alias("term"), "c_acctbal")


def _stock(spark, d, names):
    """Names that are in stock: all parts have a name of an even place in the list."""
    place = F.col("p_partkey") * 2 % len(names)
    name = F.element_at(F.array(*map(F.lit, names)), (place - place % 2 + 1).cast("int"))
    return terms.candidates(tables.read(spark, d, "part").select(name.alias("name")), "name")


def _corrected(spark, d, names):
    return terms.corrected(_forms(spark, d, names), dictionaries.dictionary(spark, dictionaries.by_form(names)), _stock(spark, d, names))


@query
def term_cascade_brands(spark, d):
    return _corrected(spark, d, dictionaries.BRANDS).drop("c_acctbal")


@query
def term_cascade_models(spark, d):
    return _corrected(spark, d, dictionaries.MODELS).drop("c_acctbal")


@query
def correction_log(spark, d):
    """The corrections of every customer's brand and price, and the message where nothing is known."""
    price = F.col("c_acctbal")
    log = text.corrections(
        text.correction("marca", F.col("term"), F.col("corrected"), F.col("was_corrected")),
        text.correction("precio_maximo", price, amounts.full_price(price), amounts.price_detail(price)["changed"]),
    )
    return _corrected(spark, d, dictionaries.BRANDS).select("c_custkey", F.array_join(log, "; ").alias("log"), F.when(F.col("unmatched"), text.not_known(F.col("term"))).alias("message"))


@query
def tokenize(spark, d):
    return tables.read(spark, d, "benchmark").select("item_id", F.array_join(text.tokens(F.col("text")), "|").alias("tokens"))


@query
def knowledge_search(spark, d):
    return knowledge.search(tables.knowledge(spark, d), "¿the thation of LICENSED?")


@query
def knowledge_search_category(spark, d):
    return knowledge.search(tables.knowledge(spark, d).withColumn("category", F.when(F.col("category") == "en", "politica").otherwise("general")), "de la", "politicas")


@query
def knowledge_search_many(spark, d):
    asked = tables.read(spark, d, "part").groupBy(F.col("p_name").alias("question")).agg(F.min("p_partkey").alias("question_id"))
    return knowledge.search_many(tables.knowledge(spark, d), asked)


@query
def knowledge_search_wordless(spark, d):
    """Questions of which every third has no word long enough: those find all."""
    k = F.col("p_partkey")
    asked = tables.read(spark, d, "part").select(k.alias("question_id"), F.when(k % 3 == 0, "a de").when(k % 3 == 1, F.col("p_name")).alias("question"))
    return knowledge.search_many(tables.knowledge(spark, d), asked, 3)


@query
def knowledge_topics(spark, d):
    """Every topic of the interface, over articles that have their categories and titles."""
    k = F.col("id")
    pick = lambda values, at: F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))
    articles = tables.knowledge(spark, d).withColumns({
        "category": pick(("general", "garantia", "financiamiento", "proceso", "politica", "servicio"), k % 6),
        "title": F.concat(pick(("Horario ", "sobre ", "Contacto ", "Documentos ", "COMPRA ", "Devolucion ", "Intercambio ", "Otro "), F.floor(k / 6) % 8), "title"),
    })
    found = [knowledge.topic(articles, name).withColumn("tema", F.lit(name)) for name in knowledge.TOPICS]
    return reduce(DataFrame.unionByName, found).select("tema", "id", "titulo")


@query
def knowledge_topic(spark, d):
    return knowledge.topic(tables.knowledge(spark, d), "x", {"x": ("fr", "%le%")})


@query
def knowledge_faq(spark, d):
    return knowledge.frequent(tables.knowledge(spark, d), "licensed", "en")


@query
def lead_status(spark, d):
    return leads.status(tables.requests(spark, d), tables.profiles(spark, d), tables.leads(spark, d)).select("telefono", "status")


@query
def lead_insert_set(spark, d):
    return leads.to_insert(tables.requests(spark, d), tables.profiles(spark, d), tables.leads(spark, d))


@query
def latest_open_lead(spark, d):
    return leads.latest_open(tables.leads(spark, d))


@query
def lead_append(spark, d):
    """What the insert leaves in the table of leads, and a second insert doesn't add to."""
    path, people, now = new_folder(spark, "leads"), tables.profiles(spark, d), tables.leads(spark, d)
    asked = tables.requests(spark, d)
    leads.append(leads.to_insert(asked, people, now), path)
    added = spark.read.parquet(path)
    leads.append(leads.to_insert(asked, people, now.select("telefono", "atendido").union(added.select("telefono", "atendido"))), path)
    return spark.read.parquet(path).select("nombre", "telefono", "email", "vehiculo_interes", "comentarios", "source", "atendido")


@query
def lead_intake_stream(spark, d):
    """Events as a stream of requests; a purchase answers the user's open lead."""
    events = tables.stream(spark, d, "events")
    asked = events.select(F.col("user_id").cast("string").alias("telefono"), F.col("event_id").alias("id"), F.col("ts").alias("created_at"), (F.col("event_type") == "purchase").alias("answered"))
    told = intake.judged(asked, tables.profiles(spark, d), tables.leads(spark, d).limit(0))
    path = new_folder(spark, "intake")
    intake.start(told, path, new_folder(spark, "intake-state")).awaitTermination()
    return spark.read.schema(told.schema).parquet(path).select("id", "telefono", "status")


@query
def quote_outbox(spark, d):
    """Every customer's quote through a stream and an outbox whose transport fails at times.

    Two batches run twice, as after a failure.
    """
    items, sent = tables.inventory(spark, d), new_folder(spark, "sent")
    busy = F.when((F.col("request_id") % 35 == 0) | ((F.col("request_id") % 5 == 0) & (F.col("intento") == 1)), "ocupado")
    box = outbox.Outbox(new_folder(spark, "outbox"), lambda due: due.withColumn("motivo", busy), outbox.to_folder(sent))
    take = lambda asked, batch: box(outbox.messages(asked, items), batch)
    asked = _asked(tables.stream(spark, d, "customer"), 11)
    asked.writeStream.foreachBatch(take).option("checkpointLocation", new_folder(spark, "outbox-state")).trigger(availableNow=True).start().awaitTermination()
    again = _asked(tables.read(spark, d, "customer"), 11)
    for batch, rows in ((0, again), (1, again), (2, again.limit(0)), (2, again.limit(0))):
        take(rows, batch)
    delivered = spark.read.text(sent).select(F.sha2("value", 256).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("veces"))
    return box.latest(spark).withColumn("hash", F.sha2("value", 256)).join(delivered, "hash", "left").select("request_id", "intento", "enviado", "motivo", F.coalesce("veces", F.lit(0)).alias("veces"))


@query
def application_update(spark, d):
    """All applications after every customer's changes, by keyed update of the written table."""
    path = new_folder(spark, "applications")
    applications.write(tables.applications(spark, d), path)
    applications.update(spark, path, tables.status_changes(spark, d))
    return applications.read(spark, path)


@query
def application_changes(spark, d):
    return applications.judged(tables.applications(spark, d), tables.status_changes(spark, d))


#: Documents that a kind of application needs: what a line item shows for one.
NEEDED = {"1-URGENT": ("AF",), "2-HIGH": ("AF", "NO"), "3-MEDIUM": ("AF", "NO", "RF"), "4-NOT SPECIFIED": ("AF", "NO", "RF", "NF"), "5-LOW": ("XX", "NO")}


@query
def application_documents(spark, d):
    needed = spark.createDataFrame([(k, v) for k, docs in NEEDED.items() for v in docs], "kind string, document string")
    held = tables.read(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("application_id"), F.concat("l_returnflag", "l_linestatus").alias("document"))
    found = applications.documents(tables.applications(spark, d), needed, held)
    return found.withColumn("faltantes", F.array_join("faltantes", "|"))


def _statuses(spark, d):
    """Events as changes of a user's status."""
    return tables.read(spark, d, "events").select(F.col("user_id").alias("key"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.col("event_type").alias("status"))


@query
def status_intervals(spark, d):
    return history.intervals(_statuses(spark, d))


@query
def status_as_of(spark, d):
    """At the time of each event: the status of the user with the next number, and since when."""
    asked = tables.read(spark, d, "events").select("event_id", (F.col("user_id") + 1).alias("key"), F.col("ts").alias("at"))
    return history.as_of(asked, _statuses(spark, d))


@query
def knowledge_index_deep(spark, d):
    """An index that stays: the first twenty articles of each part's name, so the deeper postings count."""
    index = search_index.build(tables.knowledge(spark, d), new_folder(spark, "index"), 64)
    asked = tables.read(spark, d, "part").groupBy(F.col("p_name").alias("question")).agg(F.min("p_partkey").alias("question_id"))
    return search_index.search(index, asked, 20)


@query
def knowledge_topics_folded(spark, d):
    """Topics whose titles have accents and cases of their own."""
    k = F.col("id")
    titles = ("DEVOLUCIÓN ", "devolución ", "Devolucion ", "Intercámbio ", "otro ")
    at = F.element_at(F.array(*map(F.lit, titles)), (k % len(titles) + 1).cast("int"))
    articles = tables.knowledge(spark, d).withColumns({"category": F.when(k % 2 == 0, "politica").otherwise("servicio"), "title": F.concat(at, k.cast("string"))})
    found = [knowledge.topic(articles, name, fold=True).withColumn("tema", F.lit(name)) for name in ("devoluciones", "intercambio")]
    return reduce(DataFrame.unionByName, found).select("tema", "id", "titulo")


@query
def term_folded(spark, d):
    """Segments as customers might accent them, by a join whose keys fold."""
    accented = F.translate("c_mktsegment", "AEIOU", "ÁÉÍÓÚ")
    typed = tables.read(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, accented).otherwise(F.lower(accented)).alias("term"))
    return terms.by_value(typed, _segments(spark, d), fold=True)


@query
def term_table_fresh(spark, d):
    """Names and brands of parts as they come, and then some deleted again; every batch runs twice."""
    path, part = new_folder(spark, "terms"), tables.read(spark, d, "part")
    row = lambda c, n: part.select(F.col(c).alias("term"), F.lit(n).alias("n"))
    gone = part.where("p_partkey % 3 = 0").select(F.col("p_brand").alias("term"), F.lit(-1).alias("n"))
    for batch, changes in enumerate((row("p_brand", 1), row("p_name", 1), row("p_name", -1).union(gone))):
        for _ in range(2):
            term_table.fold(changes, path, batch)
    return term_table.read(spark, path)


@query
def person_found(spark, d):
    """Customers ask by a phone, an e-mail or a name as they might write it."""
    c, key = tables.read(spark, d, "customer"), F.col("c_custkey")
    tel, mail = F.lpad(key.cast("string"), 10, "5"), F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.invalid"))
    people_ = c.select(key.alias("person_id"), key.alias("id"), tel.alias("telefono"), mail.alias("email"), F.col("c_name").alias("nombre"))
    asked = c.select(
        key.alias("request_id"),
        F.when(key % 5 == 0, key + 1).alias("id"),
        F.when(key % 5 == 1, F.concat(F.lit("+52 ("), tel, F.lit(")"))).alias("telefono"),
        F.when(key % 5 < 3, F.concat(F.lit(" "), F.upper(mail))).alias("email"),
        F.when(key % 5 > 1, F.when(key % 2 == 0, F.concat(F.lit("customer, "), F.regexp_extract("c_name", "#0*(.*)", 1))).otherwise(F.col("c_name"))).alias("nombre"),
    )
    return people.find(asked, people_)


@query
def inventory_search_layout(spark, d):
    """A search for a whole brand by ranges of year and price, from the files that may have it."""
    path = new_folder(spark, "layout")
    layout.write(tables.inventory(spark, d), path, files=24)
    conditions = {"autoano": 1995, "precio": 100000.0}, {"autoano": 1998, "precio": 300000.0}
    return inventory.search(layout.read(spark, path, "BUILDING", *conditions), {}, limit=50)


@query
def inventory_search_offers(spark, d):
    """The cheapest offers that have run no further than that."""
    return inventory.search(tables.inventory(spark, d).where("con_oferta"), {}, {}, {"kilometraje": 9000.0}, 20)


@query
def alternatives_newest(spark, d):
    return inventory.alternatives(tables.inventory(spark, d), "auto", 300000.0, priority="año")


@query
def search_messages(spark, d):
    """What a search tells every customer: a segment as it was typed, or none, and a band of prices."""
    k = F.col("c_custkey")
    asked = _typed(spark, d).select(
        k.alias("request_id"),
        F.when(k % 7 != 0, F.when(k % 4 == 3, F.concat("term", F.lit("?!zz"))).when(k % 9 == 0, F.lit("il")).otherwise(F.trim("term"))).alias("marca"),
        F.when(k % 3 != 0, 300.0 + k % 250).alias("precio_minimo"),
        F.when(k % 3 != 1, 450000.0 - (k % 500) * 900).alias("precio_maximo"),
    )
    told = messages.search(asked, tables.inventory(spark, d), dictionaries.dictionary(spark, SEGMENTS))
    return told.withColumn("corrections", F.array_join("corrections", "; "))
