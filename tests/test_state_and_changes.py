"""Keyed updates, history, missing documents, the intake stream and the outbox."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marlstone.operators import applications, history, inventory, leads
from marlstone.sources import store
from marlstone.streaming import intake, outbox

START = datetime(2024, 1, 1)


def flat(rows):
    return sorted(tuple(map(str, r)) for r in rows)


# keyed update


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "applications")
    rows = [(str(i), applications.STATUSES[i % 9], None, i) for i in range(200)]
    applications.write(spark.createDataFrame(rows, "application_id string, status string, notas string, other long"), path, slots=16)
    return path


def changes(spark, rows):
    return spark.createDataFrame(rows, "application_id string, seq int, nuevo_status string, notas string")


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


def test_update_rewrites_touched_partitions_only(spark, table):
    before = {r.application_id: r for r in applications.read(spark, table).collect()}
    old = files(table)
    applications.update(spark, table, changes(spark, [("0", 1, "documentos_completos", "a"), ("0", 2, "en_revision_banco", "b"), ("9", 1, "completada", "no"), ("x", 1, "aprobada", "?")]), slots=16)
    after = {r.application_id: r for r in applications.read(spark, table).collect()}
    assert (after.pop("0").asDict(), before.pop("0").status) == ({"application_id": "0", "status": "en_revision_banco", "notas": "b", "other": 0}, "pendiente_documentos")
    assert after == before  # a change that isn't allowed, and one of an unknown application, change nothing
    kept = old & files(table)
    assert len({p.split("/")[0] for p in old - kept}) == 1  # one partition
    assert len(kept) == len(old) - len(old - kept) and len(old - kept) < len(old)


def test_update_that_changes_nothing_writes_nothing(spark, table):
    old = files(table)
    applications.update(spark, table, changes(spark, [("1", 1, "completada", None), ("none", 1, "firmada", None)]), slots=16)
    applications.update(spark, table, changes(spark, []), slots=16)
    assert files(table) == old


def test_update_that_breaks_off_is_finished_by_the_next_read(spark, table, monkeypatch):
    before = flat(applications.read(spark, table).collect())
    real = applications.finish
    calls = []
    monkeypatch.setattr(applications, "finish", lambda s, p: calls.append(p) or (real(s, p) if len(calls) == 1 else None))
    applications.update(spark, table, changes(spark, [("0", 1, "cancelada", "late")]), slots=16)
    assert flat(spark.read.parquet(table).drop("slot").collect()) == before  # staged only
    monkeypatch.setattr(applications, "finish", real)
    assert applications.read(spark, table).where("application_id = '0'").first().status == "cancelada"
    assert not Path(f"{table}__staged").exists()
    # a half-written stage counts for nothing
    now = flat(applications.read(spark, table).collect())
    spark.range(3).selectExpr("string(id) as application_id", "0 as slot").write.parquet(f"{table}__staged")
    (Path(f"{table}__staged") / "_SUCCESS").unlink()
    assert flat(applications.read(spark, table).collect()) == now


def test_any_change_is_allowed_where_asked(spark):
    one = spark.createDataFrame([("1", "completada"), ("2", None)], "application_id string, status string")
    asked = changes(spark, [("1", 1, "aprobada", None), ("1", 2, "unheard", None), ("2", 1, "aprobada", None), ("3", 1, "aprobada", None)])
    got = {(r.application_id, r.seq): (r.outcome, r.status) for r in applications.judged(one, asked, applications.anything()).collect()}
    assert got == {("1", 1): ("aplicado", "aprobada"), ("1", 2): ("no_permitido", "aprobada"), ("2", 1): ("no_permitido", None), ("3", 1): ("desconocida", None)}
    assert {r.outcome for r in applications.judged(one, asked).where("application_id = '1'").collect()} == {"no_permitido"}


# missing documents


def test_documents_divide(spark):
    apps = spark.createDataFrame([("a", "k"), ("b", "k"), ("c", "k"), ("d", "free"), ("e", "new")], "application_id string, kind string")
    needs = spark.createDataFrame([("k", "id"), ("k", "pay"), ("k", "pay"), ("new", "x"), ("free", None)], "kind string, document string")
    held = spark.createDataFrame([("a", "pay"), ("a", "id"), ("a", "id"), ("a", "other"), ("b", "id"), ("c", "other"), ("e", None), ("zz", "id")], "application_id string, document string")
    got = {r.application_id: (r.estado, r.presentes, r.requeridos, r.faltantes) for r in applications.documents(apps, needs, held).collect()}
    assert got == {"a": ("completo", 2, 2, []), "b": ("parcial", 1, 2, ["pay"]), "c": ("ninguno", 0, 2, ["id", "pay"]), "d": ("completo", 0, 0, []), "e": ("ninguno", 0, 1, ["x"])}


# history


def slow_as_of(probes, rows):
    out = []
    for key, at, n in probes:
        past = [(a, s, v) for k, a, s, v in rows if k == key and k is not None and at is not None and a is not None and a <= at]
        last = max(past, key=lambda r: (r[0], r[1])) if past else (None, None, None)
        out.append((key, at, n, last[2], last[0]))
    return out


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_as_of_equals_brute_force(spark, unit):
    rng = random.Random(3)
    at = lambda: START + timedelta(minutes=rng.randrange(0, 6000, 10))
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([at(), at(), at(), None]), i, rng.choice(["a", "b", None])) for i in range(300)]
    probes = [(rng.choice([1, 1, 2, 4, None]), rng.choice([at(), at(), START - timedelta(days=400), None]), i) for i in range(200)]
    got = history.as_of(spark.createDataFrame(probes, "key int, at timestamp, n int"), spark.createDataFrame(rows, "key int, at timestamp, seq int, status string"), unit)
    assert got.columns == ["key", "at", "n", "status", "since"]
    assert flat(got.collect()) == flat(slow_as_of(probes, rows))


def test_a_hot_key_is_spread_over_stretches(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("key"), F.timestamp_seconds(F.col("id") * 600).alias("at"), F.col("id").alias("seq"), (F.col("id") % 3).cast("string").alias("status"))
    found = history.as_of(rows.select("key", "at", "seq"), rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and "_unit" in plan.split("Window")[1]
    assert found.where("status <> string(seq % 3)").count() == 0 and found.count() == 20_000


def test_intervals_join_repeats_and_end_where_the_next_begins(spark):
    at = lambda n: START + timedelta(hours=n)
    rows = [(1, at(0), 1, "a"), (1, at(1), 2, "a"), (1, at(2), 3, "b"), (1, at(2), 4, "c"), (1, at(3), 5, None), (2, at(0), 6, None)]
    got = [tuple(r) for r in history.intervals(spark.createDataFrame(rows, "key int, at timestamp, seq int, status string")).orderBy("key", "valid_from").collect()]
    assert got == [(1, "a", at(0), at(2)), (1, "c", at(2), at(3)), (1, None, at(3), None), (2, None, at(0), None)]


# the stream of requests


def run_stream(spark, folder, schema, requests, profiles, open_leads, **more):
    """``requests`` as files, one a batch, in order; the status of each id."""
    source = f"{folder}/in"
    for i, rows in enumerate(requests):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        newest = max(Path(source).glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
        newest.rename(newest.with_name(f"{i:03d}.parquet"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    told = intake.judged(stream, profiles, open_leads, **more)
    intake.start(told, f"{folder}/out", f"{folder}/check").awaitTermination()
    return told


REQUEST = "telefono string, id string, created_at timestamp, answered boolean"


@pytest.fixture
def nobody(spark):
    return spark.createDataFrame([], "phone string"), spark.createDataFrame([], "telefono string, atendido boolean")


def test_leads_of_the_stream_itself_count(spark, tmp_path, nobody):
    at = lambda n: START + timedelta(hours=n)
    batches = [
        [("1", "a", at(0), False), ("1", "b", at(1), False), ("p", "c", at(1), False), ("o", "d", at(1), False), (None, "e", at(1), False)],
        [("1", "f", at(2), True), ("1", "g", at(3), False), ("2", "h", at(3), True), (None, "i", at(3), None)],
        [("1", "j", at(4), False), ("2", "k", at(4), None)],
        [("1", "l", at(4 + 24 * 31), False)],
    ]
    people = spark.createDataFrame([("p",), ("p",), (None,)], "phone string")
    waiting = spark.createDataFrame([("o", False), ("2", True), ("p", False)], "telefono string, atendido boolean")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    run_stream(spark, str(tmp_path), REQUEST, batches, people, waiting)
    got = {r.id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": "nuevo", "b": "lead_abierto", "c": "perfil", "d": "lead_abierto", "e": "nuevo", "f": "respondido", "g": "nuevo", "h": "sin_lead", "i": "nuevo", "j": "lead_abierto", "k": "nuevo", "l": "nuevo"}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_a_replayed_stream_equals_the_batch(spark, tmp_path):
    rng = random.Random(6)
    asked = [(str(rng.randrange(60)), str(i), START + timedelta(minutes=i), False) for i in range(300)]
    people = spark.createDataFrame([(str(i),) for i in range(0, 60, 7)], "phone string")
    waiting = spark.createDataFrame([(str(i), i % 2 == 0) for i in range(0, 60, 5)], "telefono string, atendido boolean")
    run_stream(spark, str(tmp_path), REQUEST, [asked[:100], asked[100:110], asked[110:]], people, waiting)
    new = spark.read.parquet(str(tmp_path / "out")).where("status = 'nuevo'")
    rows = spark.createDataFrame([(t, i, i, None, None) for t, i, _, _ in asked], "telefono string, nombre string, email string, vehiculo_interes string, comentarios string")
    assert sorted(r.telefono for r in new.collect()) == sorted(r.telefono for r in leads.to_insert(rows, people, waiting).collect())
    # the same checkpoint again: nothing is taken twice
    again = intake.judged(spark.readStream.schema(REQUEST).parquet(str(tmp_path / "in")), people, waiting)
    intake.start(again, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300


# the outbox


def test_a_batch_that_runs_twice_sends_once(spark, tmp_path):
    busy = {"now": "ocupado"}
    box = outbox.Outbox(str(tmp_path / "box"), lambda due: due.withColumn("motivo", F.when(F.col("request_id") == 2, F.lit(busy["now"]))), outbox.to_folder(str(tmp_path / "sent")), tries=3)
    rows = lambda *r: spark.createDataFrame(r, "message_id string, request_id long, value string")
    first = rows(("a", 1, "{1}"), ("a", 1, "{1}"), ("b", 2, "{2}"), ("c", 3, None))
    for batch, new in ((0, first), (0, first), (1, rows(("a", 1, "{1}"), ("d", 4, "{4}"))), (1, rows(("a", 1, "{1}"), ("d", 4, "{4}")))):
        box(new, batch)
    sent = lambda: sorted(r.value for r in spark.read.text(str(tmp_path / "sent")).collect())
    assert sent() == ["{1}", "{4}"]
    last = {r.message_id: (r.intento, r.enviado, r.motivo) for r in box.latest(spark).collect()}
    assert last == {"a": (1, True, None), "b": (2, False, "ocupado"), "c": (1, False, "sin_vehiculo"), "d": (1, True, None)}
    busy["now"] = None
    box(rows(), 2)
    box(rows(), 3)
    assert sent() == ["{1}", "{2}", "{4}"] and box.rows(spark).where("message_id = 'b'").count() == 3
    # a try that breaks off leaves what other batches have written
    with pytest.raises(ZeroDivisionError):
        outbox.Outbox(box.path, lambda due: 1 / 0)(rows(("e", 5, "{5}")), 4)
    assert box.rows(spark).count() == 6


def test_messages_keep_requests_without_an_item(spark):
    item = "id long, titulo string, marca string, modelo string, autoano int, precio double, liga_web string, slug string"
    items = spark.createDataFrame([(7, "T", "M", "N", 2020, 1000.0, None, None)], item)
    asked = spark.createDataFrame([(1, "e", "n", 7, 20.0, 12), (2, "e", "n", 8, 20.0, 12)], "request_id long, email_destino string, nombre_cliente string, vehiculo_id long, enganche_porcentaje double, plazo_meses int")
    got = {r.request_id: r for r in outbox.messages(asked, items).collect()}
    assert '"titulo":"T"' in got[1].value and got[2].value is None and got[1].message_id != got[2].message_id
    changed = outbox.messages(asked, items.withColumn("precio", F.lit(2000.0))).where("request_id = 1").first()
    assert changed.message_id != got[1].message_id


# totals and folders


def test_total_comes_with_the_rows(spark):
    rows = [(i, f"t{i}", "b", "m", 2020, float(i), True, False) for i in range(50)] + [(99, "t", "b", "m", 2020, 5.0, True, True)]
    items = spark.createDataFrame(rows, "id long, titulo string, marca string, modelo string, autoano int, precio double, exhibicion_inventario boolean, separado boolean")
    for c in ("transmision", "combustible", "carroceria", "ubicacion", "garantia", "liga_web", "slug"):
        items = items.withColumn(c, F.lit("x"))
    for c in ("kilometraje", "enganchemin", "mensualidad_minima"):
        items = items.withColumn(c, F.lit(1.0))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("total", "total")
    found, counted = inventory.search_counted(items, {"marca": "B"}, {"precio": 10.0}, limit=3)
    assert [r.id for r in found.collect()] == [10, 11, 12] and counted.get["total"] == 40
    jobs = len(tracker.getJobIdsForGroup("total"))
    spark.sparkContext.setJobGroup("plain", "plain")
    inventory.search(items, {"marca": "B"}, {"precio": 10.0}, limit=3).collect()
    assert jobs == len(tracker.getJobIdsForGroup("plain"))  # the count costs no job
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_folders_of_queries_go(spark):
    path = store.new_folder(spark, "gone")
    spark.range(3).write.parquet(path)
    assert store.exists(spark, path)
    store.remove(spark, path)
    assert not store.exists(spark, path)
