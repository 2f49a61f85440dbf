"""Credit applications: status changes by key, and which documents are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.store import exists, remove

# The statuses of the interface.
STATUSES = ("pendiente_documentos", "documentos_completos", "en_revision_banco", "pre_aprobada", "aprobada", "rechazada", "firmada", "completada", "cancelada")
#: From which status an application may go to which others.  The surveyed tool
#: takes any change; pass ``anything()`` for that.
ALLOWED = {
    "pendiente_documentos": ("documentos_completos", "cancelada"),
    "documentos_completos": ("pendiente_documentos", "en_revision_banco", "cancelada"),
    "en_revision_banco": ("pre_aprobada", "rechazada", "cancelada"),
    "pre_aprobada": ("aprobada", "rechazada", "cancelada"),
    "aprobada": ("firmada", "cancelada"),
    "firmada": ("completada", "cancelada"),
}
#: Hash partitions of a table; a change rewrites those of its keys only.
SLOTS = 64


def anything() -> dict[str, tuple[str, ...]]:
    return {s: STATUSES for s in STATUSES}


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("application_id"), F.lit(slots)).cast("int").alias("slot")


def write(applications: DataFrame, path: str, slots: int = SLOTS) -> None:
    """``applications`` (application_id, status, notas, ...) by hash partitions."""
    applications.select("*", _slot(slots)).repartition("slot").write.partitionBy("slot").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The applications at ``path``, once an update that broke off is brought to its end."""
    finish(spark, path)
    return spark.read.parquet(path).drop("slot")


def judged(applications: DataFrame, changes: DataFrame, allowed: dict[str, tuple[str, ...]] = ALLOWED) -> DataFrame:
    """``changes`` (application_id, seq, nuevo_status, notas) with their outcome.

    The changes of an application are taken in the order of ``seq``, each from
    the status that the one before has left: ``aplicado``, ``no_permitido``
    (the application stays as it is) or ``desconocida`` (no such application).
    ``status`` is the application's after the change, null for an unknown one.
    One task holds the changes that one call has for an application.
    """
    to = F.create_map(*[x for s in STATUSES for x in (F.lit(s), F.array(*map(F.lit, allowed.get(s, ()))).cast("array<string>"))])
    open_to = lambda s, new: F.coalesce(F.array_contains(F.element_at(to, s), new), F.lit(False))

    def step(done: Column, change: Column) -> Column:
        now = F.when(F.size(done) > 0, F.try_element_at(done, F.lit(-1))["status"]).otherwise(change["given"])
        fits = open_to(now, change["nuevo_status"])
        row = F.struct(change["seq"].alias("seq"), change["nuevo_status"].alias("nuevo_status"), change["notas"].alias("notas"), F.when(fits, change["nuevo_status"]).otherwise(now).alias("status"), fits.alias("fits"))
        return F.concat(done, F.array(row))

    known = applications.select("application_id", F.col("status").alias("given"), F.lit(True).alias("known"))
    joined = changes.select("application_id", "seq", "nuevo_status", "notas").join(known, "application_id", "left")
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    none = F.array().cast(f"array<struct<seq:{kinds['seq']},nuevo_status:string,notas:string,status:string,fits:boolean>>")
    of_one = joined.groupBy("application_id").agg(F.first("known").alias("known"), F.array_sort(F.collect_list(F.struct("seq", "nuevo_status", "notas", "given"))).alias("todo"))
    walked = of_one.select("application_id", "known", F.explode(F.aggregate("todo", none, step)).alias("c"))
    outcome = F.when(F.col("known").isNull(), "desconocida").when(F.col("c.fits"), "aplicado").otherwise("no_permitido")
    return walked.select("application_id", "c.seq", "c.nuevo_status", "c.notas", outcome.alias("outcome"), F.when(F.col("known"), F.col("c.status")).alias("status"))


def update(spark: SparkSession, path: str, changes: DataFrame, slots: int = SLOTS, allowed: dict[str, tuple[str, ...]] = ALLOWED) -> None:
    """Applies ``changes`` to the applications at ``path``.

    Only the hash partitions that hold a changed application are read and
    written again.  The new partitions are staged beside the table first: what
    breaks off before that leaves the table as it was, what breaks off later is
    finished by the next :func:`read` or :func:`update`.  One writer at a time.
    """
    finish(spark, path)
    # no more rows than slots
    touched = [r.slot for r in changes.select(_slot(slots)).distinct().collect()]
    current = spark.read.parquet(path).where(F.col("slot").isin(touched))
    last = judged(current, changes, allowed).where("outcome = 'aplicado'").groupBy("application_id").agg(F.max(F.struct("seq", "nuevo_status", "notas")).alias("c"))
    here = last.select("application_id", "c.nuevo_status", F.col("c.notas").alias("nueva"))
    changed = here.join(current.select("application_id", "slot"), "application_id").select("slot").distinct()
    slots_of = [r.slot for r in changed.collect()]  # no more rows than slots
    if not slots_of:
        return
    rows = current.where(F.col("slot").isin(slots_of)).join(here, "application_id", "left")
    new = {"status": F.coalesce("nuevo_status", "status"), "notas": F.when(F.col("nuevo_status").isNotNull(), F.col("nueva")).otherwise(F.col("notas"))}
    rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in current.columns]).repartition("slot").write.partitionBy("slot").parquet(_staged(path))
    finish(spark, path)


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}__staged"


def finish(spark: SparkSession, path: str) -> None:
    """Moves staged partitions into the table, or drops half-written ones."""
    staged = _staged(path)
    if exists(spark, f"{staged}/_SUCCESS"):
        spark.read.parquet(staged).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("slot").parquet(path)
    if exists(spark, staged):
        remove(spark, staged)


def documents(applications: DataFrame, required: DataFrame, held: DataFrame) -> DataFrame:
    """Each application (application_id, kind) with ``estado``: completo, parcial or ninguno.

    ``required`` (kind, document) tells what a kind needs, ``held``
    (application_id, document) what is there, repeats included.  The division
    counts: a held document meets the required ones of its application's kind,
    and whatever isn't met is missing.  A kind that needs nothing is complete.
    No application gathers more than its kind needs.
    """
    needs = required.where("document is not null").select("kind", "document").distinct()
    wanted = applications.select("application_id", "kind").join(needs, "kind")
    there = held.select("application_id", "document").distinct().withColumn("_there", F.lit(True))
    met = wanted.join(there, ["application_id", "document"], "left")
    missing = F.array_sort(F.collect_list(F.when(F.col("_there").isNull(), F.col("document"))))
    counted = met.groupBy("application_id").agg(F.count("_there").alias("presentes"), F.count(F.lit(1)).alias("requeridos"), missing.alias("faltantes"))
    all_ = applications.select("application_id", "kind").join(counted, "application_id", "left")
    n, of = F.coalesce("presentes", F.lit(0)).alias("presentes"), F.coalesce("requeridos", F.lit(0)).alias("requeridos")
    out = all_.select("application_id", "kind", n, of, F.coalesce("faltantes", F.array().cast("array<string>")).alias("faltantes"))
    return out.withColumn("estado", F.when(F.col("presentes") == F.col("requeridos"), "completo").when(F.col("presentes") > 0, "parcial").otherwise("ninguno"))
