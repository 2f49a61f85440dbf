"""Readers: logical tables as given, and views of the star schema as such."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators.applications import STATUSES
from marlstone.sources import schemas


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream of its files."""
    schema = read(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as an inventory of 30 columns."""
    orders, customer, nation = (read(spark, folder, t) for t in ("orders", "customer", "nation"))
    # 25 rows, by the schema's definition
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    columns = {
        "id": key,
        "slug": F.when(key % 3 != 0, F.concat(F.lit("o-"), key.cast("string"))),
        "liga_web": F.when(key % 5 == 0, F.concat(F.lit("https://example.invalid/v/"), key.cast("string"))),
        "titulo": F.when(key % 4 == 1, "").when(key % 4 > 1, F.col("c_name")),
        "marca": F.col("c_mktsegment"),
        "modelo": F.col("o_orderpriority"),
        "autoano": F.year("o_orderdate"),
        "precio": price,
        "transmision": F.col("o_orderstatus"),
        "combustible": F.col("c_mktsegment"),
        "carroceria": F.col("o_orderpriority"),
        "ubicacion": F.col("n_name"),
        "garantia": F.col("o_orderstatus"),
        "motor": F.when(key % 2 == 0, F.concat(F.lit("M"), (key % 16).cast("string"))),
        "cilindros": (key % 8).cast("int"),
        "descripcion": F.col("c_name"),
        "kilometraje": F.when(key % 7 != 0, key * 1.5),
        "enganchemin": F.when(key % 6 == 0, 0.0).when(key % 6 != 1, price * 0.25),
        "enganche_recomendado": price * 0.5,
        "mensualidad_minima": F.when(key % 6 != 2, price * 0.03125),
        "mensualidad_recomendada": price * 0.0625,
        "plazomax": F.lit(60),
        "con_oferta": key % 9 == 0,
        "oferta": F.when(key % 9 == 0, price * 0.875),
        "promociones": F.when(key % 9 == 0, F.array(F.lit("p1"), F.concat(F.lit("p"), key.cast("string")))),
        "feature_image_url": F.concat(F.lit("https://example.invalid/i/"), key.cast("string")),
        "galeria_exterior": F.transform(F.sequence(F.lit(1), (key % 3 + 1).cast("int")), lambda i: F.concat(F.lit("e"), i.cast("string"))),
        "galeria_interior": F.array().cast("array<string>"),
        "exhibicion_inventario": F.col("o_orderstatus") != "F",
        "separado": F.col("o_orderstatus") == "P",
    }
    return schemas.checked(joined.select(*[c.alias(n) for n, c in columns.items()]), schemas.INVENTORY)


def knowledge(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as articles; those labelled of low quality are inactive."""
    low = read(spark, folder, "labels").where("quality = 0").select("doc_id").distinct()
    docs = read(spark, folder, "documents").join(low.withColumn("low", F.lit(True)), "doc_id", "left")
    return schemas.checked(
        docs.select(
            F.col("doc_id").alias("id"),
            F.col("lang").alias("category"),
            F.substring("text", 1, 80).alias("title"),
            F.col("text").alias("content"),
            F.lit(None).alias("keywords"),
            F.col("n_chars").alias("priority"),
            F.col("low").isNull().alias("is_active"),
        ),
        schemas.KNOWLEDGE,
    )


def profiles(spark: SparkSession, folder: str, segment: str = "BUILDING") -> DataFrame:
    """Customers of one segment as profiles."""
    c = read(spark, folder, "customer").where(F.col("c_mktsegment") == segment)
    key = F.col("c_custkey").cast("string")
    return schemas.checked(c.select(key.alias("id"), F.col("c_name").alias("first_name"), F.lit(None).alias("last_name"), F.lit(None).alias("email"), key.alias("phone")), schemas.PROFILES)


def leads(spark: SparkSession, folder: str) -> DataFrame:
    """Events as leads, open where a sign-up made them."""
    e = read(spark, folder, "events")
    key = F.col("event_id").cast("string")
    return schemas.checked(
        e.select(
            key.alias("id"),
            F.col("event_type").alias("nombre"),
            F.col("user_id").cast("string").alias("telefono"),
            F.lit(None).alias("email"),
            F.lit(None).alias("vehiculo_interes"),
            F.lit(None).alias("comentarios"),
            F.lit("chat_widget").alias("source"),
            (F.col("event_type") != "signup").alias("atendido"),
            F.col("ts").alias("created_at"),
        ),
        schemas.LEADS,
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as contact requests; every third has no e-mail."""
    c = read(spark, folder, "customer")
    key = F.col("c_custkey")
    return c.select(
        F.col("c_name").alias("nombre"),
        key.cast("string").alias("telefono"),
        F.when(key % 3 == 0, "").otherwise(F.concat(key.cast("string"), F.lit("@example.invalid"))).alias("email"),
        F.col("c_mktsegment").alias("vehiculo_interes"),
        F.lit(None).cast("string").alias("comentarios"),
    )


def applications(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as credit applications."""
    key = F.col("o_orderkey")
    status = F.element_at(F.array(*map(F.lit, STATUSES)), (key % len(STATUSES) + 1).cast("int"))
    return read(spark, folder, "orders").select(key.cast("string").alias("application_id"), F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderpriority").alias("kind"), status.alias("status"), F.lit(None).cast("string").alias("notas"))


def status_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Two changes that each customer asks for; some applications aren't known."""
    key = F.col("c_custkey")
    at = lambda n: F.element_at(F.array(*map(F.lit, STATUSES)), (n % len(STATUSES) + 1).cast("int"))
    two = F.explode(F.array(F.struct(F.lit(1).alias("seq"), at(key * 11 + 1).alias("nuevo_status")), F.struct(F.lit(2).alias("seq"), at(key).alias("nuevo_status"))))
    rows = read(spark, folder, "customer").select("c_custkey", two.alias("c"))
    return rows.select((key * 11).cast("string").alias("application_id"), "c.*", F.concat(F.lit("nota "), key.cast("string")).alias("notas"))
