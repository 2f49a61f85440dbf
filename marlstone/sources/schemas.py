"""Declared schemas of the logical tables, and a check of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


INVENTORY = _table(
    ("id", _L), ("slug", _S), ("liga_web", _S), ("titulo", _S), ("marca", _S), ("modelo", _S), ("autoano", _I), ("precio", _D),
    ("transmision", _S), ("combustible", _S), ("carroceria", _S), ("ubicacion", _S), ("garantia", _S), ("motor", _S), ("cilindros", _I),
    ("descripcion", _S), ("kilometraje", _D), ("enganchemin", _D), ("enganche_recomendado", _D), ("mensualidad_minima", _D),
    ("mensualidad_recomendada", _D), ("plazomax", _I), ("con_oferta", _B), ("oferta", _D), ("promociones", T.ArrayType(_S)),
    ("feature_image_url", _S), ("galeria_exterior", T.ArrayType(_S)), ("galeria_interior", T.ArrayType(_S)),
    ("exhibicion_inventario", _B), ("separado", _B),
)
KNOWLEDGE = _table(("id", _L), ("category", _S), ("title", _S), ("content", _S), ("keywords", T.ArrayType(_S)), ("priority", _L), ("is_active", _B))
PROFILES = _table(("id", _S), ("first_name", _S), ("last_name", _S), ("email", _S), ("phone", _S))
LEADS = _table(
    ("id", _S), ("nombre", _S), ("telefono", _S), ("email", _S), ("vehiculo_interes", _S), ("comentarios", _S), ("source", _S), ("atendido", _B), ("created_at", T.TimestampType())
)


class MissingColumns(ValueError):
    pass


def checked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the schema's columns and types; missing ones raise."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise MissingColumns(", ".join(missing))
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
