"""Validated parameters of the named queries."""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import Any

from marlstone.operators.inventory import PRIORITIES
from marlstone.operators.knowledge import CATEGORIES, TOPICS


class InvalidParams(ValueError):
    pass


def _need(ok: Any, message: str) -> None:
    if not ok:
        raise InvalidParams(message)


class Params:
    """Checks that texts are texts and numbers finite numbers."""

    TEXTS: tuple[str, ...] = ()
    NUMBERS: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for name in self.TEXTS:
            v = getattr(self, name)
            _need(v is None or isinstance(v, str), f"{name} must be a text")
        for name in self.NUMBERS:
            v = getattr(self, name)
            _need(v is None or (isinstance(v, (int, float)) and not isinstance(v, bool) and v == v and abs(v) != float("inf")), f"{name} must be a number")

    @classmethod
    def of(cls, given: dict[str, Any]):
        """From named values; unknown names are left out, as are nulls."""
        known = {f.name for f in fields(cls)}  # type: ignore[arg-type]
        try:
            return cls(**{k: v for k, v in given.items() if k in known and v is not None})
        except TypeError as e:
            raise InvalidParams(str(e)) from None


@dataclass(frozen=True)
class Search(Params):
    marca: str | None = None
    modelo: str | None = None
    ano_minimo: float | None = None
    ano_maximo: float | None = None
    precio_minimo: float | None = None
    precio_maximo: float | None = None
    tipo_carroceria: str | None = None
    transmision: str | None = None
    combustible: str | None = None
    kilometraje_maximo: float | None = None
    con_oferta: bool | None = None
    limite: int = 5
    TEXTS = ("marca", "modelo", "tipo_carroceria", "transmision", "combustible")
    NUMBERS = ("ano_minimo", "ano_maximo", "precio_minimo", "precio_maximo", "kilometraje_maximo", "limite")

    def __post_init__(self) -> None:
        super().__post_init__()
        _need(self.con_oferta is None or isinstance(self.con_oferta, bool), "con_oferta must be true or false")


@dataclass(frozen=True)
class Detail(Params):
    id: int | None = None
    slug: str | None = None
    TEXTS, NUMBERS = ("slug",), ("id",)

    def __post_init__(self) -> None:
        super().__post_init__()
        _need(self.id is not None or self.slug is not None, "id or slug is needed")


@dataclass(frozen=True)
class Alternatives(Params):
    marca_original: str
    presupuesto: float
    modelo_original: str | None = None
    tipo_uso: str | None = None
    prioridad: str = "precio"
    TEXTS, NUMBERS = ("marca_original", "modelo_original", "tipo_uso", "prioridad"), ("presupuesto",)

    def __post_init__(self) -> None:
        super().__post_init__()
        _need(self.prioridad in PRIORITIES, "unknown prioridad")


@dataclass(frozen=True)
class Compare(Params):
    vehiculo_ids: tuple[int, ...]

    def __post_init__(self) -> None:
        _need(2 <= len(self.vehiculo_ids) <= 4, "two to four ids are needed")
        _need(all(isinstance(v, int) for v in self.vehiculo_ids), "ids must be numbers")


@dataclass(frozen=True)
class Nothing(Params):
    pass


@dataclass(frozen=True)
class Financing(Params):
    precio_vehiculo: float
    enganche_porcentaje: float = 20.0
    plazo_meses: float = 48
    tasa_anual: float = 15.0
    NUMBERS = ("precio_vehiculo", "enganche_porcentaje", "plazo_meses", "tasa_anual")


@dataclass(frozen=True)
class Question(Params):
    pregunta: str
    categoria: str | None = None
    TEXTS = ("pregunta", "categoria")

    def __post_init__(self) -> None:
        super().__post_init__()
        _need(self.categoria is None or self.categoria in CATEGORIES, "unknown categoria")


@dataclass(frozen=True)
class Topic(Params):
    tema: str

    def __post_init__(self) -> None:
        _need(self.tema in TOPICS, "unknown tema")


@dataclass(frozen=True)
class Frequent(Params):
    categoria: str | None = None
    TEXTS = ("categoria",)


@dataclass(frozen=True)
class Contact(Params):
    nombre: str
    telefono: str
    email: str | None = None
    vehiculo_interes: str | None = None
    comentarios: str | None = None
    TEXTS = ("nombre", "telefono", "email", "vehiculo_interes", "comentarios")


@dataclass(frozen=True)
class Mail(Params):
    email_destino: str
    nombre_cliente: str
    vehiculo_id: int
    enganche_porcentaje: float = 20.0
    plazo_meses: float = 48
    TEXTS, NUMBERS = ("email_destino", "nombre_cliente"), ("vehiculo_id", "enganche_porcentaje", "plazo_meses")
