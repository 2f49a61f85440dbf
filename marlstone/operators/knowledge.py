"""Knowledge articles: keyword search, topics, frequent questions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import contains_ci
from marlstone.operators import search_index
from marlstone.operators.filters import any_of
from marlstone.sources.store import new_folder

# The categories of the interface, and as stored.
CATEGORIES = {"politicas": "politica", "procesos": "proceso", "garantias": "garantia", "faq": "faq", "financiamiento": "financiamiento", "general": "general"}
# The topics of the interface, their category and title pattern.
TOPICS = {
    "horarios": ("general", "%Horario%"),
    "ubicaciones": ("general", "%Sobre%"),
    "contacto": ("general", "%Contacto%"),
    "garantias": ("garantia", "%"),
    "financiamiento": ("financiamiento", "%"),
    "documentos_requeridos": ("proceso", "%Documento%"),
    "proceso_compra": ("proceso", "%Compra%"),
    "devoluciones": ("politica", "%Devolucion%"),
    "intercambio": ("servicio", "%Intercambio%"),
    "servicios": ("servicio", "%"),
}


def _first(df: DataFrame, n: int | None) -> DataFrame:
    """By falling priority, unknown ones first; equal ones by id."""
    ordered = df.orderBy(F.desc_nulls_first("priority"), "id")
    return ordered.limit(n) if n else ordered


def words_of(question: str) -> list[str]:
    return [w for w in re.split(r"\s+", question.lower()) if len(w) > 2]


def search(articles: DataFrame, question: str, category: str | None = None, limit: int = 5, fold: bool = False) -> DataFrame:
    """Active articles with any word of the question in title or content.

    ``fold`` finds words whatever accents they have.
    """
    found = articles.where("is_active")
    if category:
        found = found.where(F.col("category") == CATEGORIES.get(category, category))
    words = words_of(question)
    if words:
        found = found.where(any_of([contains_ci(F.col(c), w, fold=fold) for w in words for c in ("title", "content")]))
    return _first(found, limit).select("id", F.col("category").alias("categoria"), F.col("title").alias("titulo"), F.col("content").alias("contenido"))


def search_many(articles: DataFrame, questions: DataFrame, limit: int = 5, index_path: str | None = None) -> DataFrame:
    """The best articles for each of ``questions`` (question_id, question).

    The articles' words are indexed first, at ``index_path`` or in a folder that
    goes as Python ends; see :mod:`search_index` for an index that stays.  A
    question without words finds all articles, as in :func:`search`.
    """
    index = search_index.build(articles, index_path or new_folder(articles.sparkSession, "index"), max(limit, 1))
    return search_index.search(index, questions, limit)


def topic(articles: DataFrame, name: str, topics: dict[str, tuple[str, str]] = TOPICS, fold: bool = False) -> DataFrame:
    """Articles on a topic; ``fold`` takes its pattern as a term whose accents don't count."""
    category, pattern = topics[name]
    titled = contains_ci(F.col("title"), pattern.strip("%"), fold=True) if fold else F.col("title").ilike(pattern)
    found = articles.where((F.col("category") == category) & F.col("is_active") & titled)
    return _first(found, None).select("id", F.col("title").alias("titulo"), F.col("content").alias("contenido"))


def frequent(articles: DataFrame, about: str | None = None, category: str = "faq", limit: int = 10) -> DataFrame:
    """Frequent questions, of those whose answer mentions ``about``."""
    found = articles.where((F.col("category") == category) & F.col("is_active"))
    if about:
        found = found.where(contains_ci(F.col("content"), about))
    return _first(found, limit).select("id", F.col("title").alias("pregunta"), F.col("content").alias("respuesta"))
