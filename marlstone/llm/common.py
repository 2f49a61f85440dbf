"""What the operators share: tables, durable cut points, word hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words everywhere are maximal runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only on one machine (tests, a laptop) one is made where none is named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="spark-"))
        named = _local[0]
    return named


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """``name`` has ``value`` in here, and afterwards what it had."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: Spark then drops a job's shuffle files as the job ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: set[str] = set()
_local: list[str] = []


def new_path(spark: SparkSession, name: str = "cut") -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.add(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Later jobs neither repeat the work nor depend on the executors that did it.
    What is left of such folders goes as Python ends; see :func:`drop`.
    """
    spark = df.sparkSession
    path = new_path(spark)
    write_cut(df, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def write_cut(df: DataFrame, path: str, mode: str = "error") -> None:
    with setting(df.sparkSession, CLEANUP, "true"):
        df.write.mode(mode).option("compression", "zstd").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in there.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(there)]


def drop(*cuts: DataFrame) -> None:
    """Deletes what :func:`durable` wrote for these, once nothing reads them any more."""
    for cut in cuts:
        remove(cut.sparkSession, cut.cut_path)


def remove(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)
    _written.discard(path)


@atexit.register
def _remove_all() -> None:
    spark = SparkSession.getActiveSession()
    for path in list(_written) if spark else []:
        with suppress(Exception):  # the session may have ended
            remove(spark, path)


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """What operators write to the shared folder in here goes at its end.

    Results must be written or collected inside: they may read such files.  One
    thread at a time.
    """
    before = set(_written)
    try:
        yield
    finally:
        for path in _written - before:
            remove(spark, path)


def runs_of(texts: pa.Array, at_once: int, least: int = 1) -> list[tuple[int, int]]:
    """Runs of texts of at most ``at_once`` bytes, or of one text.

    A text counts ``least`` bytes at least.
    """
    out, lo, held = [], 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        size = max(size, least)
        if held and held + size > at_once:
            out.append((lo, i))
            lo, held = i, 0
        held += size
    return [*out, (lo, len(texts))] if len(texts) else out


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with so many underscores before it that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(name: str = "text") -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and its inverse for i < n, modulo 2**64."""
    if _POWERS.get("up", np.empty(0)).size < n:
        m = max(n, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        for key, base in (("up", _BASE), ("down", inverse)):
            out = np.full(m, base, np.uint64)
            out[0] = 1
            _POWERS[key] = np.multiply.accumulate(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] the polynomial of data[:i]; see :func:`span_hash`."""
    up, _ = powers(data.size)
    out = np.zeros(data.size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), equal for equal bytes."""
    _, down = powers(prefix.size)
    raw = (prefix[end] - prefix[start]) * down[start]
    return mix64(raw + (end - start).astype(np.uint64) * _MUL)
