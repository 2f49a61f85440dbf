"""Quality classifier by gated attention over passages.

A document is a bag of passages of ``PASSAGE`` bytes.  Each is described by the
frequencies of pairs of neighbouring character classes, its length and the share
of words that repeat the word before, encoded by one layer,
and weighed by gated attention (tanh times sigmoid, soft-max over the bag);
the weighted sum of the encoded passages gives the document's score.  Encoder,
attention and output are trained together from document labels alone.

A text is described in stretches of ``AT_ONCE`` bytes; neighbours across the
edge of a stretch don't count as such.  Attention over a longer text keeps a
running maximum and running sums, so a text of any length takes the memory of a
stretch beside its own.

Training takes at most ``per_class`` documents of each label, those with the
smallest hash of their doc_id, and at most ``TRAIN_PASSAGES`` evenly spaced
passages of each; weights restore the labels' true proportion.  Scoring reads
every passage of every text.

Defined results: a null or empty text is one passage without characters, and is
scored; a document labelled several times has its lowest label; other labels
than 0 and 1 don't count; without labels of both kinds every score is the share
of label 1, or 0.5.  Inputs of a score are the text's characters and nothing
else.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import fresh, prefix_hash, runs_of, span_hash, text_of

PASSAGE, TRAIN_PASSAGES, AT_ONCE = 512, 48, 1 << 19
_SETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", "\t\v\f", ".", ",", "!", "?", "|", "#", "$%&*", "'\"`", "()[]{}<>", "-_/\\", "@+=~^", ":;")
CLASSES = len(_SETS) + 2
PAIRS = CLASSES * CLASSES
FEATURES = PAIRS + 2


def _class_of_byte() -> np.ndarray:
    out = np.full(256, len(_SETS), np.int64)
    out[128:] = len(_SETS) + 1
    for k, chars in enumerate(_SETS):
        out[np.frombuffer(chars.encode(), np.uint8)] = k
    return out


def passages(texts: list[str | bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all texts, and how many each text has."""
    classes = _class_of_byte()
    data = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(x) for x in data], np.int64)
    counts = np.maximum(1, -(-size // PASSAGE))
    total = int(counts.sum())
    cls = classes[np.frombuffer(b"".join(data), np.uint8)]
    start = np.concatenate(([0], np.cumsum(size)))[:-1]
    within = np.arange(cls.size) - np.repeat(start, size)
    owner = np.repeat(np.concatenate(([0], np.cumsum(counts)))[:-1], size) + within // PASSAGE
    # a pair belongs to the passage of its second byte; pairs don't cross texts
    pair = cls[1:] + CLASSES * cls[:-1]
    inside = within[1:] > 0
    grid = np.bincount(owner[1:][inside] * PAIRS + pair[inside], minlength=total * PAIRS).reshape(total, PAIRS)
    seen = grid.sum(axis=1, keepdims=True)
    x = np.empty((total, FEATURES), np.float32)
    x[:, :PAIRS] = np.sqrt(grid / np.maximum(1, seen))
    x[:, -2] = np.log1p(seen[:, 0]) / 8
    x[:, -1] = _repeats(b" ".join(data), size, owner, total)
    return x, counts


def _repeats(joined: bytes, size: np.ndarray, owner: np.ndarray, total: int) -> np.ndarray:
    """The share of each passage's words that equal the word before."""
    data = np.frombuffer(joined, np.uint8)
    solid = np.concatenate(([False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edges[0::2], edges[1::2]
    if not start.size:
        return np.zeros(total)
    words = span_hash(prefix_hash(data), start, end)
    # a text's bytes in ``joined`` are moved by the blanks between texts
    text = np.searchsorted(np.cumsum(size + 1), start, side="right")
    at = owner[start - text]
    same = np.concatenate(([False], (words[1:] == words[:-1]) & (text[1:] == text[:-1])))
    return np.bincount(at[same], minlength=total) / np.maximum(1, np.bincount(at, minlength=total))


def slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Runs of texts that are described at once; a text counts one passage at least."""
    return runs_of(texts, AT_ONCE, PASSAGE)


class Bags:
    """Sums and soft-max over runs of rows that belong to one document."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.start = counts, np.concatenate(([0], np.cumsum(counts)))[:-1]

    def sum(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.start, axis=0)

    def spread(self, x: np.ndarray) -> np.ndarray:
        return np.repeat(x, self.counts, axis=0)

    def softmax(self, x: np.ndarray) -> np.ndarray:
        e = np.exp(x - self.spread(np.maximum.reduceat(x, self.start)))
        return e / self.spread(self.sum(e))


def stretches(data: bytes) -> Iterator[bytes]:
    for lo in range(0, max(1, len(data)), AT_ONCE):
        yield data[lo : lo + AT_ONCE]


def some_passages(data: bytes, most: int) -> np.ndarray:
    """Features of at most so many evenly spaced passages of one text."""
    total = max(1, -(-len(data) // PASSAGE))
    picked = np.linspace(0, total - 1, most).astype(int) if total > most else np.arange(total)
    out, first = [], 0
    for stretch in stretches(data):
        x, _ = passages([stretch])
        out.append(x[picked[(picked >= first) & (picked < first + len(x))] - first])
        first += len(x)
    return np.concatenate(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def encoded(m: dict, x: np.ndarray) -> dict:
    """Encoded passages and, as ``l``, what the soft-max weighs them by."""
    s = {"h": np.tanh(x @ m["we"] + m["be"])}
    s["t"], s["g"] = np.tanh(s["h"] @ m["v"]), _sigmoid(s["h"] @ m["u"])
    s["l"] = (s["t"] * s["g"]) @ m["w"]
    return s


def forward(m: dict, x: np.ndarray, bags: Bags) -> dict:
    s = encoded(m, x)
    s["a"] = bags.softmax(s["l"])
    s["z"] = bags.sum(s["a"][:, None] * s["h"])
    s["p"] = _sigmoid(s["z"] @ m["c"] + m["b"])
    return s


def score_of(m: dict, data: bytes) -> float:
    """The score of one text, a stretch of it at a time."""
    top, total, z = -np.inf, 0.0, 0.0
    for stretch in stretches(data):
        x, counts = passages([stretch])
        s = encoded(m, (x - m["mean"]) / m["scale"])
        new = max(top, float(s["l"].max()))
        e = np.exp(s["l"] - new)
        total, z, top = total * np.exp(top - new) + e.sum(), z * np.exp(top - new) + e @ s["h"], new
    return float(_sigmoid(z / total @ m["c"] + m["b"])[0])


def backward(m: dict, x: np.ndarray, bags: Bags, s: dict, y: np.ndarray, weight: np.ndarray) -> dict:
    """Gradients of the weighted cross entropy."""
    d = weight * (s["p"] - y) / weight.sum()
    g = {"c": s["z"].T @ d, "b": np.array([d.sum()])}
    dz = bags.spread(d[:, None] * m["c"])
    da = (dz * s["h"]).sum(axis=1)
    ds = s["a"] * (da - bags.spread(bags.sum(s["a"] * da)))
    g["w"] = (s["t"] * s["g"]).T @ ds
    both = ds[:, None] * m["w"]
    dt, dg = both * s["g"] * (1 - s["t"] ** 2), both * s["t"] * s["g"] * (1 - s["g"])
    g["v"], g["u"] = s["h"].T @ dt, s["h"].T @ dg
    dh = (dz * s["a"][:, None] + dt @ m["v"].T + dg @ m["u"].T) * (1 - s["h"] ** 2)
    g["we"], g["be"] = x.T @ dh, dh.sum(axis=0)
    return g


def train(x: np.ndarray, counts: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 30, rate: float = 0.01, decay: float = 1e-4, batch: int = 128) -> dict:
    """Adam over mini-batches of documents, from a fixed seed.

    ``x`` may be of half floats; only a batch of it is widened at a time.
    """
    rng = np.random.default_rng(11)
    parts = lambda: (x[lo : lo + 8192].astype(np.float64) for lo in range(0, len(x), 8192))
    mean = sum(p.sum(axis=0) for p in parts()) / len(x)
    scale = np.sqrt(sum(((p - mean) ** 2).sum(axis=0) for p in parts()) / len(x)) + 0.02
    mean, scale = mean.astype(np.float32), scale.astype(np.float32)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    m = {"we": draw(x.shape[1], hidden), "be": np.zeros(hidden, np.float32), "v": draw(hidden, gate), "u": draw(hidden, gate), "w": draw(gate), "c": draw(hidden)}
    share = float((weight * y).sum() / weight.sum())
    m["b"] = np.array([np.log(share / (1 - share))], np.float32)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    start, step = np.concatenate(([0], np.cumsum(counts))), 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            picked = order[lo : lo + batch]
            rows = np.concatenate([np.arange(start[i], start[i + 1]) for i in picked])
            bags = Bags(counts[picked])
            seen = (x[rows].astype(np.float32) - mean) / scale
            grads = backward(m, seen, bags, forward(m, seen, bags), y[picked], weight[picked])
            step += 1
            lr = rate * (1 - epoch / epochs)
            for k, g in grads.items():
                a, b = moments[k]
                g = g + decay * m[k]
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                m[k] = (m[k] - lr * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return m | {"mean": mean, "scale": scale}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 2000) -> dict:
    """A model of ``label`` (0 or 1), from rows that aren't held out."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    totals = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return {"constant": float(next(iter(totals), 0.5))}
    some = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    # at most 2 * per_class rows of two numbers, whatever the input
    chosen = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(some[0].union(some[1])), "doc_id")
    # of the rows of one doc_id that with the least hash of its text, so a repeated doc_id is one document too
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    chosen = chosen.groupBy("doc_id").agg(F.min("y").alias("y"), least["text"].alias("text")).select("text", "y")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, y in zip(b.column("text").cast(pa.binary()), b.column("y").to_pylist()):
                x = some_passages(text.as_py(), TRAIN_PASSAGES)
                yield pa.RecordBatch.from_pydict({"y": [y], "x": [x.astype(np.float16).tobytes()]}, pa.schema([("y", pa.int32()), ("x", pa.binary())]))

    got = chosen.mapInArrow(describe, "y int, x binary").toArrow().sort_by([("y", "ascending"), ("x", "ascending")])
    if len(set(got["y"].to_pylist())) < 2:
        return {"constant": totals[1] / (totals[0] + totals[1])}
    xs = [np.frombuffer(v, np.float16).reshape(-1, FEATURES) for v in got["x"].to_pylist()]
    y = got["y"].to_numpy().astype(np.float32)
    weight = np.where(y == 1, totals[1] / max(1, (y == 1).sum()), totals[0] / max(1, (y == 0).sum())).astype(np.float32)
    return train(np.concatenate(xs), np.array([len(v) for v in xs]), y, weight)


def score(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """``keep`` columns of ``docs`` and, as ``name``, the score of each whole text."""
    if "constant" in model:
        return docs.select(*keep, F.lit(model["constant"]).alias(name))
    scored = fresh(docs, "_scored")
    columns = docs.select(*keep, text_of().alias(scored))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(scored)):
                b = batch.slice(lo, hi - lo)
                texts = b.column(scored).cast(pa.binary()).to_pylist()
                if len(texts[0]) > AT_ONCE:  # then it stands alone
                    p = np.array([score_of(model, texts[0])])
                else:
                    x, counts = passages(texts)
                    p = forward(model, (x - model["mean"]) / model["scale"], Bags(counts))["p"]
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(p.astype(np.float64))], names=[*keep, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema if f.name != scored)
    return columns.mapInArrow(run, f"{schema}, `{name}` double")
