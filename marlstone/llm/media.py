"""Media columns: ISO base media files, made and read without decoding.

``to_media`` stores bytes as the samples of one track: 8-bit grey frames 64
wide, of up to 64 lines, every ``KEY_EVERY``-th a sync sample, in chunks of
``CHUNK`` samples.  ``probe`` reads any such file: it walks the nested boxes
(32- and 64-bit sizes, and "to the end"), decodes the sample tables (stsd,
stts, stss, stsc, stsz, stco or co64) and gives the codec, the duration and the
byte ranges of keyframes and of all samples.  Payloads are never decoded.

Defined results: a null text is an empty one; a null file has null features; a
file that isn't one, is cut short or keeps its samples in fragments has the
feature ``error=...`` and no sample; rows with equal texts have equal values; an
empty table has no rows out; extra columns are ignored.  A task holds a text,
its file and one copy of either at a time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marlstone.llm.common import runs_of, text_of

AT_ONCE = 4 << 20  # bytes of text
WIDTH, LINES, KEY_EVERY, CHUNK, TICKS, FRAME_TICKS = 64, 64, 12, 8, 600, 25
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex"}


def padded(data: bytes) -> bytes:
    """``data`` and zero bytes, up to a positive multiple of 64."""
    return data + bytes(-len(data) % 64 or (0 if data else 64))


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def to_media(payload: bytes) -> bytes:
    """A file whose samples, in order, are the bytes of ``payload``."""
    frame = WIDTH * LINES
    n = -(-len(payload) // frame)
    sizes = np.full(n, frame, ">u4")
    sizes[-1] = len(payload) - frame * (n - 1)
    chunks = -(-n // CHUNK)
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    entry = struct.pack(">6xH16xHHIII H32sHh", 1, WIDTH, LINES, 0x480000, 0x480000, 0, 1, b"\x04grey".ljust(32, b"\0"), 8, -1)
    runs = [(1, CHUNK, 1)] if n >= CHUNK else []
    if n % CHUNK:
        runs.append((chunks, n % CHUNK, 1))
    ticks = n * FRAME_TICKS

    def moov(start: int) -> bytes:
        offsets = start + np.arange(chunks, dtype=np.int64) * frame * CHUNK
        wide = int(offsets[-1]) >= 1 << 32
        stbl = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), box(b"raw ", entry)),
            full(b"stts", struct.pack(">III", 1, n, FRAME_TICKS)),
            full(b"stss", struct.pack(">I", -(-n // KEY_EVERY)), np.arange(1, n + 1, KEY_EVERY).astype(">u4").tobytes()),
            full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            full(b"stsz", struct.pack(">II", 0, n), sizes.tobytes()),
            full(b"co64" if wide else b"stco", struct.pack(">I", chunks), offsets.astype(">u8" if wide else ">u4").tobytes()),
        )
        mdia = box(
            b"mdia",
            full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TICKS, ticks & 0xFFFFFFFF, 0x55C4, 0)),
            full(b"hdlr", struct.pack(">I4s12x", 0, b"vide"), b"text\0"),
            box(b"minf", full(b"vmhd", bytes(8), flags=1), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), stbl),
        )
        tkhd = full(b"tkhd", struct.pack(">IIIII8xHHHH", 0, 0, 1, 0, ticks & 0xFFFFFFFF, 0, 0, 0, 0), matrix, struct.pack(">II", WIDTH << 16, LINES << 16), flags=7)
        mvhd = full(b"mvhd", struct.pack(">IIIIIH10x", 0, 0, TICKS, ticks & 0xFFFFFFFF, 0x10000, 0x100), matrix, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    size = len(moov(0))  # the offsets' width may depend on the offsets
    while True:
        index = moov(len(head) + size + (8 if len(payload) + 8 < 1 << 32 else 16))
        if len(index) == size:
            return b"".join((head, index, box(b"mdat", payload)))
        size = len(index)


def boxes(data: memoryview, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Kind and body of each box between two positions."""
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            if start + 16 > end:
                raise ValueError("box header cut short")
            (size,), body = struct.unpack_from(">Q", data, start + 8), start + 16
        stop = end if size == 0 else start + size
        if stop < body or stop > end:
            raise ValueError(f"box {kind!r} leaves its parent")
        yield kind, body, stop
        start = stop
    if start != end:
        raise ValueError("bytes after the last box")


def _table(data: memoryview, at: int, end: int, dtype: str, skip: int = 0) -> np.ndarray:
    (n,) = struct.unpack_from(">I", data, at + 4 + skip)
    first = at + 8 + skip
    if first + n * np.dtype(dtype).itemsize > end:
        raise ValueError("table leaves its box")
    return np.frombuffer(data, dtype, n, first)


def _track(data: memoryview, start: int, end: int) -> dict:
    found: dict[bytes, tuple[int, int]] = {}

    def walk(lo: int, hi: int) -> None:
        for kind, a, b in boxes(data, lo, hi):
            found.setdefault(kind, (a, b))
            if kind in CONTAINERS:
                walk(a, b)

    walk(start, end)
    at, stop = found[b"stsd"]
    codec = bytes(data[at + 12 : at + 16]).decode("latin-1") if stop >= at + 16 else ""
    at, _ = found[b"mdhd"]
    ticks, duration = struct.unpack_from(">IQ", data, at + 20) if data[at] == 1 else struct.unpack_from(">II", data, at + 12)
    stts = _table(data, *found[b"stts"], np.dtype((">u4", 2)))
    at, stop = found[b"stsz"]
    fixed, n = struct.unpack_from(">II", data, at + 4)
    if n > len(data):
        raise ValueError("more samples than bytes")
    sizes = np.full(n, fixed, np.int64) if fixed else _table(data, at, stop, ">u4", skip=4).astype(np.int64)
    if b"stco" in found:
        chunks = _table(data, *found[b"stco"], ">u4").astype(np.int64)
    else:
        chunks = _table(data, *found[b"co64"], ">u8").astype(np.int64)
    runs = _table(data, *found[b"stsc"], np.dtype((">u4", 3))).astype(np.int64)
    if len(runs) and (runs[0, 0] != 1 or runs[:, 0].max() > len(chunks)):
        raise ValueError("a run of chunks isn't there")
    per_chunk = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(chunks) + 1))) if len(runs) else np.empty(0, np.int64)
    if per_chunk.sum() != n or len(per_chunk) != len(chunks):
        raise ValueError("chunks and samples don't agree")
    # a sample starts at its chunk, after the samples before it in that chunk
    chunk = np.repeat(np.arange(len(chunks)), per_chunk)
    before = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    first = np.concatenate(([0], np.cumsum(per_chunk)))[:-1]
    offset = chunks[chunk] + before - before[first[chunk]] if n else np.empty(0, np.int64)
    if n and (offset.min() < 0 or (offset + sizes).max() > len(data)):
        raise ValueError("a sample leaves the file")
    keys = _table(data, *found[b"stss"], ">u4").astype(np.int64) - 1 if b"stss" in found else np.arange(n)
    if keys.size and (keys.min() < 0 or keys.max() >= n):
        raise ValueError("a sync sample isn't there")
    timed = int((stts[:, 0].astype(np.int64) * stts[:, 1]).sum()) if len(stts) else 0
    return {"codec": codec, "timescale": int(ticks), "duration": max(int(duration), timed), "offset": offset, "size": sizes, "keys": keys}


def probe(data: bytes) -> list[dict]:
    """Codec, duration and byte ranges of each track; ValueError if broken."""
    view = memoryview(data)
    tracks = []
    try:
        for kind, a, b in boxes(view, 0, len(view)):
            if kind == b"moof":
                raise ValueError("samples are in fragments")
            if kind == b"moov":
                tracks += [_track(view, lo, hi) for k, lo, hi in boxes(view, a, b) if k == b"trak"]
    except (KeyError, struct.error, IndexError, OverflowError) as e:
        raise ValueError(f"missing or short box: {e}") from None
    return tracks


def samples(data: bytes, track: dict) -> bytes:
    """The stored bytes of a track's samples, in order."""
    return b"".join(data[o : o + s] for o, s in zip(track["offset"].tolist(), track["size"].tolist()))


def stored(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the file ``media`` that holds each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in runs_of(batch.column("text"), AT_ONCE, 4096):
                b = batch.slice(lo, hi - lo)
                data = b.column("text").cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) for x in data], pa.int64()), pa.array([to_media(padded(x)) for x in data], pa.binary())], names=["doc_id", "n_bytes", "media"])

    named = docs.select("doc_id", text_of().alias("text"))
    return named.mapInArrow(run, f"doc_id {named.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


TRACKS = "array<struct<codec:string,seconds:double,samples:bigint,keyframes:array<struct<start:bigint,end:bigint>>>>"


def described(media: DataFrame, keep: tuple[str, ...] = ("doc_id", "n_bytes")) -> DataFrame:
    """``keep`` columns and what the column ``media`` holds."""
    named = media.select(*keep, "media")
    extra = [
        ("payload_bytes", pa.int64()),
        ("payload_sha256", pa.string()),
        ("tail_crc32", pa.int64()),
        ("media_bytes", pa.int64()),
        ("media_sha256", pa.string()),
        ("feature", pa.string()),
        ("tracks", pa.list_(pa.struct([("codec", pa.string()), ("seconds", pa.float64()), ("samples", pa.int64()), ("keyframes", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))),
    ]

    def one(data: bytes | None) -> dict:
        if data is None:
            return {k: None for k, _ in extra}
        out = {"payload_bytes": None, "payload_sha256": None, "tail_crc32": None, "media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest(), "tracks": []}
        try:
            tracks = probe(data)
        except ValueError as e:
            return out | {"feature": f"error={e}"}
        for t in tracks:
            ends = t["offset"] + t["size"]
            out["tracks"].append({"codec": t["codec"], "seconds": t["duration"] / t["timescale"] if t["timescale"] else None, "samples": len(t["size"]), "keyframes": [{"start": a, "end": b} for a, b in zip(t["offset"][t["keys"]].tolist(), ends[t["keys"]].tolist())]})
        if not tracks:
            return out | {"feature": "error=no track"}
        payload, first = samples(data, tracks[0]), out["tracks"][0]
        ranges = ",".join(f"{k['start']}-{k['end']}" for k in first["keyframes"])
        feature = f"codec={first['codec'].strip()};ticks={tracks[0]['duration']}/{tracks[0]['timescale']};samples={first['samples']};keyframes={ranges}"
        return out | {"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-64:]), "feature": feature}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [one(x.as_py()) for x in b.column("media")]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *(pa.array([r[k] for r in rows], t) for k, t in extra)], names=[*keep, *(k for k, _ in extra)])

    schema = ", ".join(f"`{k}` {named.schema[k].dataType.simpleString()}" for k in keep)
    return named.mapInArrow(run, f"{schema}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, tracks {TRACKS}")
