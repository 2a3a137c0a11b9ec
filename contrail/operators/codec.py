"""Compact bytes for tracks: differences as zig-zag variable-length integers, then gzip without a time stamp."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed value: how an archive of one track begins.
MAGIC = b"TZ01"


def zigzag(v: np.ndarray) -> np.ndarray:
    v = np.asarray(v, dtype=np.int64)
    return ((v << 1) ^ (v >> 63)).astype(np.uint64)


def unzigzag(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.uint64)
    return (v >> np.uint64(1)).astype(np.int64) ^ -(v & np.uint64(1)).astype(np.int64)


def pack(v: np.ndarray) -> bytes:
    """Unsigned integers as groups of seven bits, the lowest first; the high bit says that more follow."""
    v = np.asarray(v, dtype=np.uint64)
    if not len(v):
        return b""
    groups = np.stack([(v >> np.uint64(7 * k)) & np.uint64(127) for k in range(10)], axis=1).astype(np.uint8)
    n = np.maximum(1, 10 - (groups[:, ::-1] != 0).argmax(axis=1) * (groups != 0).any(axis=1) - 9 * ~(groups != 0).any(axis=1))
    place = np.arange(10)
    groups[place < (n - 1)[:, None]] |= 128
    return groups[place < n[:, None]].tobytes()


def unpack(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    if not len(b):
        return np.empty(0, dtype=np.uint64)
    starts = np.concatenate(([0], np.flatnonzero(b < 128)[:-1] + 1))
    place = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
    return np.add.reduceat((b & 127).astype(np.uint64) << (7 * place).astype(np.uint64), starts)


def encode(rows: np.ndarray) -> bytes:
    """rows: whole numbers (t, lat, lon, alt), one line a point."""
    rows = np.asarray(rows, dtype=np.int64).reshape(-1, 4)
    return gzip.compress(pack(zigzag(np.diff(rows, axis=0, prepend=np.zeros((1, 4), dtype=np.int64)).ravel())), 9, mtime=0)


def decode(blob: bytes) -> np.ndarray:
    """The rows that encode had."""
    return np.cumsum(unzigzag(unpack(gzip.decompress(blob))).reshape(-1, 4), axis=0)


def blobs(points: DataFrame) -> DataFrame:
    """icao, n_points, blob (with its magic) of tracks with whole-number columns t, lat, lon, alt; null altitudes are 0."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("t", "ascending"), ("seq", "ascending")])
        rows = np.array([np.array(table.column(c).fill_null(0).to_pylist(), dtype=np.int64) for c in ("t", "lat", "lon", "alt")]).T
        return pa.table({"icao": table.column("icao")[:1].cast(pa.string()), "n_points": pa.array([len(rows)], pa.int64()), "blob": pa.array([MAGIC + encode(rows)], pa.binary())})

    return points.select("icao", "t", "seq", "lat", "lon", "alt").groupBy("icao").applyInArrow(run, "icao string, n_points long, blob binary")


def points(archive: DataFrame) -> DataFrame:
    """icao, seq, t, lat, lon, alt of every point of blobs(); a blob without the magic is an error."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for icao, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if blob[:4] != MAGIC:
                    raise ValueError(f"{icao}: not a track archive")
                r = decode(blob[4:])
                yield pa.record_batch({"icao": pa.array([icao] * len(r), pa.string()), "seq": pa.array(np.arange(len(r))), **{c: pa.array(r[:, k]) for k, c in enumerate(("t", "lat", "lon", "alt"))}})

    return archive.select("icao", "blob").mapInArrow(run, "icao string, seq long, t long, lat long, lon long, alt long")


def verified(original: DataFrame, archive: DataFrame, scale: float = 1e5) -> DataFrame:
    """icao, n_in, n_out, ordered (times never fall) and in_bounds of every track of an archive, decoded again: of all of them, not of a sample."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    back = points(archive).withColumn("before", F.lag("t").over(Window.partitionBy("icao").orderBy("seq")))
    inside = (F.abs("lat") <= 90 * scale) & (F.abs("lon") <= 180 * scale)
    found = back.groupBy("icao").agg(F.count("*").alias("n_out"), F.bool_and(F.coalesce(F.col("t") >= F.col("before"), F.lit(True))).alias("ordered"), F.bool_and(inside).alias("in_bounds"))
    return original.groupBy("icao").agg(F.count("*").alias("n_in")).join(found, "icao", "left")


#: Steps of half a metre for handles, of 25 feet for altitudes.
HANDLE_M, ALT_FT = 0.5, 25.0
NONE, AS_PREDICTED, RESIDUAL = 0, 1, 2


def predicted(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Handles that a smooth curve would have: along the chord between a node's neighbours, a third of the way to the next."""
    back = np.concatenate((nodes[:1], nodes[:-1]))
    ahead = np.concatenate((nodes[1:], nodes[-1:]))
    d = ahead - back
    n = np.hypot(d[:, 0], d[:, 1])[:, None]
    d = np.divide(d, n, out=np.zeros_like(d), where=n > 0)
    third = [np.hypot(*(x - nodes).T)[:, None] / 3 for x in (back, ahead)]
    return nodes - d * third[0], nodes + d * third[1]


def residuals(nodes: np.ndarray, handles: np.ndarray, predict: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(there, off): which handles there are, and what they differ from a smooth curve's by, or from their nodes, in whole steps."""
    base = np.stack(predicted(nodes), axis=1) if predict else np.repeat(nodes[:, None], 2, axis=1)
    there = ~np.isnan(handles[:, :, 0])
    return there, np.rint(np.where(there[:, :, None], handles - base, 0) / HANDLE_M).astype(np.int64)


def encode_nodes(fixed: np.ndarray, cusp: np.ndarray, nodes: np.ndarray, handles: np.ndarray, predict: bool) -> bytes:
    """fixed: whole numbers (lat, lon, alt in 25 ft steps); nodes: metres; handles: (n, 2, 2) in and out, NaN where there is none.
    With predict only what the handles differ from a smooth curve's is kept."""
    n = len(nodes)
    there, off = residuals(nodes, handles, predict)
    steps = zigzag(np.diff(fixed, axis=0, prepend=np.zeros((1, 3), dtype=np.int64)))
    out: list[int] = []
    for i in range(n):
        out += steps[i].tolist()
        for k in (0, 1):
            exact = predict and not off[i, k].any()
            out.append(NONE if not there[i, k] else AS_PREDICTED if exact else RESIDUAL)
            if there[i, k] and not exact:
                out += zigzag(off[i, k]).tolist()
    return gzip.compress(pack(np.array([n])) + np.packbits(cusp, bitorder="little").tobytes() + pack(np.array(out, dtype=np.uint64)), 9, mtime=0)


def decode_nodes(blob: bytes, metres, predict: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fixed, cusp, handles); metres gives the nodes in metres from fixed."""
    data = gzip.decompress(blob)
    head = next(k for k, b in enumerate(data) if b < 128) + 1
    n = int(unpack(data[:head])[0])
    bits = -(-n // 8)
    cusp = np.unpackbits(np.frombuffer(data[head : head + bits], dtype=np.uint8), bitorder="little")[:n].astype(bool)
    v = unpack(data[head + bits :])
    z, at = unzigzag(v).tolist(), 0
    steps, tags, off = np.zeros((n, 3), dtype=np.int64), np.zeros((n, 2), dtype=int), np.zeros((n, 2, 2))
    for i in range(n):
        steps[i] = z[at : at + 3]
        at += 3
        for k in (0, 1):
            tags[i, k] = v[at]
            at += 1
            if tags[i, k] == RESIDUAL:
                off[i, k] = z[at : at + 2]
                at += 2
    fixed = np.cumsum(steps, axis=0)
    nodes = metres(fixed)
    base = np.stack(predicted(nodes), axis=1) if predict else np.repeat(nodes[:, None], 2, axis=1)
    return fixed, cusp, np.where((tags == NONE)[:, :, None], np.nan, base + off * HANDLE_M)
