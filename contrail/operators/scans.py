"""Operators whose rows depend on what was decided before: one pass over a track at a time, as grouped Arrow kernels.

A group is one track, an aircraft's day; kernels take its columns as lists in (t, seq) order.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.geo import KM_PER_DEGREE


def per_track(df: DataFrame, new: dict[str, str], kernel: Callable[[dict[str, list]], dict[str, list]], *reads: str, errors: bool = False) -> DataFrame:
    """df with the columns that kernel makes from the columns it reads, for each icao by itself. A column that df has is replaced.

    With errors a track that kernel fails on doesn't end the job: its new columns are null, and error, a further column, says
    why in the track's first row.
    """
    kinds = new | ({"error": "string"} if errors else {})
    fields = [f for f in df.schema.fields if f.name not in kinds]
    schema = T.StructType([*fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in kinds.items()]])
    kept = [f.name for f in fields]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("t", "ascending"), ("seq", "ascending")])
        n = table.num_rows
        try:
            made = kernel({c: table.column(c).to_pylist() for c in reads}) | {"error": [None] * n}
        except Exception as e:
            if not errors:
                raise
            made = {c: [None] * n for c in new} | {"error": [f"{type(e).__name__}: {e}"] + [None] * (n - 1)}
        out = table.select(kept)
        for c in kinds:
            out = out.append_column(c, pa.array(made[c], _ARROW[kinds[c]]))
        return out.cast(pa.schema([*[table.schema.field(c) for c in kept], *[pa.field(c, _ARROW[t]) for c, t in kinds.items()]]))

    return df.groupBy("icao").applyInArrow(run, schema)


_ARROW = {"boolean": pa.bool_(), "double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def _km(a: tuple[float, float], b: tuple[float, float]) -> float:
    north, east = (b[0] - a[0]) * KM_PER_DEGREE, (b[1] - a[1]) * KM_PER_DEGREE * math.cos(math.radians(a[0]))
    return math.sqrt(north * north + east * east)


def _ramp(alt: float, low_ft: float, high_ft: float, low: float, high: float) -> float:
    return low if alt <= low_ft else high if alt >= high_ft else low + (alt - low_ft) * (high - low) / (high_ft - low_ft)


def reachable(anchor: tuple[float, float, float], t: float, lat: float, lon: float, alt: float, cap_lo_ft=1000.0, cap_hi_ft=10000.0, low_kmh=555.0, high_kmh=1300.0) -> bool:
    """Whether a fix can follow anchor (t, lat, lon) at a speed that the fix's altitude allows; at the same time or before, within half a kilometre."""
    hours, dist = (t - anchor[0]) / 3600.0, _km(anchor[1:], (lat, lon))
    return dist / hours <= _ramp(alt, cap_lo_ft, cap_hi_ft, low_kmh, high_kmh) if hours > 0 else dist < 0.5


def whole_feet(baro: float | None, ground: bool) -> float:
    return 0.0 if ground or baro is None or baro != baro else float(int(baro))


def accepted(t, lat, lon, alt, **caps) -> list[bool]:
    """Which fixes can be reached from the last accepted one. The first is."""
    out: list[bool] = []
    anchor = None
    for fix in zip(t, lat, lon, alt):
        ok = anchor is None or reachable(anchor, *fix, **caps)
        anchor = fix[:3] if ok else anchor
        out.append(ok)
    return out


def speed_gate(df: DataFrame, **caps) -> DataFrame:
    """df with `accepted`. Where df has gate_ft, altitudes as the gate reads them, these count instead of the barometric ones."""

    def kernel(c):
        alt = list(map(whole_feet, c[feet], c["gnd"]))
        return {"accepted": accepted(c["t"], c["lat"], c["lon"], alt, **caps)}

    feet = "gate_ft" if "gate_ft" in df.columns else "baro"
    return per_track(df, {"accepted": "boolean"}, kernel, "t", "lat", "lon", feet, "gnd")


def far_enough(x, y, least_m: float = 1.0) -> list[bool]:
    """Which points are more than least_m from the last one taken. The first is taken."""
    out: list[bool] = []
    last = None
    for p in zip(x, y):
        ok = last is None or math.sqrt((p[0] - last[0]) * (p[0] - last[0]) + (p[1] - last[1]) * (p[1] - last[1])) > least_m
        last = p if ok else last
        out.append(ok)
    return out


def stationary_dedup(df: DataFrame, least_m: float = 1.0) -> DataFrame:
    """df, which has x and y in metres, with `moved`."""
    return per_track(df, {"moved": "boolean"}, lambda c: {"moved": far_enough(c["x"], c["y"], least_m)}, "x", "y")


def bucket_starts(t, width: float = 1.0) -> list[int]:
    """Each time's bucket number; a bucket begins at its first time and holds those less than width later."""
    out: list[int] = []
    start, n = None, -1
    for now in t:
        if start is None or now >= start + width:
            start, n = now, n + 1
        out.append(n)
    return out


def decimate(df: DataFrame, width: float = 1.0) -> DataFrame:
    """One sample for each bucket: means of what is known, on the ground by at least half, the last track angle and source. seq: the bucket's first.

    Means are sums in (t, seq) order, so they don't depend on how rows were dealt out or spilled."""
    means = ("t", "lat", "lon", "baro", "geom", "gs", "vr")
    kind = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([
        T.StructField("icao", kind["icao"]), T.StructField("bucket", T.LongType()), T.StructField("seq", kind["seq"]), *[T.StructField(c, T.DoubleType()) for c in means],
        T.StructField("gnd", T.BooleanType()), T.StructField("trk", kind["trk"]), T.StructField("src", kind["src"]), T.StructField("merged", T.LongType()),
    ])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("t", "ascending"), ("seq", "ascending")])
        bucket = np.array(bucket_starts(table.column("t").to_pylist(), width))
        n = np.bincount(bucket)
        last = pa.array(np.cumsum(n) - 1)

        def sums(c: str) -> tuple[np.ndarray, np.ndarray]:
            """Of each bucket the sum of what is known, one row after the other, and how many are."""
            x = table.column(c).cast(pa.float64()).combine_chunks()
            known = pc.is_valid(x).to_numpy(zero_copy_only=False)
            return np.bincount(bucket[known], x.drop_null().to_numpy(), len(n)), np.bincount(bucket[known], minlength=len(n))

        out = {"icao": table.column("icao").take(last), "bucket": np.arange(len(n))}
        out["seq"] = pa.table({"bucket": bucket, "seq": table.column("seq")}).group_by("bucket", use_threads=False).aggregate([("seq", "min")]).column("seq_min")
        for c in means:
            total, known = sums(c)
            out[c] = pa.array(total / np.maximum(known, 1), mask=known == 0, from_pandas=False)
        ground, known = sums("gnd")
        out["gnd"] = pa.array(ground * 2 >= n, mask=known == 0)
        return pa.table(out | {c: table.column(c).take(last) for c in ("trk", "src")} | {"merged": n})

    return df.select("icao", "seq", *means, "gnd", "trk", "src").groupBy("icao").applyInArrow(run, schema)


def despiked(t, alt, ground, off_ft: float = 400.0, flank_ft: float = 400.0, span_s: float = 30.0, longest: int = 2) -> list[float | None]:
    """Altitudes with runs of up to `longest` airborne samples straightened that jump off two agreeing flanks and come back."""
    known = [i for i, a in enumerate(alt) if a is not None]
    out = list(alt)
    k = 1
    while k < len(known) - 1:
        for n in range(1, min(longest, len(known) - 1 - k) + 1):
            left, right, inner = known[k - 1], known[k + n], known[k : k + n]
            a, b, span = alt[left], alt[right], t[right] - t[left]
            agree = abs(a - b) < flank_ft and span <= span_s and not any(ground[i] for i in inner)
            if agree and min(min(abs(alt[i] - a), abs(alt[i] - b)) for i in inner) > off_ft:
                for i in inner:
                    out[i] = float(round(a + (b - a) * (t[i] - t[left]) / (span or 1)))
                k += n
                break
        k += 1
    return out


def altitude_despike(df: DataFrame, alt: str = "alt", **limits) -> DataFrame:
    """df with `repaired`: alt after despiked."""
    return per_track(df, {"repaired": "double"}, lambda c: {"repaired": despiked(c["t"], c[alt], c["gnd"], **limits)}, "t", alt, "gnd")
