"""Whole-track plans: thinning (compress), curve nodes (fit), smoothing, and checks of what they give.

Windows and the airport lookup come first, then one grouped kernel for what is sequential or iterative, so a plan
moves the samples once to bring a track's rows together, plus once for the decimation's means.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import geo
from contrail.operators import bezier, codec, curves, kalman, scans, thinning
from contrail.operators import sequence as seq
from contrail.operators.nearest import nearest_airport, surface_snap
from contrail.operators.quantiles import at_ranks, between, interpolated


def _xy(lat, lon) -> np.ndarray:
    lat, lon = np.array(lat, dtype=np.float64), np.array(lon, dtype=np.float64)
    return np.stack((lon * geo.M_PER_DEGREE * np.cos(np.radians(lat.mean())), lat * geo.M_PER_DEGREE), axis=1)


def reversal_places(t, lat, lon, ground, gs, jitter_m=30.0, step_m=8.0, share=0.5, gap_s=600.0, stop_kt=1.5) -> np.ndarray:
    """Places of ground points that stick out of their neighbours on the ground, as in sequence.ground_reversals."""
    at = np.flatnonzero(ground)
    if len(at) < 3:
        return at[:0]
    y, x, now = np.array(lat)[at], np.array(lon)[at], np.array(t)[at]
    speed = np.array([np.nan if v is None else v for v in np.array(gs, dtype=object)[at]], dtype=np.float64)

    def metres(i, j):
        return np.hypot((y[j] - y[i]) * geo.KM_PER_DEGREE, (x[j] - x[i]) * geo.KM_PER_DEGREE * np.cos(np.radians(y[i]))) * 1000

    a, b, c = np.arange(len(at) - 2), np.arange(1, len(at) - 1), np.arange(2, len(at))
    step, across = np.maximum(metres(a, b), metres(b, c)), metres(a, c)
    out = np.where(speed[b] < stop_kt, across < step, (step < jitter_m) & (across < share * step))
    return at[b[(now[c] - now[a] <= gap_s) & (step > step_m) & out]]


def day_key(df: DataFrame, date: str = "date") -> DataFrame:
    """df with its column date put into icao, so that an aircraft's day is a track of its own for every plan; icao holds no line end."""
    return df.withColumn("icao", F.concat_ws("\n", "icao", F.col(date).cast("string"))).drop(date)


def by_day(plan: Callable[..., DataFrame], samples: DataFrame, *more, date: str = "date", **options) -> DataFrame:
    """plan over samples of several days, told apart by their column date, which the result has beside icao."""
    part = F.split("icao", "\n", 2)
    return plan(day_key(samples, date), *more, **options).withColumns({"icao": part[0], date: part[1]})


def gated(samples: DataFrame, speed: dict[str, float] | None = None, jump: dict[str, float] | None = None) -> DataFrame:
    """Samples that pass the speed gate and the spike gate. speed: cap_lo_ft, cap_hi_ft, low_kmh, high_kmh; jump: cap_lo_ft, cap_hi_ft, low_km, high_km."""
    return seq.spike_gate(scans.speed_gate(samples, **(speed or {})).where("accepted"), **(jump or {})).where("not spike").drop("accepted", "spike")


def _chosen(r: DataFrame, keep: str, errors: bool) -> DataFrame:
    """The rows that a kernel kept and, with errors, one row of each track that it failed on."""
    return r.where(F.col(keep) | F.col("error").isNotNull()) if errors else r.where(keep)


def levelled(
    samples: DataFrame, airports: DataFrame | None = None, denoise: bool = True, speed: dict[str, float] | None = None,
    jump: dict[str, float] | None = None, parked: dict[str, float] | None = None,
) -> DataFrame:
    """Samples as thinning takes them: gated, parked runs merged, on one datum, at the field's elevation on the ground."""
    r = gated(samples, speed, jump)
    r = seq.parked(r, **(parked or {})).drop("merged") if denoise else r
    whole_feet = {c: F.col(c).cast("long").cast("double") for c in ("baro", "geom")}
    r = seq.datum(seq.long_enough(r, 2).withColumns(whole_feet))
    r = r.withColumn("alt", F.when(F.col("geom").isNull(), F.rint("alt")).otherwise(F.col("alt"))).withColumn("alt", F.when(~F.col("gnd"), F.col("alt")))
    return surface_snap(r, airports) if airports is not None else r


def compress(
    samples: DataFrame, airports: DataFrame | None = None, denoise: bool = True, speed: dict[str, float] | None = None,
    jump: dict[str, float] | None = None, parked: dict[str, float] | None = None, errors: bool = False, **limits,
) -> DataFrame:
    """icao, seq, t (whole seconds), lat, lon (hundred-thousandths), alt (feet), on_ground: the thinned track.

    Gates, parked runs, one altitude datum, field elevations, then in one kernel despiking, thinning across and up, reversals,
    and both again on what is kept. Of rows in one second the last stays. speed and jump: of the gates; parked: gs_kt and radius_m; limits: those of
    thinning. errors: see per_track; a track that fails has one row, with error.
    """
    r = levelled(samples, airports, denoise, speed, jump, parked)

    def kernel(c):
        t, ground = c["t"], np.array(c["gnd"], dtype=bool)
        alt = scans.despiked(t, c["alt"], ground)
        xy = _xy(c["lat"], c["lon"])
        keep = thinning.thinned(t, xy[:, 0], xy[:, 1], [a or 0.0 for a in alt], ground, **limits)
        keep[reversal_places(t, c["lat"], c["lon"], ground, c["gs"])] = False
        keep[[0, -1]] = True
        at = np.flatnonzero(keep)
        for i, a in zip(at, scans.despiked([t[i] for i in at], [alt[i] for i in at], ground[at])):
            alt[i] = a
        keep[at[reversal_places(np.array(t)[at], np.array(c["lat"])[at], np.array(c["lon"])[at], ground[at], np.array(c["gs"], dtype=object)[at])]] = False
        keep[[0, -1]] = True
        return {"keep": keep.tolist(), "alt": alt}

    r = scans.per_track(r, {"keep": "boolean", "alt": "double"}, kernel, "t", "lat", "lon", "alt", "gnd", "gs", errors=errors)
    return _thinned(_chosen(r, "keep", errors), errors)


def _thinned(r: DataFrame, errors: bool) -> DataFrame:
    r = seq.last_of_second(r, F.rint("t").cast("int"))
    return r.select(
        "icao", "seq", F.rint("t").cast("int").alias("t"), geo.encode("lat").alias("lat"), geo.encode("lon").alias("lon"),
        F.rint("alt").cast("int").alias("alt"), F.col("gnd").alias("on_ground"), *(["error"] if errors else []),
    )


def counts(samples: DataFrame, kept: DataFrame) -> DataFrame:
    """icao, n_orig, n_kept, n_rejected (not passed by the gates)."""
    a = samples.groupBy("icao").agg(F.count("*").alias("n_orig"))
    b = kept.groupBy("icao").agg(F.count("*").alias("n_kept"))
    g = gated(samples).groupBy("icao").agg(F.count("*").alias("n_gated"))
    return a.join(b, "icao", "left").join(g, "icao", "left").select(
        "icao", "n_orig", F.coalesce("n_kept", F.lit(0)).alias("n_kept"), (F.col("n_orig") - F.coalesce("n_gated", F.lit(0))).alias("n_rejected"),
    )


def prepared(samples: DataFrame, airports: DataFrame | None) -> DataFrame:
    """Samples as the fit needs them: one a second, stops snapped, one datum, field elevation on the ground."""
    r = seq.long_enough(seq.stationary_snap(scans.decimate(samples)), 3)
    r = seq.datum(r)
    if airports is None:
        return r.withColumn("elev", F.lit(None).cast("double"))
    r = nearest_airport(r, airports, "elev", "elev")
    return r.withColumn("elev", F.when(F.col("gnd"), F.col("elev").cast("double")))


def _held(elev: list, ground: np.ndarray) -> list:
    """Each ground run's most frequent elevation where there is one; the one seen first among equals."""
    out, i = list(elev), 0
    while i < len(elev):
        j = i
        while j < len(elev) and ground[j] == ground[i]:
            j += 1
        known = [e for e in elev[i:j] if e is not None] if ground[i] else []
        if known:
            top = max(dict.fromkeys(known), key=known.count)
            out[i:j] = [top if e is not None else None for e in elev[i:j]]
        i = j
    return out


def _track(c: dict, least_m: float):
    """The points of a track that moved: places in it, metres, altitudes with held elevations, ground."""
    xy = _xy(c["lat"], c["lon"])
    at = np.flatnonzero(scans.far_enough(xy[:, 0].tolist(), xy[:, 1].tolist(), least_m))
    ground = np.array(c["gnd"], dtype=bool)[at]
    elev = _held([c["elev"][i] for i in at], ground)
    alt = np.array([e if e is not None else (c["alt"][i] or 0.0) for i, e in zip(at, elev)])
    return at, xy[at], alt, ground


def fit(samples: DataFrame, airports: DataFrame | None = None, ground_m: float = 2.0, cruise_m: float = 150.0, degrees: float = 35.0, errors: bool = False) -> DataFrame:
    """nodes: icao, seq, t (tenths of a second), lat, lon, alt, on_ground, cusp. The curve through them, broken at cusps, stays
    within each thinned point's tolerance. errors: see per_track; a track that fails has one row, with error."""

    def kernel(c):
        n = len(c["t"])
        out = {"node": [False] * n, "cusp": [False] * n, "node_alt": [None] * n}
        at, xy, alt, ground = _track(c, 1.0)
        if len(at) >= 3:
            tol = thinning.ramp(alt, 500.0, 12000.0, ground_m, cruise_m)
            nodes, cusp = curves.fit(xy, tol, ground, degrees)
            for k, b in zip(nodes, cusp):
                out["node"][at[k]], out["cusp"][at[k]], out["node_alt"][at[k]] = True, bool(b), float(alt[k])
        return out

    r = scans.per_track(prepared(samples, airports), {"node": "boolean", "cusp": "boolean", "node_alt": "double"}, kernel, "t", "lat", "lon", "alt", "elev", "gnd", errors=errors)
    return _chosen(r, "node", errors).select(
        "icao", "seq", F.rint(F.col("t") * 10).cast("int").alias("t"), geo.encode("lat").alias("lat"), geo.encode("lon").alias("lon"),
        F.rint("node_alt").cast("int").alias("alt"), F.col("gnd").alias("on_ground"), "cusp", *(["error"] if errors else []),
    )


def _unthinned(samples: DataFrame, airports: DataFrame | None, least: int = 3) -> DataFrame:
    """Samples of tracks of `least` points and more on one datum, with elev: the field's elevation on the ground."""
    r = seq.datum(seq.long_enough(samples, least))
    if airports is None:
        return r.withColumn("elev", F.lit(None).cast("double"))
    return nearest_airport(r, airports, "elev", "elev").withColumn("elev", F.when(F.col("gnd"), F.col("elev").cast("double")))


def _bezier(table: pa.Table, ground_m: float, cruise_m: float, degrees: float):
    """(places in the sorted table, metres, altitudes, nodes among them, cusp, handles, metres to a degree east); None for tracks of less than three points."""
    c = {n: table.column(n).to_pylist() for n in ("lat", "lon", "alt", "elev", "gnd")}
    at, xy, alt, ground = _track(c, 1.5)
    if len(at) < 3:
        return None
    k, cusp, handles = bezier.nodes(xy, thinning.ramp(alt, 500.0, 12000.0, ground_m, cruise_m), ground, degrees)
    return at, xy, alt, k, cusp, handles, geo.M_PER_DEGREE * np.cos(np.radians(np.mean(c["lat"])))


def bezier_nodes(samples: DataFrame, airports: DataFrame | None = None, ground_m: float = 2.0, cruise_m: float = 150.0, degrees: float = 35.0) -> DataFrame:
    """icao, n_nodes, n_points, naive_bytes, predicted_bytes, worst_handle_m: Bezier fits of unthinned tracks and their codecs' sizes."""
    schema = "icao string, n_points long, n_nodes long, naive_bytes long, predicted_bytes long, worst_handle_m double"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("t", "ascending"), ("seq", "ascending")])
        rows = []
        if (fitted := _bezier(table, ground_m, cruise_m, degrees)) is not None:
            at, xy, alt, k, cusp, handles, kx = fitted
            fixed = np.rint(np.stack((xy[k, 1] / geo.M_PER_DEGREE * geo.SCALE, xy[k, 0] / kx * geo.SCALE, alt[k] / codec.ALT_FT), axis=1)).astype(np.int64)

            def metres(f):
                return np.stack((f[:, 1] / geo.SCALE * kx, f[:, 0] / geo.SCALE * geo.M_PER_DEGREE), axis=1)

            sizes, off = [], 0.0
            for predict in (False, True):
                blob = codec.encode_nodes(fixed, cusp, metres(fixed), handles, predict)
                sizes.append(len(blob))
                off = max(off, float(np.nanmax(np.abs(codec.decode_nodes(blob, metres, predict)[2] - handles))))
            rows.append((table.column("icao")[0].as_py(), len(at), len(k), *sizes, off))
        return pa.table(
            [pa.array(list(x), t) for x, t in zip(zip(*rows) if rows else [[]] * 6, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
            names=["icao", "n_points", "n_nodes", "naive_bytes", "predicted_bytes", "worst_handle_m"],
        )

    return _unthinned(samples, airports).groupBy("icao").applyInArrow(run, schema)


def bezier_columns(samples: DataFrame, airports: DataFrame | None = None, ground_m: float = 2.0, cruise_m: float = 150.0, degrees: float = 35.0) -> DataFrame:
    """One row a node of the Bezier fit: icao, seq, t (whole seconds), lat, lon, alt, on_ground, cusp, has_in, has_out, and in half metres what its
    handles differ by from those of a smooth curve: hin_dx, hin_dy, hout_dx, hout_dy, 0 where there is no handle."""
    schema = "icao string, seq long, t int, lat int, lon int, alt int, on_ground boolean, cusp boolean, has_in boolean, has_out boolean, hin_dx int, hin_dy int, hout_dx int, hout_dy int"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), *[pa.int32()] * 4, *[pa.bool_()] * 4, *[pa.int32()] * 4]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("t", "ascending"), ("seq", "ascending")])
        columns = [[] for _ in names]
        if (fitted := _bezier(table, ground_m, cruise_m, degrees)) is not None:
            at, xy, alt, k, cusp, handles, kx = fitted
            own = table.take(pa.array(at[k]))
            there, off = codec.residuals(xy[k], handles)
            place = np.rint(np.stack((xy[k, 1] / geo.M_PER_DEGREE, xy[k, 0] / kx)) * geo.SCALE)
            columns = [
                own.column("icao"), own.column("seq"), np.trunc(own.column("t").to_numpy()), *place, np.rint(alt[k]), own.column("gnd"), cusp,
                there[:, 0], there[:, 1], *off.reshape(len(k), 4).T,
            ]
        return pa.table([pa.array(c).cast(t) if not isinstance(c, pa.ChunkedArray) else c.cast(t) for c, t in zip(columns, kinds)], names=names)

    return _unthinned(samples, airports).groupBy("icao").applyInArrow(run, schema)


def smooth(
    samples: DataFrame, airports: DataFrame | None = None, ground_m: float = 5.0, settings: kalman.Settings = kalman.Settings(), errors: bool = False,
    **limits,
) -> DataFrame:
    """icao, seq, t (whole seconds), lat, lon, alt, on_ground: the smoothed track, thinned. errors: see per_track; a track that fails has
    one row, with error."""
    r = _unthinned(samples, airports, 2)

    def kernel(c):
        lat, lon, alt = kalman.smooth(c["t"], c["lat"], c["lon"], c["gnd"], c["alt"], c["elev"], c["gs"], c["trk"], c["vr"], c["src"], settings)
        xy = _xy(lat, lon)
        keep = thinning.thinned(np.rint(c["t"]), xy[:, 0], xy[:, 1], np.rint(alt), np.array(c["gnd"]), ground_m=ground_m, **limits)
        return {"lat": lat.tolist(), "lon": lon.tolist(), "alt": alt.tolist(), "keep": keep.tolist()}

    new = {"lat": "double", "lon": "double", "alt": "double", "keep": "boolean"}
    r = scans.per_track(r, new, kernel, "t", "lat", "lon", "gnd", "alt", "elev", "gs", "trk", "vr", "src", errors=errors)
    return _thinned(_chosen(r, "keep", errors), errors)


def errors(t, xy: np.ndarray, alt, ground, keep, mode: str, low_ft: float = 3000.0) -> np.ndarray:
    """Metres from each point to the kept points' path at its time: straight lines (linear), curves (catmull), or curves only where an
    end is on the ground or low (segment)."""
    t, kept = np.asarray(t, dtype=np.float64), np.flatnonzero(keep)
    if len(kept) < 2:
        return np.hypot(*(xy - xy[kept[0]]).T)
    j = np.clip(np.searchsorted(kept, np.arange(len(t)), "right") - 1, 0, len(kept) - 2)
    a, b = kept[j], kept[j + 1]
    span = t[b] - t[a]
    u = np.clip(np.divide(t - t[a], span, out=np.zeros(len(t)), where=span > 0), 0, 1)[:, None]
    path = xy[a] + (xy[b] - xy[a]) * u
    if mode != "linear":
        low = np.asarray(ground, dtype=bool) | (np.asarray(alt, dtype=np.float64) < low_ft)
        nodes = np.concatenate((kept[:1], kept, kept[-1:]))
        for k in np.unique(j):
            if mode == "catmull" or low[kept[k]] or low[kept[k + 1]]:
                here = j == k
                path[here] = curves.curve(*xy[nodes[k : k + 4]], u[here, 0])
    return np.hypot(*(path - xy).T)


def analyse(samples: DataFrame, mode: str = "segment", speed: dict[str, float] | None = None, jump: dict[str, float] | None = None, **limits) -> DataFrame:
    """One row a track: points, kept, rejected, keep_pct, comp_bytes, and for each phase the number of points, the error at rank
    floor(0.95 (n - 1)) and the largest. Without datum, elevations or denoising."""
    r = seq.long_enough(gated(seq.long_enough(samples, 2), speed, jump), 2)
    schema = "icao string, kept long, gated long, comp_bytes long, " + ", ".join(f"{p}_n long, {p}_p95 double, {p}_max double" for p in ("ground", "low", "high"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("t", "ascending"), ("seq", "ascending")])
        c = {n: table.column(n).to_pylist() for n in ("t", "lat", "lon", "baro", "gnd")}
        ground = np.array(c["gnd"], dtype=bool)
        alt = np.array([0.0 if g or b is None else float(int(b)) for b, g in zip(c["baro"], ground)])
        xy = _xy(c["lat"], c["lon"])
        keep = thinning.thinned(c["t"], xy[:, 0], xy[:, 1], alt, ground, **limits)
        off = errors(c["t"], xy, alt, ground, keep, mode)
        blob = codec.encode(np.stack((np.rint(c["t"]), np.rint(np.array(c["lat"]) * geo.SCALE), np.rint(np.array(c["lon"]) * geo.SCALE), alt), axis=1)[keep])
        row = [table.column("icao")[0].as_py(), int(keep.sum()), len(alt), len(blob)]
        for part in (ground, ~ground & (alt < 3000), ~ground & (alt >= 3000)):
            e = np.sort(off[part])
            row += [len(e), *([float(e[int(0.95 * (len(e) - 1))]), float(e[-1])] if len(e) else [0.0, 0.0])]
        kinds = [pa.string(), *[pa.int64()] * 3, *[pa.int64(), pa.float64(), pa.float64()] * 3]
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=[x.split()[0] for x in schema.split(", ")])

    each = r.groupBy("icao").applyInArrow(run, schema)
    total = samples.groupBy("icao").agg(F.count("*").alias("points"))
    return each.join(total, "icao").withColumns({"rejected": F.col("points") - F.col("gated"), "keep_pct": 100.0 * F.col("kept") / F.col("points")}).drop("gated")


def fit_report(samples: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: tracks, raw (points), nodes, raw_per_node."""
    a = samples.groupBy("icao").agg(F.count("*").alias("raw"))
    b = nodes.groupBy("icao").agg(F.count("*").alias("nodes"))
    return a.join(b, "icao").agg(F.count("*").alias("tracks"), F.sum("raw").alias("raw"), F.sum("nodes").alias("nodes"), (F.sum("raw") / F.sum("nodes")).alias("raw_per_node"))


def validation_report(validated: DataFrame) -> DataFrame:
    """One row over all tracks of validate: tracks, points, the medians over tracks of median and p95, the largest error and its track, and
    the means over tracks of the shares within and strictly within tolerance."""
    return validated.agg(
        F.count("*").alias("tracks"), F.sum("n").alias("points"), F.median("median").alias("median"), F.median("p95").alias("p95"), F.max("max").alias("max"),
        F.max_by("icao", F.struct("max", "icao")).alias("worst"), F.avg("within").alias("within"), F.avg("strict").alias("strict"),
    )


def report(analysed: DataFrame) -> DataFrame:
    """One row over all tracks: points, kept, median, p90 (by rank) and extremes of the points kept, worst errors by phase over tracks that have it."""
    ranks = at_ranks(analysed, [], "keep_pct", between(0.5) | {"keep_p90": lambda n: F.least(F.floor(n * 9 / 10), n - 1)})
    ranks = ranks.select(interpolated(0.5).alias("keep_median"), "keep_p90")
    worst = [F.max(F.when(F.col(f"{p}_n") > 0, F.col(f"{p}_max"))).alias(f"{p}_worst") for p in ("ground", "low", "high")]
    return analysed.agg(
        F.count("*").alias("tracks"), F.sum("points").alias("points"), F.sum("kept").alias("kept"), F.min("keep_pct").alias("keep_min"),
        F.max("keep_pct").alias("keep_max"), *worst,
    ).join(F.broadcast(ranks))


def validate(samples: DataFrame, nodes: DataFrame, ground_m: float = 2.0, cruise_m: float = 150.0) -> DataFrame:
    """One row a track: n, median, p95 and max distance in metres of its raw points from the curve through its nodes, within (share at most
    1.5 tolerances and a metre off) and strict (share within the tolerance); worst_seq is the farthest point's. Tolerances follow the barometric altitude."""
    schema = "icao string, n long, median double, p95 double, max double, within double, strict double, worst_seq long"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.sort_by([("t", "ascending"), ("seq", "ascending")]), right.sort_by([("t", "ascending"), ("seq", "ascending")])
        kinds = (pa.string(), pa.int64(), *[pa.float64()] * 5, pa.int64())
        names = [x.split()[0] for x in schema.split(", ")]
        if not left.num_rows or right.num_rows < 2:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        lat, lon = (np.array(right.column(c).to_pylist()) / geo.SCALE for c in ("lat", "lon"))
        kx = geo.M_PER_DEGREE * np.cos(np.radians(lat.mean()))
        line = curves.broken_polyline(np.stack((lon * kx, lat * geo.M_PER_DEGREE), axis=1), np.array(right.column("cusp").to_pylist()))
        points = np.stack((np.array(left.column("lon").to_pylist()) * kx, np.array(left.column("lat").to_pylist()) * geo.M_PER_DEGREE), axis=1)
        d = curves.distances(points, line, 512)
        baro = np.array([np.nan if g or b is None else b for b, g in zip(left.column("baro").to_pylist(), left.column("gnd").to_pylist())], dtype=np.float64)
        tol = np.where(np.isnan(baro), ground_m, thinning.ramp(np.nan_to_num(baro), 500.0, 12000.0, ground_m, cruise_m))
        row = (
            left.column("icao")[0].as_py(), len(d), float(np.median(d)), float(np.percentile(d, 95)), float(d.max()),
            float((d <= 1.5 * tol + 1.0).mean()), float((d <= tol).mean()), left.column("seq")[int(d.argmax())].as_py(),
        )
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    points = samples.select("icao", "t", "seq", "lat", "lon", "baro", "gnd")
    return points.groupBy("icao").cogroup(nodes.select("icao", "t", "seq", "lat", "lon", "cusp").groupBy("icao")).applyInArrow(run, schema)
