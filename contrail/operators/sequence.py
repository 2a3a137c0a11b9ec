"""Operators on tracks that windows express: every row knows its neighbours in (t, seq) order within its icao."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions import geo

TRACK = "icao"
ORDER = ("t", "seq")


def ordered():
    return Window.partitionBy(TRACK).orderBy(*ORDER)


def whole():
    return Window.partitionBy(TRACK)


def following(c: Column | str, from_row: int = 0) -> Column:
    """The first value of c that isn't null, from this row on or from the next (1): a running last in descending order, as a frame
    that ends with the track would be gone through anew for each row."""
    return F.last(c, ignorenulls=True).over(Window.partitionBy(TRACK).orderBy(*[F.desc_nulls_last(x) for x in ORDER]).rowsBetween(Window.unboundedPreceding, -from_row))


def islands(df: DataFrame, flag: Column, name: str = "run") -> DataFrame:
    """Adds the running number of the maximal runs of rows with one value of flag."""
    w = ordered()
    f = F.coalesce(flag, F.lit(False))
    before = F.lag(f).over(w)
    return df.withColumn("_new", F.when(before.eqNullSafe(f), 0).otherwise(1)).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def long_enough(df: DataFrame, least: int) -> DataFrame:
    """Tracks of `least` points and more."""
    return df.withColumn("_n", F.count("*").over(whole())).where(F.col("_n") >= least).drop("_n")


def spike_gate(accepted: DataFrame, cap_lo_ft: float = 1000.0, cap_hi_ft: float = 10000.0, low_km: float = 0.25, high_km: float = 25.0) -> DataFrame:
    """Rows that passed the speed gate, with `spike`: far from both neighbours, which are close to each other."""
    w = ordered()
    near = {f"{c}_{s}": f(c).over(w) for c in ("lat", "lon") for s, f in (("p", F.lag), ("n", F.lead))}
    r = accepted.withColumns(near)
    back, ahead = geo.km("lat_p", "lon_p", "lat", "lon"), geo.km("lat", "lon", "lat_n", "lon_n")
    across = geo.km("lat_p", "lon_p", "lat_n", "lon_n")
    feet = "gate_ft" if "gate_ft" in accepted.columns else "baro"
    cap = geo.ramp(geo.gate_altitude(feet, "gnd"), cap_lo_ft, cap_hi_ft, low_km, high_km)
    spike = (back > cap) & (ahead > cap) & (across < 0.5 * F.greatest(back, ahead))
    return r.withColumn("spike", F.coalesce(spike, F.lit(False))).drop(*near)


def ground_reversals(df: DataFrame, jitter_m: float = 30.0, step_m: float = 8.0, share: float = 0.5, gap_s: float = 600.0, stop_kt: float = 1.5) -> DataFrame:
    """df with `reversal`: points on the ground that stick out of their neighbours on the ground, out and back."""
    w = Window.partitionBy(TRACK, "gnd").orderBy(*ORDER)
    near = {f"{c}_{s}": f(c).over(w) for c in ("t", "lat", "lon") for s, f in (("p", F.lag), ("n", F.lead))}
    r = df.withColumns(near)
    back, ahead = geo.km("lat_p", "lon_p", "lat", "lon") * 1000, geo.km("lat", "lon", "lat_n", "lon_n") * 1000
    across, step = geo.km("lat_p", "lon_p", "lat_n", "lon_n") * 1000, F.greatest(back, ahead)
    stopped = F.coalesce(F.col("gs") < stop_kt, F.lit(False))
    out = F.when(stopped, across < step).otherwise((step < jitter_m) & (across < share * step))
    hit = F.col("gnd") & F.col("t_p").isNotNull() & F.col("t_n").isNotNull() & (F.col("t_n") - F.col("t_p") <= gap_s) & (step > step_m) & out
    return r.withColumn("reversal", F.coalesce(hit, F.lit(False))).drop(*near)


def last_of_second(df: DataFrame, second: Column) -> DataFrame:
    """Of neighbouring rows with one value of second the last."""
    return df.withColumn("_s", second).withColumn("_next", F.lead("_s").over(ordered())).where(F.col("_next").isNull() | (F.col("_next") != F.col("_s"))).drop("_s", "_next")


def filled(value: Column, at: str = "t") -> Column:
    """value, linear in `at` between rows that have it, flat beyond the first and last, 0 where a track has none."""
    w = ordered()
    known = F.when(value.isNotNull(), F.struct(F.col(at).alias("t"), value.alias("v")))
    a = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    b = following(known)
    span = b["t"] - a["t"]
    mid = a["v"] + (b["v"] - a["v"]) * (F.col(at) - a["t"]) / F.when(span == 0, 1.0).otherwise(span)
    return F.coalesce(value, F.when(a.isNotNull() & b.isNotNull(), mid), a["v"], b["v"], F.lit(0.0))


def datum(df: DataFrame, name: str = "alt") -> DataFrame:
    """Adds one altitude: geometric, else barometric moved by the offset between the two, interpolated over time; null without either."""
    baro = F.when(~F.col("gnd"), F.col("baro"))
    offset = filled(F.col("geom") - baro)
    return df.withColumn("offset", offset).withColumn(name, F.coalesce(F.col("geom"), baro + F.col("offset")))


def stationary_snap(df: DataFrame, stop_kt: float = 3.0, dwell_s: float = 20.0, box_m: float = 40.0) -> DataFrame:
    """Runs below stop_kt are on the ground; those that last or are tight move to their centre, the sum in (t, seq) order by their number. Adds `snapped`."""
    still = F.col("gs").isNotNull() & (F.col("gs") < stop_kt)
    r = islands(df.withColumn("_still", still), F.col("_still"), "_run")
    # sums of doubles depend on their order, and rows of a run come in any order once a sort has spilled
    run = Window.partitionBy(TRACK, "_run").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lat, lon = F.avg("lat").over(run), F.avg("lon").over(run)
    r = r.withColumns({
        "_lat": lat, "_lon": lon, "_dt": F.max("t").over(run) - F.min("t").over(run), "_n": F.count("*").over(run),
        "_dy": F.max("lat").over(run) - F.min("lat").over(run), "_dx": F.max("lon").over(run) - F.min("lon").over(run),
    })
    box = F.greatest(F.col("_dy") * geo.M_PER_DEGREE, F.col("_dx") * geo.M_PER_DEGREE * F.cos(F.radians("_lat")))
    snap = F.col("_still") & ((F.col("_dt") >= dwell_s) | ((F.col("_n") >= 3) & (box < box_m)))
    r = r.withColumn("snapped", snap)
    return r.withColumns({
        "lat": F.when(F.col("snapped"), F.col("_lat")).otherwise(F.col("lat")), "lon": F.when(F.col("snapped"), F.col("_lon")).otherwise(F.col("lon")),
        "gnd": F.col("gnd") | F.col("_still"),
    }).drop("_still", "_run", "_lat", "_lon", "_dt", "_n", "_dx", "_dy")


def parked(df: DataFrame, gs_kt: float = 2.0, radius_m: float = 20.0) -> DataFrame:
    """Parked runs become two rows, at their first and last time, at the median position; all else stays. Adds `merged`: rows of the run, 1 if it stays."""
    still = F.col("gnd") & (F.col("gs").isNull() | (F.col("gs") < gs_kt))
    r = islands(df.withColumn("_still", still), F.col("_still"), "_run")
    run = Window.partitionBy(TRACK, "_run")
    inner = run.orderBy(*ORDER)
    r = r.withColumns({
        "_lat0": F.first("lat").over(inner), "_lon0": F.first("lon").over(inner), "_i": F.row_number().over(inner), "_n": F.count("*").over(run),
        "_t0": F.min("t").over(run), "_gs": F.median(F.coalesce("gs", F.lit(0.0))).over(run), "_mlat": F.median("lat").over(run),
        "_mlon": F.median("lon").over(run),
    })
    r = r.withColumn("_d", F.max(geo.km("_lat0", "_lon0", "lat", "lon") * 1000).over(run))
    merge = F.col("_still") & (F.col("_n") >= 3) & ((F.col("_d") < radius_m) | ((F.col("_gs") < 1.0) & (F.col("_d") < 200.0)))
    r = r.withColumn("_merge", merge).where(~F.col("_merge") | (F.col("_i") == 1) | ((F.col("_i") == F.col("_n")) & (F.col("t") != F.col("_t0"))))
    return r.withColumns({"lat": F.when(F.col("_merge"), F.col("_mlat")).otherwise(F.col("lat")), "lon": F.when(F.col("_merge"), F.col("_mlon")).otherwise(F.col("lon")), "merged": F.when(F.col("_merge"), F.col("_n")).otherwise(F.lit(1)).cast("long")}).drop(
        "_still", "_run", "_lat0", "_lon0", "_i", "_n", "_t0", "_gs", "_mlat", "_mlon", "_d", "_merge"
    )


def ground_hold(df: DataFrame, elevation: str = "elev") -> DataFrame:
    """Adds held: each ground run's most frequent elevation, the one seen first among equals, where a row has an elevation."""
    r = islands(df, F.col("gnd"), "_run")
    counts = r.where(F.col("gnd") & F.col(elevation).isNotNull()).groupBy(TRACK, "_run", elevation).agg(F.count("*").alias("n"), F.min(F.struct(*ORDER)).alias("first"))
    top = counts.groupBy(TRACK, "_run").agg(F.max_by(elevation, F.struct("n", (-F.col("first.t")).alias("t"), (-F.col("first.seq")).alias("s"))).alias("held"))
    r = r.join(top, [TRACK, "_run"], "left")
    return r.withColumn("held", F.when(F.col("gnd") & F.col(elevation).isNotNull(), F.col("held"))).drop("_run")


def corners(df: DataFrame, degrees: float = 35.0) -> DataFrame:
    """Adds angle (of the turn, degrees) and corner: sharp turns, changes between ground and air, and both ends. x and y are metres."""
    w = ordered()

    def unit(dx: Column, dy: Column):
        n = F.sqrt(dx * dx + dy * dy)
        return F.when(n > 0, dx / n).otherwise(0.0), F.when(n > 0, dy / n).otherwise(0.0)

    r = df.withColumns({"_xp": F.lag("x").over(w), "_yp": F.lag("y").over(w), "_xn": F.lead("x").over(w), "_yn": F.lead("y").over(w), "_gp": F.lag("gnd").over(w)})
    ax, ay = unit(F.col("x") - F.col("_xp"), F.col("y") - F.col("_yp"))
    bx, by = unit(F.col("_xn") - F.col("x"), F.col("_yn") - F.col("y"))
    end = F.col("_xp").isNull() | F.col("_xn").isNull()
    r = r.withColumn("angle", F.when(~end, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ax * bx + ay * by))))))
    return r.withColumn("corner", end | (F.col("angle") > degrees) | (F.col("gnd") != F.col("_gp"))).drop("_xp", "_yp", "_xn", "_yn", "_gp")


def projected(df: DataFrame) -> DataFrame:
    """Adds x and y: metres in the track's own projection about its mean latitude."""
    return df.withColumn("_kx", F.cos(F.radians(F.avg("lat").over(whole())))).withColumns({
        "x": F.col("lon") * F.col("_kx") * geo.M_PER_DEGREE, "y": F.col("lat") * geo.M_PER_DEGREE,
    }).drop("_kx")


def bracketed(df: DataFrame, keep: Column, point: str | None = None) -> DataFrame:
    """Adds k0 and k1: the kept points around each row, from the row's own or the last before it to the next; of a track's last rows the last
    pair. point: a column with what to carry of a kept point, else t, seq, x and y."""
    w = ordered()
    r = df.withColumn("_k", F.when(keep, F.col(point) if point else F.struct("t", "seq", "x", "y")))
    r = r.withColumn("_kn", following("_k", 1))
    r = r.withColumn("_kp", F.last("_k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    here = F.last("_k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    r = r.withColumn("k0", F.when(F.col("_kn").isNull() & F.col("_k").isNotNull(), F.col("_kp")).otherwise(here))
    return r.withColumn("k1", F.coalesce("_kn", "_k")).drop("_k", "_kn", "_kp")


def linear_error(df: DataFrame, keep: Column) -> DataFrame:
    """Adds err: metres from each row to where the straight line between kept points has it at its time. The first and last row are kept."""
    r = bracketed(df, keep)
    span = F.col("k1.t") - F.col("k0.t")
    u = F.when(span > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("t") - F.col("k0.t")) / span))).otherwise(0.0)
    dx = geo.lerp(F.col("k0.x"), F.col("k1.x"), u) - F.col("x")
    dy = geo.lerp(F.col("k0.y"), F.col("k1.y"), u) - F.col("y")
    return r.withColumn("err", F.sqrt(dx * dx + dy * dy)).drop("k0", "k1")


def path_error(df: DataFrame, keep: Column, mode: str = "linear", low_ft: float = 3000.0, alt: str = "baro") -> DataFrame:
    """Adds err: metres from each row to where the path through the kept points has it at its time: straight lines (linear), centripetal
    Catmull-Rom curves (catmull), or curves only where an end of the span is on the ground or below low_ft (segment). The first and last row are kept."""
    if mode == "linear":
        return linear_error(df, keep)
    low = F.coalesce("gnd", F.lit(False)) | (F.coalesce(F.col(alt), F.lit(0.0)) < low_ft)
    r = df.withColumn("_low", low).withColumn("_at", F.when(keep, F.struct("x", "y")))
    before = F.last("_at", ignorenulls=True).over(ordered().rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("_point", F.when(keep, F.struct("t", "seq", "x", "y", "_low", before.alias("p"), following("_at", 1).alias("n"))))
    r = bracketed(r, keep, "_point")
    k0, k1 = F.col("k0"), F.col("k1")
    span = k1["t"] - k0["t"]
    u = F.when(span > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("t") - k0["t"]) / span))).otherwise(0.0)
    ends = [[F.coalesce(k0["p"][c], k0[c]), k0[c], k1[c], F.coalesce(k1["n"][c], k1[c])] for c in "xy"]
    curve = geo.catmull_rom(list(zip(*ends)), u)
    bent = F.lit(True) if mode == "catmull" else k0["_low"] | k1["_low"]
    dx, dy = (F.when(bent, c).otherwise(geo.lerp(e[1], e[2], u)) - F.col(n) for c, e, n in zip(curve, ends, "xy"))
    return r.withColumn("err", F.sqrt(dx * dx + dy * dy)).drop("k0", "k1", "_low", "_at", "_point")
