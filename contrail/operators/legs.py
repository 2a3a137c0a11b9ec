"""Flight legs: airborne runs that travel, cuts between them, end airports, and the rows of each airport."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions import geo
from contrail.operators.nearest import nearest_airport, sent
from contrail.operators.sequence import TRACK, following, islands, ordered, whole


def airborne_runs(points: DataFrame, least_km: float = 2.0) -> DataFrame:
    """icao, s, e (places of the run's ends), t_s, t_e, km (diagonal of its box) and flight (farther than least_km)."""
    r = islands(points.withColumn("i", F.row_number().over(ordered()) - 1), ~F.coalesce("gnd", F.lit(False)), "run")
    runs = r.where(~F.coalesce("gnd", F.lit(False))).groupBy(TRACK, "run").agg(
        F.min("i").alias("s"), F.max("i").alias("e"), F.min_by("t", "i").alias("t_s"), F.max_by("t", "i").alias("t_e"),
        *[f(c).alias(f"{n}_{c}") for c in ("lat", "lon") for f, n in ((F.min, "min"), (F.max, "max"))],
    )
    runs = runs.withColumn("km", geo.km("min_lat", "min_lon", "max_lat", "max_lon"))
    return runs.select(TRACK, "s", "e", "t_s", "t_e", "km", (F.col("km") > least_km).alias("flight"))


def leg_points(points: DataFrame, least_km: float = 2.0) -> DataFrame:
    """points of tracks that fly, with i (place), leg (from 0) and leg_id. A null gnd counts as airborne; rows without icao are left out.

    Between two flights the leg changes at the first point at or after the middle of the time between them, or where
    the next begins. All windows have the track's key, so this takes one shuffle.
    """
    w, track = ordered(), whole()
    air = ~F.coalesce("gnd", F.lit(False))
    r = islands(points.where(F.col(TRACK).isNotNull()).withColumn("i", F.row_number().over(w) - 1), air, "_run")
    run = Window.partitionBy(TRACK, "_run")
    r = r.withColumns({
        "_s": F.min("i").over(run), "_e": F.max("i").over(run),
        "_box": geo.km(F.min("lat").over(run), F.min("lon").over(run), F.max("lat").over(run), F.max("lon").over(run)),
    })
    flight = air & (F.col("_box") > least_km)
    r = r.withColumn("_flight", flight)
    r = r.withColumn("_flies", F.max("_flight").over(track)).where("_flies")
    begin = F.when(F.col("_flight") & (F.col("i") == F.col("_s")), F.struct("i", "t"))
    r = r.withColumn("_begin", begin).withColumn("_next", following("_begin", 1))
    done = F.when(
        F.col("_flight") & (F.col("i") == F.col("_e")) & F.col("_next").isNotNull(),
        F.struct(F.col("i").alias("e"), F.col("_next.i").alias("s"), ((F.col("t") + F.col("_next.t")) / 2).alias("mid")),
    )
    r = r.withColumn("_done", done).withColumn("_gap", F.last("_done", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    may = (F.col("i") <= F.col("_gap.s")) & ((F.col("t") >= F.col("_gap.mid")) | (F.col("i") == F.col("_gap.s")))
    r = r.withColumn("_may", F.when(may, F.col("i"))).withColumn("_cut", F.min("_may").over(Window.partitionBy(TRACK, "_gap.e")))
    leg = F.sum(F.when(F.col("i") == F.col("_cut"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    r = r.withColumn("leg", leg).drop(*[c for c in r.columns if c.startswith("_")])
    return r.withColumn("leg_id", F.concat_ws("_", TRACK, "leg"))


def flights(points: DataFrame, airports: DataFrame, meta: DataFrame | None = None, least_km: float = 2.0, radius_km: float = 10.0) -> DataFrame:
    """leg_id, icao, reg, type, dep, arr, t_start, t_end, n_points. Ends are the leg's first and last fix on the ground, else its first and last."""
    legs = leg_points(points, least_km)
    at, ground = F.struct("lat", "lon"), F.coalesce("gnd", F.lit(False))
    ends = legs.groupBy(TRACK, "leg", "leg_id").agg(
        F.coalesce(F.min_by(F.when(ground, at), F.when(ground, F.col("i"))), F.min_by(at, "i")).alias("a"),
        F.coalesce(F.max_by(F.when(ground, at), F.when(ground, F.col("i"))), F.max_by(at, "i")).alias("b"),
        F.min_by("t", "i").alias("t_start"), F.max_by("t", "i").alias("t_end"), F.count("*").alias("n_points"),
    )
    ends = ends.select("*", F.col("a.lat").alias("a_lat_"), F.col("a.lon").alias("a_lon_"), F.col("b.lat").alias("b_lat_"), F.col("b.lon").alias("b_lon_"))
    ends = nearest_airport(ends, airports, "ident", "dep", "a_lat_", "a_lon_", radius_km)
    ends = nearest_airport(ends, airports, "ident", "arr", "b_lat_", "b_lon_", radius_km)
    ends = with_meta(ends, meta)
    return ends.select("leg_id", TRACK, "reg", "type", "dep", "arr", "t_start", "t_end", "n_points")


def with_meta(df: DataFrame, meta: DataFrame | None) -> DataFrame:
    """df with reg and type of its aircraft, null where unknown; of repeated aircraft the last row (by its seq, else any) counts."""
    if meta is None:
        return df.withColumns({"reg": F.lit(None).cast("string"), "type": F.lit(None).cast("string")})
    last = F.struct("seq") if "seq" in meta.columns else F.struct(F.lit(0))
    one = meta.groupBy(TRACK).agg(F.max_by(F.struct("reg", "type"), last).alias("m")).select(TRACK, F.col("m.reg").alias("reg"), F.col("m.type").alias("type"))
    return df.join(one, TRACK, "left")


def points_legs(points: DataFrame, airports: DataFrame, meta: DataFrame | None = None, least_km: float = 2.0, radius_km: float = 10.0) -> DataFrame:
    """Every point with its leg and the leg's airports; unknown altitudes are 0. The ends come by windows with the track's key, so
    the points aren't moved again to meet their legs."""
    legs = leg_points(points, least_km)
    every = Window.partitionBy(TRACK, "leg").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = F.struct("lat", "lon")
    ground = F.when(F.coalesce("gnd", F.lit(False)), at)
    ends = {
        "_a": F.coalesce(F.first(ground, ignorenulls=True).over(every), F.first(at).over(every)),
        "_b": F.coalesce(F.last(ground, ignorenulls=True).over(every), F.last(at).over(every)),
    }
    out = legs.withColumns(ends).withColumns({"_ay": F.col("_a.lat"), "_ax": F.col("_a.lon"), "_by": F.col("_b.lat"), "_bx": F.col("_b.lon")})
    out = nearest_airport(out, airports, "ident", "dep", "_ay", "_ax", radius_km)
    out = nearest_airport(out, airports, "ident", "arr", "_by", "_bx", radius_km)
    out = with_meta(out.drop("i", "leg", *[c for c in out.columns if c.startswith("_")]), meta)
    return out.withColumn("alt", F.coalesce("alt", F.lit(0))) if "alt" in out.columns else out


def fan_out(rows: DataFrame, orphan_arrivals: bool = False) -> DataFrame:
    """rows once for each of their leg's airports: the departure, and the arrival where it is another one. Where the departure is
    unknown the arrival counts only with orphan_arrivals."""
    other = F.when(F.col("arr") != F.col("dep"), F.col("arr"))
    if orphan_arrivals:
        other = F.when(F.col("dep").isNull(), F.col("arr")).otherwise(other)
    return rows.withColumn("airport", F.explode(F.array_compact(F.array("dep", other))))


def clip(rows: DataFrame, airports: DataFrame, radius_km: float) -> DataFrame:
    """Rows of fan_out that lie within radius_km of their airport (great circle); all of them for 0."""
    if radius_km <= 0:
        return rows
    at = sent(airports.select(F.col("ident").alias("airport"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")))
    return rows.join(at, "airport").where(geo.haversine_km("p_lat", "p_lon", "lat", "lon") < radius_km).drop("p_lat", "p_lon")


def airport_count(legs: DataFrame) -> DataFrame:
    """n_airports: distinct departures and arrivals together."""
    codes = legs.select(F.col("dep").alias("code")).union(legs.select(F.col("arr").alias("code"))).where("code is not null").distinct()
    return codes.agg(F.count("*").alias("n_airports"))
