"""Named queries over the driver's tables, each with the SQL that gives the same rows where SQL can express it.

Lengths and angles come as whole thousandths, so that equal rows have equal values in either engine.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions import geo
from contrail.operators import legs, scans
from contrail.operators import sequence as seq
from contrail.operators.nearest import nearest_airport, surface_snap
from contrail.operators.quantiles import at_ranks, between, interpolated
from contrail.plans import tracks
from contrail.plans.oracles import MISSING, SQL
from contrail.sources import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    """Register f under its name, with whole numbers that may be missing as doubles."""
    columns = MISSING.get(f.__name__, ())

    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.withColumns({c: F.col(c).cast("double") for c in columns}) if columns else df

    QUERIES[f.__name__] = run
    return run


def milli(x: Column | str) -> Column:
    return F.rint((F.col(x) if isinstance(x, str) else x) * 1000.0).cast("long")


def fixed(df: DataFrame) -> DataFrame:
    return df.withColumns({"lat": F.rint(F.col("lat") * 1e5).cast("long"), "lon": F.rint(F.col("lon") * 1e5).cast("long"), "t": milli("t")})


@query
def airports(spark, d):
    return fixtures.airports(spark, d).select("ident", geo.encode("lat").cast("long").alias("lat"), geo.encode("lon").cast("long").alias("lon"), "elev")


@query
def trace_points(spark, d):
    return fixed(fixtures.sparse(spark, d)).select("icao", "seq", "t", "lat", "lon", F.col("baro").cast("long").alias("baro"), "gnd")


@query
def dense_points(spark, d):
    r = fixed(fixtures.dense(spark, d))
    return r.select("icao", "seq", "t", "lat", "lon", "gnd", *[F.col(c).cast("long").alias(c) for c in ("baro", "geom")], *[milli(c).alias(c) for c in ("gs", "trk", "vr")], "src")


@query
def metadata_lookup(spark, d):
    """Aircraft of the customer table: registration and type where they are known."""
    meta = spark.read.parquet(f"{d}/customer.parquet").select(F.concat(F.lit("u"), "c_custkey").alias("icao"), F.col("c_name").alias("reg"), F.col("c_mktsegment").alias("type"))
    return legs.with_meta(fixtures.sparse(spark, d).select("icao").distinct(), meta).select("icao", "reg", "type")


@query
def tolerance_ramps(spark, d):
    r = fixtures.sparse(spark, d).select("seq", "baro", "gnd")
    alt = geo.gate_altitude("baro", "gnd")
    return r.select(
        "seq", milli(geo.ramp(alt, 1000.0, 10000.0, 555.0, 1300.0)).alias("max_speed"),
        milli(geo.ramp(alt, 1000.0, 10000.0, 0.25, 25.0)).alias("max_jump"), milli(geo.fit_tolerance("baro")).alias("fit_m"),
        milli(geo.thin_tolerance(alt, "gnd")).alias("thin_m"), milli(geo.thin_tolerance_ft(alt, "gnd")).alias("thin_ft"),
    )


@query
def source_noise(spark, d):
    n = geo.source_noise("src")
    return fixtures.dense(spark, d).groupBy("src").agg(F.count("*").alias("n")).select(
        "src", "n", n["pos_m"].alias("pos_m"), n["vel_ms"].alias("vel_ms"), n["alt_m"].alias("alt_m"),
    )


@query
def phase_counts(spark, d):
    r = fixtures.sparse(spark, d).withColumn("phase", geo.phase("gnd", F.coalesce("baro", F.lit(0.0))))
    return r.groupBy("icao", "phase").agg(F.count("*").alias("n"))


@query
def airport_distances(spark, d):
    """Both distance measures between all pairs of the 25 airports."""
    a = fixtures.airports(spark, d)
    pairs = a.select("ident", "lat", "lon").join(a.select(F.col("ident").alias("other"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), F.col("ident") < F.col("other"))
    return pairs.select("ident", "other", milli(geo.km("lat", "lon", "lat2", "lon2")).alias("flat_m"), milli(geo.haversine_km("lat", "lon", "lat2", "lon2")).alias("round_m"))


@query
def speed_gate(spark, d):
    return scans.speed_gate(fixtures.sparse(spark, d)).select("icao", "seq", "accepted")


@query
def spike_gate(spark, d):
    return seq.spike_gate(scans.speed_gate(fixtures.dense(spark, d)).where("accepted")).select("icao", "seq", "spike")


@query
def gate_counts(spark, d):
    """Points, points that pass both gates and points that don't, by aircraft."""
    s = fixtures.sparse(spark, d)
    return tracks.counts(s, tracks.gated(s)).select("icao", "n_orig", "n_kept", "n_rejected")


@query
def ground_deglitch(spark, d):
    return seq.ground_reversals(fixtures.dense(spark, d)).where("gnd").select("icao", "seq", "reversal")


@query
def parked_denoise(spark, d):
    return seq.parked(fixtures.dense(spark, d)).select("icao", "seq", geo.encode("lat").cast("long").alias("lat"), geo.encode("lon").cast("long").alias("lon"), "merged")


@query
def stationary_snap(spark, d):
    return seq.stationary_snap(fixtures.dense(spark, d)).select(
        "icao", "seq", F.rint(F.col("lat") * 1e6).cast("long").alias("lat"), F.rint(F.col("lon") * 1e6).cast("long").alias("lon"), "gnd", "snapped",
    )


@query
def decimate_1s(spark, d):
    r = scans.decimate(fixtures.dense(spark, d))
    return r.select(
        "icao", "bucket", "seq", milli("t").alias("t"), F.rint(F.col("lat") * 1e6).cast("long").alias("lat"),
        F.rint(F.col("lon") * 1e6).cast("long").alias("lon"), "gnd", *[milli(c).alias(c) for c in ("baro", "geom", "gs", "vr", "trk")], "src",
        "merged",
    )


@query
def stationary_dedup(spark, d):
    return scans.stationary_dedup(seq.projected(fixtures.dense(spark, d))).select("icao", "seq", "moved")


@query
def duplicate_seconds(spark, d):
    r = fixtures.dense(spark, d)
    return seq.last_of_second(r, F.rint("t").cast("long")).select("icao", "seq", F.rint("t").cast("long").alias("second"))


@query
def alt_despike(spark, d):
    r = fixtures.dense(spark, d).withColumn("alt", F.coalesce("geom", "baro"))
    return scans.altitude_despike(r).select("icao", "seq", F.col("alt").cast("long").alias("alt"), F.col("repaired").cast("long").alias("repaired"))


@query
def datum_fill(spark, d):
    return seq.datum(fixtures.dense(spark, d)).select("icao", "seq", milli("offset").alias("off"), milli("alt").alias("alt"))


@query
def nearest_airport_ident(spark, d):
    return nearest_airport(fixtures.dense(spark, d), fixtures.airports(spark, d), "ident", "ident").select("icao", "seq", "ident")


@query
def surface(spark, d):
    r = surface_snap(seq.datum(fixtures.dense(spark, d)), fixtures.airports(spark, d))
    return r.select("icao", "seq", "elev", "surface", "gnd", milli("alt").alias("alt"))


@query
def ground_hold(spark, d):
    r = nearest_airport(fixtures.dense(spark, d), fixtures.airports(spark, d), "elev", "elev")
    r = r.withColumn("elev", F.when(F.col("gnd"), F.col("elev") + F.col("seq") % 3))  # neighbours disagree
    return seq.ground_hold(r).select("icao", "seq", "elev", "held")


@query
def corners(spark, d):
    return seq.corners(seq.projected(fixtures.sparse(spark, d))).select("icao", "seq", milli("angle").alias("angle"), "corner")


@query
def fixed_point(spark, d):
    """Degrees as whole hundred-thousandths and what is lost by that."""
    r = fixtures.sparse(spark, d)
    return r.select(
        "icao", "seq", geo.encode("lat").alias("lat_fixed"),
        F.rint(F.abs(geo.decode(geo.encode("lat")) - F.col("lat")) * 1e9).cast("long").alias("lost"), F.rint(F.col("t") * 10).cast("int").alias("ds"),
    )


@query
def airborne_runs(spark, d):
    return legs.airborne_runs(fixtures.sparse(spark, d)).select(
        "icao", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"), milli("t_s").alias("t_s"), milli("t_e").alias("t_e"),
        milli("km").alias("m"), "flight",
    )


@query
def leg_points(spark, d):
    return legs.leg_points(fixtures.sparse(spark, d)).select("icao", "seq", F.col("i").cast("long").alias("i"), F.col("leg").cast("long").alias("leg"), "leg_id")


def _flights(spark, d):
    return legs.flights(fixtures.sparse(spark, d), fixtures.airports(spark, d))


@query
def flights(spark, d):
    """The flagship: every flight leg with its airports and times."""
    return _flights(spark, d).select("leg_id", "icao", "dep", "arr", milli("t_start").alias("t_start"), milli("t_end").alias("t_end"), "n_points")


def _fanned(spark, d):
    return legs.fan_out(legs.points_legs(fixtures.sparse(spark, d), fixtures.airports(spark, d)))


@query
def airport_fanout(spark, d):
    return _fanned(spark, d).groupBy("airport", "leg_id").agg(F.count("*").alias("n_points"))


@query
def airport_clip(spark, d):
    return legs.clip(_fanned(spark, d), fixtures.airports(spark, d), 40.0).select("airport", "leg_id", "seq")


@query
def airport_count(spark, d):
    return legs.airport_count(_flights(spark, d))


@query
def flights_by_departure(spark, d):
    return _flights(spark, d).groupBy("dep").agg(F.count("*").alias("n"), F.sum("n_points").alias("points"))


@query
def limited_aircraft(spark, d):
    """The points of the first 10 aircraft in order (semi-join)."""
    r = fixtures.sparse(spark, d)
    return r.join(r.select("icao").distinct().orderBy("icao").limit(10), "icao", "left_semi").groupBy("icao").agg(F.count("*").alias("n"))


def _dates(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select(F.date_format("ts", "yyyy-MM-dd").alias("date"))


@query
def dates_manifest(spark, d):
    from contrail.sources.sinks import dates_manifest as manifest

    return manifest(_dates(spark, d))


@query
def retention(spark, d):
    from contrail.sources.sinks import expired

    return expired(_dates(spark, d).distinct(), 10)


@query
def date_of_tag(spark, d):
    from contrail.sources.sinks import tag_date

    tags = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(
        F.lit("v"), F.date_format("o_orderdate", "yyyy.MM.dd"), F.lit("-set-"), F.col("o_orderkey").cast("string"),
    ).alias("tag"))
    return tags.select("tag", tag_date("tag").alias("date"))


def _every_tenth(df: DataFrame) -> DataFrame:
    """df with keep: each track's every tenth point, and its last."""
    w = seq.ordered()
    i = F.row_number().over(w) - 1
    return df.withColumn("keep", (i % 10 == 0) | F.lead("seq").over(w).isNull())


@query
def recon_error_linear(spark, d):
    r = seq.linear_error(seq.projected(_every_tenth(fixtures.sparse(spark, d))), F.col("keep"))
    return r.select("icao", "seq", milli("err").alias("err"))


@query
def recon_error_catmull(spark, d):
    r = seq.path_error(seq.projected(_every_tenth(fixtures.sparse(spark, d))), F.col("keep"), "catmull")
    return r.select("icao", "seq", milli("err").alias("err"))


@query
def recon_error_segment(spark, d):
    r = seq.path_error(seq.projected(_every_tenth(fixtures.sparse(spark, d))), F.col("keep"), "segment")
    return r.select("icao", "seq", milli("err").alias("err"))


@query
def error_stats(spark, d):
    """By phase: number, median, p95 by interpolation, p95 by rank, largest error and the share within 1.5 tolerances and a metre."""
    r = seq.linear_error(seq.projected(_every_tenth(fixtures.sparse(spark, d))), F.col("keep"))
    r = r.withColumns({"phase": geo.phase("gnd", F.coalesce("baro", F.lit(0.0))), "tol": geo.fit_tolerance("baro")})
    ranks = at_ranks(r, ["phase"], "err", between(0.5) | between(0.95) | {"p95_rank": lambda n: F.floor(0.95 * (n - 1))})
    rest = r.groupBy("phase").agg(
        F.max("err").alias("max"), F.avg((F.col("err") <= 1.5 * F.col("tol") + 1.0).cast("double")).alias("within"),
        F.max_by("seq", F.struct(F.col("err"), -F.col("seq"))).alias("worst_seq"),
    )
    return rest.join(ranks, "phase").select(
        "phase", "n", milli(interpolated(0.5)).alias("median"), milli(interpolated(0.95)).alias("p95"), milli("p95_rank").alias("p95_rank"), milli("max").alias("max"), F.rint(F.col("within") * 1e6).cast("long").alias("within"), "worst_seq"
    )


@query
def worst_tracks(spark, d):
    """Six tracks with the largest errors."""
    r = seq.linear_error(seq.projected(_every_tenth(fixtures.sparse(spark, d))), F.col("keep"))
    return r.groupBy("icao").agg(milli(F.percentile("err", F.lit(0.95))).alias("p95")).orderBy(F.desc("p95"), "icao").limit(6)


@query
def cr_polyline(spark, d):
    """Sixteen points of the curve between each two points of a track."""
    r = seq.projected(fixtures.sparse(spark, d))
    w = seq.ordered()
    ends = {f"{c}{k}": (F.lag if k == 0 else F.lead)(c, 1 if k < 3 else 2).over(w) for c in "xy" for k in (0, 2, 3)}
    r = r.withColumns(ends).where("x2 is not null")
    p = [
        tuple(F.coalesce(F.col(f"{c}0"), F.col(c)) for c in "xy"), (F.col("x"), F.col("y")), (F.col("x2"), F.col("y2")),
        tuple(F.coalesce(F.col(f"{c}3"), F.col(f"{c}2")) for c in "xy"),
    ]
    r = r.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(15))))
    x, y = geo.catmull_rom(p, F.col("k") / 16.0)
    return r.select("icao", "seq", "k", F.rint(x * 10).cast("long").alias("x"), F.rint(y * 10).cast("long").alias("y"))


@query
def codec_roundtrip(spark, d):
    """Every track's points after encoding and decoding, beside what went in."""
    from contrail.operators import codec

    r = fixtures.sparse(spark, d)
    fixed_ = r.select(
        "icao", "seq", F.rint("t").cast("long").alias("t"), F.rint(F.col("lat") * 1e5).cast("long").alias("lat"),
        F.rint(F.col("lon") * 1e5).cast("long").alias("lon"), F.coalesce("baro", F.lit(0.0)).cast("long").alias("alt"),
    )
    return codec.points(codec.blobs(fixed_)).select("icao", "t", "lat", "lon", "alt")


@query
def archive_check(spark, d):
    from contrail.operators import codec

    r = fixtures.sparse(spark, d)
    fixed_ = r.select(
        "icao", "seq", F.rint("t").cast("long").alias("t"), F.rint(F.col("lat") * 1e5).cast("long").alias("lat"),
        F.rint(F.col("lon") * 1e5).cast("long").alias("lon"), F.lit(0).alias("alt"),
    )
    return codec.verified(fixed_, codec.blobs(fixed_))


@query
def longest_tracks(spark, d):
    """Sixteen aircraft with the most points for each airborne run."""
    runs = legs.airborne_runs(fixtures.sparse(spark, d)).groupBy("icao").agg(F.count("*").alias("runs"))
    n = fixtures.sparse(spark, d).groupBy("icao").agg(F.count("*").alias("points"))
    return n.join(runs, "icao").select("icao", milli(F.col("points") / F.col("runs")).alias("ratio")).orderBy(F.desc("ratio"), "icao").limit(16)


@query
def dp_nodes(spark, d):
    return tracks.compress(fixtures.dense(spark, d), fixtures.airports(spark, d))


@query
def compress_report(spark, d):
    return tracks.report(tracks.analyse(fixtures.dense(spark, d)))


@query
def compress_analysis(spark, d):
    return tracks.analyse(fixtures.dense(spark, d))


@query
def cr_nodes(spark, d):
    return tracks.fit(fixtures.dense(spark, d), fixtures.airports(spark, d))


@query
def cr_error_stats(spark, d):
    points = fixtures.dense(spark, d)
    return tracks.validate(points, tracks.fit(points, fixtures.airports(spark, d)))


@query
def node_flights(spark, d):
    """Legs of the fitted nodes, with times in tenths of a second."""
    n = tracks.fit(fixtures.dense(spark, d), fixtures.airports(spark, d))
    points = n.select("icao", "seq", "t", geo.decode("lat").alias("lat"), geo.decode("lon").alias("lon"), "alt", F.col("on_ground").alias("gnd"), "cusp")
    return legs.flights(points, fixtures.airports(spark, d)).drop("reg", "type")


@query
def smoothed(spark, d):
    return tracks.smooth(fixtures.dense(spark, d), fixtures.airports(spark, d))


@query
def bezier_nodes(spark, d):
    return tracks.bezier_nodes(fixtures.dense(spark, d), fixtures.airports(spark, d))


@query
def bezier_columns(spark, d):
    return tracks.bezier_columns(fixtures.dense(spark, d), fixtures.airports(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in QUERIES}
