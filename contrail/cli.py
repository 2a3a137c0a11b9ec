"""Command line: python -m contrail.cli {fit,legs,compress,analyse,smooth,validate,manifest} ..."""

from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions import geo
from contrail.operators import codec, kalman, legs
from contrail.plans import tracks
from contrail.sources import sinks, traces


#: Options of the compressor beside those of all commands, with their plan's names: of the gates, of parked runs, of thinning.
SPEED = {"max-speed": ("high_kmh", 1300.0), "max-speed-low": ("low_kmh", 555.0)}
JUMP = {"max-jump": ("high_km", 25.0), "max-jump-low": ("low_km", 0.25)}
PARKED = {"gs-stationary": ("gs_kt", 2.0), "stationary-radius": ("radius_m", 20.0)}
THIN = {
    "h-ground": ("ground_m", 10.0), "h-low": ("low_m", 20.0), "h-cruise": ("cruise_m", 150.0), "v-ground": ("ground_ft", 25.0),
    "v-cruise": ("cruise_ft", 250.0), "low-alt": ("low_alt_ft", 2000.0), "high-alt": ("high_alt_ft", 12000.0),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="contrail")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("fit", "compress", "analyse", "smooth", "validate"):
        s = sub.add_parser(name)
        s.add_argument("traces")
        s.add_argument("out")
        s.add_argument("--airports")
        s.add_argument("--limit", type=int)
        if name in ("fit", "validate", "smooth"):
            s.add_argument("--tol-ground", type=float, default=5.0 if name == "smooth" else 2.0)
            s.add_argument("--tol-cruise", type=float, default=150.0)
        if name in ("fit", "validate"):
            s.add_argument("--corner", type=float, default=35.0)
        if name in ("compress", "analyse"):
            for option, (_, default) in (SPEED | JUMP | THIN | (PARKED if name == "compress" else {})).items():
                s.add_argument(f"--{option}", type=float, default=default)
        if name == "analyse":
            s.add_argument("--recon", choices=("linear", "catmull", "segment"), default="linear")
        if name == "compress":
            s.add_argument("--no-denoise", action="store_true")
            s.add_argument("--partition-by", choices=("none", "date"), default="none")
            s.add_argument("--denormalize", action="store_true", help="registration, type, description and base time in every row, and no aircraft table")
            s.add_argument("--blobs", action="store_true")
            s.add_argument("--verify", action="store_true", help="decode the blobs and hold them against the rows")
        if name == "smooth":
            for f in fields(kalman.Settings):
                s.add_argument(f"--{f.name.replace('_', '-')}", type=float, default=f.default)
    s = sub.add_parser("legs")
    s.add_argument("--traces", required=True)
    s.add_argument("--meta")
    s.add_argument("--airports", required=True)
    s.add_argument("--out-dir", required=True)
    s.add_argument("--radius-km", type=float, default=0.0)
    s.add_argument("--limit-aircraft", type=int)
    s.add_argument("--orphan-arrivals", action="store_true")
    s = sub.add_parser("manifest")
    s.add_argument("legs")
    s.add_argument("--keep", type=int, default=30)
    return p


def _of(a, options: dict[str, tuple[str, float]]) -> dict[str, float]:
    return {name: getattr(a, option.replace("-", "_")) for option, (name, _) in options.items()}


def _samples(spark: SparkSession, a) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(samples with their date, aircraft, airports); documents that can't be read go to quarantine."""
    docs = traces.documents(traces.files(spark, a.traces, sample=a.limit))
    samples, quarantine = traces.samples(docs)
    quarantine.write.mode("overwrite").parquet(f"{a.out}/quarantine")
    samples = samples.withColumn("date", sinks.epoch_date("base_ts")).drop("base_ts")
    return samples, traces.aircraft(docs), traces.airports(spark, a.airports) if a.airports else None


def _settled(spark: SparkSession, tracks_: DataFrame, out: str) -> DataFrame:
    """The rows of tracks_, computed once; tracks that failed go to quarantined tracks with the reason."""
    tracks_.write.mode("overwrite").parquet(f"{out}/_staged")
    staged = spark.read.parquet(f"{out}/_staged")
    staged.where("error is not null").select("icao", "date", "error").write.mode("overwrite").parquet(f"{out}/quarantine_tracks")
    return staged.where("error is null").drop("error")


def build_legs(spark: SparkSession, a) -> None:
    nodes, airports = spark.read.parquet(a.traces), traces.airports(spark, a.airports)
    if a.limit_aircraft:
        nodes = nodes.join(nodes.select("icao").distinct().orderBy("icao").limit(a.limit_aircraft), "icao", "left_semi")
    points = nodes.withColumns({"lat": geo.decode("lat"), "lon": geo.decode("lon"), "gnd": F.col("on_ground")}).drop("on_ground")
    points = points if "seq" in points.columns else points.withColumn("seq", F.monotonically_increasing_id())
    meta = spark.read.parquet(a.meta) if a.meta else None
    days = "date" in points.columns

    def named(df: DataFrame) -> DataFrame:
        """With the aircraft's own icao, its day in leg_id, and its metadata."""
        if days:
            part = F.split("icao", "\n", 2)
            df = df.withColumns({"leg_id": F.translate("leg_id", "\n", "_"), "date": part[1], "icao": part[0]})
        return legs.with_meta(df.drop("reg", "type"), meta)

    points = tracks.day_key(points) if days else points
    named(legs.flights(points, airports)).repartitionByRange("dep", "leg_id").sortWithinPartitions("dep", "leg_id").write.mode("overwrite").parquet(f"{a.out_dir}/flights.parquet")
    fixed = {"lat": geo.encode("lat"), "lon": geo.encode("lon")}
    named(legs.points_legs(points, airports)).withColumns(fixed).withColumnRenamed("gnd", "on_ground").write.mode("overwrite").parquet(f"{a.out_dir}/points_legs.parquet")
    done = spark.read.parquet(f"{a.out_dir}/points_legs.parquet")
    rows = legs.fan_out(done.withColumns({"lat": geo.decode("lat"), "lon": geo.decode("lon")}), a.orphan_arrivals)
    sinks.write_airports(legs.clip(rows, airports, a.radius_km).withColumns(fixed), f"{a.out_dir}/airports")
    flights = spark.read.parquet(f"{a.out_dir}/flights.parquet")
    flights.agg(F.count("*").alias("flights"), F.count("dep").alias("with_departure"), F.count("arr").alias("with_arrival"), F.sum("n_points").alias("points")).show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("contrail").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "legs":
        return build_legs(spark, a)
    if a.command == "manifest":
        found = spark.read.parquet(a.legs).select(F.col("date").cast("string").alias("date")).distinct()
        sinks.dates_manifest(found).show(truncate=False)
        return sinks.expired(found, a.keep).show(truncate=False)
    samples, aircraft, airports = _samples(spark, a)
    if a.command != "compress" or not a.denormalize:
        aircraft.write.mode("overwrite").parquet(f"{a.out}/aircraft.parquet")
    if a.command in ("fit", "validate"):
        nodes = _settled(spark, tracks.by_day(tracks.fit, samples, airports, a.tol_ground, a.tol_cruise, a.corner, errors=True), a.out)
        if a.command == "fit":
            sinks.write_sorted(nodes, f"{a.out}/nodes.parquet")
            return tracks.fit_report(tracks.day_key(samples), tracks.day_key(nodes)).show(truncate=False)
        tracks.by_day(tracks.validate, samples, tracks.day_key(nodes), a.tol_ground, a.tol_cruise).write.mode("overwrite").parquet(f"{a.out}/validation.parquet")
        return tracks.validation_report(spark.read.parquet(f"{a.out}/validation.parquet")).show(truncate=False)
    if a.command == "smooth":
        settings = kalman.Settings(**{f.name: getattr(a, f.name) for f in fields(kalman.Settings)})
        return sinks.write_sorted(
            _settled(spark, tracks.by_day(tracks.smooth, samples, airports, a.tol_ground, settings, True, cruise_m=a.tol_cruise), a.out),
            f"{a.out}/traces.parquet",
        )
    if a.command == "analyse":
        tracks.by_day(tracks.analyse, samples, a.recon, _of(a, SPEED), _of(a, JUMP), **_of(a, THIN)).write.mode("overwrite").parquet(f"{a.out}/analysis.parquet")
        return tracks.report(spark.read.parquet(f"{a.out}/analysis.parquet")).show(truncate=False)
    kept = _settled(spark, tracks.by_day(tracks.compress, samples, airports, not a.no_denoise, _of(a, SPEED), _of(a, JUMP), _of(a, PARKED), True, **_of(a, THIN)), a.out)
    if a.blobs:
        archive = codec.blobs(kept)
        sinks.write_blobs(archive, f"{a.out}/blobs").write.mode("overwrite").parquet(f"{a.out}/blob_sizes.parquet")
        sinks.archive_manifest(archive, _of(a, THIN)).write.mode("overwrite").text(f"{a.out}/manifest.json")
        if a.verify:
            codec.verified(kept, sinks.read_blobs(spark, f"{a.out}/blobs")).where("n_in <> n_out or not ordered or not in_bounds").show(truncate=False)
        return
    if a.denormalize:
        more = aircraft.withColumn("date", sinks.epoch_date("base_ts")).groupBy("icao", "date").agg(F.max_by(F.struct("reg", "type", "desc", "base_ts"), "base_ts").alias("m"))
        kept = kept.join(more, ["icao", "date"], "left").select("*", "m.*").drop("m")
    sinks.write_sorted(kept, f"{a.out}/traces.parquet", "date" if a.partition_by == "date" else None)


if __name__ == "__main__":
    main()
