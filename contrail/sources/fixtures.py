"""Tracks and airports derived from the driver's events and nation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
CYCLE_US = 6 * DAY_US


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, ident, lat, lon, elev: 25 fields on a grid; pos is the place in the file."""
    n = F.col("n_nationkey")
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        n.cast("int").alias("pos"), F.col("n_name").alias("ident"), (40.0 + F.floor(n / 5) * F.lit(1.5)).alias("lat"), (2.0 + (n % 5) * F.lit(1.5)).alias("lon"), (n * 10).cast("int").alias("elev")
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"), F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)").alias("us")
    )


def _flown(rows: DataFrame, ports: DataFrame) -> DataFrame:
    """Adds cyc, uc, fr, gnd, base and the coordinates of both ends; ports is tiny and fixed in size."""
    uc = F.col("us") % CYCLE_US
    rows = rows.withColumns({"cyc": F.expr(f"us div {CYCLE_US}"), "uc": uc})
    rows = rows.withColumns({
        "fr": F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("uc") - DAY_US) / F.lit(float(4 * DAY_US)))),
        "gnd": (F.col("uc") < DAY_US) | (F.col("uc") >= 5 * DAY_US),
        "d": (F.col("user_id") * 7 + F.col("cyc") * 3) % 25,
        "a": (F.col("user_id") * 7 + (F.col("cyc") + 1) * 3) % 25,
    }).withColumn("base", F.floor(F.lit(140000.0) * F.col("fr") * (1 - F.col("fr"))).cast("double"))
    for end in "da":
        side = F.broadcast(ports.select(F.col("pos").cast("long").alias(end), F.col("lat").alias(f"{end}_lat"), F.col("lon").alias(f"{end}_lon")))
        rows = rows.join(side, end)
    return rows


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """icao, seq, t, lat, lon, baro, gnd: one sample for each event."""
    r = _flown(_events(spark, sf_dir), airports(spark, sf_dir))
    stray = F.when((F.col("event_type") == "error") & (F.col("k") >= 90) & ~F.col("gnd"), 0.5).otherwise(0.0)
    return r.select(
        F.concat(F.lit("u"), F.col("user_id")).alias("icao"),
        F.col("event_id").alias("seq"),
        (F.expr("us div 120000") / F.lit(1000.0)).alias("t"),
        (F.col("d_lat") + (F.col("a_lat") - F.col("d_lat")) * F.col("fr") + (F.col("k") % 21 - 10) * F.lit(0.00001) + stray).alias("lat"),
        (F.col("d_lon") + (F.col("a_lon") - F.col("d_lon")) * F.col("fr")).alias("lon"),
        F.when(~F.col("gnd"), F.col("base")).alias("baro"),
        "gnd",
    )


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """icao, seq, t, lat, lon, gnd, baro, geom, gs, trk, vr, src: six samples for each event."""
    steps = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(ms * 120000).alias("off")) for j, ms in enumerate((0, 300, 600, 5000, 10000, 15000))])
    e = _events(spark, sf_dir).withColumn("s", F.explode(steps)).withColumns({"j": F.col("s.j"), "us": F.col("us") + F.col("s.off")}).drop("s")
    r = _flown(e, airports(spark, sf_dir))
    k, j, gnd = F.col("k"), F.col("j"), F.col("gnd")
    spike = F.when((k % 17 == 0) & (j == 4), 900.0).otherwise(0.0)
    shake = lambda e: F.when(gnd, e * F.lit(0.00004)).otherwise(0.0)
    stray = F.when((F.col("event_type") == "error") & (k >= 90) & ~gnd & (j == 3), 0.5).otherwise(0.0)
    src = F.create_map(*[F.lit(x) for x in ("purchase", "mlat", "signup", "tisb_icao", "error", "adsr_icao", "view", "other", "click", "adsb_icao")])
    return r.select(
        F.concat(F.lit("u"), F.col("user_id")).alias("icao"),
        (F.col("event_id") * 6 + j).alias("seq"),
        (F.expr("us div 120000") / F.lit(1000.0)).alias("t"),
        (F.col("d_lat") + (F.col("a_lat") - F.col("d_lat")) * F.col("fr") + shake((k * (j + 1)) % 7 - 3) + stray).alias("lat"),
        (F.col("d_lon") + (F.col("a_lon") - F.col("d_lon")) * F.col("fr") + shake((k * (j + 2)) % 5 - 2)).alias("lon"),
        "gnd",
        F.when(~gnd & ((k + j) % 13 != 0), F.col("base") + spike).alias("baro"),
        F.when(~gnd & (k % 4 != 0), F.col("base") + 200.0 + spike).alias("geom"),
        F.when((k + j) % 11 == 0, None).when(gnd, ((k + j) % 6) * F.lit(0.6)).otherwise((300 + k).cast("double")).alias("gs"),
        (((k * 36 + j * 10) % 3600) / F.lit(10.0)).alias("trk"),
        F.when(k % 3 != 0, (1 - 2 * F.col("fr")) * 2000).alias("vr"),
        src[F.col("event_type")].alias("src"),
    )


#: The same views as common table expressions of DuckDB.
ORACLE = """
airports AS (SELECT n_nationkey::INT AS pos, n_name AS ident, 40e0 + (n_nationkey // 5) * 1.5e0 AS lat, 2e0 + (n_nationkey % 5) * 1.5e0 AS lon, (n_nationkey * 10)::INT AS elev FROM nation),
ev AS (SELECT event_id, user_id, event_type, (props->>'k')::INT AS k, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS us FROM events),
sp0 AS (SELECT *, us // 518400000000 AS cyc, us % 518400000000 AS uc FROM ev),
sp1 AS (SELECT *, greatest(0e0, least(1e0, (uc - 86400000000) / 345600000000e0)) AS fr, (uc < 86400000000 OR uc >= 432000000000) AS gnd FROM sp0),
sparse AS (SELECT 'u' || user_id AS icao, event_id AS seq, (us // 120000) / 1000e0 AS t,
  d.lat + (a.lat - d.lat) * fr + (k % 21 - 10) * 0.00001e0 + CASE WHEN event_type = 'error' AND k >= 90 AND NOT gnd THEN 0.5e0 ELSE 0e0 END AS lat,
  d.lon + (a.lon - d.lon) * fr AS lon, CASE WHEN NOT gnd THEN floor(140000e0 * fr * (1 - fr)) END AS baro, gnd
  FROM sp1 JOIN airports d ON d.pos = (user_id * 7 + cyc * 3) % 25 JOIN airports a ON a.pos = (user_id * 7 + (cyc + 1) * 3) % 25),
dn0 AS (SELECT event_id, user_id, event_type, k, j, us + ms * 120000 AS us FROM ev, (VALUES (0, 0), (1, 300), (2, 600), (3, 5000), (4, 10000), (5, 15000)) s(j, ms)),
dn1 AS (SELECT *, us // 518400000000 AS cyc, us % 518400000000 AS uc FROM dn0),
dn2 AS (SELECT *, greatest(0e0, least(1e0, (uc - 86400000000) / 345600000000e0)) AS fr, (uc < 86400000000 OR uc >= 432000000000) AS gnd,
  CASE WHEN k % 17 = 0 AND j = 4 THEN 900e0 ELSE 0e0 END AS spk FROM dn1),
dense AS (SELECT 'u' || user_id AS icao, event_id * 6 + j AS seq, (us // 120000) / 1000e0 AS t,
  d.lat + (a.lat - d.lat) * fr + CASE WHEN gnd THEN ((k * (j + 1)) % 7 - 3) * 0.00004e0 ELSE 0e0 END + CASE WHEN event_type = 'error' AND k >= 90 AND NOT gnd AND j = 3 THEN 0.5e0 ELSE 0e0 END AS lat,
  d.lon + (a.lon - d.lon) * fr + CASE WHEN gnd THEN ((k * (j + 2)) % 5 - 2) * 0.00004e0 ELSE 0e0 END AS lon, gnd,
  CASE WHEN NOT gnd AND (k + j) % 13 <> 0 THEN floor(140000e0 * fr * (1 - fr)) + spk END AS baro,
  CASE WHEN NOT gnd AND k % 4 <> 0 THEN floor(140000e0 * fr * (1 - fr)) + 200e0 + spk END AS geom,
  CASE WHEN (k + j) % 11 = 0 THEN NULL WHEN gnd THEN ((k + j) % 6) * 0.6e0 ELSE (300 + k)::DOUBLE END AS gs,
  ((k * 36 + j * 10) % 3600) / 10e0 AS trk, CASE WHEN k % 3 <> 0 THEN (1 - 2 * fr) * 2000 END AS vr,
  CASE event_type WHEN 'purchase' THEN 'mlat' WHEN 'signup' THEN 'tisb_icao' WHEN 'error' THEN 'adsr_icao' WHEN 'view' THEN 'other' WHEN 'click' THEN 'adsb_icao' END AS src
  FROM dn2 JOIN airports d ON d.pos = (user_id * 7 + cyc * 3) % 25 JOIN airports a ON a.pos = (user_id * 7 + (cyc + 1) * 3) % 25)"""
