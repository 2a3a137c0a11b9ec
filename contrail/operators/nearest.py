"""Nearest airport within a radius, without moving the points.

Airports are listed under each one-degree cell that they or a neighbouring cell lie in, so a point looks up its own
cell only, and the nearest is picked inside the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import geo

#: Airports whose lists are sent to every executor; more are joined by shuffling.
MOST_SENT = 500_000


def sent(airports: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """lists, or airports themselves, to every executor if there are at most MOST_SENT airports, which are counted; else joined by shuffling."""
    out = airports if lists is None else lists
    return F.broadcast(out) if airports.limit(MOST_SENT + 1).count() <= MOST_SENT else out


def cells(airports: DataFrame, payload: str) -> DataFrame:
    """(cy, cx, near): the airports of a cell and its eight neighbours. Rows without coordinates are left out."""
    steps = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in (-1, 0, 1) for x in (-1, 0, 1)])
    a = airports.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col(payload).isNotNull())
    each = a.select(F.explode(steps).alias("s"), "pos", F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"), F.col(payload).alias("payload"))
    at = each.select((F.rint("a_lat") + F.col("s.y")).cast("int").alias("cy"), (F.rint("a_lon") + F.col("s.x")).cast("int").alias("cx"), F.struct("pos", "a_lat", "a_lon", "payload").alias("a"))
    return at.groupBy("cy", "cx").agg(F.collect_list("a").alias("near"))


def nearest_airport(points: DataFrame, airports: DataFrame, payload: str, name: str, lat: str = "lat", lon: str = "lon", radius_km: float = 10.0) -> DataFrame:
    """points with name: payload of the nearest airport closer than radius_km, the first in the file among equals; else null."""
    lists = sent(airports, cells(airports, payload))
    r = points.withColumns({"_cy": F.rint(lat).cast("int"), "_cx": F.rint(lon).cast("int")})
    r = r.join(lists, (F.col("_cy") == F.col("cy")) & (F.col("_cx") == F.col("cx")), "left")
    ranked = F.transform("near", lambda a: F.struct(geo.km(F.col(lat), F.col(lon), a["a_lat"], a["a_lon"]).alias("d"), a["pos"].alias("pos"), a["payload"].alias("payload")))
    best = F.array_min(F.filter(ranked, lambda a: a["d"] < radius_km))
    return r.withColumn(name, best["payload"]).drop("_cy", "_cx", "cy", "cx", "near")


def surface_snap(points: DataFrame, airports: DataFrame, taxi_kt: float = 40.0, above_ft: float = 500.0) -> DataFrame:
    """points, which have alt, with elev, surface and alt and gnd as they are on the surface: near an airport, and on the ground
    or slow and low, a point is on the ground at the airport's elevation."""
    r = nearest_airport(points, airports, "elev", "elev")
    low = F.col("gs").isNotNull() & (F.col("gs") < taxi_kt) & (F.col("alt").isNull() | (F.col("alt") < F.col("elev") + above_ft))
    r = r.withColumn("surface", F.col("elev").isNotNull() & (F.col("gnd") | low))
    alt = F.when(F.col("surface"), F.col("elev").cast("double")).when(~F.col("gnd"), F.col("alt"))
    return r.withColumns({"alt": alt, "gnd": F.col("gnd") | F.col("surface")})
