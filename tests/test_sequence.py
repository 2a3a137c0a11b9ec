"""Hand-made tracks for the operators that look at neighbours."""

import pytest
from pyspark.sql import functions as F

from contrail.operators import scans
from contrail.operators import sequence as seq
from contrail.operators.nearest import nearest_airport

SCHEMA = "icao string, seq long, t double, lat double, lon double, gnd boolean, baro double, geom double, gs double, trk double, vr double, src string"
M = 1 / 111_320.0  # a metre in degrees of latitude


@pytest.fixture
def track(spark):
    def make(*points):
        """Points as dicts; what isn't given is a parked fix a second after the one before."""
        rows = []
        for k, p in enumerate(points):
            p = {"t": float(k), "lat": 50.0, "lon": 4.0, "gnd": True, "baro": None, "geom": None, "gs": 0.0, "trk": None, "vr": None, "src": None} | p
            rows.append((p.pop("icao", "a"), k, *[p[c] for c in ("t", "lat", "lon", "gnd", "baro", "geom", "gs", "trk", "vr", "src")]))
        return spark.createDataFrame(rows, SCHEMA)

    return make


def column(df, name):
    return [r[0] for r in df.orderBy("icao", "seq").select(name).collect()]


def test_parked_runs(track):
    two = track({}, {"lat": 50 + 5 * M})
    assert column(seq.parked(two), "merged") == [1, 1]
    tight = track({}, {"lat": 50 + 5 * M}, {"lat": 50 + 9 * M}, {"gs": 15.0, "lat": 50.1})
    assert column(seq.parked(tight), "merged") == [3, 3, 1]
    assert column(seq.parked(tight), "lat")[:2] == [50 + 5 * M] * 2
    creep = track({"gs": 1.5}, {"gs": 1.5, "lat": 50 + 30 * M}, {"gs": 1.5, "lat": 50 + 60 * M})
    assert column(seq.parked(creep), "merged") == [1, 1, 1]
    unknown = track({"gs": None}, {"gs": None, "lat": 50 + 100 * M}, {"gs": None})
    assert column(seq.parked(unknown), "merged") == [3, 3]
    at_once = track({"t": 0.0}, {"t": 0.0}, {"t": 0.0})
    assert column(seq.parked(at_once), "merged") == [3]


def test_stops_are_snapped(track):
    short = track({"gnd": False}, {"gnd": False, "lat": 50 + 90 * M}, {"gs": 30.0, "gnd": False})
    r = seq.stationary_snap(short)
    assert column(r, "gnd") == [True, True, False] and column(r, "snapped") == [False] * 3
    dwell = track({"gnd": False}, {"gnd": False, "t": 25.0, "lat": 50 + 90 * M}, {"t": 30.0, "gs": None})
    r = seq.stationary_snap(dwell)
    assert column(r, "snapped") == [True, True, False] and len(set(column(r, "lat")[:2])) == 1


@pytest.fixture
def backwards(spark, track):
    """Two tracks whose rows come the other way round, while each sort spills after every row, as it does at size. Their latitudes add up to 0 only in order of time."""
    conf, spills = spark._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    before = conf.get(spills, str(2**31 - 1))
    conf.set(spills, "1")
    yield track(*[{"icao": i, "t": k / 100, "lat": x, "gnd": False} for i in "ab" for k, x in enumerate([2.0**53, *[1.0] * 38, -(2.0**53)])]).orderBy(F.desc("seq"))
    conf.set(spills, before)


def test_means_of_buckets_in_order_of_time(backwards):
    assert column(scans.decimate(backwards), "lat") == [0.0] * 2


def test_centres_of_stops_in_order_of_time(backwards):
    assert column(seq.stationary_snap(backwards.withColumn("t", F.col("t") * 100)), "lat") == [0.0] * 80


def test_reversals(track):
    parked = track({}, {"lat": 50 + 20 * M, "gs": 0.0}, {"lat": 50 + 5 * M})
    assert column(seq.ground_reversals(parked), "reversal") == [False, True, False]
    wobble = track({"gs": 8.0}, {"lat": 50 + 20 * M, "gs": 8.0}, {"lat": 50 + 2 * M, "gs": 8.0})
    assert column(seq.ground_reversals(wobble), "reversal") == [False, True, False]
    backtrack = track({"gs": 20.0}, {"lat": 50 + 300 * M, "gs": 20.0}, {"lat": 50 + 2 * M, "gs": 20.0})
    assert column(seq.ground_reversals(backtrack), "reversal") == [False] * 3
    gap = track({}, {"t": 400.0, "lat": 50 + 20 * M}, {"t": 700.0})
    assert column(seq.ground_reversals(gap), "reversal") == [False] * 3


def test_buckets(track):
    tie = track({"t": 0.5, "gnd": True, "gs": 2.0, "src": "x"}, {"t": 1.2, "gnd": False, "gs": None, "src": "y"}, {"t": 1.6, "gnd": False})
    r = scans.decimate(tie).orderBy("bucket").collect()
    assert [(x.gnd, x.gs, x.src, x.merged) for x in r] == [(True, 2.0, "y", 2), (False, 0.0, None, 1)] and abs(r[0].t - 0.85) < 1e-12


def test_datum(track):
    air = {"gnd": False}
    known = track(air | {"baro": 100.0, "geom": 150.0}, air | {"baro": 200.0}, air | {"baro": 300.0, "geom": 390.0}, air | {"baro": 400.0}, air, {"baro": 5.0, "geom": 7.0})
    assert column(seq.datum(known), "alt") == [150.0, 270.0, 390.0, 490.0, None, 7.0]
    baro_only = track(air | {"baro": 100.0}, air | {"baro": 200.0})
    assert column(seq.datum(baro_only), "alt") == [100.0, 200.0]


def test_ground_hold(track):
    rows = track({}, {}, {}, {"gnd": False}, {}, {}).withColumn("elev", F.element_at(F.array(*[F.lit(x) for x in (None, 175, 184, 9, 184, 175)]), (F.col("seq") + 1).cast("int")))
    assert column(seq.ground_hold(rows), "held") == [None, 175, 175, None, 184, 184]


def test_corners(track):
    r = seq.corners(seq.projected(track({}, {"lat": 50.01}, {"lat": 50.02}, {"lat": 50.02, "lon": 4.02}, {"lat": 50.02, "lon": 4.02}, {"lat": 50.02, "lon": 4.04, "gnd": False})))
    assert column(r, "corner") == [True, False, True, True, True, True]


def test_airport_ties_and_edges(spark, track):
    ports = spark.createDataFrame([(0, "first", 50.0, 4.01), (1, "second", 50.0, 3.99), (2, "date line", 0.0, 179.99), (3, "pole", 89.95, 0.0)], "pos int, ident string, lat double, lon double")
    at = track({}, {"lat": 0.0, "lon": -179.99}, {"lat": 89.9, "lon": 0.0}, {"lat": 50.0, "lon": 3.995})
    assert column(nearest_airport(at, ports, "ident", "ident"), "ident") == ["first", None, "pole", "second"]
    assert column(nearest_airport(at, ports.limit(0), "ident", "ident"), "ident") == [None] * 4


def test_track_plans_without_points(track):
    from contrail.plans import tracks

    none = track({}).where("false")
    assert tracks.compress(none).count() == tracks.fit(none).count() == tracks.smooth(none).count() == 0
    one = track({})
    assert tracks.compress(one).count() == tracks.fit(one).count() == tracks.smooth(one).count() == 0


def test_a_track_of_a_whole_day(spark):
    """50,000 fixes of one aircraft: what follows a row is found without going through the track anew for each row."""
    import time

    from pyspark.sql import functions as F

    from contrail.operators import legs
    from contrail.operators import sequence as seq

    n = 50_000
    i = F.col("id")
    r = spark.range(n).select(
        F.lit("a").alias("icao"), i.alias("seq"), i.cast("double").alias("t"), (40 + i * 1e-5).alias("lat"), (2 + i * 1e-5).alias("lon"), ((i < 100) | (i > n - 100)).alias("gnd"),
        F.when((i == 0) | (i == n - 1), F.lit(100.0)).alias("geom"), F.lit(50.0).alias("baro"),
    )
    r = r.withColumn("baro", F.when(F.col("gnd"), None).otherwise(F.col("baro")))
    began = time.time()
    assert seq.datum(r).agg(F.count("alt")).first()[0] > 0
    assert legs.leg_points(r).agg(F.max("leg")).first()[0] == 0
    kept = seq.linear_error(seq.projected(r), (F.col("seq") == 0) | (F.col("seq") == n - 1))
    assert kept.agg(F.max("err")).first()[0] < 1
    assert time.time() - began < 60
