import gzip
import json
import math

import pytest
from pyspark.sql import functions as F

from contrail.operators import codec, legs
from contrail.operators.nearest import nearest_airport
from contrail.sources import sinks, traces


def point(t, lat, lon, alt, *rest):
    return [t, lat, lon, alt, 100.0, 90.0, 0, 64, None, *(rest or ("adsb_icao", 1000, 5))]


@pytest.fixture
def folder(tmp_path):
    docs = {
        "trace_full_aaaaaa.json": json.dumps({"icao": "aaaaaa", "r": "X-1", "t": "B738", "timestamp": 1000, "trace": [point(0, 1, 2, "ground"), point(1, 1, 2, "1200"), point(2.5, 1, 2, 1200, {"type": "mlat"}, None, None), point(3, 1, 2, None)]}).encode(),
        "trace_full_bbbbbb.json": gzip.compress(json.dumps({"trace": [point(0, 1, 2, 5)]}).encode()),
        "trace_full_cccccc.json": b'{"icao": "cccccc", "trace": [[0, 1, 2',
        "trace_full_dddddd.json": json.dumps({"icao": "dddddd", "trace": [[0, 1, 2, 3]]}).encode(),
        "trace_full_eeeeee.json": json.dumps({"icao": "eeeeee", "trace": [point(0, None, 2, 3)]}).encode(),
        "trace_full_ffffff.json": b"\x1f\x8bnot gzip",
        "other.json": b"{}",
    }
    for name, data in docs.items():
        (tmp_path / name).write_bytes(data)
    return str(tmp_path)


def test_trace_documents(spark, folder):
    docs = traces.documents(traces.files(spark, folder))
    samples, bad = traces.samples(docs)
    rows = {(r.icao, r.seq): r for r in samples.collect()}
    assert set(rows) == {("aaaaaa", 0), ("aaaaaa", 1), ("aaaaaa", 2), ("aaaaaa", 3), ("bbbbbb", 0)}
    first, text, mlat, none = (rows["aaaaaa", k] for k in range(4))
    assert first.gnd and first.baro is None and first.geom == 1000 and first.vr == 5 and first.src == "adsb_icao" and first.base_ts == 1000
    assert not text.gnd and text.baro is None and text.gate_ft == 1200 and mlat.gate_ft == 1200 and first.gate_ft is None
    assert mlat.baro == 1200 and mlat.src == "mlat" and mlat.geom is None and mlat.vr == 64 and mlat.t == 2.5
    assert not none.gnd and none.baro is None
    reasons = {r.path[-11:-5]: r.error for r in bad.collect()}
    assert set(reasons) == {"cccccc", "dddddd", "eeeeee", "ffffff"} and reasons["dddddd"] == "point too short" and reasons["ffffff"].startswith("unreadable")
    assert {r.icao: r.type for r in traces.aircraft(docs).collect()}["aaaaaa"] == "B738"
    assert traces.files(spark, folder, sample=2).count() == 2


def test_airports(spark, tmp_path):
    p = tmp_path / "airports.csv"
    p.write_text("ident,latitude_deg,longitude_deg,elevation_ft\nA,50.0,4.0,184.9\nB,50.01,4.0,\nC,x,4,1\n")
    a = traces.airports(spark, str(p))
    assert [(r.ident, r.elev) for r in a.orderBy("pos").collect()] == [("A", 184), ("B", None)]
    points = spark.createDataFrame([(0, 50.0, 4.0), (1, 50.005, 4.0), (2, 50.2, 4.0), (3, 50.009, 4.0)], "seq long, lat double, lon double")
    ident = {r.seq: r.ident for r in nearest_airport(points, a, "ident", "ident").collect()}
    assert ident == {0: "A", 1: ident[1], 2: None, 3: "B"} and ident[1] in "AB"
    assert {r.seq: r.e for r in nearest_airport(points, a, "elev", "e").collect()} == {0: 184, 1: 184, 2: None, 3: 184}


def track(*legs_):
    """Points of one aircraft: True is ground."""
    rows = []
    for ground, lat in legs_:
        rows.append(("a", len(rows), float(len(rows) * 60), lat, 4.0, ground))
    return rows


def test_legs_of_odd_tracks(spark):
    schema = "icao string, seq long, t double, lat double, lon double, gnd boolean"
    ports = spark.createDataFrame([(0, "P", 50.0, 4.0, 0), (1, "Q", 51.0, 4.0, 0)], "pos int, ident string, lat double, lon double, elev int")
    none = spark.createDataFrame(track((True, 50.0), (False, 50.001), (True, 50.0)), schema)
    assert legs.flights(none, ports).count() == 0
    one = spark.createDataFrame(track((True, 50.0), (None, 50.3), (False, 50.6), (True, 51.0)), schema)
    assert [(r.dep, r.arr, r.n_points) for r in legs.flights(one, ports).collect()] == [("P", "Q", 4)]
    two = spark.createDataFrame(track((True, 50.0), (False, 50.3), (False, 50.6), (True, 51.0), (True, 51.0), (False, 50.6), (False, 50.3), (True, 50.0)) + [(None, 9, 1.0, 50.0, 4.0, False)], schema)
    assert sorted((r.leg_id, r.dep, r.arr, r.n_points) for r in legs.flights(two, ports).collect()) == [("a_0", "P", "Q", 4), ("a_1", "Q", "P", 4)]
    lost = spark.createDataFrame([("l0", None, "Q"), ("l1", "P", "P"), ("l2", "P", None), ("l3", "P", "Q")], "leg_id string, dep string, arr string")
    at = lambda **k: sorted((r.leg_id, r.airport) for r in legs.fan_out(lost, **k).collect())
    assert at() == [("l1", "P"), ("l2", "P"), ("l3", "P"), ("l3", "Q")]
    assert at(orphan_arrivals=True) == [("l0", "Q"), ("l1", "P"), ("l2", "P"), ("l3", "P"), ("l3", "Q")]
    assert legs.airport_count(lost).first()[0] == 2


def test_one_file_for_each_airport(spark, tmp_path):
    rows = spark.range(400).select(F.concat(F.lit("A"), F.col("id") % 7).alias("airport"), F.concat(F.lit("i"), F.col("id") % 3).alias("icao"), F.col("id").cast("int").alias("t"))
    out = str(tmp_path / "airports")
    sinks.write_airports(rows, out)
    found = sorted(p.relative_to(out).as_posix() for p in (tmp_path / "airports").rglob("*.parquet"))
    assert found == [f"airport=A{k}/data_0.parquet" for k in range(7)]
    assert spark.read.parquet(out).count() == 400


def test_date_partitions_replace_only_themselves(spark, tmp_path):
    out = str(tmp_path / "traces")
    rows = spark.createDataFrame([("a", 1, 2, 3, 4, "2024-01-01"), ("a", 2, 2, 3, 4, "2024-01-02")], "icao string, t int, lat int, lon int, alt int, date string")
    sinks.write_sorted(rows, out, "date")
    sinks.write_sorted(rows.where("t = 2").withColumn("alt", F.lit(9)), out, "date")
    assert sorted((r.t, r.alt) for r in spark.read.parquet(out).collect()) == [(1, 4), (2, 9)]


def test_blob_archive(spark, tmp_path):
    points = spark.createDataFrame([("a", 0, 5, 1, -2, 3), ("a", 1, 6, 10, 20, None), ("b", 0, 0, 0, 0, 0)], "icao string, seq long, t long, lat long, lon long, alt long")
    archive = codec.blobs(points)
    assert sinks.write_blobs(archive, str(tmp_path / "z")).count() == 2
    back = codec.points(sinks.read_blobs(spark, str(tmp_path / "z")))
    assert sorted(tuple(r) for r in back.collect()) == [("a", 0, 5, 1, -2, 3), ("a", 1, 6, 10, 20, 0), ("b", 0, 0, 0, 0, 0)]
    assert json.loads(sinks.archive_manifest(archive, {"ground_m": 10.0}).first()[0])["count"] == 2


def test_manifest_of_no_dates(spark):
    assert json.loads(sinks.dates_manifest(spark.createDataFrame([], "date string")).first()[0]) == {"dates": [], "latest": None}


def test_command_line(spark, tmp_path):
    from contrail import cli

    src = tmp_path / "in"
    src.mkdir()
    flight = [[k * 10.0, 50 + max(0, min(k - 10, 100)) * 0.01 + max(0, k - 110) * 5e-4, 4.0 + 0.2 * math.sin(max(0, min(k - 10, 100)) * math.pi / 100), "ground" if k < 10 or k > 110 else 3000 + 50 * k, 5.0 if k < 10 or k > 110 else 250.0, 0.0, 0, 0, None, "adsb_icao"] for k in range(121)]
    (src / "trace_full_abcdef.json").write_text(json.dumps({"icao": "abcdef", "r": "X-2", "t": "A320", "timestamp": 1704067200, "trace": flight}))
    (tmp_path / "airports.csv").write_text("ident,latitude_deg,longitude_deg,elevation_ft\nP,50.0,4.0,100\nQ,51.0,4.0,200\n")
    airports, out = str(tmp_path / "airports.csv"), str(tmp_path / "out")
    cli.main(["fit", str(src), out, "--airports", airports])
    cli.main(["legs", "--traces", f"{out}/nodes.parquet", "--meta", f"{out}/aircraft.parquet", "--airports", airports, "--out-dir", f"{out}/legs"])
    f = spark.read.parquet(f"{out}/legs/flights.parquet").collect()
    assert [(r.icao, r.dep, r.arr, r.reg, r.type) for r in f] == [("abcdef", "P", "Q", "X-2", "A320")]
    assert sorted(p.parent.name for p in (tmp_path / "out/legs/airports").rglob("data_0.parquet")) == ["airport=P", "airport=Q"]
    cli.main(["validate", str(src), str(tmp_path / "v"), "--airports", airports])
    assert spark.read.parquet(str(tmp_path / "v/validation.parquet")).first()["within"] > 0.9
    cli.main(["compress", str(src), str(tmp_path / "c"), "--airports", airports, "--partition-by", "date"])
    assert spark.read.parquet(str(tmp_path / "c/traces.parquet")).first()["date"] is not None
    assert spark.read.parquet(str(tmp_path / "c/quarantine_tracks")).count() == 0
    cli.main(["compress", str(src), str(tmp_path / "w"), "--h-low", "2000", "--h-cruise", "2000", "--v-cruise", "9000", "--denormalize"])
    wide = spark.read.parquet(str(tmp_path / "w/traces.parquet"))
    assert wide.count() < spark.read.parquet(str(tmp_path / "c/traces.parquet")).count() and wide.first()["reg"] == "X-2"
    cli.main(["compress", str(src), str(tmp_path / "z"), "--blobs", "--verify"])
    cli.main(["analyse", str(src), str(tmp_path / "a"), "--recon", "catmull"])
    assert spark.read.parquet(str(tmp_path / "a/analysis.parquet")).count() == 1
    cli.main(["smooth", str(src), str(tmp_path / "s"), "--airports", airports, "--jerk", "1.5"])
    assert spark.read.parquet(str(tmp_path / "s/traces.parquet")).count() > 2


def test_days_are_tracks_of_their_own(spark, tmp_path):
    from contrail import cli

    src = tmp_path / "in"
    src.mkdir()
    for day, north in ((0, 0.0), (1, 3.0)):
        flight = [[k * 10.0, 50 + north + k * 0.01, 4.0 + 0.2 * math.sin(k * math.pi / 99), "ground" if k in (0, 99) else 5000, 250.0, 0.0, 0, 0, None, "adsb_icao"] for k in range(100)]
        (src / str(day)).mkdir()
        (src / str(day) / "trace_full_abcdef.json").write_text(json.dumps({"icao": "abcdef", "r": "X-2", "t": "A320", "timestamp": 1704067200 + 86400 * day, "trace": flight}))
    (tmp_path / "airports.csv").write_text("ident,latitude_deg,longitude_deg,elevation_ft\nP,50.0,4.0,100\nQ,53.0,4.0,200\n")
    airports, out = str(tmp_path / "airports.csv"), str(tmp_path / "out")
    cli.main(["fit", str(src), out, "--airports", airports])
    nodes = spark.read.parquet(f"{out}/nodes.parquet")
    assert {(r.icao, r.date) for r in nodes.collect()} == {("abcdef", "2024-01-01"), ("abcdef", "2024-01-02")}
    cli.main(["legs", "--traces", f"{out}/nodes.parquet", "--meta", f"{out}/aircraft.parquet", "--airports", airports, "--out-dir", f"{out}/legs"])
    found = sorted((r.leg_id, r.icao, r.date, r.dep, r.reg) for r in spark.read.parquet(f"{out}/legs/flights.parquet").collect())
    assert found == [("abcdef_2024-01-01_0", "abcdef", "2024-01-01", "P", "X-2"), ("abcdef_2024-01-02_0", "abcdef", "2024-01-02", "Q", "X-2")]


def test_a_track_that_fails_stays_alone(spark):
    from contrail.operators import scans

    rows = spark.createDataFrame([("a", 0, 0.0, 1.0), ("a", 1, 1.0, 2.0), ("b", 0, 0.0, -1.0), ("b", 1, 1.0, 3.0)], "icao string, seq long, t double, x double")
    got = scans.per_track(rows, {"y": "double"}, lambda c: {"y": [math.sqrt(v) for v in c["x"]]}, "x", errors=True).orderBy("icao", "seq").collect()
    assert [r.y is None for r in got] == [False, False, True, True]
    assert [r.error is None for r in got] == [True, True, False, True] and got[2].error.startswith("ValueError")
    with pytest.raises(Exception, match="expected a nonnegative input|math domain"):
        scans.per_track(rows, {"y": "double"}, lambda c: {"y": [math.sqrt(v) for v in c["x"]]}, "x").collect()
