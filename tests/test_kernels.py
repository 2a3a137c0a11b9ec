import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.operators import bezier, codec, curves, kalman, scans, thinning

coordinate = st.integers(-(2**40), 2**40)
tracks = st.lists(st.tuples(st.floats(-5e4, 5e4), st.floats(-5e4, 5e4)), min_size=3, max_size=40, unique=True)


@given(st.lists(st.tuples(*[coordinate] * 4), max_size=30))
def test_codec_round_trip(rows):
    r = np.array(rows, dtype=np.int64).reshape(-1, 4)
    assert (codec.decode(codec.encode(r)) == r).all()


@given(st.lists(st.integers(0, 2**64 - 1)))
def test_variable_length_integers(values):
    v = np.array(values, dtype=np.uint64)
    assert (codec.unpack(codec.pack(v)) == v).all()


def test_codec_is_reproducible():
    assert codec.encode([(1, 2, 3, 4)]) == codec.encode([(1, 2, 3, 4)])


@given(tracks, st.floats(1, 500))
@settings(max_examples=60, deadline=None)
def test_nodes_keep_the_tolerance(points, metres):
    p, tol = np.array(points), np.full(len(points), metres)
    k = curves.place_nodes(p, tol)
    assert k[0] == 0 and k[-1] == len(p) - 1
    for a, b in zip(range(len(k) - 1), k[1:]):
        before, after = p[k[a - 1] if a else k[0]], p[k[a + 2] if a + 2 < len(k) else b]
        line = curves.curve(before, p[k[a]], p[b], after, np.arange(curves.SUB + 1) / curves.SUB)
        inside = p[k[a] + 1 : b]
        assert not len(inside) or (curves.distances(inside, line) <= metres + 1e-6).all()


@given(tracks, st.floats(1, 500))
@settings(max_examples=60, deadline=None)
def test_thinning_keeps_ends_and_tolerance(points, metres):
    p, tol = np.array(points), np.full(len(points), metres)
    kept = np.flatnonzero(thinning.horizontal(p[:, 0], p[:, 1], tol))
    assert kept[0] == 0 and kept[-1] == len(p) - 1
    for a, b in zip(kept[:-1], kept[1:]):
        d = p[b] - p[a]
        off = np.abs(d[0] * (p[a, 1] - p[a + 1 : b, 1]) - d[1] * (p[a, 0] - p[a + 1 : b, 0])) / max(np.hypot(*d), 1e-9)
        assert (off <= metres * (1 + 1e-9)).all()


@given(st.lists(st.tuples(st.floats(0, 1e4), st.floats(40, 41), st.floats(2, 3), st.floats(0, 4e4)), min_size=1, max_size=40))
def test_speed_gate_leaves_no_step_over_the_cap(rows):
    t, lat, lon, alt = zip(*sorted(rows))
    kept = [i for i, ok in enumerate(scans.accepted(t, lat, lon, alt)) if ok]
    for a, b in zip(kept, kept[1:]):
        dist = scans._km((lat[a], lon[a]), (lat[b], lon[b]))
        hours = (t[b] - t[a]) / 3600
        assert dist / hours <= 1300 + 1e-6 if hours > 0 else dist < 0.5


def test_speed_gate_drops_a_teleport_and_keeps_what_follows():
    assert scans.accepted([0, 10, 20], [40, 45, 40.001], [2, 2, 2], [0, 0, 0]) == [True, False, True]
    assert scans.accepted([0, 0], [40, 40.01], [2, 2], [0, 0]) == [True, False]


def test_despike():
    t, ground = list(range(7)), [False] * 7
    assert scans.despiked(t, [1000, 1000, 3000, 1000, 1000, 1000, 1000], ground) == [1000] * 7
    assert scans.despiked(t, [1000, 1000, 3000, 3000, 1000, 1000, 1000], ground) == [1000] * 7
    three = [1000, 3000, 3000, 3000, 1000, 1000, 1000]
    assert scans.despiked(t, three, ground) == three
    climb = [0, 500, 1000, 1500, 2000, 2500, 3000]
    assert scans.despiked(t, climb, ground) == climb
    slow = [x * 20 for x in t]
    assert scans.despiked(slow, [1000, 3000, 1000, 1000, None, 1000, 1000], ground)[1] == 3000


def test_buckets_begin_at_their_first_time():
    assert scans.bucket_starts([0.0, 0.9, 1.0, 1.95, 2.0, 5.0]) == [0, 0, 1, 1, 2, 3]
    assert scans.bucket_starts([0.5, 1.2, 1.6]) == [0, 0, 1]


def test_bezier_stays_within_tolerance():
    t = np.linspace(0, 6, 200)
    p = np.stack((1000 * t, 3000 * np.sin(t)), 1) + np.random.default_rng(0).normal(0, 3, (200, 2))
    cubics = bezier.fit(p, np.full(200, 15.0))
    assert len(cubics) < 40
    line = np.concatenate([bezier.evaluate(b, np.linspace(0, 1, 60)) for b in cubics])
    assert curves.distances(p, line).max() <= 15.5


def test_node_codecs_round_trip():
    t = np.linspace(0, 6, 200)
    p = np.rint(np.stack((1000 * t, 3000 * np.sin(t)), 1))
    at, cusp, handles = bezier.nodes(p, np.full(200, 15.0), np.zeros(200, bool))
    fixed = np.stack((p[at, 1], p[at, 0], at), 1).astype(np.int64)
    for predict in (False, True):
        blob = codec.encode_nodes(fixed, cusp, p[at], handles, predict)
        f, c, h = codec.decode_nodes(blob, lambda x: x[:, [1, 0]].astype(float), predict)
        assert (f == fixed).all() and (c == cusp).all() and (np.isnan(h) == np.isnan(handles)).all()
        assert np.nanmax(np.abs(h - handles)) <= codec.HANDLE_M / 2 + 1e-9


def test_smoothing_takes_noise_out_of_a_line():
    rng = np.random.default_rng(0)
    n = 200
    t = np.arange(n) * 5.0
    lat, lon = 50 + t * 2e-4, 4 + t * 3e-4
    noisy = lat + rng.normal(0, 60 / 111320, n), lon + rng.normal(0, 60 / 111320, n)
    none, flat = [None] * n, [30000.0] * n
    y, x, alt = kalman.smooth(t.tolist(), noisy[0].tolist(), noisy[1].tolist(), [False] * n, flat, none, none, none, none, ["mlat"] * n)
    assert np.isfinite(y).all() and np.isfinite(x).all() and abs(alt.mean() - 30000) < 1
    assert np.abs(y - lat).mean() < 0.7 * np.abs(noisy[0] - lat).mean()


def test_a_corner_breaks_the_curve():
    p = np.concatenate((np.stack((np.arange(20) * 100.0, np.zeros(20)), 1), np.stack((np.full(19, 1900.0), np.arange(1, 20) * 100.0), 1)))
    at, cusp = curves.fit(p, np.full(39, 5.0), np.zeros(39, bool))
    assert at.tolist() == [0, 19, 38] and cusp.all()
