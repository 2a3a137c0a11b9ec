"""Whole-track plans against plain versions: every point looked at, nothing vectorised or kept from step to step."""

import math
import statistics

import numpy as np
import pytest

from contrail.operators import bezier, codec
from contrail.plans import registry, tracks
from contrail.plans.oracles import LEGS, milli
from contrail.sources import fixtures
from tests.compare import connect, rows as as_rows

DEGREE = 111_320.0


def by_track(df):
    """{icao: rows in (t, seq) order}."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.icao, r.t, r.seq)):
        out.setdefault(r.icao, []).append(r)
    return out


def ramp(v, a, b, low, high):
    return low if v <= a else high if v >= b else low + (v - a) * (high - low) / (b - a)


def metres(rows):
    kx = math.cos(math.radians(sum(r.lat for r in rows) / len(rows)))
    return [(r.lon * DEGREE * kx, r.lat * DEGREE) for r in rows]


def split_at_worst(n, off, tol):
    """Douglas-Peucker by its definition: off(a, i, b) is how far point i is from what a and b say."""
    keep = {0, n - 1}

    def go(a, b):
        inner = range(a + 1, b)
        if not inner:
            return
        d = [off(a, i, b) for i in inner]
        if max(d) > min(tol[i] for i in inner):
            k = a + 1 + d.index(max(d))
            keep.add(k)
            go(a, k)
            go(k, b)

    go(0, n - 1)
    return keep


def thinned(t, xy, alt, ground, ground_m=10.0):
    across = [ground_m if g else ramp(a, 2000, 12000, 20, 150) for a, g in zip(alt, ground)]
    up = [25 if g else ramp(a, 2000, 12000, 25, 250) for a, g in zip(alt, ground)]

    def sideways(a, i, b):
        (x0, y0), (x, y), (x1, y1) = xy[a], xy[i], xy[b]
        return abs((x1 - x0) * (y0 - y) - (y1 - y0) * (x0 - x)) / max(math.hypot(x1 - x0, y1 - y0), 1e-9)

    def vertical(a, i, b):
        u = (t[i] - t[a]) / (t[b] - t[a]) if t[b] > t[a] else 0
        return abs(alt[i] - (alt[a] + (alt[b] - alt[a]) * u))

    return split_at_worst(len(t), sideways, across) | split_at_worst(len(t), vertical, up)


def despiked(t, alt, ground):
    known = [i for i, a in enumerate(alt) if a is not None]
    out, k = list(alt), 1
    while k < len(known) - 1:
        step = 1
        for n in (1, 2):
            if k + n >= len(known):
                break
            p, q, inner = known[k - 1], known[k + n], known[k : k + n]
            if abs(alt[p] - alt[q]) < 400 and t[q] - t[p] <= 30 and not any(ground[i] for i in inner) and all(abs(alt[i] - alt[e]) > 400 for i in inner for e in (p, q)):
                for i in inner:
                    out[i] = float(round(alt[p] + (alt[q] - alt[p]) * (t[i] - t[p]) / ((t[q] - t[p]) or 1)))
                step = n + 1
                break
        k += step
    return out


def km(a, b):
    return math.hypot((b.lat - a.lat) * 111.32, (b.lon - a.lon) * 111.32 * math.cos(math.radians(a.lat)))


def reversals(rows, ground):
    """Places in rows of ground points that stick out of their neighbours on the ground."""
    at, out = [i for i, g in enumerate(ground) if g], set()
    for a, b, c in zip(at, at[1:], at[2:]):
        p, q, r = rows[a], rows[b], rows[c]
        step, across = 1000 * max(km(p, q), km(q, r)), 1000 * km(p, r)
        sticks = across < step if q.gs is not None and q.gs < 1.5 else step < 30 and across < 0.5 * step
        if r.t - p.t <= 600 and step > 8 and sticks:
            out.add(b)
    return out


def last_of_second(rows):
    return [r for r, after in zip(rows, [*rows[1:], None]) if after is None or round(after[1]) != round(r[1])]


def fixed(v):
    return round(v * 1e5)


def test_dp_nodes(spark, sf_dir):
    want = []
    for icao, rows in by_track(tracks.levelled(fixtures.dense(spark, sf_dir), fixtures.airports(spark, sf_dir))).items():
        t, ground = [r.t for r in rows], [r.gnd for r in rows]
        alt = despiked(t, [r.alt for r in rows], ground)
        ends = {0, len(rows) - 1}
        keep = sorted(thinned(t, metres(rows), [a or 0.0 for a in alt], ground) - reversals(rows, ground) | ends)
        for i, a in zip(keep, despiked([t[i] for i in keep], [alt[i] for i in keep], [ground[i] for i in keep])):
            alt[i] = a
        gone = {keep[k] for k in reversals([rows[i] for i in keep], [ground[i] for i in keep])}
        kept = [(rows[i].seq, t[i], rows[i].lat, rows[i].lon, alt[i], ground[i]) for i in keep if i not in gone or i in ends]
        want += [(icao, s, round(x), fixed(la), fixed(lo), None if a is None else round(a), g) for s, x, la, lo, a, g in last_of_second(kept)]
    got = [(r.icao, r.seq, r.t, r.lat, r.lon, r.alt, r.on_ground) for r in registry.queries()["dp_nodes"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want) and len(got) > 100


def curve(p, u):
    """Barry and Goldman's pyramid over centripetal knots."""
    knots = [0.0]
    for a, b in zip(p, p[1:]):
        knots.append(knots[-1] + math.sqrt(max(math.hypot(b[0] - a[0], b[1] - a[1]), 1e-9)))
    t, level = knots[1] + (knots[2] - knots[1]) * u, [tuple(map(float, q)) for q in p]
    for width in (1, 2, 3):
        new = []
        for k in range(len(level) - 1):
            lo, hi = (k, k + width) if width < 3 else (1, 2)
            if width == 2:
                lo, hi = k, k + 2
            f = (t - knots[lo]) / (knots[hi] - knots[lo])
            new.append(tuple(x + (y - x) * f for x, y in zip(level[k], level[k + 1])))
        level = new
    return level[0]


def to_chord(q, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    n = dx * dx + dy * dy or 1e-9
    u = min(1.0, max(0.0, ((q[0] - a[0]) * dx + (q[1] - a[1]) * dy) / n))
    return math.hypot(q[0] - a[0] - u * dx, q[1] - a[1] - u * dy)


def placed(points, tol, sub=12):
    """Nodes by measuring every span anew for each node: the point that is farthest beyond its tolerance becomes one."""
    nodes = [0, len(points) - 1]
    while len(points) > 2:
        worst, at = 0.0, None
        for k, (a, b) in enumerate(zip(nodes, nodes[1:])):
            if b - a < 2:
                continue
            p = [points[nodes[max(k - 1, 0)]], points[a], points[b], points[nodes[min(k + 2, len(nodes) - 1)]]]
            line = [curve(p, j / sub) for j in range(sub + 1)]
            for i in range(a + 1, b):
                over = min(to_chord(points[i], x, y) for x, y in zip(line, line[1:])) - tol[i]
                if over > worst:
                    worst, at = over, i
        if at is None:
            break
        nodes = sorted([*nodes, at])
    return nodes


def moved(xy, least):
    out = [0]
    for i in range(1, len(xy)):
        if math.dist(xy[i], xy[out[-1]]) > least:
            out.append(i)
    return out


def held(elev, ground):
    out = list(elev)
    for i, g in enumerate(ground):
        if g and elev[i] is not None:
            a = max((j for j in range(i + 1) if not ground[j]), default=-1) + 1
            b = min((j for j in range(i, len(ground)) if not ground[j]), default=len(ground))
            known = [e for e in elev[a:b] if e is not None]
            out[i] = max(known, key=lambda e: (known.count(e), -known.index(e)))
        elif not g:
            out[i] = None
    return out


def test_cr_nodes(spark, sf_dir):
    want = []
    for icao, rows in by_track(tracks.prepared(fixtures.dense(spark, sf_dir), fixtures.airports(spark, sf_dir))).items():
        every = metres(rows)
        at = moved(every, 1.0)
        if len(at) < 3:
            continue
        xy, ground = [every[i] for i in at], [rows[i].gnd for i in at]
        alt = [e if e is not None else rows[i].alt or 0.0 for i, e in zip(at, held([rows[i].elev for i in at], ground))]
        tol = [ramp(a, 500, 12000, 2, 150) for a in alt]
        cuts = [0]
        for k in range(1, len(xy) - 1):
            a, b = [(q[0] - p[0], q[1] - p[1]) for p, q in ((xy[k - 1], xy[k]), (xy[k], xy[k + 1]))]
            cos = (a[0] * b[0] + a[1] * b[1]) / (math.hypot(*a) * math.hypot(*b))
            if math.degrees(math.acos(max(-1.0, min(1.0, cos)))) > 35 or ground[k] != ground[k - 1]:
                cuts.append(k)
        cuts.append(len(xy) - 1)
        nodes = sorted({a + k for a, b in zip(cuts, cuts[1:]) for k in placed(xy[a : b + 1], tol[a : b + 1])})
        want += [(icao, rows[at[k]].seq, round(rows[at[k]].t * 10), fixed(rows[at[k]].lat), fixed(rows[at[k]].lon), round(alt[k]), ground[k], k in cuts) for k in nodes]
    got = [(r.icao, r.seq, r.t, r.lat, r.lon, r.alt, r.on_ground, r.cusp) for r in registry.queries()["cr_nodes"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want) and len(got) > 100


def rts(t, rows, alt, field):
    """One filter of nine states (position, speed, acceleration; east, north, up in each) and the fixed-interval smoother, in matrices."""
    n, lat0, lon0 = len(rows), sum(r.lat for r in rows) / len(rows), sum(r.lon for r in rows) / len(rows)
    mlon = DEGREE * math.cos(math.radians(lat0))
    noise = {"mlat": (120, 10, 60), "adsb": (18, 2.5, 15), "adsr": (18, 2.5, 15), "tisb": (60, 6, 30)}
    measured = []
    for i, r in enumerate(rows):
        pos, vel, high = next((v for k, v in noise.items() if k in (r.src or "")), (40, 5, 25))
        pos *= 3 if r.gnd else 1
        m = [(0, (r.lon - lon0) * mlon, pos**2), (1, (r.lat - lat0) * DEGREE, pos**2)]
        if field[i] is not None:
            m.append((2, field[i] * 0.3048, 25.0))
        elif alt[i] is not None:
            m.append((2, alt[i] * 0.3048, high**2))
        if not r.gnd and r.gs is not None and r.trk is not None:
            v, a = r.gs * KNOT, math.radians(r.trk)
            m += [(3, v * math.sin(a), vel**2), (4, v * math.cos(a), vel**2)]
        if r.gnd:
            m += [(6, 0.0, 0.15**2), (7, 0.0, 0.15**2)]
            if r.gs is None or r.gs < 1.5:
                m += [(3, 0.0, 0.09), (4, 0.0, 0.09)]
        if r.vr is not None:
            m.append((5, r.vr * 0.3048 / 60, 4.0))
        measured.append(m)
    first = field[0] if field[0] is not None else alt[0]
    x, p = np.zeros(9), np.diag([1e4] * 3 + [1e2] * 3 + [1e1] * 3)
    x[:2] = measured[0][0][1], measured[0][1][1]
    x[2] = 0 if first is None else first * 0.3048
    if not rows[0].gnd:
        for k, z, _ in measured[0]:
            if k in (3, 4):
                x[k] = z
    before, after, steps = [], [], []
    for i in range(n):
        f = np.eye(9)
        if i:
            h = min(60.0, max(1e-3, t[i] - t[i - 1]))
            q = np.zeros((9, 9))
            for c in range(3):
                f[c, 3 + c], f[c, 6 + c], f[3 + c, 6 + c] = h, h * h / 2, h
                jerk = 1.0 if c == 2 else 0.05 if rows[i].gnd and rows[i - 1].gnd else 2.0
                s = [c, 3 + c, 6 + c]
                q[np.ix_(s, s)] = jerk * np.array([[h**5 / 20, h**4 / 8, h**3 / 6], [h**4 / 8, h**3 / 3, h**2 / 2], [h**3 / 6, h**2 / 2, h]])
            x, p = f @ x, f @ p @ f.T + q
        steps.append(f)
        before.append((x, p))
        for k, z, r in measured[i]:
            y, s = z - x[k], p[k, k] + r
            if y * y / s > 16:
                s = p[k, k] + r * (y * y / s / 16)
            g = p[:, k] / s
            x, p = x + g * y, p - np.outer(g, p[k])
        after.append((x, p))
    out = [after[-1][0]]
    for i in range(n - 2, -1, -1):
        (x, p), (xp, pp) = after[i], before[i + 1]
        out.append(x + p @ steps[i + 1].T @ np.linalg.solve(pp, out[-1] - xp))
    out.reverse()
    return [(lat0 + v[1] / DEGREE, lon0 + v[0] / mlon, v[2] / 0.3048) for v in out]


KNOT = 0.514444


def test_smoothed(spark, sf_dir):
    """Positions to a metre's hundredth before thinning; then the same points by the plain thinning, but for those at the very edge of a tolerance."""
    from pyspark.sql import functions as F

    from contrail.operators import kalman
    from contrail.operators import sequence as seq
    from contrail.operators.nearest import nearest_airport

    got = {(r.icao, r.seq): r for r in registry.queries()["smoothed"](spark, sf_dir).collect()}
    r = nearest_airport(seq.datum(seq.long_enough(fixtures.dense(spark, sf_dir), 2)), fixtures.airports(spark, sf_dir), "elev", "elev")
    r = r.withColumn("elev", F.when(F.col("gnd"), F.col("elev").cast("double")))
    want, n = set(), 0
    for icao, rows in list(by_track(r).items())[:6]:
        t = [x.t for x in rows]
        found = rts(t, rows, [x.alt for x in rows], [x.elev for x in rows])
        c = {k: [x[k] for x in rows] for k in ("t", "lat", "lon", "gnd", "alt", "elev", "gs", "trk", "vr", "src")}
        lat, lon, alt = kalman.smooth(*c.values())
        assert max(abs(a - b[0]) * DEGREE for a, b in zip(lat, found)) < 0.01 and max(abs(a - b[1]) * DEGREE for a, b in zip(lon, found)) < 0.01
        assert max(abs(a - b[2]) for a, b in zip(alt, found)) < 0.01
        kx = math.cos(math.radians(sum(f[0] for f in found) / len(found)))
        xy = [(b * DEGREE * kx, a * DEGREE) for a, b, _ in found]
        keep = sorted(thinned([round(x) for x in t], xy, [round(a) for *_, a in found], [x.gnd for x in rows], 5.0))
        last = last_of_second([(rows[i].seq, t[i]) for i in keep])
        want |= {(icao, s) for s, _ in last}
        n += len(last)
        for s, _ in last:
            k = next(i for i, x in enumerate(rows) if x.seq == s)
            if (icao, s) in got:
                g = got[icao, s]
                assert abs(g.lat - found[k][0] * 1e5) <= 1 and abs(g.lon - found[k][1] * 1e5) <= 1 and abs(g.alt - found[k][2]) <= 1
    mine = {k for k in got if k[0] in {i for i, _ in want}}
    assert len(mine ^ want) <= 0.01 * n


def test_compress_analysis_and_report(spark, sf_dir):
    points = {}
    for r in fixtures.dense(spark, sf_dir).collect():
        points[r.icao] = points.get(r.icao, 0) + 1
    got = {r.icao: r for r in registry.queries()["compress_analysis"](spark, sf_dir).collect()}
    for icao, rows in by_track(tracks.gated(fixtures.dense(spark, sf_dir))).items():
        t, ground, xy = [r.t for r in rows], [r.gnd for r in rows], metres(rows)
        alt = [0.0 if r.gnd or r.baro is None else float(int(r.baro)) for r in rows]
        keep = sorted(thinned(t, xy, alt, ground))
        low = [g or a < 3000 for g, a in zip(ground, alt)]
        off = {"ground": [], "low": [], "high": []}
        for i in range(len(rows)):
            k = min(max(j for j, x in enumerate(keep) if x <= i), len(keep) - 2)
            a, b = keep[k], keep[k + 1]
            u = min(1.0, max(0.0, (t[i] - t[a]) / (t[b] - t[a]))) if t[b] > t[a] else 0.0
            if low[a] or low[b]:
                at = curve([xy[keep[max(k - 1, 0)]], xy[a], xy[b], xy[keep[min(k + 2, len(keep) - 1)]]], u)
            else:
                at = tuple(p + (q - p) * u for p, q in zip(xy[a], xy[b]))
            off["ground" if ground[i] else "low" if alt[i] < 3000 else "high"].append(math.dist(at, xy[i]))
        g = got[icao]
        assert (g.points, g.kept, g.rejected) == (points[icao], len(keep), points[icao] - len(rows)) and math.isclose(g.keep_pct, 100 * len(keep) / points[icao])
        for phase, e in off.items():
            e.sort()
            assert g[f"{phase}_n"] == len(e)
            assert math.isclose(g[f"{phase}_max"], e[-1] if e else 0, abs_tol=1e-6) and math.isclose(g[f"{phase}_p95"], e[int(0.95 * (len(e) - 1))] if e else 0, abs_tol=1e-6)
        blob = codec.encode([(round(t[i]), fixed(rows[i].lat), fixed(rows[i].lon), int(alt[i])) for i in keep])
        assert g.comp_bytes == len(blob)
    report, every = registry.queries()["compress_report"](spark, sf_dir).first(), list(got.values())
    pct = sorted(r.keep_pct for r in every)
    assert (report.tracks, report.points, report.kept) == (len(every), sum(points.values()), sum(r.kept for r in every))
    assert np.allclose([report.keep_median, report.keep_min, report.keep_max, report.keep_p90], [statistics.median(pct), pct[0], pct[-1], pct[9 * len(pct) // 10]])
    for phase in ("ground", "low", "high"):
        assert math.isclose(report[f"{phase}_worst"], max(r[f"{phase}_max"] for r in every if r[f"{phase}_n"]))


def test_cr_error_stats(spark, sf_dir):
    nodes = by_track(registry.queries()["cr_nodes"](spark, sf_dir))
    samples = by_track(fixtures.dense(spark, sf_dir))
    got = {r.icao: r for r in registry.queries()["cr_error_stats"](spark, sf_dir).collect()}
    assert set(got) == {k for k, v in nodes.items() if len(v) > 1}
    for icao in sorted(got)[:5]:
        own, rows, g = nodes[icao], samples[icao], got[icao]
        kx = math.cos(math.radians(sum(r.lat for r in own) / len(own) / 1e5))
        p = [(r.lon / 1e5 * DEGREE * kx, r.lat / 1e5 * DEGREE) for r in own]
        cuts = sorted({0, len(p) - 1} | {k for k, r in enumerate(own) if r.cusp})
        chords = []
        for a, b in zip(cuts, cuts[1:]):
            part = p[a : b + 1]
            line = [curve([part[max(k - 1, 0)], part[k], part[k + 1], part[min(k + 2, len(part) - 1)]], j / 16) for k in range(len(part) - 1) for j in range(16)] + [part[-1]]
            chords += list(zip(line, line[1:]))
        d = [min(to_chord((r.lon * DEGREE * kx, r.lat * DEGREE), *c) for c in chords) for r in rows]
        tol = [2.0 if r.gnd or r.baro is None else ramp(r.baro, 500, 12000, 2, 150) for r in rows]
        assert g.n == len(d) and g.worst_seq == rows[d.index(max(d))].seq
        assert np.allclose([g.median, g.p95, g.max], [statistics.median(d), np.percentile(d, 95), max(d)], atol=1e-5)
        assert math.isclose(g.within, sum(x <= 1.5 * y + 1 for x, y in zip(d, tol)) / len(d)) and math.isclose(g.strict, sum(x <= y for x, y in zip(d, tol)) / len(d))


def test_node_flights(spark, sf_dir):
    """The legs' SQL over the fitted nodes."""
    con = connect(sf_dir)
    nodes = registry.queries()["cr_nodes"](spark, sf_dir).toPandas()
    ports = fixtures.airports(spark, sf_dir).toPandas()
    con.register("nodes", nodes)
    con.register("ports", ports)
    con.execute("CREATE TABLE sparse AS SELECT icao, seq, t, lat / 1e5::DOUBLE AS lat, lon / 1e5::DOUBLE AS lon, on_ground AS gnd FROM nodes")
    con.execute("CREATE TABLE airports AS SELECT * FROM ports")
    want = con.execute(f"WITH RECURSIVE {LEGS}\nSELECT leg_id, icao, dep, arr, {milli('t_start')} AS t_start, {milli('t_end')} AS t_end, n_points FROM arr").df()
    got = registry.queries()["node_flights"](spark, sf_dir).toPandas()
    got[["t_start", "t_end"]] *= 1000
    assert as_rows(got) == as_rows(want) and len(got) > 10


def test_bezier_nodes(spark, sf_dir):
    """The points that count, and what decoding gives back."""
    got = {r.icao: r for r in registry.queries()["bezier_nodes"](spark, sf_dir).collect()}
    n = {icao: len(moved(metres(rows), 1.5)) for icao, rows in by_track(fixtures.dense(spark, sf_dir)).items()}
    assert {k: r.n_points for k, r in got.items()} == {k: v for k, v in n.items() if v >= 3}
    assert all(2 <= r.n_nodes <= r.n_points and r.worst_handle_m <= codec.HANDLE_M / 2 + 1e-9 for r in got.values()), got


def test_bezier_columns(spark, sf_dir):
    """Handles put together again from the residuals, by the plain prediction, are those of the fit."""
    nodes, samples = by_track(registry.queries()["bezier_columns"](spark, sf_dir)), by_track(tracks._unthinned(fixtures.dense(spark, sf_dir), fixtures.airports(spark, sf_dir)))
    counts = {r.icao: r.n_nodes for r in registry.queries()["bezier_nodes"](spark, sf_dir).collect()}
    assert {k: len(v) for k, v in nodes.items()} == counts
    for icao, own in list(nodes.items())[:5]:
        rows = samples[icao]
        every, place = tracks._xy([r.lat for r in rows], [r.lon for r in rows]).tolist(), {r.seq: i for i, r in enumerate(rows)}
        own.sort(key=lambda r: place[r.seq])
        p = [every[place[r.seq]] for r in own]
        for k, r in enumerate(own):
            s = rows[place[r.seq]]
            assert (r.t, r.lat, r.lon, r.on_ground) == (int(s.t), fixed(s.lat), fixed(s.lon), s.gnd) and r.has_in == (k > 0) and r.has_out == (k < len(own) - 1)
        handles = []
        for k, r in enumerate(own):
            a, b = p[max(k - 1, 0)], p[min(k + 1, len(p) - 1)]
            n = math.dist(a, b) or 1.0
            d = ((b[0] - a[0]) / n, (b[1] - a[1]) / n)
            back, on = math.dist(a, p[k]) / 3, math.dist(b, p[k]) / 3
            handles.append(((p[k][0] - d[0] * back + r.hin_dx / 2, p[k][1] - d[1] * back + r.hin_dy / 2), (p[k][0] + d[0] * on + r.hout_dx / 2, p[k][1] + d[1] * on + r.hout_dy / 2)))
        at = moved(every, 1.5)
        alt = [e if e is not None else rows[i].alt or 0.0 for i, e in zip(at, held([rows[i].elev for i in at], [rows[i].gnd for i in at]))]
        k, cusp, want = bezier.nodes(np.array(every)[at], np.array([ramp(a, 500, 12000, 2, 150) for a in alt]), np.array([rows[i].gnd for i in at]))
        assert [at[i] for i in k] == [place[r.seq] for r in own] and cusp.tolist() == [r.cusp for r in own]
        for h, w in zip(handles, want):
            assert all(np.isnan(y).any() or max(abs(x[0] - y[0]), abs(x[1] - y[1])) <= 0.26 for x, y in zip(h, w))


@pytest.mark.parametrize("values", [[5.0], [1.0, 1.0, 1.0], [0.0, -3.0, 7.5, 7.5, 1e9, 1e-9], list(map(float, range(1000)))])
def test_ranks(spark, values):
    from pyspark.sql import functions as F

    from contrail.operators.quantiles import at_ranks, between, interpolated

    df = spark.createDataFrame([(k, v) for k in ("a", None) for v in [*values, None]], "k string, v double")
    found = at_ranks(df, ["k"], "v", between(0.95) | {"third": lambda n: F.lit(2)}).select("k", "n", interpolated(0.95).alias("p"), "third").collect()
    assert {r.k for r in found} == {"a", None}
    for r in found:
        assert r.n == len(values) and math.isclose(r.p, np.percentile(values, 95)) and r.third == (sorted(values)[2] if len(values) > 2 else None)
