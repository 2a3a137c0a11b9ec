"""Column expressions for positions: distances, ramps by altitude, fixed point, curves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KM_PER_DEGREE, M_PER_DEGREE, EARTH_KM = 111.32, 111320.0, 6371.0
SCALE = 1e5
KNOT, FOOT = 0.514444, 0.3048


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def km(lat1, lon1, lat2, lon2) -> Column:
    """Flat-earth kilometres; a degree of longitude shrinks with the cosine of the first latitude."""
    north = (_c(lat2) - _c(lat1)) * KM_PER_DEGREE
    east = (_c(lon2) - _c(lon1)) * KM_PER_DEGREE * F.cos(F.radians(_c(lat1)))
    return F.sqrt(north * north + east * east)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    north, east = F.radians(_c(lat2) - _c(lat1)) / 2, F.radians(_c(lon2) - _c(lon1)) / 2
    a = F.sin(north) * F.sin(north) + F.cos(F.radians(_c(lat1))) * F.cos(F.radians(_c(lat2))) * F.sin(east) * F.sin(east)
    return F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_KM)


def ramp(alt, low_ft: float, high_ft: float, low: float, high: float) -> Column:
    """low up to low_ft, high from high_ft on, linear between."""
    a = _c(alt)
    return F.when(a <= low_ft, low).when(a >= high_ft, high).otherwise(low + (a - low_ft) * (high - low) / (high_ft - low_ft))


def gate_altitude(alt, ground) -> Column:
    """Whole feet of what can be read as a number; on the ground and where nothing can be read 0."""
    return F.when(_c(ground), F.lit(0.0)).otherwise(F.coalesce(_c(alt).try_cast("double").cast("long").cast("double"), F.lit(0.0)))


def fit_tolerance(alt, ground_m: float = 2.0, cruise_m: float = 150.0) -> Column:
    """Metres a fitted curve may be off; tight where the altitude is unknown."""
    return F.coalesce(ramp(alt, 500.0, 12000.0, ground_m, cruise_m), F.lit(ground_m))


def thin_tolerance(alt, ground, ground_m: float = 10.0, low_m: float = 20.0, cruise_m: float = 150.0) -> Column:
    return F.when(_c(ground), ground_m).otherwise(ramp(alt, 2000.0, 12000.0, low_m, cruise_m))


def thin_tolerance_ft(alt, ground, ground_ft: float = 25.0, cruise_ft: float = 250.0) -> Column:
    return F.when(_c(ground), ground_ft).otherwise(ramp(alt, 2000.0, 12000.0, ground_ft, cruise_ft))


def phase(ground, alt) -> Column:
    return F.when(_c(ground), "ground").when(_c(alt) < 3000, "low").otherwise("high")


#: Position (m), speed (m/s) and altitude (m) noise by the first part that a source's name contains.
NOISE = ((("mlat",), (120.0, 10.0, 60.0)), (("adsb", "adsr"), (18.0, 2.5, 15.0)), (("tisb",), (60.0, 6.0, 30.0)))
OTHER_NOISE = (40.0, 5.0, 25.0)


def source_noise(src) -> Column:
    """struct(pos_m, vel_ms, alt_m)."""
    s = F.coalesce(_c(src), F.lit(""))
    out = []
    for k, name in enumerate(("pos_m", "vel_ms", "alt_m")):
        e = None
        for parts, values in NOISE:
            hit = s.contains(parts[0])
            for p in parts[1:]:
                hit = hit | s.contains(p)
            e = F.when(hit, values[k]) if e is None else e.when(hit, values[k])
        out.append(e.otherwise(OTHER_NOISE[k]).alias(name))
    return F.struct(*out)


def encode(degrees) -> Column:
    """Degrees as whole hundred-thousandths, halves to even."""
    return F.rint(_c(degrees) * SCALE).cast("int")


def decode(fixed) -> Column:
    return _c(fixed) / SCALE


def lerp(a: Column, b: Column, u: Column) -> Column:
    return a + (b - a) * u


def catmull_rom(p: list[tuple[Column, Column]], u: Column) -> tuple[Column, Column]:
    """The point at u between the second and third of four points on the centripetal Catmull-Rom curve."""
    def knot(a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        return F.sqrt(F.greatest(F.sqrt(dx * dx + dy * dy), F.lit(1e-9)))

    d1, d2, d3 = knot(p[0], p[1]), knot(p[1], p[2]), knot(p[2], p[3])
    t1 = d1
    t2 = t1 + d2
    t3 = t2 + d3
    t = t1 + (t2 - t1) * u
    out = []
    for k in (0, 1):
        a1 = lerp(p[0][k], p[1][k], t / t1)
        a2 = lerp(p[1][k], p[2][k], (t - t1) / (t2 - t1))
        a3 = lerp(p[2][k], p[3][k], (t - t2) / (t3 - t2))
        b1, b2 = lerp(a1, a2, t / t2), lerp(a2, a3, (t - t1) / (t3 - t1))
        out.append(lerp(b1, b2, (t - t1) / (t2 - t1)))
    return out[0], out[1]


def bernstein(p: list[Column], u: Column) -> Column:
    """One coordinate of the cubic with four control values."""
    v = 1 - u
    return p[0] * v * v * v + p[1] * 3 * v * v * u + p[2] * 3 * v * u * u + p[3] * u * u * u


def segment_distance(px, py, ax, ay, bx, by) -> Column:
    """From a point to a segment."""
    dx, dy = _c(bx) - _c(ax), _c(by) - _c(ay)
    n = dx * dx + dy * dy
    u = F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((_c(px) - _c(ax)) * dx + (_c(py) - _c(ay)) * dy) / n))).otherwise(0.0)
    ex, ey = _c(px) - (_c(ax) + dx * u), _c(py) - (_c(ay) + dy * u)
    return F.sqrt(ex * ex + ey * ey)
