"""The registered queries in DuckDB's SQL."""

from contrail.sources.fixtures import ORACLE as VIEWS


def km(a: str, b: str, c: str, d: str) -> str:
    north, east = f"(({c} - {a}) * 111.32e0)", f"(({d} - {b}) * 111.32e0 * cos(radians({a})))"
    return f"sqrt({north} * {north} + {east} * {east})"


def haversine(a: str, b: str, c: str, d: str) -> str:
    north, east = f"sin(radians({c} - {a}) / 2)", f"sin(radians({d} - {b}) / 2)"
    return f"(asin(sqrt(least({north} * {north} + cos(radians({a})) * cos(radians({c})) * {east} * {east}, 1e0))) * 12742e0)"


def ramp(a: str, low_ft: float, high_ft: float, low: float, high: float) -> str:
    return f"(CASE WHEN {a} <= {low_ft!r}::DOUBLE THEN {low!r}::DOUBLE WHEN {a} >= {high_ft!r}::DOUBLE THEN {high!r}::DOUBLE ELSE {low!r}::DOUBLE + ({a} - {low_ft!r}::DOUBLE) * {high - low!r}::DOUBLE / {high_ft - low_ft!r}::DOUBLE END)"


def milli(x: str) -> str:
    return f"round_even(({x}) * 1000e0, 0)::BIGINT"


def whole(x: str, by: str) -> str:
    return f"round_even(({x}) * {by}, 0)::BIGINT"


TRACK = "PARTITION BY icao ORDER BY t, seq"
GATE_ALT = "(CASE WHEN gnd OR baro IS NULL THEN 0e0 ELSE trunc(baro) END)"


def numbered(view: str, name: str = "n", more: str = "") -> str:
    return f"{name} AS (SELECT *{more}, row_number() OVER ({TRACK}) - 1 AS i FROM {view})"


def islands(view: str, flag: str, name: str) -> str:
    return f"""{name}_0 AS (SELECT *, coalesce({flag}, FALSE) AS f, CASE WHEN lag(coalesce({flag}, FALSE)) OVER ({TRACK}) IS NOT DISTINCT FROM coalesce({flag}, FALSE) THEN 0 ELSE 1 END AS new FROM {view}),
{name} AS (SELECT *, sum(new) OVER ({TRACK} ROWS UNBOUNDED PRECEDING) AS run FROM {name}_0)"""


def gated(view: str) -> str:
    """ok: icao, i and whether the speed gate accepts the point."""
    return f"""{numbered(view)},
ok AS (
  SELECT icao, i, TRUE AS accepted, t AS a_t, lat AS a_y, lon AS a_x FROM n WHERE i = 0
  UNION ALL
  SELECT icao, i, good, CASE WHEN good THEN t ELSE a_t END, CASE WHEN good THEN lat ELSE a_y END, CASE WHEN good THEN lon ELSE a_x END FROM (
    SELECT n.icao, n.i, n.t, n.lat, n.lon, a_t, a_y, a_x,
      CASE WHEN n.t - a_t > 0 THEN {km("a_y", "a_x", "n.lat", "n.lon")} / ((n.t - a_t) / 3600e0) <= {ramp(GATE_ALT, 1000.0, 10000.0, 555.0, 1300.0)} ELSE {km("a_y", "a_x", "n.lat", "n.lon")} < 0.5e0 END AS good
    FROM ok JOIN n ON n.icao = ok.icao AND n.i = ok.i + 1)),
survivors AS (SELECT n.* EXCLUDE (i) FROM n JOIN ok USING (icao, i) WHERE accepted)"""


SPIKES = f"""spikes AS (SELECT *, coalesce(back > cap AND ahead > cap AND across < 0.5e0 * greatest(back, ahead), FALSE) AS spike FROM (
  SELECT *, {ramp(GATE_ALT, 1000.0, 10000.0, 0.25, 25.0)} AS cap, {km("py", "px", "lat", "lon")} AS back, {km("lat", "lon", "ny", "nx")} AS ahead, {km("py", "px", "ny", "nx")} AS across FROM (
    SELECT *, lag(lat) OVER w AS py, lag(lon) OVER w AS px, lead(lat) OVER w AS ny, lead(lon) OVER w AS nx FROM survivors WINDOW w AS ({TRACK}))))"""

FILL = f"""known AS (SELECT *, CASE WHEN NOT gnd THEN geom - baro END AS o FROM dense),
sides AS (SELECT *, last_value(CASE WHEN o IS NOT NULL THEN t END IGNORE NULLS) OVER a AS t0, last_value(o IGNORE NULLS) OVER a AS o0,
    first_value(CASE WHEN o IS NOT NULL THEN t END IGNORE NULLS) OVER b AS t1, first_value(o IGNORE NULLS) OVER b AS o1 FROM known
  WINDOW a AS ({TRACK} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS ({TRACK} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
datum AS (SELECT *, coalesce(geom, CASE WHEN NOT gnd THEN baro END + off) AS alt FROM (
  SELECT *, coalesce(o, CASE WHEN t0 IS NOT NULL AND t1 IS NOT NULL THEN o0 + (o1 - o0) * (t - t0) / CASE WHEN t1 = t0 THEN 1e0 ELSE t1 - t0 END END, o0, o1, 0e0) AS off FROM sides))"""


def nearest(view: str, payload: str, name: str, lat: str = "lat", lon: str = "lon") -> str:
    """All airports within 10 km of each point of view, the nearest first, then the first in the file."""
    return f"""{name} AS (SELECT v.*, (SELECT a.{payload} FROM airports a WHERE {km(f"v.{lat}", f"v.{lon}", "a.lat", "a.lon")} < 10 ORDER BY {km(f"v.{lat}", f"v.{lon}", "a.lat", "a.lon")}, a.pos LIMIT 1) AS {name} FROM {view} v)"""


def near_ports(view: str, payload: str, name: str) -> str:
    """The same with a join: each distinct position once."""
    d = km("p.lat", "p.lon", "a.lat", "a.lon")
    return f"""{name}_at AS (SELECT p.lat, p.lon, arg_min(a.{payload}, ({d}, a.pos)) AS {name} FROM (SELECT DISTINCT lat, lon FROM {view}) p JOIN airports a ON {d} < 10 GROUP BY ALL),
{name}_of AS (SELECT v.*, {name} FROM {view} v LEFT JOIN {name}_at USING (lat, lon))"""


PROJECTED = """AS (SELECT *, lon * cos(radians(avg(lat) OVER (PARTITION BY icao))) * 111320e0 AS x, lat * 111320e0 AS y FROM {})"""

LEGS = f"""{numbered("sparse")},
{islands("n", "NOT gnd", "r")},
runs AS (SELECT icao, run, min(i) AS s, max(i) AS e, arg_min(t, i) AS t_s, arg_max(t, i) AS t_e, {km("min(lat)", "min(lon)", "max(lat)", "max(lon)")} AS km FROM r WHERE f GROUP BY icao, run),
fl AS (SELECT *, row_number() OVER w - 1 AS k, lead(s) OVER w AS next_s, (t_e + lead(t_s) OVER w) / 2 AS mid FROM runs WHERE km > 2 WINDOW w AS (PARTITION BY icao ORDER BY s)),
cuts AS (SELECT fl.icao, fl.k, min(n.i) AS cut FROM fl JOIN n ON n.icao = fl.icao AND n.i BETWEEN fl.e AND fl.next_s AND (n.t >= fl.mid OR n.i = fl.next_s) GROUP BY fl.icao, fl.k),
legs AS (SELECT n.*, (SELECT count(*) FROM cuts c WHERE c.icao = n.icao AND c.cut <= n.i) AS leg, n.icao || '_' || (SELECT count(*) FROM cuts c WHERE c.icao = n.icao AND c.cut <= n.i) AS leg_id
  FROM n WHERE icao IN (SELECT icao FROM fl)),
ends AS (SELECT icao, leg, leg_id, coalesce(arg_min(lat, i) FILTER (gnd), arg_min(lat, i)) AS y0, coalesce(arg_min(lon, i) FILTER (gnd), arg_min(lon, i)) AS x0,
  coalesce(arg_max(lat, i) FILTER (gnd), arg_max(lat, i)) AS y1, coalesce(arg_max(lon, i) FILTER (gnd), arg_max(lon, i)) AS x1,
  arg_min(t, i) AS t_start, arg_max(t, i) AS t_end, count(*) AS n_points FROM legs GROUP BY ALL),
{nearest("ends", "ident", "dep", "y0", "x0")},
{nearest("dep", "ident", "arr", "y1", "x1")}"""
FANNED = """fanned AS (SELECT legs.*, port AS airport FROM legs JOIN arr USING (leg_id), unnest([dep, CASE WHEN arr.arr <> dep THEN arr.arr END]) u(port) WHERE port IS NOT NULL)"""

KEPT = f"""{numbered("sparse", "every")},
kept AS (SELECT *, i % 10 = 0 OR lead(seq) OVER ({TRACK}) IS NULL AS keep FROM every),
xy {PROJECTED.format("kept")}"""
LINEAR = f"""{KEPT},
k AS (SELECT * FROM xy WHERE keep),
pairs AS (SELECT icao, i AS i0, lead(i) OVER w AS i1, t AS t0, lead(t) OVER w AS t1, x AS x0, lead(x) OVER w AS x1, y AS y0, lead(y) OVER w AS y1, lead(i, 2) OVER w IS NULL AS final FROM k WINDOW w AS (PARTITION BY icao ORDER BY i)),
off AS (SELECT xy.*, CASE WHEN t1 - t0 > 0 THEN greatest(0e0, least(1e0, (t - t0) / (t1 - t0))) ELSE 0e0 END AS u, x0, x1, y0, y1
  FROM xy JOIN pairs ON xy.icao = pairs.icao AND i1 IS NOT NULL AND i >= i0 AND (i < i1 OR final AND i = i1)),
err AS (SELECT *, sqrt((x0 + (x1 - x0) * u - x) * (x0 + (x1 - x0) * u - x) + (y0 + (y1 - y0) * u - y) * (y0 + (y1 - y0) * u - y)) AS err FROM off)"""

PHASE = "CASE WHEN gnd THEN 'ground' WHEN coalesce(baro, 0) < 3000 THEN 'low' ELSE 'high' END"


def lerp(a: str, b: str, u: str) -> str:
    return f"({a} + ({b} - {a}) * ({u}))"


def _curve(c: str) -> str:
    a1, a2, a3 = lerp(f"{c}0", f"{c}1", "tt / t1"), lerp(f"{c}1", f"{c}2", "(tt - t1) / (t2 - t1)"), lerp(f"{c}2", f"{c}3", "(tt - t2) / (t3 - t2)")
    b1, b2 = lerp(a1, a2, "tt / t2"), lerp(a2, a3, "(tt - t1) / (t3 - t1)")
    return lerp(b1, b2, "(tt - t1) / (t2 - t1)")


def _knot(i: int, j: int) -> str:
    return f"sqrt(greatest(sqrt((x{j} - x{i}) * (x{j} - x{i}) + (y{j} - y{i}) * (y{j} - y{i})), 1e-9))"


#: The path through every tenth point: off has each row's place between its kept points 1 and 2, with those before and after.
CURVED = f"""{KEPT},
k AS (SELECT *, gnd OR coalesce(baro, 0) < 3000 AS low FROM xy WHERE keep),
pairs AS (SELECT icao, i AS i0, lead(i) OVER w AS i1, t AS ta, lead(t) OVER w AS tb, low AS low0, lead(low) OVER w AS low1, lead(i, 2) OVER w IS NULL AS final,
  coalesce(lag(x) OVER w, x) AS x0, coalesce(lag(y) OVER w, y) AS y0, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2, coalesce(lead(x, 2) OVER w, lead(x) OVER w) AS x3, coalesce(lead(y, 2) OVER w, lead(y) OVER w) AS y3
  FROM k WINDOW w AS (PARTITION BY icao ORDER BY i)),
off AS (SELECT xy.*, CASE WHEN tb - ta > 0 THEN greatest(0e0, least(1e0, (t - ta) / (tb - ta))) ELSE 0e0 END AS u, pairs.* EXCLUDE (icao)
  FROM xy JOIN pairs ON xy.icao = pairs.icao AND i1 IS NOT NULL AND i >= i0 AND (i < i1 OR final AND i = i1)),
knots AS (SELECT *, {_knot(0, 1)} AS t1, {_knot(0, 1)} + {_knot(1, 2)} AS t2, {_knot(0, 1)} + {_knot(1, 2)} + {_knot(2, 3)} AS t3 FROM off),
path AS (SELECT *, {_curve("x")} AS cx, {_curve("y")} AS cy, x1 + (x2 - x1) * u AS sx, y1 + (y2 - y1) * u AS sy FROM (SELECT *, t1 + (t2 - t1) * u AS tt FROM knots))"""


BODIES = {
    "airports": f"SELECT ident, {whole('lat', '1e5')} AS lat, {whole('lon', '1e5')} AS lon, elev FROM airports",
    "trace_points": f"SELECT icao, seq, {milli('t')} AS t, {whole('lat', '1e5')} AS lat, {whole('lon', '1e5')} AS lon, baro::BIGINT AS baro, gnd FROM sparse",
    "dense_points": f"SELECT icao, seq, {milli('t')} AS t, {whole('lat', '1e5')} AS lat, {whole('lon', '1e5')} AS lon, gnd, baro::BIGINT AS baro, geom::BIGINT AS geom, {milli('gs')} AS gs, {milli('trk')} AS trk, {milli('vr')} AS vr, src FROM dense",
    "metadata_lookup": "SELECT icao, c_name AS reg, c_mktsegment AS type FROM (SELECT DISTINCT icao FROM sparse) LEFT JOIN customer ON icao = 'u' || c_custkey",
    "tolerance_ramps": f"""SELECT seq, {milli(ramp(GATE_ALT, 1000.0, 10000.0, 555.0, 1300.0))} AS max_speed, {milli(ramp(GATE_ALT, 1000.0, 10000.0, 0.25, 25.0))} AS max_jump,
  {milli("CASE WHEN baro IS NULL THEN 2e0 ELSE " + ramp("baro", 500.0, 12000.0, 2.0, 150.0) + " END")} AS fit_m,
  {milli("CASE WHEN gnd THEN 10e0 ELSE " + ramp(GATE_ALT, 2000.0, 12000.0, 20.0, 150.0) + " END")} AS thin_m, {milli("CASE WHEN gnd THEN 25e0 ELSE " + ramp(GATE_ALT, 2000.0, 12000.0, 25.0, 250.0) + " END")} AS thin_ft FROM sparse""",
    "source_noise": """SELECT src, count(*) AS n, CASE WHEN src LIKE '%mlat%' THEN 120e0 WHEN src LIKE '%adsb%' OR src LIKE '%adsr%' THEN 18e0 WHEN src LIKE '%tisb%' THEN 60e0 ELSE 40e0 END AS pos_m,
  CASE WHEN src LIKE '%mlat%' THEN 10e0 WHEN src LIKE '%adsb%' OR src LIKE '%adsr%' THEN 2.5e0 WHEN src LIKE '%tisb%' THEN 6e0 ELSE 5e0 END AS vel_ms,
  CASE WHEN src LIKE '%mlat%' THEN 60e0 WHEN src LIKE '%adsb%' OR src LIKE '%adsr%' THEN 15e0 WHEN src LIKE '%tisb%' THEN 30e0 ELSE 25e0 END AS alt_m FROM dense GROUP BY src""",
    "phase_counts": f"SELECT icao, {PHASE} AS phase, count(*) AS n FROM sparse GROUP BY ALL",
    "airport_distances": f"SELECT a.ident, b.ident AS other, {milli(km('a.lat', 'a.lon', 'b.lat', 'b.lon'))} AS flat_m, {milli(haversine('a.lat', 'a.lon', 'b.lat', 'b.lon'))} AS round_m FROM airports a JOIN airports b ON a.ident < b.ident",
    "speed_gate": (gated("sparse"), "SELECT icao, seq, accepted FROM n JOIN ok USING (icao, i)"),
    "spike_gate": (f"{gated('dense')},\n{SPIKES}", "SELECT icao, seq, spike FROM spikes"),
    "gate_counts": (
        f"{gated('sparse')},\n{SPIKES}",
        """SELECT icao, n_orig, coalesce(n_kept, 0)::BIGINT AS n_kept, (n_orig - coalesce(n_kept, 0))::BIGINT AS n_rejected FROM (SELECT icao, count(*) AS n_orig FROM sparse GROUP BY icao)
  LEFT JOIN (SELECT icao, count(*) AS n_kept FROM spikes WHERE NOT spike GROUP BY icao) USING (icao)""",
    ),
    "ground_deglitch": f"""SELECT icao, seq, coalesce(nt - pt <= 600 AND step > 8 AND CASE WHEN coalesce(gs < 1.5e0, FALSE) THEN across < step ELSE step < 30 AND across < 0.5e0 * step END, FALSE) AS reversal FROM (
  SELECT *, greatest({km("py", "px", "lat", "lon")} * 1000, {km("lat", "lon", "ny", "nx")} * 1000) AS step, {km("py", "px", "ny", "nx")} * 1000 AS across FROM (
    SELECT *, lag(t) OVER w AS pt, lead(t) OVER w AS nt, lag(lat) OVER w AS py, lag(lon) OVER w AS px, lead(lat) OVER w AS ny, lead(lon) OVER w AS nx FROM dense WHERE gnd WINDOW w AS ({TRACK}))
  )""",
    "parked_denoise": (
        f"""{islands("dense", "gnd AND (gs IS NULL OR gs < 2)", "r")},
p AS (SELECT *, row_number() OVER (PARTITION BY icao, run ORDER BY t, seq) AS j, count(*) OVER q AS c, min(t) OVER q AS t_0, median(coalesce(gs, 0)) OVER q AS m_gs, median(lat) OVER q AS m_y, median(lon) OVER q AS m_x,
  first_value(lat) OVER (PARTITION BY icao, run ORDER BY t, seq) AS f_y, first_value(lon) OVER (PARTITION BY icao, run ORDER BY t, seq) AS f_x FROM r WINDOW q AS (PARTITION BY icao, run)),
q AS (SELECT *, max({km("f_y", "f_x", "lat", "lon")} * 1000) OVER (PARTITION BY icao, run) AS far FROM p),
m AS (SELECT *, f AND c >= 3 AND (far < 20 OR m_gs < 1 AND far < 200) AS merge FROM q)""",
        f"""SELECT icao, seq, {whole("CASE WHEN merge THEN m_y ELSE lat END", "1e5")} AS lat, {whole("CASE WHEN merge THEN m_x ELSE lon END", "1e5")} AS lon, (CASE WHEN merge THEN c ELSE 1 END)::BIGINT AS merged
FROM m WHERE NOT merge OR j = 1 OR (j = c AND t <> t_0)""",
    ),
    "stationary_snap": (
        f"""{islands("dense", "gs IS NOT NULL AND gs < 3", "r")},
p AS (SELECT *, avg(lat) OVER q AS m_y, avg(lon) OVER q AS m_x, max(t) OVER q - min(t) OVER q AS dt, count(*) OVER q AS c, max(lat) OVER q - min(lat) OVER q AS dy, max(lon) OVER q - min(lon) OVER q AS dx FROM r WINDOW q AS (PARTITION BY icao, run)),
m AS (SELECT *, f AND (dt >= 20 OR c >= 3 AND greatest(dy * 111320e0, dx * 111320e0 * cos(radians(m_y))) < 40) AS snapped FROM p)""",
        f"SELECT icao, seq, {whole('CASE WHEN snapped THEN m_y ELSE lat END', '1e6')} AS lat, {whole('CASE WHEN snapped THEN m_x ELSE lon END', '1e6')} AS lon, gnd OR f AS gnd, snapped FROM m",
    ),
    "decimate_1s": (
        f"""{numbered("dense")},
b AS (SELECT icao, i, 0 AS bucket, t AS t_0 FROM n WHERE i = 0 UNION ALL
  SELECT n.icao, n.i, CASE WHEN n.t >= t_0 + 1 THEN bucket + 1 ELSE bucket END, CASE WHEN n.t >= t_0 + 1 THEN n.t ELSE t_0 END FROM b JOIN n ON n.icao = b.icao AND n.i = b.i + 1)""",
        f"""SELECT icao, bucket::BIGINT AS bucket, min(seq) AS seq, {milli("avg(t)")} AS t, {whole("avg(lat)", "1e6")} AS lat, {whole("avg(lon)", "1e6")} AS lon, count(*) FILTER (gnd) * 2 >= count(*) AS gnd,
  {milli("avg(baro)")} AS baro, {milli("avg(geom)")} AS geom, {milli("avg(gs)")} AS gs, {milli("avg(vr)")} AS vr, {milli("arg_max(trk, i)")} AS trk, arg_max(src, i) AS src, count(*) AS merged FROM n JOIN b USING (icao, i) GROUP BY icao, bucket""",
    ),
    "stationary_dedup": (
        f"""xy {PROJECTED.format("dense")},
{numbered("xy")},
m AS (SELECT icao, i, TRUE AS moved, x AS a, y AS b FROM n WHERE i = 0 UNION ALL
  SELECT icao, i, go, CASE WHEN go THEN x ELSE a END, CASE WHEN go THEN y ELSE b END FROM (
    SELECT n.icao, n.i, n.x, n.y, a, b, sqrt((n.x - a) * (n.x - a) + (n.y - b) * (n.y - b)) > 1 AS go FROM m JOIN n ON n.icao = m.icao AND n.i = m.i + 1))""",
        "SELECT icao, seq, moved FROM n JOIN m USING (icao, i)",
    ),
    "duplicate_seconds": f"""SELECT icao, seq, second FROM (SELECT *, lead(second) OVER ({TRACK}) AS after FROM (SELECT *, round_even(t, 0)::BIGINT AS second FROM dense)) WHERE after IS NULL OR after <> second""",
    "alt_despike": (
        f"""alts AS (SELECT *, coalesce(geom, baro) AS alt FROM dense),
k AS (SELECT *, row_number() OVER ({TRACK}) - 1 AS i, count(*) OVER (PARTITION BY icao) AS m FROM alts WHERE alt IS NOT NULL),
c AS (SELECT *, lag(alt) OVER w AS va, lag(t) OVER w AS ta, lead(alt) OVER w AS v1, lead(t) OVER w AS t1, lead(alt, 2) OVER w AS v2, lead(t, 2) OVER w AS t2, lead(gnd) OVER w AS g1 FROM k WINDOW w AS (PARTITION BY icao ORDER BY i)),
l AS (SELECT *, CASE WHEN i < 1 OR i >= m - 1 THEN 0
  WHEN NOT gnd AND t1 - ta <= 30 AND abs(va - v1) < 400 AND abs(alt - va) > 400 AND abs(alt - v1) > 400 THEN 1
  WHEN i + 2 < m AND NOT gnd AND NOT g1 AND t2 - ta <= 30 AND abs(va - v2) < 400 AND abs(alt - va) > 400 AND abs(alt - v2) > 400 AND abs(v1 - va) > 400 AND abs(v1 - v2) > 400 THEN 2 ELSE 0 END AS len FROM c),
walk AS (SELECT icao, i, len FROM l WHERE i = 1 UNION ALL SELECT l.icao, l.i, l.len FROM walk JOIN l ON l.icao = walk.icao AND l.i = walk.i + walk.len + 1),
fix AS (SELECT l.icao, l.i + d AS i, va, ta, CASE walk.len WHEN 1 THEN v1 ELSE v2 END AS vc, CASE walk.len WHEN 1 THEN t1 ELSE t2 END AS tc FROM walk JOIN l USING (icao, i), (VALUES (0), (1)) s(d) WHERE d < walk.len)""",
        """SELECT alts.icao, alts.seq, alts.alt::BIGINT AS alt, (CASE WHEN fix.i IS NULL THEN alts.alt ELSE round_even(va + (vc - va) * (alts.t - ta) / CASE WHEN tc = ta THEN 1 ELSE tc - ta END, 0) END)::BIGINT AS repaired
FROM alts LEFT JOIN k ON k.icao = alts.icao AND k.seq = alts.seq LEFT JOIN fix ON fix.icao = k.icao AND fix.i = k.i""",
    ),
    "datum_fill": (FILL, f"SELECT icao, seq, {milli('off')} AS off, {milli('alt')} AS alt FROM datum"),
    "nearest_airport_ident": (near_ports("dense", "ident", "ident"), "SELECT icao, seq, ident FROM ident_of"),
    "surface": (
        f"{FILL},\n{near_ports('datum', 'elev', 'elev')},\ns AS (SELECT *, elev IS NOT NULL AND (gnd OR gs IS NOT NULL AND gs < 40 AND (alt IS NULL OR alt < elev + 500)) AS surface FROM elev_of)",
        f"SELECT icao, seq, elev, surface, gnd OR surface AS gnd, {milli('CASE WHEN surface THEN elev::DOUBLE WHEN NOT gnd THEN alt END')} AS alt FROM s",
    ),
    "ground_hold": (
        f"""{near_ports("dense", "elev", "near")},
e AS (SELECT *, (CASE WHEN gnd THEN near + seq % 3 END)::BIGINT AS elev FROM near_of),
{islands("e", "gnd", "r")},
c AS (SELECT icao, run, elev, count(*) AS c, min((t, seq)) AS first FROM r WHERE gnd AND elev IS NOT NULL GROUP BY ALL),
top AS (SELECT icao, run, elev AS held FROM c QUALIFY row_number() OVER (PARTITION BY icao, run ORDER BY c DESC, first) = 1)""",
        "SELECT icao, seq, elev, CASE WHEN gnd AND elev IS NOT NULL THEN held END AS held FROM r LEFT JOIN top USING (icao, run)",
    ),
    "corners": (
        f"""xy {PROJECTED.format("sparse")},
s AS (SELECT *, x - lag(x) OVER w AS ax, y - lag(y) OVER w AS ay, lead(x) OVER w - x AS bx, lead(y) OVER w - y AS b_y, lag(gnd) OVER w AS was FROM xy WINDOW w AS ({TRACK})),
l AS (SELECT *, sqrt(ax * ax + ay * ay) AS an, sqrt(bx * bx + b_y * b_y) AS bn FROM s),
a AS (SELECT *, CASE WHEN an IS NOT NULL AND bn IS NOT NULL THEN degrees(acos(greatest(-1e0, least(1e0, CASE WHEN an > 0 THEN ax / an ELSE 0 END * CASE WHEN bn > 0 THEN bx / bn ELSE 0 END + CASE WHEN an > 0 THEN ay / an ELSE 0 END * CASE WHEN bn > 0 THEN b_y / bn ELSE 0 END)))) END AS angle FROM l)""",
        f"SELECT icao, seq, {milli('angle')} AS angle, an IS NULL OR bn IS NULL OR angle > 35 OR gnd <> was AS corner FROM a",
    ),
    "fixed_point": f"SELECT icao, seq, {whole('lat', '1e5')}::INT AS lat_fixed, {whole('abs(round_even(lat * 1e5, 0) / 1e5 - lat)', '1e9')} AS lost, {whole('t', '10e0')}::INT AS ds FROM sparse",
    "airborne_runs": (LEGS, f"SELECT icao, s, e, {milli('t_s')} AS t_s, {milli('t_e')} AS t_e, {milli('km')} AS m, km > 2 AS flight FROM runs"),
    "leg_points": (LEGS, "SELECT icao, seq, i, leg, leg_id FROM legs"),
    "flights": (LEGS, f"SELECT leg_id, icao, dep, arr, {milli('t_start')} AS t_start, {milli('t_end')} AS t_end, n_points FROM arr"),
    "airport_fanout": (f"{LEGS},\n{FANNED}", "SELECT airport, leg_id, count(*) AS n_points FROM fanned GROUP BY ALL"),
    "airport_clip": (f"{LEGS},\n{FANNED}", f"SELECT airport, leg_id, seq FROM fanned f JOIN airports a ON a.ident = f.airport WHERE {haversine('a.lat', 'a.lon', 'f.lat', 'f.lon')} < 40"),
    "airport_count": (LEGS, "SELECT count(*) AS n_airports FROM (SELECT dep AS code FROM arr UNION SELECT arr FROM arr) WHERE code IS NOT NULL"),
    "flights_by_departure": (LEGS, "SELECT dep, count(*) AS n, sum(n_points)::BIGINT AS points FROM arr GROUP BY dep"),
    "limited_aircraft": "SELECT icao, count(*) AS n FROM sparse WHERE icao IN (SELECT DISTINCT icao FROM sparse ORDER BY icao LIMIT 10) GROUP BY icao",
    "dates_manifest": """SELECT '{"dates":[' || string_agg('"' || d || '"', ',' ORDER BY d) || '],"latest":"' || max(d) || '"}' AS manifest FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS d FROM events)""",
    "retention": "SELECT date FROM (SELECT date, dense_rank() OVER (ORDER BY date DESC) AS r FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events)) WHERE r > 10",
    "date_of_tag": "SELECT 'v' || strftime(o_orderdate, '%Y.%m.%d') || '-set-' || o_orderkey AS tag, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders",
    "recon_error_linear": (LINEAR, f"SELECT icao, seq, {milli('err')} AS err FROM err"),
    "recon_error_catmull": (CURVED, f"SELECT icao, seq, {milli('sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y))')} AS err FROM path"),
    "recon_error_segment": (
        CURVED,
        f"SELECT icao, seq, {milli('sqrt((px - x) * (px - x) + (py - y) * (py - y))')} AS err FROM (SELECT *, CASE WHEN low0 OR low1 THEN cx ELSE sx END AS px, CASE WHEN low0 OR low1 THEN cy ELSE sy END AS py FROM path)",
    ),
    "error_stats": (
        f"""{LINEAR},
p AS (SELECT *, {PHASE} AS phase, CASE WHEN baro IS NULL THEN 2e0 ELSE {ramp("baro", 500.0, 12000.0, 2.0, 150.0)} END AS tol FROM err),
q AS (SELECT *, row_number() OVER (PARTITION BY phase ORDER BY err) - 1 AS j, count(*) OVER (PARTITION BY phase) AS c FROM p)""",
        f"""SELECT phase, count(*) AS n, {milli("median(err)")} AS median, {milli("quantile_cont(err, 0.95)")} AS p95, {milli("max(err) FILTER (j = floor(0.95e0 * (c - 1)))")} AS p95_rank, {milli("max(err)")} AS max,
  {whole("avg((err <= 1.5e0 * tol + 1)::INT)", "1e6")} AS within, arg_max(seq, (err, -seq)) AS worst_seq FROM q GROUP BY phase""",
    ),
    "worst_tracks": (LINEAR, f"SELECT icao, {milli('quantile_cont(err, 0.95)')} AS p95 FROM err GROUP BY icao ORDER BY p95 DESC, icao LIMIT 6"),
    "cr_polyline": (
        f"""{KEPT},
s AS (SELECT icao, seq, x AS x1, y AS y1, coalesce(lag(x) OVER w, x) AS x0, coalesce(lag(y) OVER w, y) AS y0, lead(x) OVER w AS x2, lead(y) OVER w AS y2, coalesce(lead(x, 2) OVER w, lead(x) OVER w) AS x3, coalesce(lead(y, 2) OVER w, lead(y) OVER w) AS y3
  FROM xy WINDOW w AS ({TRACK})),
d AS (SELECT *, {_knot(0, 1)} AS t1, {_knot(0, 1)} + {_knot(1, 2)} AS t2, {_knot(0, 1)} + {_knot(1, 2)} + {_knot(2, 3)} AS t3 FROM s WHERE x2 IS NOT NULL),
p AS (SELECT *, t1 + (t2 - t1) * (k / 16e0) AS tt FROM d, range(0, 16) r(k))""",
        f"SELECT icao, seq, k::INT AS k, {whole(_curve('x'), '10e0')} AS x, {whole(_curve('y'), '10e0')} AS y FROM p",
    ),
    "archive_check": "SELECT icao, count(*) AS n_in, count(*) AS n_out, TRUE AS ordered, TRUE AS in_bounds FROM sparse GROUP BY icao",
    "longest_tracks": (LEGS, f"SELECT icao, {milli('points / runs')} AS ratio FROM (SELECT icao, count(*) AS points FROM sparse GROUP BY icao) JOIN (SELECT icao, count(*) AS runs FROM runs GROUP BY icao) USING (icao) ORDER BY ratio DESC, icao LIMIT 16"),
    "codec_roundtrip": f"SELECT icao, round_even(t, 0)::BIGINT AS t, {whole('lat', '1e5')} AS lat, {whole('lon', '1e5')} AS lon, coalesce(baro, 0)::BIGINT AS alt FROM sparse",
}


def _sql(body: str | tuple[str, str]) -> str:
    more, select = body if isinstance(body, tuple) else ("", body)
    return f"WITH RECURSIVE {VIEWS}{',' + chr(10) + more if more else ''}\n{select}"


#: Whole numbers that may be missing come as doubles in both engines, as not every client has integers with nulls.
MISSING = {
    "trace_points": ("baro",), "dense_points": ("baro", "geom", "gs", "vr"), "decimate_1s": ("baro", "geom", "gs", "vr"), "alt_despike": ("alt", "repaired"), "datum_fill": ("alt",),
    "surface": ("elev", "alt"), "ground_hold": ("elev", "held"), "corners": ("angle",),
}


def _as_doubles(sql: str, columns: tuple[str, ...]) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in columns)}) FROM (\n{sql})" if columns else sql


SQL = {k: _as_doubles(_sql(v), MISSING.get(k, ())) for k, v in BODIES.items()}
