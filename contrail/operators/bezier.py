"""Piecewise cubic Bezier fits by least squares, after Schneider's algorithm, under a tolerance for each point."""

from __future__ import annotations

import numpy as np

from contrail.operators.curves import corner_places, unit


def basis(u: np.ndarray) -> np.ndarray:
    v = 1 - u
    return np.stack((v**3, 3 * u * v**2, 3 * u**2 * v, u**3), axis=1)


def evaluate(b: np.ndarray, u: np.ndarray) -> np.ndarray:
    return basis(u) @ b


def least_squares(p: np.ndarray, u: np.ndarray, t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
    """The control points for fixed end tangents; a third of the chord where the solution isn't usable."""
    w = basis(u)
    a, c = np.outer(w[:, 1], t1), np.outer(w[:, 2], t2)
    rest = p - np.outer(w[:, 0] + w[:, 1], p[0]) - np.outer(w[:, 2] + w[:, 3], p[-1])
    m = np.array([[(a * a).sum(), (a * c).sum()], [(a * c).sum(), (c * c).sum()]])
    r = np.array([(a * rest).sum(), (c * rest).sum()])
    chord, det = np.hypot(*(p[-1] - p[0])), m[0, 0] * m[1, 1] - m[0, 1] * m[1, 0]
    left, right = (0.0, 0.0) if det == 0 else ((r[0] * m[1, 1] - m[0, 1] * r[1]) / det, (m[0, 0] * r[1] - m[0, 1] * r[0]) / det)
    if min(left, right) < 1e-6 * chord:
        left = right = chord / 3
    return np.stack((p[0], p[0] + t1 * left, p[-1] + t2 * right, p[-1]))


def refined(p: np.ndarray, b: np.ndarray, u: np.ndarray) -> np.ndarray:
    """One Newton step of each parameter towards the curve's nearest point."""
    d = evaluate(b, u) - p
    one, two = 3 * np.diff(b, axis=0), 6 * np.diff(b, 2, axis=0)
    v = (1 - u)[:, None]
    w = u[:, None]
    first = one[0] * v**2 + 2 * one[1] * v * w + one[2] * w**2
    second = two[0] * v + two[1] * w
    den = (first * first).sum(axis=1) + (d * second).sum(axis=1)
    return u - np.divide((d * first).sum(axis=1), den, out=np.zeros_like(u), where=den != 0)


def worst(p: np.ndarray, b: np.ndarray, u: np.ndarray, tol: np.ndarray) -> tuple[float, int]:
    over = np.hypot(*(evaluate(b, u[1:-1]) - p[1:-1]).T) - tol[1:-1]
    k = int(over.argmax())
    return float(over[k]), k + 1


def fit(points: np.ndarray, tol: np.ndarray, rounds: int = 5) -> np.ndarray:
    """(n, 4, 2): cubics through the ends of consecutive pieces, each within tol of its points. Pieces are split at their worst point."""
    points = np.asarray(points, dtype=np.float64)
    if len(points) < 2:
        return np.empty((0, 4, 2))
    t1, t2 = unit(points[1:2] - points[:1])[0], unit(points[-2:-1] - points[-1:])[0]
    out, todo = [], [(0, len(points) - 1, t1, t2)]
    while todo:
        a, z, t1, t2 = todo.pop()
        p, limit = points[a : z + 1], tol[a : z + 1]
        lengths = np.concatenate(([0.0], np.cumsum(np.hypot(*np.diff(p, axis=0).T))))
        u = lengths / (lengths[-1] or 1.0)
        if z - a == 1:
            third = lengths[-1] / 3
            out.append(np.stack((p[0], p[0] + t1 * third, p[1] + t2 * third, p[1])))
            continue
        b = least_squares(p, u, t1, t2)
        off, at = worst(p, b, u, limit)
        for _ in range(rounds):
            if off <= 0:
                break
            v = refined(p, b, u)
            c = least_squares(p, v, t1, t2)
            off2, at2 = worst(p, c, v, limit)
            if off2 >= off:
                break
            b, u, off, at = c, v, off2, at2
        if off <= 0:
            out.append(b)
            continue
        m = a + at
        turn = unit((points[m - 1] - points[m + 1])[None])[0]
        todo += [(m, z, -turn, t2), (a, m, t1, turn)]
    return np.array(out)


def nodes(points: np.ndarray, tol: np.ndarray, ground: np.ndarray, degrees: float = 35.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indices, cusp, handles) of a track: handles are (n, 2, 2), in and out, NaN at the open ends. Nodes are points of the track."""
    cuts = corner_places(points, ground, degrees)
    pieces = [fit(points[a : b + 1], tol[a : b + 1]) for a, b in zip(cuts[:-1], cuts[1:])]
    b = np.concatenate(pieces)
    xy = np.concatenate((b[:, 0], b[-1:, 3]))
    handles = np.full((len(xy), 2, 2), np.nan)
    handles[1:, 0], handles[:-1, 1] = b[:, 2], b[:, 1]
    cusp = np.zeros(len(xy), dtype=bool)
    cusp[np.concatenate(([0], np.cumsum([len(x) for x in pieces])))] = True
    at, k = [], 0
    for p in xy:  # nodes are the track's own points, in its order
        k += int(np.flatnonzero((points[k:] == p).all(axis=1))[0])
        at.append(k)
    return np.array(at), cusp, handles
