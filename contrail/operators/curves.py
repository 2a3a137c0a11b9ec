"""Sparse nodes whose centripetal Catmull-Rom curve stays within each point's tolerance, and checks of such curves."""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np

SUB = 12


def curve(p0, p1, p2, p3, u: np.ndarray) -> np.ndarray:
    """Points at u (0 to 1) between p1 and p2, one row each."""
    p = np.array([p0, p1, p2, p3], dtype=np.float64)
    knots = np.concatenate(([0.0], np.cumsum(np.sqrt(np.maximum(np.hypot(*np.diff(p, axis=0).T), 1e-9)))))
    t = (knots[1] + (knots[2] - knots[1]) * u)[:, None]

    def between(a, b, i, j):
        return a + (b - a) * (t - knots[i]) / (knots[j] - knots[i])

    a = [between(p[k], p[k + 1], k, k + 1) for k in range(3)]
    b = [between(a[k], a[k + 1], k, k + 2) for k in range(2)]
    return between(b[0], b[1], 1, 2)


def polyline(nodes: np.ndarray, sub: int = SUB) -> np.ndarray:
    """The curve through nodes, sub chords to a span; end nodes stand for the missing neighbours."""
    if len(nodes) < 2:
        return np.asarray(nodes, dtype=np.float64)
    u = np.arange(sub) / sub
    padded = np.concatenate((nodes[:1], nodes, nodes[-1:]))
    return np.concatenate([curve(*padded[k : k + 4], u) for k in range(len(nodes) - 1)] + [nodes[-1:]])


def distances(points: np.ndarray, line: np.ndarray, block: int = 4096) -> np.ndarray:
    """From each point to the nearest chord of line."""
    if len(line) == 1:
        return np.hypot(*(points - line[0]).T)
    a, d = line[:-1], np.diff(line, axis=0)
    n = (d**2).sum(axis=1)
    n[n == 0] = 1e-9
    out = []
    for k in range(0, len(points), block):
        q = points[k : k + block, None, :] - a
        u = np.clip((q * d).sum(axis=2) / n, 0, 1)
        out.append(np.sqrt(((q - u[:, :, None] * d) ** 2).sum(axis=2).min(axis=1)))
    return np.concatenate(out) if out else np.empty(0)


def place_nodes(points: np.ndarray, tol: np.ndarray, sub: int = SUB) -> np.ndarray:
    """Indices of nodes, both ends included: as long as a point is farther from its span's curve than it may be, the worst becomes a node.

    excess and worst are kept for each span under its left node; a new node changes its own two spans and, as they lean
    on their neighbours, the two beside them. A heap gives the worst span; what it holds of a span that was measured again is passed over.
    """
    points, tol, n = np.asarray(points, dtype=np.float64), np.asarray(tol, dtype=np.float64), len(points)
    if n <= 2:
        return np.arange(n)
    after, before = np.full(n, -1), np.full(n, -1)
    after[0], before[n - 1] = n - 1, 0
    excess, worst = np.full(n, -np.inf), np.zeros(n, dtype=int)
    u = np.arange(sub + 1) / sub

    def measure(a: int) -> None:
        b = after[a]
        excess[a] = -np.inf
        if b - a > 1:
            line = curve(points[before[a] if before[a] >= 0 else a], points[a], points[b], points[after[b] if after[b] >= 0 else b], u)
            over = distances(points[a + 1 : b], line) - tol[a + 1 : b]
            k = int(over.argmax())
            excess[a], worst[a] = over[k], a + 1 + k
            if over[k] > 0:
                heappush(heap, (-over[k], a))

    heap: list[tuple[float, int]] = []
    measure(0)
    while heap:
        most, a = heappop(heap)
        if -most != excess[a]:
            continue
        b, m = after[a], worst[a]
        after[a], before[m], after[m], before[b] = m, a, b, m
        for left in (before[a], a, m, b if after[b] >= 0 else -1):
            if left >= 0:
                measure(left)
    return np.flatnonzero(np.concatenate(([True], before[1:] >= 0)))


def unit(v: np.ndarray) -> np.ndarray:
    n = np.hypot(v[:, 0], v[:, 1])[:, None]
    return np.divide(v, n, out=np.zeros_like(v), where=n > 0)


def corner_places(points: np.ndarray, ground: np.ndarray, degrees: float) -> np.ndarray:
    """Both ends, sharp turns, and first points after a change between ground and air."""
    steps = unit(np.diff(points, axis=0))
    turn = np.degrees(np.arccos(np.clip((steps[:-1] * steps[1:]).sum(axis=1), -1, 1)))
    inner = np.flatnonzero((turn > degrees) | (ground[1:-1] != ground[:-2])) + 1
    return np.concatenate(([0], inner, [len(points) - 1]))


def fit(points: np.ndarray, tol: np.ndarray, ground: np.ndarray, degrees: float = 35.0) -> tuple[np.ndarray, np.ndarray]:
    """(indices, cusp) of a track's nodes: the curve is broken at corners, and both ends count as such."""
    cuts = corner_places(points, ground, degrees)
    nodes = [a + place_nodes(points[a : b + 1], tol[a : b + 1]) for a, b in zip(cuts[:-1], cuts[1:])]
    at = np.unique(np.concatenate(nodes))
    return at, np.isin(at, cuts)


def broken_polyline(nodes: np.ndarray, cusp: np.ndarray, sub: int = 16) -> np.ndarray:
    """The whole curve of a track, begun anew at every cusp but the first node."""
    cuts = np.unique(np.concatenate(([0], np.flatnonzero(cusp[1:]) + 1, [len(nodes) - 1])))
    pieces = [polyline(nodes[a : b + 1], sub) for a, b in zip(cuts[:-1], cuts[1:])]
    return np.concatenate([p[:-1] for p in pieces[:-1]] + pieces[-1:]) if pieces else polyline(nodes, sub)
