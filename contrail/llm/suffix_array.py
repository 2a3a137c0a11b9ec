"""Suffix arrays by induced sorting, with every step over whole arrays.

Suffixes are classified as smaller or larger than the next one; the leftmost smaller ones are sorted by their substrings, which are
named, and the string of names is sorted in the same way, recursively, until no two names are equal or the string is short; the order
of all suffixes is then induced in two scans. A scan takes a stretch of the order at a time: entries before the first place that the
stretch itself fills are final, so what they induce is placed at once, and the scan goes on from there.
"""

from __future__ import annotations

import numpy as np

#: Most of the order that is taken at a time.
STRETCH = 1 << 16
#: Strings of names up to this length are sorted by pairs of ranks, where scans of whole arrays gain nothing.
SHORT = 1 << 17


def types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last, a sentinel, counts as smaller."""
    n = len(text)
    out = np.ones(n, dtype=bool)
    differs = np.flatnonzero(text[1:] != text[:-1])
    if len(differs):
        rises = text[differs + 1] > text[differs]
        out[: differs[-1] + 1] = np.repeat(rises, np.diff(differs, prepend=-1))
    return out


def _scan(order: np.ndarray, text: np.ndarray, right_kind: np.ndarray, cursor: np.ndarray) -> None:
    """Place the predecessors that are of the kind to be induced at their buckets' cursors, from the order's first place to its last.
    cursor: each bucket's next free place, in the order's own direction."""
    n, i, size = len(order), 0, 1 << 12
    while i < n:
        j = min(i + size, n)
        held = order[i:j]
        at = (held > 0).nonzero()[0]
        before = held[at] - 1
        fits = right_kind[before].nonzero()[0]
        if not len(fits):
            i, size = j, min(size * 2, STRETCH)
            continue
        at, before = at[fits], before[fits]
        chars = text[before]
        by = chars.argsort(kind="stable")
        ranked = chars[by]
        edges = (ranked[1:] != ranked[:-1]).nonzero()[0]
        target = cursor[ranked]
        if len(edges) + 1 < len(ranked):  # several go to one bucket: each after the one before it
            new = np.zeros(len(edges) + 1, dtype=np.int64)
            np.add(edges, 1, out=new[1:])
            run = np.arange(len(ranked))
            begin = np.zeros(len(ranked), dtype=np.int64)
            begin[new[1:]] = new[1:]
            target += run - np.maximum.accumulate(begin)
        first = int(target.min())
        if first < j:
            final = (at[by] < first - i).nonzero()[0]
            target, ranked, by = target[final], ranked[final], by[final]
            size = max((first - i) * 3 // 2, 64)
            i = first
        else:
            i, size = j, min(size * 2, STRETCH)
        order[target] = before[by]
        cursor[ranked] = target + 1  # the last of a bucket counts

def _induced(text: np.ndarray, smaller: np.ndarray, ends: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """The order of all suffixes from that of the leftmost smaller ones, which come by bucket at least."""
    n = len(text)
    order = np.full(n, -1, dtype=np.int32)
    bucket = text[leftmost]
    new = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    counts = np.diff(np.append(new, len(bucket)))
    place = np.arange(len(bucket)) + np.repeat(ends[bucket[new]] - counts - new, counts)
    order[place] = leftmost
    sizes = np.diff(ends, prepend=0)
    _scan(order, text, ~smaller, ends - sizes)
    order[place[1:]] = -1  # the sentinel stays
    _scan(order[::-1], text, smaller, n - ends)
    order[0] = n - 1
    return order


def _names(text: np.ndarray, leftmost: np.ndarray, in_order: np.ndarray) -> np.ndarray:
    """Numbers of the substrings from each leftmost suffix to the next, in the order given: equal ones get one number."""
    n = np.zeros(len(text), dtype=np.int32)
    n[leftmost] = np.append(np.diff(leftmost) + 1, 1)
    length = n[in_order]
    same = np.flatnonzero(length[1:] == length[:-1]) + 1
    equal = np.zeros(len(in_order), dtype=bool)
    k = 0
    while len(same):
        same = same[text[in_order[same] + k] == text[in_order[same - 1] + k]]
        k += 1
        ended = length[same] <= k
        equal[same[ended]] = True
        same = same[~ended]
    return np.cumsum(~equal, dtype=np.int32) - 1


def _doubled(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of names by pairs of ranks, again and again. A rank is the place where a group of suffixes that are
    equal so far begins in the order; only such groups are sorted again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    new = np.flatnonzero(np.concatenate(([True], np.diff(names[order]) != 0)))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(new, np.diff(np.append(new, n)))
    width = 1
    while True:
        ranked = rank[order]
        same = ranked[1:] == ranked[:-1]
        at = np.flatnonzero(np.append(same, False) | np.append(False, same))
        if not len(at):
            return order.astype(np.int32)
        members = order[at]
        after = np.where(members + width < n, rank[np.minimum(members + width, n - 1)] + 1, 0)
        pair = rank[members] * (n + 2) + after
        by = np.argsort(pair)
        members, pair = members[by], pair[by]
        order[at] = members
        new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        rank[members] = np.repeat(at[new], np.diff(np.append(new, len(at))))
        width *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes of text in ascending order; text ends with its only 0, values are whole numbers below its length or 2^16."""
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int32)
    sizes = np.bincount(text)
    if sizes.max() == 1:
        return np.argsort(text).astype(np.int32)
    ends = np.cumsum(sizes)
    smaller = types(text)
    first = smaller.copy()
    first[1:] &= ~smaller[:-1]
    first[0] = False
    leftmost = np.flatnonzero(first).astype(np.int32)
    rough = _induced(text, smaller, ends, leftmost[np.argsort(text[leftmost], kind="stable")])
    in_order = rough[first[rough]]
    names = _names(text, leftmost, in_order)
    if names[-1] + 1 < len(names):
        of = np.empty(n, dtype=np.int32)
        of[in_order] = names
        reduced = of[leftmost]
        in_order = leftmost[suffix_array(reduced) if len(reduced) > SHORT else _doubled(reduced)]
    return _induced(text, smaller, ends, in_order)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each place of the text how many characters its suffix has in common with the one before it in the
    order, counted up to `most`."""
    before = np.full(len(text), -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(text), dtype=np.int32)
    padded = np.zeros(len(text) + most + 8, dtype="<u2")
    padded[: len(text)] = text
    fours = np.ndarray((len(padded) - 3,), "<u8", padded, 0, (2,))  # four characters from each place on
    at = np.flatnonzero(before >= 0)
    other = before[at]
    for k in range(0, most, 4):
        differ = fours[at + k] ^ fours[other + k]
        same = differ == 0
        if not same.all():
            ended, x = at[~same], differ[~same]
            inner = np.zeros(len(x), dtype=np.int32)
            for bits in (16, 32, 48):
                inner += x & np.uint64((1 << bits) - 1) == 0
            out[ended] = k + inner
            at, other = at[same], other[same]
    out[at] = most
    return np.minimum(out, most)
