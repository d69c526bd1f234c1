"""Jaro-Winkler similarity over many pairs at once, and keys that all pairs of some similarity share."""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb

import numpy as np

#: Cells of a matrix of characters that are looked at together.
CELLS = 1 << 16
#: Keys that a name may have for one length of its partner, letters of a key, longest name that keys are made for.
MOST_KEYS, MOST_LETTERS, LONGEST = 70, 6, 32
#: Weight of a common prefix and its longest length; it counts above this similarity.
WEIGHT, PREFIX, ABOVE = 0.1, 4, 0.7


def _matrix(texts: list[str], lengths: np.ndarray, pad: int) -> np.ndarray:
    out = np.full((len(texts), max(1, int(lengths.max(initial=0)))), pad, np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def jaro_winkler_many(left: list[str], right: list[str]) -> np.ndarray:
    """The similarity of each pair."""
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))
    out, longest = np.zeros(len(left)), np.maximum(la, lb)
    order, at = np.argsort(longest, kind="stable"), 0
    while at < len(order):
        n = max(1, int(np.searchsorted(np.arange(1, len(order) - at + 1) * longest[order[at:]], CELLS, "right")))
        rows = order[at : at + n]
        out[rows] = _block([left[i] for i in rows], [right[i] for i in rows], la[rows], lb[rows])
        at += n
    return out


def _block(left: list[str], right: list[str], la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    a, b = _matrix(left, la, -1), _matrix(right, lb, -2)
    rows, places = np.arange(len(left)), np.arange(b.shape[1])
    reach = np.maximum(la, lb) // 2 - 1
    taken, matched = np.zeros(b.shape, bool), np.zeros(a.shape, bool)
    for i in range(a.shape[1]):
        free = (b == a[:, i : i + 1]) & ~taken & (np.abs(places - i) <= reach[:, None])
        first = free.argmax(axis=1)
        hit = free[rows, first]
        taken[rows[hit], first[hit]] = True
        matched[hit, i] = True
    m = matched.sum(axis=1)
    width = int(m.max(initial=0))
    # the matched characters of either side, in their order
    in_a = np.take_along_axis(a, np.argsort(~matched, axis=1, kind="stable"), axis=1)[:, :width]
    in_b = np.take_along_axis(b, np.argsort(~taken, axis=1, kind="stable"), axis=1)[:, :width]
    swaps = ((in_a != in_b) & (np.arange(width) < m[:, None])).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / la + m / lb + (m - swaps) / m) / 3, 0.0)
    k = min(PREFIX, a.shape[1], b.shape[1])
    prefix = np.cumprod(a[:, :k] == b[:, :k], axis=1).sum(axis=1)
    out = np.where(jaro > ABOVE, jaro + WEIGHT * prefix * (1 - jaro), jaro)
    same = np.fromiter((x == y for x, y in zip(left, right)), bool, len(left))
    return np.where(same, 1.0, np.where((la > 0) & (lb > 0), out, 0.0))


def least_jaro(threshold: float, prefix: int) -> float:
    """The Jaro similarity that a pair with such a common prefix needs for the threshold."""
    return min(threshold, max(ABOVE, (threshold - WEIGHT * prefix) / (1 - WEIGHT * prefix)))


#: Letters and digits from rare to frequent in names; all others are rarer.
FREQUENT = "qzxj0123456789kvwybfpghmudclsntrioae "


def letters(name: str) -> list[int]:
    """The characters of a name as numbers that differ (the second "a" is not the first), from rare to frequent in an order that all
    names share; as many as two names have in common, so many characters can match."""
    seen: dict[str, int] = {}
    out = []
    for c in name:
        k = seen[c] = seen.get(c, 0) + 1
        out.append((-k, FREQUENT.find(c), ord(c)))
    return [-k << 21 | c for k, _, c in sorted(out)]


def common(short: int, long: int, jaro: float) -> int:
    """Characters that must match between names of such lengths: with m of them the similarity is (m / short + m / long + 1) / 3 at most."""
    return max(1, ceil((3 * jaro - 1) * short * long / (short + long) - 1e-9))


def plan(short: int, long: int, jaro: float) -> tuple[int, int] | None:
    """(matches, letters of a key) for names of such lengths, None if they cannot be similar. If two sets of s and l letters have m in
    common, their first s - m + k and l - m + k have k in common in any order; k is the largest that makes few enough keys."""
    m = common(short, long, jaro)
    if m > short:
        return None
    k = 1
    while k < min(m, MOST_LETTERS) and comb(long - m + k + 1, k + 1) <= MOST_KEYS:
        k += 1
    return m, k


def keys(name: str, threshold: float) -> list[tuple[int, int]]:
    """(key, side) of a name of at most LONGEST characters: similar names share a key, with sides 0 and 1 for the shorter and the
    longer, or 2 and 2 if they are equally long. Names with a common beginning of PREFIX characters need less similarity, so they have
    keys of their own; keys of all others count at most PREFIX - 1. Keys are hashes: others may share one."""
    order, n, out = letters(name), len(name), set()
    for family in (0, 1):
        if family and n < PREFIX:
            continue
        start = 0
        for c in name[: PREFIX if family else 0]:
            start = (start * 1_000_003 + ord(c) + 1) % (2**61 - 1)
        jaro = least_jaro(threshold, PREFIX - 1 + family)
        for other in range(1, LONGEST + 1):
            short, long = min(n, other), max(n, other)
            found = plan(short, long, jaro)
            if found is None:
                continue
            m, k = found
            side = 2 if n == other else int(n > other)
            for chosen in combinations(order[: n - m + k], k):
                h = ((start * 64 + short) * 64 + long) * 2 + family
                for c in chosen:
                    h = (h * 1_000_003 + c) % (2**61 - 1)
                out.add((h % (2**61 - 1), side))
    return sorted(out)
