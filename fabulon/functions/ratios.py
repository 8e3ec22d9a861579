"""difflib's ratio of many pairs at once: the same blocks, found for all windows of one depth in one step of numpy."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np

#: Pairs and characters that are compared at once, places where both texts of them agree (more of them are halved), and characters of a text (longer ones go to difflib).
PAIRS, LETTERS, PLACES, LONGEST = 1 << 11, 1 << 19, 1 << 21, 1 << 20
#: So few pairs take less time one by one.
FEW = 8
#: Length of a second text from which on difflib takes no match from its frequent characters.
POPULAR = 200


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """SequenceMatcher(None, x, y).ratio() of each x of a and y of b."""
    if len(a) <= FEW:
        return np.array([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype=float)
    out = np.empty(len(a))
    for lo, hi in _parts(a, b):
        _fill(a, b, lo, hi, out)
    return out


def _parts(a: list[str], b: list[str]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i in range(len(a)):
        size = len(a[i]) + len(b[i])
        if i > lo and (i - lo >= PAIRS or held + size > LETTERS):
            yield lo, i
            lo, held = i, 0
        held += size
    if lo < len(a):
        yield lo, len(a)


def _fill(a: list[str], b: list[str], lo: int, hi: int, out: np.ndarray) -> None:
    found = None if hi - lo == 1 and max(len(a[lo]), len(b[lo])) > LONGEST else _matches(a[lo:hi], b[lo:hi])
    if found is not None:
        whole = np.array([len(x) + len(y) for x, y in zip(a[lo:hi], b[lo:hi], strict=True)])
        out[lo:hi] = np.where(whole > 0, 2.0 * found / np.maximum(whole, 1), 1.0)
    elif hi - lo == 1:
        out[lo] = SequenceMatcher(None, a[lo], b[lo]).ratio()
    else:
        mid = (lo + hi) // 2
        _fill(a, b, lo, mid, out)
        _fill(a, b, mid, hi, out)


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of the texts, each with one more behind its end; where each begins, and where it ends."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    return np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64), ends - sizes, ends


def _met(x: np.ndarray, at_x: np.ndarray, y: np.ndarray, at_y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Places of equal keys, and the index into x of each; None if there are more than PLACES."""
    order = np.argsort(y, kind="stable")
    y = y[order]
    low = np.searchsorted(y, x, "left")
    n = np.searchsorted(y, x, "right") - low
    total = int(n.sum())
    if total > PLACES:
        return None
    of = np.repeat(np.arange(len(x)), n)
    nth = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    return at_x[of], at_y[order[low[of] + nth]], of


def _grown(ok: np.ndarray, step) -> np.ndarray:
    """How often step(rows, n) holds in a row for each of the rows `ok`."""
    size = np.zeros(len(ok), dtype=np.int64)
    rows, n = np.flatnonzero(ok), 0
    while len(rows):
        rows = rows[step(rows, n)]
        n += 1
        size[rows] = n
    return size


def _matches(a: list[str], b: list[str]) -> np.ndarray | None:
    """Characters in matching blocks of each pair; None if that takes too many places at once.

    The longest run of a window (the first in a, then in b) is its block; the windows before and behind it are of the next depth. A run lies on one side of the block, as it would be longer
    otherwise. Runs of two characters and more are found first; single ones then, in the windows that these leave. In long texts runs hold no frequent
    character of b, and a block grows by equal ones at its ends.
    """
    (x, x0, x1), (y, y0, y1) = _letters(a), _letters(b)
    codes = np.zeros(int(max(x.max(), y.max())) + 1, dtype=np.int64)
    codes[x] = codes[y] = 1
    n = int(codes.sum())
    if len(a) > 1 and len(a) * n > 1 << 24:
        return None
    codes = np.cumsum(codes) - 1
    x, y = codes[x], codes[y]
    of_x, of_y = np.repeat(np.arange(len(a)), x1 - x0 + 1), np.repeat(np.arange(len(a)), y1 - y0 + 1)
    x[x1], y[y1] = -1, -2
    # u, v: what runs are made of
    u, v = x, y
    long = y1 - y0 >= POPULAR
    if long.any():
        seen = np.bincount((of_y * n + y)[y >= 0], minlength=len(a) * n).reshape(len(a), n)
        often = (seen > ((y1 - y0) // 100 + 1)[:, None]) & long[:, None]
        u, v = np.where((x >= 0) & often[of_x, x], -1, x), np.where((y >= 0) & often[of_y, y], -2, y)
    two_x, two_y = np.flatnonzero((u[:-1] >= 0) & (u[1:] >= 0)), np.flatnonzero((v[:-1] >= 0) & (v[1:] >= 0))
    met = _met((of_x[two_x] * n + u[two_x]) * n + u[two_x + 1], two_x, (of_y[two_y] * n + v[two_y]) * n + v[two_y + 1], two_y)
    if met is None:
        return None
    p, q, _ = met
    first = u[p - 1] != v[q - 1]
    p, q = p[first], q[first]
    size = 2 + _grown(np.ones(len(p), bool), lambda rows, k: u[p[rows] + 2 + k] == v[q[rows] + 2 + k])
    total = np.zeros(len(a), dtype=np.int64)
    windows = np.stack([np.arange(len(a)), x0, x1, y0, y1])
    rest = _split(windows, of_x[p], p, q, size, 2, x, y, long, total)
    rest = rest[:, (rest[1] < rest[2]) & (rest[3] < rest[4])]

    def inside(low, high, letters):
        at = np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange(int((high - low).sum()))
        of = np.repeat(np.arange(len(low)), high - low)
        kept = letters[at] >= 0
        return of[kept], at[kept]

    (wx, px), (wy, py) = inside(rest[1], rest[2], u), inside(rest[3], rest[4], v)
    met = _met(wx * n + u[px], px, wy * n + v[py], py)
    if met is None:
        return None
    p, q, of = met
    rest = _split(rest, wx[of], p, q, np.ones(len(p), dtype=np.int64), 1, x, y, long, total)
    # windows of long texts without a run: the equal characters with which both sides begin
    rest = rest[:, long[rest[0]] & (rest[1] < rest[2]) & (rest[3] < rest[4])]
    room = np.minimum(rest[2] - rest[1], rest[4] - rest[3])
    np.add.at(total, rest[0], _grown(np.ones(rest.shape[1], bool), lambda rows, k: (k < room[rows]) & (x[np.where(k < room[rows], rest[1, rows] + k, 0)] == y[np.where(k < room[rows], rest[3, rows] + k, 0)])))
    return total


def _split(windows: np.ndarray, w: np.ndarray, p: np.ndarray, q: np.ndarray, size: np.ndarray, least: int, x: np.ndarray, y: np.ndarray, long: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Adds the blocks of the windows (pair, begin and end in x, begin and end in y) to total, depth by depth, from the runs (window, place in x, place in y,
    size) sorted by window; gives the windows in which no run of at least `least` is left."""
    left_over = []
    while len(w):
        begin = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        own = w[begin]
        empty = np.ones(windows.shape[1], bool)
        empty[own] = False
        left_over.append(windows[:, empty])
        pair, a0, a1, b0, b1 = windows[:, own]
        g = np.repeat(np.arange(len(own)), np.diff(np.append(begin, len(w))))
        low = (1 << 21) - 1
        best = np.maximum.reduceat(size << 42 | (low - (p - a0[g])) << 21 | (low - (q - b0[g])), begin)
        i, j, k = a0 + low - (best >> 21 & low), b0 + low - (best & low), best >> 42
        if (wide := long[pair]).any():
            room = np.minimum(i - a0, j - b0)
            back = _grown(wide, lambda rows, n: (n < room[rows]) & (x[i[rows] - n - 1] == y[j[rows] - n - 1]))  # noqa: B023
            i, j, k = i - back, j - back, k + back
            room = np.minimum(a1 - i, b1 - j) - k
            on = i + k, j + k
            k = k + _grown(wide, lambda rows, n: (n < room[rows]) & (x[np.where(n < room[rows], on[0][rows] + n, 0)] == y[np.where(n < room[rows], on[1][rows] + n, 0)]))  # noqa: B023
        np.add.at(total, pair, k)
        windows = np.concatenate([np.stack([pair, a0, i, b0, j]), np.stack([pair, i + k, a1, j + k, b1])], axis=1)
        before = np.minimum(size, np.minimum(i[g] - p, j[g] - q))
        past = np.maximum(0, np.maximum((i + k)[g] - p, (j + k)[g] - q))
        one, two = before >= least, size - past >= least
        w, p, q, size = (np.concatenate(c) for c in ((g[one], g[two] + len(own)), (p[one], (p + past)[two]), (q[one], (q + past)[two]), (before[one], (size - past)[two])))
    return np.concatenate([*left_over, windows], axis=1)
