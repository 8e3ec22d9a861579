"""Vectorised words, word hashes and word shingles over the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; hashes see A-Z in lower case. Hashes have 64 bits and depend
on the bytes alone, so that every executor and every rerun gets the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 18

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit numbers."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + U(seed) * U(1 << 32)) * U(0x9E3779B97F4A7C15))


BYTE = numbers(256, 1)
BASE = 0x9E3779B97F4A7C13 | 3
BASE_INV = pow(BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i < n, kept for the usual chunk and made anew beyond it."""
    if _powers and len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    size = max(n, CHUNK_BYTES + 1)
    made = []
    for base in (BASE, BASE_INV):
        out = np.ones(size, dtype=np.uint64)
        done = 1
        with np.errstate(over="ignore"):
            while done < size:
                more = min(done, size - done)
                out[done : done + more] = out[:more] * U(pow(base, done, 1 << 64))
                done += more
        made.append(out)
    if size <= 4 * CHUNK_BYTES:
        _powers[:] = made
    return made[0], made[1]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, one after the other, and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of `limit` bytes at most, or of one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, and row of each word."""
    gap = SPACE[data]
    before, after = np.empty(len(data), dtype=bool), np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = after[-1] = True
        before[1:], after[:-1] = gap[:-1], gap[1:]
        full = offsets[1:] > offsets[:-1]
        before[offsets[:-1][full]] = True
        after[offsets[1:][full] - 1] = True
    starts = np.flatnonzero(~gap & before)
    ends = np.flatnonzero(~gap & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """What hashes_at needs of the bytes, A-Z taken in lower case."""
    up, _ = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE[LOWER[data]] * up[: len(data)], out=total[1:])
    return total


def hashes_at(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of the bytes summed in `total`."""
    _, down = powers(len(total))
    with np.errstate(over="ignore"):
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of bytes, A-Z taken in lower case."""
    return hashes_at(prefix_sums(data), starts, ends)


def shingles(h: np.ndarray, rows: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of k words in a row, their row and first word (its number in the row).

    A row of fewer words, but at least one, gets one shingle of all of them.
    """
    scale = numbers(k, 2)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    number = np.arange(len(h)) - first[rows] if len(h) else np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        whole = np.flatnonzero(number + k <= counts[rows]) if len(h) else np.zeros(0, dtype=np.int64)
        total = np.zeros(len(whole), dtype=np.uint64)
        for j in range(k):
            total += h[whole + j] * scale[j]
        short = np.flatnonzero((counts > 0) & (counts < k))
        rest = counts[short].astype(np.uint64) * U(0xA24BAED4963EE407)
        for j in range(k - 1):
            has = counts[short] > j
            rest[has] += h[first[short[has]] + j] * scale[j]
    s = np.concatenate([mix(total), mix(rest ^ U(0x5851F42D4C957F2D))])
    r = np.concatenate([rows[whole], short])
    p = np.concatenate([number[whole], np.zeros(len(short), dtype=np.int64)])
    if len(short):
        order = np.lexsort((p, r))
        s, r, p = s[order], r[order], p[order]
    return s, r, p


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of rows that agree in the first `keys` columns, from batches sorted by them. Keeps one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        for c in range(keys):
            v = batch.column(c).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(batch.column(c)[a].as_py() for c in range(keys))
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
