"""Runs: stretches of words that repeat with a period, found on a harmonic grid of longest common extensions.

A run is a stretch of a text with smallest period q, of at least two periods and `least` words, that neither neighbour extends. For each
period p the words at 0, p, 2p, .. are a grid, and a run of period p holds two neighbours jp and (j + 1)p of it. How far the text goes on alike
from both, forward and backward, gives the run's ends: it is one if the two extensions come to p or more. Over all p the grids have
n (1 + 1/2 + 1/3 + ..) pairs. Of the pairs of one run the first is taken, whose backward extension is less than p. A run is met by the
multiples of its period as well, with the same ends, and the least one stands.

Extensions are minima of ranges of the longest common prefixes of neighbours in a suffix array: one of the texts, one of the texts
reversed. Suffixes are sorted by doubling, of which only what is still tied is sorted again; a range is asked of a sparse table of the
minima of blocks, and of the running minima within a block, so that a text of n words takes O(n) memory but for the ranks of
doubling. Texts are put end to end and handled about CHUNK words at a time; a word of one text never equals one of another here. Pairs are
made PAIRS at a time. All is numpy on integers, without a loop over words.

Null and empty texts have no words and no run. Texts of any length are read whole, each within one task. Repeated rows give equal rows; null doc_ids
do no harm. Only doc_id and text are read, so other columns, also of clashing names, are of no matter. Empty tables give empty results.
Of runs of equal length the first is the longest, and of those the one of least period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches, trimmed

LEAST, CHUNK, PAIRS, BLOCK = 12, 200_000, 1 << 20, 16
Change = Callable[[int | None, list[bytes]], list[bytes]]


class Extensions:
    """How far a sequence of integers goes on alike from two places."""

    def __init__(self, words: np.ndarray, text: np.ndarray):
        """words: numbers from 0; text: the number of the text that each stands in, not falling. Places of two texts have nothing in common."""
        n = self.n = len(words)
        # the first ranks tell texts apart, so that suffixes of two texts are never tied
        _, rank = np.unique(text.astype(np.int64) * (int(words.max(initial=0)) + 1) + words, return_inverse=True)
        order = np.argsort(rank, kind="stable")
        rank = self._begins(rank[order])[np.argsort(order, kind="stable")] if n else rank
        levels, k = [rank.astype(np.int32)], 1
        while True:
            # places whose rank is shared, in order: each group is sorted by the rank of what follows k words on
            ranked = rank[order]
            same = np.zeros(n, dtype=bool)
            same[1:] = ranked[1:] == ranked[:-1]
            tied = same.copy()
            tied[:-1] |= same[1:]
            at = np.flatnonzero(tied)
            if not len(at):
                break
            places = order[at]
            # at a text's end nothing follows: less than all that does
            ahead = np.minimum(places + k, n - 1)
            then = np.where((places + k < n) & (text[ahead] == text[places]), rank[ahead] + 1, 0)
            new = np.lexsort((then, ranked[at]))
            places, then, was = places[new], then[new], ranked[at][new]
            order[at] = places
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (was[1:] != was[:-1]) | (then[1:] != then[:-1])
            rank = rank.copy()
            rank[places] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
            levels.append(rank.astype(np.int32))
            k *= 2
        self.rank = rank.astype(np.int32)
        self._minima(self._common(order, levels, text))

    @staticmethod
    def _begins(sorted_ranks: np.ndarray) -> np.ndarray:
        """For each of sorted ranks the place where its equals begin."""
        fresh = np.ones(len(sorted_ranks), dtype=bool)
        fresh[1:] = sorted_ranks[1:] != sorted_ranks[:-1]
        return np.maximum.accumulate(np.where(fresh, np.arange(len(sorted_ranks)), 0))

    def _common(self, order: np.ndarray, levels: list[np.ndarray], text: np.ndarray) -> np.ndarray:
        """The words that each suffix shares with the one before it in order: steps of falling powers of two on which ranks agree."""
        n = self.n
        out = np.zeros(n, dtype=np.int32)
        if n < 2:
            return out
        a, b = order[:-1].copy(), order[1:].copy()
        open_ = np.flatnonzero(text[a] == text[b])
        a, b, shared = a[open_], b[open_], np.zeros(len(open_), dtype=np.int64)
        limit = np.append(np.flatnonzero(np.diff(text)) + 1, n)
        end = limit[np.searchsorted(limit, np.maximum(a, b), side="right")] if len(a) else a
        for level in range(len(levels) - 1, -1, -1):
            step = 1 << level
            x, y = a + shared, b + shared
            fits = np.maximum(x, y) + step <= end
            alike = fits & (levels[level][np.where(fits, x, 0)] == levels[level][np.where(fits, y, 0)])
            shared += np.where(alike, step, 0)
        out[open_ + 1] = shared
        return out

    def _minima(self, lcp: np.ndarray) -> None:
        n, pad = self.n, -self.n % BLOCK
        blocks = np.concatenate([lcp, np.full(pad, np.iinfo(np.int32).max, np.int32)]).reshape(-1, BLOCK)
        self.lcp = lcp
        self.left = np.minimum.accumulate(blocks, axis=1).ravel()  # from the block's first to here
        self.right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()  # from here to its last
        table = [blocks.min(axis=1) if len(blocks) else np.zeros(0, np.int32)]
        while 2 << (len(table) - 1) <= len(table[0]):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self.table = table
        size = np.zeros(len(table[0]) + 1, dtype=np.int8)
        for i in range(1, len(table)):
            size[1 << i :] = i
        self.log = size

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of words alike from places a and b on, two different places of one text each."""
        x, y = self.rank[a].astype(np.int64), self.rank[b].astype(np.int64)
        lo, hi = np.minimum(x, y) + 1, np.maximum(x, y)  # the least of lcp[lo .. hi]
        first, last = lo // BLOCK, hi // BLOCK
        out = np.minimum(self.right[lo], self.left[hi])
        between = last - first - 1
        for i in np.unique(self.log[np.maximum(between, 0)][between > 0]).tolist():
            m = np.flatnonzero((between > 0) & (self.log[np.maximum(between, 0)] == i))
            row = self.table[i]
            out[m] = np.minimum(out[m], np.minimum(row[first[m] + 1], row[last[m] - (1 << i)]))
        inside = np.flatnonzero(first == last)
        if len(inside):
            p, q = lo[inside], hi[inside]
            low = self.lcp[p]
            for step in range(1, BLOCK):
                low = np.minimum(low, self.lcp[np.minimum(p + step, q)])
            out[inside] = low
        return out


def grid(lengths: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period): all jp with (j + 1)p in the text, for each text and each period p of half its words at most; PAIRS at a time or of one period."""
    periods = lengths // 2
    text = np.repeat(np.arange(len(lengths)), periods)
    p = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    n = (lengths[text] - 1) // p
    lo = 0
    upto = np.cumsum(n)
    while lo < len(p):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, side="right")))
        k = n[lo:hi]
        j = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        period = np.repeat(p[lo:hi], k)
        yield np.repeat(starts[text[lo:hi]], k) + j * period, period
        lo = hi


def runs(words: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, ordered by start and period, of texts of `lengths` words that stand end to end; starts count from the first text's first word."""
    lengths = np.asarray(lengths, dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), lengths)
    n = len(words)
    first = starts[text]
    ahead = behind = None
    found = [(np.zeros(0, np.int64),) * 3]
    for a, p in grid(lengths, starts):
        # a pair of unlike words has no forward extension, and a run that ends before it is the pair's before
        alike = np.flatnonzero(words[a] == words[a + p])
        if not len(alike):
            continue
        if ahead is None:
            ahead, behind = Extensions(words, text), Extensions(words[::-1], text[-1] - text[::-1])
        a, p = a[alike], p[alike]
        forward = ahead.of(a, a + p).astype(np.int64)
        # from the words before the pair's, read backward; a text's first word has none before it
        backward = np.zeros(len(a), dtype=np.int64)
        inner = np.flatnonzero(a > first[a])
        if len(inner):
            backward[inner] = behind.of(n - a[inner], n - a[inner] - p[inner])
        run = (backward < p) & (backward + forward >= p) & (backward + forward + p >= least)
        found.append(((a - backward)[run], (p + backward + forward)[run], p[run]))
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    once = np.ones(len(start), dtype=bool)
    once[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[once], length[once], period[once]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def numbered(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """Words as numbers, equal for equal words."""
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(start):
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten with a tail that repeats itself, by the crc32 of its id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


def _texts(batches: Iterator[pa.RecordBatch], change: Change | None, least: int) -> Iterator[list[tuple[int | None, list[bytes], np.ndarray, np.ndarray, np.ndarray]]]:
    """(doc_id, words, start, length, period) of texts, about CHUNK words at a time."""
    held: list[tuple[int | None, list[bytes]]] = []
    size = 0

    def done():
        known: dict[bytes, int] = {}
        lengths = np.array([len(w) for _, w in held], dtype=np.int64)
        ids = np.concatenate([np.zeros(0, np.int64), *(numbered(w, known) for _, w in held)])
        found = runs(ids, lengths, least)
        ends = np.cumsum(lengths)
        cut = np.searchsorted(found[0], ends)
        low = 0
        out = []
        for (doc, w), hi, end, n in zip(held, cut.tolist(), ends.tolist(), lengths.tolist(), strict=True):
            out.append((doc, w, found[0][low:hi] - (end - n), found[1][low:hi], found[2][low:hi]))
            low = hi
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            w = (text.as_py() or b"").split()
            held.append((doc, change(doc, w) if change else w))
            size += len(w)
            if size >= CHUNK or len(held) >= 1000:
                yield done()
                held, size = [], 0
    if held:
        yield done()


def _rows(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def periodic_runs(docs: DataFrame, *, least: int = LEAST) -> DataFrame:
    """(doc_id, start, length, period): the runs of each text, in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches, None, least):
            doc = [d for d, _, s, _, _ in texts for _ in range(len(s))]
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), *(pa.array(np.concatenate([t[i] for t in texts])) for i in (2, 3, 4))], ["doc_id", "start", "length", "period"])

    return _rows(docs).mapInArrow(trimmed(run), "doc_id long, start long, length long, period long")


def collapse_runs(docs: DataFrame, *, least: int = LEAST) -> DataFrame:
    """(doc_id, text): each text's words that no run holds after its first period, joined by single spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches, None, least):
            kept = [b" ".join(collapsed(w, *found)).decode("utf-8", "replace") for _, w, *found in texts]
            yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in texts], pa.int64()), pa.array(kept, pa.string())], ["doc_id", "text"])

    return _rows(docs).mapInArrow(trimmed(run), "doc_id long, text string")


def summary(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of one text."""
    longest = (None,) * 4
    if len(start):
        i = int(np.argmax(length))  # runs are by start and period: the first of the longest
        longest = (int(start[i]), int(length[i]), int(period[i]), 1000 * int(length[i]) // int(period[i]))
    listed = "".join([f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist(), strict=True)])
    return len(start), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, start, length, period))).hexdigest()


def run_summaries(docs: DataFrame, *, least: int = LEAST, change: Change | None = None) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): a row for each row; start to exponent_milli are of the
    longest run. `change` makes the words of a text, given its doc_id, into those that are read."""
    names = ["n_runs", "start", "length", "period", "exponent_milli"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _texts(batches, change, least):
            found = list(zip(*(summary(*t[1:]) for t in texts), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in texts], pa.int64()), *(pa.array(c, pa.int64()) for c in found[:5]), pa.array(found[5]), pa.array(found[6])], ["doc_id", *names, "runs_sha256", "collapsed_sha256"])

    return _rows(docs).mapInArrow(trimmed(run), f"doc_id long, {', '.join(f'{n} long' for n in names)}, runs_sha256 string, collapsed_sha256 string")
