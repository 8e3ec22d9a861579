"""Fuzzy passage deduplication by collinear chaining of shared word k-mer seeds.

1. Seeds: of the hashes of k words in a row those below 2^64 / DENSE, whatever stands around them, so that a changed word costs the k
   seeds that hold it and no other; and the minimizers of every window of `window`, so that two texts that share window + k - 1
   words in a row share a seed. What a text has of one seed beyond the first is a seed by its number as well, so that a line that
   is repeated many times meets the same line in another text at as many places.
2. Every occurrence of a seed meets its first one (the smallest doc_id, and there the first place) and the one in the document
   before its own among those with the seed - two rows at most for each occurrence, however common the passage. So a passage whose seeds stand
   somewhere earlier as well mostly meets the last text that holds it. The occurrences are sorted and read as a stream, so that a
   seed of any frequency takes no memory; seeds that a sample shows to be frequent are dealt by ranges of documents as well, each of which begins with
   the seed's first occurrence and the last one before the range. Short seeds are dealt in buckets of about BUCKET occurrences, so that a
   row of the shuffle holds many.
   Word for word repeats of more than `least` words are found whatever else holds parts of them. Each has a middle of `least` + 2 - window words (a
   minimizer) in both texts; occurrences of middles that stand in two documents meet like those of short seeds. Where the middles in a row of one
   text do not amount to more than `least` words with one other, every window of `least` + 1 words around
   that middle is a seed in all texts that hold it, and so meets the first text with the whole window.
   Runs of equal middles or windows of more than `least` words are repeats as they stand; but for their ends, chains within them need no alignment.
3. For each document the anchors to one earlier document are merged along diagonals and chained: a chain rises in both texts, and
   gives up `gap` for each word that it skips in either. A Fenwick tree over the places in the other text finds the best chain that
   each anchor continues, in O(n log n).
4. The words of the other text around any other chain (of PIECE words at most) are fetched (in blocks of words, each sent once for each chain that needs it).
   The chain and `slack` words on either side are aligned by a longest common subsequence, and the stretches of it that are dense
   in equal words count when `similar` of the longer side agrees, or else their longest part of which that holds. Passages of
   one other document that touch are united, and those of more than `least` words are repeats.

A text keeps the passages that first occur in it; later documents lose theirs. Within one document nothing is a repeat of
itself. Order is by doc_id. Of different texts that share a doc_id the least stands under it, and the others are documents of their own, which
come after all doc_ids; equal rows have one fate. Null doc_ids take no part. Null and empty texts have no passage. Other columns pass through.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .batches import small_batches, trimmed
from .scratch import Scratch

K, WINDOW, DENSE, GAP, SLACK, SIMILAR, LEAST, BLOCK = 5, 16, 2, 0.04, 32, 0.8, 50, 64
#: Words between the ends of a chain (fewer are not aligned, as chance makes them), of one alignment, and by which places in the other text can shift.
SPAN, PIECE, SHIFT = 10, 1024, 8
#: What a word without its equal takes from a stretch, to which an equal word adds 1, and the fall from its height at which a stretch ends.
MISS, FALL = 1.0, 12.0
#: Part of the documents that shows which seeds are frequent, share of its rows that makes a seed so, and ranges of documents of such a seed.
SAMPLE, FREQUENT, RANGES = 64, 10_000, 64
#: Occurrences of short seeds in a bucket, fewest buckets, occurrences that a task holds before it deals them out, and characters of text for one of them.
BUCKET, BUCKETS, HELD, PER_SEED = 1 << 17, 1024, 1 << 21, 11
#: Kinds of seeds: short ones, middles of long ones, and windows of more than `least` words.
SHORT, MIDDLE, LONG = 0, 1, 2
U = np.uint64
TOP = U(0xFFFFFFFFFFFFFFFF)


def minimizers(s: np.ndarray, rows: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of the hashes are the least of some window of `window` hashes of their row (at its ends of fewer)."""
    pad = window - 1
    at = np.arange(len(s)) + (rows + 1) * pad
    wide = np.full(len(s) + (n + 1) * pad, TOP, dtype=np.uint64)
    wide[at] = s
    low, size = wide, 1
    while size < window:
        step = min(size, window - size)
        low = np.minimum(low, np.concatenate([low[step:], np.full(step, TOP, dtype=np.uint64)]))
        size += step
    high, size = low, 1
    while size < window:
        step = min(size, window - size)
        high = np.maximum(high, np.concatenate([np.zeros(step, dtype=np.uint64), high[:-step]]))
        size += step
    # `high` sees windows that begin before the row as well; those hold its first hashes only
    return high[at] == s


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Chunks of rows (doc, text, ..): batch, first row and row after the last, word hashes, row of each word, words of each row."""
    for batch in batches:
        data, offsets = words.utf8(batch.column(1))
        for lo, hi in words.chunks(offsets):
            part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            starts, ends, rows = words.bounds(part, at)
            yield batch, lo, hi, words.hashes(part, starts, ends), rows, np.bincount(rows, minlength=hi - lo)


def _of_k(h: np.ndarray, rows: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of k words of the rows that have as many."""
    counts = np.where(counts >= k, counts, 0)
    whole = counts[rows] > 0
    return words.shingles(h[whole], rows[whole], counts, k)


def _seeded(k: int, window: int, least: int, hot: np.ndarray | None = None, middles: bool = True):
    """(doc, text) -> (seed, doc, pos, kind): short seeds (those of the sorted `hot`, if given) and, if asked, middles of long ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lo, hi, h, rows, counts in _texts(batches):
            s, r, p = _of_k(h, rows, counts, k)
            keep = minimizers(s, r, hi - lo, window) | (s < TOP // U(DENSE))
            s, r, p = s[keep], r[keep], p[keep]
            order = np.lexsort((p, s, r))
            s, r, p = s[order], r[order], p[order]
            first = np.concatenate([[True], (s[1:] != s[:-1]) | (r[1:] != r[:-1])]) if len(s) else np.zeros(0, bool)
            again = np.flatnonzero(~first)
            number = again - np.flatnonzero(first)[np.cumsum(first)[again] - 1]
            with np.errstate(over="ignore"):
                counted = words.mix(s[again] + number.astype(np.uint64) * U(0x9E3779B97F4A7C15))
            s, r, p = np.concatenate([s, counted]), np.concatenate([r, r[again]]), np.concatenate([p, p[again]])
            if hot is not None:
                keep = np.zeros(len(s), bool)
                if len(hot):
                    keep = hot[np.minimum(np.searchsorted(hot, s.view(np.int64)), len(hot) - 1)] == s.view(np.int64)
                s, r, p = s[keep], r[keep], p[keep]
            kind = np.full(len(s), SHORT, np.int8)
            if middles:
                s2, r2, p2 = _of_k(h, rows, counts, max(least + 2 - window, 1))
                keep = minimizers(s2, r2, hi - lo, min(window, least + 1)) & (counts[r2] > least)
                s, r, p = np.concatenate([s, s2[keep]]), np.concatenate([r, r2[keep]]), np.concatenate([p, p2[keep]])
                kind = np.concatenate([kind, np.full(int(keep.sum()), MIDDLE, np.int8)])
            ids = batch.column(0).to_numpy()[lo:hi]
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(ids[r]), pa.array(p.astype(np.int32)), pa.array(kind)], ["seed", "doc", "pos", "kind"])

    return run


def _windows(window: int, least: int):
    """(doc, text, places of shared middles) -> (seed, doc, pos, kind): all windows of least + 1 words that hold one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lo, hi, h, rows, counts in _texts(batches):
            s, r, p = _of_k(h, rows, counts, least + 1)
            base = np.concatenate([[0], np.cumsum(counts)])
            wanted = np.zeros(len(h) + window + 1, dtype=np.int32)
            for i, places in enumerate(batch.column(2).slice(lo, hi - lo)):
                at = np.asarray(places.values)
                np.add.at(wanted, base[i] + np.maximum(at - window + 1, 0), 1)
                np.add.at(wanted, base[i] + at + 1, -1)
            keep = np.cumsum(wanted)[base[r] + p] > 0
            s, r, p = s[keep], r[keep], p[keep]
            ids = batch.column(0).to_numpy()[lo:hi]
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(ids[r]), pa.array(p.astype(np.int32)), pa.array(np.full(len(s), LONG, np.int8))], ["seed", "doc", "pos", "kind"])

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (seed, doc, at) sorted by all three -> (doc, other, xy, seed): each occurrence that is no ghost with the first ones of its seed in the
    earliest text and in the last one before its own. at: place * 8 + kind * 2 + ghost; xy: both places and the kind (see places_of)."""
    held = None  # the seed; doc and place of its first occurrence, of that in the last doc, and in the doc before that one
    for batch in batches:
        if not batch.num_rows:
            continue
        s, d, p = (batch.column(i).to_numpy() for i in range(3))
        if held is not None:  # what is known of the seed so far, as rows before the batch
            s, d, p = np.concatenate([np.full(3, held[0]), s]), np.concatenate([held[1], d]), np.concatenate([held[2], p])
        new = np.concatenate([[True], s[1:] != s[:-1]])
        text = new | np.concatenate([[True], d[1:] != d[:-1]])
        number = np.arange(len(s))
        first, own = (np.maximum.accumulate(np.where(m, number, 0)) for m in (new, text))
        last = np.where(new[own], own, np.concatenate([[0], own[:-1]])[own])
        own_only = (number >= (3 if held is not None else 0)) & (p & 1 == 0)
        z = len(s) - 1
        out = []
        for partner in (first, last):
            hit = np.flatnonzero(own_only & (d != d[partner]) & ((partner != first) | (partner is first)))
            to = partner[hit]
            out.append((d[hit], d[to], (p[hit] >> 3 << 34) + (p[to] >> 3 << 2) + (p[hit] >> 1 & 3), s[hit]))
        back = [first[z], last[z], own[z]]
        held = (s[z], d[back], p[back])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["doc", "other", "xy", "seed"])


def places_of(xy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in the text, place in the other, and kind."""
    return xy >> 34, xy >> 2 & 0xFFFFFFFF, xy & 3


def _packed(seed: np.ndarray, doc: np.ndarray, at: np.ndarray, buckets: int) -> pa.RecordBatch:
    """(bucket, seeds, docs, ats): the rows (seed, doc, at) in one row for each bucket, as bytes."""
    of = (words.mix(seed.view(U)) >> U(32)).astype(np.int64) % buckets
    order = np.argsort(of, kind="stable")
    of = of[order]
    cuts = np.flatnonzero(np.diff(of, prepend=-1))
    ends = np.append(cuts[1:], len(of))
    at = at.astype(np.int32 if not len(at) or at.max() < 1 << 31 else np.int64)
    parts = [[v[a:z].tobytes() for a, z in zip(cuts, ends, strict=True)] for v in (seed[order], doc[order], at[order])]
    return pa.RecordBatch.from_arrays([pa.array(of[cuts].astype(np.int32)), *(pa.array(v, pa.binary()) for v in parts)], ["bucket", "seeds", "docs", "ats"])


PACKED = "bucket int, seeds binary, docs binary, ats binary"


def _dealt(seeded, hot: np.ndarray, ranges: np.ndarray, buckets: int):
    """(doc, text) -> packed rows of the short seeds that `seeded` makes; those in `hot` (sorted) carry the number of their range of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in seeded(batches):
            s, d, p, kind = (batch.column(i).to_numpy() for i in range(4))
            if len(hot) and len(s):
                often = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s
                s = np.where(often, s & np.int64(-RANGES) | np.searchsorted(ranges, d), s)
            held.append((s, d, p.astype(np.int64) * 8 + kind * 2))
            size += len(s)
            if size > HELD:
                yield _packed(*(np.concatenate(v) for v in zip(*held, strict=True)), buckets)
                held, size = [], 0
        if size:
            yield _packed(*(np.concatenate(v) for v in zip(*held, strict=True)), buckets)

    return run


def _ghosts_packed(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _packed(*(batch.column(i).to_numpy() for i in range(3)), buckets)

    return run


def _met_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_met of packed rows sorted by bucket, without the seed."""
    for group in words.groups(batches, 1):
        seeds, docs, ats = (group.column(i).to_pylist() for i in (1, 2, 3))
        s = np.frombuffer(b"".join(seeds), np.int64)
        order = np.argsort(s)
        same = s[order][1:] == s[order][:-1]
        order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]  # a seed that stands once meets none
        d = np.frombuffer(b"".join(docs), np.int64)[order]
        at = np.concatenate([np.frombuffer(a, np.int32 if len(a) * 2 == len(x) else np.int64) for a, x in zip(ats, seeds, strict=True)])[order].astype(np.int64)
        s = s[order]
        order = np.lexsort((at, d, s))
        for batch in _met(iter([pa.RecordBatch.from_arrays([pa.array(v[order]) for v in (s, d, at)], ["seed", "doc", "at"])])):
            yield batch.select(["doc", "other", "xy"])


def short_partners(text: DataFrame, seeded, often: DataFrame, hot: np.ndarray, ranges: list[int], scratch: Scratch) -> DataFrame:
    """(doc, other, xy) for the short seeds of the texts: what `partners` finds for them. often: the occurrences of the seeds hot."""
    bounds = sorted(set(ranges))
    size = text.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(BUCKETS, size // (PER_SEED * BUCKET))
    rows = text.select("doc", "text").mapInArrow(trimmed(_dealt(seeded, hot, np.array(bounds, dtype=np.int64), buckets)), PACKED)
    if len(hot):
        rows = rows.unionAll(ghosts_of(often, part_of(bounds), scratch).mapInArrow(trimmed(_ghosts_packed(buckets)), PACKED))
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(trimmed(_met_packed), "doc long, other long, xy long")


def part_of(ranges: list[int]) -> Column:
    """The number of the range of a document."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in sorted(set(ranges))]).cast("array<long>"), lambda b: b < F.col("doc"))) if ranges else F.lit(0)


def _named() -> Column:
    return (F.col("seed").bitwiseAND(F.lit(-RANGES))).bitwiseOR(F.col("part").cast("long"))


def ghosts_of(often: DataFrame, part: Column, scratch: Scratch) -> DataFrame:
    """(seed, doc, at): for each range of documents of a frequent seed its first occurrence, and the last one before the range."""
    sums = often.withColumn("part", part).groupBy("seed", "part").agg(F.min(F.struct("doc", "pos")).alias("low"), F.max(F.struct("doc", (-F.col("pos")).alias("pos"))).alias("high"))
    sums = scratch.cut(sums.select("seed", "part", "low", F.struct(F.col("high.doc").alias("doc"), (-F.col("high.pos")).alias("pos")).alias("high")))
    by = Window.partitionBy("seed").orderBy("part")  # RANGES rows at most
    known = sums.select("seed", "part", F.first("low").over(by).alias("low"), F.lag("high").over(by).alias("high")).filter("high is not null")
    found = known.withColumn("g", F.explode(F.array_distinct(F.array("low", "high")))).select(_named().alias("seed"), F.col("g.doc").alias("doc"), F.col("g.pos").alias("pos"))
    return found.select("seed", "doc", (F.col("pos").cast("long") * 8 + 1).alias("at"))


def partners(seeds: DataFrame, often: DataFrame, frequent: DataFrame, ranges: list[int] | None, scratch: Scratch) -> DataFrame:
    """(doc, other, xy, seed) for the occurrences (seed, doc, pos, kind). often: those of the seeds frequent (hot), of which there are FREQUENT at
    most; they are dealt by ranges of documents too: up to a bound of `ranges` (or of quantiles), and beyond the one before. The number of the
    range takes the place of the lowest bits of such a seed."""
    if ranges is None:
        ranges = often.agg(F.percentile_approx("doc", [i / RANGES for i in range(1, RANGES)], 1000)).first()[0] or []
    part = part_of(ranges)
    dealt = seeds.join(frequent, F.col("seed") == F.col("hot"), "left").withColumn("part", F.when(F.col("hot").isNotNull(), part).otherwise(0))
    at = F.col("pos").cast("long") * 8 + F.col("kind") * 2
    rows = dealt.select(F.when(F.col("hot").isNotNull(), _named()).otherwise(F.col("seed")).alias("seed"), "doc", at.alias("at"))
    return rows.unionAll(ghosts_of(often, part, scratch)).repartition("seed").sortWithinPartitions("seed", "doc", "at").mapInArrow(trimmed(_met), "doc long, other long, xy long, seed long")


def diagonals(x: np.ndarray, y: np.ndarray, k: int, reach: int) -> np.ndarray:
    """Segments (x0, x1, y0, y1, words) of anchors on one diagonal that follow within `reach` words; ends are exclusive."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    d, step = x - y, x[1:] - x[:-1]
    a = np.flatnonzero((d[1:] != d[:-1]) | (step > reach)) + 1
    a, b = np.append(0, a), np.append(a - 1, len(x) - 1)
    gains = np.append(k, np.minimum(step, k))
    gains[a] = k
    out = np.empty((len(a), 5), dtype=np.int64)
    out[:, 0], out[:, 1], out[:, 2], out[:, 3], out[:, 4] = x[a], x[b] + k, y[a], y[b] + k, np.add.reduceat(gains, a)
    return out


class Fenwick:
    """Largest (value, item) of a prefix."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(-np.inf, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def top(self, i: int) -> tuple[float, int]:
        """Of the items below i."""
        out = (-np.inf, -1)
        while i:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def chains(segments: np.ndarray, gap: float) -> list[list[int]]:
    """Collinear chains of segments, the best first; each segment is in one chain.

    A segment continues the chain of the best score that ends before it in both texts, if that is worth the gap.
    """
    n = len(segments)
    if n == 1:
        return [[0]]
    x0, x1, y0, y1, gain = segments.T.tolist()
    ys = sorted({*y1})
    place = {v: i for i, v in enumerate(ys)}
    tree, score, back = Fenwick(len(ys)), [0.0] * n, [-1] * n
    ending = sorted(range(n), key=lambda i: x1[i])
    done = 0
    starts = np.searchsorted(ys, y0, "right").tolist()
    for i in sorted(range(n), key=lambda i: (x0[i], y0[i])):
        while done < n and x1[ending[done]] <= x0[i]:
            j = ending[done]
            tree.put(place[y1[j]], (score[j] + gap * (x1[j] + y1[j]), j))
            done += 1
        value, j = tree.top(starts[i])
        more = value - gap * (x0[i] + y0[i])
        score[i], back[i] = gain[i] + max(0.0, more), j if more > 0 else -1
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def pieces(chain: np.ndarray, most: int = PIECE) -> list[tuple[int, int, int, int]]:
    """The segments of a chain put together to pieces (x0, x1, y0, y1) of about `most` words, longer ones cut."""
    out: list[list[int]] = []
    for x0, x1, y0, y1, _ in chain.tolist():
        for x in range(x0, x1, most):
            z = min(x + most, x1)
            if out and z - out[-1][0] <= most and y0 + z - x0 - out[-1][2] <= 2 * most:
                out[-1][1], out[-1][3] = z, y0 + z - x0
            else:
                out.append([x, z, y0 + x - x0, y0 + z - x0])
    return [tuple(p) for p in out]


def runs(other: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> list[tuple[int, int, int, int, int]]:
    """(other, x0, x1, y0, y1) of the equal stretches made of equal windows of n words."""
    if not len(x):
        return []
    order = np.lexsort((x, x - y, other))
    other, x, y = other[order], x[order], y[order]
    new = np.concatenate([[True], (other[1:] != other[:-1]) | (np.diff(x - y) != 0) | (np.diff(x) > n)])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(x)) - 1
    return list(zip(other[a].tolist(), x[a].tolist(), (x[b] + n).tolist(), y[a].tolist(), (y[b] + n).tolist(), strict=True))


def _unresolved(n: int, least: int):
    """Rows (doc, other, xy, seed) of equal middles of n words, sorted by doc -> (open): seeds in no run of more than `least` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in words.groups(batches, 1):
            other, seed = group.column(1).to_numpy(), group.column(3).to_numpy()
            x, y, _ = places_of(group.column(2).to_numpy())
            held = np.zeros(int(x.max()) + 2, dtype=np.int64)
            for _, x0, x1, _, _ in runs(other, x, y, n):
                if x1 - x0 > least:
                    held[x0] += 1
                    held[x1 - n + 1] -= 1
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(seed[np.cumsum(held)[x] == 0]))], ["open"])

    return run


def _chained(k: int, window: int, gap: float, span: int, least: int):
    """Rows (doc, other, xy) sorted by doc -> (doc, other, x0, x1, y0, y1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in words.groups(batches, 1):
            other = group.column(1).to_numpy()
            x, y, kind = places_of(group.column(2).to_numpy())
            wide, covered = kind != SHORT, None
            known = [r for n, of in ((max(least + 2 - window, 1), MIDDLE), (least + 1, LONG)) for r in runs(other[kind == of], x[kind == of], y[kind == of], n) if r[2] - r[1] > least]
            if len(known):  # the anchors of runs are seen at their ends and between; words of the text that runs cover
                at = [(o, x0 + d, y0 + d) for o, x0, x1, y0, _ in known for d in {*range(0, x1 - x0 - k, window), x1 - x0 - k}]
                other, x, y = (np.concatenate([v[~wide], w]) for v, w in zip((other, x, y), np.array(at).T, strict=True))
                covered = np.zeros(int(x.max()) + k + 1, dtype=np.int64)
                for _, x0, x1, _, _ in known:
                    covered[x0:x1] = 1
                covered = np.concatenate([[0], np.cumsum(covered)])
            else:
                other, x, y = other[~wide], x[~wide], y[~wide]
            order = np.argsort(other, kind="stable")
            other, x, y = other[order], x[order], y[order]
            found = [(o, x0, x1, -1, -1) for o, x0, x1, _, _ in known]
            for o, x0, x1, y0, y1 in known:  # a run may go on, word for word or fuzzily, beyond an end at which no other run does
                if not x0 or covered[x0] == covered[x0 - 1]:
                    found.append((o, x0, x0 + window, y0, y0 + window))
                if x1 + 1 >= len(covered) or covered[x1 + 1] == covered[x1]:
                    found.append((o, x1 - window, x1, y1 - window, y1))
            cuts = np.flatnonzero(np.concatenate([[True], other[1:] != other[:-1]])) if len(other) else np.zeros(0, np.int64)
            ends = np.append(cuts[1:], len(other))
            wide = cuts
            if len(other):  # nor are those all of whose words are in runs
                low, high = np.minimum.reduceat(x, cuts), np.maximum.reduceat(x, cuts) + k
                wide = np.flatnonzero((high - low >= span) & (covered is None or covered[high] - covered[low] < high - low))
            for a, b in zip(cuts[wide].tolist(), ends[wide].tolist(), strict=True):
                segments = diagonals(x[a:b], y[a:b], k, 2 * window)
                for chain in chains(segments, gap):
                    lo, hi = segments[chain[0], 0], segments[chain[-1], 1]
                    if hi - lo >= span and (covered is None or covered[hi] - covered[lo] < hi - lo):
                        found += [(other[a], *piece) for piece in pieces(segments[chain])]
            if found:
                of, *places = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), group.column(0)[0].as_py())), pa.array(of), *(pa.array(v.astype(np.int32)) for v in places)], ["doc", "other", "x0", "x1", "y0", "y1"])

    return run


def _blocks(size: int):
    """(doc, text) -> (src, block, body): the words of a text in blocks, joined by one space, A-Z in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = text.encode().lower().split()
                for b in range(0, len(w), size):
                    for to, v in zip(out, (doc, b // size, b" ".join(w[b : b + size])), strict=True):
                        to.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], ["src", "block", "body"])

    return run


def common(a: list, b: list) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & where.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, bit-parallel, the rows kept to find the way back."""
    where: dict = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows, v = [full], full
    for of in map(where.get, b):
        if of is not None and (u := v & of):
            v = ((v + u) | (v - u)) & full
        rows.append(v)
    # a zero bit i in row j: word i of a adds one to what the words of a up to it share with the first j of b
    out, i, j = [], len(a) - 1, len(b)
    while i >= 0 and j:
        if rows[j] >> i & 1:
            i -= 1
        elif rows[j - 1] >> i & 1:
            j -= 1
            out.append((i, j))
            i -= 1
        else:
            j -= 1
    return out[::-1]


def stretches(pairs: list[tuple[int, int]], similar: float) -> list[tuple[int, int, int, int, float]]:
    """(p0, p1, q0, q1, similarity) of the stretches of an alignment that are dense in equal words and as similar as asked."""
    if not pairs:
        return []
    places = np.array(pairs)
    steps = np.diff(places, axis=0).max(axis=1) if len(pairs) > 1 else np.zeros(0, np.int64)
    gaps = np.flatnonzero(steps > 1)
    runs, start, best, score, high, at = [], 0, 0, 1.0, 1.0, 0
    for last, fall in zip([*gaps.tolist(), len(pairs) - 1], [*(MISS * (steps[gaps] - 1)).tolist(), np.inf], strict=True):
        score += last - at  # words that follow one another in both texts
        if score >= high:
            best, high = last, score
        at = last + 1
        if score - fall < max(0.0, high - FALL):
            runs.append((start, best))
            start, best, score, high = at, at, 1.0, 1.0
        else:
            score += 1 - fall
            if score >= high:
                best, high = at, score
    out = []
    for lo, hi in runs:
        x, y = places[lo : hi + 1].T
        n = hi + 1 - lo
        alike = n / max(x[-1] - x[0] + 1, y[-1] - y[0] + 1)
        i, j = 0, n - 1
        if alike < similar:
            # matches less similar * words, from each first to each last match; the longest part where it is not below 0
            m = np.arange(n)
            width = np.maximum(x[None, :] - x[:, None], y[None, :] - y[:, None]) + 1
            length = np.where((m[None, :] - m[:, None] + 1 >= similar * width) & (m[None, :] >= m[:, None]), width, 0)
            i, j = divmod(int(length.argmax()), n)
            alike = (j - i + 1) / width[i, j]
        out.append((int(x[i]), int(x[j]) + 1, int(y[i]), int(y[j]) + 1, float(alike)))
    return out


def repeats(text: str, found: list[tuple], least: int, similar: float, slack: int, block: int) -> list[tuple[int, int, int, float]]:
    """Passages (first word, word after the last, other document, similarity) of a text, from chains (other, x0, x1, y0, y1,
    blocks of the other text's words)."""
    w = text.encode().lower().split()
    spans = []
    for other, x0, x1, y0, y1, blocks in found:
        if y0 < 0:  # a run of equal windows
            spans.append((x0, x1, other, 1.0))
            continue
        blocks = sorted(blocks)
        b = b" ".join(body for _, body in blocks).split()
        base = blocks[0][0] * block if blocks else 0
        if any(o == other and a < x0 and x1 < z for a, z, o, _ in spans):
            continue
        lo, low = max(x0 - slack, 0), max(y0 - base - slack - SHIFT, 0)
        one, two = w[lo : x1 + slack], b[low : max(y1 - base, 0) + slack + SHIFT]
        for p0, p1, q0, q1, alike in stretches(aligned(one, two), similar):
            while p0 and q0 and one[p0 - 1] == two[q0 - 1]:
                p0, q0 = p0 - 1, q0 - 1
            while p1 < len(one) and q1 < len(two) and one[p1] == two[q1]:
                p1, q1 = p1 + 1, q1 + 1
            spans.append((lo + p0, lo + p1, other, alike))
    # what touches is one passage if it is of one other text; only then lengths count
    own = [s for other in sorted({s[2] for s in spans}) for s in united([s for s in spans if s[2] == other]) if s[1] - s[0] > least]
    return united(own)


def united(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Spans (first word, word after the last, other document, similarity) that overlap or touch as one, of the first's document."""
    out: list[list] = []
    for a, z, other, alike in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if out and a <= out[-1][1]:
            if z > out[-1][1]:
                out[-1][3] = min(out[-1][3], alike)
                out[-1][1] = z
        else:
            out.append([a, z, other, alike])
    return [tuple(s) for s in out]


def without(text: str, spans: list[tuple]) -> str:
    """The text without the words of the spans, and without the gap after each."""
    if not spans:
        return text
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, _, _ = words.bounds(data, np.array([0, len(raw)], dtype=np.int64))
    starts = [*starts.tolist(), len(raw)]
    out, at = [], 0
    for a, z, *_ in spans:
        out.append(raw[at : starts[a]])
        at = starts[z]
    return b"".join([*out, raw[at:]]).decode()


def counted_partners(seeds: DataFrame, scratch: Scratch) -> DataFrame:
    """partners of written occurrences (seed, doc, pos, kind); seeds of over 1/FREQUENT of the rows are frequent."""
    many = max(4096, seeds.count() // FREQUENT + 1)
    frequent = scratch.cut(seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= many).select(F.col("seed").alias("hot")))
    hot = [r["hot"] for r in frequent.collect()]  # FREQUENT at most
    often, frequent = scratch.cut(seeds.filter(F.col("seed").isin(hot) if hot else F.lit(False))), F.broadcast(frequent)
    return partners(seeds, often, frequent, None, scratch)


def find_chains(docs: DataFrame, scratch: Scratch, *, k: int = K, window: int = WINDOW, gap: float = GAP, least: int = LEAST, slack: int = SLACK, block: int = BLOCK) -> DataFrame:
    """(of, chains): for each doc of the rows (doc, text) with chains, its chains with the words of the other texts."""
    small_batches(docs.sparkSession)
    text = docs.select("doc", "text").filter("doc is not null and text is not null")
    kinds = "seed long, doc long, pos int, kind byte"
    seeded = lambda rows, **which: rows.mapInArrow(trimmed(_seeded(k, window, least, **which)), kinds)
    # seeds that are frequent in a part of the documents, FREQUENT at most, and ranges of their documents
    part = text.filter(F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0)
    few = scratch.cut(seeded(part, middles=False).groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    least_n = max(64, (few.agg(F.sum("n")).first()[0] or 0) // FREQUENT + 1)
    few = few.filter(F.col("n") >= least_n)
    # middles that stand in two documents, and the occurrences of frequent seeds
    hot = np.array(sorted(r[0] for r in few.select("seed").collect()), dtype=np.int64)  # FREQUENT at most, as each has that share of the rows
    ranges = (seeded(part, hot=hot, middles=False).agg(F.percentile_approx("doc", [i / RANGES for i in range(1, RANGES)], 1000)).first()[0] if len(hot) else None) or []
    first = scratch.cut(seeded(text, hot=hot))
    # written before anything else is made, so that the shuffle of the seeds, the largest of all, ends here
    short = scratch.cut(short_partners(text, _seeded(k, window, least, middles=False), first.filter(F.col("kind") == SHORT), hot, ranges, scratch))
    middles = first.filter(F.col("kind") == MIDDLE)
    shared = scratch.cut(middles.groupBy("seed").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b").select(F.col("seed").alias("held")))
    middles = scratch.cut(middles.join(shared, F.col("seed") == F.col("held"), "left_semi"))
    scratch.drop(first)
    met = scratch.cut(counted_partners(middles, scratch))
    size = max(least + 2 - window, 1)
    open_ = met.repartition("doc").sortWithinPartitions("doc").select("doc", "other", "xy", "seed").mapInArrow(trimmed(_unresolved(size, least)), "open long").distinct()
    upper = lambda c: F.col(c).bitwiseAND(F.lit(-RANGES))  # noqa: E731  without the number of a range
    places = middles.join(scratch.cut(open_), upper("seed") == upper("open"), "left_semi").groupBy(F.col("doc").alias("in")).agg(F.sort_array(F.collect_set("pos")).alias("at"))
    windows = scratch.cut(text.join(scratch.cut(places), F.col("doc") == F.col("in")).select("doc", "text", "at").mapInArrow(trimmed(_windows(window, least)), kinds))
    anchors = short.unionAll(met.drop("seed")).unionAll(counted_partners(windows, scratch).drop("seed"))
    found = scratch.cut(anchors.repartition("doc").sortWithinPartitions("doc").mapInArrow(trimmed(_chained(k, window, gap, SPAN, least)), "doc long, other long, x0 int, x1 int, y0 int, y1 int"))
    scratch.drop(short, middles, met, windows)  # only what is found is read from here on
    sources = scratch.cut(found.filter("y0 >= 0").select("other").distinct())
    pieces = text.join(sources, F.col("doc") == F.col("other"), "left_semi").select("doc", "text").mapInArrow(trimmed(_blocks(block)), "src long, block int, body binary")
    needs = found.filter("y0 >= 0").withColumn("need", F.explode(F.sequence(F.expr(f"greatest(y0 - {slack + SHIFT}, 0) div {block}").cast("int"), F.expr(f"(y1 + {slack + SHIFT}) div {block}").cast("int"))))
    pieces = scratch.cut(pieces)
    met = needs.join(pieces, (F.col("other") == F.col("src")) & (F.col("need") == F.col("block")))
    of_chain = met.groupBy("doc", "other", "x0", "x1", "y0", "y1").agg(F.collect_list(F.struct("block", "body")).alias("blocks"))
    of_chain = of_chain.unionAll(found.filter("y0 < 0").withColumn("blocks", F.array().cast("array<struct<block:int,body:binary>>")))
    out = scratch.cut(of_chain.groupBy(F.col("doc").alias("of")).agg(F.collect_list(F.struct("other", "x0", "x1", "y0", "y1", "blocks")).alias("chains")))
    scratch.drop(found, pieces)
    return out


def numbered(docs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """docs with a column `name`: doc_id, and for texts that share one, beyond the least of them, a number above all doc_ids."""
    doc, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rows = docs.select(doc.alias("doc"), text.alias("text")).filter("doc is not null and text is not null")
    many = scratch.cut(rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc").alias("many")))
    if many.isEmpty():
        return docs.withColumn(name, doc)
    marks = lambda d, t: [F.xxhash64(d, t), F.xxhash64(t, d)]
    texts = rows.join(many, F.col("doc") == F.col("many"), "left_semi").groupBy(F.col("doc").alias(name + "d"), *(m.alias(f"{name}{i}") for i, m in enumerate(marks("doc", "text")))).agg(F.min(F.substring("text", 1, 64)).alias("head"))
    late = F.pmod(F.col(name + "0"), F.lit(1 << 61)) + F.lit(1 << 62)
    first = F.row_number().over(Window.partitionBy(name + "d").orderBy("head", name + "0")) == 1
    texts = scratch.keep(texts.withColumn(name + "n", F.when(~first, late)).filter(f"{name}n is not null").drop("head"))
    same = (doc == F.col(name + "d")) & (marks(doc, text)[0] == F.col(name + "0")) & (marks(doc, text)[1] == F.col(name + "1"))
    return docs.join(texts, same, "left").withColumn(name, F.coalesce(F.col(name + "n"), doc)).select(*[F.col(f"`{c}`") for c in docs.columns], name)


def unused(docs: DataFrame, name: str) -> str:
    """A name that no column of docs begins with."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def _chains(column: pa.Array) -> Iterator[list[tuple]]:
    """For each row the chains (other, x0, x1, y0, y1, blocks) of a column of lists, in order."""
    chains = column.flatten()
    blocks = chains.field("blocks").flatten()
    pairs = list(zip(blocks.field("block").to_pylist(), blocks.field("body").to_pylist(), strict=True))
    sizes = chains.field("blocks").value_lengths().to_pylist()
    ends = np.cumsum([0, *sizes]).tolist()
    rows = list(zip(*(chains.field(c).to_pylist() for c in ("other", "x0", "x1", "y0", "y1")), (pairs[a:z] for a, z in zip(ends, ends[1:], strict=False)), strict=True))
    at = 0
    for n in column.value_lengths().fill_null(0).to_pylist():
        yield sorted(rows[at : at + n])
        at += n


def _found(base: DataFrame, number: str, scratch: Scratch, least: int, similar: float, slack: int, block: int, **seeding) -> DataFrame:
    """(number, first_word, end_word, n_words, other, similarity), a kept table: the passages that the rows (number, text) repeat from earlier ones."""
    rows = base.select(F.col(number).alias("doc"), F.col("text").cast("string").alias("text"))
    chains = find_chains(rows, scratch, least=least, slack=slack, block=block, **seeding)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        for batch in batches:
            rows = [(doc, a, z, z - a, other, alike) for doc, text, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _chains(batch.column(2)), strict=True) if text for a, z, other, alike in repeats(text, c, least, similar, slack, block)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["number", "first_word", "end_word", "n_words", "other", "similarity"])

    # rows that are equal have one number and the same passages
    met = rows.join(chains, F.col("doc") == F.col("of")).select("doc", "text", "chains")
    return scratch.keep(met.mapInArrow(trimmed(run), "number long, first_word long, end_word long, n_words long, other long, similarity double"))


def repeated_passages(docs: DataFrame, *, least: int = LEAST, similar: float = SIMILAR, slack: int = SLACK, block: int = BLOCK, **seeding) -> DataFrame:
    """(doc_id, first_word, end_word, n_words, other_id, similarity): the passages that a document repeats from earlier ones."""
    with Scratch(docs.sparkSession) as scratch:
        rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), scratch, "doc")
        spans = _found(rows, "doc", scratch, least, similar, slack, block, **seeding)
        late = scratch.keep(rows.filter("doc != doc_id").select("doc", F.col("doc_id").alias("owner")).distinct())
    first, second = (late.select(F.col("doc").alias(f"d{i}"), F.col("owner").alias(f"o{i}")) for i in (1, 2))
    out = spans.join(first, F.col("number") == F.col("d1"), "left").join(second, F.col("other") == F.col("d2"), "left")
    return out.select(F.coalesce("o1", "number").alias("doc_id"), "first_word", "end_word", "n_words", F.coalesce("o2", "other").alias("other_id"), "similarity")


def drop_repeats(docs: DataFrame, *, least: int = LEAST, similar: float = SIMILAR, slack: int = SLACK, block: int = BLOCK, **seeding) -> DataFrame:
    """docs, in all their columns, with the repeated passages cut out of text."""
    own = unused(docs, "__passages")
    with Scratch(docs.sparkSession) as scratch:
        rows = numbered(docs, scratch, own)
        spans = _found(rows, own, scratch, least, similar, slack, block, **seeding)
    cuts = spans.groupBy(F.col("number").alias(own + "of")).agg(F.sort_array(F.collect_set(F.struct("first_word", "end_word"))).alias(own + "cuts"))
    at = docs.columns.index("text")
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(width)
            texts = batch.column(at)
            if held.null_count < len(held):
                new = texts.to_pylist()
                for i in np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False)).tolist():
                    new[i] = without(new[i], [(c["first_word"], c["end_word"]) for c in held[i].as_py()]) if new[i] else new[i]
                texts = pa.array(new, texts.type)
            columns = [batch.column(c) for c in range(width)]
            columns[at] = texts
            yield pa.RecordBatch.from_arrays(columns, names=list(batch.schema.names[:width]))

    met = rows.join(cuts, F.col(own) == F.col(own + "of"), "left").select(*[F.col(f"`{c}`") for c in docs.columns], own + "cuts")
    return met.mapInArrow(trimmed(run), docs.schema)
