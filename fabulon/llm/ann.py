"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are dealt into shards of bounded size by a hash of vec_id; each shard has its own index, so that recall does not depend
on the number of vectors, and a shard is all that a task holds. The rows of a shard are split by norm into bands (norms within RATIO of
each other, but BAND rows at least), and each band is indexed: the largest inner product becomes the smallest distance when a row x gets one
more component, sqrt(M^2 - |x|^2) with M the largest norm of the band, and a query gets 0 and the norm M. A table of the index hashes a
vector by `k` projections on normal (2-stable) directions, cut into cells of width `width` times M.

A query first visits in each table FIRST buckets in the order of the expected sums of squared distances to the cells' walls: its own bucket, then
sets of perturbed cells. The distance r of the last of the best `top` so found gives every bucket's probability to hold a vector at r,
the product over the projections of a normal law's mass in the cell. The buckets of all tables are visited in falling order of it
until such a vector is missed by all tables with probability MISS at most. So few buckets are visited where neighbours are near, and
many where nothing is near; there is no fixed number of candidates. If all `probes` buckets of all tables do not reach MISS the band
is compared whole. What the tables find is merged and ranked exactly, by inner products in double precision on the vectors
as given; the best of all shards are merged.

A query goes from the band of the largest norms to the smallest, and leaves out a band only if no inner product there can reach the best
`top` that it has (|q| M bounds them).

The queries meet every shard in blocks of bounded size: rows between tasks are queries times shards, never candidates. The index is
built once for each block of QUERY_BLOCK queries, which costs about a hundredth of what they then take.

Vectors that are null, empty, zero or hold null or non-finite components neither ask nor answer. Only vectors of one length are
compared. Rows that repeat a vec_id count once (the least vector by array order). Ties go to the smaller vec_id. A null vec_id
takes no part. Other columns are not read. Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import trimmed
from .scratch import Scratch
from .vectors import matrix, usable
from .words import groups

SHARD, QUERY_BLOCK, TABLES, K, WIDTH, PROBES = 16384, 4096, 32, 16, 2.5, 2048
#: Buckets of a table that give a query its first neighbours, and the probability to miss a neighbour at which it has visited enough.
FIRST, MISS = 32, 0.18
#: Rows of a band at least, and its largest norm to the smallest.
BAND, RATIO = 1024, 1.1
#: Levels of probability, each a quarter of a power of e.
LEVELS = 160


@lru_cache(maxsize=8)
def perturbations(k: int, probes: int) -> np.ndarray:
    """The first `probes` sets of perturbations, in order of their expected squared distance to the walls.

    Of the 2k distances to walls in rising order, the j-th and the (2k + 1 - j)-th belong to one projection and exclude each other.
    A row marks the ranks of one set; the first is the empty set.
    """
    j = np.arange(1, 2 * k + 1)
    cost = np.where(j <= k, j * (j + 1) / (4 * (k + 1) * (k + 2)), 1 - (2 * k + 1 - j) / (k + 1) + (2 * k + 1 - j) * (2 * k + 2 - j) / (4 * (k + 1) * (k + 2)))
    out, heap = [()], [(cost[0], (0,))]
    while heap and len(out) < probes:
        c, s = heapq.heappop(heap)
        if not any(2 * k - 1 - x in s for x in s):
            out.append(s)
        if s[-1] + 1 < 2 * k:
            heapq.heappush(heap, (c - cost[s[-1]] + cost[s[-1] + 1], (*s[:-1], s[-1] + 1)))
            heapq.heappush(heap, (c + cost[s[-1] + 1], (*s, s[-1] + 1)))
    marks = np.zeros((len(out), 2 * k), dtype=np.int64)
    for i, s in enumerate(out):
        marks[i, list(s)] = 1
    return marks


def normal_mass(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Mass of the normal law between two bounds, by the tanh approximation of its distribution."""
    half = lambda x: 0.5 * np.tanh(0.7978846 * (x + 0.044715 * x**3))
    return np.maximum(half(high) - half(low), 1e-12)


class Index:
    """Hash tables over the rows of one band."""

    def __init__(self, data: np.ndarray, *, tables: int = TABLES, k: int = K, width: float = WIDTH, probes: int = PROBES, miss: float = MISS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.data, self.k, self.miss = data, k, miss
        squares = (data * data).sum(axis=1)
        self.most = max(float(np.sqrt(squares.max())), 1e-300)
        self.width = width * self.most
        data = np.concatenate([data, np.sqrt(np.maximum(self.most**2 - squares, 0))[:, None]], axis=1)
        self.mult = rng.integers(1, 1 << 62, size=k, dtype=np.int64) | 1
        self.marks = perturbations(k, probes)
        self.tables = []
        for _ in range(tables):
            a, b = rng.normal(size=(data.shape[1], k)), rng.random(k)
            buckets, of = np.unique(self._keys(np.floor(data @ a / self.width + b).astype(np.int64)), return_inverse=True)
            rows = np.argsort(of, kind="stable")
            self.tables.append((a, b, buckets, rows, np.searchsorted(of[rows], np.arange(len(buckets) + 1))))

    def _keys(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.mult).sum(axis=-1)

    def _visit(self, seen: np.ndarray, table: int, q: np.ndarray, keys: np.ndarray) -> None:
        """Mark the rows in the buckets `keys` as seen by the queries q."""
        _, _, buckets, rows, cuts = self.tables[table]
        place = np.minimum(np.searchsorted(buckets, keys), len(buckets) - 1)
        hit = buckets[place] == keys
        q, place = q[hit], place[hit]
        n = cuts[place + 1] - cuts[place]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(cuts[place], n)
        seen[np.repeat(q, n), rows[at]] = True

    def candidates(self, queries: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, top: int, worst: np.ndarray) -> list[np.ndarray]:
        """For each query the rows in the buckets that it visits. worst: the least inner product that is still of use, if known."""
        n = len(queries)
        seen = np.zeros((n, len(self.data)), dtype=bool)
        norms = np.maximum(np.sqrt((queries * queries).sum(axis=1)), 1e-300)
        unit = queries / norms[:, None]
        wide = np.concatenate([unit * self.most, np.zeros((n, 1))], axis=1)
        walls_of = np.concatenate([-self.mult, self.mult])  # what a step over each wall adds to the key
        at, rank, base = [], [], []
        for t, (a, b, *_) in enumerate(self.tables):
            x = wide @ a / self.width + b
            cell = np.floor(x)
            at.append(x - cell)  # to the wall below; the one above is at 1 - that
            rank.append(np.argsort(np.concatenate([at[t], 1 - at[t]], axis=1), axis=1, kind="stable"))
            base.append(self._keys(cell.astype(np.int64)))
            with np.errstate(over="ignore"):
                keys = base[t][:, None] + walls_of[rank[t]] @ self.marks[:FIRST].T
            self._visit(seen, t, np.repeat(np.arange(n), keys.shape[1]), keys.ravel())
        # the distance at which the last of the best so far lies (twice the norm if there are too few)
        limit = worst / norms
        for i in range(n):
            rows = np.flatnonzero(seen[i])
            rows = rows[ids[rows] != query_ids[i]]
            if len(rows) >= top:
                limit[i] = max(limit[i], np.partition(self.data[rows] @ unit[i], len(rows) - top)[len(rows) - top])
        far = np.sqrt(np.clip(2 * self.most**2 - 2 * self.most * np.maximum(limit, -self.most), 0, None))
        sigma = (np.maximum(far, 1e-6 * self.most) / self.width)[:, None]
        logs = np.empty((len(self.tables), n, len(self.marks)), dtype=np.float32)
        marks = self.marks.T.astype(np.float64)
        for t, low in enumerate(at):
            own, below, above = (np.log(normal_mass(x / sigma, y / sigma)) for x, y in ((-low, 1 - low), (-low - 1, -low), (1 - low, 2 - low)))
            steps = np.take_along_axis(np.concatenate([below - own, above - own], axis=1), rank[t], axis=1)
            logs[t] = own.sum(axis=1)[:, None] + steps @ marks
        # mass of the buckets by level of probability; the first level at which few enough are missed
        level = np.clip((-4 * logs).astype(np.int16), 0, LEVELS - 1)
        flat = (np.arange(len(self.tables) * n)[:, None] * LEVELS + level.reshape(len(self.tables) * n, -1)).ravel()
        mass = np.bincount(flat, np.exp(logs.ravel(), dtype=np.float64), len(self.tables) * n * LEVELS).reshape(len(self.tables), n, LEVELS).cumsum(axis=2)
        missed = np.log1p(-np.minimum(mass, 1 - 1e-9)).sum(axis=0) > np.log(self.miss)
        upto = missed.sum(axis=1)
        for t in range(len(self.tables)):
            q, p = np.nonzero(level[t] <= upto[:, None])
            with np.errstate(over="ignore"):
                keys = base[t][q] + (walls_of[rank[t]][q] * self.marks[p]).sum(axis=1)
            self._visit(seen, t, q, keys)
        seen[upto >= LEVELS] = True  # the buckets do not suffice
        return [np.flatnonzero(x) for x in seen]


def bands(norms: np.ndarray) -> list[np.ndarray]:
    """Rows by falling norm, cut where the norm has fallen by RATIO, but not before BAND rows."""
    order = np.argsort(-norms, kind="stable")
    out, a = [], 0
    while a < len(order):
        z = int(np.searchsorted(-norms[order], -norms[order[a]] / RATIO, "right"))
        z = max(z, a + BAND)
        out.append(np.sort(order[a:z]))
        a = z
    return out


def search(data: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, top: int, **index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (query, row, score) of the best `top` of each query among its candidates in the rows of a shard, itself left out."""
    norms, lengths = (np.sqrt((x * x).sum(axis=1)) for x in (data, queries))
    best = [(np.zeros(0, int), np.zeros(0)) for _ in queries]
    for band in bands(norms):
        own, most = data[band], norms[band].max()
        table = Index(own, **index)
        # a bound a little above |q| M, for rounding
        open_ = np.array([i for i, (rows, score) in enumerate(best) if len(rows) < top or lengths[i] * most * (1 + 1e-9) >= score[-1]], dtype=int)
        for lo in range(0, len(open_), 32):
            part = open_[lo : lo + 32]
            worst = np.array([best[i][1][-1] if len(best[i][1]) >= top else -np.inf for i in part])
            for i, rows in zip(part.tolist(), table.candidates(queries[part], ids[band], query_ids[part], top, worst), strict=True):
                rows = rows[ids[band[rows]] != query_ids[i]]
                score = own[rows] @ queries[i]
                if len(rows) > top:
                    limit = np.partition(score, len(score) - top)[len(score) - top]
                    rows, score = rows[score >= limit], score[score >= limit]
                rows, score = np.concatenate([best[i][0], band[rows]]), np.concatenate([best[i][1], score])
                order = np.lexsort((ids[rows], -score))[:top]
                best[i] = rows[order], score[order]
    of = np.repeat(np.arange(len(best)), [len(rows) for rows, _ in best])
    return of, np.concatenate([np.zeros(0, int), *(rows for rows, _ in best)]), np.concatenate([np.zeros(0), *(score for _, score in best)])


def nearest(vectors: DataFrame, is_query: Column, *, top: int = 20, vector: str = "embedding", shard: int = SHARD, **index) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector that is_query holds for, the `top` others of largest inner product found."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).filter(F.col("vec_id").isNotNull() & usable("v"))
    rows = scratch.cut(rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("q").alias("q")).withColumn("dim", F.size("v")))
    sizes = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"), F.ceil(F.sum(F.col("q").cast("long")) / QUERY_BLOCK).cast("int").alias("blocks"))
    sizes = scratch.cut(sizes.filter("blocks > 0").withColumnRenamed("dim", "of_dim"))
    dealt = rows.join(sizes, F.col("dim") == F.col("of_dim"))
    spread = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(n).cast("long")).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    base = dealt.select("dim", spread("shards", 1).alias("shard"), F.explode(every("blocks")).alias("block"), F.lit(0).alias("side"), "vec_id", "v")
    asked = dealt.filter("q").select("dim", F.explode(every("shards")).alias("shard"), spread("blocks", 2).alias("block"), F.lit(1).alias("side"), "vec_id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 3):
            side, ids, data = group.column(3).to_numpy(), group.column(4).to_numpy(), matrix(group.column(5))
            own, q = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if len(own) and len(q):
                own = own[np.argsort(ids[own])]
                of, row, score = search(data[own], ids[own], ids[q], data[q], top, **index)
                yield pa.RecordBatch.from_arrays([pa.array(ids[q][of]), pa.array(ids[own][row]), pa.array(score)], ["query_id", "vec_id", "score"])

    keys = ["dim", "shard", "block"]
    found = base.unionAll(asked).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(trimmed(run), "query_id long, vec_id long, score double")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scratch.cut(found).withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
