"""Mixing of (overlapping) sources to target weights by min-cost flow over membership patterns.

Documents are summed by membership pattern, the set of sources that they belong to. The driver solves one flow: each
pattern offers its words once at no cost and again at rising costs (repetition is convex), to any source of the pattern, up to
each source's quota. Then documents are selected by a seeded hash: whole copies for everybody, and for what is left of a
pattern's flow the documents of the lowest hashes. Hashes are ordered by parts: sums by their first nine bits and by the next nine find
the part in which the flow ends, and only the documents of that part (1/2^18 of a pattern) are ordered one by one, so that no
task sorts a pattern. What the flow still lacks is filled in the same way from the documents left that fit into the gap, in passes until no
document left fits: a document longer than the gap is passed over, never the end.

The driver holds a row for each pattern and source (bounded by MAX_PATTERNS), never documents. Reruns give the same choice.
Null source: a source of its own, last in order. Null text has size 0 and is never taken. Rows of one pattern that repeat a doc_id (or
have none) are rows of their own, of equal fate. Other columns pass through; those named like the results are replaced.
"""

from __future__ import annotations

import heapq
import json
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .scratch import Scratch

#: Bits of a hash, and those of the parts in which it is ordered.
HASH, PART, MAX_PATTERNS = 40, 9, 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def shares(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Targets in proportion to the weights, none above `most` times its size; what is above goes to the others by weight."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else unit * weights[i]
        if not full:
            break
        open_ -= full
        left -= sum(most * sizes[i] for i in full)
    return out


def min_cost_flow(patterns: list[tuple[int, tuple[int, ...]]], quotas: list[int], costs: tuple[int, ...]) -> list[dict[int, int]]:
    """For each pattern (words, sources) the words that go to each source, quotas met as far as can be, at the least cost.

    costs: of a pattern's first copy, its second and so on; they may not fall. Primal-dual: for each distance from the source, of which
    there are few, all shortest paths at once by blocking flows.
    """
    n_p, n_s = len(patterns), len(quotas)
    end = 1 + n_p + n_s
    graph: list[list[int]] = [[] for _ in range(end + 1)]
    to, left, cost = [], [], []

    def arc(a: int, b: int, room: int, price: int) -> None:
        for x, y, r, c in ((a, b, room, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y)
            left.append(r)
            cost.append(c)

    for p, (size, sources) in enumerate(patterns):
        for price in costs:
            arc(0, 1 + p, size, price)
        for s in sources:
            arc(1 + p, 1 + n_p + s, size * len(costs), 0)
    for s, quota in enumerate(quotas):
        arc(1 + n_p + s, end, quota, 0)
    potential = [0] * (end + 1)

    def on_shortest(e: int, x: int) -> bool:
        return left[e] > 0 and cost[e] + potential[x] == potential[to[e]]

    def levels() -> list[int]:
        level, queue = [-1] * (end + 1), [0]
        level[0] = 0
        for x in queue:
            for e in graph[x]:
                if level[to[e]] < 0 and on_shortest(e, x):
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        return level

    def block(level: list[int]) -> None:
        """Fill shortest paths until each has a full arc."""
        at, path, x = [0] * (end + 1), [], 0
        while True:
            if x == end:
                room = min(left[e] for e in path)
                for e in path:
                    left[e] -= room
                    left[e ^ 1] += room
                path, x = [], 0
            while at[x] < len(graph[x]) and not (level[to[graph[x][at[x]]]] == level[x] + 1 and on_shortest(graph[x][at[x]], x)):
                at[x] += 1
            if at[x] < len(graph[x]):
                path.append(graph[x][at[x]])
                x = to[path[-1]]
            elif x:
                x = to[path.pop() ^ 1]
                at[x] += 1
            else:
                return

    while True:
        far, heap = [math.inf] * (end + 1), [(0, 0)]
        far[0] = 0
        while heap:
            d, x = heapq.heappop(heap)
            if d > far[x]:
                continue
            for e in graph[x]:
                if left[e] > 0 and (new := d + cost[e] + potential[x] - potential[to[e]]) < far[to[e]]:
                    far[to[e]] = new
                    heapq.heappush(heap, (new, to[e]))
        if far[end] == math.inf:
            break
        potential = [p + min(d, far[end]) for p, d in zip(potential, far, strict=True)]
        while (level := levels())[end] >= 0:
            block(level)
    out: list[dict[int, int]] = [{} for _ in patterns]
    for p in range(n_p):
        for e in graph[1 + p]:
            if e % 2 == 0 and to[e] > n_p and left[e ^ 1]:
                out[p][to[e] - 1 - n_p] = left[e ^ 1]
    return out


def ends(fits: DataFrame) -> dict[str, tuple[int, int | None, int]]:
    """For each k of the documents (k, gap, h, n) their sum, the part (2 * PART bits of h) in which a running sum by h exceeds the gap, or
    None, and what of the gap is left where the part begins."""
    low = fits.groupBy("k", "gap", F.shiftright("h", HASH - 2 * PART).alias("part")).agg(F.sum("n").alias("n")).withColumn("high", F.shiftright("part", PART))
    before = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # noqa: E731  2^PART rows at most
    high = low.groupBy("k", "high").agg(F.sum("n").alias("n")).withColumn("from", before(["k"], "high")).select(F.col("k").alias("k1"), F.col("high").alias("high1"), F.col("n").alias("of_high"), "from")
    met = low.withColumn("at", before(["k", "high"], "part")).join(high, (F.col("k") == F.col("k1")) & (F.col("high") == F.col("high1"))).withColumn("room", F.col("gap") - F.col("from") - F.col("at"))
    out = met.groupBy("k").agg(F.sum("n").alias("n"), F.min(F.when((F.col("room") >= 0) & (F.col("room") < F.col("n")), F.struct("part", "room"))).alias("end"))
    return {r["k"]: (r["n"], *(r["end"] or (None, 0))) for r in out.collect()}


def select(scratch: Scratch, items: DataFrame, want: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """Of the items (k, id, h, n) of each k, in order of (h, id), those that fit into what is left of want, until none left fits.

    Returns chosen rows (k, id) and, for each k, the number below which the first 2 * PART bits of h say that an item of n <= want is chosen as well.
    """
    spark = items.sparkSession

    def table(rows: list[tuple], *names: str) -> DataFrame:
        """Rows of a text and numbers, MAX_PATTERNS at most."""
        columns = list(zip(*rows, strict=True))
        return F.broadcast(spark.createDataFrame(pa.table({n: pa.array(c, pa.int64() if i else pa.string()) for i, (n, c) in enumerate(zip(names, columns, strict=True))})))

    part = F.shiftright("h", HASH - 2 * PART)
    gaps = {k: n for k, n in want.items() if n > 0}
    chosen = items.filter("false").select("k", "id")
    below: dict[str, int] = {}
    while gaps:
        fits = items.join(table([(k, n, below.get(k, 0)) for k, n in gaps.items()], "k0", "gap", "below"), F.col("k") == F.col("k0")).filter("n > 0 and n <= gap").filter(part >= F.col("below"))
        if below:
            # what the first pass left in its whole parts was longer than its gap, and is so now
            fits = fits.join(chosen.select(F.col("k").alias("k5"), F.col("id").alias("id5")), (F.col("k") == F.col("k5")) & F.col("id").eqNullSafe(F.col("id5")), "left_anti")
        found = ends(fits)
        if not found:
            break
        last = {k: 1 << 2 * PART if end is None else end for k, (_, end, _) in found.items()}
        met = fits.join(table([(k, last[k], room) for k, (_, _, room) in found.items()], "k2", "last", "room"), F.col("k") == F.col("k2"))
        run = F.sum("n").over(Window.partitionBy("k").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0))
        taken = met.filter(part == F.col("last")).withColumn("run", run).filter("run <= room").select("k", "id", "n")
        if below:  # few documents fit into what the first pass has left
            taken = taken.unionAll(met.filter(part < F.col("last")).select("k", "id", "n"))
        taken = scratch.cut(taken)
        got = {r["k"]: r["n"] for r in taken.groupBy("k").agg(F.sum("n").alias("n")).collect()}
        chosen = chosen.unionAll(taken.select("k", "id"))
        if not below:
            for k, (n, end, room) in found.items():
                got[k] = got.get(k, 0) + (n if end is None else gaps[k] - room)
            below = last
        gaps = {k: n - got[k] for k, n in gaps.items() if got.get(k) and n > got[k]}
    return chosen, below


def mix(docs: DataFrame, sources: Column, size: Column, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """docs with size, source_size, target (of the first source, in order, of the row's pattern) and taken, in words.

    sources: array of source names (or of one null). The sources, in code point order with null last, weigh `weights` in turn
    and share `share` times all words; no source gets more than `most` times its words, no document is taken more than
    `most` times.
    """
    spark = docs.sparkSession
    new = ["size", "source_size", "target", "taken"]
    rest = [c for c in docs.columns if c not in new]
    own = "__mix_"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    c_size, c_of, c_h = (F.col(own + c) for c in ("size", "of", "h"))
    base = docs.withColumns({own + "size": size, own + "of": F.to_json(F.struct(F.array_sort(F.array_distinct(sources)).alias("s"))), own + "h": F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(seed)), F.lit(1 << HASH))})
    with Scratch(spark) as scratch:
        slim = scratch.cut(base.select(F.col("doc_id").cast("long").alias("id"), c_size.alias("n"), c_of.alias("k"), c_h.alias("h")))
        found = slim.groupBy("k").agg(F.sum("n").alias("n")).limit(MAX_PATTERNS + 1).collect()
        if len(found) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
        patterns = sorted((r["k"], json.loads(r["k"]).get("s") or [None], r["n"]) for r in found)
        names = sorted({s for _, of, _ in patterns for s in of}, key=lambda s: (s is None, [ord(c) for c in s or ""]))
        place = {s: i for i, s in enumerate(names)}
        sizes = [0] * len(names)
        for _, of, n in patterns:
            for s in of:
                sizes[place[s]] += n
        targets = shares(sizes, [float(weights[i % len(weights)]) for i in range(len(names))], share * sum(n for _, _, n in patterns), most)
        flow = min_cost_flow([(n, tuple(place[s] for s in of)) for _, of, n in patterns], [round(t) for t in targets], tuple(i * i for i in range(most)))
        plan = []
        for (key, of, n), sent in zip(patterns, flow, strict=True):
            first = place[min(of, key=lambda s: place[s])]
            whole, part = divmod(sum(sent.values()), n) if n else (0, 0)
            plan.append((key, whole, part, sizes[first], targets[first]))
        chosen, below = select(scratch, scratch.cut(slim.groupBy("k", "id", "h").agg(F.sum("n").alias("n"))), {key: part for key, _, part, _, _ in plan})
        kinds = [("k", T.StringType()), ("whole", T.LongType()), ("part", T.LongType()), ("source_size", T.LongType()), ("target", T.DoubleType()), ("below", T.LongType())]
        plan_of = F.broadcast(spark.createDataFrame([(*x, below.get(x[0], 0)) for x in plan], T.StructType([T.StructField(own + c, t) for c, t in kinds])))  # MAX_PATTERNS rows at most
        # an item of the first pass is of one doc_id: all its rows together
        several = scratch.keep(slim.groupBy("k", "id").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).filter("rows > 1").select(F.col("k").alias(own + "k7"), F.col("id").alias(own + "id7"), F.col("n").alias(own + "n7")))
        ids = scratch.keep(chosen.select(F.col("k").alias(own + "k2"), F.col("id").alias(own + "id2")).distinct())
    id_of = F.col("doc_id").cast("long")
    out = base.join(plan_of, c_of == F.col(own + "k"), "left").join(ids, (c_of == F.col(own + "k2")) & id_of.eqNullSafe(F.col(own + "id2")), "left").join(several, (c_of == F.col(own + "k7")) & id_of.eqNullSafe(F.col(own + "id7")), "left")
    item = F.coalesce(F.col(own + "n7"), c_size)
    extra = ((F.shiftright(c_h, HASH - 2 * PART) < F.col(own + "below")) & (item <= F.col(own + "part"))) | F.col(own + "k2").isNotNull()
    return out.select(*[F.col(f"`{c}`") for c in rest], c_size.alias("size"), F.col(own + "source_size").alias("source_size"), F.col(own + "target").alias("target"), (c_size * (F.col(own + "whole") + extra.cast("long"))).alias("taken"))
