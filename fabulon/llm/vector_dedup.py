"""Near-duplicate vectors by int8 products of tiles with rigorous error bounds.

Vectors of one label are dealt into blocks of bounded size; each pair of blocks is one tile, and a task holds one tile. Every unit
vector u is written as s * q + e with q in int8, and |e| is computed. Since u . v = s_u s_v (q_u . q_v) + (s_u q_u) . e_v + e_u . v,
the true cosine is at most the product of the quantised ones plus |s_u q_u| |e_v| + |e_u|. Only pairs that this bound lets reach
the threshold are computed again in double precision on the vectors as given; none can be missed.

A tile gives a count of links for each vector and the edges of a spanning forest, never its pairs. Equal vectors of one
label form a class first, of which one vector goes into the tiles. Components come from large-star and small-star steps.

Vectors that are null, empty, zero or hold null or non-finite components, null labels and null vec_ids link with nothing. Vectors of
different lengths are never linked. Rows that repeat a vec_id are rows of their own with the count and component of all rows of
that vec_id: n_links is the number of other vec_ids of which some vector is linked with one of its own. A vec_id with several
different vectors must be counted once wherever it is met, so only for the classes of such vec_ids a tile gives the pairs of
classes as well (none where vec_ids are unique). Other columns are not read; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import trimmed
from .components import components, local
from .scratch import Scratch
from .vectors import matrix, usable
from .words import groups

BLOCK = 2048


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scale, and norm of the rest of the unit vectors of x's rows."""
    u = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow in the norm
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((u - scale[:, None] * q) ** 2).sum(axis=1))


def possible(a: tuple, b: tuple, limit: float, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a within rows, row of b) whose cosine may reach the limit."""
    (qa, sa, ea), (qb, sb, eb) = [x[rows] for x in a], b
    exact = np.float32 if qa.shape[1] * 127 * 127 < 1 << 24 else np.float64  # integer sums below 2 ** 24 are exact in float32
    dot = (qa.astype(exact) @ qb.astype(exact).T).astype(np.float64)
    norm = sa * np.sqrt((qa.astype(np.float64) ** 2).sum(axis=1))
    return np.nonzero(dot * (sa[:, None] * sb) + (norm[:, None] * eb + ea[:, None]) >= limit - 1e-9)


def linked(x: np.ndarray, y: np.ndarray | None, limit: float, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of x and y (of x and itself, each once, if y is None) with cosine >= limit in double precision."""
    a = quantised(x)
    b = a if y is None else quantised(y)
    other = x if y is None else y
    unit = lambda z: (z / np.abs(z).max(axis=1, keepdims=True))
    ux, uy = unit(x), unit(other)
    nx, ny = np.sqrt((ux * ux).sum(axis=1)), np.sqrt((uy * uy).sum(axis=1))
    out = []
    for lo in range(0, len(x), step):
        i, j = possible(a, b, limit, slice(lo, lo + step))
        i += lo
        if y is None:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 << 16):
            p, r = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            keep = np.einsum("ij,ij->i", ux[p], uy[r]) / (nx[p] * ny[r]) >= limit
            out.append((p[keep], r[keep]))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int))


def _tile(limit: float, keys: int):
    """Rows (keys.., side, id, weight, several, class, v) sorted by the keys -> (class, links, root, id, other): links of the classes,
    counted with the weights of the others, and the smallest id that the tile connects to; or, with `other`, a pair of classes of which one
    is marked `several`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, keys):
            side, ids, weight, several, number = (group.column(keys + c).to_numpy() for c in range(5))
            data = matrix(group.column(keys + 5))
            order = np.lexsort((number, ids, side))
            side, ids, weight, several, number, data = side[order], ids[order], weight[order], several[order], number[order], data[order]
            n = int((side == 0).sum())
            if n == len(ids):
                i, j = linked(data, None, limit)
            elif n:
                i, j = linked(data[:n], data[n:], limit)
                j = j + n
            else:
                continue
            if not len(i):
                continue
            links = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
            rank = np.argsort(ids, kind="stable")
            place = np.empty_like(rank)
            place[rank] = np.arange(len(rank))
            root = ids[rank][local(len(ids), place[i], place[j])[place]]
            met = np.zeros(len(ids), dtype=bool)
            met[i] = met[j] = True
            of = [pa.array(number[met]), pa.array(links[met].astype(np.int64)), pa.array(root[met]), pa.array(ids[met]), pa.nulls(int(met.sum()), pa.int64())]
            yield pa.RecordBatch.from_arrays(of, ["class", "links", "root", "id", "other"])
            pair = (several[i] | several[j]) > 0
            if pair.any():
                i, j = i[pair], j[pair]
                x, y = np.concatenate([i, j]), np.concatenate([j, i])
                none = np.zeros(len(x), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(number[x]), pa.array(none), pa.array(ids[x]), pa.array(ids[x]), pa.array(number[y])], ["class", "links", "root", "id", "other"])

    return run


def near_duplicate_vectors(vectors: DataFrame, *, limit: float = 0.98, vector: str = "embedding", label: str = "label", block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row; links join vectors of equal label with cosine >= limit."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.withColumn("ok", F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("v"))
    rows = scratch.cut(rows.select("vec_id", "label", F.when(F.col("ok"), F.col("v")).alias("v"), "ok"))
    # a class is told by two hashes of label and vector
    named = lambda: [F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit(7), "v", "label").alias("h2")]
    of_class = scratch.cut(rows.filter("ok").select("vec_id", "label", "v", *named()).groupBy("h1", "h2", "vec_id").agg(F.first("label").alias("label"), F.first("v").alias("v")))
    spread = of_class.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n_classes")).filter("n_classes > 1").select(F.col("vec_id").alias("many"))
    marked = of_class.join(scratch.cut(spread), F.col("vec_id") == F.col("many"), "left").withColumn("several", F.col("many").isNotNull())
    # weight: the vec_ids that stand in this class alone
    classes = marked.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count(F.when(~F.col("several"), 1)).alias("weight"), F.max(F.col("several").cast("int")).alias("several"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = scratch.cut(classes.withColumns({"dim": F.size("v"), "class": F.monotonically_increasing_id()}))
    sizes = scratch.cut(classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).select(F.col("label").alias("of"), F.col("dim").alias("of_dim"), "blocks"))
    dealt = classes.join(sizes, (F.col("label") == F.col("of")) & (F.col("dim") == F.col("of_dim"))).withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks").cast("long")).cast("int"))
    meets = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = meets.select(F.xxhash64("label", "dim").alias("t"), "dim", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), (F.col("block") > F.col("other")).cast("int").alias("side"), "id", "weight", "several", "class", "v")
    keys = ["t", "dim", "lo", "hi"]
    found = scratch.cut(tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(trimmed(_tile(limit, 4)), "class long, links long, root long, id long, other long"))
    members = scratch.cut(marked.select("vec_id", "several", F.col("h1").alias("g1"), F.col("h2").alias("g2")).join(classes.select("h1", "h2", "class", "id", "weight"), (F.col("g1") == F.col("h1")) & (F.col("g2") == F.col("h2"))).select("vec_id", "several", "class", "id", "weight"))
    # a vec_id of several classes: they are one node
    group = components(scratch, found.filter("other is null").select(F.col("id").alias("a"), F.col("root").alias("b")).unionAll(members.filter("id != vec_id").select(F.col("id").alias("a"), F.col("vec_id").alias("b"))))
    links = scratch.cut(found.filter("other is null").groupBy(F.col("class").alias("c2")).agg(F.sum("links").alias("links")))
    single = members.filter("not several").join(links, F.col("class") == F.col("c2"), "left").select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"))
    # what the pairs of classes add: for a vec_id of one class the other vec_ids of several, and for one of several all that its classes meet
    pairs = scratch.cut(found.filter("other is not null").select(F.col("class").alias("c1"), "other").unionAll(members.filter("several").select(F.col("class").alias("c1"), F.col("class").alias("other"))).distinct())
    mine = members.select(F.col("vec_id").alias("u"), F.col("several").alias("u_several"), F.col("class").alias("uc")).join(pairs, F.col("uc") == F.col("c1")).select("u", "u_several", "other").distinct()
    mine = scratch.cut(mine)
    by_many = mine.join(members.filter("several").select("vec_id", "class"), F.col("other") == F.col("class")).filter("u != vec_id").select("u", "vec_id").distinct().groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    by_class = mine.filter("u_several").join(classes.select("class", "weight"), F.col("other") == F.col("class")).groupBy("u").agg(F.sum("weight").alias("n"))
    counted = single.select("vec_id", "n").unionAll(by_many).unionAll(by_class).groupBy(F.col("vec_id").alias("v_id")).agg(F.sum("n").alias("n"))
    counted = scratch.cut(counted.join(group, F.col("v_id") == F.col("node"), "left").select("v_id", "n", "component"))
    out = rows.select("vec_id").join(counted, F.col("vec_id") == F.col("v_id"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
