"""MinHash near-duplicate detection on word shingles, with confirmed links and distributed components.

1. Each text becomes its set of distinct word shingles (64-bit hashes) and, from many universal hash functions, the minima
   in bands. Texts with equal sets form a class at once; the smallest doc_id stands for it.
2. Representatives that share a band key are joined to the smallest one of that key (one edge each, never all pairs).
   The components of these edges are the candidate groups: two texts that share any band are in the same group.
3. A group is checked in tiles of bounded size. In a tile signatures are compared first, and what may reach the threshold is
   confirmed on the full sets, unless both texts are linked by way of others already. Only a star for each component leaves a tile.
   A group above the tile size is dealt into blocks, each with the group's smallest text; texts that this does not link to
   that one meet all the blocks in a second pass. So no link is lost and no task holds more than a tile.
4. Large-star and small-star give the components of the confirmed edges.

With 20 bands of 4 minima, a pair at similarity 0.85 shares no band with probability 4e-7.

Empty or null text: an empty set, linked with nothing. Rows that repeat a doc_id stay rows of their own; what any of them is
linked with is linked with the doc_id. A null doc_id takes part in nothing: its component is null and it is kept. Other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .batches import small_batches, trimmed
from .components import components
from .scratch import Scratch

BANDS, ROWS, TILE = 20, 4, 512
U = np.uint64


def _minima(s: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """For each segment of s, the minima of n universal hash functions (multiply, add, high half)."""
    a, b = words.numbers(n, 3) | U(1), words.numbers(n, 4)
    out = np.empty((len(starts), n), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for j in range(n):
            out[:, j] = np.minimum.reduceat(((s * a[j] + b[j]) >> U(32)).astype(np.uint32), starts)
    return out


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each row, one row after the other, and the n + 1 offsets."""
    starts, ends, rows = words.bounds(data, offsets)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    s, r, _ = words.shingles(words.hashes(data, starts, ends), rows, counts, k)
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    if len(s):
        keep = np.concatenate([[True], (s[1:] != s[:-1]) | (r[1:] != r[:-1])])
        s, r = s[keep], r[keep]
    return s, np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(offsets) - 1))])


def _signed(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = words.numbers(bands, 5)
        scale = words.numbers(rows, 6)
        for batch in batches:
            data, offsets = words.utf8(batch.column(1))
            for lo, hi in words.chunks(offsets):
                s, at = _sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)
                n = np.diff(at)
                full = np.flatnonzero(n)
                keys = np.zeros((hi - lo, bands), dtype=np.int64)
                digest = np.zeros((hi - lo, 2), dtype=np.int64)
                if len(full):
                    least = _minima(s, at[full], bands * rows).reshape(len(full), bands, rows).astype(np.uint64)
                    with np.errstate(over="ignore"):
                        keys[full] = words.mix((least * scale).sum(axis=2) + salt).view(np.int64)
                        for j, step in enumerate(words.numbers(2, 7)):
                            digest[full, j] = words.mix(np.add.reduceat(words.mix(s + step), at[full]) + n[full].astype(np.uint64)).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands * (hi - lo) + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(digest[:, 0]), pa.array(digest[:, 1]), lists], ["doc_id", "n_shingles", "d1", "d2", "bands"])

    return run


def _forest(texts: pa.ChunkedArray, nodes: np.ndarray, k: int, percent: int, n_hashes: int) -> tuple[np.ndarray, np.ndarray]:
    """An edge from each text to the smallest one that the confirmed links of one tile connect it to."""
    order = np.argsort(nodes, kind="stable")
    nodes = nodes[order]
    data, offsets = words.utf8(texts.take(pa.array(order)))
    sets, at = [], [0]
    least = np.empty((len(nodes), n_hashes), dtype=np.uint32)
    for lo, hi in words.chunks(offsets):
        s, cut = _sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], k)
        sets += [s[cut[i] : cut[i + 1]] for i in range(hi - lo)]
        full = np.flatnonzero(np.diff(cut))
        if len(full):
            least[lo + full] = _minima(s, cut[full], n_hashes)
    size = np.array([len(x) for x in sets])
    near = percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / n_hashes)  # six standard deviations below
    label = np.arange(len(nodes))
    for i in range(len(nodes) - 1):
        if not size[i]:
            continue
        j = np.arange(i + 1, len(nodes))
        j = j[(label[i + 1 :] != label[i]) & (100 * np.minimum(size[i], size[i + 1 :]) >= percent * np.maximum(size[i], size[i + 1 :])) & (size[i + 1 :] > 0)]
        j = j[(least[j] == least[i]).mean(axis=1) >= near]
        for x in j.tolist():
            if label[x] == label[i]:
                continue
            both = np.intersect1d(sets[i], sets[x], assume_unique=True).size
            if 100 * both >= percent * (size[i] + size[x] - both):
                label[label == max(label[x], label[i])] = min(label[x], label[i])
    far = np.flatnonzero(nodes[label] != nodes)
    return nodes[far], nodes[label[far]]


def _tiled(keys: int, k: int, percent: int, n_hashes: int):
    """Rows (keys.., node, text), sorted by the keys -> edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in words.groups(batches, keys):
            a, b = _forest(group.column(keys + 1).combine_chunks(), group.column(keys).to_numpy(), k, percent, n_hashes)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _check(tiles: DataFrame, keys: list[str], k: int, percent: int, n_hashes: int) -> DataFrame:
    dealt = tiles.select(*keys, "node", "text").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(trimmed(_tiled(len(keys), k, percent, n_hashes)), "a long, b long")


def near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs` (doc_id, text).

    Two texts are linked when 100 * |intersection| >= percent * |union| of their sets of distinct shingles of k words.
    component_id is the smallest doc_id reachable by links, kept says whether it is the row's own.
    """
    small_batches(docs.sparkSession)
    with Scratch(docs.sparkSession) as scratch:
        return _near_duplicates(docs, scratch, k, percent, bands, rows, tile)


def _near_duplicates(docs: DataFrame, scratch: Scratch, k: int, percent: int, bands: int, rows: int, tile: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = scratch.cut(docs.mapInArrow(trimmed(_signed(k, bands, rows)), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"))
    of_set = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = scratch.cut(of_set.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")))
    keyed = classes.select("rep", F.explode("bands").alias("key"))
    shared = scratch.cut(keyed.groupBy("key").agg(F.min("rep").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("key").alias("shared"), "low"))
    met = keyed.join(shared, F.col("key") == F.col("shared")).filter("rep != low")
    groups = components(scratch, met.select(F.col("rep").alias("a"), F.col("low").alias("b")))

    sizes = scratch.cut(groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")).select(F.col("component").alias("grp"), F.ceil(F.col("n") / tile).cast("int").alias("blocks")))
    members = groups.join(sizes, F.col("component") == F.col("grp")).select("node", "grp", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int").alias("block"))
    texts = scratch.cut(docs.filter("doc_id is not null").join(members, F.col("doc_id") == F.col("node")).select("grp", "blocks", "block", "node", "text"))
    own = F.when(F.col("node") == F.col("grp"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    edges = scratch.cut(_check(texts.withColumn("tile", F.explode(own)), ["grp", "tile"], k, percent, bands * rows))

    wide = texts.filter("blocks > 1")
    if not wide.isEmpty():
        apart = (F.col("node") == F.col("a")) & (F.col("grp") == F.col("b"))
        far = scratch.cut(wide.filter("node != grp").select("node", "grp").distinct().join(edges, apart, "left_anti").select(F.col("node").alias("far"), F.col("grp").alias("of")))
        parts = far.groupBy(F.col("of").alias("grp2")).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
        parts = scratch.cut(parts)
        whole = wide.join(parts, F.col("grp") == F.col("grp2")).select("grp", F.col("block").alias("tile"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "text")
        some = (
            wide.join(far.select("far"), F.col("node") == F.col("far")).join(parts, F.col("grp") == F.col("grp2"))
            .withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts").cast("long")).cast("int"))
            .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("tile != block")
            .select("grp", "tile", "part", "node", "text")
        )
        edges = scratch.cut(edges.unionAll(_check(whole.unionAll(some), ["grp", "tile", "part"], k, percent, bands * rows)))
    scratch.drop(texts)
    final = components(scratch, edges)
    found = scratch.cut(classes.select("d1", "d2", "rep").join(final, F.col("rep") == F.col("node"), "left").select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.coalesce("component", "rep").alias("component")))
    # rows that repeat a doc_id can stand in several classes: their components are one
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(found, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("component", "doc_id")
    # a row of numbers for each document: all that is left of the call
    return scratch.keep(out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")))
