"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .scratch import Scratch


def _stars(scratch: Scratch, edges: DataFrame, large: bool) -> tuple[DataFrame, int]:
    """One step over edges (a, b), and how many of them it changes. The minima are written first, so that both sides of the
    join are dealt out anew and a node with very many neighbours is split by AQE."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.unionAll(turned) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = scratch.cut(around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")))
    met = around.join(least, F.col("a") == F.col("n"))
    seen = Observation()
    if large:
        new = met.filter("b > a").observe(seen, F.count(F.when(F.col("m") != F.col("a"), 1)).alias("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = met.filter("b != m").observe(seen, F.count(F.lit(1)).alias("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    out = scratch.cut(new)
    scratch.drop(least)
    return out, seen.get["n"]


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, component) for each end of the edges (a long, b long); component is the smallest node reachable.

    Nulls and loops are ignored. Every step is a distributed job on the edges, written to the shared folder; the driver
    sees one number a step. The steps end when two in a row, one of each kind, change no edge: a star for each component.
    """
    at = scratch.cut(edges.filter("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    still, large = 0, True
    while still < 2:
        new, changed = _stars(scratch, at, large)
        scratch.drop(at)
        at, large, still = new, not large, 0 if changed else still + 1
    return scratch.cut(at.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(at.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())


def local(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 of one task, the smallest node of each one's component over edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            hop = new[new]
            if np.array_equal(hop, new):
                break
            new = hop
        if np.array_equal(new, label):
            break
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label[label]
