"""Joins of layers, relations, speakers and themes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabulon.functions import patterns

KEY = ["doc_id", "idx"]


def last_wins(rows: DataFrame, order: str) -> DataFrame:
    """One row for each segment: the last by `order`."""
    by = Window.partitionBy(*KEY).orderBy(F.desc(order))
    return rows.withColumn("_rn", F.row_number().over(by)).filter("_rn = 1").drop("_rn")


def merge_layers(segments: DataFrame, *layers: DataFrame) -> DataFrame:
    """Left joins of all layers on the segments."""
    for layer in layers:
        segments = segments.join(layer, KEY, "left")
    return segments


def relation_projection(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """The edges that leave and that reach each segment, as sorted lists."""
    side = lambda a, b, name: refs.groupBy("doc_id", F.col(a).alias("idx")).agg(F.array_join(F.sort_array(F.collect_list(b)), ",").alias(name))
    out = rows.select(*KEY).join(side("src", "tgt", "targets"), KEY, "left").join(side("tgt", "src", "sources"), KEY, "left")
    return out.fillna("", ["targets", "sources"])


def pending(rows: DataFrame, done: DataFrame) -> DataFrame:
    return rows.select(*KEY).join(done.select(*KEY), KEY, "left_anti")


def prefer_emotion(rows: DataFrame, emotion: DataFrame) -> DataFrame:
    """Polarity and intensity of the emotion layer where it has the segment, else of the structure layer."""
    met = rows.select(*KEY, "pol", "inten").join(emotion.select(*KEY, "emo_pol", "emo_int"), KEY, "left")
    return met.select(*KEY, F.coalesce("emo_pol", "pol").alias("polarity"), F.coalesce("emo_int", "inten").alias("intensity"))


def co_occurrence(present: DataFrame) -> DataFrame:
    """(doc_id, a, b, n): pairs of names in one segment, a < b; a segment's names are few by contract."""
    a, b = present.select(*KEY, F.col("who").alias("a")), present.select(*KEY, F.col("who").alias("b"))
    return a.join(b, KEY).filter("a < b").groupBy("doc_id", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def theme_echoes(tags: DataFrame, window: int = 15) -> DataFrame:
    """Segments of one theme up to `window` apart; the range is a bucketed equi-join, so that no document is joined whole."""
    a = tags.select("doc_id", F.col("idx").alias("src"), "tag", F.explode(F.array(F.floor(F.col("idx") / window), F.floor(F.col("idx") / window) + 1)).alias("_b"))
    b = tags.select("doc_id", F.col("idx").alias("tgt"), "tag", F.floor(F.col("idx") / window).alias("_b"))
    return a.join(b, ["doc_id", "tag", "_b"]).filter(F.col("tgt") - F.col("src") > 0).filter(F.col("tgt") - F.col("src") <= window).select("doc_id", "tag", "src", "tgt").distinct()


def neighbour_overlap(rows: DataFrame, reach: int = 5) -> DataFrame:
    """Mean Jaccard index of the themes of each row with its neighbours, by window leads and lags (no self join)."""
    order = Window.partitionBy("doc_id").orderBy("idx")
    rows = rows.select(*KEY, F.array_distinct(F.array("t1", "t2")).alias("themes"))
    parts = []
    for k in [*range(-reach, 0), *range(1, reach + 1)]:
        other = F.lead("themes", k).over(order) if k > 0 else F.lag("themes", -k).over(order)
        near = F.lead("idx", k).over(order) if k > 0 else F.lag("idx", -k).over(order)
        parts.append(F.when(F.abs(near - F.col("idx")) <= reach, F.size(F.array_intersect("themes", other)) / F.size(F.array_union("themes", other))))
    rows = rows.withColumn("parts", F.array_compact(F.array(*parts)))
    return rows.select(*KEY, F.size("parts").cast("long").alias("n"), F.round(F.aggregate("parts", F.lit(0.0), lambda a, x: a + x), 6).alias("overlap"))


def canonical_names(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """who, replaced by its canonical name where the alias table (alias, canonical) has one."""
    return names.join(aliases, F.col("who") == F.col("alias"), "left").withColumn("name", F.coalesce("canonical", "who")).drop("alias", "canonical")


def contained(names: DataFrame, others: DataFrame) -> DataFrame:
    """(doc_id, a, b): pairs of one document, a of names and b of others, in which one holds the other; empty names are in none. The names of either side are looked for in those
    of the other in one pass, so that a document's names never meet pair by pair."""
    a = names.select("doc_id", "a").filter(F.length("a") > 0).distinct()
    b = others.select("doc_id", "b").filter(F.length("b") > 0).distinct()
    holds = patterns.find(a.withColumn("txt", F.col("a")), b.select(F.col("b").alias("w"))).select("doc_id", "a", F.col("w").alias("b")).join(b, ["doc_id", "b"], "left_semi")
    held = patterns.find(b.withColumn("txt", F.col("b")), a.select(F.col("a").alias("w"))).select("doc_id", F.col("w").alias("a"), "b").join(a, ["doc_id", "a"], "left_semi")
    return holds.select("doc_id", "a", "b").union(held.select("doc_id", "a", "b")).distinct()


def deduplicated(refs: DataFrame, priority: str) -> DataFrame:
    """One edge for each (document, source, target): the first by priority."""
    by = Window.partitionBy("doc_id", "src", "tgt").orderBy(priority, "rel")
    return refs.withColumn("_rn", F.row_number().over(by)).filter("_rn = 1").drop("_rn")


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of new replace those of old with the same segment."""
    return old.join(new.select(*KEY), KEY, "left_anti").unionByName(new)


def brackets(rows: DataFrame, opening: str, closing: str) -> DataFrame:
    """Opening (step 1) and closing (step -1) rows with their running sum and its floor; a close without an open before it is left out."""
    order = Window.partitionBy("doc_id").orderBy("idx")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("d06") == opening, 1).when(F.col("d06") == closing, -1)
    rows = rows.withColumn("step", step).filter("step is not null").withColumn("sum", F.sum("step").over(so_far))
    rows = rows.withColumn("floor", F.least(F.lit(0), F.min("sum").over(so_far)))
    return rows.withColumn("lost", (F.col("step") == -1) & (F.col("floor") < F.coalesce(F.lag("floor").over(order), F.lit(0)))).filter("not lost")


def paired_first_in(rows: DataFrame, opening: str = "隐藏", closing: str = "揭示") -> DataFrame:
    """Bracket pairs of one document in queue order: the n-th open with the n-th close that finds one open."""
    at = Window.partitionBy("doc_id", "step").orderBy("idx")
    n = brackets(rows, opening, closing).withColumn("rn", F.row_number().over(at))
    out = n.groupBy("doc_id", "rn").agg(F.max(F.when(F.col("step") == 1, F.col("idx"))).alias("src"), F.max(F.when(F.col("step") == -1, F.col("idx"))).alias("tgt"))
    return out.filter("src is not null and tgt is not null").select("doc_id", "src", "tgt")


def paired_last_in(rows: DataFrame, opening: str = "隐藏", closing: str = "揭示") -> DataFrame:
    """Bracket pairs of one document (stack order): an open and the next close at its depth."""
    rows = brackets(rows, opening, closing).withColumn("depth", F.col("sum") - F.col("floor") + F.when(F.col("step") == -1, 1).otherwise(0))
    at = Window.partitionBy("doc_id", "depth").orderBy("idx")
    return rows.withColumn("src", F.lag("idx").over(at)).withColumn("was", F.lag("step").over(at)).filter("step = -1 and was = 1").selectExpr("doc_id", "src", "idx as tgt")


def reuse_edges(rows: DataFrame, column: str) -> DataFrame:
    """Edges between successive segments of a document that name the same value."""
    order = Window.partitionBy("doc_id", column).orderBy("idx")
    known = rows.filter(F.col(column).isNotNull()).select("doc_id", "idx", F.col(column).alias("value")).withColumnRenamed("value", column)
    return known.withColumn("src", F.lag("idx").over(order)).filter("src is not null").select("doc_id", F.col(column).alias("value"), "src", F.col("idx").alias("tgt"))


def boundary_lookup(pairs: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Adjacent pairs (idx, next_idx) with what a boundary table (a, b, is_boundary) says of them; false where it says nothing."""
    b = boundaries.select(F.col("doc_id").alias("d2"), "a", "b", "is_boundary")
    met = pairs.join(b, (F.col("doc_id") == F.col("d2")) & (F.col("idx") == F.col("a")) & (F.col("next_idx") == F.col("b")), "left")
    return met.select("doc_id", "idx", "next_idx", F.coalesce("is_boundary", F.lit(False)).alias("is_boundary"))
