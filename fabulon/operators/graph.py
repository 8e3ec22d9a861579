"""Causal, event, object and character graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabulon.functions import enums as E
from fabulon.functions.text import rounded

from .sequence import event_function


def causal_edges(refs: DataFrame, structure: DataFrame) -> DataFrame:
    """Edges of causal relations between annotated segments, with at least the floor of confidence of their type."""
    kind, floor = F.lit(None).cast("string"), F.lit(None).cast("double")
    for rel, (name, least) in E.EDGE_TYPES.items():
        kind, floor = F.when(F.col("rel") == rel, F.lit(name)).otherwise(kind), F.when(F.col("rel") == rel, F.lit(least)).otherwise(floor)
    known = structure.filter("d01 is not null")
    a = known.select(F.col("doc_id").alias("da"), F.col("idx").alias("ia"), F.col("d01").alias("src_d01"))
    b = known.select(F.col("doc_id").alias("db"), F.col("idx").alias("ib"), F.col("d01").alias("tgt_d01"))
    rows = refs.filter(F.col("rel").isin(*E.EDGE_TYPES)).withColumn("edge_type", kind).withColumn("confidence", F.greatest("conf", floor))
    rows = rows.join(a, (F.col("doc_id") == F.col("da")) & (F.col("src") == F.col("ia")), "left").join(b, (F.col("doc_id") == F.col("db")) & (F.col("tgt") == F.col("ib")), "left")
    reason = F.when(F.col("tgt") < F.col("src"), "reversed").when(F.col("src_d01").isNull() | F.col("tgt_d01").isNull(), "isolated")
    return rows.withColumn("reason", reason).select("doc_id", "src", "tgt", "edge_type", F.round("confidence", 6).alias("confidence"), "src_d01", "tgt_d01", "reason")


def accepted(edges: DataFrame) -> DataFrame:
    return edges.filter("reason is null").drop("reason")


def rejected(edges: DataFrame) -> DataFrame:
    return edges.filter("reason is not null").select("doc_id", "src", "tgt", "reason")


def degrees(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """In and out degree and position (source or sink 1.0, isolated 0.3, else 0.7) of each node."""
    ends = edges.select("doc_id", F.explode(F.array(F.struct(F.col("src").alias("idx"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("tgt").alias("idx"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e"))
    n = ends.groupBy("doc_id", F.col("e.idx").alias("idx")).agg(F.sum("e.o").alias("out_degree"), F.sum("e.i").alias("in_degree"))
    rows = nodes.select("doc_id", "idx").join(n, ["doc_id", "idx"], "left").fillna(0, ["out_degree", "in_degree"])
    place = F.when((F.col("out_degree") == 0) & (F.col("in_degree") == 0), 0.3).when((F.col("out_degree") == 0) | (F.col("in_degree") == 0), 1.0).otherwise(0.7)
    return rows.withColumn("position", place)


def chains(edges: DataFrame, hops: int = 5) -> DataFrame:
    """All simple paths of 1 to `hops` edges as text; each level is one join on the last node."""
    edges = edges.select("doc_id", "src", "tgt").distinct()
    level = edges.select("doc_id", F.array("src", "tgt").alias("path"), F.col("tgt").alias("last"))
    out = level
    for _ in range(hops - 1):
        step = edges.select(F.col("doc_id").alias("d2"), "src", "tgt")
        level = level.join(step, (F.col("doc_id") == F.col("d2")) & (F.col("last") == F.col("src"))).filter(~F.array_contains("path", F.col("tgt"))).select("doc_id", F.concat("path", F.array("tgt")).alias("path"), F.col("tgt").alias("last"))
        out = out.unionByName(level)
    return out.select("doc_id", F.array_join("path", ">").alias("path"), (F.size("path") - 1).cast("long").alias("length"))


def top_chains(paths: DataFrame, k: int = 20) -> DataFrame:
    by = Window.partitionBy("doc_id").orderBy(F.desc("length"), "path")
    return paths.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= k)


def salience(positions: DataFrame, rows: DataFrame, recurrence: DataFrame) -> DataFrame:
    """0.4 position + 0.3 length (half of that against the document's mean, 1 at most) + 0.3 recurrence (mean overlap with the neighbours, 0.3
    without any), and whether the event is a core event and a turning point. The parts are rounded first, so that sums have no noise."""
    whole = Window.partitionBy("doc_id")
    length = F.least(F.length("txt") / F.avg(F.length("txt")).over(whole), F.lit(2.0)) / 2
    met = positions.join(rows.select("doc_id", "idx", "d01", rounded(length, 9).alias("length")), ["doc_id", "idx"]).join(recurrence.select("doc_id", "idx", "n", "overlap"), ["doc_id", "idx"])
    again = rounded(F.when(F.col("n") > 0, F.col("overlap") / F.col("n")).otherwise(0.3), 9)
    met = met.withColumn("salience", rounded(F.col("position") * 0.4 + F.col("length") * 0.3 + again * 0.3, 3))
    core = F.col("d01").isin("激励事件", "高潮", "转折", "结局") & (F.col("salience") >= 0.7)
    turning = F.col("d01").isin("转折", "高潮") | (F.col("salience") >= 0.8)
    return met.select("doc_id", "idx", "salience", core.alias("core"), turning.alias("turning"))


def causal_types(edges: DataFrame) -> DataFrame:
    """Per segment of edges (doc_id, src, tgt, kind): conditional if any prevents, indirect if more enable than cause, else direct."""
    ends = edges.select("doc_id", F.explode(F.array("src", "tgt")).alias("idx"), "kind")
    n = lambda k: F.count_if(F.col("kind") == k)
    return ends.groupBy("doc_id", "idx").agg(F.when(n("PREVENT") > 0, "条件因果").when(n("ENABLE") > n("CAUSE"), "间接因果").otherwise("直接因果").alias("causal_type"))


def event_sequence(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes of causal edges in order, with their function and edge counts."""
    nodes = degrees(edges, rows).filter("in_degree + out_degree > 0").join(rows.select("doc_id", "idx", "d01", "loc", "year"), ["doc_id", "idx"])
    order = Window.partitionBy("doc_id").orderBy("idx")
    return nodes.select("doc_id", "idx", F.row_number().over(order).cast("long").alias("event_no"), event_function().alias("function"), "loc", "year", "in_degree", "out_degree")


def object_chains(rows: DataFrame, least: int = 2) -> DataFrame:
    """Clusters of imagery with at least `least` items: first, last, type by mode, and whether the type shifts."""
    per = rows.groupBy("doc_id", "cl", "itype").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first"), F.max("idx").alias("last"))
    out = per.groupBy("doc_id", "cl").agg(F.sum("n").alias("n"), F.min("first").alias("first_idx"), F.max("last").alias("last_idx"), F.max_by("itype", F.struct("n", -F.col("first"))).alias("itype"), (F.count(F.lit(1)) > 1).alias("shifts"))
    return out.filter(F.col("n") >= least)


# fixed values: what an emotion toward someone says about the relation
RELATION_OF = {
    "思念": "亲情", "眷恋": "亲情", "爱慕": "爱情", "心动": "爱情", "甜蜜": "爱情", "信任": "友情", "温暖": "友情", "坚定": "战友", "热血": "战友", "愤怒": "敌对", "仇恨": "敌对",
    "厌恶": "敌对", "敬畏": "上下级", "服从": "上下级", "敬佩": "师徒", "感激": "师徒", "羞涩": "暗恋", "期待": "暗恋", "默契": "合作", "协作": "合作",
}


def relation_of(emotion: Column) -> Column:
    """The relation of the first word, in order, that an emotion holds; null for none."""
    return F.coalesce(*(F.when(F.contains(emotion, F.lit(word)), F.lit(relation)) for word, relation in RELATION_OF.items()))


def network_edges(pairs: DataFrame, intensity: DataFrame, dialogue: DataFrame) -> DataFrame:
    """Strength of pairs: 0.4 co-occurrence / 10, 0.3 intensity / 10, 0.3 dialogue / 5, each 1 at most; the relation by the emotions between
    them (felt: the first that tells one, in intensity's rows), else by dialogue, else by co-occurrence."""
    rows = pairs.join(intensity, ["doc_id", "a", "b"], "left").join(dialogue, ["doc_id", "a", "b"], "left")
    part = lambda c, full, w: F.least(F.coalesce(F.col(c), F.lit(0)) / full, F.lit(1.0)) * w
    strength = rounded(part("n", 10, 0.4) + part("mean_intensity", 10, 0.3) + part("n_dialogue", 5, 0.3), 3)
    rows = rows.withColumn("strength", strength)
    by_count = F.when(F.coalesce("n_dialogue", F.lit(0)) >= 2, "合作").when(F.col("n") >= 3, "友情").otherwise("陌生")
    relation = F.when(F.col("strength") < 0.1, "陌生").otherwise(F.coalesce("felt", by_count))
    return rows.select("doc_id", "a", "b", "n", "strength", relation.alias("relation"))


def centrality(edges: DataFrame) -> DataFrame:
    """Per node of edges (doc_id, a, b, strength): number of partners and sum of strengths."""
    ends = edges.select("doc_id", F.explode(F.array("a", "b")).alias("who"), "strength")
    return ends.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("degree"), rounded(F.sum("strength"), 3).alias("weight"))


def communities(edges: DataFrame) -> DataFrame:
    """Members by relation label."""
    who = edges.select("doc_id", "relation", F.explode(F.array("a", "b")).alias("who"))
    return who.groupBy("doc_id", "relation").agg(F.array_join(F.sort_array(F.collect_set("who")), ",").alias("members"))


def entities(mentions: DataFrame) -> DataFrame:
    """Counts, first and last segment of each name."""
    return mentions.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))


def scene_presence(scenes: DataFrame, mentions: DataFrame) -> DataFrame:
    """How often each name is in each scene, from rows numbered by scene: an equality join on the segment, not a range join on the document."""
    return mentions.join(scenes.select("doc_id", "idx", "scene"), ["doc_id", "idx"]).groupBy("doc_id", "scene", "who").agg(F.count(F.lit(1)).alias("n"))


def narrative_speed(rows: DataFrame) -> DataFrame:
    """By length against the document's mean: scene with dialogue, ellipsis where the time text jumps, summary, else normal."""
    ratio = F.length("txt") / F.avg(F.length("txt")).over(Window.partitionBy("doc_id"))
    jumps = F.coalesce(F.col("time_txt").rlike("跳|年后|次日"), F.lit(False))
    kind = F.when((F.col("ratio") > 1.5) & F.col("d10").isNotNull(), "场景").when((F.col("ratio") < 0.2) & jumps, "省略").when(F.col("ratio") < 0.5, "概述").otherwise("正常")
    return rows.withColumn("ratio", ratio).select("doc_id", "idx", kind.alias("speed"))
