"""How a text is told: suspense, density of techniques, style, use of time, fitness of structure, and edges for texts without relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabulon.functions import enums as E

from . import sequence as Q
from .aggregates import act_ranges, numbered
from .joins import paired_first_in

# fixed values: words of a question, of a look back and of continuity in time
QUESTIONS = ("为什么", "怎么", "究竟", "难道", "莫非", "到底", "谁知", "不料", "竟然", "居然", "未曾想", "殊不知", "谁曾想", "岂料", "偏偏")
LOOKS_BACK = ("回忆", "回想", "多年前", "曾经", "那年", "那时", "小时候", "童年", "往事", "昔日", "从前", "记忆中", "恍如隔世", "追溯")
GOES_ON = ("第二天", "次日", "随后", "接着", "然后", "不久", "片刻", "一会儿", "同时", "其间", "之后", "之前")
# fixed values: functions that confirm a beat
SIGNALS = {"catalyst": ("激励事件",), "midpoint": ("转折", "高潮"), "all_is_lost": ("下降行动", "转折"), "finale": ("结局",)}
KEY_FUNCTIONS = ("激励事件", "转折", "高潮")


def holds_any(c: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w)), F.lit(False))


def per_document(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).select("doc_id", F.lit(name).alias("name"), "n")


def suspense(rows: DataFrame, refs: DataFrame, words: tuple[str, ...] = QUESTIONS) -> DataFrame:
    """Per document: hidden rows, those that ask, runs, rows never resolved, pairs of plant and payoff, and the strength of suspense."""
    base = rows.groupBy("doc_id").agg(F.count_if(F.col("d06") == "隐藏").alias("n_hidden"), F.count_if((F.col("d06") == "隐藏") & holds_any(F.col("txt"), words)).alias("n_questions"))
    parts = per_document(Q.serial_runs(rows), "n_runs").unionByName(per_document(Q.unresolved(rows), "n_unresolved")).unionByName(per_document(refs.filter("rel = '伏笔-回收'"), "n_pairs"))
    wide = parts.groupBy("doc_id").pivot("name", ["n_runs", "n_unresolved", "n_pairs"]).agg(F.sum("n"))
    out = base.join(wide, "doc_id", "left").fillna(0, ["n_runs", "n_unresolved", "n_pairs"])
    strength = F.when((F.col("n_hidden") >= 10) | (F.col("n_pairs") >= 5), "high").when((F.col("n_hidden") >= 5) | (F.col("n_pairs") >= 2), "moderate").otherwise("low")
    return out.withColumn("intensity", strength)


def technique_density(rows: DataFrame) -> DataFrame:
    """Instances of transitions, suspense, montage and hooks, their number per segment, and the style that it stands for."""
    found = [
        per_document(Q.time_transitions(rows), "transition"), per_document(Q.location_transitions(rows), "transition"), per_document(Q.function_bigrams(rows), "transition"),
        per_document(rows.filter("d06 = '隐藏'"), "suspense"), per_document(Q.parallel_montage(rows), "montage"), per_document(Q.cross_montage(rows), "montage"),
        per_document(Q.contrast_montage(rows), "montage"), Q.hooks(rows).select("doc_id", F.lit("hook").alias("name"), F.col("n_total").alias("n")),
    ]
    parts = found[0]
    for p in found[1:]:
        parts = parts.unionByName(p)
    kinds = ["transition", "suspense", "montage", "hook"]
    wide = parts.groupBy("doc_id").pivot("name", kinds).agg(F.sum("n"))
    out = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).join(wide, "doc_id", "left").fillna(0, kinds)
    out = out.withColumn("total", sum(F.col(k) for k in kinds)).withColumn("density", F.round(F.col("total") / F.col("rows"), 6))
    style = F.when(F.col("density") >= 3.0, "dense").when(F.col("density") >= 1.5, "balanced").otherwise("plain")
    return out.select("doc_id", *kinds, "density", style.alias("style"))


def perspectives(rows: DataFrame) -> DataFrame:
    """Per document the two most frequent perspectives (ties by first row), their shares, and the switches. Front matter is left out by the caller."""
    per = rows.filter("persp is not null").groupBy("doc_id", "persp").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first"), F.count_if(F.col("sw") == 0).alias("switches"))
    by = Window.partitionBy("doc_id").orderBy(F.desc("n"), "first")
    ranked = per.withColumn("rn", F.row_number().over(by))
    total = F.sum("n")
    return ranked.groupBy("doc_id").agg(
        F.max(F.when(F.col("rn") == 1, F.col("persp"))).alias("dominant"), (F.max(F.when(F.col("rn") == 1, F.col("n"))) / total).alias("ratio"),
        F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("n"))) / total, F.lit(0.0)).alias("second"), F.count_if(F.col("persp") != "多视角").alias("n_real"),
        F.sum("switches").alias("n_switches"), F.coalesce(F.max(F.when(F.col("persp") == "不可靠叙述者", F.col("n"))), F.lit(0)).alias("n_unreliable"), total.alias("total"),
    )


def narrative_style(rows: DataFrame) -> DataFrame:
    """Style by perspective: several voices only with real switches and no perspective of 70 per cent."""
    p = perspectives(rows)
    several = (F.col("n_switches") >= 2) & (F.col("n_real") >= 2) & (F.col("ratio") < 0.7) & (F.col("second") >= 0.1)
    style = F.when(several, "多视角叙事").when((F.col("ratio") > 0.5) & (F.col("dominant") == "第一人称"), "第一人称叙述").when((F.col("ratio") > 0.5) & F.col("dominant").isin("第三人称有限", "第三人称全知"), F.concat("dominant", F.lit("视角")))
    style = style.when(F.col("ratio") > 0.5, F.concat("dominant", F.lit("主导"))).otherwise("混合视角")
    sure = F.when(F.col("n_switches") == 0, F.least("ratio", F.lit(0.95))).otherwise(F.greatest(F.lit(0.5), 1.0 - F.col("n_switches") / F.col("total")))
    return p.select("doc_id", style.alias("style"), (F.col("n_switches") == 0).alias("is_linear"), F.round(sure, 6).alias("confidence"))


def focal_complexity(rows: DataFrame) -> DataFrame:
    p = perspectives(rows)
    kind = F.when((F.col("ratio") >= 0.95) & (F.col("n_switches") == 0), "single").when((F.col("ratio") >= 0.8) & (F.col("n_switches") <= F.col("total") * 0.1), "occasional").otherwise("multiple")
    return p.select("doc_id", "dominant", kind.alias("complexity"), F.round(F.col("n_switches") / F.col("total"), 6).alias("switch_rate"), (F.col("n_unreliable") > F.col("total") * 0.1).alias("unreliable"))


def time_structure(rows: DataFrame) -> DataFrame:
    """Looks back and jumps among the rows (doc_id, idx, time) that tell a time, and the structure that they make; three such rows at least."""
    told = Q.with_previous(rows.filter("time is not null and time <> ''"), "time")
    jump = F.col("prev").isNotNull() & ~holds_any(F.col("time"), GOES_ON) & (F.col("time") != F.col("prev_time"))
    n = told.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_told"), F.count_if(holds_any(F.col("time"), LOOKS_BACK)).alias("n_back"), F.count_if(jump).alias("n_jumps")).filter("n_told >= 3")
    kind = F.when((F.col("n_back") >= 3) & (F.col("n_jumps") >= 8), "nonlinear").when((F.col("n_back") >= 3) | ((F.col("n_back") >= 1) & (F.col("n_jumps") >= 5)), "flashback").when(F.col("n_jumps") >= 8, "jumping").when(F.col("n_back") >= 1, "linear with memories").otherwise("linear")
    return n.select("doc_id", "n_back", "n_jumps", kind.alias("kind"), F.round(F.least(F.lit(0.95), 0.4 + (F.col("n_back") + F.col("n_jumps")) * 0.03), 6).alias("confidence"))


def reader_type(mood: DataFrame, strong: int = 7) -> DataFrame:
    """What reading feels like: shares of polarities and of strong rows, and the type that they make."""
    n = F.count(F.lit(1))
    share = lambda p: F.count_if(F.col("polarity") == p) / n
    high = lambda p: F.count_if((F.col("polarity") == p) & (F.col("intensity") >= strong))
    s = mood.groupBy("doc_id").agg(share("negative").alias("neg"), share("positive").alias("posi"), (F.count_if(F.col("intensity") >= strong) / n).alias("strong"), high("positive").alias("high_pos"), high("negative").alias("high_neg"))
    neg, pos, top = F.col("neg"), F.col("posi"), F.col("strong")
    kind = F.when((neg > 0.5) & (top > 0.3), "虐心").when((pos > 0.5) & (top < 0.3), "治愈").when((pos > 0.4) & (F.col("high_pos") > F.col("high_neg")), "燃").when(pos > 0.5, "甜").when((neg > 0.3) & (pos > 0.3), "虐甜混合").when(neg > 0.4, "压抑").otherwise("复杂/中性")
    return s.select("doc_id", F.round(neg, 6).alias("negative"), F.round(pos, 6).alias("positive"), F.round(top, 6).alias("strong"), kind.alias("kind"))


def structure_health(rows: DataFrame) -> DataFrame:
    """Acts that are missing (an inciting event counts as derived when it isn't marked), share of rising action, and fitness."""
    acts = act_ranges(rows).groupBy("doc_id").agg(F.collect_set("act").alias("acts"), F.sum(F.when(F.col("act") == "rising_action", F.col("labelled")).otherwise(0)).alias("rising"))
    out = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).join(acts, "doc_id", "left")
    out = out.withColumn("acts", F.coalesce("acts", F.array().cast("array<string>"))).withColumn("rising_share", F.round(F.coalesce("rising", F.lit(0)) / F.col("n") * 100, 1))
    missing = F.size(F.array_except(F.array(*(F.lit(a) for a in E.ACT_ORDER if a != "inciting_incident")), "acts")).cast("long")
    return out.withColumn("n_missing", missing).select("doc_id", "n_missing", "rising_share", F.when((F.col("rising_share") >= 20) & (F.col("n_missing") <= 1), "healthy").otherwise("needs_review").alias("health"))


def beat_signals(rows: DataFrame) -> DataFrame:
    """Key beats whose stretch of the text holds a function that confirms them, and their share in per cent."""
    rows = numbered(rows).withColumn("pos", F.col("rn") - 1)
    hits = []
    for name, a, z in E.BEATS:
        if name in SIGNALS:
            inside = F.col("pos").between((F.col("n") * a).cast("int"), F.least((F.col("n") * z).cast("int"), (F.col("n") - 1).cast("int")))
            hits.append(F.max(F.when(inside & F.col("d01").isin(*SIGNALS[name]), 1).otherwise(0)).alias(name))
    out = rows.groupBy("doc_id").agg(*hits)
    return out.select("doc_id", *(F.col(n).cast("long").alias(n) for n in SIGNALS), F.round(sum(F.col(n) for n in SIGNALS) / len(SIGNALS) * 100, 1).alias("completeness"))


def narrative_levels(rows: DataFrame) -> DataFrame:
    """Rows by level of narration (`level`; null and empty count as unknown)."""
    return rows.groupBy("doc_id", F.coalesce(F.when(F.col("level") != "", F.col("level")), F.lit("unknown")).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def degraded_edges(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Weak edges for documents that have no causal edge: planted and revealed rows in queue order, and neighbours among key functions."""
    rows = rows.join(edges.select("doc_id").distinct(), "doc_id", "left_anti").filter("d01 is not null")
    pairs = paired_first_in(rows).withColumn("source", F.lit("reveal"))
    key = rows.filter(F.col("d01").isin(*KEY_FUNCTIONS)).withColumn("tgt", F.lead("idx").over(Q.order())).filter("tgt is not null").select("doc_id", F.col("idx").alias("src"), "tgt", F.lit("function").alias("source"))
    return pairs.unionByName(key).withColumn("edge_type", F.lit("ENABLE")).withColumn("confidence", F.lit(0.5))


def node_attributes(rows: DataFrame) -> DataFrame:
    """Time, place, tone, function, intensity and the sorted distinct participants of each segment."""
    who = F.array_sort(F.array_distinct(F.array_compact(F.array("s1", "s2", "emo_tgt"))))
    return rows.select("doc_id", "idx", "year", "loc", F.col("emo").alias("tone"), "d01", "inten", F.array_join(who, ",").alias("participants"))
