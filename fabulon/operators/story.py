"""Character, narrative and story-level summaries per document, and the export adapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabulon.functions.enums import TRAITS
from fabulon.functions.text import rounded

from .aggregates import half_split_trend, head_tail_means, mode_first_seen, moments


def order():
    """Rows of a document in order."""
    return Window.partitionBy("doc_id").orderBy("idx")


def polarity_score(column: str) -> Column:
    return F.when(F.col(column) == "positive", 1).when(F.col(column) == "negative", -1).otherwise(0)


def trajectories(mentions: DataFrame, mood: DataFrame, strong: int = 7) -> DataFrame:
    """Per character rows, mean intensity, key moments and final polarity."""
    met = mentions.join(mood, ["doc_id", "idx"])
    return met.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("intensity"), 6).alias("mean_intensity"), F.count_if(F.col("intensity") >= strong).alias("n_key"), F.max_by("polarity", "idx").alias("final_polarity"), F.sum(polarity_score("polarity")).cast("long").alias("balance"))


def agency(mentions: DataFrame, rows: DataFrame) -> DataFrame:
    """Share of a character's rows with an active function."""
    met = mentions.join(rows.select("doc_id", "idx", "d01"), ["doc_id", "idx"])
    active = F.col("d01").isin("激励事件", "高潮", "转折", "结局", "上升行动", "下降行动")
    return met.groupBy("doc_id", "who").agg(F.round(F.avg(F.when(active, 1.0).otherwise(0.0)), 6).alias("agency"))


def dominance(mentions: DataFrame) -> DataFrame:
    """Share of a document's mentions that fall to each character, and its rank."""
    n = mentions.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("doc_id").orderBy(F.desc("n"), "who")
    return n.select("doc_id", "who", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("doc_id")), 6).alias("share"), F.row_number().over(by).cast("long").alias("rank"))


def main_characters(mentions: DataFrame, rows: DataFrame, least: int = 3, share: float = 0.05, most: int = 15) -> DataFrame:
    """Characters with at least max(least, share of rows) mentions, `most` of a document."""
    total = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total"))
    n = mentions.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first_idx")).join(total, "doc_id").filter(F.col("n") >= F.greatest(F.lit(float(least)), F.col("total") * share))
    by = Window.partitionBy("doc_id").orderBy(F.desc("n"), "first_idx", "who")
    return n.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= most).select("doc_id", "rank", "who", "n")


def focalization(rows: DataFrame) -> DataFrame:
    """Dominant perspective, number of perspectives and of switches."""
    top = mode_first_seen(rows, "persp").select("doc_id", F.col("value").alias("dominant"))
    n = rows.groupBy("doc_id").agg(F.count_distinct("persp").alias("n_types"), F.count_if(F.col("sw") == 0).alias("n_switches"))
    return top.join(n, "doc_id")


def timeline(rows: DataFrame) -> DataFrame:
    """Steps forward and back between the years that rows tell."""
    told = rows.filter("year is not null").withColumn("before", F.lag("year").over(order()))
    return told.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_years"), F.count_if(F.col("year") > F.col("before")).alias("n_forward"), F.count_if(F.col("year") < F.col("before")).alias("n_back"))


def pace(rows: DataFrame) -> DataFrame:
    out = moments(rows, "pace").join(half_split_trend(rows, "pace"), "doc_id")
    kind = F.when(F.col("mean") >= 3.5, "fast").when(F.col("mean") <= 2.5, "slow").otherwise("medium")
    return out.select("doc_id", "mean", "variance", "trend", kind.alias("kind"))


def emotion_arc(mood: DataFrame) -> DataFrame:
    """Polarity at the head and tail (a tenth of the rows, 3 at least), trend, variance, peak, and the shape of the arc; too short below 5 rows."""
    by = Window.partitionBy("doc_id")
    rows = mood.withColumns({"score": polarity_score("polarity"), "rn": F.row_number().over(by.orderBy("idx")), "size": F.count(F.lit(1)).over(by)})
    edge = F.greatest(F.lit(3), F.floor(F.col("size") / 10))
    mean = lambda c: F.sum(F.when(c, F.col("score"))) / F.count_if(c)
    out = rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), mean(F.col("rn") <= edge).alias("head"), mean(F.col("rn") > F.col("size") - edge).alias("tail"), F.sum("score").alias("total"), F.sum(F.col("score") * F.col("score")).alias("squares"),
        F.count_if(F.col("score") < 0).alias("neg"), F.count_if(F.col("score") > 0).alias("pos"), F.max("intensity").alias("peak_intensity"), F.min_by("idx", F.struct(-F.coalesce("intensity", F.lit(0)), F.col("idx"))).alias("peak_idx"),
    )
    out = out.withColumns({"trend": F.col("tail") - F.col("head"), "variance": F.col("squares") / F.col("n") - (F.col("total") / F.col("n")) * (F.col("total") / F.col("n")), "neg": F.col("neg") / F.col("n"), "pos": F.col("pos") / F.col("n")})
    side = lambda c: F.when(F.col(c) > 0.3, "positive").when(F.col(c) < -0.3, "negative").otherwise("mixed/neutral")
    out = out.withColumns({"start_polarity": side("head"), "end_polarity": side("tail")})
    end, neg, pos = F.col("end_polarity"), F.col("neg"), F.col("pos")
    open_ = end == "mixed/neutral"
    pattern = (
        F.when(F.col("n") < 5, "数据不足").when((neg > 0.5) & ((end == "negative") | (F.col("trend") < -0.1)), "悲剧弧线（压抑→下行）")
        .when((pos > 0.5) & ((end == "positive") | (F.col("trend") > 0.1)), "喜剧弧线（上升→圆满）")
        .when((F.col("variance") > 0.3) & (open_ | ((neg > 0.3) & (pos > 0.3))), "悲喜剧弧线（起伏→释然）").when(F.col("variance") > 0.5, "波动型弧线（大起大落）")
        .when(open_ & (neg > 0.3), "悲剧弧线（余韵悠长）").when(open_, "开放式结局（余韵悠长）").otherwise("平稳型弧线")
    )
    known = lambda c: F.when(F.col("n") >= 5, c)
    confidence = F.when(F.col("n") >= 5, rounded(F.least(F.lit(0.9), 0.4 + F.col("n") * 0.01), 2)).otherwise(0.0)
    return out.select("doc_id", pattern.alias("pattern"), *(known(F.col(c)).alias(c) for c in ("start_polarity", "end_polarity", "peak_intensity", "peak_idx")), known(rounded(F.col("trend"), 2)).alias("trend"), known(rounded(F.col("variance"), 2)).alias("variance"), confidence.alias("confidence"))


def reader_experience(rows: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    part = lambda c: F.round(F.count_if(F.coalesce(c, F.lit(False))) / n, 6)
    return rows.groupBy("doc_id").agg(part(F.col("d06").isin("隐藏", "误导")).alias("suspense"), part(F.col("inten") >= 7).alias("tension"), part(F.col("emo_pol").isin("positive", "negative")).alias("involvement"))


def times_and_places(rows: DataFrame) -> DataFrame:
    """Distinct times and places of a document with ids by first occurrence."""
    one = rows.select("doc_id", "idx", F.explode(F.array(F.struct(F.lit("time").alias("kind"), F.col("season").alias("value")), F.struct(F.lit("place").alias("kind"), F.col("loc").alias("value")))).alias("v")).select("doc_id", "idx", "v.kind", "v.value").filter("value is not null")
    first = one.groupBy("doc_id", "kind", "value").agg(F.min("idx").alias("first_idx"))
    return first.withColumn("no", F.row_number().over(Window.partitionBy("doc_id", "kind").orderBy("first_idx", "value")).cast("long"))


def plot_buckets(rows: DataFrame) -> DataFrame:
    """Rows of each document by thirds of the text and class of event."""
    from .sequence import event_function

    n, rn = F.count(F.lit(1)).over(Window.partitionBy("doc_id")), F.row_number().over(order())
    third = F.floor((rn - 1) * 3 / n).cast("long")
    return rows.withColumn("third", third).withColumn("fn", event_function()).groupBy("doc_id", "third", "fn").agg(F.count(F.lit(1)).alias("n"))


def story_graph(**products: DataFrame) -> DataFrame:
    """One JSON document per document id from flat products; a product that lacks a document is an empty list."""
    out = None
    for name, rows in products.items():
        columns = [c for c in rows.columns if c != "doc_id"]
        part = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
        out = part if out is None else out.join(part, "doc_id", "full_outer")
    return out.select("doc_id", F.to_json(F.struct(*(F.coalesce(F.col(n), F.array()).alias(n) for n in products))).alias("graph"))


def redacted(rows: DataFrame, hidden: tuple[str, ...] = ("txt", "text", "anchor", "quote", "source")) -> DataFrame:
    """Text columns give way to a placeholder and their length."""
    out = rows
    for c in rows.columns:
        if any(h in c for h in hidden) and dict(rows.dtypes)[c] == "string":
            out = out.withColumn(f"{c}_length", F.length(c).cast("long")).withColumn(c, F.when(F.col(c).isNotNull(), F.lit("[redacted]")))
    return out


def traits(items: DataFrame, lexicon: dict[str, tuple[float, list[str]]] = TRAITS, most: int = 5) -> DataFrame:
    """The strongest traits of each character from weighted texts (doc_id, who, text, weight): every key word that a text holds counts, by the trait's weight."""
    hits = F.array(*(F.struct(F.lit(t).alias("trait"), sum(F.contains(F.col("text"), F.lit(w)).cast("int") for w in ws).alias("hits"), F.lit(by).alias("by")) for t, (by, ws) in lexicon.items()))
    rows = items.select("doc_id", "who", "weight", F.explode(hits).alias("h")).filter("h.hits > 0")
    score = rows.groupBy("doc_id", "who", F.col("h.trait").alias("trait")).agg(F.round(F.sum(F.col("h.hits") * F.col("weight") * F.col("h.by")), 6).alias("score"))
    by = Window.partitionBy("doc_id", "who").orderBy(F.desc("score"), "trait")
    return score.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= most)


def biographies(mentions: DataFrame, rows: DataFrame, mood: DataFrame, edges: DataFrame, most: int = 8) -> DataFrame:
    """Main characters with their span, turning rows, and strongest relations (as text, `most` at most)."""
    main = main_characters(mentions, rows)
    met = mentions.join(rows.select("doc_id", "idx", "d01"), ["doc_id", "idx"]).join(mood, ["doc_id", "idx"])
    life = met.groupBy("doc_id", "who").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.count_if(F.col("d01").isin("转折", "高潮")).alias("n_turning"), F.round(F.avg("intensity"), 6).alias("mean_intensity"))
    both = edges.select("doc_id", F.col("a").alias("who"), F.col("b").alias("other"), "strength").unionByName(edges.select("doc_id", F.col("b").alias("who"), F.col("a").alias("other"), "strength"))
    by = Window.partitionBy("doc_id", "who").orderBy(F.desc("strength"), "other")
    near = both.withColumn("rn", F.row_number().over(by)).filter(F.col("rn") <= most).groupBy("doc_id", "who").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "other"))), lambda s: s["other"]), ",").alias("relations"))
    return main.join(life, ["doc_id", "who"]).join(near, ["doc_id", "who"], "left").fillna("", ["relations"])


def genre(scores: DataFrame) -> DataFrame:
    """The genre of the highest score (ties by name) and its share of all scores."""
    by = Window.partitionBy("doc_id").orderBy(F.desc("score"), "genre")
    total = F.sum("score").over(Window.partitionBy("doc_id"))
    return scores.withColumn("confidence", F.round(F.col("score") / total, 6)).withColumn("rn", F.row_number().over(by)).filter("rn = 1").select("doc_id", "genre", "confidence")


def event_chain(scenes: DataFrame) -> DataFrame:
    """Scenes of a story as events in order, from rows numbered by scene: function by mode (ties: first met), first known place and time."""
    per = scenes.groupBy("doc_id", "scene", "d01").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first"))
    label = per.groupBy("doc_id", "scene").agg(F.max_by("d01", F.struct("n", -F.col("first"))).alias("label"))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("idx"))).alias(c)
    out = scenes.groupBy("doc_id", "scene").agg(F.min("idx").alias("start"), F.max("idx").alias("end"), F.count(F.lit(1)).alias("duration"), first("loc"), first("season"), F.max("inten").alias("max_intensity"))
    return out.join(label, ["doc_id", "scene"]).withColumn("event_id", F.format_string("evt_%03d", "scene")).drop("scene")


def rhetorical_relations(edges: DataFrame) -> DataFrame:
    """Causal edges as numbered relations of events."""
    by = Window.partitionBy("doc_id").orderBy("src", "tgt", "edge_type")
    kind = F.when(F.col("edge_type") == "CAUSE", "cause").when(F.col("edge_type") == "ENABLE", "enablement").when(F.col("edge_type") == "PREVENT", "prevention").otherwise("elaboration")
    return edges.select("doc_id", F.format_string("rel_%03d", F.row_number().over(by)).alias("relation_id"), kind.alias("type"), "src", "tgt", "confidence")


def participants(entities: DataFrame) -> DataFrame:
    """Names as numbered participants, the most mentioned first."""
    by = Window.partitionBy("doc_id").orderBy(F.desc("n"), "first_idx", "who")
    return entities.withColumn("participant_id", F.format_string("p_%03d", F.row_number().over(by))).select("doc_id", "participant_id", "who", "n", "first_idx", "last_idx")


def object_threads(chains: DataFrame) -> DataFrame:
    """Chains of objects as numbered threads, in order of their first segment."""
    by = Window.partitionBy("doc_id").orderBy("first_idx", "cl")
    return chains.withColumn("thread_id", F.format_string("obj_%03d", F.row_number().over(by))).select("doc_id", "thread_id", "cl", "itype", "n")
