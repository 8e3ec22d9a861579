"""Portraits of characters from what they say: timeline, decisions, voice, quotes, desire and an appraisal in words.

`said` is (doc_id, idx, who, pattern, verb, turn): one row for each voice item of a segment, with the speaker's canonical name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .techniques import holds_any

UNCLEAR = "（未明确）"
# fixed values: kinds of key moments, and words of a decision
MOMENTS = {"激励事件": "inciting_incident", "高潮": "climax", "转折": "turning_point", "下降行动": "falling_action", "结局": "resolution"}
DECISIONS = ("决定", "选择", "必须", "只能", "只好", "宁愿", "决心", "决意", "放弃", "坚持", "答应", "拒绝", "同意", "反对", "承诺", "发誓", "计划", "打算", "准备", "考虑", "犹豫", "纠结", "权衡")


def of(*order):
    return Window.partitionBy("doc_id", "who").orderBy(*order)


def joined(value: str, rank: str = "rn", sep: str = "|"):
    """Values of a group in order of a rank, as text."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(rank, value))), lambda s: s[value]), sep)


def timeline(mentions: DataFrame, rows: DataFrame, said: DataFrame) -> DataFrame:
    """Rows in which a character takes part: what happens there, whether the character speaks, and how much it weighs."""
    speaks = said.groupBy("doc_id", "idx", "who").agg(F.count(F.lit(1)).alias("n_said"))
    out = mentions.join(rows.select("doc_id", "idx", "d01", "inten"), ["doc_id", "idx"]).join(speaks, ["doc_id", "idx", "who"], "left").fillna(0, ["n_said"])
    kind = F.lit(None).cast("string")
    for name, value in MOMENTS.items():
        kind = F.when(F.col("d01") == name, F.lit(value)).otherwise(kind)
    weight = F.when(F.col("d01").isin(*MOMENTS) | (F.col("inten") >= 7), "high").when(F.col("n_said") > 0, "medium").otherwise("low")
    return out.select("doc_id", "who", "idx", "d01", "inten", kind.alias("moment"), weight.alias("significance"), (F.col("n_said") > 0).alias("has_dialogue"))


def decisions(said: DataFrame, words: tuple[str, ...] = DECISIONS, most: int = 10) -> DataFrame:
    """The first `most` segments in which a character says a word of a decision, each with the first such line."""
    hit = said.filter(holds_any(F.col("pattern"), words))
    first = hit.groupBy("doc_id", "who", "idx").agg(F.min_by("pattern", "item").alias("decision"))
    return first.withColumn("no", F.row_number().over(of("idx")).cast("long")).filter(F.col("no") <= most)


def voices(said: DataFrame, most: int = 10) -> DataFrame:
    """Dominant verb of speech (ties: first said), mean length of turns, number of turns, and the first patterns."""
    verbs = said.filter("verb is not null").groupBy("doc_id", "who", "verb").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("idx", "item")).alias("first"))
    verbs = verbs.withColumn("rn", F.row_number().over(of(F.desc("n"), "first")))
    verbs = verbs.groupBy("doc_id", "who").agg(F.max(F.when(F.col("rn") == 1, F.col("verb"))).alias("verb"), F.count(F.lit(1)).alias("n_verbs"))
    turns = said.groupBy("doc_id", "who").agg(F.round(F.coalesce(F.avg(F.when(F.col("turn") > 0, F.col("turn"))), F.lit(0.0)), 6).alias("mean_length"), F.count_if(F.col("turn") > 0).alias("n_turns"))
    first = said.filter("pattern <> ''").withColumn("rn", F.row_number().over(of("idx", "item"))).filter(F.col("rn") <= most).groupBy("doc_id", "who").agg(joined("pattern").alias("patterns"))
    return turns.join(verbs, ["doc_id", "who"], "left").join(first, ["doc_id", "who"], "left")


def quotes(said: DataFrame, golden: DataFrame, most: int = 10, least: int = 8, least_golden: int = 5, size: int = 100) -> DataFrame:
    """The first `most` quotes of a character: golden lines (doc_id, idx, text) of segments in which the character speaks, then long patterns."""
    heard = said.select("doc_id", "idx", "who").distinct()
    lines = golden.filter(F.length("text") >= least_golden).join(heard, ["doc_id", "idx"]).select("doc_id", "who", "idx", F.lit(0).alias("at"), F.lit(0).alias("item"), "text", F.lit("golden_line").alias("kind"))
    own = said.filter(F.length("pattern") >= least).select("doc_id", "who", "idx", F.lit(1).alias("at"), "item", F.col("pattern").alias("text"), F.lit("dialogue").alias("kind"))
    both = lines.unionByName(own).withColumn("text", F.left("text", F.lit(size)))
    return both.withColumn("no", F.row_number().over(of("idx", "at", "item", "text")).cast("long")).filter(F.col("no") <= most).select("doc_id", "who", "no", "idx", "kind", "text")


def desires(mentions: DataFrame, rows: DataFrame, tags: DataFrame, traits: DataFrame) -> DataFrame:
    """What a character pursues (themes of inciting and climactic rows), is opposed by (of turns and falls), and is driven by (first trait).

    Where layers carry no themes on the structure, pass no tags: pursuit and opposition are then unclear for all.
    """
    met = mentions.join(rows.select("doc_id", "idx", "d01"), ["doc_id", "idx"]).join(tags, ["doc_id", "idx"])
    aim = F.when(F.col("d01").isin("激励事件", "高潮") & (F.col("pos") < 2), "pursues").when(F.col("d01").isin("转折", "下降行动") & (F.col("pos") < 1), "opposed_by")
    first = met.withColumn("aim", aim).filter("aim is not null").groupBy("doc_id", "who", "aim", "tag").agg(F.min(F.struct("idx", "pos")).alias("first"))
    first = first.withColumn("rn", F.row_number().over(Window.partitionBy("doc_id", "who", "aim").orderBy("first"))).filter(F.col("rn") <= F.when(F.col("aim") == "pursues", 3).otherwise(2))
    wide = first.groupBy("doc_id", "who").pivot("aim", ["pursues", "opposed_by"]).agg(F.when(F.count("tag") > 0, joined("tag")))
    top = traits.filter("rank = 1").select("doc_id", "who", F.col("trait").alias("driven_by"))
    return mentions.select("doc_id", "who").distinct().join(wide, ["doc_id", "who"], "left").join(top, ["doc_id", "who"], "left").fillna(UNCLEAR, ["pursues", "opposed_by", "driven_by"])


def appraisals(line: DataFrame, decided: DataFrame, traits: DataFrame, rows: DataFrame) -> DataFrame:
    """A sentence for each character: part in the story, presence, key moments, decisions and first traits."""
    total = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total"))
    life = line.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"), F.count("moment").alias("n_moments"))
    made = decided.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n_decisions"))
    own = traits.filter("rank <= 3").groupBy("doc_id", "who").agg(joined("trait", "rank", "、").alias("own"))
    rows = life.join(total, "doc_id").join(made, ["doc_id", "who"], "left").fillna(0, ["n_decisions"]).join(own, ["doc_id", "who"], "left")
    role = F.when(F.col("n") >= F.col("total") * 0.3, "主角").when(F.col("n") >= F.col("total") * 0.1, "配角").otherwise("次要角色")
    kind = F.when(F.col("n") >= F.col("total") * 0.2, "圆形").otherwise("扁平")
    part = lambda cond, *cs: F.when(cond, F.concat(*cs)).otherwise("")
    text = F.concat(
        "who", F.lit("，"), role, F.lit("，"), kind, F.lit("人物。全书出场"), F.col("n").cast("string"), F.lit("段"),
        part(F.col("n_moments") > 0, F.lit("，参与"), F.col("n_moments").cast("string"), F.lit("个关键时刻")),
        part(F.col("n_decisions") > 0, F.lit("，做出"), F.col("n_decisions").cast("string"), F.lit("个关键决策")),
        part(F.col("own").isNotNull(), F.lit("。性格特征："), F.col("own")), F.lit("。"),
    )
    return rows.select("doc_id", "who", role.alias("role"), kind.alias("kind"), text.alias("appraisal"))


# fixed values: functions in which a character acts or is acted upon, weights of complexity
ACTIVE, PASSIVE = ("激励事件", "高潮", "转折", "结局", "上升行动", "下降行动"), ("背景铺垫", "过渡")
COMPLEXITY = {"traits": 0.4, "variance": 0.3, "presence": 0.3}
ROUND, POINTED = 0.6, 0.3


def halves(rows: DataFrame) -> DataFrame:
    """rows (doc_id, who, idx) with their number and how many there are for the character."""
    return rows.withColumn("rn", F.row_number().over(of("idx"))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "who")))


def arcs(mentions: DataFrame, mood: DataFrame) -> DataFrame:
    """Arc of each character's polarity: trend between the halves of its rows, variance, and the last row."""
    from .story import polarity_score

    rows = halves(mentions.join(mood, ["doc_id", "idx"]).filter("polarity is not null").withColumn("score", polarity_score("polarity")))
    early = F.col("rn") <= F.floor(F.col("n") / 2)
    half = lambda c: F.coalesce(F.avg(F.when(~early, F.col(c))), F.lit(0.0)) - F.coalesce(F.avg(F.when(early, F.col(c))), F.lit(0.0))
    out = rows.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"), half("score").alias("trend"), F.var_pop("score").alias("variance"), F.max_by("score", "idx").cast("long").alias("final"), half("intensity").alias("intensity_trend"))
    out = out.withColumns({c: F.round(c, 6) for c in ("trend", "variance", "intensity_trend")})  # sums in another order give the same class
    kind = F.when((F.col("trend") > 0.3) & (F.col("final") > 0), "rise").when((F.col("trend") < -0.3) & (F.col("final") < 0), "fall").when(F.col("variance") > 0.5, "wave").when((F.abs("trend") < 0.2) & (F.col("variance") < 0.3), "level").otherwise("mixed")
    return out.select("doc_id", "who", kind.alias("arc"), "trend", "variance", "final", "intensity_trend", F.round(F.least(F.lit(1.0), F.col("n") / 20), 6).alias("confidence"))


def agency_curves(line: DataFrame) -> DataFrame:
    """Shares of rows of a timeline in which a character acts (by function or by speaking), is acted upon or looks on, and the trend of acting."""
    level = F.when(F.col("d01").isin(*ACTIVE) | F.col("has_dialogue"), "active").when(F.col("d01").isin(*PASSIVE), "passive").otherwise("observer")
    rows = halves(line.withColumn("level", level))
    early = F.col("rn") <= F.floor(F.col("n") / 2)
    acts = F.when(F.col("level") == "active", 1.0).otherwise(0.0)
    part = lambda v: F.round(F.count_if(F.col("level") == v) / F.count(F.lit(1)), 6).alias(v)
    out = rows.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"), part("active"), part("passive"), part("observer"), F.avg(F.when(early, acts)).alias("first"), F.avg(F.when(~early, acts)).alias("second"))
    trend = F.when(F.col("n") < 4, "unknown").when(F.col("second") > F.col("first") + 0.1, "rise").when(F.col("second") < F.col("first") - 0.1, "fall").otherwise("level")
    return out.select("doc_id", "who", "n", "active", "passive", "observer", trend.alias("trend"))


def roles(curves: DataFrame, rows: DataFrame) -> DataFrame:
    """Part that a character plays, from its agency and presence."""
    total = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("total"))
    out = curves.join(total, "doc_id").withColumn("presence", F.col("n") / F.col("total"))
    role = F.when((F.col("active") > 0.5) & (F.col("presence") > 0.3), "主要行动者").when(F.col("passive") > 0.5, "阻碍者").when(F.col("presence") < 0.3, "辅助者").otherwise("未知")
    gaps = F.when(F.col("presence") < 0.5, F.floor((0.5 - F.col("presence")) * 10 + 1e-9) + 1).otherwise(0).cast("long")
    return out.select("doc_id", "who", F.round("presence", 6).alias("presence"), role.alias("role"), gaps.alias("gaps"))


def complexity(arc: DataFrame, traits: DataFrame, curves: DataFrame) -> DataFrame:
    """Score of complexity from the number of traits, the variance of the arc and presence; flat, pointed or round; static or dynamic."""
    n = traits.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n_traits"))
    rows = arc.join(curves.select("doc_id", "who", "n"), ["doc_id", "who"]).join(n, ["doc_id", "who"], "left").fillna(0, ["n_traits"])
    part = lambda c, full, name: F.least(F.col(c) / full, F.lit(1.0)) * COMPLEXITY[name]
    score = F.round(part("n_traits", 3, "traits") + part("variance", 0.5, "variance") + part("n", 20, "presence"), 3)
    shape = F.when(F.col("score") >= ROUND, "圆形").when(F.col("score") >= POINTED, "尖形").otherwise("扁平")
    return rows.withColumn("score", score).select("doc_id", "who", "score", shape.alias("shape"), ((F.col("variance") > 0.3) & (F.col("n") > 10)).alias("dynamic"))


def dialogue_dominance(said: DataFrame) -> DataFrame:
    """Share of a document's voice items that are a character's."""
    n = said.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("doc_id"))
    return n.select("doc_id", "who", "n", F.round(share, 6).alias("ratio"), F.when(share >= 0.4, "lead").when(share >= 0.2, "major").otherwise("minor").alias("level"))
