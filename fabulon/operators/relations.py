"""Relations between segments by rule: all rules in one pass over the rows of a document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rules in the order in which the first of equal relations stands: (relation, source, confidence).
RULES = [("时序", "rule", 0.7), ("对比", "rule", 0.7), ("呼应", "rule", 0.7), ("呼应", "rule_enhanced", 0.5), ("呼应", "rule_enhanced", 0.5), ("伏笔-回收", "rule_enhanced", 0.6)]
#: Rows that a task takes: each gives some six occurrences, which are sorted several times.
ROWS = 1 << 16
JUMP, SWITCH, THEME, TARGET, IMAGE, PLANT = range(6)


def tasks(rows: DataFrame) -> int:
    """Into how many parts rows are dealt by document: so many that one grows with no input, and one for each core at least. A pass counts the rows."""
    return max(-(-rows.count() // ROWS), rows.sparkSession.sparkContext.defaultParallelism)


def rule_relations(rows: DataFrame, window: int = 15, jump: int = 4, longest: tuple[int, int] = (20, 30), opening: str = "隐藏", closing: str = "揭示", parts: int | None = None) -> DataFrame:
    """(doc_id, src, tgt, relation, source, confidence, note) from rows (doc_id, idx, inten, sw, persp, themes array<string>, emo_tgt, images array<string>, d06).

    Each row gives what it holds as occurrences (rule, key): itself for a jump of the mood and a switch of the perspective against the row before, its themes, its target, its
    images, and whether it plants or reveals. An occurrence is met with those before it of the same key: the last one for targets and images, all of the `window` rows before for
    themes, and for a reveal the latest plant still open. One exchange by document serves the numbering, the occurrences, the pairing and the choice among equal
    relations. Of equal (src, tgt, relation) the first rule's stands, and of themes the one met first. Rows are numbered by idx; empty and null keys, and targets and images
    longer than `longest`, are left out; an image that a row holds twice is related to itself, as every other occurrence to the one before. parts: parts of
    the exchange, of tasks(rows) unless they are given.
    """
    numbered = rows.repartition(parts or tasks(rows), "doc_id").withColumn("rn", F.row_number().over(Window.partitionBy("doc_id").orderBy("idx")).cast("long"))
    none = F.lit(None).cast("string")
    one = lambda rule, key, pos=F.lit(0), step=F.lit(0): F.struct(F.lit(rule).alias("rule"), key.alias("key"), pos.cast("int").alias("pos"), step.cast("int").alias("step"))
    each = lambda rule, c: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x, i: one(rule, x, i))
    step = F.when(F.col("d06") == opening, 1).when(F.col("d06") == closing, -1)
    short = lambda c, n: (F.length(c) > 0) & (F.length(c) <= n)
    found = F.concat(
        F.array(one(JUMP, F.lit(""))), F.filter(each(THEME, "themes"), lambda x: F.length(x["key"]) > 0), F.when(short(F.col("emo_tgt"), longest[0]), F.array(one(TARGET, F.col("emo_tgt")))).otherwise(F.array().cast("array<struct<rule:int,key:string,pos:int,step:int>>")),
        F.filter(each(IMAGE, "images"), lambda x: short(x["key"], longest[1])), F.when(step.isNotNull(), F.array(one(PLANT, F.lit(""), F.lit(0), step))).otherwise(F.array().cast("array<struct<rule:int,key:string,pos:int,step:int>>")),
    )
    met = numbered.select("doc_id", "idx", "rn", "inten", "persp", (F.coalesce(F.col("sw") == 0, F.lit(False))).alias("switch"), F.explode(found).alias("o")).select("doc_id", "idx", "rn", "inten", "persp", "switch", "o.*")
    key = Window.partitionBy("doc_id", "rule", "key")
    line = key.orderBy("rn", "pos")
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumns({
        "before": F.lag("idx").over(line), "was": F.lag("inten").over(line), "seen": F.lag("persp").over(line), "first": F.min(F.struct("rn", "pos")).over(key),
        "near": F.when(F.col("rule") == THEME, F.collect_set("idx").over(key.orderBy("rn").rangeBetween(-window, -1))),
        # plants and reveals: running sum and its floor; a reveal that lowers the floor finds no plant open
        "sum": F.sum("step").over(so_far),
    })
    met = met.withColumn("floor", F.least(F.lit(0), F.min("sum").over(so_far)))
    met = met.withColumn("lost", (F.col("step") == -1) & (F.col("floor") < F.coalesce(F.lag("floor").over(line), F.lit(0))))
    met = met.withColumn("depth", F.when((F.col("rule") == PLANT) & ~F.col("lost"), F.col("sum") - F.col("floor") + F.when(F.col("step") == -1, 1).otherwise(0)))
    level = Window.partitionBy("doc_id", "rule", "key", "depth").orderBy("rn", "pos")
    met = met.withColumns({"planted": F.lag("idx").over(level), "open": F.lag("step").over(level)})
    edge = lambda rule, src, note: F.struct(F.lit(rule).alias("rule"), src.alias("src"), note.alias("note"))
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    delta = F.abs(F.col("inten") - F.col("was"))
    rule = F.col("rule")
    edges = F.concat(
        F.when(rule == JUMP, F.filter(F.array(
            F.when(delta >= jump, edge(JUMP, F.col("before"), text("情绪强度 ", F.col("was"), " → ", F.col("inten"), "（突变档差 ", delta, f" ≥ {jump}）"))),
            F.when(F.col("switch") & (F.col("seen") != F.col("persp")), edge(SWITCH, F.col("before"), text("视角 ", F.col("seen"), " → ", F.col("persp"), " 切换点"))),
        ), lambda x: x.isNotNull())).otherwise(F.array(edge(JUMP, F.col("idx"), none)).cast("array<struct<rule:int,src:bigint,note:string>>")),
        F.transform(F.coalesce("near", F.array().cast("array<bigint>")), lambda i: edge(THEME, i, text("主题标签「", F.col("key"), "」重复出现"))),
        F.array(F.when(rule == TARGET, edge(TARGET, F.col("before"), text("情感对象: ", F.col("key")))), F.when(rule == IMAGE, edge(IMAGE, F.col("before"), text("意象: ", F.col("key")))), F.when((rule == PLANT) & (F.col("step") == -1) & (F.col("open") == 1), edge(PLANT, F.col("planted"), F.lit("D06")))),
    )
    listed = F.filter(edges, lambda x: x.isNotNull() & x["src"].isNotNull() & x["note"].isNotNull())
    named = met.select("doc_id", F.col("idx").alias("tgt"), "first", F.explode(listed).alias("e")).select("doc_id", "e.src", "tgt", "e.rule", "e.note", "first")
    value = lambda i: F.element_at(F.array(*(F.lit(r[i]) for r in RULES)), F.col("rule") + 1)
    named = named.withColumns({"relation": value(0), "source": value(1), "confidence": value(2)})
    same = Window.partitionBy("doc_id", "src", "tgt", "relation").orderBy("rule", "first", "note")
    return named.withColumn("_rn", F.row_number().over(same)).filter("_rn = 1").select("doc_id", "src", "tgt", "relation", "source", "confidence", "note")


def with_curated(rules: DataFrame, curated: DataFrame, parts: int | None = None) -> DataFrame:
    """Curated relations, but for those whose source begins with `rule`, and then those rules that say something else; of equal curated ones the least by source and note.
    Both are dealt into `parts` by document, if given."""
    kept = curated.filter(~F.startswith(F.coalesce("source", F.lit("")), F.lit("rule")))
    both = kept.withColumn("_late", F.lit(0)).unionByName(rules.withColumn("_late", F.lit(1)))
    both = both.repartition(parts, "doc_id") if parts else both
    same = Window.partitionBy("doc_id", "src", "tgt", "relation").orderBy("_late", "source", "note")
    return both.withColumn("_rn", F.row_number().over(same)).filter("_rn = 1").drop("_rn", "_late")
