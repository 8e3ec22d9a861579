"""Aggregations with the contract's tie-breaks; all are hash aggregates or windows within one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabulon.functions import enums as E


def order():
    """Rows of a document in order."""
    return Window.partitionBy("doc_id").orderBy("idx")


def whole():
    """All rows of a document."""
    return Window.partitionBy("doc_id")


def mode_first_seen(rows: DataFrame, column: str) -> DataFrame:
    """The most frequent value of each document; ties go to the one seen first."""
    n = rows.groupBy("doc_id", column).agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first"))
    return n.groupBy("doc_id").agg(F.max_by(column, F.struct("n", -F.col("first"))).alias("value"), F.max("n").alias("n"))


def top_k(rows: DataFrame, column: str, k: int = 3) -> DataFrame:
    n = rows.groupBy("doc_id", column).agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first"))
    by = Window.partitionBy("doc_id").orderBy(F.desc("n"), "first", column)
    return n.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= k).select("doc_id", "rank", F.col(column).alias("value"), "n")


def distribution(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy("doc_id", F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def moments(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(column), 6).alias("mean"), F.round(F.var_pop(column), 6).alias("variance"), F.min(column).alias("low"), F.max(column).alias("high"))


def numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"rn": F.row_number().over(order()), "n": F.count(F.lit(1)).over(whole())})


def half_split_trend(rows: DataFrame, column: str) -> DataFrame:
    """Mean of the second half less that of the first (the first has floor(n / 2) rows)."""
    first = F.col("rn") <= F.floor(F.col("n") / 2)
    out = numbered(rows).groupBy("doc_id").agg((F.avg(F.when(~first, F.col(column))) - F.avg(F.when(first, F.col(column)))).alias("trend"))
    return out.select("doc_id", F.round(F.coalesce("trend", F.lit(0.0)), 6).alias("trend"))


def head_tail_means(rows: DataFrame, column: str) -> DataFrame:
    size = F.greatest(F.lit(3), F.floor(F.col("n") / 10))
    rows = numbered(rows).withColumn("size", size)
    return rows.groupBy("doc_id").agg(F.round(F.avg(F.when(F.col("rn") <= F.col("size"), F.col(column))), 6).alias("head"), F.round(F.avg(F.when(F.col("rn") > F.col("n") - F.col("size"), F.col(column))), 6).alias("tail"))


def act_ranges(rows: DataFrame) -> DataFrame:
    """First row of each act and the row before the next act in order that begins later."""
    act = F.lit("transition")
    for name, value in E.ACTS.items():
        act = F.when(F.col("d01") == name, F.lit(value)).otherwise(act)
    rows = numbered(rows).withColumn("act", act).withColumn("pos", F.col("rn") - 1)
    place = F.lit(None).cast("int")
    for i, name in enumerate(E.ACT_ORDER):
        place = F.when(F.col("act") == name, F.lit(i)).otherwise(place)
    first = rows.filter(F.col("act") != "transition").groupBy("doc_id", "act").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("labelled"), F.max("n").alias("n")).withColumn("place", place)
    after = F.collect_list(F.struct("first")).over(Window.partitionBy("doc_id").orderBy("place").rowsBetween(1, Window.unboundedFollowing))
    later = F.filter(F.transform(after, lambda s: s["first"]), lambda v: v > F.col("first"))
    return first.select("doc_id", "act", F.col("first").cast("long").alias("start_segment"), F.coalesce(F.get(later, F.lit(0)) - 1, F.col("n") - 1).cast("long").alias("end_segment"), "labelled")


def beats(rows: DataFrame, column: str = "inten") -> DataFrame:
    """Mean of a column over the 14 overlapping beats; the beats are the rows of a constant array, not a join."""
    marks = F.array(*(F.struct(F.lit(b).alias("beat"), F.lit(a).alias("a"), F.lit(z).alias("z")) for b, a, z in E.BEATS))
    rows = numbered(rows).withColumn("pos", F.col("rn") - 1).select("doc_id", "pos", "n", column, F.explode(marks).alias("m"))
    inside = F.col("pos").between((F.col("n") * F.col("m.a")).cast("int"), F.least((F.col("n") * F.col("m.z")).cast("int"), (F.col("n") - 1).cast("int")))
    return rows.filter(inside).groupBy("doc_id", F.col("m.beat").alias("beat")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(column), 6).alias("mean"))


def five_intervals(rows: DataFrame, hit) -> DataFrame:
    """Density of a condition in five equal intervals; rows after the fifth are left out."""
    size = F.greatest(F.floor(F.col("n") / 5), F.lit(1))
    rows = numbered(rows).withColumn("interval", F.floor((F.col("rn") - 1) / size).cast("long")).withColumn("size", size).filter("interval < 5")
    return rows.groupBy("doc_id", "interval").agg(F.round(F.count_if(hit) / F.max("size"), 6).alias("density"))


def keyword_scores(tags: DataFrame, genres: dict[str, list[str]] = E.GENRES) -> DataFrame:
    """Per document and genre the number of tags (with repeats) that hold one of its key words."""
    hits = {g: F.exists(F.array(*(F.lit(w) for w in ws)), lambda w: F.contains(F.col("tag"), w)) for g, ws in genres.items()}
    names = F.array_compact(F.array(*(F.when(h, F.lit(g)) for g, h in hits.items())))
    return tags.select("doc_id", F.explode(names).alias("genre")).groupBy("doc_id", "genre").agg(F.count(F.lit(1)).alias("score"))


# fixed values: weights of the craft dimensions, the count that is full marks, and the number of legal types
CRAFT = {"D13": (0.30, 3, 6), "D14": (0.20, 2, 8), "D15": (0.20, 2, 5), "D16": (0.15, 2, 4), "D17": (0.15, 2, 6)}


def quality_score(items: DataFrame) -> DataFrame:
    """Weighted craft score per document from items (doc_id, dim, kind)."""
    per = items.groupBy("doc_id", "dim").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("kind").alias("kinds"))
    table = lambda i: F.element_at(F.create_map(*(F.lit(x) for k, v in CRAFT.items() for x in (k, float(v[i])))), F.col("dim"))
    mark = 0.4 + F.least(F.col("n") / table(1), F.lit(1.0)) * 0.4 + F.least(F.col("kinds") / table(2), F.lit(1.0)) * 0.2
    return per.groupBy("doc_id").agg(F.round(F.sum(mark * table(0)) * 100, 4).alias("score"))


def confidence(rows: DataFrame) -> DataFrame:
    """Recomputed confidence: presence, completeness, span, legal values and agreement of the layers."""
    parts = F.array("d06", "d10", "loc", "season", "emo_tgt")
    complete = F.size(F.array_compact(parts)) / 5
    agree = F.when(F.col("pol") == F.col("emo_pol"), 1.0).otherwise(0.0)
    legal = F.when(F.col("d01").isin(*E.D01) & F.col("emo").isin(*E.EMOTIONS), 1.0).otherwise(0.0)
    span = F.when(F.length("txt") > 0, 1.0).otherwise(0.0)
    return rows.select("doc_id", "idx", F.round(0.30 + 0.25 * complete + 0.20 * span + 0.15 * legal + 0.10 * agree, 6).alias("confidence"))


def agreement(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    met = left.join(right, keys)
    return met.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(a) == F.col(b)).alias("n_equal"), F.round(F.avg(F.when(F.col(a) == F.col(b), 1.0).otherwise(0.0)), 6).alias("rate"))


def progress(done: DataFrame, total: DataFrame) -> DataFrame:
    """Finished segments by document and share of all."""
    n = total.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    d = done.groupBy("doc_id").agg(F.count(F.lit(1)).alias("d"))
    return n.join(d, "doc_id", "left").select("doc_id", "n", F.coalesce("d", F.lit(0)).alias("done"), F.round(100 * F.coalesce("d", F.lit(0)) / F.col("n"), 6).alias("percent"))


def frequent_words(rows: DataFrame, known: list[str], column: str, least: int = 3) -> DataFrame:
    """Values outside a list with their count and first place."""
    return rows.filter(~F.col(column).isin(*known)).groupBy(F.col(column).alias("word")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "idx")).alias("at")).filter(F.col("n") >= least).select("word", "n", F.col("at.doc_id").alias("doc_id"), F.col("at.idx").alias("idx"))


def quota_top(rows: DataFrame, group: str, order: list, quota: int, most: int) -> DataFrame:
    """`quota` rows of each group, `most` in all, by order."""
    out = rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")).filter(F.col("rank") <= quota)
    return out.orderBy("rank", group).limit(most)


def lexicon_subset(words: DataFrame) -> DataFrame:
    """A lexicon (w, pos, cls, pol, pos_in_file) with one row a word: first part of speech, sorted classes, majority polarity (ties: first seen)."""
    short = words.filter((F.length("w") <= 2) & F.col("pos").isin("noun", "verb", "adj", "adv"))
    pol = short.groupBy("w", "pol").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).groupBy("w").agg(F.max_by("pol", F.struct("n", -F.col("first"))).alias("pol"))
    return short.groupBy("w").agg(F.min_by("pos", "at").alias("pos"), F.array_join(F.sort_array(F.collect_set("cls")), ",").alias("cls")).join(pol, "w")


def coverage_gap(classes: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits of each class (name) of a list, 0 for classes without any."""
    n = hits.groupBy(F.col("name").alias("hit")).agg(F.count(F.lit(1)).alias("n"))
    return classes.join(n, F.col("name") == F.col("hit"), "left").select("name", F.coalesce("n", F.lit(0)).alias("n"))


def polarity_vote(shares: DataFrame, rows: DataFrame) -> DataFrame:
    """Per document the share of segments whose lexicon vote (positive first, then negative, neutral without words) is the annotated polarity."""
    vote = F.when((F.col("positive") > 0) & (F.col("positive") >= F.col("negative")), "positive").when(F.col("negative") > 0, "negative").otherwise("neutral")
    met = shares.withColumn("vote", vote).join(rows.select("doc_id", "idx", "pol"), ["doc_id", "idx"])
    return met.groupBy("doc_id").agg(F.round(F.avg(F.when(F.col("vote") == F.col("pol"), 1.0).otherwise(0.0)), 6).alias("consistency"))
