"""Ordered-sequence operators over annotated segments (doc_id, idx, ...).

All windows are partitioned by document and ordered by segment number, so that a task holds one document's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabulon.functions.enums import EVENT_FUNCTION


def order():
    """Rows of a document in order."""
    return Window.partitionBy("doc_id").orderBy("idx")


def before(column: str, n: int = 1) -> Column:
    return F.lag(column, n).over(order())


def with_previous(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select("*", F.lag("idx").over(order()).alias("prev"), *(before(c).alias(f"prev_{c}") for c in columns))


def intensity_jumps(rows: DataFrame, least: int = 4) -> DataFrame:
    """Edges between neighbours whose intensities differ by `least`."""
    return with_previous(rows, "inten").filter(F.abs(F.col("inten") - F.col("prev_inten")) >= least).selectExpr("doc_id", "prev as src", "idx as tgt", "abs(inten - prev_inten) as diff")


def perspective_switches(rows: DataFrame) -> DataFrame:
    return with_previous(rows, "persp").filter("sw = 0 and prev is not null and persp <> prev_persp").selectExpr("doc_id", "prev as src", "idx as tgt", "prev_persp as from_type", "persp as to_type")


def event_function(column: str = "d01") -> Column:
    out = F.lit("未知")
    for name, kind in EVENT_FUNCTION.items():
        out = F.when(F.col(column) == name, F.lit(kind)).otherwise(out)
    return out


def with_scenes(rows: DataFrame) -> DataFrame:
    """rows with the number of their scene: a session whose time, place and function go on from the row before."""
    rows = with_previous(rows.withColumn("fn", event_function()), "year", "loc", "fn")
    time = F.col("year").isNull() | F.col("prev_year").isNull() | (F.col("year") >= F.col("prev_year"))
    place = F.col("loc").isNull() | F.col("prev_loc").isNull() | F.contains("loc", "prev_loc") | F.contains("prev_loc", "loc")
    new = F.when(F.col("prev").isNull() | ~(time & place & (F.col("fn") == F.col("prev_fn"))), 1).otherwise(0)
    return rows.withColumn("new", new).withColumn("scene", F.sum("new").over(order().rowsBetween(Window.unboundedPreceding, 0)))


def scenes(rows: DataFrame) -> DataFrame:
    """First and last row and size of each scene."""
    return with_scenes(rows).groupBy("doc_id", "scene").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.count(F.lit(1)).alias("n"))


def time_transitions(rows: DataFrame, years: int = 2) -> DataFrame:
    rows = with_previous(rows, "year", "season")
    gap = F.abs(F.col("year") - F.col("prev_year")) >= years
    turn = F.col("season") != F.col("prev_season")
    return rows.filter(F.coalesce(gap, F.lit(False)) | F.coalesce(turn, F.lit(False))).select("doc_id", F.col("prev").alias("src"), F.col("idx").alias("tgt"), F.coalesce(gap, F.lit(False)).alias("year_gap"), F.coalesce(turn, F.lit(False)).alias("season_change"))


def location_transitions(rows: DataFrame) -> DataFrame:
    return with_previous(rows, "loc").filter("loc <> prev_loc").selectExpr("doc_id", "prev as src", "idx as tgt", "prev_loc as from_loc", "loc as to_loc")


def function_bigrams(rows: DataFrame) -> DataFrame:
    """Pairs of functions of neighbours that mark a transition."""
    rows = with_previous(rows, "d01")
    kind = (
        F.when((F.col("prev_d01") == "背景铺垫") & (F.col("d01") == "过渡"), "setup")
        .when((F.col("prev_d01") == "过渡") & (F.col("d01") == "上升行动"), "rise")
        .when(F.col("prev_d01").isin("高潮", "转折") & F.col("d01").isin("下降行动", "背景铺垫", "结局"), "release")
    )
    return rows.withColumn("kind", kind).filter("kind is not null").selectExpr("doc_id", "prev as src", "idx as tgt", "kind")


def serial_runs(rows: DataFrame, value: str = "隐藏", least: int = 3) -> DataFrame:
    """Maximal runs of neighbouring rows with one value of d06 (gaps and islands)."""
    numbered = rows.withColumn("rn", F.row_number().over(order()))
    hidden = numbered.filter(F.col("d06") == value).withColumn("island", F.col("rn") - F.row_number().over(order()))
    return hidden.groupBy("doc_id", "island").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).drop("island")


def parallel_montage(rows: DataFrame, size: int = 5, changes: int = 3) -> DataFrame:
    """Full windows of `size` rows in which the known places change often."""
    frame = order().rowsBetween(0, size - 1)
    rows = rows.select("doc_id", "idx", F.collect_list("loc").over(frame).alias("locs"), F.count(F.lit(1)).over(frame).alias("n"), F.last("idx").over(frame).alias("last_idx")).filter(F.col("n") == size)
    pairs = F.zip_with(F.slice("locs", 1, F.greatest(F.size("locs") - 1, F.lit(0))), F.slice("locs", 2, F.greatest(F.size("locs") - 1, F.lit(0))), lambda a, b: F.when(a != b, 1).otherwise(0))
    return rows.withColumn("changes", F.aggregate(pairs, F.lit(0), lambda a, x: a + x).cast("long")).filter(F.col("changes") >= changes).selectExpr("doc_id", "idx as first_idx", "last_idx", "changes")


def cross_montage(rows: DataFrame, pace: int = 4, functions: tuple[str, ...] = ("上升行动", "高潮", "转折"), reach: int = 3, least: int = 2) -> DataFrame:
    """Anchors of fast rows of which `least` of the next fast rows near by have another function."""
    fast = rows.filter((F.col("pace") >= pace) & F.col("d01").isin(*functions)).select("doc_id", "idx", "d01")
    near = [((F.lead("idx", k).over(order()) - F.col("idx") <= reach) & (F.lead("d01", k).over(order()) != F.col("d01"))) for k in range(1, 4)]
    return fast.select("doc_id", "idx", "d01", sum(F.when(F.coalesce(x, F.lit(False)), 1).otherwise(0) for x in near).cast("long").alias("switches")).filter(F.col("switches") >= least)


def contrast_montage(rows: DataFrame, least: int = 5) -> DataFrame:
    rows = with_previous(rows, "pol", "inten")
    strong = (F.col("inten") >= least) & (F.col("prev_inten") >= least)
    pair = F.array_sort(F.array("pol", "prev_pol"))
    against = (pair == F.array(F.lit("negative"), F.lit("positive"))) | (pair == F.array(F.lit("mixed"), F.lit("positive"))) | (pair == F.array(F.lit("mixed"), F.lit("negative")))
    return rows.filter(strong & against).selectExpr("doc_id", "prev as src", "idx as tgt", "prev_pol as from_pol", "pol as to_pol")


def hooks(rows: DataFrame) -> DataFrame:
    """Per document the rows that hook the reader, by kind, and how many rows any of them names."""
    rows = with_previous(rows, "loc")
    kinds = {"suspense": F.col("d06").isin("隐藏", "误导"), "emotion": F.col("inten") >= 8, "turn": F.col("d01").isin("转折", "激励事件"), "scene": F.col("loc") != F.col("prev_loc")}
    kinds = {k: F.coalesce(v, F.lit(False)) for k, v in kinds.items()}
    some = kinds["suspense"] | kinds["emotion"] | kinds["turn"] | kinds["scene"]
    return rows.groupBy("doc_id").agg(*(F.count_if(v).alias(f"n_{k}") for k, v in kinds.items()), F.count_if(some).alias("n_total"))


def year_jumps(rows: DataFrame, least: int = 5) -> DataFrame:
    """Rows whose year is far from the last known one."""
    known = F.last("year", ignorenulls=True).over(order().rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("known", known).filter(F.abs(F.col("year") - F.col("known")) >= least).selectExpr("doc_id", "idx", "known as from_year", "year as to_year")


def time_jumps(rows: DataFrame) -> DataFrame:
    """Among rows that tell a time, those whose time differs from the one told before."""
    told = rows.filter("season is not null")
    return with_previous(told, "season").filter("season <> prev_season").selectExpr("doc_id", "prev as src", "idx as tgt", "season")


def inciting_rows(rows: DataFrame, strong: tuple[str, ...] = ("激励事件", "转折", "上升行动")) -> DataFrame:
    """Per document the nearest row of a strong function before the first climax, else the first row."""
    climax = F.min(F.when(F.col("d01") == "高潮", F.col("idx"))).over(Window.partitionBy("doc_id"))
    return rows.withColumn("climax", climax).groupBy("doc_id").agg(F.coalesce(F.max(F.when(F.col("d01").isin(*strong) & (F.col("idx") < F.col("climax")), F.col("idx"))), F.min("idx")).alias("inciting"))


def unresolved(rows: DataFrame, reach: int = 5) -> DataFrame:
    """Hidden rows without a reveal in the next rows."""
    reveal = F.max(F.when(F.col("d06") == "揭示", 1).otherwise(0)).over(order().rowsBetween(1, reach))
    return rows.withColumn("reveal", F.coalesce(reveal, F.lit(0))).filter("d06 = '隐藏' and reveal = 0").select("doc_id", "idx")


def nearest_antecedents(rows: DataFrame) -> DataFrame:
    """For rows without a target, the last target that an earlier row names."""
    last = F.last("emo_tgt", ignorenulls=True).over(order().rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("antecedent", last).filter("emo_tgt is null and antecedent is not null").select("doc_id", "idx", "antecedent")


def context_anchors(rows: DataFrame, size: int = 200) -> DataFrame:
    """The end of the text before and the start of the text after each segment; empty at the ends."""
    return rows.select("doc_id", "idx", F.coalesce(F.right(before("txt"), F.lit(size)), F.lit("")).alias("context_prev"), F.coalesce(F.left(F.lead("txt").over(order()), F.lit(size)), F.lit("")).alias("context_next"))


def adjacent_pairs(rows: DataFrame, size: int = 500) -> DataFrame:
    after = rows.select("doc_id", "idx", F.left("txt", F.lit(size)).alias("head"), F.lead("idx").over(order()).alias("next_idx"), F.left(F.lead("txt").over(order()), F.lit(size)).alias("next_head"))
    return after.filter("next_idx is not null")


def sampled_points(rows: DataFrame, points: int = 5, most: int = 6) -> DataFrame:
    """Every max(1, n / points)-th row of a document, `most` at most."""
    n = F.count(F.lit(1)).over(Window.partitionBy("doc_id"))
    rows = rows.withColumn("rn", F.row_number().over(order()) - 1).withColumn("step", F.greatest(F.lit(1), F.floor(n / points)))
    return rows.filter((F.col("rn") % F.col("step") == 0) & (F.col("rn") / F.col("step") < most)).selectExpr("doc_id", "idx", "inten")
