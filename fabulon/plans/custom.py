"""Queries of operators that SQL cannot express: checked by rows here, and against brute force in the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabulon.functions.similarity import locate, seq_ratio
from fabulon.operators import entities, memory, scratchpad
from fabulon.operators.sequence import with_previous

from .fixture import annotated, segments


def sim_seq_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment against the one before, whole."""
    rows = with_previous(segments(spark, sf_dir), "txt").filter("prev is not null")
    return rows.select("doc_id", "idx", F.round(seq_ratio("prev_txt", "txt"), 6).alias("ratio"))


def span_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes with a changed character, found again in their segments."""
    rows = segments(spark, sf_dir).withColumn("quote", F.concat(F.substring("txt", 5, 12), F.lit("~"), F.substring("txt", 18, 12)))
    # a file of few row groups is few tasks, and the search is the work
    found = rows.repartition("doc_id", "idx").withColumn("found", locate("txt", "quote"))
    return found.select("doc_id", "idx", "found.start", "found.end", "found.level", F.round("found.similarity", 6).alias("similarity"))


def scratchpad_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratchpad.fold(annotated(spark, sf_dir))


def layer_rows(a: DataFrame) -> DataFrame:
    """What the layers of a segment name: targets of all kinds, speakers, moods and information."""
    third = "element_at(array('他', '我', '秘密花园', '此人'), cast(inten % 4 + 1 as int))"
    return a.selectExpr("doc_id", "idx", f"if(gap = 1, {third}, emo_tgt) as target", "if(gap = 2, array(t1, emo_tgt), null) as secondary", "if(gap = 3, array('她', s1), array()) as voices", "array(s2, if(sw = 0, '我', '你')) as speakers", "d01", "emo as mood", "emo_int as strength", "if(gap = 4, '', sent) as txt", "d06", "concat(if(sw < 4, '关键信息：', ''), sent) as content")


def memory_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memory.remembered(layer_rows(annotated(spark, sf_dir)))


def alias_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.alias_clusters(annotated(spark, sf_dir).select("doc_id", F.concat("s1", F.lit("x"), "t1").alias("who")))


def object_leader_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.object_leaders(annotated(spark, sf_dir).select("doc_id", "idx", F.concat("cl", F.lit(" "), "t2").alias("text")))


def queries() -> dict:
    return {f.__name__: f for f in (sim_seq_ratio, span_fuzzy, scratchpad_fold, memory_fold, alias_clusters, object_leader_clusters)}
