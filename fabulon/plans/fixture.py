"""Annotation layers derived from `documents` by md5, in Spark and, as text, in SQL for the oracle.

The driver's tables hold no annotations. A segment is a non-blank line of a document; its number is the line's. Each field is drawn from the
md5 of document, segment and field, so that both engines get the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fabulon.functions import enums as E

THEMES = ["爱情", "战争", "未来世界", "死亡与牺牲", "校园成长", "城市生活", "真相", "魔法", "信念与追求"]
KEY = "concat(doc_id, '|', idx, '|', '{}')"
# name, tag, values (a list, or (count, first, prefix)), null when the draw of (tag, n) is 0
FIELDS = [
    ("d01", "D01", E.D01, None),
    ("inten", "D04", (10, 1, None), None),
    ("pol", "POL", E.POLARITY, None),
    ("pace", "D05", (5, 1, None), None),
    ("persp", "D07", E.D07, None),
    ("year", "YEAR", (12, 1990, None), ("N_YEAR", 4)),
    ("season", "SEASON", E.SEASONS, ("N_SEASON", 4)),
    ("loc", "LOC", (6, 0, "loc"), ("N_LOC", 4)),
    ("d06", "D06", E.D06, ("N_D06", 3)),
    ("d10", "D10", E.D10, ("N_D10", 2)),
    ("emo", "D19", E.EMOTIONS, None),
    ("emo_int", "D19I", (10, 1, None), None),
    ("emo_pol", "D19P", E.POLARITY, None),
    ("emo_tgt", "D19T", (7, 0, "c"), ("N_TGT", 3)),
    ("conf", "CONF", (101, 0, None), None),
    ("status", "STATUS", E.STATUS, None),
    ("sw", "SW", (8, 0, None), None),
    ("t1", "T1", THEMES, None),
    ("t2", "T2", THEMES, None),
    ("s1", "S1", (7, 0, "c"), None),
    ("s2", "S2", (7, 0, "c"), None),
    ("cl", "I1", (11, 0, "cl"), None),
    ("itype", "I2", E.IMAGERY, None),
    ("gap", "R", (5, 1, None), None),
    ("rel", "RT", E.RELATIONS, None),
    ("done", "DONE", (3, 0, None), None),
    ("time_txt", "TIME", ["清晨", "次日上午", "三年后", "傍晚", "时间跳跃", "夜里", "第三章", "那年冬天"], ("N_TIME", 4)),
    ("space_txt", "SPACE", ["在巴黎", "巴黎的画室里", "来到客厅", "客厅", "离开 车站附近", "街上"], ("N_SPACE", 4)),
    ("word", "WORD", ["高兴", "害怕", "（旧）孤寂", "愤怒", "向往", "「羞愧」", "妒忌", "信任"], None),
    ("sent", "SENT", ["王秀英走了，他看见张伟。", "她们说：这位先生，王秀英！", "张伟 和 李明 都在，那人他认识。", "小张伟不在。他们俩笑了", "李明；它们", "nothing"], None),
]


def _draw(tag: str, n: int, spark: bool) -> str:
    key = KEY.format(tag)
    value = f"cast(conv(substring(md5({key}), 1, 6), 16, 10) as bigint)" if spark else f"('0x' || substr(md5({key}), 1, 6))::BIGINT"
    return f"({value} % {n})"


def _field(tag, values, null, spark: bool) -> str:
    if isinstance(values, list):
        listed = ", ".join(f"'{v}'" for v in values)
        out = f"element_at(array({listed}), cast({_draw(tag, len(values), spark)} + 1 as int))" if spark else f"([{listed}])[{_draw(tag, len(values), spark)} + 1]"
    else:
        n, first, prefix = values
        out = f"({_draw(tag, n, spark)} + {first})"
        out = f"concat('{prefix}', {out})" if prefix else out
    return f"CASE WHEN {_draw(*null, spark)} = 0 THEN NULL ELSE {out} END" if null else out


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, idx, txt): the non-blank lines of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.selectExpr("doc_id", "posexplode(split(text, '\\n')) as (p, txt)").filter("length(trim(txt)) > 0").selectExpr("doc_id", "cast(p as bigint) as idx", "txt")


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segments with all fields; Catalyst prunes those that a query doesn't read."""
    return segments(spark, sf_dir).selectExpr("*", *(f"{_field(tag, values, null, True)} AS {name}" for name, tag, values, null in FIELDS))


def tags(ann: DataFrame) -> DataFrame:
    return ann.selectExpr("doc_id", "idx", "posexplode(array(t1, t2)) as (pos, tag)")


def speakers(ann: DataFrame) -> DataFrame:
    return ann.selectExpr("doc_id", "idx", "explode(array_distinct(array(s1, s2))) as who")


def refs(ann: DataFrame) -> DataFrame:
    """Edges (doc_id, src, tgt, rel) between segments that exist."""
    to = ann.selectExpr("doc_id as d2", "idx as i2")
    edges = ann.selectExpr("doc_id", "idx as src", "idx + gap as tgt", "rel", "conf / 100.0D as conf")
    return edges.join(to, (edges.doc_id == to.d2) & (edges.tgt == to.i2)).select("doc_id", "src", "tgt", "rel", "conf")


_listed = ", ".join(f"{_field(tag, values, null, False)} AS {name}" for name, tag, values, null in FIELDS)
SEG_SQL = "seg AS (SELECT doc_id, i - 1 AS idx, l[i] AS txt FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents) WHERE length(trim(l[i], ' ')) > 0)"
ANN_SQL = f"{SEG_SQL}, ann AS (SELECT *, {_listed} FROM seg)"
TAGS_SQL = "tags AS (SELECT doc_id, idx, 0 AS pos, t1 AS tag FROM ann UNION ALL SELECT doc_id, idx, 1, t2 FROM ann)"
SPK_SQL = "spk AS (SELECT DISTINCT doc_id, idx, who FROM (SELECT doc_id, idx, s1 AS who FROM ann UNION ALL SELECT doc_id, idx, s2 FROM ann))"
REFS_SQL = "refs AS (SELECT a.doc_id, a.idx AS src, b.idx AS tgt, a.rel, a.conf / 100.0::DOUBLE AS conf FROM ann a JOIN ann b ON a.doc_id = b.doc_id AND b.idx = a.idx + a.gap)"


def sql(query: str, *, recursive: bool = False) -> str:
    """A query over seg, ann, tags, spk and refs, for the oracle."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{ANN_SQL}, {TAGS_SQL}, {SPK_SQL}, {REFS_SQL} {query}"
