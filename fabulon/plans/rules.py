"""Registered queries of relations by rule, seeded samples and nested annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabulon.operators import nested, relations, sampling

from .registry import on_ann, register, table

# relations: all rules of one pass; images are two of a row's fields
IMAGES = "filter(array(if(gap < 3, cl, null), itype, if(gap = 5, itype, null)), x -> x is not null)"


def related(a: DataFrame, parts: int | None = None) -> DataFrame:
    return relations.rule_relations(a.selectExpr("doc_id", "idx", "inten", "sw", "persp", "array(t1, t2) as themes", "emo_tgt", f"{IMAGES} as images", "d06"), parts=parts)


def curated(a: DataFrame) -> DataFrame:
    """Relations of which some are by hand and some left from an earlier run of the rules."""
    return a.filter("gap = 1 and idx > 0").selectExpr("doc_id", "idx - 1 as src", "idx as tgt", "if(sw < 4, '时序', '对比') as relation", "if(sw % 2 = 0, if(sw = 6, null, 'hand'), 'rule_old') as source", "0.9D as confidence", "'by hand' as note")


def curated_first(a: DataFrame) -> DataFrame:
    parts = relations.tasks(a)
    return relations.with_curated(related(a, parts), curated(a), parts)


REL_SQL = (
    ", num AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS rn FROM ann), nb AS (SELECT *, lag(idx) OVER w AS bi, lag(inten) OVER w AS bn, lag(persp) OVER w AS bp FROM num WINDOW w AS (PARTITION BY doc_id ORDER BY idx)), "
    "th AS (SELECT doc_id, idx, rn, 0 AS pos, t1 AS k FROM num UNION ALL SELECT doc_id, idx, rn, 1, t2 FROM num), tf AS (SELECT *, min(rn * 10 + pos) OVER (PARTITION BY doc_id, k) AS f FROM th), "
    "im AS (SELECT doc_id, idx, rn, 0 AS pos, cl AS k FROM num WHERE gap < 3 UNION ALL SELECT doc_id, idx, rn, 1, itype FROM num UNION ALL SELECT doc_id, idx, rn, 2, itype FROM num WHERE gap = 5), il AS (SELECT *, lag(idx) OVER (PARTITION BY doc_id, k ORDER BY rn, pos) AS bi, min(rn * 10 + pos) OVER (PARTITION BY doc_id, k) AS f FROM im), "
    "tg AS (SELECT doc_id, idx, emo_tgt AS k, lag(idx) OVER (PARTITION BY doc_id, emo_tgt ORDER BY rn) AS bi, min(rn * 10) OVER (PARTITION BY doc_id, emo_tgt) AS f FROM num WHERE emo_tgt IS NOT NULL), "
    # the latest plant still open: the last one before the reveal between which and it there are as many plants as reveals
    "br AS (SELECT doc_id, idx, CASE d06 WHEN '隐藏' THEN 1 ELSE -1 END AS step, sum(CASE d06 WHEN '隐藏' THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY idx) AS s FROM ann WHERE d06 IN ('隐藏', '揭示')), "
    "pl AS (SELECT r.doc_id, r.idx, max(p.idx) AS bi FROM br r JOIN br p ON p.doc_id = r.doc_id AND p.idx < r.idx AND p.step = 1 AND p.s = r.s + 1 WHERE r.step = -1 GROUP BY 1, 2), "
    "pq AS (SELECT pl.* FROM pl WHERE NOT EXISTS (SELECT 1 FROM br m WHERE m.doc_id = pl.doc_id AND m.idx > pl.bi AND m.idx < pl.idx AND m.s < (SELECT s FROM br p WHERE p.doc_id = pl.doc_id AND p.idx = pl.bi))), "
    "e AS (SELECT doc_id, bi AS src, idx AS tgt, 0 AS rule, 0 AS f, concat('情绪强度 ', bn, ' → ', inten, '（突变档差 ', abs(inten - bn), ' ≥ 4）') AS note FROM nb WHERE abs(inten - bn) >= 4 "
    "UNION ALL SELECT doc_id, bi, idx, 1, 0, concat('视角 ', bp, ' → ', persp, ' 切换点') FROM nb WHERE sw = 0 AND bp <> persp "
    "UNION ALL SELECT DISTINCT a.doc_id, a.idx, b.idx, 2, a.f, concat('主题标签「', a.k, '」重复出现') FROM tf a JOIN tf b ON a.doc_id = b.doc_id AND a.k = b.k AND b.rn - a.rn BETWEEN 1 AND 15 "
    "UNION ALL SELECT doc_id, bi, idx, 3, f, concat('情感对象: ', k) FROM tg WHERE bi IS NOT NULL UNION ALL SELECT doc_id, bi, idx, 4, f, concat('意象: ', k) FROM il WHERE bi IS NOT NULL UNION ALL SELECT doc_id, bi, idx, 5, 0, 'D06' FROM pq), "
    "ru AS (SELECT *, (['时序', '对比', '呼应', '呼应', '呼应', '伏笔-回收'])[rule + 1] AS relation, CASE WHEN rule < 3 THEN 'rule' ELSE 'rule_enhanced' END AS source, ([0.7::DOUBLE, 0.7, 0.7, 0.5, 0.5, 0.6])[rule + 1] AS confidence FROM e), "
    "ro AS (SELECT doc_id, src, tgt, relation, source, confidence, note FROM ru QUALIFY row_number() OVER (PARTITION BY doc_id, src, tgt, relation ORDER BY rule, f, note) = 1)"
)
register("rel_rules", on_ann(related), f"{REL_SQL} SELECT * FROM ro")
register(
    "rel_curated_first", on_ann(curated_first),
    f"{REL_SQL}, cu AS (SELECT doc_id, idx - 1 AS src, idx AS tgt, CASE WHEN sw < 4 THEN '时序' ELSE '对比' END AS relation, CASE WHEN sw = 6 THEN NULL ELSE 'hand' END AS source, 0.9::DOUBLE AS confidence, 'by hand' AS note FROM ann WHERE gap = 1 AND idx > 0 AND sw % 2 = 0) "
    "SELECT * FROM cu UNION ALL SELECT ro.* FROM ro WHERE NOT EXISTS (SELECT 1 FROM cu WHERE cu.doc_id = ro.doc_id AND cu.src = ro.src AND cu.tgt = ro.tgt AND cu.relation = ro.relation)",
)

# samples of exact size by stratum
DRAW = "md5(concat_ws('|', '7', coalesce(o_orderpriority, '\\N'), coalesce(o_orderstatus, '\\N'), o_orderkey::VARCHAR))"
register("sample_stratified", table("orders", lambda o: sampling.stratified(o, ["o_orderpriority", "o_orderstatus"], ["o_orderkey"], 5, seed=7).select("o_orderkey", "o_orderpriority", "o_orderstatus")), f"SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY {DRAW}) <= 5", raw=True)
QUOTA = "CASE lang WHEN 'en' THEN 9 WHEN 'fr' THEN 4 ELSE 1 END"
register(
    "sample_shares", table("documents", lambda d: sampling.shares(d, ["lang", "source"], sampling.stratified(d, ["lang", "source"], ["doc_id", "text"], F.expr(QUOTA), seed=3))),
    f"SELECT lang, source, count(*) AS n, least(count(*), max({QUOTA}))::BIGINT AS taken, round(count(*) / least(count(*), max({QUOTA})), 6) AS weight FROM documents GROUP BY 1, 2", raw=True,
)

# nested annotations as JSON text, drawn from the annotations
SPAN = "named_struct('text', left(txt, 9), 'start', idx)"
RAW = (
    f"CASE WHEN gap = 5 AND sw = 0 THEN 'no json' ELSE to_json(named_struct('document_id', concat('d', doc_id), 'status', if(sw = 1, '', status), 'schema_version', if(gap = 1, '2.5.0', '2.10.0'), 'text_span', {SPAN}, 'layers', named_struct('emotion', named_struct('emo', emo, 'source_segment', idx, "
    f"'secondary', array(named_struct('emo', emo, 'n', emo_int), named_struct('emo', 'x', 'n', gap)), 'empty', filter(array(1), x -> x > 2))), 'cross_refs_sources', array('a', 'b'), 'items', array(array(named_struct('text_span', {SPAN}, '原文片段', txt, 'kept', sw = 3))))) END"
)


def raw(a: DataFrame) -> DataFrame:
    return a.selectExpr("doc_id", "idx", f"{RAW} as raw")


BAD = "(gap = 5 AND sw = 0)"
_v = {"$.document_id": "concat('d', doc_id)", "$.status": "CASE WHEN sw = 1 THEN '' ELSE status END", "$.schema_version": "CASE WHEN gap = 1 THEN '2.5.0' ELSE '2.10.0' END", "$.text_span.text": "left(txt, 9)", "$.text_span.start": "idx::VARCHAR", "$.layers.emotion.emo": "emo", "$.layers.emotion.source_segment": "idx::VARCHAR", "$.layers.emotion.secondary[0].emo": "emo", "$.layers.emotion.secondary[0].n": "emo_int::VARCHAR", "$.layers.emotion.secondary[1].emo": "'x'", "$.layers.emotion.secondary[1].n": "gap::VARCHAR", "$.layers.emotion.empty": "'[]'", "$.cross_refs_sources[0]": "'a'", "$.cross_refs_sources[1]": "'b'", "$.items[0][0].text_span.text": "left(txt, 9)", "$.items[0][0].text_span.start": "idx::VARCHAR", "$.items[0][0].kept": "(sw = 3)::VARCHAR", "$.items[0][0].原文片段": "txt"}
_values = " UNION ALL ".join(f"SELECT doc_id, idx, '{p}' AS path, {x} AS value FROM ann WHERE NOT {BAD}" for p, x in _v.items())
register("nested_values", on_ann(lambda a: nested.flattened(raw(a)).drop("kind")), f", pv AS ({_values}) SELECT * FROM pv")
register("nested_key", on_ann(lambda a: nested.values_of(raw(a), "emo")), f", pv AS ({_values}) SELECT * FROM pv WHERE path LIKE '%.emo'")
_hid = [p for p in _v if not p.startswith("$.cross") and "source" not in p and "原文" not in p]
_h = {p: ("'【已脱敏】'" if p.endswith("text_span.text") else _v[p]) for p in _hid} | {"$.cross_refs_sources": "'【已脱敏】'", "$.layers.emotion.source_segment": "'【已脱敏】'", "$.items[0][0].原文片段": "'【已脱敏】'", "$.text_span.char_length": "length(left(txt, 9))::VARCHAR", "$.items[0][0].text_span.char_length": "length(left(txt, 9))::VARCHAR"}
register("export_nested", on_ann(lambda a: nested.exported(raw(a)).drop("kind")), ", pv AS (" + " UNION ALL ".join(f"SELECT doc_id, idx, '{p}' AS path, {x} AS value FROM ann WHERE NOT {BAD}" for p, x in _h.items()) + ") SELECT * FROM pv")
_n = lambda kind, name, where=f"NOT {BAD}", n="count(*)": f"SELECT '{kind}' AS kind, {name} AS name, {n} AS n FROM ann WHERE {where} GROUP BY 2"
register(
    "export_summary", on_ann(lambda a: nested.export_summary(nested.redacted(raw(a)))),
    ", x AS (" + " UNION ALL ".join([_n("lines", "'total'", "true"), _n("lines", "'annotations'"), _n("lines", "'skipped'", BAD), _n("document", "concat('d', doc_id)"), _n("status", "CASE WHEN sw = 1 THEN '__no_status__' ELSE status END"), _n("schema_version", "CASE WHEN gap = 1 THEN '2.5.0' ELSE '2.10.0' END"), _n("hidden", "'text_span'", n="2 * count(*)"), _n("hidden", "'source_segment'"), _n("hidden", "'cross_refs_sources'"), _n("hidden", "'原文片段'")]) + ") SELECT kind, name, n::BIGINT AS n FROM x",
)
