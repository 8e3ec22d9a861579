"""Registered queries of recomputed confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabulon.functions import enums as E
from fabulon.operators import calibrate, commit, validate

from .registry import R, on_ann, register

# each layer's row as JSON text, with fields that lack, values that are not legal and quotes without a span in some rows
STRUCTURE = "named_struct('D01', if(gap = 1, 'x', d01), 'D04', named_struct('core', if(gap = 2, null, element_at(array('信任', '悬疑', '悲伤', '压力'), cast(idx % 4 + 1 as int))), 'intensity', if(gap = 3, null, inten)), 'D05', pace, 'D07', if(sw = 1, null, named_struct('type', persp)), 'D08', if(sw = 2, named_struct('t', if(true, null, 1)), named_struct('t', 1)))"
EMOTION = "named_struct('primary', named_struct('emotion', emo, 'intensity', emo_int, 'polarity', emo_pol), 'target', emo_tgt, 'trigger', if(sw = 3, '', 'x'), 'expression', named_struct('key_phrases', array('a', 'b')))"
CRAFT = "named_struct('D13_golden_lines', if(sw = 4, filter(array(named_struct('text', 'a')), x -> false), array(named_struct('text', 'a'))), 'D14_rhetoric', array(named_struct('text', 'b', 'type', if(sw = 5, 'x', '比喻'), 'span', named_struct('start', 1, 'end', 2))), 'D15_imagery', array(named_struct('text', 'c', 'type', itype, 'span', if(gap = 1, null, named_struct('start', 1, 'end', 2))), named_struct('text', '', 'type', 'y', 'span', null)), 'D17_syntax', array(named_struct('text', 'd', 'type', '')))"
LAYERS = {"structure": STRUCTURE, "emotion": EMOTION, "craft": CRAFT, "interpretation": "named_struct('D09', array(t1))"}


def rows(a: DataFrame) -> DataFrame:
    """(doc_id, idx, layer, raw): craft at the root, emotion for some segments only."""
    one = lambda layer, text: F.struct(F.lit(layer).alias("layer"), F.expr(f"to_json(named_struct('{layer}', {text}))" if layer == "craft" else f"to_json(named_struct('layers', named_struct('{layer}', {text})))").alias("raw"))
    return a.select("doc_id", "idx", "done", F.explode(F.array(*(one(k, v) for k, v in LAYERS.items()))).alias("x")).filter("x.layer <> 'emotion' or done > 0").select("doc_id", "idx", "x.*")


_in = lambda vs: "(" + ", ".join(f"'{v}'" for v in vs) + ")"
_core = "(CASE WHEN gap = 2 THEN NULL ELSE (['信任', '悬疑', '悲伤', '压力'])[idx % 4 + 1] END)"
_want = "(CASE " + " ".join(f"WHEN {_core} = '{k}' THEN '{v}'" for k, v in calibrate.MOOD_POLARITY.items() if k in ("信任", "悬疑", "悲伤")) + " END)"
_cross = f"CASE WHEN {_core} IS NULL OR done = 0 THEN 0.8 ELSE (CASE WHEN emo_pol = 'mixed' OR {_want} IS NULL THEN 0.8 WHEN {_want} = emo_pol THEN 1.0 ELSE 0.5 END + CASE WHEN gap = 3 THEN 0.8 ELSE greatest(0.5, 1.0 - abs(inten - emo_int) * 0.15) END) / 2 END"
_d = lambda x: f"({x})::DOUBLE"
_part = {
    "structure": (_d("(3 + (sw <> 1)::INT + (sw <> 2)::INT) / 5"), _d("1"), _d(f"((gap <> 1)::INT + CASE WHEN gap <> 2 THEN ({_core} IN {_in(E.D04_CORE)})::INT ELSE 0 END + (sw <> 1)::INT) / (1 + (gap <> 2)::INT + (sw <> 1)::INT)"), _d(_cross)),
    "emotion": (_d("(2 + (emo_tgt IS NOT NULL)::INT + (sw <> 3)::INT) / 4"), _d("1"), _d("1"), _d(_cross)),
    "craft": (_d("(3 + (sw <> 4)::INT) / 5"), _d("CASE WHEN sw = 4 THEN (3 + 1 + (gap <> 1)::INT) / 6 ELSE (4 + 1 + (gap <> 1)::INT) / 8 END"), _d("((sw <> 5)::INT + 1) / 3"), _d("1")),
    "interpretation": (_d("0.5"), _d("1"), _d("1"), _d("1")),
}
_sql = " UNION ALL ".join(f"SELECT doc_id, idx, '{k}' AS layer, {a} AS completeness, {b} AS span, {c} AS enums, {d} AS consistency FROM ann" + (" WHERE done > 0" if k == "emotion" else "") for k, (a, b, c, d) in _part.items())
TERMS = f", tm AS ({_sql}), cf AS (SELECT *, {R('0.3::DOUBLE + completeness * 0.25::DOUBLE + span * 0.2::DOUBLE + enums * 0.15::DOUBLE + consistency * 0.1::DOUBLE', 3)} AS confidence FROM tm)"
measured = on_ann(lambda a: calibrate.terms(rows(a)))
register("conf_terms", on_ann(lambda a: calibrate.terms(rows(a)).select("doc_id", "idx", "layer", *(F.round(c, 6).alias(c) for c in ("completeness", "span", "enums", "consistency")), "confidence")), f"{TERMS} SELECT doc_id, idx, layer, round(completeness, 6) AS completeness, round(span, 6) AS span, round(enums, 6) AS enums, round(consistency, 6) AS consistency, confidence FROM cf")
register("conf_summary", on_ann(lambda a: calibrate.summary(calibrate.terms(rows(a)))), f"{TERMS} SELECT layer, count(*) AS total, {R('avg(confidence)', 3)} AS mean, min(confidence) AS least, max(confidence) AS greatest, count(DISTINCT confidence) AS different FROM cf GROUP BY 1")


# whole craft rows on their way into the tables: right, without a span, out of bounds, nowhere, of no kind, drifted; of an unknown version now and then
PART = "substring(sent, 2, 4)"
CRAFT_ROWS = [
    "doc_id", "idx", "sent as segment", "if(sw = 7, '1.0.0', '2.10.0') as schema_version",
    f"array(named_struct('dim', 'D15', 'kind', if(idx % 6 = 4, 'x', itype), 'text', if(idx % 6 = 3, '一二三四五六', {PART}), 'start', CASE idx % 6 WHEN 1 THEN null WHEN 3 THEN null WHEN 5 THEN 3L ELSE 1L END, 'end', CASE idx % 6 WHEN 1 THEN null WHEN 3 THEN null WHEN 2 THEN length(sent) + 5L WHEN 5 THEN 7L ELSE 5L END, 'score', cast(null as int))) as items",
    "array(named_struct('who', s1, 'pattern', if(gap = 1, '', if(gap = 2, '不在这里', left(sent, 3))))) as voices",
]


def craft_rows(a: DataFrame) -> DataFrame:
    return a.selectExpr(*CRAFT_ROWS)


_bare = "trim(substr(sent, 2, 4), ' ')"
_first = "CASE idx % 6 WHEN 3 THEN 'D15[0] not in text' WHEN 4 THEN 'D15[0] kind' END"
_fixed = "idx % 6 IN (2, 5)"
_message = "array_to_string(list_filter([CASE WHEN sw = 7 THEN 'schema_version' END, " + _first + ", CASE WHEN gap = 1 THEN 'D18[0] pattern' END], lambda x: x IS NOT NULL), ';')"
register(
    "commit_rounds",
    on_ann(lambda a: commit.committed(craft_rows(a)).select("doc_id", "idx", F.col("items")[0]["text"].alias("text"), F.col("items")[0]["start"].alias("start"), F.col("items")[0]["end"].alias("end"), F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"), F.array_join("lost", ";").alias("lost"), "rounds", "repaired", "is_valid")),
    f", c AS (SELECT doc_id, idx, CASE WHEN idx % 6 = 3 THEN '一二三四五六' WHEN {_fixed} THEN {_bare} ELSE substr(sent, 2, 4) END AS text, CASE WHEN idx % 6 IN (1, 3) THEN NULL WHEN {_fixed} THEN instr(sent, {_bare}) - 1 ELSE 1 END::BIGINT AS start, CASE WHEN idx % 6 IN (1, 3) THEN NULL WHEN {_fixed} THEN instr(sent, {_bare}) - 1 + length({_bare}) ELSE 5 END::BIGINT AS end, {_message} AS errors, "
    f"CASE WHEN gap = 2 THEN 'D18[0] elsewhere' ELSE '' END AS warnings, CASE WHEN idx % 6 = 3 THEN 'D15[0] 一二三四五六' ELSE '' END AS lost, CASE WHEN {_fixed} THEN 2 ELSE 1 END::BIGINT AS rounds, CASE WHEN {_fixed} THEN 1 ELSE 0 END::BIGINT AS repaired FROM ann) SELECT *, errors = '' AS is_valid FROM c",
)
register(
    "commit_messages",
    on_ann(lambda a: commit.messages("craft", commit.committed(craft_rows(a))).groupBy("layer", "kind", "message").agg(F.count(F.lit(1)).alias("n"))),
    f", m AS (SELECT 'error' AS kind, unnest(string_split({_message}, ';')) AS message FROM ann WHERE {_message} <> '' UNION ALL SELECT 'warning', 'D18[0] elsewhere' FROM ann WHERE gap = 2 UNION ALL SELECT 'unmatched', 'D15[0] 一二三四五六' FROM ann WHERE idx % 6 = 3) SELECT 'craft' AS layer, kind, message, count(*) AS n FROM m GROUP BY 2, 3",
)
REF = "CASE gap WHEN 1 THEN to_json(named_struct('ref_id', 'r', 'relation_type', rel, 'source', named_struct('segment_id', 1, 'anchor_text', ''), 'target', named_struct('anchor_text', 'x'))) WHEN 2 THEN to_json(named_struct('relation_type', 'other', 'source', 'text')) WHEN 3 THEN 'no json' ELSE to_json(named_struct('ref_id', 'r', 'relation_type', rel, 'source', named_struct('segment_id', 1, 'anchor_text', 'x'), 'target', named_struct('segment_id', 2, 'anchor_text', 'x'))) END"
register(
    "val_references",
    on_ann(lambda a: validate.flat(validate.checked(a.selectExpr("doc_id", "idx", f"{REF} as ref"), validate.reference_rules()))),
    "SELECT doc_id, idx, CASE gap WHEN 1 THEN 'target.segment_id' WHEN 2 THEN 'missing ref_id;missing target;relation_type;target.segment_id' WHEN 3 THEN 'missing ref_id;missing relation_type;missing source;missing target;relation_type;source.segment_id;target.segment_id' ELSE '' END AS errors, CASE gap WHEN 1 THEN 'source.anchor_text' WHEN 2 THEN 'target.anchor_text' WHEN 3 THEN 'source.anchor_text;target.anchor_text' ELSE '' END AS warnings, gap > 3 AS is_valid FROM ann",
)
