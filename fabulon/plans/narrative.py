"""Queries on techniques, portraits and layers, with their oracles. Oracles of other queries stand in as subqueries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabulon.functions import enums as E
from fabulon.operators import graph as G
from fabulon.operators import joins, layers, metrics, portrait, story, validate
from fabulon.operators import segmentation as S
from fabulon.operators import sequence as Q
from fabulon.operators import techniques as T
from fabulon.sources import writers

from . import registry as R
from .fixture import refs, speakers, tags
from .registry import CAUSAL, MOOD, SCENES, SCORE, NUM, TRAITS, W, mood, on_ann, register, trait_items

WORDS = ("the", "und", "que")


def sub(name: str) -> str:
    return f"({R._sql[name]})"


def n_of(name: str, kind: str) -> str:
    return f"SELECT doc_id, '{kind}' AS k, count(*) AS n FROM {sub(name)} GROUP BY 1"


def any_of(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


# pairs of planted and revealed rows; the oracle walks over the rows with the number of open ones
WALK = f"st AS (SELECT doc_id, idx, d06 = '隐藏' AS op, row_number() {W} AS rn FROM ann WHERE d06 IN ('隐藏','揭示')), walk AS (SELECT doc_id, idx, op, rn, op::INT AS open, op AS kept FROM st WHERE rn = 1 UNION ALL SELECT s.doc_id, s.idx, s.op, s.rn, CASE WHEN s.op THEN open + 1 ELSE greatest(open - 1, 0) END, s.op OR open > 0 FROM walk w JOIN st s ON s.doc_id = w.doc_id AND s.rn = w.rn + 1)"
FIFO = f"{WALK}, kp AS (SELECT doc_id, idx, op, row_number() OVER (PARTITION BY doc_id, op ORDER BY idx) AS k FROM walk WHERE kept), fifo AS (SELECT o.doc_id, o.idx AS src, c.idx AS tgt FROM kp o JOIN kp c ON o.doc_id = c.doc_id AND o.k = c.k AND o.op AND NOT c.op)"
register("jn_bracket_queue", on_ann(joins.paired_first_in), f", {FIFO} SELECT * FROM fifo", recursive=True)
register("jn_bracket_stack", on_ann(joins.paired_last_in), f", {WALK}, lv AS (SELECT doc_id, idx, op, CASE WHEN op THEN open ELSE open + 1 END AS d FROM walk WHERE kept) SELECT c.doc_id, max(o.idx) AS src, c.idx AS tgt FROM lv c JOIN lv o ON o.doc_id = c.doc_id AND o.d = c.d AND o.op AND o.idx < c.idx WHERE NOT c.op GROUP BY c.doc_id, c.idx", recursive=True)

# techniques
register(
    "tech_suspense",
    on_ann(lambda a: T.suspense(a, refs(a), WORDS)),
    f", b AS (SELECT doc_id, count(*) FILTER (d06 = '隐藏') AS n_hidden, count(*) FILTER (d06 = '隐藏' AND {any_of('txt', WORDS)}) AS n_questions FROM ann GROUP BY 1), u AS ({n_of('win_serial_runs', 'r')} UNION ALL {n_of('jn_reveal_lookahead', 'u')} UNION ALL SELECT doc_id, 'p', count(*) FROM refs WHERE rel = '伏笔-回收' GROUP BY 1), x AS (SELECT b.*, coalesce(sum(n) FILTER (k = 'r'), 0)::BIGINT AS n_runs, coalesce(sum(n) FILTER (k = 'u'), 0)::BIGINT AS n_unresolved, coalesce(sum(n) FILTER (k = 'p'), 0)::BIGINT AS n_pairs FROM b LEFT JOIN u USING (doc_id) GROUP BY ALL) SELECT *, CASE WHEN n_hidden >= 10 OR n_pairs >= 5 THEN 'high' WHEN n_hidden >= 5 OR n_pairs >= 2 THEN 'moderate' ELSE 'low' END AS intensity FROM x",
)
_kinds = {"win_time_transition": "transition", "win_location_transition": "transition", "win_function_bigram": "transition", "win_parallel_montage": "montage", "win_cross_montage": "montage", "win_contrast_montage": "montage"}
_sums = ", ".join(f"coalesce(sum(u.n) FILTER (k = '{k}'), 0)::BIGINT AS {k}" for k in ("transition", "suspense", "montage", "hook"))
register(
    "tech_density",
    on_ann(T.technique_density),
    f", c AS (SELECT doc_id, count(*) AS m FROM ann GROUP BY 1), u AS ({' UNION ALL '.join(n_of(q, k) for q, k in _kinds.items())} UNION ALL SELECT doc_id, 'suspense', count(*) FROM ann WHERE d06 = '隐藏' GROUP BY 1 UNION ALL SELECT doc_id, 'hook', n_total FROM {sub('win_hooks')}), x AS (SELECT c.doc_id, m, {_sums} FROM c LEFT JOIN u USING (doc_id) GROUP BY 1, 2), y AS (SELECT *, round((transition + suspense + montage + hook) / m, 6) AS density FROM x) SELECT doc_id, transition, suspense, montage, hook, density, CASE WHEN density >= 3 THEN 'dense' WHEN density >= 1.5 THEN 'balanced' ELSE 'plain' END AS style FROM y",
)
PERSP = "pc AS (SELECT doc_id, persp, count(*) AS n, min(idx) AS f, count(*) FILTER (sw = 0) AS s FROM ann GROUP BY 1, 2), po AS (SELECT doc_id, list(persp ORDER BY n DESC, f) AS p, list(n ORDER BY n DESC, f) AS c, sum(s)::BIGINT AS sws, sum(n)::BIGINT AS tot, count(*) FILTER (persp <> '多视角') AS n_real, coalesce(max(n) FILTER (persp = '不可靠叙述者'), 0) AS unr FROM pc GROUP BY 1), pv AS (SELECT *, p[1] AS dominant, c[1] / tot AS ratio, coalesce(c[2] / tot, 0) AS second FROM po)"
register(
    "narrative_style",
    on_ann(T.narrative_style),
    f", {PERSP} SELECT doc_id, CASE WHEN sws >= 2 AND n_real >= 2 AND ratio < 0.7 AND second >= 0.1 THEN '多视角叙事' WHEN ratio > 0.5 THEN CASE dominant WHEN '第一人称' THEN '第一人称叙述' WHEN '第三人称有限' THEN '第三人称有限视角' WHEN '第三人称全知' THEN '第三人称全知视角' ELSE dominant || '主导' END ELSE '混合视角' END AS style, sws = 0 AS is_linear, round(CASE WHEN sws = 0 THEN least(ratio, 0.95::DOUBLE) ELSE greatest(0.5::DOUBLE, 1 - sws / tot) END, 6) AS confidence FROM pv",
)
register("narrative_focal_complexity", on_ann(T.focal_complexity), f", {PERSP} SELECT doc_id, dominant, CASE WHEN ratio >= 0.95 AND sws = 0 THEN 'single' WHEN ratio >= 0.8 AND sws <= tot * 0.1::DOUBLE THEN 'occasional' ELSE 'multiple' END AS complexity, round(sws / tot, 6) AS switch_rate, unr > tot * 0.1::DOUBLE AS unreliable FROM pv")
TIME = "CASE WHEN cl = 'cl0' THEN concat(season, '的回忆') WHEN cl = 'cl1' THEN concat('随后', season) ELSE season END"
register(
    "narrative_time_structure",
    on_ann(lambda a: T.time_structure(a.selectExpr("doc_id", "idx", f"{TIME} as time"))),
    f", t AS (SELECT doc_id, idx, {TIME} AS tm FROM ann WHERE season IS NOT NULL), v AS (SELECT *, lag(tm) {W} AS pt FROM t), n AS (SELECT doc_id, count(*) AS m, count(*) FILTER (contains(tm, '回忆')) AS n_back, count(*) FILTER (pt IS NOT NULL AND tm <> pt AND NOT contains(tm, '随后')) AS n_jumps FROM v GROUP BY 1) SELECT doc_id, n_back, n_jumps, CASE WHEN n_back >= 3 AND n_jumps >= 8 THEN 'nonlinear' WHEN n_back >= 3 OR (n_back >= 1 AND n_jumps >= 5) THEN 'flashback' WHEN n_jumps >= 8 THEN 'jumping' WHEN n_back >= 1 THEN 'linear with memories' ELSE 'linear' END AS kind, round(least(0.95::DOUBLE, 0.4::DOUBLE + (n_back + n_jumps) * 0.03::DOUBLE), 6) AS confidence FROM n WHERE m >= 3",
)
register(
    "story_reader_type",
    on_ann(lambda a: T.reader_type(mood(a))),
    f", {MOOD}, s AS (SELECT doc_id, avg((polarity = 'negative')::INT) AS ng, avg((polarity = 'positive')::INT) AS ps, avg((intensity >= 7)::INT) AS st, count(*) FILTER (polarity = 'positive' AND intensity >= 7) AS hp, count(*) FILTER (polarity = 'negative' AND intensity >= 7) AS hn FROM mood GROUP BY 1) SELECT doc_id, round(ng, 6) AS negative, round(ps, 6) AS positive, round(st, 6) AS strong, CASE WHEN ng > 0.5 AND st > 0.3::DOUBLE THEN '虐心' WHEN ps > 0.5 AND st < 0.3::DOUBLE THEN '治愈' WHEN ps > 0.4::DOUBLE AND hp > hn THEN '燃' WHEN ps > 0.5 THEN '甜' WHEN ng > 0.3::DOUBLE AND ps > 0.3::DOUBLE THEN '虐甜混合' WHEN ng > 0.4::DOUBLE THEN '压抑' ELSE '复杂/中性' END AS kind FROM s",
)
_act = {"exposition": "背景铺垫", "rising_action": "上升行动", "falling_action": "下降行动", "resolution": "结局"}
register(
    "narrative_structure_health",
    on_ann(T.structure_health),
    f", h AS (SELECT doc_id, (5 - {' - '.join(f"max((d01 = '{d}')::INT)" for d in _act.values())} - max((d01 IN ('转折','高潮'))::INT))::BIGINT AS n_missing, round(count(*) FILTER (d01 = '上升行动') / count(*) * 100, 1) AS rising_share FROM ann GROUP BY 1) SELECT *, CASE WHEN rising_share >= 20 AND n_missing <= 1 THEN 'healthy' ELSE 'needs_review' END AS health FROM h",
)
_beat = lambda n, a, z: f"max(CASE WHEN rn - 1 BETWEEN trunc(n * {a}::DOUBLE) AND least(trunc(n * {z}::DOUBLE), n - 1) AND d01 IN ({', '.join(f"'{d}'" for d in T.SIGNALS[n])}) THEN 1 ELSE 0 END)::BIGINT AS {n}"
register("narrative_beat_signals", on_ann(T.beat_signals), f", {NUM}, b AS (SELECT doc_id, {', '.join(_beat(*b) for b in E.BEATS if b[0] in T.SIGNALS)} FROM num GROUP BY 1) SELECT *, round((catalyst + midpoint + all_is_lost + finale) / 4 * 100, 1) AS completeness FROM b")
register("narrative_levels", on_ann(lambda a: T.narrative_levels(a.selectExpr("doc_id", "CASE gap WHEN 1 THEN '2' WHEN 2 THEN '3+' WHEN 3 THEN '' END as level"))), ", l AS (SELECT doc_id, CASE gap WHEN 1 THEN '2' WHEN 2 THEN '3+' ELSE 'unknown' END AS level FROM ann) SELECT doc_id, level, count(*) AS n FROM l GROUP BY 1, 2")
register(
    "graph_degraded_edges",
    on_ann(lambda a: T.degraded_edges(a, G.accepted(G.causal_edges(refs(a), a)))),
    f", {CAUSAL}, {FIFO}, ky AS (SELECT doc_id, idx AS src, lead(idx) {W} AS tgt FROM ann WHERE d01 IN ('激励事件','转折','高潮')), al AS (SELECT *, 'reveal' AS source FROM fifo UNION ALL SELECT *, 'function' FROM ky WHERE tgt IS NOT NULL) SELECT *, 'ENABLE' AS edge_type, 0.5::DOUBLE AS confidence FROM al WHERE doc_id NOT IN (SELECT doc_id FROM edges)",
    recursive=True,
)
register("graph_node_attributes", on_ann(T.node_attributes), "SELECT doc_id, idx, year, loc, emo AS tone, d01, inten, array_to_string(list_sort(list_distinct([x FOR x IN [s1, s2, emo_tgt] IF x IS NOT NULL])), ',') AS participants FROM ann")


# portraits
def said(a: DataFrame) -> DataFrame:
    first = a.selectExpr("doc_id", "idx", "0 as item", "s1 as who", "left(txt, 100) as pattern", "itype as verb", "length(txt) as turn")
    return first.unionByName(a.selectExpr("doc_id", "idx", "1 as item", "s2 as who", "right(txt, 40) as pattern", "d10 as verb", "cast(inten as int) as turn"))


def traits(a: DataFrame) -> DataFrame:
    return story.traits(trait_items(a), TRAITS)


SAID = "said AS (SELECT doc_id, idx, 0 AS item, s1 AS who, left(txt, 100) AS pattern, itype AS verb, length(txt) AS turn FROM ann UNION ALL SELECT doc_id, idx, 1, s2, right(txt, 40), d10, inten FROM ann)"
_moment = "CASE d01 " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in portrait.MOMENTS.items()) + " END"
LINE = f"{SAID}, tl AS (SELECT spk.doc_id, who, idx, d01, inten, {_moment} AS moment, CASE WHEN {_moment} IS NOT NULL OR inten >= 7 THEN 'high' WHEN EXISTS (SELECT 1 FROM said s WHERE s.doc_id = spk.doc_id AND s.idx = spk.idx AND s.who = spk.who) THEN 'medium' ELSE 'low' END AS significance, who IN (s1, s2) AS has_dialogue FROM spk JOIN ann USING (doc_id, idx))"
DECIDED = f"de AS (SELECT doc_id, who, idx, arg_min(pattern, item) AS decision FROM said WHERE {any_of('pattern', WORDS)} GROUP BY 1, 2, 3), dn AS (SELECT *, row_number() OVER (PARTITION BY doc_id, who ORDER BY idx) AS no FROM de QUALIFY no <= 10)"
register("char_timeline", on_ann(lambda a: portrait.timeline(speakers(a), a, said(a))), f", {LINE} SELECT * FROM tl")
register("char_decisions", on_ann(lambda a: portrait.decisions(said(a), WORDS)), f", {SAID}, {DECIDED} SELECT * FROM dn")
register(
    "char_voices",
    on_ann(lambda a: portrait.voices(said(a))),
    f", {SAID}, vb AS (SELECT doc_id, who, verb, count(*) AS n, min(idx * 10 + item) AS f FROM said WHERE verb IS NOT NULL GROUP BY 1, 2, 3), vv AS (SELECT doc_id, who, (list(verb ORDER BY n DESC, f))[1] AS verb, count(*) AS n_verbs FROM vb GROUP BY 1, 2), tu AS (SELECT doc_id, who, round(avg(turn), 6) AS mean_length, count(*) AS n_turns, array_to_string((list(pattern ORDER BY idx, item))[1:10], '|') AS patterns FROM said GROUP BY 1, 2) SELECT tu.*, verb, n_verbs FROM tu LEFT JOIN vv USING (doc_id, who)",
)
register(
    "char_quotes",
    on_ann(lambda a: portrait.quotes(said(a), a.filter("gap = 1").selectExpr("doc_id", "idx", "left(txt, 30) as text"))),
    f", {SAID}, q AS (SELECT s.doc_id, s.who, a.idx, 0 AS at_, 0 AS item, left(a.txt, 30) AS text, 'golden_line' AS kind FROM ann a JOIN (SELECT DISTINCT doc_id, idx, who FROM said) s ON s.doc_id = a.doc_id AND s.idx = a.idx WHERE gap = 1 AND length(left(a.txt, 30)) >= 5 UNION ALL SELECT doc_id, who, idx, 1, item, pattern, 'dialogue' FROM said WHERE length(pattern) >= 8) SELECT doc_id, who, row_number() OVER (PARTITION BY doc_id, who ORDER BY idx, at_, item, text) AS no, idx, kind, text FROM q QUALIFY no <= 10",
)
_aim = lambda fns, p, k: f"(SELECT doc_id, who, array_to_string((list(tag ORDER BY f))[1:{k}], '|') AS v FROM (SELECT doc_id, who, tag, min(idx * 10 + pos) AS f FROM spk JOIN ann USING (doc_id, idx) JOIN tags USING (doc_id, idx) WHERE d01 IN ({fns}) AND pos < {p} GROUP BY 1, 2, 3) GROUP BY 1, 2)"
register(
    "char_desires",
    on_ann(lambda a: portrait.desires(speakers(a), a, tags(a), traits(a))),
    f", pu AS {_aim("'激励事件','高潮'", 2, 3)}, op AS {_aim("'转折','下降行动'", 1, 2)}, dr AS (SELECT doc_id, who, trait FROM {sub('char_traits')} WHERE rank = 1) SELECT w.doc_id, w.who, coalesce(pu.v, '{portrait.UNCLEAR}') AS pursues, coalesce(op.v, '{portrait.UNCLEAR}') AS opposed_by, coalesce(trait, '{portrait.UNCLEAR}') AS driven_by FROM (SELECT DISTINCT doc_id, who FROM spk) w LEFT JOIN pu USING (doc_id, who) LEFT JOIN op USING (doc_id, who) LEFT JOIN dr USING (doc_id, who)",
)
register(
    "char_appraisals",
    on_ann(lambda a: portrait.appraisals(portrait.timeline(speakers(a), a, said(a)), portrait.decisions(said(a), WORDS), traits(a), a)),
    f", {LINE}, {DECIDED}, lf AS (SELECT doc_id, who, count(*) AS n, count(moment) AS km FROM tl GROUP BY 1, 2), md AS (SELECT doc_id, who, count(*) AS nd FROM dn GROUP BY 1, 2), ow AS (SELECT doc_id, who, string_agg(trait, '、' ORDER BY rank) AS own FROM {sub('char_traits')} WHERE rank <= 3 GROUP BY 1, 2), al AS (SELECT lf.*, (SELECT count(*) FROM ann a WHERE a.doc_id = lf.doc_id) AS tot, nd, own FROM lf LEFT JOIN md USING (doc_id, who) LEFT JOIN ow USING (doc_id, who)), rl AS (SELECT *, CASE WHEN n >= tot * 0.3::DOUBLE THEN '主角' WHEN n >= tot * 0.1::DOUBLE THEN '配角' ELSE '次要角色' END AS role, CASE WHEN n >= tot * 0.2::DOUBLE THEN '圆形' ELSE '扁平' END AS kind FROM al) SELECT doc_id, who, role, kind, concat(who, '，', role, '，', kind, '人物。全书出场', n, '段', CASE WHEN km > 0 THEN concat('，参与', km, '个关键时刻') END, CASE WHEN nd > 0 THEN concat('，做出', nd, '个关键决策') END, CASE WHEN own IS NOT NULL THEN concat('。性格特征：', own) END, '。') AS appraisal FROM rl",
)


# layers as JSON text
def raw(a: DataFrame) -> DataFrame:
    s = "named_struct('D01', d01, 'D04', named_struct('core', emo, 'intensity', if(gap = 1, concat('', inten), if(gap = 2, 'high', cast(inten as string))), 'polarity', pol), 'D07', named_struct('type', persp, 'is_switch_point', sw = 0), 'D08', named_struct('time', season, 'space', loc))"
    e = "named_struct('primary', named_struct('emotion', emo, 'intensity', emo_int, 'polarity', emo_pol), 'arc', named_struct('has_shift', sw = 1))"
    text = f"CASE WHEN gap = 3 THEN to_json(named_struct('structure', {s})) ELSE to_json(named_struct('layers', named_struct('structure', {s}))) END"
    with_target = f"CASE WHEN gap = 4 THEN to_json(named_struct('emotion', named_struct('D19_emotion_analysis', {e}, 'target', 'outside'))) WHEN gap = 5 THEN to_json(named_struct('emotion', named_struct('primary', {e}.primary, 'arc', {e}.arc, 'target', emo_tgt))) ELSE to_json(named_struct('layers', named_struct('emotion', named_struct('primary', {e}.primary, 'arc', {e}.arc, 'target', named_struct('name', emo_tgt))))) END"
    return a.selectExpr("doc_id", "idx", f"{text} as raw", f"{with_target} as raw_emotion")


register("proj_structure", on_ann(lambda a: layers.structure(raw(a))), "SELECT doc_id, idx, d01, emo AS core, CASE WHEN gap <> 2 THEN inten END AS inten, pol, persp, sw = 0 AS switch, season AS time, loc AS space FROM ann")
register("proj_emotion", on_ann(lambda a: layers.emotion(raw(a), "raw_emotion")), "SELECT doc_id, idx, emo, emo_int, emo_pol, CASE WHEN gap <> 4 THEN emo_tgt END AS emo_tgt, sw = 1 AS has_shift FROM ann")
register("norm_layer_kind", on_ann(lambda a: raw(a).select("doc_id", "idx", layers.kind("raw").alias("a"), layers.kind("raw_emotion").alias("b"))), "SELECT doc_id, idx, 'structure' AS a, 'emotion' AS b FROM ann")
register(
    "ingest_commit",
    on_ann(lambda a: layers.committed(a.selectExpr("doc_id", "idx", "'D15' as dim", "CASE WHEN cl = 'cl3' THEN '无' ELSE itype END as kind", "CASE WHEN cl = 'cl2' THEN '一二三四五六' ELSE left(txt, 6) END as text", "cast(0 as bigint) as start", "cast(CASE WHEN cl = 'cl4' THEN length(txt) + 1 ELSE length(left(txt, 6)) END as bigint) as `end`", "txt as segment")).select("doc_id", "idx", "start", "end", "text", "outcome")),
    # a repaired quote loses the white space at its ends, and its span goes to the first place of what is left
    r", q AS (SELECT *, CASE WHEN cl = 'cl2' THEN '一二三四五六' ELSE left(txt, 6) END AS quote, regexp_replace(left(txt, 6), '^\s+|\s+$', '', 'g') AS bare FROM ann) SELECT doc_id, idx, CASE WHEN cl = 'cl4' THEN instr(txt, bare) - 1 ELSE 0 END::BIGINT AS start, CASE WHEN cl = 'cl4' THEN instr(txt, bare) - 1 + length(bare) ELSE length(left(txt, 6)) END::BIGINT AS end, CASE WHEN cl = 'cl4' THEN bare ELSE quote END AS text, CASE WHEN cl IN ('cl2', 'cl3') THEN 'rejected' WHEN cl = 'cl4' THEN 'repaired' ELSE 'valid' END AS outcome FROM q",
)
_section = lambda name, column, table="ann": f"SELECT doc_id, '{name}' AS section, {column} AS value, min(idx) AS f, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY 1, 3"
register("report_sections", on_ann(writers.sections), f", s AS ({' UNION ALL '.join(_section(n, c) for n, c in writers.SECTIONS.items())}) SELECT doc_id, section, row_number() OVER (PARTITION BY doc_id, section ORDER BY n DESC, f, value) AS rank, value, n FROM s QUALIFY rank <= 10")


# texts: segments, clean lines, titles, tokens by a lexicon, prompts
def headed(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "concat('一、', source, '\\n\\n', left(text, 300), '\\n第一章 ', lang, '\\n', text, '\\nChapter 2\\n', right(text, 500), '\\n尾声\\n', left(text, 50)) as text")


register("seg_documents", lambda s, d: S.segmented(headed(s, d)))
register("seg_plain_documents", lambda s, d: S.segmented(s.read.parquet(f"{d}/documents.parquet")))
_clean = "concat(text, chr(10), chr(10), chr(10), 'www.abc.com x', chr(10), '求月票 ', lang, chr(10))"
_nested = _clean
for _w in S.WATERMARKS:
    _nested = f"regexp_replace({_nested}, '{_w}', '', 'g')"
register("seg_clean", lambda s, d: S.cleaned(s.read.parquet(f"{d}/documents.parquet").selectExpr("doc_id", f"{_clean.replace('chr(10)', 'char(10)')} as text")).select("doc_id", F.sha2("text", 256).alias("sha256")), f"SELECT doc_id, sha256(regexp_replace(regexp_replace({_nested}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) AS sha256 FROM documents", raw=True)
register(
    "seg_titles",
    lambda s, d: S.possible_titles(s.read.parquet(f"{d}/documents.parquet").selectExpr("doc_id", "posexplode(split(text, '\\n')) as (p, txt)").selectExpr("doc_id", "cast(p as bigint) as idx", "txt")),
    "WITH l AS (SELECT doc_id, i - 1 AS idx, trim(l[i], ' ') AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)), n AS (SELECT *, coalesce(lag(t) OVER w, '') = '' AS b, coalesce(lead(t) OVER w, '') = '' AS a FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY idx)) SELECT doc_id, idx, t AS title FROM n WHERE length(t) BETWEEN 2 AND 15 AND NOT contains('。！？，、；：', right(t, 1)) AND NOT (length(t) > 10 AND contains(t, ' ')) AND b AND (a OR length(t) <= 8)",
    raw=True,
)
PAIRS = ["th", "e ", "un", " d", "qu", "es", "。”"]
register("qm_lexicon_tokens", on_ann(lambda a: metrics.tokens_by(a, PAIRS).select("doc_id", "idx", F.size("tokens").cast("long").alias("n"), F.sha2(F.array_join("tokens", "|"), 256).alias("sha256"))), f", t AS (SELECT doc_id, idx, regexp_extract_all(txt, '{'|'.join(PAIRS)}|[一-鿿]|[a-zA-Z0-9]+') AS t FROM seg) SELECT doc_id, idx, len(t) AS n, sha256(array_to_string(t, '|')) AS sha256 FROM t")
register(
    "proj_prompts",
    on_ann(lambda a: layers.prompts(Q.context_anchors(a).join(a.selectExpr("doc_id", "idx", "txt", "array_compact(array(if(inten >= 4, 'intensity', null), if(d10 is not null, 'dialogue', null))) as reasons", "if(gap = 1, t1, null) as summary"), ["doc_id", "idx"])).select("doc_id", "idx", F.sha2("prompt", 256).alias("sha256"))),
    f", c AS (SELECT *, coalesce(nullif(trim(right(lag(txt) {W}, 200), ' '), ''), '(start)') AS p, coalesce(nullif(trim(left(lead(txt) {W}, 200), ' '), ''), '(end)') AS n FROM ann) SELECT doc_id, idx, sha256(concat('segment: ', idx, chr(10), 'before: ', p, chr(10), 'after: ', n, chr(10), '---', chr(10), txt, chr(10), '---', CASE WHEN gap = 1 THEN concat(chr(10), 'memory: ', t1) END, chr(10), CASE WHEN inten < 4 AND d10 IS NULL THEN 'emotion layer: no trigger' ELSE concat('emotion layer: ', concat_ws('; ', CASE WHEN inten >= 4 THEN 'intensity' END, CASE WHEN d10 IS NOT NULL THEN 'dialogue' END)) END)) AS sha256 FROM c",
)
register(
    "val_json_types",
    on_ann(lambda a: validate.checked(a.selectExpr("doc_id", "idx", "CASE gap WHEN 1 THEN '{\"null_reasons\": [], \"alternatives\": []}' WHEN 2 THEN '{\"null_reasons\": {}, \"alternatives\": 3}' WHEN 3 THEN '{\"null_reasons\": null}' WHEN 4 THEN '{\"chapter\": 1, \"section_type\": null, \"segment_id\": \"a\", \"text_span\": {}}' END as raw"), validate.type_rules() + validate.merged_rules()).select("doc_id", "idx", F.array_join("errors", ";").alias("errors"))),
    f"SELECT doc_id, idx, CASE gap WHEN 1 THEN 'null_reasons;' WHEN 2 THEN 'alternatives;' ELSE '' END || CASE WHEN gap = 4 THEN '' ELSE '{';'.join(f'missing {k}' for k in validate.MERGED)}' END AS errors FROM ann",
)


# classes of characters
HALF = "round(coalesce(avg(CASE WHEN rn > n // 2 THEN {0} END), 0) - coalesce(avg(CASE WHEN rn <= n // 2 THEN {0} END), 0), 6)"
ARCS = f"{MOOD}, cr AS (SELECT doc_id, who, idx, {SCORE} AS score, intensity, row_number() OVER (PARTITION BY doc_id, who ORDER BY idx) AS rn, count(*) OVER (PARTITION BY doc_id, who) AS n FROM spk JOIN mood USING (doc_id, idx)), ca AS (SELECT doc_id, who, count(*) AS m, {HALF.format('score')} AS trend, round(var_pop(score), 6) AS variance, arg_max(score, idx)::BIGINT AS final, {HALF.format('intensity')} AS intensity_trend FROM cr GROUP BY 1, 2)"
register(
    "char_arcs",
    on_ann(lambda a: portrait.arcs(speakers(a), mood(a))),
    f", {ARCS} SELECT doc_id, who, CASE WHEN trend > 0.3::DOUBLE AND final > 0 THEN 'rise' WHEN trend < -0.3::DOUBLE AND final < 0 THEN 'fall' WHEN variance > 0.5::DOUBLE THEN 'wave' WHEN abs(trend) < 0.2::DOUBLE AND variance < 0.3::DOUBLE THEN 'level' ELSE 'mixed' END AS arc, trend, variance, final, intensity_trend, round(least(1, m / 20), 6) AS confidence FROM ca",
)


def curves(a: DataFrame) -> DataFrame:
    return portrait.agency_curves(portrait.timeline(speakers(a), a, said(a).filter("item = 0")))


_in = lambda values: "(" + ", ".join(f"'{v}'" for v in values) + ")"
LEVEL = f"lv AS (SELECT doc_id, who, idx, CASE WHEN d01 IN {_in(portrait.ACTIVE)} OR who = s1 THEN 'active' WHEN d01 IN {_in(portrait.PASSIVE)} THEN 'passive' ELSE 'observer' END AS level, row_number() OVER (PARTITION BY doc_id, who ORDER BY idx) AS rn, count(*) OVER (PARTITION BY doc_id, who) AS n FROM spk JOIN ann USING (doc_id, idx)), cu AS (SELECT doc_id, who, max(n) AS n, {', '.join(f"round(avg((level = '{v}')::INT), 6) AS {v}" for v in ('active', 'passive', 'observer'))}, avg(CASE WHEN rn <= n // 2 THEN (level = 'active')::INT END) AS f, avg(CASE WHEN rn > n // 2 THEN (level = 'active')::INT END) AS s FROM lv GROUP BY 1, 2)"
register("char_agency_curve", on_ann(curves), f", {LEVEL} SELECT doc_id, who, n, active, passive, observer, CASE WHEN n < 4 THEN 'unknown' WHEN s > f + 0.1::DOUBLE THEN 'rise' WHEN s < f - 0.1::DOUBLE THEN 'fall' ELSE 'level' END AS trend FROM cu")
register(
    "char_roles",
    on_ann(lambda a: portrait.roles(curves(a), a)),
    f", {LEVEL}, pr AS (SELECT *, n / (SELECT count(*) FROM ann a WHERE a.doc_id = cu.doc_id) AS p FROM cu) SELECT doc_id, who, round(p, 6) AS presence, CASE WHEN active > 0.5 AND p > 0.3::DOUBLE THEN '主要行动者' WHEN passive > 0.5 THEN '阻碍者' WHEN p < 0.3::DOUBLE THEN '辅助者' ELSE '未知' END AS role, CASE WHEN p < 0.5 THEN floor((0.5 - p) * 10 + 1e-9::DOUBLE)::BIGINT + 1 ELSE 0 END AS gaps FROM pr",
)
register(
    "char_complexity",
    on_ann(lambda a: portrait.complexity(portrait.arcs(speakers(a), mood(a)), traits(a), curves(a))),
    f", {ARCS}, nt AS (SELECT doc_id, who, count(*) AS t FROM {sub('char_traits')} GROUP BY 1, 2), sc AS (SELECT doc_id, who, m, variance, round(least(coalesce(t, 0) / 3, 1) * 0.4::DOUBLE + least(variance / 0.5, 1) * 0.3::DOUBLE + least(m / 20, 1) * 0.3::DOUBLE, 3) AS score FROM ca LEFT JOIN nt USING (doc_id, who)) SELECT doc_id, who, score, CASE WHEN score >= 0.6::DOUBLE THEN '圆形' WHEN score >= 0.3::DOUBLE THEN '尖形' ELSE '扁平' END AS shape, variance > 0.3::DOUBLE AND m > 10 AS dynamic FROM sc",
)
register("char_dialogue_dominance", on_ann(lambda a: portrait.dialogue_dominance(said(a))), f", {SAID}, c AS (SELECT doc_id, who, count(*) AS n FROM said GROUP BY 1, 2), r AS (SELECT *, n / sum(n) OVER (PARTITION BY doc_id) AS q FROM c) SELECT doc_id, who, n, round(q, 6) AS ratio, CASE WHEN q >= 0.4::DOUBLE THEN 'lead' WHEN q >= 0.2::DOUBLE THEN 'major' ELSE 'minor' END AS level FROM r")

# adapters
register(
    "adapter_event_chain",
    on_ann(lambda a: story.event_chain(Q.with_scenes(a))),
    f", {SCENES}, fc AS (SELECT doc_id, scene, d01, count(*) AS c, min(idx) AS f FROM sc GROUP BY 1, 2, 3), lb AS (SELECT doc_id, scene, (list(d01 ORDER BY c DESC, f))[1] AS label FROM fc GROUP BY 1, 2) SELECT sc.doc_id, printf('evt_%03d', sc.scene) AS event_id, label, min(idx) AS start, max(idx) AS end, count(*) AS duration, arg_min(loc, idx) FILTER (loc IS NOT NULL) AS loc, arg_min(season, idx) FILTER (season IS NOT NULL) AS season, max(inten) AS max_intensity FROM sc JOIN lb ON lb.doc_id = sc.doc_id AND lb.scene = sc.scene GROUP BY sc.doc_id, sc.scene, label",
)
register("adapter_relations", on_ann(lambda a: story.rhetorical_relations(G.accepted(G.causal_edges(refs(a), a)))), f", {CAUSAL} SELECT doc_id, printf('rel_%03d', row_number() OVER (PARTITION BY doc_id ORDER BY src, tgt, edge_type)) AS relation_id, CASE edge_type WHEN 'CAUSE' THEN 'cause' ELSE 'enablement' END AS type, src, tgt, confidence FROM edges")
register("adapter_participants", on_ann(lambda a: story.participants(G.entities(speakers(a)))), ", e AS (SELECT doc_id, who, count(*) AS n, min(idx) AS first_idx, max(idx) AS last_idx FROM spk GROUP BY 1, 2) SELECT doc_id, printf('p_%03d', row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_idx, who)) AS participant_id, who, n, first_idx, last_idx FROM e")
register("adapter_object_threads", on_ann(lambda a: story.object_threads(G.object_chains(a))), f", o AS {sub('graph_object_chains')} SELECT doc_id, printf('obj_%03d', row_number() OVER (PARTITION BY doc_id ORDER BY first_idx, cl)) AS thread_id, cl, itype, n FROM o")
