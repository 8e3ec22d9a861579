"""The registered queries: an operator on derived annotations, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabulon.functions import enums as E
from fabulon.functions import similarity
from fabulon.functions import text as X
from fabulon.operators import aggregates as A
from fabulon.operators import entities, gate, joins, layers, metrics, story, validate
from fabulon.operators import graph as G
from fabulon.operators import segmentation as S
from fabulon.operators import sequence as Q

from .fixture import annotated, refs, segments, speakers, sql, tags

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def register(name: str, query: Query, oracle: str | None = None, *, recursive: bool = False, raw: bool = False) -> None:
    _queries[name] = query
    if oracle:
        _sql[name] = oracle if raw else sql(oracle, recursive=recursive)


def on_ann(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(annotated(spark, sf))


def table(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(spark.read.parquet(f"{sf}/{name}.parquet"))


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


W = "OVER (PARTITION BY doc_id ORDER BY idx)"
LAG = lambda *cs: ", ".join(["lag(idx) " + W + " AS prev", *(f"lag({c}) {W} AS prev_{c}" for c in cs)])
FN = "CASE WHEN d01 IN ('背景铺垫','激励事件') THEN '开启' WHEN d01 IN ('上升行动','过渡') THEN '发展' WHEN d01 IN ('高潮','转折') THEN '高潮' WHEN d01 IN ('下降行动','结局') THEN '收束' ELSE '未知' END"
MOOD = "mood AS (SELECT doc_id, idx, CASE WHEN trig THEN emo_pol ELSE pol END AS polarity, CASE WHEN trig THEN emo_int ELSE inten END AS intensity FROM (SELECT *, (inten >= 4 OR d01 IN ('激励事件','转折','高潮','结局') OR d10 IS NOT NULL) AS trig FROM ann))"
SCORE = "CASE polarity WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END"
CAUSAL = "edges AS (SELECT doc_id, src, tgt, CASE rel WHEN '因果' THEN 'CAUSE' ELSE 'ENABLE' END AS edge_type, round(greatest(conf, CASE rel WHEN '因果' THEN 0.75 ELSE 0.65 END), 6) AS confidence FROM refs WHERE rel IN ('因果','伏笔-回收'))"
DEG = "deg AS (SELECT n.doc_id, n.idx, coalesce(sum(o), 0)::BIGINT AS out_degree, coalesce(sum(i), 0)::BIGINT AS in_degree FROM ann n LEFT JOIN (SELECT doc_id, src AS idx, 1 AS o, 0 AS i FROM edges UNION ALL SELECT doc_id, tgt, 0, 1 FROM edges) e ON e.doc_id = n.doc_id AND e.idx = n.idx GROUP BY 1, 2)"
POSITION = "CASE WHEN out_degree = 0 AND in_degree = 0 THEN 0.3 WHEN out_degree = 0 OR in_degree = 0 THEN 1.0 ELSE 0.7 END::DOUBLE"
SCENES = f"sc AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING)::BIGINT AS scene FROM (SELECT *, CASE WHEN prev IS NULL OR NOT ((year IS NULL OR prev_year IS NULL OR year >= prev_year) AND (loc IS NULL OR prev_loc IS NULL OR contains(loc, prev_loc) OR contains(prev_loc, loc)) AND fn = prev_fn) THEN 1 ELSE 0 END AS new FROM (SELECT *, {LAG('year', 'loc', 'fn')} FROM (SELECT *, {FN} AS fn FROM ann)))), scenes AS (SELECT doc_id, scene, min(idx) AS first_idx, max(idx) AS last_idx, count(*) AS n FROM sc GROUP BY 1, 2)"
NUM = "num AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS rn, count(*) OVER (PARTITION BY doc_id) AS n FROM ann)"


def triggered(ann: DataFrame) -> DataFrame:
    return validate.trigger(ann).filter("triggered")


def mood(ann: DataFrame) -> DataFrame:
    return joins.prefer_emotion(ann, triggered(ann))


# sequence
register("win_intensity_jump", on_ann(Q.intensity_jumps), f"SELECT doc_id, prev AS src, idx AS tgt, abs(inten - prev_inten) AS diff FROM (SELECT *, {LAG('inten')} FROM ann) WHERE abs(inten - prev_inten) >= 4")
register("win_perspective_switch", on_ann(Q.perspective_switches), f"SELECT doc_id, prev AS src, idx AS tgt, prev_persp AS from_type, persp AS to_type FROM (SELECT *, {LAG('persp')} FROM ann) WHERE sw = 0 AND prev IS NOT NULL AND persp <> prev_persp")
register("win_scene_continuity", on_ann(Q.scenes), f", {SCENES} SELECT * FROM scenes")
register("win_time_transition", on_ann(Q.time_transitions), f"SELECT doc_id, prev AS src, idx AS tgt, coalesce(abs(year - prev_year) >= 2, false) AS year_gap, coalesce(season <> prev_season, false) AS season_change FROM (SELECT *, {LAG('year', 'season')} FROM ann) WHERE coalesce(abs(year - prev_year) >= 2, false) OR coalesce(season <> prev_season, false)")
register("win_location_transition", on_ann(Q.location_transitions), f"SELECT doc_id, prev AS src, idx AS tgt, prev_loc AS from_loc, loc AS to_loc FROM (SELECT *, {LAG('loc')} FROM ann) WHERE loc <> prev_loc")
register("win_function_bigram", on_ann(Q.function_bigrams), f"SELECT * FROM (SELECT doc_id, prev AS src, idx AS tgt, CASE WHEN prev_d01 = '背景铺垫' AND d01 = '过渡' THEN 'setup' WHEN prev_d01 = '过渡' AND d01 = '上升行动' THEN 'rise' WHEN prev_d01 IN ('高潮','转折') AND d01 IN ('下降行动','背景铺垫','结局') THEN 'release' END AS kind FROM (SELECT *, {LAG('d01')} FROM ann)) WHERE kind IS NOT NULL")
register("win_serial_runs", on_ann(Q.serial_runs), f", r AS (SELECT *, row_number() {W} AS rn FROM ann), h AS (SELECT *, rn - row_number() {W} AS island FROM r WHERE d06 = '隐藏') SELECT doc_id, min(idx) AS first_idx, max(idx) AS last_idx, count(*) AS n FROM h GROUP BY doc_id, island HAVING count(*) >= 3")
register("win_parallel_montage", on_ann(Q.parallel_montage), ", w AS (SELECT doc_id, idx, list(loc) FILTER (loc IS NOT NULL) OVER f AS l, count(*) OVER f AS n, max(idx) OVER f AS last_idx FROM ann WINDOW f AS (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)), c AS (SELECT *, coalesce(len(list_filter(range(1, len(l)), lambda i: l[i] <> l[i + 1])), 0)::BIGINT AS changes FROM w WHERE n = 5) SELECT doc_id, idx AS first_idx, last_idx, changes FROM c WHERE changes >= 3")
register("win_cross_montage", on_ann(Q.cross_montage), ", f AS (SELECT doc_id, idx, d01, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS rn FROM ann WHERE pace >= 4 AND d01 IN ('上升行动','高潮','转折')) SELECT a.doc_id, a.idx, a.d01, count(*) AS switches FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.rn BETWEEN a.rn + 1 AND a.rn + 3 AND b.idx - a.idx <= 3 AND a.d01 <> b.d01 GROUP BY 1, 2, 3 HAVING count(*) >= 2")
register("win_contrast_montage", on_ann(Q.contrast_montage), f"SELECT doc_id, prev AS src, idx AS tgt, prev_pol AS from_pol, pol AS to_pol FROM (SELECT *, {LAG('pol', 'inten')} FROM ann) WHERE inten >= 5 AND prev_inten >= 5 AND pol <> prev_pol AND pol <> 'neutral' AND prev_pol <> 'neutral'")
register("win_hooks", on_ann(Q.hooks), f"SELECT doc_id, count(*) FILTER (a) AS n_suspense, count(*) FILTER (b) AS n_emotion, count(*) FILTER (c) AS n_turn, count(*) FILTER (d) AS n_scene, count(*) FILTER (a OR b OR c OR d) AS n_total FROM (SELECT doc_id, coalesce(d06 IN ('隐藏','误导'), false) AS a, inten >= 8 AS b, d01 IN ('转折','激励事件') AS c, coalesce(loc <> prev_loc, false) AS d FROM (SELECT *, {LAG('loc')} FROM ann)) GROUP BY doc_id")
register("win_year_jump_last_known", on_ann(Q.year_jumps), "SELECT doc_id, idx, known AS from_year, year AS to_year FROM (SELECT *, last_value(year IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known FROM ann) WHERE abs(year - known) >= 5")
register("win_time_jump", on_ann(Q.time_jumps), f"SELECT doc_id, prev AS src, idx AS tgt, season FROM (SELECT *, {LAG('season')} FROM ann WHERE season IS NOT NULL) WHERE season <> prev_season")
register("win_inciting", on_ann(Q.inciting_rows), "SELECT doc_id, coalesce(max(CASE WHEN d01 IN ('激励事件','转折','上升行动') AND idx < climax THEN idx END), min(idx)) AS inciting FROM (SELECT *, min(CASE WHEN d01 = '高潮' THEN idx END) OVER (PARTITION BY doc_id) AS climax FROM ann) GROUP BY doc_id")
register("jn_reveal_lookahead", on_ann(Q.unresolved), "SELECT doc_id, idx FROM (SELECT *, max(CASE WHEN d06 = '揭示' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS r FROM ann) WHERE d06 = '隐藏' AND coalesce(r, 0) = 0")
register("win_nearest_antecedent", on_ann(Q.nearest_antecedents), "SELECT doc_id, idx, a AS antecedent FROM (SELECT *, last_value(emo_tgt IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a FROM ann) WHERE emo_tgt IS NULL AND a IS NOT NULL")
register("win_sampled_points", on_ann(Q.sampled_points), f", {NUM} SELECT doc_id, idx, inten FROM (SELECT *, greatest(1, n // 5) AS step FROM num) WHERE (rn - 1) % step = 0 AND (rn - 1) / step < 6")

# segmentation
register("seg_context_anchors", lambda s, d: Q.context_anchors(segments(s, d)), f"SELECT doc_id, idx, coalesce(right(lag(txt) {W}, 200), '') AS context_prev, coalesce(left(lead(txt) {W}, 200), '') AS context_next FROM seg")
register("seg_adjacent_pairs", lambda s, d: Q.adjacent_pairs(segments(s, d)), f"SELECT * FROM (SELECT doc_id, idx, left(txt, 500) AS head, lead(idx) {W} AS next_idx, left(lead(txt) {W}, 500) AS next_head FROM seg) WHERE next_idx IS NOT NULL")
register("seg_token_estimate", lambda s, d: segments(s, d).select("doc_id", "idx", X.tokens_estimated(F.col("txt")).alias("tokens")), "SELECT doc_id, idx, CASE WHEN length(txt) = 0 THEN 0 ELSE greatest(1, c + l + greatest(0, length(txt) - c - l) // 4) END::BIGINT AS tokens FROM (SELECT *, len(regexp_extract_all(txt, '[一-鿿]')) AS c, len(regexp_extract_all(txt, '[A-Za-z]+')) AS l FROM seg)")
register("seg_scene_groups", on_ann(S.scene_groups), f", g AS (SELECT *, sum(CASE WHEN prev IS NULL OR season IS DISTINCT FROM prev_season THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING)::BIGINT AS scene FROM (SELECT *, {LAG('season')} FROM ann)) SELECT doc_id, idx, scene FROM g")
register("seg_scene_rebuild", on_ann(lambda a: S.rebuilt(S.with_groups(a))), f", g AS (SELECT *, sum(CASE WHEN prev IS NULL OR season IS DISTINCT FROM prev_season THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING)::BIGINT AS scene FROM (SELECT *, {LAG('season')} FROM ann)) SELECT doc_id, scene, min(idx) AS first_idx, max(idx) AS last_idx, count(*) AS merged_from_count, sha256(string_agg(txt, chr(10) ORDER BY idx)) AS text_sha256 FROM g GROUP BY 1, 2")
register("seg_ids", lambda s, d: S.with_ids(segments(s, d)), f"SELECT doc_id, idx, concat(doc_id, '_seg_', lpad((row_number() {W} - 1)::VARCHAR, 4, '0')) AS segment_id, substr(sha256(txt), 1, 16) AS hash FROM seg")
register("seg_greedy", table("documents", S.packed))

# quality gate
register("qg_cjk_ratio", table("documents", gate.cjk_ratio), "SELECT doc_id, CASE WHEN length(text) > 0 THEN len(regexp_extract_all(text, '[一-鿿㐀-䶿　-〿＀-￯]')) / length(text) ELSE 0 END::DOUBLE AS ratio, CASE WHEN ratio >= 0.8 THEN 'pass' WHEN ratio >= 0.56 THEN 'warn' ELSE 'fail' END AS status FROM documents", raw=True)
register("qg_quote_balance", table("documents", gate.quote_balance), "SELECT *, CASE WHEN imbalance <= 0.1 THEN 'pass' WHEN imbalance <= 0.2 THEN 'warn' ELSE 'fail' END AS status FROM (SELECT *, CASE WHEN n_open + n_close > 0 THEN abs(n_open - n_close) / (n_open + n_close) ELSE 0 END::DOUBLE AS imbalance FROM (SELECT doc_id, (length(text) - length(translate(text, '«“「『‘', '')))::BIGINT AS n_open, (length(text) - length(translate(text, '»”」』’', '')))::BIGINT AS n_close FROM documents))", raw=True)
register("qg_garbage_pages", table("pages", lambda p: gate.garbage_density(p, "page_id", "html")), r"SELECT *, CASE WHEN density <= 0.001 THEN 'pass' WHEN density <= 0.01 THEN 'warn' ELSE 'fail' END AS status FROM (SELECT *, CASE WHEN n_chars > 0 THEN n_garbage / n_chars ELSE 0 END::DOUBLE AS density FROM (SELECT page_id, len(regexp_extract_all(html, '(?i)[\x{fffd}\x00-\x08\x0b\x0c\x0e-\x1f]|&nbsp;|&amp;|&lt;|&gt;|<br\s*/?>|<p\s*>|</p>|<div[^>]*>|</div>'))::BIGINT AS n_garbage, length(html)::BIGINT AS n_chars FROM pages))", raw=True)
PARA = r"para AS (SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE list_filter(list_transform(regexp_split_to_array(text, '\n\s*\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') END AS p FROM documents)"


def R(x: str, digits: int) -> str:
    """The oracle's rounding: half up, in the steps of text.rounded."""
    return f"(floor(({x})::DOUBLE * {float(10**digits)}::DOUBLE + 0.5::DOUBLE) / {float(10**digits)}::DOUBLE)"


STATUS = "CASE WHEN score >= 100 THEN 'pass' WHEN score >= 70 THEN 'warn' ELSE 'fail' END"
PSTAT = f"{PARA}, pl AS (SELECT doc_id, len(p)::BIGINT AS n, coalesce(list_sum(list_transform(p, lambda x: length(x)::DOUBLE)), 0) / greatest(len(p), 1) AS mean, coalesce(list_sum(list_transform(p, lambda x: (length(x) * length(x))::DOUBLE)), 0) / greatest(len(p), 1) AS sq, len(list_filter(p, lambda x: length(x) < 10)) / greatest(len(p), 1) AS short FROM para WHERE p IS NOT NULL), pd AS (SELECT *, sqrt(greatest(sq - mean * mean, 0::DOUBLE)) AS sd FROM pl), pc AS (SELECT *, CASE WHEN mean > 0 THEN sd / mean ELSE 0::DOUBLE END AS cv FROM pd), pst AS (SELECT doc_id, n, {R('mean', 1)} AS mean, {R('sd', 1)} AS sd, {R('cv', 3)} AS cv, {R('short', 3)} AS short, CASE WHEN n = 0 THEN 0 WHEN n <= 2 THEN 75 WHEN cv BETWEEN 0.2::DOUBLE AND 1.2::DOUBLE AND short < 0.3::DOUBLE THEN 100 WHEN cv <= 2 AND short < 0.5::DOUBLE THEN 70 ELSE 40 END::BIGINT AS score FROM pc)"
register("qg_paragraph_stats", table("documents", gate.paragraph_stats), f"WITH {PSTAT} SELECT *, {STATUS} AS status FROM pst", raw=True)


def _grams(text: str) -> str:
    return f"g AS (SELECT doc_id, greatest(length({text}) - 4, 0)::BIGINT AS n_grams, len(list_distinct(list_transform(range(1, greatest(length({text}) - 4, 0) + 1), lambda i: substr({text}, i, 5))))::BIGINT AS n_distinct FROM documents), gr AS (SELECT *, round(CASE WHEN n_grams > 0 THEN (n_grams - n_distinct) / n_grams ELSE 0 END, 6)::DOUBLE AS repeated FROM g)"


def _rep(grams: str) -> str:
    return f"{PARA}, {grams}, rp AS (SELECT doc_id, coalesce(len(p), -1) AS n, coalesce(len(list_filter(range(2, len(p) + 1), lambda i: p[i] = p[i - 1] AND length(p[i]) > 20)), 0)::BIGINT AS n_repeated, CASE WHEN n_grams > 1 THEN repeated ELSE 0 END AS ratio FROM para JOIN gr USING (doc_id)), rep AS (SELECT doc_id, n_repeated, {R('ratio', 3)} AS ratio, CASE WHEN n <= 0 THEN 0 WHEN n_repeated = 0 AND ratio < 0.3::DOUBLE THEN 100 WHEN n_repeated <= 2 AND ratio < 0.5::DOUBLE THEN 70 ELSE 40 END::BIGINT AS score FROM rp)"


GRAMS = _grams("left(text, 5000)")
register("qg_gram_repetition", table("documents", gate.gram_repetition), f"WITH {GRAMS} SELECT * FROM gr", raw=True)
REP = _rep(GRAMS)
register("qg_repetition", table("documents", gate.repetition), f"WITH {_rep(_grams('text'))} SELECT *, {STATUS} AS status FROM rep", raw=True)


def _bounded(x: str) -> str:
    return f"least(greatest(floor({x}), 0), 100)::DOUBLE"


GARBAGE = r"len(regexp_extract_all(text, '(?i)[\x{fffd}\x00-\x08\x0b\x0c\x0e-\x1f]|&nbsp;|&amp;|&lt;|&gt;|<br\s*/?>|<p\s*>|</p>|<div[^>]*>|</div>'))"
VERDICT = (
    f"WITH {REP}, {PSTAT[len(PARA) + 2 :]}, c1 AS (SELECT doc_id, status, CASE status WHEN 'pass' THEN 100 WHEN 'warn' THEN {_bounded('ratio / 0.8::DOUBLE * 80')} ELSE {_bounded('ratio / 0.8::DOUBLE * 40')} END::DOUBLE AS score FROM ({_sql['qg_cjk_ratio']})), "
    f"c2 AS (SELECT doc_id, status, CASE status WHEN 'pass' THEN 100 WHEN 'warn' THEN {_bounded('(1 - imbalance) * 80')} ELSE {_bounded('(1 - imbalance) * 50')} END::DOUBLE AS score FROM ({_sql['qg_quote_balance']})), "
    f"c3 AS (SELECT doc_id, CASE WHEN d IS NULL THEN 'fail' WHEN d <= 0.001::DOUBLE THEN 'pass' WHEN d <= 0.01::DOUBLE THEN 'warn' ELSE 'fail' END AS status, CASE WHEN d IS NULL THEN 0 WHEN d <= 0.001::DOUBLE THEN 100 WHEN d <= 0.01::DOUBLE THEN {_bounded('(1 - d * 50) * 80')} ELSE {_bounded('(1 - d * 10) * 40')} END::DOUBLE AS score FROM (SELECT doc_id, CASE WHEN length(text) > 0 THEN {GARBAGE} / length(text) END AS d FROM documents)), "
    f"v AS (SELECT doc_id, c1.score * 0.30::DOUBLE + c2.score * 0.15::DOUBLE + c3.score * 0.20::DOUBLE + pst.score * 0.20::DOUBLE + rep.score * 0.15::DOUBLE AS total, [c1.status, c2.status, c3.status, CASE WHEN pst.score >= 100 THEN 'pass' WHEN pst.score >= 70 THEN 'warn' ELSE 'fail' END, CASE WHEN rep.score >= 100 THEN 'pass' WHEN rep.score >= 70 THEN 'warn' ELSE 'fail' END] AS st FROM c1 JOIN c2 USING (doc_id) JOIN c3 USING (doc_id) JOIN pst USING (doc_id) JOIN rep USING (doc_id)) "
    f"SELECT doc_id, {R('total', 2)} AS score, CASE WHEN list_contains(st, 'fail') THEN 'fail' WHEN list_contains(st, 'warn') THEN 'warn' ELSE 'pass' END AS verdict FROM v"
)
register("qg_verdict", table("documents", gate.verdict), VERDICT, raw=True)

# metrics
TOK = "tok AS (SELECT *, regexp_extract_all(txt, '[一-鿿]|[a-zA-Z0-9]+') AS t FROM seg)"
register("qm_counts", lambda s, d: metrics.counts(segments(s, d)), f", {TOK} SELECT doc_id, idx, length(txt)::BIGINT AS char_count, len(t)::BIGINT AS word_count, s AS sentence_count, {R('length(txt) / greatest(s, 1)', 1)} AS avg_sentence_length FROM (SELECT *, len(list_filter(regexp_split_to_array(txt, '[。！？；…!?;]+'), lambda x: trim(x, ' ') <> ''))::BIGINT AS s FROM tok)")
register("qm_ttr", lambda s, d: metrics.type_token_ratio(segments(s, d)), f", {TOK} SELECT doc_id, idx, {R('len(list_distinct(t)) / greatest(len(t), 1)', 4)} AS ttr FROM tok")
register("qm_punctuation", lambda s, d: metrics.punctuation_density(segments(s, d)), "SELECT doc_id, idx, " + R(r"len(regexp_extract_all(txt, '[，。！？；：、" + '"' + r"''「」『』（）《》【】—…·,.!?;:()\[\]{}\-]')) / greatest(length(txt), 1)", 4) + " AS density FROM seg")
register("qm_dialogue_ratio", lambda s, d: metrics.dialogue_ratio(segments(s, d)), "SELECT doc_id, idx, " + R("coalesce(list_sum(list_transform(regexp_extract_all(txt, '(?s)[「『" + '"' + "“‘].*?[」』" + '"' + "”’]'), lambda x: length(x))), 0) / greatest(length(txt), 1)", 4) + " AS dialogue_ratio FROM seg")
SENSES = {"visual": ["light", "and", "in"], "sound": ["th", "ou"], "touch": ["re", "er", "st"]}
_hits = lambda w: f"(length(txt) - length(replace(txt, '{w}', ''))) / {len(w)}"
register("qm_sense_density", lambda s, d: metrics.word_density(segments(s, d), SENSES), "SELECT doc_id, idx, " + ", ".join(f"{R(f'({' + '.join(map(_hits, ws))}) / greatest(length(txt), 1)', 5)} AS {k}" for k, ws in SENSES.items()) + " FROM seg")
LEXICON = [("the", "noun", 1, ["PA"]), ("of", "verb", 2, ["NB", "ND"]), ("and", "adj", 1, ["PB"]), ("to", "verb", 2, ["NE"]), ("die", "noun", 1, ["PF"]), ("la", "adj", 2, ["NC", "NI"]), ("que", "verb", 1, [])]
POLAR = [x[:3] for x in LEXICON]
_share = lambda cond: R(f"count(*) FILTER ({cond}) / greatest(count(x), 1)", 4)
_parts = {"positive": "pol = 1", "negative": "pol = 2", "anxiety": f"len(list_intersect(cls, {metrics.ANXIETY})) > 0", "adjectives": "pos = 'adj'", "verbs": "pos = 'verb'", "nouns": "pos = 'noun'"}
register("qm_lexicon_shares", lambda s, d: metrics.lexicon_shares(segments(s, d), s.createDataFrame(LEXICON, "w string, pos string, pol int, cls array<string>")), f", {TOK}, lex(w, pos, pol, cls) AS (VALUES {', '.join(f"('{w}', '{pos}', {pol}, {cls}::VARCHAR[])" for w, pos, pol, cls in LEXICON)}), e AS (SELECT doc_id, idx, unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS x FROM tok) SELECT doc_id, idx, {', '.join(f'{_share(c)} AS {k}' for k, c in _parts.items())} FROM e LEFT JOIN lex ON lower(x) = w GROUP BY 1, 2")

# validators and predicates: the oracle restates each rule
BAD = "CASE WHEN d01 IN ('过渡') THEN '过度' ELSE d01 END AS d01, CASE WHEN inten = 10 THEN 11 ELSE inten END AS inten, CASE WHEN pol = 'mixed' THEN 'both' ELSE pol END AS pol"


def spoiled(a: DataFrame) -> DataFrame:
    """Annotations of which some break a rule."""
    return a.selectExpr("doc_id", "idx", "CASE WHEN d01 IN ('过渡') THEN '过度' ELSE d01 END AS d01", "CASE WHEN inten = 10 THEN 11 ELSE inten END AS inten", "CASE WHEN pol = 'mixed' THEN 'both' ELSE pol END AS pol", "pace", "persp", "d10", "'平静' AS mood")


def listed(*rules: tuple[str, str]) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {p} THEN '{i}' END" for i, p in rules) + "], lambda x: x IS NOT NULL), ';')"


register("val_structure_errors", on_ann(lambda a: validate.flat(validate.checked(spoiled(a), validate.structure_rules()))), f", b AS (SELECT doc_id, idx, {BAD} FROM ann), e AS (SELECT doc_id, idx, {listed(('D01', "d01 = '过度'"), ('D04.intensity', 'inten > 10'), ('D04.polarity', "pol = 'both'"))} AS errors FROM b) SELECT doc_id, idx, errors, '' AS warnings, errors = '' AS is_valid FROM e")
register("val_confidence_status", on_ann(lambda a: validate.flat(validate.checked(a.withColumn("overall", F.col("conf") / F.lit(100.0)), validate.confidence_rules()))), f", e AS (SELECT doc_id, idx, {listed(('confirmed below 0.8', "status = 'confirmed' AND conf < 80"))} AS errors, {listed(('tentative at 0.8', "status = 'tentative' AND conf >= 80"))} AS warnings FROM ann) SELECT doc_id, idx, errors, warnings, errors = '' AS is_valid FROM e")
register("val_interpretation", on_ann(lambda a: validate.flat(validate.checked(a.withColumn("themes", F.array("t1", "t2", "t1")), validate.interpretation_rules()))), "SELECT doc_id, idx, '' AS errors, 'D09 repeated' AS warnings, true AS is_valid FROM ann")
register("val_emotion", on_ann(lambda a: validate.flat(validate.checked(a, validate.emotion_rules()))), "SELECT doc_id, idx, '' AS errors, CASE WHEN emo_tgt IS NULL THEN 'target' ELSE '' END AS warnings, true AS is_valid FROM ann")
register("val_cross_refs", on_ann(lambda a: validate.checked(refs(a).withColumn("tgt", F.when(F.col("rel") == "对比", F.col("src") - 1).otherwise(F.col("tgt"))), validate.relation_rules()).selectExpr("doc_id", "src", "tgt", "rel", "array_join(errors, ';') as errors")), "SELECT doc_id, src, CASE WHEN rel = '对比' THEN src - 1 ELSE tgt END AS tgt, rel, CASE WHEN rel = '对比' THEN 'backwards' ELSE '' END AS errors FROM refs")
register("val_text_span", lambda s, d: validate.flat(validate.checked(segments(s, d).withColumns({"start_char": F.lit(0), "end_char": F.length("txt") + F.when(F.col("idx") % 7 == 0, 1).otherwise(0)}), validate.span_rules())), "SELECT doc_id, idx, CASE WHEN idx % 7 = 0 THEN 'span length' ELSE '' END AS errors, '' AS warnings, idx % 7 <> 0 AS is_valid FROM seg")
register("val_totals", on_ann(lambda a: validate.totals(validate.checked(spoiled(a), validate.structure_rules()))), f", b AS (SELECT doc_id, idx, {BAD} FROM ann), e AS (SELECT doc_id, (d01 = '过度')::INT + (inten > 10)::INT + (pol = 'both')::INT AS k FROM b) SELECT doc_id, count(*) AS n, count(*) FILTER (k = 0) AS n_valid, sum(k)::BIGINT AS n_errors FROM e GROUP BY 1")
register("val_quote_check", lambda s, d: validate.quote_check(segments(s, d).withColumn("quote", F.when(F.col("idx") % 3 == 0, F.left("txt", F.lit(12))).when(F.col("idx") % 3 == 1, F.replace(F.left("txt", F.lit(12)), F.lit(" "), F.lit("  "))).otherwise(F.lit("@@@")))).select("doc_id", "idx", "found"), "SELECT doc_id, idx, CASE WHEN contains(txt, q) THEN 'exact' WHEN contains(regexp_replace(txt, '[\\s   -     　\u0085\\x1c-\\x1f]+', '', 'g'), regexp_replace(q, '[\\s   -     　\u0085\\x1c-\\x1f]+', '', 'g')) THEN 'space' ELSE 'missing' END AS found FROM (SELECT *, CASE idx % 3 WHEN 0 THEN left(txt, 12) WHEN 1 THEN replace(left(txt, 12), ' ', '  ') ELSE '@@@' END AS q FROM seg)")
register("pred_p4_trigger", on_ann(lambda a: validate.trigger(a).select("doc_id", "idx", "triggered", "reasons")), "SELECT doc_id, idx, r <> '' AS triggered, r AS reasons FROM (SELECT doc_id, idx, concat_ws(',', CASE WHEN inten >= 4 THEN 'intensity' END, CASE WHEN d01 IN ('激励事件','转折','高潮','结局') THEN 'function' END, CASE WHEN d10 IS NOT NULL THEN 'dialogue' END) AS r FROM ann)")
register("pred_sampling_tier", on_ann(lambda a: validate.sampling_tier(a).select("doc_id", "idx", "tier", "reasons")), "SELECT doc_id, idx, CASE WHEN r <> '' THEN 'deep' WHEN d01 IN ('过渡','背景铺垫') THEN 'skip' ELSE 'light' END AS tier, r AS reasons FROM (SELECT doc_id, idx, d01, concat_ws(',', CASE WHEN d01 IN ('激励事件','转折','高潮','结局') THEN 'function' END, CASE WHEN inten >= 6 THEN 'intensity' END, CASE WHEN sw = 0 THEN 'switch' END) AS r FROM ann)")
register("pred_person_target", on_ann(lambda a: validate.person_targets(a.filter("emo_tgt is not null").select("doc_id", "idx", F.col("emo_tgt").alias("name")), ["c1"], ["c3", "c5"])), "SELECT doc_id, idx, emo_tgt AS name FROM ann WHERE emo_tgt IS NOT NULL AND (emo_tgt = 'c1' OR NOT (contains(emo_tgt, 'c3') OR contains(emo_tgt, 'c5')))")

# joins
register("jn_layer_merge", on_ann(lambda a: joins.merge_layers(a.select("doc_id", "idx"), a.select("doc_id", "idx", "d01", "inten"), triggered(a).select("doc_id", "idx", "emo"), a.filter("d06 is not null").select("doc_id", "idx", "d06"))), "SELECT doc_id, idx, d01, inten, CASE WHEN inten >= 4 OR d01 IN ('激励事件','转折','高潮','结局') OR d10 IS NOT NULL THEN emo END AS emo, d06 FROM ann")
register("jn_relation_projection", on_ann(lambda a: joins.relation_projection(a, refs(a))), "SELECT a.doc_id, a.idx, coalesce(t, '') AS targets, coalesce(s, '') AS sources FROM ann a LEFT JOIN (SELECT doc_id, src, string_agg(tgt::VARCHAR, ',' ORDER BY tgt) AS t FROM refs GROUP BY 1, 2) x ON x.doc_id = a.doc_id AND x.src = a.idx LEFT JOIN (SELECT doc_id, tgt, string_agg(src::VARCHAR, ',' ORDER BY src) AS s FROM refs GROUP BY 1, 2) y ON y.doc_id = a.doc_id AND y.tgt = a.idx")
register("jn_pending_antijoin", on_ann(lambda a: joins.pending(a, a.filter("done = 0"))), "SELECT doc_id, idx FROM ann WHERE done <> 0")
register("jn_emotion_prefer", on_ann(mood), f", {MOOD} SELECT * FROM mood")
register("jn_cooccurrence", on_ann(lambda a: joins.co_occurrence(speakers(a))), "SELECT a.doc_id, a.who AS a, b.who AS b, count(*) AS n FROM spk a JOIN spk b ON a.doc_id = b.doc_id AND a.idx = b.idx AND a.who < b.who GROUP BY 1, 2, 3")
register("jn_speaker_pairs", on_ann(lambda a: joins.co_occurrence(speakers(a.filter("d10 is not null")))), ", d AS (SELECT s.* FROM spk s JOIN ann a ON a.doc_id = s.doc_id AND a.idx = s.idx WHERE a.d10 IS NOT NULL) SELECT a.doc_id, a.who AS a, b.who AS b, count(*) AS n FROM d a JOIN d b ON a.doc_id = b.doc_id AND a.idx = b.idx AND a.who < b.who GROUP BY 1, 2, 3")
register("jn_theme_echo", on_ann(lambda a: joins.theme_echoes(tags(a))), "SELECT DISTINCT a.doc_id, a.tag, a.idx AS src, b.idx AS tgt FROM tags a JOIN tags b ON a.doc_id = b.doc_id AND a.tag = b.tag AND b.idx - a.idx BETWEEN 1 AND 15")
JACCARD = "jac AS (SELECT a.doc_id, a.idx, count(b.idx) AS n, round(coalesce(sum(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s)))), 0), 6) AS overlap FROM (SELECT doc_id, idx, list_distinct([t1, t2]) AS s FROM ann) a LEFT JOIN (SELECT doc_id, idx, list_distinct([t1, t2]) AS s FROM ann) b ON a.doc_id = b.doc_id AND abs(a.idx - b.idx) BETWEEN 1 AND 5 GROUP BY 1, 2)"
register("jn_neighbor_jaccard", on_ann(joins.neighbour_overlap), f", {JACCARD} SELECT * FROM jac")
register("jn_alias_normalize", lambda s, d: joins.canonical_names(speakers(annotated(s, d)), s.createDataFrame([("c1", "c0"), ("c4", "c3")], "alias string, canonical string")).select("doc_id", "idx", "name"), "SELECT doc_id, idx, CASE who WHEN 'c1' THEN 'c0' WHEN 'c4' THEN 'c3' ELSE who END AS name FROM spk")
register("jn_containment", on_ann(lambda a: joins.contained(a.select("doc_id", F.col("cl").alias("a")).distinct(), a.select("doc_id", F.concat(F.col("cl"), F.lit("0")).alias("b")).distinct())), ", x AS (SELECT DISTINCT doc_id, cl AS a FROM ann), y AS (SELECT DISTINCT doc_id, concat(cl, '0') AS b FROM ann) SELECT x.doc_id, a, b FROM x JOIN y USING (doc_id) WHERE contains(a, b) OR contains(b, a)")
register("set_dedup_priority", on_ann(lambda a: joins.deduplicated(refs(a).withColumn("rank", F.lit(0)).unionByName(refs(a).withColumns({"rel": F.lit("zz"), "rank": F.lit(1)})), "rank").select("doc_id", "src", "tgt", "rel")), "SELECT doc_id, src, tgt, rel FROM refs")
register("upsert_last_wins", on_ann(lambda a: joins.upsert(a.select("doc_id", "idx", "d01"), a.filter("done = 0").select("doc_id", "idx", F.col("pol").alias("d01")))), "SELECT doc_id, idx, CASE WHEN done = 0 THEN pol ELSE d01 END AS d01 FROM ann")

# aggregates
register("agg_mode_first_seen", on_ann(lambda a: A.mode_first_seen(a, "d01")), ", c AS (SELECT doc_id, d01, count(*) AS n, min(idx) AS f FROM ann GROUP BY 1, 2) SELECT doc_id, d01 AS value, n FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) = 1")
register("agg_topk", on_ann(lambda a: A.top_k(a, "loc", 3)), ", c AS (SELECT doc_id, loc, count(*) AS n, min(idx) AS f FROM ann GROUP BY 1, 2) SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f, loc NULLS FIRST) AS rank, loc AS value, n FROM c QUALIFY rank <= 3")
register("agg_distribution", on_ann(lambda a: A.distribution(a, "persp")), "SELECT doc_id, persp AS value, count(*) AS n FROM ann GROUP BY 1, 2")
register("agg_moments", on_ann(lambda a: A.moments(a, "inten")), "SELECT doc_id, count(*) AS n, round(avg(inten), 6) AS mean, round(var_pop(inten), 6) AS variance, min(inten) AS low, max(inten) AS high FROM ann GROUP BY 1")
TREND = "round(coalesce(avg(CASE WHEN rn > n // 2 THEN {0} END) - avg(CASE WHEN rn <= n // 2 THEN {0} END), 0), 6)"
register("agg_half_split_trend", on_ann(lambda a: A.half_split_trend(a, "inten")), f", {NUM} SELECT doc_id, {TREND.format('inten')} AS trend FROM num GROUP BY 1")
HEADTAIL = "round(avg(CASE WHEN rn <= greatest(3, n // 10) THEN {0} END), 6) AS head, round(avg(CASE WHEN rn > n - greatest(3, n // 10) THEN {0} END), 6) AS tail"
register("agg_head_tail_mean", on_ann(lambda a: A.head_tail_means(a, "inten")), f", {NUM} SELECT doc_id, {HEADTAIL.format('inten')} FROM num GROUP BY 1")
ACTS = "CASE " + " ".join(f"WHEN d01 = '{k}' THEN '{v}'" for k, v in E.ACTS.items()) + " END"
PLACE = "CASE act " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(E.ACT_ORDER)) + " END"
register("agg_first_occurrence_ranges", on_ann(A.act_ranges), f", {NUM}, a AS (SELECT doc_id, {ACTS} AS act, min(rn - 1) AS first, count(*) AS labelled, max(n) AS n FROM num WHERE {ACTS} IS NOT NULL GROUP BY 1, 2), p AS (SELECT *, {PLACE} AS place FROM a) SELECT p.doc_id, p.act, p.first AS start_segment, coalesce((SELECT arg_min(q.first, q.place) FROM p q WHERE q.doc_id = p.doc_id AND q.place > p.place AND q.first > p.first) - 1, p.n - 1) AS end_segment, p.labelled FROM p")
register("agg_beats", on_ann(A.beats), f", {NUM}, beat(beat, a, z) AS (VALUES {', '.join(f"('{b}', {a}::DOUBLE, {z}::DOUBLE)" for b, a, z in E.BEATS)}) SELECT doc_id, beat, count(*) AS rows, round(avg(inten), 6) AS mean FROM num JOIN beat ON rn - 1 BETWEEN trunc(n * a)::INT AND least(trunc(n * z)::INT, n - 1) GROUP BY 1, 2")
register("agg_five_intervals", on_ann(lambda a: A.five_intervals(a, F.col("d10").isNotNull())), f", {NUM}, b AS (SELECT *, greatest(n // 5, 1) AS size, (rn - 1) // greatest(n // 5, 1) AS interval_ FROM num) SELECT doc_id, interval_::BIGINT AS interval, round(count(*) FILTER (d10 IS NOT NULL) / max(size), 6) AS density FROM b WHERE interval_ < 5 GROUP BY 1, 2")
GENRES = E.GENRES
register("agg_genre_score", on_ann(lambda a: A.keyword_scores(tags(a), GENRES)), " UNION ALL ".join(f"SELECT doc_id, '{g}' AS genre, count(*) AS score FROM tags WHERE {' OR '.join(f"contains(tag, '{w}')" for w in ws)} GROUP BY 1" for g, ws in GENRES.items()))
CRAFTED = "items AS (SELECT doc_id, unnest(['D13','D14','D15','D16','D17']) AS dim, [t1, d01, itype, pol, persp] AS k, unnest([1,2,3,4,5]) AS i FROM ann)"
register("agg_quality_score", on_ann(lambda a: A.quality_score(a.select("doc_id", F.posexplode(F.array("t1", "d01", "itype", "pol", "persp")).alias("p", "kind")).withColumn("dim", F.concat(F.lit("D1"), (F.col("p") + 3).cast("string"))))), f", {CRAFTED}, per AS (SELECT doc_id, dim, count(*) AS n, count(DISTINCT k[i]) AS kinds FROM items GROUP BY 1, 2), w(dim, w, c, t) AS (VALUES {', '.join(f"('{k}', {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for k, (a, b, c) in A.CRAFT.items())}) SELECT doc_id, round(sum((0.4::DOUBLE + least(n / c, 1) * 0.4::DOUBLE + least(kinds / t, 1) * 0.2::DOUBLE) * w) * 100, 4) AS score FROM per JOIN w USING (dim) GROUP BY 1")
register("agg_confidence", on_ann(A.confidence), "SELECT doc_id, idx, round(0.65 + 0.25 * ((d06 IS NOT NULL)::INT + (d10 IS NOT NULL)::INT + (loc IS NOT NULL)::INT + (season IS NOT NULL)::INT + (emo_tgt IS NOT NULL)::INT) / 5 + CASE WHEN pol = emo_pol THEN 0.1 ELSE 0 END, 6)::DOUBLE AS confidence FROM ann")
register("agg_label_agreement", lambda s, d: A.agreement(s.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality"), s.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic"), ["doc_id"], "quality", "toxic"), "SELECT count(*) AS n, count(*) FILTER (a.quality = b.toxic) AS n_equal, round(avg(CASE WHEN a.quality = b.toxic THEN 1.0 ELSE 0.0 END), 6) AS rate FROM labels a JOIN labels b USING (doc_id)", raw=True)
register("agg_sorted_set", on_ann(lambda a: a.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_set("loc")), ",").alias("locs"), F.count_distinct("loc").alias("n"))), "SELECT doc_id, coalesce(string_agg(DISTINCT loc, ',' ORDER BY loc), '') AS locs, count(DISTINCT loc) AS n FROM ann GROUP BY 1")
register("agg_candidate_words", on_ann(lambda a: A.frequent_words(a, E.EMOTIONS[:25], "emo")), f"SELECT emo AS word, count(*) AS n, min((doc_id, idx))[1] AS doc_id, min((doc_id, idx))[2] AS idx FROM ann WHERE emo NOT IN ({quoted(E.EMOTIONS[:25])}) GROUP BY 1 HAVING count(*) >= 3")
register("agg_progress", on_ann(lambda a: A.progress(a.filter("done = 0"), a)), "SELECT doc_id, count(*) AS n, count(*) FILTER (done = 0) AS done, round(100.0 * count(*) FILTER (done = 0) / count(*), 6)::DOUBLE AS percent FROM ann GROUP BY 1")
register("topk_quota", on_ann(lambda a: A.quota_top(a.select("doc_id", "idx", "persp", "inten"), "persp", [F.desc("inten"), F.col("doc_id"), F.col("idx")], 4, 20)), "SELECT doc_id, idx, persp, inten, rank FROM (SELECT doc_id, idx, persp, inten, row_number() OVER (PARTITION BY persp ORDER BY inten DESC, doc_id, idx) AS rank FROM ann) WHERE rank <= 4 ORDER BY rank, persp LIMIT 20")
register("set_diff_both", on_ann(lambda a: validate.enum_differences(a.filter("pace <= 3").select("doc_id", "loc").filter("loc is not null").distinct(), a.filter("pace > 3").select("doc_id", "loc").filter("loc is not null").distinct())), ", l AS (SELECT DISTINCT doc_id, loc FROM ann WHERE pace <= 3 AND loc IS NOT NULL), r AS (SELECT DISTINCT doc_id, loc FROM ann WHERE pace > 3 AND loc IS NOT NULL) (SELECT *, 'left' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM r)) UNION ALL (SELECT *, 'right' FROM (SELECT * FROM r EXCEPT SELECT * FROM l))")
register("export_redacted", lambda s, d: story.redacted(segments(s, d)), "SELECT doc_id, idx, '[redacted]' AS txt, length(txt)::BIGINT AS txt_length FROM seg")

# graphs
register("graph_causal_edges", on_ann(lambda a: G.accepted(G.causal_edges(refs(a), a))), f", {CAUSAL} SELECT e.*, a.d01 AS src_d01, b.d01 AS tgt_d01 FROM edges e JOIN ann a ON a.doc_id = e.doc_id AND a.idx = src JOIN ann b ON b.doc_id = e.doc_id AND b.idx = tgt")
register("graph_rejected_edges", on_ann(lambda a: G.rejected(G.causal_edges(refs(a), a.withColumn("d01", F.when(F.col("d01") != "无法判断", F.col("d01")))))), f", {CAUSAL} SELECT e.doc_id, src, tgt, 'isolated' AS reason FROM edges e JOIN ann a ON a.doc_id = e.doc_id AND a.idx = src JOIN ann b ON b.doc_id = e.doc_id AND b.idx = tgt WHERE a.d01 = '无法判断' OR b.d01 = '无法判断'")
register("graph_degree_position", on_ann(lambda a: G.degrees(G.accepted(G.causal_edges(refs(a), a)), a)), f", {CAUSAL}, {DEG} SELECT *, {POSITION} AS position FROM deg")
register("graph_chains", on_ann(lambda a: G.chains(G.accepted(G.causal_edges(refs(a), a)))), f", {CAUSAL}, walk AS (SELECT DISTINCT doc_id, [src, tgt] AS p FROM edges UNION ALL SELECT w.doc_id, list_append(p, e.tgt) FROM walk w JOIN (SELECT DISTINCT doc_id, src, tgt FROM edges) e ON e.doc_id = w.doc_id AND e.src = p[len(p)] WHERE len(p) < 6 AND NOT list_contains(p, e.tgt)) SELECT doc_id, array_to_string(p, '>') AS path, (len(p) - 1)::BIGINT AS length FROM walk", recursive=True)
register("graph_salience", on_ann(lambda a: G.salience(G.degrees(G.accepted(G.causal_edges(refs(a), a)), a), a, joins.neighbour_overlap(a))), f", {CAUSAL}, {DEG}, {JACCARD}, l AS (SELECT doc_id, idx, d01, {R('least(length(txt) / avg(length(txt)) OVER (PARTITION BY doc_id), 2) / 2', 9)} AS len_ FROM ann), r AS (SELECT doc_id, idx, {R('CASE WHEN n > 0 THEN overlap / n ELSE 0.3::DOUBLE END', 9)} AS again FROM jac), s AS (SELECT doc_id, idx, d01, {R(f'({POSITION}) * 0.4::DOUBLE + len_ * 0.3::DOUBLE + again * 0.3::DOUBLE', 3)} AS salience FROM deg JOIN l USING (doc_id, idx) JOIN r USING (doc_id, idx)) SELECT doc_id, idx, salience, d01 IN ('激励事件','高潮','转折','结局') AND salience >= 0.7::DOUBLE AS core, d01 IN ('转折','高潮') OR salience >= 0.8::DOUBLE AS turning FROM s")
register("graph_causal_types", on_ann(lambda a: G.causal_types(G.accepted(G.causal_edges(refs(a), a)).withColumnRenamed("edge_type", "kind"))), f", {CAUSAL}, e2 AS (SELECT doc_id, src AS idx, edge_type AS k FROM edges UNION ALL SELECT doc_id, tgt, edge_type FROM edges) SELECT doc_id, idx, CASE WHEN count(*) FILTER (k = 'ENABLE') > count(*) FILTER (k = 'CAUSE') THEN '间接因果' ELSE '直接因果' END AS causal_type FROM e2 GROUP BY 1, 2")
register("graph_event_sequence", on_ann(lambda a: G.event_sequence(a, G.accepted(G.causal_edges(refs(a), a)))), f", {CAUSAL}, {DEG} SELECT doc_id, idx, row_number() {W} AS event_no, {FN} AS function, loc, year, in_degree, out_degree FROM deg JOIN ann USING (doc_id, idx) WHERE in_degree + out_degree > 0")
register("graph_object_chains", on_ann(G.object_chains), ", p AS (SELECT doc_id, cl, itype, count(*) AS n, min(idx) AS f, max(idx) AS l FROM ann GROUP BY 1, 2, 3) SELECT doc_id, cl, sum(n)::BIGINT AS n, min(f) AS first_idx, max(l) AS last_idx, arg_max(itype, (n, -f)) AS itype, count(*) > 1 AS shifts FROM p GROUP BY 1, 2 HAVING sum(n) >= 2")


def network(a: DataFrame) -> DataFrame:
    pairs = joins.co_occurrence(speakers(a))
    both = speakers(a).select("doc_id", "idx", F.col("who").alias("a")).join(speakers(a).select("doc_id", "idx", F.col("who").alias("b")), ["doc_id", "idx"]).filter("a < b")
    felt = G.relation_of(F.col("emo"))
    strength = both.join(mood(a), ["doc_id", "idx"]).join(a.select("doc_id", "idx", "emo"), ["doc_id", "idx"]).groupBy("doc_id", "a", "b").agg(F.avg("intensity").alias("mean_intensity"), F.min_by(felt, F.when(felt.isNotNull(), F.col("idx"))).alias("felt"))
    talk = joins.co_occurrence(speakers(a.filter("d10 is not null"))).withColumnRenamed("n", "n_dialogue")
    return G.network_edges(pairs, strength, talk)


_felt = "CASE " + " ".join(f"WHEN contains(emo, '{w}') THEN '{r}'" for w, r in G.RELATION_OF.items()) + " END"
NET = f"{MOOD}, pr AS (SELECT x.doc_id, x.idx, x.who AS a, y.who AS b FROM spk x JOIN spk y ON x.doc_id = y.doc_id AND x.idx = y.idx AND x.who < y.who), ne AS (SELECT pr.doc_id, a, b, count(*) AS n, avg(intensity) AS mi, count(*) FILTER (d10 IS NOT NULL) AS nd, arg_min({_felt}, idx) FILTER ({_felt} IS NOT NULL) AS felt FROM pr JOIN mood USING (doc_id, idx) JOIN ann USING (doc_id, idx) GROUP BY 1, 2, 3), net AS (SELECT doc_id, a, b, n, strength, CASE WHEN strength < 0.1::DOUBLE THEN '陌生' ELSE coalesce(felt, CASE WHEN nd >= 2 THEN '合作' WHEN n >= 3 THEN '友情' ELSE '陌生' END) END AS relation FROM (SELECT *, {R('least(n / 10, 1) * 0.4::DOUBLE + least(mi / 10, 1) * 0.3::DOUBLE + least(nd / 5, 1) * 0.3::DOUBLE', 3)} AS strength FROM ne))"
register("graph_centrality", on_ann(lambda a: G.centrality(network(a))), f", {NET} SELECT doc_id, who, count(*) AS degree, {R('sum(strength)', 3)} AS weight FROM (SELECT doc_id, a AS who, strength FROM net UNION ALL SELECT doc_id, b, strength FROM net) GROUP BY 1, 2")
register("graph_network_edges", on_ann(network), f", {NET} SELECT * FROM net")
register("graph_communities", on_ann(lambda a: G.communities(network(a))), f", {NET} SELECT doc_id, relation, string_agg(DISTINCT who, ',' ORDER BY who) AS members FROM (SELECT doc_id, relation, a AS who FROM net UNION ALL SELECT doc_id, relation, b FROM net) GROUP BY 1, 2")
register("graph_entities", on_ann(lambda a: G.entities(speakers(a))), "SELECT doc_id, who, count(*) AS n, min(idx) AS first_idx, max(idx) AS last_idx FROM spk GROUP BY 1, 2")
register("graph_scene_presence", on_ann(lambda a: G.scene_presence(Q.with_scenes(a), speakers(a))), f", {SCENES} SELECT spk.doc_id, scene, who, count(*) AS n FROM spk JOIN scenes ON scenes.doc_id = spk.doc_id AND idx BETWEEN first_idx AND last_idx GROUP BY 1, 2, 3")
register("narrative_speed", on_ann(G.narrative_speed), "SELECT doc_id, idx, CASE WHEN r > 1.5 AND d10 IS NOT NULL THEN '场景' WHEN r < 0.2 AND coalesce(regexp_matches(time_txt, '跳|年后|次日'), false) THEN '省略' WHEN r < 0.5 THEN '概述' ELSE '正常' END AS speed FROM (SELECT *, length(txt) / avg(length(txt)) OVER (PARTITION BY doc_id) AS r FROM ann)")

# characters and stories
register("char_trajectory", on_ann(lambda a: story.trajectories(speakers(a), mood(a))), f", {MOOD} SELECT doc_id, who, count(*) AS n, round(avg(intensity), 6) AS mean_intensity, count(*) FILTER (intensity >= 7) AS n_key, arg_max(polarity, idx) AS final_polarity, sum({SCORE})::BIGINT AS balance FROM spk JOIN mood USING (doc_id, idx) GROUP BY 1, 2")
register("char_agency", on_ann(lambda a: story.agency(speakers(a), a)), "SELECT doc_id, who, round(avg(CASE WHEN d01 IN ('激励事件','高潮','转折','结局','上升行动','下降行动') THEN 1.0 ELSE 0.0 END), 6) AS agency FROM spk JOIN ann USING (doc_id, idx) GROUP BY 1, 2")
register("char_dominance", on_ann(lambda a: story.dominance(speakers(a))), ", c AS (SELECT doc_id, who, count(*) AS n FROM spk GROUP BY 1, 2) SELECT doc_id, who, round(n / sum(n) OVER (PARTITION BY doc_id), 6) AS share, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, who) AS rank FROM c")
register("char_main", on_ann(lambda a: story.main_characters(speakers(a), a)), ", t AS (SELECT doc_id, count(*) AS total FROM ann GROUP BY 1), c AS (SELECT doc_id, who, count(*) AS n, min(idx) AS f FROM spk GROUP BY 1, 2) SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f, who) AS rank, who, n FROM c JOIN t USING (doc_id) WHERE n >= greatest(3, total * 0.05::DOUBLE) QUALIFY rank <= 15")
register("narrative_focalization", on_ann(story.focalization), ", c AS (SELECT doc_id, persp, count(*) AS n, min(idx) AS f FROM ann GROUP BY 1, 2), m AS (SELECT doc_id, persp AS dominant FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) = 1) SELECT doc_id, dominant, count(DISTINCT persp) AS n_types, count(*) FILTER (sw = 0) AS n_switches FROM ann JOIN m USING (doc_id) GROUP BY 1, 2")
register("narrative_timeline", on_ann(story.timeline), f", y AS (SELECT *, lag(year) {W} AS b FROM ann WHERE year IS NOT NULL) SELECT doc_id, count(*) AS n_years, count(*) FILTER (year > b) AS n_forward, count(*) FILTER (year < b) AS n_back FROM y GROUP BY 1")
register("story_pace", on_ann(story.pace), f", {NUM}, p AS (SELECT doc_id, round(avg(pace), 6) AS mean, round(var_pop(pace), 6) AS variance, {TREND.format('pace')} AS trend FROM num GROUP BY 1) SELECT *, CASE WHEN mean >= 3.5 THEN 'fast' WHEN mean <= 2.5 THEN 'slow' ELSE 'medium' END AS kind FROM p")
_side = lambda c: f"CASE WHEN {c} > 0.3::DOUBLE THEN 'positive' WHEN {c} < -0.3::DOUBLE THEN 'negative' ELSE 'mixed/neutral' END"
ARC = f"{MOOD}, m AS (SELECT *, ({SCORE})::DOUBLE AS score, row_number() {W} AS rn, count(*) OVER (PARTITION BY doc_id) AS size FROM mood), h AS (SELECT doc_id, count(*) AS n, sum(score) FILTER (rn <= greatest(3, size // 10)) / count(*) FILTER (rn <= greatest(3, size // 10)) AS head, sum(score) FILTER (rn > size - greatest(3, size // 10)) / count(*) FILTER (rn > size - greatest(3, size // 10)) AS tail, sum(score * score) / count(*) - (sum(score) / count(*)) * (sum(score) / count(*)) AS variance, count(*) FILTER (score < 0) / count(*) AS neg, count(*) FILTER (score > 0) / count(*) AS pos, max(intensity) AS peak, arg_min(idx, (-coalesce(intensity, 0), idx)) AS peak_at FROM m GROUP BY 1), i AS (SELECT *, tail - head AS tr, {_side('head')} AS sp, {_side('tail')} AS ep FROM h)"
register(
    "story_emotion_arc", on_ann(lambda a: story.emotion_arc(mood(a))),
    f", {ARC} SELECT doc_id, CASE WHEN n < 5 THEN '数据不足' WHEN neg > 0.5::DOUBLE AND (ep = 'negative' OR tr < -0.1::DOUBLE) THEN '悲剧弧线（压抑→下行）' WHEN pos > 0.5::DOUBLE AND (ep = 'positive' OR tr > 0.1::DOUBLE) THEN '喜剧弧线（上升→圆满）' WHEN variance > 0.3::DOUBLE AND (ep = 'mixed/neutral' OR (neg > 0.3::DOUBLE AND pos > 0.3::DOUBLE)) THEN '悲喜剧弧线（起伏→释然）' WHEN variance > 0.5::DOUBLE THEN '波动型弧线（大起大落）' WHEN ep = 'mixed/neutral' AND neg > 0.3::DOUBLE THEN '悲剧弧线（余韵悠长）' WHEN ep = 'mixed/neutral' THEN '开放式结局（余韵悠长）' ELSE '平稳型弧线' END AS pattern, "
    f"CASE WHEN n >= 5 THEN sp END AS start_polarity, CASE WHEN n >= 5 THEN ep END AS end_polarity, CASE WHEN n >= 5 THEN peak END AS peak_intensity, CASE WHEN n >= 5 THEN peak_at END AS peak_idx, CASE WHEN n >= 5 THEN {R('tr', 2)} END AS trend, CASE WHEN n >= 5 THEN {R('variance', 2)} END AS variance, CASE WHEN n >= 5 THEN {R('least(0.9::DOUBLE, 0.4::DOUBLE + n * 0.01::DOUBLE)', 2)} ELSE 0 END::DOUBLE AS confidence FROM i",
)
register("story_reader_experience", on_ann(story.reader_experience), "SELECT doc_id, round(count(*) FILTER (d06 IN ('隐藏','误导')) / count(*), 6) AS suspense, round(count(*) FILTER (inten >= 7) / count(*), 6) AS tension, round(count(*) FILTER (emo_pol IN ('positive','negative')) / count(*), 6) AS involvement FROM ann GROUP BY 1")
register("adapter_times_places", on_ann(story.times_and_places), ", o AS (SELECT doc_id, idx, 'time' AS kind, season AS value FROM ann WHERE season IS NOT NULL UNION ALL SELECT doc_id, idx, 'place', loc FROM ann WHERE loc IS NOT NULL), f AS (SELECT doc_id, kind, value, min(idx) AS first_idx FROM o GROUP BY 1, 2, 3) SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY first_idx, value) AS no FROM f")
register("adapter_plot_buckets", on_ann(story.plot_buckets), f", {NUM} SELECT doc_id, ((rn - 1) * 3 // n)::BIGINT AS third, {FN} AS fn, count(*) AS n FROM num GROUP BY 1, 2, 3")
register("story_graph", on_ann(lambda a: story.story_graph(scenes=Q.scenes(a).select("doc_id", "scene", "first_idx", "last_idx"), objects=G.object_chains(a).select("doc_id", "cl", "n"))))


# further summaries
TRAITS = E.TRAITS


def trait_items(a: DataFrame) -> DataFrame:
    said = a.select("doc_id", F.col("s1").alias("who"), F.concat("t1", F.lit(" "), "s2").alias("text"), F.lit(1.0).alias("weight"))
    return said.unionByName(a.select("doc_id", F.col("s2").alias("who"), F.concat("t2", F.lit(" "), "cl").alias("text"), F.lit(0.5).alias("weight")))


_trait = lambda ws: " + ".join(f"contains(text, '{w}')::INT" for w in ws)
register("char_traits", on_ann(lambda a: story.traits(trait_items(a), TRAITS)), ", it AS (SELECT doc_id, s1 AS who, concat(t1, ' ', s2) AS text, 1.0::DOUBLE AS weight FROM ann UNION ALL SELECT doc_id, s2, concat(t2, ' ', cl), 0.5::DOUBLE FROM ann), h AS (" + " UNION ALL ".join(f"SELECT doc_id, who, '{t}' AS trait, ({_trait(ws)}) AS hits, weight * {by}::DOUBLE AS weight FROM it" for t, (by, ws) in TRAITS.items()) + "), sc AS (SELECT doc_id, who, trait, round(sum(hits * weight), 6) AS score FROM h WHERE hits > 0 GROUP BY 1, 2, 3) SELECT *, row_number() OVER (PARTITION BY doc_id, who ORDER BY score DESC, trait) AS rank FROM sc QUALIFY rank <= 5")
MAIN = "tot AS (SELECT doc_id, count(*) AS total FROM ann GROUP BY 1), cnt AS (SELECT doc_id, who, count(*) AS n, min(idx) AS f FROM spk GROUP BY 1, 2), mainc AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f, who) AS rank, who, n FROM cnt JOIN tot USING (doc_id) WHERE n >= greatest(3, total * 0.05::DOUBLE) QUALIFY rank <= 15)"
register("char_biography", on_ann(lambda a: story.biographies(speakers(a), a, mood(a), network(a))), f", {NET}, {MAIN}, life AS (SELECT doc_id, who, min(idx) AS first_idx, max(idx) AS last_idx, count(*) FILTER (d01 IN ('转折','高潮')) AS n_turning, round(avg(intensity), 6) AS mean_intensity FROM spk JOIN ann USING (doc_id, idx) JOIN mood USING (doc_id, idx) GROUP BY 1, 2), bo AS (SELECT doc_id, a AS who, b AS other, strength FROM net UNION ALL SELECT doc_id, b, a, strength FROM net), nr AS (SELECT doc_id, who, string_agg(other, ',' ORDER BY rn) AS relations FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, who ORDER BY strength DESC, other) AS rn FROM bo) WHERE rn <= 8 GROUP BY 1, 2) SELECT m.doc_id, m.who, m.rank, m.n, first_idx, last_idx, n_turning, mean_intensity, coalesce(relations, '') AS relations FROM mainc m JOIN life USING (doc_id, who) LEFT JOIN nr USING (doc_id, who)")
_scores = "sco AS (" + " UNION ALL ".join(f"SELECT doc_id, '{g}' AS genre, count(*) AS score FROM tags WHERE {' OR '.join(f"contains(tag, '{w}')" for w in ws)} GROUP BY 1" for g, ws in GENRES.items()) + ")"
register("story_genre", on_ann(lambda a: story.genre(A.keyword_scores(tags(a), GENRES))), f", {_scores} SELECT doc_id, genre, round(score / sum(score) OVER (PARTITION BY doc_id), 6) AS confidence FROM sco QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, genre) = 1")
register("jn_target_reuse", on_ann(lambda a: joins.reuse_edges(a, "emo_tgt")), "SELECT * FROM (SELECT doc_id, emo_tgt AS value, lag(idx) OVER (PARTITION BY doc_id, emo_tgt ORDER BY idx) AS src, idx AS tgt FROM ann WHERE emo_tgt IS NOT NULL) WHERE src IS NOT NULL")
register("jn_imagery_reuse", on_ann(lambda a: joins.reuse_edges(a, "cl")), "SELECT * FROM (SELECT doc_id, cl AS value, lag(idx) OVER (PARTITION BY doc_id, cl ORDER BY idx) AS src, idx AS tgt FROM ann) WHERE src IS NOT NULL")
register("jn_boundary_lookup", on_ann(lambda a: joins.boundary_lookup(Q.adjacent_pairs(a).select("doc_id", "idx", "next_idx"), refs(a).select("doc_id", F.col("src").alias("a"), F.col("tgt").alias("b"), F.lit(True).alias("is_boundary")))), f", p AS (SELECT * FROM (SELECT doc_id, idx, lead(idx) {W} AS next_idx FROM ann) WHERE next_idx IS NOT NULL) SELECT p.doc_id, p.idx, p.next_idx, r.src IS NOT NULL AS is_boundary FROM p LEFT JOIN refs r ON r.doc_id = p.doc_id AND r.src = p.idx AND r.tgt = p.next_idx")
register("agg_coverage_gap", lambda s, d: A.coverage_gap(s.createDataFrame([(e,) for e in [*E.EMOTIONS, "none"]], "name string"), annotated(s, d).select(F.col("emo").alias("name"))), f", c(name) AS (VALUES {', '.join(f"('{e}')" for e in [*E.EMOTIONS, 'none'])}) SELECT name, count(emo) AS n FROM c LEFT JOIN ann ON emo = name GROUP BY 1")
register("agg_polarity_vote", lambda s, d: A.polarity_vote(metrics.lexicon_shares(segments(s, d), s.createDataFrame(LEXICON, "w string, pos string, pol int, cls array<string>")), annotated(s, d)), f", {TOK}, lex(w, pos, lp) AS (VALUES {', '.join(map(str, POLAR))}), e AS (SELECT doc_id, idx, unnest(CASE WHEN len(t) = 0 THEN [NULL] ELSE t END) AS x FROM tok), v AS (SELECT doc_id, idx, count(*) FILTER (lp = 1) AS p, count(*) FILTER (lp = 2) AS n FROM e LEFT JOIN lex ON lower(x) = w GROUP BY 1, 2) SELECT doc_id, round(avg(CASE WHEN (CASE WHEN p > 0 AND p >= n THEN 'positive' WHEN n > 0 THEN 'negative' ELSE 'neutral' END) = pol THEN 1.0 ELSE 0.0 END), 6) AS consistency FROM v JOIN ann USING (doc_id, idx) GROUP BY 1")
register("val_craft", on_ann(lambda a: validate.checked(a.selectExpr("doc_id", "idx", "'D15' as dim", "CASE WHEN cl = 'cl3' THEN '无' ELSE itype END as kind", "left(txt, 6) as text", "0 as start", "CASE WHEN cl = 'cl4' THEN length(txt) + 1 ELSE 1 END as `end`", "txt as segment"), validate.craft_rules()).selectExpr("doc_id", "idx", "array_join(errors, ';') as errors")), f"SELECT doc_id, idx, {listed(('text', "trim(left(txt, 6), ' ') = ''"), ('kind', "cl = 'cl3'"), ('bounds', "cl = 'cl4'"))} AS errors FROM ann")
register("norm_segment_number", lambda s, d: Q.with_previous(segments(s, d)).select("doc_id", "idx", X.segment_number(F.concat(F.lit("d_"), F.when(F.col("idx") % 3 == 0, "seg_").when(F.col("idx") % 3 == 1, "scene_").otherwise("x"), F.col("idx").cast("string"))).cast("long").alias("number")), "SELECT doc_id, idx, idx AS number FROM seg")
register("sink_sampling_plan", on_ann(lambda a: validate.sampling_tier(a).groupBy("doc_id", "tier").agg(F.array_join(F.sort_array(F.collect_list("idx")), ",").alias("segments"))), ", t AS (SELECT doc_id, idx, CASE WHEN d01 IN ('激励事件','转折','高潮','结局') OR inten >= 6 OR sw = 0 THEN 'deep' WHEN d01 IN ('过渡','背景铺垫') THEN 'skip' ELSE 'light' END AS tier FROM ann) SELECT doc_id, tier, string_agg(idx::VARCHAR, ',' ORDER BY idx) AS segments FROM t GROUP BY 1, 2")
register("lexicon_subset", on_ann(lambda a: A.lexicon_subset(a.selectExpr("loc as w0", "CASE itype WHEN '自然意象' THEN 'noun' WHEN '器物意象' THEN 'verb' WHEN '人体意象' THEN 'adj' ELSE 'x' END as pos", "cl as cls", "inten % 3 as pol", "doc_id * 100000 + idx as at").withColumn("w", F.right("w0", F.lit(2))).filter("w is not null"))), ", x AS (SELECT right(loc, 2) AS w, CASE itype WHEN '自然意象' THEN 'noun' WHEN '器物意象' THEN 'verb' WHEN '人体意象' THEN 'adj' ELSE 'x' END AS pos, cl AS cls, inten % 3 AS pol, doc_id * 100000 + idx AS at_ FROM ann WHERE loc IS NOT NULL), y AS (SELECT * FROM x WHERE pos <> 'x'), p AS (SELECT w, pol, count(*) AS n, min(at_) AS f FROM y GROUP BY 1, 2), q AS (SELECT w, pol FROM p QUALIFY row_number() OVER (PARTITION BY w ORDER BY n DESC, f) = 1) SELECT w, arg_min(pos, at_) AS pos, string_agg(DISTINCT cls, ',' ORDER BY cls) AS cls, q.pol AS pol FROM y JOIN q USING (w) GROUP BY w, q.pol")


# rules on texts
_hint = lambda c: "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p}') THEN {i}" for i, p in enumerate(X.DAY, 1)) + " END"
_marker = lambda c, k: f"nullif(regexp_extract({c}, '{X.MARKERS[k]}'), '')"
register("dt_time_markers", on_ann(lambda a: a.select("doc_id", "idx", X.time_hint(F.col("time_txt")).cast("long").alias("hint"), *(X.time_marker(F.col("time_txt"), k).alias(k) for k in X.MARKERS))), f"SELECT doc_id, idx, ({_hint('time_txt')})::BIGINT AS hint, {', '.join(f'{_marker("time_txt", k)} AS {k}' for k in X.MARKERS)} FROM ann")
_place = lambda c: f"nullif(trim(regexp_replace(regexp_replace({c}, '^(在|位于|到了|来到|进入|离开)\\s*', ''), '\\s*(里|中|内|上|下|旁|附近)$', '')), '')"
register("str_plain_place", on_ann(lambda a: a.select("doc_id", "idx", X.plain_place(F.col("space_txt")).alias("place"))), f"SELECT doc_id, idx, {_place('space_txt')} AS place FROM ann")


def continuity(a: DataFrame) -> DataFrame:
    rows = Q.with_previous(a.select("doc_id", "idx", "time_txt", "space_txt"), "time_txt", "space_txt").filter("prev is not null")
    return rows.select("doc_id", "idx", X.time_goes_on(F.col("prev_time_txt"), F.col("time_txt")).alias("time_goes_on"), X.same_place(F.col("prev_space_txt"), F.col("space_txt")).alias("same_place"))


_explicit = lambda c: f"(({_hint(c)}) IS NOT NULL OR regexp_matches({c}, '{X.BY_CHAPTER}'))"
register("dt_time_continuity", on_ann(continuity), f", p AS (SELECT *, {LAG('time_txt', 'space_txt')} FROM ann), c AS (SELECT *, {_hint('prev_time_txt')} AS h0, {_hint('time_txt')} AS h1, {_place('prev_space_txt')} AS pl0, {_place('space_txt')} AS pl1 FROM p WHERE prev IS NOT NULL) SELECT doc_id, idx, CASE WHEN prev_time_txt IS NOT NULL AND time_txt IS NOT NULL AND {_explicit('prev_time_txt')} AND {_explicit('time_txt')} THEN CASE WHEN h0 IS NOT NULL AND h1 IS NOT NULL THEN h1 >= h0 ELSE trim(prev_time_txt) = trim(time_txt) END ELSE true END AS time_goes_on, coalesce(contains(pl0, pl1) OR contains(pl1, pl0), true) AS same_place FROM c")
_form = "trim(regexp_replace(regexp_replace(word, '[（(].*?[)）]', '', 'g'), '[《》「」『』\"“”''‘’·]', '', 'g'))"
register("str_word_form", on_ann(lambda a: a.select("doc_id", "idx", X.word_form(F.col("word")).alias("form"))), f"SELECT doc_id, idx, {_form} AS form FROM ann")
for _layer in similarity.TERMS:
    _term = "CASE word " + " ".join(f"WHEN '{x}' THEN '{y}'" for x, y in similarity.TERMS[_layer].items()) + " ELSE word END"
    register(f"term_changes_{_layer}", on_ann(lambda a, layer=_layer: similarity.normalised_rows(a, "word", layer)[1]), f"SELECT word AS old, {_term} AS new, count(*) AS n FROM ann WHERE word <> {_term} GROUP BY 1, 2")
    register(f"term_rows_{_layer}", on_ann(lambda a, layer=_layer: similarity.normalised_rows(a.select("doc_id", "idx", "word"), "word", layer)[0]), f"SELECT doc_id, idx, {_term} AS word FROM ann")
register("str_anchor", on_ann(lambda a: a.select("doc_id", "idx", X.anchor(F.col("txt")).alias("a")).select("doc_id", "idx", "a.text", F.col("a.start").cast("long").alias("start"), F.col("a.end").cast("long").alias("end"))), "SELECT doc_id, idx, left(txt, 24) AS text, (instr(txt, left(txt, 6)) - 1)::BIGINT AS start, (instr(txt, left(txt, 6)) - 1 + length(left(txt, 24)))::BIGINT AS end FROM ann")
# fixed names of the derived sentences
NAMED = ["王秀英", "秀英", "张伟", "李明"]
FEMALE, MALE = "秀英华娟", "伟明强刚"
_names = lambda a: a.select("doc_id").distinct().withColumn("who", F.explode(F.array(*map(F.lit, NAMED))))
_sent = lambda a: a.select("doc_id", "idx", F.col("sent").alias("txt"))
_at = lambda part: f"list_filter(range(1, length(sent) + 1), lambda i: substr(sent, i, length({part})) = {part})"
NAMES_SQL = f"nm AS (SELECT doc_id, idx, sent, who, unnest({_at('who')}) AS pos FROM ann, (VALUES {', '.join(f"('{n}')" for n in NAMED)}) v(who)), np AS (SELECT doc_id, idx, who, pos FROM nm WHERE NOT (pos > 1 AND regexp_matches(substr(sent, pos - 1, 1), '[一-鿿]')) AND NOT regexp_matches(substr(sent, pos + length(who), 1), '[一-鿿]'))"
PRON_SQL = f"pn AS (SELECT doc_id, idx, text, gender, unnest({_at('text')}) AS pos FROM ann, (VALUES {', '.join(f"('{w}', '{g}')" for g, ws in entities.PRONOUNS.items() for w in ws)}) v(text, gender))"
register("entity_name_places", on_ann(lambda a: entities.name_places(_sent(a), _names(a))), f", {NAMES_SQL} SELECT * FROM np")
register("entity_mentions", on_ann(lambda a: entities.mentions(_sent(a), _names(a))), f", {NAMES_SQL} SELECT doc_id, idx, who, count(*) AS n FROM np GROUP BY 1, 2, 3")
register("entity_pronouns", on_ann(lambda a: entities.pronouns(_sent(a))), f", {PRON_SQL} SELECT doc_id, idx, text, gender, pos FROM pn")
_marks = lambda chars: f"len(list_intersect(list_distinct(string_split(who, '')), string_split('{chars}', '')))"
GENDER_SQL = f"CASE WHEN {_marks(FEMALE)} > {_marks(MALE)} THEN 'female' WHEN {_marks(MALE)} > {_marks(FEMALE)} THEN 'male' END"
register("entity_gender", on_ann(lambda a: _names(a).withColumn("gender", entities.gender_of(F.col("who"), FEMALE, MALE))), f"SELECT DISTINCT doc_id, who, {GENDER_SQL} AS gender FROM ann, (VALUES {', '.join(f"('{n}')" for n in NAMED)}) v(who)")
register(
    "entity_resolved_pronouns", on_ann(lambda a: entities.resolved_pronouns(_sent(a), entities.name_places(_sent(a), _names(a)).withColumn("gender", entities.gender_of(F.col("who"), FEMALE, MALE)), entities.pronouns(_sent(a)))),
    f", {NAMES_SQL}, {PRON_SQL}, g AS (SELECT *, {GENDER_SQL} AS gender FROM np), l AS (SELECT doc_id, idx, arg_max(who, (-length(who), pos, who)) FILTER (gender = 'male') AS m, arg_max(who, (-length(who), pos, who)) FILTER (gender = 'female') AS f FROM g GROUP BY 1, 2), k AS (SELECT a.doc_id, a.idx, last_value(m IGNORE NULLS) OVER o AS m, last_value(f IGNORE NULLS) OVER o AS f FROM ann a LEFT JOIN l ON l.doc_id = a.doc_id AND l.idx = a.idx WINDOW o AS (PARTITION BY a.doc_id ORDER BY a.idx ROWS UNBOUNDED PRECEDING)) "
    "SELECT doc_id, idx, text, pos, CASE gender WHEN 'male' THEN m WHEN 'female' THEN f END AS resolved_to, 0.7::DOUBLE AS confidence FROM pn JOIN k USING (doc_id, idx) WHERE CASE gender WHEN 'male' THEN m WHEN 'female' THEN f END IS NOT NULL",
)


# details of the layers, each rule broken in some rows
_no = lambda kind: f"cast(NULL AS {kind})"
DETAIL = {
    "structure": (
        validate.structure_detail_rules,
        ["CASE WHEN idx % 11 = 0 THEN NULL ELSE true END AS is_switch_point", "CASE WHEN idx % 13 = 0 THEN NULL ELSE named_struct('time_type', CASE WHEN idx % 5 = 0 THEN 'sideways' ELSE 'linear' END, 'narrative_level', CASE WHEN idx % 7 = 0 THEN '9' END) END AS d08", "CASE WHEN idx % 6 = 0 THEN array() WHEN idx % 6 = 1 THEN array('环境描写', '别的') ELSE array('环境描写') END AS d11", "CASE WHEN idx % 4 > 0 THEN named_struct('mode', CASE WHEN idx % 3 = 0 THEN '别的' ELSE '场景' END, 'density', CASE WHEN idx % 9 = 0 THEN 1.5D ELSE 0.5D END, 'is_summary', CASE WHEN idx % 10 = 0 THEN NULL ELSE false END, 'is_scene', CASE WHEN idx % 12 = 1 THEN NULL ELSE true END) END AS d12", "CASE WHEN idx % 8 = 0 THEN 'cover' ELSE 'body' END AS section_type"],
        [("D07.is_switch_point", "idx % 11 = 0"), ("D08", "idx % 13 = 0"), ("D08._time_type", "idx % 13 <> 0 AND idx % 5 = 0"), ("D08._narrative_level", "idx % 13 <> 0 AND idx % 7 = 0"), ("D11", "idx % 6 = 0"), ("D11 value", "idx % 6 = 1"), ("D12.mode", "idx % 4 > 0 AND idx % 3 = 0"), ("D12.density", "idx % 4 > 0 AND idx % 9 = 0"), ("D12.is_summary", "idx % 4 > 0 AND idx % 10 = 0"), ("D12.is_scene", "idx % 4 > 0 AND idx % 12 = 1"), ("section_type", "idx % 8 = 0")], [],
    ),
    "interpretation": (
        validate.interpretation_detail_rules,
        ["txt", "CASE WHEN idx % 3 = 0 THEN concat('「', left(txt, 3), '」与「~~无~~」') WHEN idx % 3 = 1 THEN concat('「', trim(left(txt, 3)), '」') END AS content", "CASE WHEN idx % 4 = 0 THEN array('延迟揭示', '别的') WHEN idx % 4 = 1 THEN array('延迟揭示') END AS techniques", "CASE WHEN idx % 5 = 0 THEN '别的' WHEN idx % 5 = 1 THEN '可靠' END AS reliability"],
        [("D06 quote", "idx % 3 = 0 OR idx % 3 = 2 AND false"), ("D06._techniques", "idx % 4 = 0"), ("narrator_reliability", "idx % 5 = 0")], [],
    ),
    "emotion": (
        validate.emotion_detail_rules,
        ["txt", "CASE idx % 5 WHEN 0 THEN NULL WHEN 1 THEN filter(array(named_struct('emotion', '喜悦', 'intensity', 3, 'polarity', 'positive')), x -> false) WHEN 2 THEN array_repeat(named_struct('emotion', '喜悦', 'intensity', 3, 'polarity', 'positive'), 3) WHEN 3 THEN array(named_struct('emotion', '喜悦', 'intensity', 13, 'polarity', 'positive')) ELSE array(named_struct('emotion', '喜悦', 'intensity', 3, 'polarity', 'positive')) END AS secondary", "CASE WHEN idx % 3 > 0 THEN named_struct('name', CASE WHEN idx % 6 = 1 THEN ' ' ELSE 'c' END) END AS target", "CASE WHEN idx % 4 > 0 THEN named_struct('description', CASE WHEN idx % 8 = 1 THEN NULL ELSE 'd' END) END AS trigger",
         "CASE WHEN idx % 7 > 0 THEN named_struct('has_shift', idx % 7 > 1, 'shift_point', CASE WHEN idx % 7 = 2 THEN '' ELSE 'p' END, 'before', named_struct('emotion', CASE WHEN idx % 7 = 3 THEN '别的' ELSE '喜悦' END, 'intensity', 3, 'polarity', 'positive'), 'after', named_struct('emotion', '悲伤', 'intensity', 3, 'polarity', CASE WHEN idx % 7 = 4 THEN 'up' ELSE 'negative' END)) END AS arc",
         "CASE WHEN idx % 9 > 0 THEN named_struct('direct', CASE WHEN idx % 9 = 1 THEN NULL ELSE true END, 'indirect', false, 'key_phrases', CASE WHEN idx % 9 = 2 THEN array() WHEN idx % 9 = 3 THEN array('~~无~~') ELSE array(left(trim(txt), 4)) END) END AS expression"],
        [("secondary empty", "idx % 5 = 1"), ("secondary", "idx % 5 = 3"), ("target.name", "idx % 6 = 1"), ("trigger.description", "idx % 8 = 1"), ("arc.has_shift", "idx % 7 = 1"), ("arc.shift_point", "idx % 7 = 2"), ("arc.before", "idx % 7 = 3"), ("arc.after", "idx % 7 = 4"), ("expression", "idx % 9 IN (0, 1)"), ("key_phrases", "idx % 9 IN (0, 2)"), ("key_phrases not in text", "idx % 9 = 3")], [("secondary many", "idx % 5 = 2")],
    ),
}
for _layer, (_rules, _columns, _errors, _warnings) in DETAIL.items():
    register(f"val_{_layer}_details", on_ann(lambda a, rules=_rules, columns=_columns: validate.flat(validate.checked(a.selectExpr("doc_id", "idx", *columns), rules()))), f", e AS (SELECT doc_id, idx, {listed(*_errors)} AS errors, {listed(*_warnings) if _warnings else repr('')} AS warnings FROM ann) SELECT doc_id, idx, errors, warnings, errors = '' AS is_valid FROM e")
for _layer, (_dims, _needed) in validate.DIMENSIONS.items():
    register(
        f"val_dimensions_{_layer}",
        on_ann(lambda a, layer=_layer, names=_dims: validate.flat(validate.checked(a.selectExpr("doc_id", "idx", "CASE WHEN idx % 4 = 0 THEN 'guess' ELSE 'human_review' END AS confidence_method", "map(" + ", ".join(f"'{d}', CASE WHEN idx % {i + 5} = 0 THEN NULL WHEN idx % {i + 5} = 1 THEN 1.5D ELSE 0.5D END" for i, d in enumerate(names)) + ") AS per_dimension"), validate.dimension_rules(layer)))),
        f", e AS (SELECT doc_id, idx, {listed(('confidence_method', 'idx % 4 = 0'), *((f'per_dimension.{d}', f'idx % {i + 5} = 1' + (f' OR idx % {i + 5} = 0' if _needed else '')) for i, d in enumerate(_dims)))} AS errors FROM ann) SELECT doc_id, idx, errors, '' AS warnings, errors = '' AS is_valid FROM e",
    )
register("proj_imagery", on_ann(lambda a: layers.imagery(a.selectExpr("doc_id", "idx", "CASE WHEN idx % 3 > 0 THEN array(named_struct('text', left(txt, 2), 'type', itype, 'cluster', cl, 'start', 0L, 'end', 2L), named_struct('text', 'x', 'type', cast(NULL AS string), 'cluster', cl, 'start', 1L, 'end', 2L)) END AS d15"))), "SELECT doc_id, idx, 0::BIGINT AS pos, left(txt, 2) AS text, itype AS type, cl AS cluster, 0::BIGINT AS start, 2::BIGINT AS end FROM ann WHERE idx % 3 > 0 UNION ALL SELECT doc_id, idx, 1, 'x', 'unknown', cl, 1, 2 FROM ann WHERE idx % 3 > 0")
register("proj_padded", on_ann(lambda a: layers.padded(a.selectExpr("doc_id", "idx", "CASE WHEN idx % 2 = 0 THEN 'own' END AS txt", "CASE WHEN idx % 3 = 0 THEN 'id' END AS segment_id", "CASE WHEN idx % 5 = 0 THEN '2.5.0' END AS schema_version"), a.selectExpr("doc_id", "idx", "txt", "concat(doc_id, '_seg_', idx) as segment_id"), "2.10.0")), "SELECT doc_id, idx, CASE WHEN idx % 2 = 0 THEN 'own' ELSE txt END AS txt, CASE WHEN idx % 3 = 0 THEN 'id' ELSE concat(doc_id, '_seg_', idx) END AS segment_id, CASE WHEN idx % 5 = 0 THEN '2.5.0' ELSE '2.10.0' END AS schema_version FROM ann")
register("agg_first_seen", on_ann(lambda a: layers.first_seen(a, "loc").select("doc_id", F.array_join("values", ",").alias("values"))), "SELECT doc_id, string_agg(loc, ',' ORDER BY at_, loc) AS values FROM (SELECT doc_id, loc, min(idx) AS at_ FROM ann WHERE loc IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
register("agg_export_counters", on_ann(layers.export_counters), "SELECT doc_id, status, count(*) AS n FROM ann GROUP BY 1, 2")
register("sink_filled_spans", on_ann(lambda a: layers.filled_spans(a.selectExpr("doc_id", "idx", "txt", "CASE WHEN idx % 3 = 2 THEN '~~无~~' ELSE substring(trim(txt), 2, 5) END AS text", "CASE WHEN idx % 3 = 0 THEN -1L END AS start", "CASE WHEN idx % 3 = 0 THEN 4L END AS end").filter("length(trim(txt)) > 8 and trim(text) = text and length(text) = 5"))[0].select("doc_id", "idx", "text", "start", "end", "filled")), ", t AS (SELECT doc_id, idx, txt, CASE WHEN idx % 3 = 2 THEN '~~无~~' ELSE substr(trim(txt, ' '), 2, 5) END AS text FROM ann) SELECT doc_id, idx, text, CASE WHEN idx % 3 = 2 THEN NULL ELSE instr(txt, text) - 1 END::BIGINT AS start, CASE WHEN idx % 3 = 2 THEN NULL ELSE instr(txt, text) + 4 END::BIGINT AS end, idx % 3 <> 2 AS filled FROM t WHERE length(trim(txt, ' ')) > 8 AND trim(text, ' ') = text AND length(text) = 5")


def queries() -> dict[str, Query]:
    from fabulon.streaming import events

    from . import calibration, custom, narrative, networks, rules, vocabulary  # noqa: F401

    return dict(_queries) | custom.queries() | events.queries()


def oracle_sql() -> dict[str, str]:
    from fabulon.streaming import events

    from . import calibration, narrative, networks, rules, vocabulary  # noqa: F401

    return dict(_sql) | events.oracle_sql()
