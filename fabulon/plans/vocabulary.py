"""Registered queries of large lexicons, networks and evidence of traits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabulon.functions.enums import SENSES, TRAITS
from fabulon.operators import joins, lexicon

from .fixture import annotated, segments, speakers
from .registry import R, on_ann, register

# a lexicon drawn from the documents' own words: every pair of letters that begins a line, and the letter at its end, with a polarity by md5
DRAWN = "(cast(conv(substring(md5(w), 1, 6), 16, 10) as bigint) % 4)"


def drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(w, pol, at): words of one to three characters; those of three are never met, and pol 3 says nothing."""
    seg = segments(spark, sf_dir)
    words = seg.selectExpr("explode(array(substring(txt, 1, 2), substring(txt, 3, 2), right(txt, 1), substring(txt, 1, 3))) as w").filter("length(w) > 0").distinct()
    return words.selectExpr("w", f"{DRAWN} as pol", "0 as at")


LEX_SQL = "lx AS (SELECT w, CASE p WHEN 1 THEN 'positive' WHEN 2 THEN 'negative' ELSE 'neutral' END AS polarity FROM (SELECT w, ('0x' || substr(md5(w), 1, 6))::BIGINT % 4 AS p FROM (SELECT DISTINCT unnest([substr(txt, 1, 2), substr(txt, 3, 2), right(txt, 1)]) AS w FROM seg) WHERE length(w) > 0) WHERE p < 3)"
# a pair of letters that is a word is passed as one: of words in a row, each from the second letter of the last, every other one counts, from the first
VOTE_SQL = (
    f", {LEX_SQL}, ch AS (SELECT doc_id, idx, txt, unnest(range(1, length(txt) + 1)) AS i FROM seg), ct AS (SELECT doc_id, idx, i, substr(txt, i, 1) AS c, CASE WHEN i < length(txt) THEN substr(txt, i, 2) END AS d FROM ch), "
    "ht AS (SELECT ct.*, lx.polarity AS pd, lx.polarity IS NOT NULL AS hit FROM ct LEFT JOIN lx ON lx.w = ct.d), rn AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, idx, hit ORDER BY i) AS island FROM ht), "
    "ps AS (SELECT *, hit AND (row_number() OVER (PARTITION BY doc_id, idx, hit, island ORDER BY i)) % 2 = 1 AS taken FROM rn), vs AS (SELECT *, coalesce(lag(taken) OVER (PARTITION BY doc_id, idx ORDER BY i), false) AS covered FROM ps), "
    "wd AS (SELECT doc_id, idx, i, CASE WHEN taken THEN d ELSE c END AS w, CASE WHEN taken THEN pd ELSE (SELECT polarity FROM lx WHERE lx.w = vs.c) END AS polarity FROM vs WHERE taken OR NOT covered), "
    "vt AS (SELECT doc_id, idx, count(*) FILTER (polarity = 'positive') AS positive, count(*) FILTER (polarity = 'negative') AS negative, count(*) FILTER (polarity = 'neutral') AS neutral, count(polarity) AS matched, coalesce(array_to_string((list(concat(w, ':', polarity) ORDER BY i) FILTER (polarity IS NOT NULL))[1:10], ','), '') AS words FROM wd GROUP BY 1, 2), "
    "vote AS (SELECT doc_id, idx, positive, negative, neutral, matched, CASE WHEN matched = 0 THEN 'neutral' WHEN positive >= negative AND positive >= neutral THEN 'positive' WHEN negative >= positive AND negative >= neutral THEN 'negative' ELSE 'neutral' END AS dominant, words FROM vt)"
)
SAME = "(pol = 'mixed' OR dominant = 'neutral' OR pol = dominant)"
register("lex_vote", lambda s, d: lexicon.vote(segments(s, d), lexicon.polarities(drawn(s, d))), f"{VOTE_SQL} SELECT * FROM vote")
register(
    "lex_consistency",
    lambda s, d: lexicon.consistency_report(lexicon.consistency(lexicon.vote(segments(s, d), lexicon.polarities(drawn(s, d))), annotated(s, d))),
    f"{VOTE_SQL} SELECT doc_id, count(*) AS validated, count(*) FILTER ({SAME}) AS consistent, {R(f'avg(({SAME})::INT)', 3)} AS rate FROM vote JOIN ann USING (doc_id, idx) GROUP BY 1",
)
# the derived sentences, times and places are the text that has words of the senses
SAID = "concat_ws('，', sent, time_txt, space_txt)"
_apart = lambda w: f"(length(t) - length(replace(t, '{w}', ''))) / {len(w)}"
register(
    "lex_five_senses", on_ann(lambda a: lexicon.sense_densities(a.selectExpr("doc_id", "idx", f"{SAID} as txt"))),
    f", tx AS (SELECT doc_id, idx, {SAID} AS t FROM ann) SELECT doc_id, idx, " + ", ".join(f"{R(f'({" + ".join(map(_apart, dict.fromkeys(ws)))}) / greatest(length(t), 1)', 5)} AS {s}" for s, ws in SENSES.items()) + " FROM tx",
)

# evidence of traits: texts that hold key words, drawn from the annotations
WORDS = [w for _, ws in TRAITS.values() for w in (ws[0], ws[2])][:40]
PICK = "element_at(array({}), cast(idx % {} + 1 as int))"


def _voices(a: DataFrame) -> DataFrame:
    listed = ", ".join(f"'{w}'" for w in WORDS)
    return a.selectExpr("doc_id", "idx", "concat(s1, if(gap = 1, 'x', '')) as who", f"concat(d01, {PICK.format(listed, len(WORDS))}, emo) as text")


def _details(a: DataFrame) -> DataFrame:
    return a.filter("gap = 2").selectExpr("doc_id", "idx", "concat(word, emo) as text")


def _lines(a: DataFrame) -> DataFrame:
    listed = ", ".join(f"'{w}'" for w in WORDS[::-1])
    return a.filter("gap = 3").selectExpr("doc_id", "idx", f"concat(s2, '说', {PICK.format(listed, len(WORDS))}) as text")


def _feelings(a: DataFrame) -> DataFrame:
    return speakers(a).join(a.select("doc_id", "idx", "emo", F.col("emo_int").alias("inten")), ["doc_id", "idx"])


def evidence(a: DataFrame) -> DataFrame:
    return lexicon.trait_evidence(speakers(a), _voices(a), _feelings(a), _details(a), _lines(a))


_list = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
_tw = "tw(trait, by_, w) AS (VALUES " + ", ".join(f"('{t}', {by}::DOUBLE, '{w}')" for t, (by, ws) in TRAITS.items() for w in ws) + ")"
_em = "em(emo, trait) AS (VALUES " + ", ".join(f"('{e}', '{t}')" for e, t in lexicon.EMOTION_TRAITS.items()) + ")"
TRAIT_SQL = (
    f", {_tw}, {_em}, pe AS (SELECT DISTINCT doc_id, who FROM spk), vo AS (SELECT doc_id, idx, concat(s1, CASE WHEN gap = 1 THEN 'x' ELSE '' END) AS speaker, concat(d01, ({_list(WORDS)})[idx % {len(WORDS)} + 1], emo) AS text FROM ann), "
    "ev AS (SELECT pe.doc_id, pe.who, trait, idx, by_ * 1.0::DOUBLE AS part FROM vo JOIN pe ON pe.doc_id = vo.doc_id AND (contains(pe.who, speaker) OR contains(speaker, pe.who)) JOIN tw ON contains(text, w) "
    "UNION ALL SELECT pe.doc_id, pe.who, trait, idx, by_ * 0.3::DOUBLE FROM ann JOIN pe USING (doc_id) JOIN tw ON contains(concat(word, emo), w) WHERE gap = 2 "
    f"UNION ALL SELECT pe.doc_id, pe.who, trait, idx, by_ * 0.4::DOUBLE FROM (SELECT doc_id, idx, concat(s2, '说', ({_list(WORDS[::-1])})[idx % {len(WORDS)} + 1]) AS text FROM ann WHERE gap = 3) l JOIN pe ON pe.doc_id = l.doc_id AND contains(text, pe.who) JOIN tw ON contains(text, w) "
    "UNION ALL SELECT doc_id, who, trait, idx, 0.5::DOUBLE * emo_int / 10.0::DOUBLE FROM (SELECT spk.doc_id, who, spk.idx, ann.emo, emo_int, trait, count(*) OVER (PARTITION BY spk.doc_id, who, ann.emo) AS n FROM spk JOIN ann USING (doc_id, idx) JOIN em ON em.emo = ann.emo) WHERE n >= 2)"
)
register("char_trait_evidence", on_ann(lambda a: evidence(a).groupBy("doc_id", "who", "trait").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("part"), 6).alias("score"))), f"{TRAIT_SQL} SELECT doc_id, who, trait, count(*) AS n, round(sum(part), 6) AS score FROM ev GROUP BY 1, 2, 3")
register(
    "char_inferred_traits",
    on_ann(lambda a: lexicon.inferred_traits(evidence(a))),
    f"{TRAIT_SQL}, sc AS (SELECT doc_id, who, trait, round(sum(part), 6) AS score, count(DISTINCT idx) AS frequency FROM ev GROUP BY 1, 2, 3), rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, who ORDER BY score DESC, trait) AS rank FROM sc WHERE score > 0) SELECT doc_id, who, rank, trait, score, frequency, round(least(score / 5, 0.95::DOUBLE), 3) AS confidence FROM rk WHERE rank <= 5",
)
# speakers met with the names of characters that hold them or are held by them
register("jn_speaker_names", on_ann(lambda a: joins.contained(speakers(a).select("doc_id", F.col("who").alias("a")), _voices(a).select("doc_id", F.col("who").alias("b")))), ", v AS (SELECT DISTINCT doc_id, concat(s1, CASE WHEN gap = 1 THEN 'x' ELSE '' END) AS b FROM ann), p AS (SELECT DISTINCT doc_id, who AS a FROM spk) SELECT p.doc_id, a, b FROM p JOIN v ON p.doc_id = v.doc_id AND (contains(a, b) OR contains(b, a))")
