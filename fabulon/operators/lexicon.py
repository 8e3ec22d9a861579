"""Votes and densities of large lexicons: all patterns in one pass over the texts."""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabulon.functions import patterns
from fabulon.functions.enums import SENSES, TRAITS
from fabulon.functions.text import rounded

KEY = ["doc_id", "idx"]
POLARITY = {1: "positive", 2: "negative", 0: "neutral"}


def polarities(lexicon: DataFrame) -> DataFrame:
    """(w, polarity) from (w, pol, at): words of one or two characters whose pol is 0, 1 or 2; of equal words the last one (by at) stands."""
    named = F.create_map(*(F.lit(x) for pair in POLARITY.items() for x in pair))
    known = lexicon.withColumn("polarity", named[F.col("pol").cast("int")]).filter(F.col("polarity").isNotNull() & F.length("w").between(1, 2))
    return known.groupBy("w").agg(F.max_by("polarity", "at").alias("polarity"))


def vote(rows: DataFrame, lexicon: DataFrame, listed: int = 10, **bounds) -> DataFrame:
    """(doc_id, idx, positive, negative, neutral, matched, dominant, words): what the words of a lexicon (w, polarity) that stand in a segment (doc_id, idx, txt) say of it.

    From left to right a word of two characters goes before one of one character, and what it covers is passed. The dominant polarity is positive if no other has more, else
    negative if no other has more, else neutral; neutral without words. `words` lists the first `listed` as `word:polarity`. A null text has no words.
    """
    known = patterns.small(lexicon.select("w", "polarity"), **bounds)
    if known is None:
        out = _joined_votes(rows, lexicon, listed, bounds)
    else:
        of = defaultdict(list)
        for r in known:
            of[r["w"]].append((r["w"] if r["polarity"] is None else f"{r['w']}:{r['polarity']}", r["polarity"]))
        sent = rows.sparkSession.sparkContext.broadcast({w: sorted(x, key=lambda v: v[0]) for w, x in of.items()})

        def made(found: list[tuple[int, str]]) -> dict:
            said = sent.value
            hits = [x for _, w in found for x in said[w]]
            n = Counter([p for _, p in hits])
            return {p: n[p] for p in POLARITY.values()} | {"matched": len(hits), "words": ",".join([x for x, _ in hits[:listed]])}

        out = patterns.in_rows(rows.select(*KEY, "txt"), list(of), made, "positive long, negative long, neutral long, matched long, words string", mode=patterns.LONGEST)
    p, q, z = F.col("positive"), F.col("negative"), F.col("neutral")
    dominant = F.when(F.col("matched") == 0, "neutral").when((p >= q) & (p >= z), "positive").when((q >= p) & (q >= z), "negative").otherwise("neutral")
    return out.withColumn("dominant", dominant).select(*KEY, "positive", "negative", "neutral", "matched", "dominant", "words")


def _joined_votes(rows: DataFrame, lexicon: DataFrame, listed: int, bounds: dict) -> DataFrame:
    """The counts of vote by joins, for a lexicon that is too large for one automaton."""
    hits = patterns.find(rows.select(*KEY, "txt"), lexicon.select("w"), mode=patterns.LONGEST, **bounds).select(*KEY, "w", "pos").join(lexicon, "w")
    n = lambda p: F.count_if(F.col("polarity") == p).alias(p)
    first = F.slice(F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(":", "w", "polarity").alias("x")))), 1, listed)
    counted = hits.groupBy(*KEY).agg(n("positive"), n("negative"), n("neutral"), F.count(F.lit(1)).alias("matched"), F.array_join(F.transform(first, lambda s: s["x"]), ",").alias("words"))
    return rows.select(*KEY).join(counted, KEY, "left").fillna(0, ["positive", "negative", "neutral", "matched"]).fillna("", ["words"])


def consistency(votes: DataFrame, annotated: DataFrame) -> DataFrame:
    """votes with the annotated polarity (doc_id, idx, pol) and whether they agree; mixed annotations and neutral votes agree with all."""
    met = votes.join(annotated.select(*KEY, "pol"), KEY)
    same = (F.col("pol") == "mixed") | (F.col("dominant") == "neutral") | (F.col("pol") == F.col("dominant"))
    return met.withColumn("consistent", F.coalesce(same, F.lit(False)))


def consistency_report(checked: DataFrame) -> DataFrame:
    """Per document the rows that were checked, those that agree, and their share."""
    return checked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("validated"), F.count_if("consistent").alias("consistent"), rounded(F.avg(F.col("consistent").cast("double")), 3).alias("rate"))


def sense_densities(rows: DataFrame, senses: dict[str, list[str]] = SENSES) -> DataFrame:
    """(doc_id, idx, each sense): the occurrences of each word of a sense, apart from each other, per character; a word inside another counts for both."""
    spark = rows.sparkSession
    of = spark.createDataFrame([(w, s) for s, ws in senses.items() for w in dict.fromkeys(ws)], "w string, sense string")
    hits = patterns.find(rows.select(*KEY, "txt"), of.select("w"), mode=patterns.APART).select(*KEY, "w").join(F.broadcast(of), "w")  # a fixed list
    counted = hits.groupBy(*KEY).agg(*(F.count_if(F.col("sense") == s).alias(s) for s in senses))
    out = rows.select(*KEY, F.greatest(F.length("txt"), F.lit(1)).alias("_n")).join(counted, KEY, "left")
    return out.select(*KEY, *(rounded(F.coalesce(F.col(s), F.lit(0)) / F.coalesce("_n", F.lit(1)), 5).alias(s) for s in senses))


# fixed values: the trait that a repeated emotion tells
EMOTION_TRAITS = {"焦虑": "焦虑", "紧张": "焦虑", "不安": "敏感", "愤怒": "冲动", "暴躁": "冲动", "平静": "冷静", "镇定": "冷静", "喜悦": "热情", "兴奋": "热情", "悲伤": "敏感", "忧愁": "敏感", "恐惧": "懦弱", "害怕": "懦弱"}
VOICE, DETAIL, LINE, REPEATED = 1.0, 0.3, 0.4, 2


def trait_evidence(people: DataFrame, voices: DataFrame, feelings: DataFrame, details: DataFrame, lines: DataFrame, traits: dict[str, tuple[float, list[str]]] = TRAITS) -> DataFrame:
    """(doc_id, who, trait, idx, part): what counts for a trait of each of the people (doc_id, who).

    Every key word in the text of a voice (doc_id, idx, who, text) of a speaker whose name holds or is held by theirs counts with the trait's weight; one in a golden line
    (doc_id, idx, text) that names them by LINE of it, and one in a detail (doc_id, idx, text), whoever is meant, by DETAIL of it. An emotion (doc_id, idx, who, emo, inten: of the
    segments with them) that occurs REPEATED times or more counts half its mean intensity of 10 for each time.
    """
    from fabulon.operators.joins import contained

    spark = people.sparkSession
    weights = F.broadcast(spark.createDataFrame([(w, t, by) for t, (by, ws) in traits.items() for w in ws], "w string, trait string, by double"))  # a fixed list
    people = people.select("doc_id", "who").distinct()

    def words(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Each key word that a text holds, once for each of its places in the lexicon."""
        numbered = rows.select(*keys, "text", F.monotonically_increasing_id().alias("_row"))
        met = patterns.find(numbered.withColumnRenamed("text", "txt"), weights.select("w")).select("_row", *keys, "w").distinct()
        return met.join(weights, "w")

    said = voices.filter(F.length("who") > 0).withColumnRenamed("who", "speaker")
    alike = contained(people.select("doc_id", F.col("who").alias("a")), said.select("doc_id", F.col("speaker").alias("b")).distinct()).select("doc_id", F.col("a").alias("who"), F.col("b").alias("speaker"))
    of_voice = words(said, ["doc_id", "idx", "speaker"]).join(alike, ["doc_id", "speaker"]).select("doc_id", "who", "trait", "idx", (F.col("by") * VOICE).alias("part"))
    of_detail = words(details, ["doc_id", "idx"]).select("doc_id", "trait", "idx", (F.col("by") * DETAIL).alias("part")).join(people, "doc_id").select("doc_id", "who", "trait", "idx", "part")
    marked = lines.select("doc_id", "idx", F.monotonically_increasing_id().alias("_line"), "text", F.col("text").alias("txt"))
    named = patterns.find(marked, people.select(F.col("who").alias("w"))).select("doc_id", "idx", "_line", "text", F.col("w").alias("who")).distinct().join(people, ["doc_id", "who"], "left_semi")
    of_line = words(named, ["doc_id", "idx", "who"]).select("doc_id", "who", "trait", "idx", (F.col("by") * LINE).alias("part"))
    meaning = F.create_map(*(F.lit(x) for pair in EMOTION_TRAITS.items() for x in pair))
    felt = feelings.withColumn("trait", meaning[F.col("emo")]).filter(F.col("trait").isin(*traits))
    often = felt.groupBy("doc_id", "who", "emo").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= REPEATED).drop("_n")
    of_mood = felt.join(often, ["doc_id", "who", "emo"], "left_semi").select("doc_id", "who", "trait", "idx", (F.lit(0.5) * F.col("inten") / 10.0).alias("part"))
    return of_voice.unionByName(of_detail).unionByName(of_line).unionByName(of_mood)


def inferred_traits(evidence: DataFrame, most: int = 5) -> DataFrame:
    """(doc_id, who, rank, trait, score, frequency, confidence): the strongest traits of each character (ties by name), the segments that tell of them, and a confidence of
    a fifth of the score, .95 at most."""
    score = evidence.groupBy("doc_id", "who", "trait").agg(F.round(F.sum("part"), 6).alias("score"), F.count_distinct("idx").alias("frequency"))
    ranked = patterns.kept_first(score.filter("score > 0"), ["doc_id", "who"], [F.desc("score"), "trait"], most)
    return ranked.select("doc_id", "who", "rank", "trait", "score", "frequency", F.round(F.least(F.col("score") / 5, F.lit(0.95)), 3).alias("confidence"))
