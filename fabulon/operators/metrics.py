"""Quantitative text metrics of segments (doc_id, idx, txt)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabulon.functions.text import CLOSE, OPEN, rounded

TOKEN = "[一-鿿]|[a-zA-Z0-9]+"
SINGLE = re.compile(TOKEN)
ENDS = "[。！？；…!?;]+"
# fixed values: classes of the lexicon that tell anxiety
ANXIETY = ["NC", "NI", "NB", "NJ", "NH", "PF"]
MARKS = r"[，。！？；：、\"'「」『』（）《》【】—…·,.!?;:()\[\]{}\-]"


def tokens(rows: DataFrame) -> DataFrame:
    """With an empty lexicon: single ideographs and runs of letters and digits."""
    return rows.withColumn("tokens", F.regexp_extract_all("txt", F.lit(TOKEN), F.lit(0)))


def split_by(text: str, lexicon: frozenset[str]) -> list[str]:
    """From left to right: a word of two characters of the lexicon, else an ideograph, else a run of letters and digits; all else is passed."""
    out, i = [], 0
    while i < len(text):
        if text[i : i + 2] in lexicon:
            out.append(text[i : i + 2])
        elif m := SINGLE.match(text, i):
            out.append(m[0])
        else:
            i += 1
            continue
        i += len(out[-1])
    return out


def tokens_by(rows: DataFrame, lexicon: list[str]) -> DataFrame:
    """tokens with a lexicon (its words of two characters count; its size is that of a dictionary, which goes to each task)."""
    known = frozenset(w for w in lexicon if len(w) == 2)

    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda t: split_by(t or "", known))

    run.__annotations__ = {"x": pd.Series, "return": pd.Series}
    return rows.withColumn("tokens", F.pandas_udf(run, "array<string>")("txt"))


def counts(rows: DataFrame) -> DataFrame:
    sentences = F.size(F.filter(F.split("txt", ENDS), lambda s: F.trim(s) != "")).cast("long")
    rows = tokens(rows).select("doc_id", "idx", F.length("txt").cast("long").alias("char_count"), F.size("tokens").cast("long").alias("word_count"), sentences.alias("sentence_count"))
    return rows.withColumn("avg_sentence_length", rounded(F.col("char_count") / F.greatest("sentence_count", F.lit(1)), 1))


def type_token_ratio(rows: DataFrame) -> DataFrame:
    rows = tokens(rows)
    return rows.select("doc_id", "idx", rounded(F.size(F.array_distinct("tokens")) / F.greatest(F.size("tokens"), F.lit(1)), 4).alias("ttr"))


def punctuation_density(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "idx", rounded(F.regexp_count("txt", F.lit(MARKS)) / F.greatest(F.length("txt"), F.lit(1)), 4).alias("density"))


def dialogue_ratio(rows: DataFrame, opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """Share of characters inside quotes, marks included; any closing mark ends any opening one."""
    spans = F.regexp_extract_all("txt", F.lit(f"(?s)[{opening}].*?[{closing}]"), F.lit(0))
    total = F.aggregate(F.transform(spans, F.length), F.lit(0), lambda a, x: a + x)
    return rows.select("doc_id", "idx", rounded(total / F.greatest(F.length("txt"), F.lit(1)), 4).alias("dialogue_ratio"))


def word_density(rows: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    """For each class the non-overlapping hits of its words per character; a word inside another counts for both."""
    hits = lambda w: (F.length("txt") - F.length(F.replace(F.col("txt"), F.lit(w)))) / len(w)
    return rows.select("doc_id", "idx", *(rounded(sum(hits(w) for w in words) / F.greatest(F.length("txt"), F.lit(1)), 5).alias(name) for name, words in lexicon.items()))


def lexicon_shares(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Shares of a segment's tokens by polarity and part of speech, from a lexicon (w, pos, pol, cls: classes) that the optimizer may broadcast."""
    n = tokens(rows).select("doc_id", "idx", F.explode_outer("tokens").alias("token"))
    met = n.join(lexicon, F.lower("token") == F.col("w"), "left")
    total = F.greatest(F.count("token"), F.lit(1))
    part = lambda cond: rounded(F.count_if(F.coalesce(cond, F.lit(False))) / total, 4)
    return met.groupBy("doc_id", "idx").agg(part(F.col("pol") == 1).alias("positive"), part(F.col("pol") == 2).alias("negative"), part(F.arrays_overlap("cls", F.array(*map(F.lit, ANXIETY)))).alias("anxiety"), part(F.col("pos") == "adj").alias("adjectives"), part(F.col("pos") == "verb").alias("verbs"), part(F.col("pos") == "noun").alias("nouns"))
