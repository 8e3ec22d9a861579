"""Alias and object clustering per document, and mentions of names in texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabulon.functions import patterns
from fabulon.functions.similarity import leaders, near_ratio
from fabulon.functions.text import CJK


def merge_aliases(names: list[tuple[str, int]], least: float = 0.6) -> dict[str, str]:
    """Names by count (ties in order): each free name absorbs the later ones like it or holding it or held by it."""
    out: dict[str, str] = {}
    ranked = [n for n, _ in sorted(names, key=lambda x: -x[1])]
    for i, head in enumerate(ranked):
        if head not in out:
            out[head] = head
            for other in ranked[i + 1 :]:
                if other not in out and (head in other or other in head or near_ratio(head, other, least) >= least):
                    out[other] = head
    return out


def alias_clusters(mentions: DataFrame) -> DataFrame:
    """(doc_id, alias, canonical) from mentions (doc_id, who): names are counted first, so that a group holds a document's distinct names. Nulls take no part."""
    n = mentions.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"))

    def run(names: pd.Series, counts: pd.Series) -> pd.Series:
        found = (merge_aliases(list(zip(who, n, strict=True))) for who, n in zip(names, counts, strict=True))
        return pd.Series([[{"alias": a, "canonical": c} for a, c in f.items()] for f in found], dtype=object)

    run.__annotations__ = {"names": pd.Series, "counts": pd.Series, "return": pd.Series}
    # a row for each document: many of them go to Python at once
    held = n.filter(F.col("doc_id").isNotNull() & F.col("who").isNotNull()).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("who", "n"))).alias("x"))
    found = held.select("doc_id", F.explode(F.pandas_udf(run, "array<struct<alias:string,canonical:string>>")("x.who", "x.n")).alias("x"))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "x.alias", "x.canonical")


def object_leaders(items: DataFrame, least: float = 0.6) -> DataFrame:
    """(doc_id, text, cluster) by greedy leaders over a document's distinct texts in order of first occurrence."""
    first = items.groupBy("doc_id", "text").agg(F.min("idx").alias("idx"))

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([leaders(list(t), least) for t in texts], dtype=object)

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    # a row for each document, nulls last: many of them go to Python at once
    order = F.struct(F.col("idx").isNull().alias("late"), "idx", F.col("text").isNull().alias("last"), "text")
    held = first.groupBy("doc_id").agg(F.array_sort(F.collect_list(order)).alias("x"))
    found = held.select("doc_id", F.explode(F.arrays_zip(F.col("x.text").alias("text"), F.pandas_udf(run, "array<long>")("x.text").alias("cluster"))).alias("x"))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "x.text", "x.cluster")


def places(text: str, part: Column) -> Column:
    """Where (from 1) a text has a part, overlapping places too."""
    return F.filter(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(F.col(text), i, F.length(part)) == part)


def name_places(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, idx, who, pos): each place of a document's names of two characters or more in its segments, unless an ideograph stands right before or
    after it. All names are looked for in one pass; a document's own are kept."""
    own = names.filter(F.length("who") > 1).select("doc_id", "who").distinct()
    met = patterns.find(rows.select("doc_id", "idx", "txt"), own.select(F.col("who").alias("w")))
    inside = F.coalesce(F.col("before").rlike(CJK), F.lit(False)) | F.coalesce(F.col("after").rlike(CJK), F.lit(False))
    return met.filter(~inside).select("doc_id", "idx", F.col("w").alias("who"), "pos").join(own, ["doc_id", "who"], "left_semi").select("doc_id", "idx", "who", "pos")


def mentions(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, idx, who, n): how often a document's names stand in its segments, by the rule of name_places."""
    return name_places(rows, names).groupBy("doc_id", "idx", "who").agg(F.count(F.lit(1)).alias("n"))


# fixed values: pronouns by gender
PRONOUNS = {
    "male": ["他", "他自己", "他俩", "他们", "他们俩", "这位先生", "那男人", "这男人"],
    "female": ["她", "她自己", "她俩", "她们", "她们俩", "这位女士", "那女人", "这女人"],
    "neutral": ["它", "它们", "这", "那", "这个", "那个", "此人", "那人", "该人"],
}


def pronouns(rows: DataFrame) -> DataFrame:
    """(doc_id, idx, text, gender, pos): every place of every pronoun; a short form inside a long one counts as well."""
    each = F.array(*(F.struct(F.lit(w).alias("text"), F.lit(g).alias("gender")) for g, ws in PRONOUNS.items() for w in ws))
    met = rows.filter(F.col("txt").rlike("[他她它这那此该]")).select("doc_id", "idx", "txt", F.explode(each).alias("p")).select("doc_id", "idx", "txt", "p.*").filter(F.contains("txt", "text"))
    return met.select("doc_id", "idx", "text", "gender", F.explode(places("txt", F.col("text"))).alias("pos")).withColumn("pos", F.col("pos").cast("long"))


def gender_of(name: Column, female: str, male: str) -> Column:
    """By the distinct characters of a name in two sets; null for a tie."""
    n = lambda marks: F.size(F.array_intersect(F.split(name, ""), F.split(F.lit(marks), "")))
    return F.when(n(female) > n(male), "female").when(n(male) > n(female), "male")


def resolved_pronouns(rows: DataFrame, named: DataFrame, said: DataFrame) -> DataFrame:
    """(doc_id, idx, text, pos, resolved_to, confidence): pronouns (said) with the last name of their gender. named: (doc_id, idx, who, pos, gender); all names of a
    segment count before its pronouns, the last of them by falling length of the name, then by place. Neutral pronouns stay open."""
    order = F.struct(-F.length("who"), F.col("pos"), F.col("who"))
    last = named.groupBy("doc_id", "idx").agg(*(F.max_by(F.when(F.col("gender") == g, F.col("who")), F.when(F.col("gender") == g, order)).alias(g) for g in ("male", "female")))
    upto = Window.partitionBy("doc_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    known = rows.select("doc_id", "idx").join(last, ["doc_id", "idx"], "left").select("doc_id", "idx", *(F.last(g, ignorenulls=True).over(upto).alias(g) for g in ("male", "female")))
    who = F.when(F.col("gender") == "male", F.col("male")).when(F.col("gender") == "female", F.col("female"))
    return said.join(known, ["doc_id", "idx"]).select("doc_id", "idx", "text", "pos", who.alias("resolved_to"), F.lit(0.7).alias("confidence")).filter("resolved_to is not null")
