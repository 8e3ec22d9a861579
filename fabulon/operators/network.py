"""Networks of names: components of alias links, canonical names, edges whose ends hold one another, and segments found by alias."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fabulon.functions import patterns
from fabulon.functions.text import rounded

from .graph import relation_of
from .joins import contained

LOCAL_DIR = "file:///tmp/checkpoints/fabulon"


def _cut(df: DataFrame) -> DataFrame:
    """df checkpointed in the folder that the cluster shares; in one of this machine only under a local master that names none."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or LOCAL_DIR)
    return df.checkpoint()


def components(links: DataFrame) -> DataFrame:
    """(doc_id, name, component) for each name of the links (doc_id, a, b) of a document; component is the least name that links lead to.

    Every name takes the least label of its neighbours and then that of its label, until none changes: the labels' ways halve with each round. Nulls and links of a name
    to itself are left out. The rounds are jobs on names and links, aggregated before they are dealt out; the driver sees one number of each.
    """
    once = links.select("doc_id", "a", "b").filter("doc_id is not null and a is not null and b is not null and a != b").distinct()
    both = _cut(once.unionByName(once.select("doc_id", F.col("b").alias("a"), F.col("a").alias("b"))))
    at = _cut(both.groupBy("doc_id", F.col("a").alias("name")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        seen = Observation()
        known = at.select("doc_id", F.col("name").alias("b"), F.col("component").alias("near"))
        least = both.join(known, ["doc_id", "b"]).groupBy("doc_id", F.col("a").alias("name")).agg(F.min("near").alias("near"))
        next_ = at.join(least, ["doc_id", "name"], "left").select("doc_id", "name", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        of = at.select("doc_id", F.col("name").alias("component"), F.col("component").alias("far"))
        jumped = next_.join(of, ["doc_id", "component"], "left").select("doc_id", "name", F.least("component", "far").alias("component"), "was")
        at = _cut(jumped.observe(seen, F.count_if(F.col("component") != F.col("was")).alias("n")).drop("was"))
        if not seen.get["n"]:
            return at


def canonical(groups: DataFrame, mentions: DataFrame) -> DataFrame:
    """(doc_id, name, component, canonical): of a component the name that is mentioned most (ties: first met, then the least); names that none mentions come after those."""
    n = mentions.groupBy("doc_id", F.col("who").alias("name")).agg(F.count(F.lit(1)).alias("_n"), F.min("idx").alias("_first"))
    met = groups.join(n, ["doc_id", "name"], "left")
    order = F.struct((-F.coalesce("_n", F.lit(0))).alias("n"), F.coalesce("_first", F.lit(1 << 60)).alias("first"), "name")
    best = met.groupBy("doc_id", "component").agg(F.min_by("name", order).alias("canonical"))
    return groups.join(best, ["doc_id", "component"]).select("doc_id", "name", "component", "canonical")


def _alike(names: DataFrame, *tables: DataFrame) -> DataFrame:
    """(doc_id, who, given): names, each with the src and tgt of the tables that it holds or is held by; found once, for all of them."""
    ends = [t.select("doc_id", F.explode(F.array("src", "tgt")).alias("b")) for t in tables]
    given = _cut(reduce(DataFrame.unionAll, ends).distinct())
    return _cut(contained(names.select("doc_id", F.col("who").alias("a")), given).select("doc_id", F.col("a").alias("who"), F.col("b").alias("given")))


def _ends(rows: DataFrame, alike: DataFrame) -> DataFrame:
    """rows (doc_id, _id, src, tgt, ..) met with pairs a < b of names of which one end holds, or is held by, src and the other tgt (alike); once for each row and pair."""
    one = alike.select("doc_id", F.col("given").alias("src"), F.col("who").alias("x"))
    two = alike.select("doc_id", F.col("given").alias("tgt"), F.col("who").alias("y"))
    met = rows.join(one, ["doc_id", "src"]).join(two, ["doc_id", "tgt"]).filter("x != y")
    return met.withColumns({"a": F.least("x", "y"), "b": F.greatest("x", "y")}).drop("x", "y").dropDuplicates(["doc_id", "_id", "a", "b"])


def edges(pairs: DataFrame, felt: DataFrame, talked: DataFrame) -> DataFrame:
    """(doc_id, a, b, n, n_emotions, n_dialogue, strength, relation) of pairs (doc_id, a, b, n: segments together, a < b).

    Emotions (doc_id, idx, src, tgt, emo, inten) and dialogues (doc_id, src, tgt, n) count for a pair if one of its names holds src or is held by it, and the other
    tgt. Names meet by what they hold, never pair by pair. Strength: .4 of segments together / 10, .3 of the mean intensity / 10, .3 of dialogues / 5, each part 1 at most; relation: the first
    that an emotion tells (by idx, then emotion), else by two dialogues, else by three segments together; under a strength of .1 they are strangers.
    """
    pairs = _cut(pairs)  # counts of segments together, which every step below would take again
    names = _cut(pairs.select("doc_id", F.explode(F.array("a", "b")).alias("who")).distinct())
    alike = _alike(names, felt, talked)
    emotions = _ends(felt.withColumn("_id", F.struct("idx", "src", "tgt", "emo")), alike)
    told = relation_of(F.col("emo"))
    of_emotion = emotions.groupBy("doc_id", "a", "b").agg(F.count(F.lit(1)).alias("n_emotions"), F.avg("inten").alias("_mean"), F.min_by(told, F.when(told.isNotNull(), F.struct("idx", "emo"))).alias("_told"))
    spoken = _ends(talked.withColumn("_id", F.struct("src", "tgt")), alike).groupBy("doc_id", "a", "b").agg(F.sum("n").alias("n_dialogue"))
    rows = pairs.join(of_emotion, ["doc_id", "a", "b"], "left").join(spoken, ["doc_id", "a", "b"], "left").fillna(0, ["n_emotions", "n_dialogue"])
    part = lambda c, full, w: F.least(F.coalesce(c, F.lit(0.0)) / full, F.lit(1.0)) * w
    strength = rounded(part(F.col("n"), 10, 0.4) + part(F.col("_mean"), 10, 0.3) + part(F.col("n_dialogue"), 5, 0.3), 3)
    by_count = F.when(F.col("n_dialogue") >= 2, "合作").when(F.col("n") >= 3, "友情").otherwise("陌生")
    rows = rows.withColumn("strength", strength)
    return rows.withColumn("relation", F.when(F.col("strength") < 0.1, "陌生").otherwise(F.coalesce("_told", by_count))).drop("_mean", "_told")


def nodes(mentions: DataFrame) -> DataFrame:
    """(doc_id, who, n, n_segments, centrality): mentions, segments with them, and the share of the most mentioned name's count (3 decimals)."""
    n = mentions.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("idx").alias("n_segments"))
    top = n.groupBy("doc_id").agg(F.max("n").alias("_top"))
    return n.join(top, "doc_id").select("doc_id", "who", "n", "n_segments", rounded(F.col("n") / F.col("_top"), 3).alias("centrality"))


def presence(known: DataFrame, expected: DataFrame, aliases: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, idx, who): the segments of each character. known: (doc_id, idx, who), a sample perhaps; of characters that it has in fewer segments than expected (doc_id, who, n_segments) all
    segments (doc_id, idx, txt) count that hold one of their aliases (doc_id, who, alias). All aliases are looked for in one pass."""
    have = known.select("doc_id", "idx", "who").distinct()
    n = have.groupBy("doc_id", "who").agg(F.count(F.lit(1)).alias("_n"))
    short = expected.join(n, ["doc_id", "who"], "left").filter(F.coalesce("_n", F.lit(0)) < F.col("n_segments")).select("doc_id", "who")
    wanted = aliases.filter(F.length("alias") > 0).join(short, ["doc_id", "who"], "left_semi").select("doc_id", "who", F.col("alias").alias("w")).distinct()
    hits = patterns.find(rows.select("doc_id", "idx", "txt"), wanted.select("w")).select("doc_id", "idx", "w").distinct()
    return have.union(hits.join(wanted, ["doc_id", "w"]).select("doc_id", "idx", "who")).distinct()
