"""Preparation of `documents` for training: five stages, each on the rows that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows to the shared folder and reads them again.
A stage deletes the tables it makes, but for small ones (ids, passages) that its rows read. Stages let the session give up the files of finished shuffles
(spark.sql.classic.shuffleDependency.fileCleanup.enabled), as those of a stage are of no use to the next one.
Rows of null doc_id or null text, empty texts, ties and repeated rows have a defined result in each stage, stated there; empty tables give empty results.
The last stage gives a row for each document copy of the mix: ids and offsets of its text, and digests of ids and of the bytes decoded.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabulon.llm import bpe, language_id, minhash_dedup, mixing, substring_dedup
from fabulon.llm.scratch import CLEANUP, Scratch, shared_dir
from fabulon.plans.ship import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _lean(spark: SparkSession) -> None:
    if spark.conf.get(CLEANUP, None) is not None:
        spark.conf.set(CLEANUP, "true")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those learned from the labelled documents; rejected texts go. Null and empty texts and texts without letters
    go as rejected; each repeated row is judged by itself, by text alone, and so shares the fate of its equals; doc_id may be null."""
    _lean(spark)
    return language_id.keep_identified(docs.select(*COLUMNS), language_id.train(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id. Texts that share a doc_id are documents of their own: the first
    one in order stands under the doc_id, and the others come after all doc_ids, under a hash of doc_id and text."""
    _lean(spark)
    once = docs.select(*COLUMNS)
    known = once.filter("doc_id is not null")
    # of equal texts of one doc_id the least row; the least text of a doc_id is its first
    rows = known.groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("rest")).select("doc_id", "text", "rest.*")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text")) == 1
    late = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 61)) + F.lit(1 << 62)
    rows = rows.withColumn("_node", F.when(first, F.col("doc_id").cast("long")).otherwise(late))
    with Scratch(spark) as scratch:
        found = minhash_dedup.near_duplicates(scratch.cut(rows.select(F.col("_node").alias("doc_id"), "text")), percent=80)
        keep = scratch.keep(found.filter("kept").select(F.col("doc_id").alias("_keep")).distinct())
    return rows.join(keep, F.col("_node") == F.col("_keep"), "left_semi").select(*COLUMNS).unionAll(once.filter("doc_id is null"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one holds; n_chars follows the text."""
    _lean(spark)
    return substring_dedup.drop_repeats(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes (at most two). Null and empty texts have no words and are never taken; rows of one doc_id and
    source are taken together; rows of null doc_id are one item; ties of the seeded order go by doc_id."""
    _lean(spark)
    mixed = mixing.mix(docs.select(*COLUMNS), F.array("source"), mixing.words_of())
    copies = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return mixed.withColumn("_copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>")))).select(*COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each text's ids, and digest of what they decode to: a row for each row. Null text counts as empty, with no ids."""
    _lean(spark)
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [("language_id", language_stage), ("minhash_near_dedup", near_dedup_stage), ("substring_dedup", substring_stage), ("mixing", mixing_stage), ("byte_level_bpe", bpe_stage)]

#: Hash-seeded selection, chaining and BPE are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    ship(spark)
    root = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        found = stage(spark, docs, sf_dir)
        found.write.parquet(f"{root}/{name}")
        docs = spark.read.schema(found.schema).parquet(f"{root}/{name}")
    return docs
