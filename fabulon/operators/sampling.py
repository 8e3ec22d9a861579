"""Seeded samples of exact size by stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drawn(seed: int, *keys: str) -> Column:
    """The place of a row in the seeded order: the md5 of seed and keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys)))


def stratified(rows: DataFrame, strata: list[str], keys: list[str], size: int | Column, seed: int = 0, parts: int = 64) -> DataFrame:
    """`size` rows of each stratum (all, if it has fewer): the first ones by the md5 of seed and keys, so that the sample is the same however the rows are dealt out.

    The first rows of a stratum are the first ones of its parts' first ones: rows are dealt to `parts` parts of each stratum by their md5, each keeps `size` rows, and only
    these meet, so that a stratum of any size is no task's work. size may be an expression of the strata. Rows that agree in stratum and keys are alike to the sample: any of them
    stands for the other, and each counts. Nulls are a stratum and a key of their own.
    """
    size = F.lit(size) if isinstance(size, int) else size
    placed = rows.withColumn("_h", drawn(seed, *strata, *keys))
    part = placed.withColumn("_part", F.pmod(F.crc32("_h"), F.lit(parts)))
    first = part.withColumn("_rn", F.row_number().over(Window.partitionBy(*strata, "_part").orderBy("_h"))).filter(F.col("_rn") <= size)
    return first.withColumn("_rn", F.row_number().over(Window.partitionBy(*strata).orderBy("_h"))).filter(F.col("_rn") <= size).drop("_h", "_part", "_rn")


def shares(rows: DataFrame, strata: list[str], sample: DataFrame) -> DataFrame:
    """By stratum the rows there are, those in the sample, and the weight of one of them."""
    total = rows.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"))
    taken = sample.groupBy(*strata).agg(F.count(F.lit(1)).alias("_taken"))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in strata]
    met = total.alias("a").join(taken.alias("b"), on, "left")
    k = F.coalesce(F.col("_taken"), F.lit(0))
    return met.select(*(F.col(f"a.{c}").alias(c) for c in strata), "n", k.alias("taken"), F.when(k > 0, F.round(F.col("n") / k, 6)).alias("weight"))
