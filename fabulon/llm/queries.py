"""The registered queries of this subpackage, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, bpe, chat, language_id, lm, minhash_dedup, mixing, pieces, quality, runs, substring_dedup, vector_dedup

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int) -> Column:
    """crc32 of doc_id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def held_out(n: int, value: int) -> Column:
    return F.coalesce(remainder(n) == value, F.lit(False))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), limit=0.98)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each row of a conversation: its role as given and as recovered from the raw transcript, and its part of the canonical text."""
    raw = chat.raw_pieces(table(spark, sf_dir, "conversations"))
    return chat.format_pieces(raw).withColumnRenamed("role", "given_role").select("conv_id", "turn", "given_role", "found_role", "n_begun", "rendered")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(3, 1)
    weights = quality.train(docs, table(spark, sf_dir, "labels").filter(~out), label="quality")
    return quality.score(docs, weights).select("doc_id", out.alias("held_out"), "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, F.array("source"), mixing.words_of()).select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated passages: the document that loses one, its words, and the earlier document."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(5, 1)
    found = lm.score_texts(table(spark, sf_dir, "documents"), ~out, set(bpe.read_ranks(RANKS)))
    return found.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(4, 2)
    tables = language_id.train(docs.filter(~out))
    return language_id.identify(docs, tables).select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of texts of which one in ten has a tail that repeats itself."""
    return runs.run_summaries(table(spark, sf_dir, "documents"), change=runs.planted_tail)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), PIECES)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_counts(table(spark, sf_dir, "documents"), BYTES, PIECES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_ann, op2_vector_dedup, op3_chat, op4_bpe, op5_quality, op6_mixing, op7_substring_dedup, op8_lm, op9_language_id, op10_minhash_dedup, op11_periodic_runs, op12_sentencepiece, op13_alignment]
    return {f.__name__: f for f in found}


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a), n AS (SELECT a, count(DISTINCT b) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low.b, vec_id)) AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(low.b, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.a = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_vector_dedup": OP2_SQL, "op10_minhash_dedup": OP10_SQL}
