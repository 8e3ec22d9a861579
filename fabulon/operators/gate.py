"""Document quality gate: (doc_id, text) -> measures and verdicts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabulon.functions.text import rounded

# fixed values: ideographs and their punctuation; remains of markup and control characters
CJK_WIDE = "[一-鿿㐀-䶿　-〿＀-￯]"
# what garbage begins with is looked for first, as most places hold none of it
GARBAGE = r"(?i)(?=[\x{fffd}\x00-\x08\x0b\x0c\x0e-\x1f&<])(?:[\x{fffd}\x00-\x08\x0b\x0c\x0e-\x1f]|&nbsp;|&amp;|&lt;|&gt;|<br\s*/?>|<p\s*>|</p>|<div[^>]*>|</div>)"
WEIGHTS = {"cjk": 0.30, "quotes": 0.15, "garbage": 0.20, "paragraphs": 0.20, "repetition": 0.15}
# characters whose n-grams are counted together
PLACES = 1 << 20


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def graded(value: Column, good: float, fair: float) -> Column:
    return F.when(value <= good, "pass").when(value <= fair, "warn").otherwise("fail")


def cjk_ratio(docs: DataFrame) -> DataFrame:
    ratio = share(F.regexp_count("text", F.lit(CJK_WIDE)), F.length("text"))
    return docs.select("doc_id", ratio.alias("ratio")).select("*", F.when(F.col("ratio") >= 0.8, "pass").when(F.col("ratio") >= 0.56, "warn").otherwise("fail").alias("status"))


def quote_balance(docs: DataFrame, left: str = "«“「『‘", right: str = "»”」』’") -> DataFrame:
    count = lambda marks: F.length("text") - F.length(F.translate("text", marks, ""))
    rows = docs.select("doc_id", count(left).cast("long").alias("n_open"), count(right).cast("long").alias("n_close"))
    off = share(F.abs(F.col("n_open") - F.col("n_close")), F.col("n_open") + F.col("n_close"))
    return rows.withColumn("imbalance", off).withColumn("status", graded(F.col("imbalance"), 0.1, 0.2))


def garbage_density(rows: DataFrame, key: str, text: str) -> DataFrame:
    n = F.regexp_count(text, F.lit(GARBAGE)).cast("long")
    rows = rows.select(key, n.alias("n_garbage"), F.length(text).cast("long").alias("n_chars"))
    return rows.withColumn("density", share(F.col("n_garbage"), F.col("n_chars"))).withColumn("status", graded(F.col("density"), 0.001, 0.01))


def _paragraphs() -> Column:
    """The text's parts between blank lines, without space at their ends."""
    return F.filter(F.transform(F.split("text", r"\n\s*\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def paragraph_stats(docs: DataFrame) -> DataFrame:
    """Lengths of paragraphs: a row stays where it is, no paragraph leaves it."""
    rows = docs.select("doc_id", F.transform(_paragraphs(), lambda x: F.length(x).cast("double")).alias("l")).withColumn("n", F.size("l").cast("long")).filter("n >= 0")
    rows = rows.withColumn("mean", _total(F.col("l")) / F.greatest("n", F.lit(1)))
    rows = rows.withColumn("sd", F.sqrt(F.greatest(_total(F.transform("l", lambda x: x * x)) / F.greatest("n", F.lit(1)) - F.col("mean") * F.col("mean"), F.lit(0.0))))
    rows = rows.withColumn("cv", F.when(F.col("mean") > 0, F.col("sd") / F.col("mean")).otherwise(0.0)).withColumn("short", F.size(F.filter("l", lambda x: x < 10)) / F.greatest("n", F.lit(1)))
    score = F.when(F.col("n") == 0, 0).when(F.col("n") <= 2, 75).when(F.col("cv").between(0.2, 1.2) & (F.col("short") < 0.3), 100).when((F.col("cv") <= 2) & (F.col("short") < 0.5), 70).otherwise(40)
    return rows.select("doc_id", "n", rounded(F.col("mean"), 1).alias("mean"), rounded(F.col("sd"), 1).alias("sd"), rounded(F.col("cv"), 3).alias("cv"), rounded(F.col("short"), 3).alias("short"), score.cast("long").alias("score")).withColumn("status", by_score())


def by_score() -> Column:
    return F.when(F.col("score") >= 100, "pass").when(F.col("score") >= 70, "warn").otherwise("fail")


def repetition(docs: DataFrame, least: int = 20, head: int | None = None) -> DataFrame:
    """Paragraphs of more than `least` characters that equal the one before, and the share of repeated character n-grams of the whole text (or of its first `head` characters)."""
    p = docs.select("doc_id", _paragraphs().alias("p"))
    same = F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.size("p") - 1, F.lit(1))), lambda i: F.coalesce((F.get("p", i) == F.get("p", i - 1)) & (F.length(F.get("p", i)) > least), F.lit(False))))
    rows = p.select("doc_id", F.coalesce(F.size("p"), F.lit(-1)).alias("n"), same.cast("long").alias("n_repeated"))
    grams = gram_repetition(docs, head=head).select("doc_id", F.when(F.col("n_grams") > 1, F.col("repeated")).otherwise(0.0).alias("ratio"))
    return rows.join(grams, "doc_id").select("doc_id", "n", "n_repeated", "ratio").select("doc_id", "n_repeated", rounded(F.col("ratio"), 3).alias("ratio"), _repetition_score().cast("long").alias("score")).withColumn("status", by_score())


def _repetition_score() -> Column:
    return F.when(F.col("n") <= 0, 0).when((F.col("n_repeated") == 0) & (F.col("ratio") < 0.3), 100).when((F.col("n_repeated") <= 2) & (F.col("ratio") < 0.5), 70).otherwise(40)


def distinct_grams(texts: list[str], size: int) -> np.ndarray:
    """How many different strings of `size` characters each text holds. Characters are numbered, so that a string is one number; where that is too large, or the texts are long, they are halved."""
    if len(texts) > 1 and sum(map(len, texts)) > PLACES:
        mid = len(texts) // 2
        return np.concatenate([distinct_grams(texts[:mid], size), distinct_grams(texts[mid:], size)])
    x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(x):
        return np.zeros(len(texts), dtype=np.int64)
    used = np.zeros(int(x.max()) + 1, dtype=np.int64)
    used[x] = 1
    base = int(used.sum())
    if base**size >= 1 << 63:
        if len(texts) == 1:
            return np.array([len({texts[0][i : i + size] for i in range(len(texts[0]) - size + 1)})])
        mid = len(texts) // 2
        return np.concatenate([distinct_grams(texts[:mid], size), distinct_grams(texts[mid:], size)])
    x = (np.cumsum(used) - 1)[x]
    grams = np.zeros(max(len(x) - size + 1, 0), dtype=np.int64)
    for i in range(size):
        grams = grams * base + x[i : i + len(grams)]
    ends = np.cumsum([len(t) for t in texts])
    out = np.zeros(len(texts), dtype=np.int64)
    for i, (text, end) in enumerate(zip(texts, ends.tolist(), strict=True)):
        if len(text) >= size:
            own = np.sort(grams[end - len(text) : end - size + 1])
            out[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
    return out


def gram_repetition(docs: DataFrame, size: int = 5, head: int | None = 5000) -> DataFrame:
    """Share of repeated character n-grams in the first `head` characters (the measure's own window), or in the whole text."""

    def distinct(texts: pd.Series) -> pd.Series:
        return pd.Series(distinct_grams(texts.fillna("").tolist(), size), dtype="int64")

    distinct.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    own = F.col("text") if head is None else F.left("text", F.lit(head))
    rows = docs.select("doc_id", F.greatest(F.length(own) - size + 1, F.lit(0)).alias("n"), F.pandas_udf(distinct, "long")(own).alias("d"))
    return rows.select("doc_id", F.col("n").cast("long").alias("n_grams"), F.col("d").cast("long").alias("n_distinct"), F.round(share(F.col("n") - F.col("d"), F.col("n")), 6).alias("repeated"))


def verdict(docs: DataFrame) -> DataFrame:
    """Weighted score and the worst status of the checks."""
    whole = lambda c: F.least(F.greatest(F.floor(c), F.lit(0)), F.lit(100)).cast("double")
    marks = {
        "cjk": (cjk_ratio(docs), F.when(F.col("status") == "pass", 100.0).otherwise(whole(F.col("ratio") / 0.8 * F.when(F.col("status") == "warn", 80.0).otherwise(40.0)))),
        "quotes": (quote_balance(docs), F.when(F.col("status") == "pass", 100.0).otherwise(whole((1 - F.col("imbalance")) * F.when(F.col("status") == "warn", 80.0).otherwise(50.0)))),
        "garbage": (garbage_density(docs, "doc_id", "text"), F.when(F.col("n_chars") == 0, 0.0).when(F.col("status") == "pass", 100.0).when(F.col("status") == "warn", whole((1 - F.col("density") * 50) * 80)).otherwise(whole((1 - F.col("density") * 10) * 40))),
        "paragraphs": (paragraph_stats(docs), F.col("score").cast("double")), "repetition": (repetition(docs, head=5000), F.col("score").cast("double")),
    }
    rows = None
    for name, (found, points) in marks.items():
        status = F.when((F.col("n_chars") == 0), "fail").otherwise(F.col("status")) if name == "garbage" else F.col("status")
        found = found.select("doc_id", status.alias(name), points.alias(name + "_score"))
        rows = found if rows is None else rows.join(found, "doc_id")
    worst = F.when(F.array_contains(F.array(*WEIGHTS), "fail"), "fail").when(F.array_contains(F.array(*WEIGHTS), "warn"), "warn").otherwise("pass")
    return rows.select("doc_id", rounded(sum(F.col(c + "_score") * w for c, w in WEIGHTS.items()), 2).alias("score"), worst.alias("verdict"))


def recommendations(rows: DataFrame) -> DataFrame:
    """Advice by status, for rows with the statuses of verdict's checks."""
    texts = {"cjk": "check the language", "quotes": "repair quote marks", "garbage": "strip markup", "paragraphs": "check paragraph breaks", "repetition": "remove repeated passages"}
    return rows.withColumn("advice", F.array_compact(F.array(*(F.when(F.col(c) != "pass", F.lit(t)) for c, t in texts.items() if c in rows.columns))))
