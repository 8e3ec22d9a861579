"""Confidence of annotations, recomputed term by term from what they hold, and its rewrite with a summary.

Rows are (doc_id, idx, layer, raw): the JSON text of a layer's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from fabulon.functions import enums as E
from fabulon.functions.text import rounded
from fabulon.sources.versions import Table

KEY = ["doc_id", "idx"]
# fixed values: fields that a layer must have, the polarity of a mood, the kinds of the craft dimensions and the weights of the terms
REQUIRED = {"structure": ["D01", "D04", "D05", "D07", "D08"], "interpretation": ["D06_information_control", "D09"], "craft": ["D13_golden_lines", "D14_rhetoric", "D15_imagery", "D16_diction", "D17_syntax"], "emotion": ["primary", "target", "trigger", "expression"]}
MOOD_POLARITY = {
    "信任": "positive", "压抑": "negative", "厌恶": "negative", "喜悦": "positive", "复仇": "negative", "嫉妒": "negative", "孤独": "negative", "屈辱": "negative", "希望": "positive", "平静": "neutral",
    "恐惧": "negative", "悬疑": "neutral", "悲伤": "negative", "惊讶": "neutral", "愤怒": "negative", "渴望": "positive", "焦虑": "negative", "绝望": "negative", "羞耻": "negative", "释然": "positive",
}
KINDS = {"D14_rhetoric": ("type", E.RHETORIC), "D15_imagery": ("type", E.IMAGERY), "D16_diction": ("pos", E.DICTION), "D17_syntax": ("type", E.SYNTAX)}
WEIGHTS = {"validation": 0.30, "completeness": 0.25, "span": 0.20, "enums": 0.15, "consistency": 0.10}
#: Closed values: the column that holds one, its place in the layer's object and what is legal.
GIVEN = {"_d01": ("D01", E.D01), "_d04": ("D04.core", E.D04_CORE), "_d07": ("D07.type", E.D07)}
METHOD, SINCE = "recalibrated_v382", "v3.8.2"


def _layer(raw: Column, layer: Column) -> Column:
    """The layer's object, under layers unless that is empty, else at the root; an empty object where there is none."""
    under = F.call_function("get_json_object", raw, F.concat(F.lit("$.layers."), layer))
    top = F.call_function("get_json_object", raw, F.concat(F.lit("$."), layer))
    return F.coalesce(F.when(under != "{}", under), top, F.lit("{}"))


def _at(path: str, of: str = "_l") -> Column:
    return F.get_json_object(of, f"$.{path}")


def _items(dim: str) -> Column:
    return F.coalesce(F.from_json(_at(dim), "array<map<string,string>>"), F.array().cast("array<map<string,string>>"))


def _named(dim: str, key: str) -> Column:
    """The kinds of a dimension's items, without empty ones."""
    return F.filter(F.transform(F.col(f"_{dim}"), lambda x: x[key]), lambda v: F.coalesce(v, F.lit("")) != "")


def opened(rows: DataFrame, layer: Column) -> DataFrame:
    """rows with what the terms read more than once of the layer's object (_l), each parsed once: closed values, and the items of a craft row."""
    return rows.withColumns({v: _at(path) for v, (path, _) in GIVEN.items()} | {f"_{dim}": F.when(layer == "craft", _items(dim)) for dim in REQUIRED["craft"]})


def _among(kinds: Column, legal: list[str]) -> Column:
    return F.filter(kinds, lambda v: v.isin(*legal))


def completeness(layer: Column) -> Column:
    """The share of a layer's required fields that are neither null nor empty."""
    filled = lambda f: F.coalesce(~_at(f).isin("", "[]", "{}"), F.lit(False)).cast("int")
    out = F.lit(1.0)
    for name, fields in REQUIRED.items():
        out = F.when(layer == name, sum(filled(f) for f in fields) / len(fields)).otherwise(out)
    return out


def enum_validity(layer: Column) -> Column:
    """The share of closed values that are legal, of those that are there; 1 without any."""
    known = [F.when(F.coalesce(F.col(v), F.lit("")) != "", F.col(v).isin(*legal).cast("int")) for v, (_, legal) in GIVEN.items()]
    total, good = sum(F.when(k.isNotNull(), 1).otherwise(0) for k in known), sum(F.coalesce(k, F.lit(0)) for k in known)
    for dim, (key, legal) in KINDS.items():
        kinds = F.when(layer == "craft", _named(dim, key))
        total = total + F.when(kinds.isNotNull(), F.size(kinds)).otherwise(0)
        good = good + F.when(kinds.isNotNull(), F.size(_among(kinds, legal))).otherwise(0)
    return F.when(total > 0, good / total).otherwise(1.0)


def span_accuracy(layer: Column) -> Column:
    """Mean over a craft row's quotes of 1 with a span that has both ends and .5 without; 1 for all else."""
    quotes = F.filter(F.concat(*(F.col(f"_{d}") for d in REQUIRED["craft"])), lambda x: F.coalesce(x["text"], F.lit("")) != "")
    ends = lambda x: F.json_object_keys(x["span"])
    whole = lambda x: F.coalesce(F.array_contains(ends(x), "start") & F.array_contains(ends(x), "end"), F.lit(False))
    spans = F.transform(quotes, lambda x: F.when(whole(x), 1.0).otherwise(0.5))
    return F.when(layer == "craft", F.aggregate(spans, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")), lambda a, v: F.struct((a["sum"] + v).alias("sum"), (a["n"] + 1).alias("n")), lambda a: F.when(a["n"] > 0, a["sum"] / a["n"]).otherwise(1.0))).otherwise(1.0)


def consistency(layer: Column) -> Column:
    """For structure and emotion rows how far the mood (_core, _intensity) and the primary emotion (_emotion, _strength, _polarity) agree in polarity and intensity; 1 for other layers."""
    table = F.create_map(*(F.lit(x) for pair in MOOD_POLARITY.items() for x in pair))
    expected = table[F.col("_core")]
    polarity = F.when((F.col("_polarity") == "mixed") | expected.isNull(), 0.8).when(expected == F.col("_polarity"), 1.0).otherwise(0.5)
    both = (F.coalesce("_intensity", F.lit(0)) != 0) & (F.coalesce("_strength", F.lit(0)) != 0)
    intensity = F.when(both, F.greatest(F.lit(0.5), 1.0 - F.abs(F.col("_intensity") - F.col("_strength")) * 0.15)).otherwise(0.8)
    absent = (F.coalesce("_core", F.lit("")) == "") | (F.coalesce("_emotion", F.lit("")) == "")
    return F.when(~layer.isin("structure", "emotion"), 1.0).when(absent, 0.8).otherwise((polarity + intensity) / 2)


def terms(rows: DataFrame) -> DataFrame:
    """rows with the five terms and the confidence (3 decimals).

    Structure and emotion rows are measured against the row of the other layer of their segment (the last one by raw, if there are several); without one they get the neutral .8.
    """
    mood = [("_core", "layers.structure.D04.core", "string"), ("_intensity", "layers.structure.D04.intensity", "double")]
    felt = [("_emotion", "layers.emotion.primary.emotion", "string"), ("_strength", "layers.emotion.primary.intensity", "double"), ("_polarity", "layers.emotion.primary.polarity", "string")]
    pick = lambda fields, of: F.struct(*(F.get_json_object(of, f"$.{p}").try_cast(t).alias(n) for n, p, t in fields))
    own = F.col("layer")
    # one exchange by segment; rows without a key have no other layer
    known, segment = F.col("doc_id").isNotNull() & F.col("idx").isNotNull(), Window.partitionBy(*KEY)
    last = lambda name: F.max(F.when((own == name) & known, F.col("raw"))).over(segment)
    one = rows.withColumns({"_m": last("structure"), "_f": last("emotion")})
    one = one.withColumns({"_m": F.when(own == "structure", F.col("raw")).when(own == "emotion", F.col("_m")), "_f": F.when(own == "emotion", F.col("raw")).when(own == "structure", F.col("_f")), "_l": _layer(F.col("raw"), own)})
    one = one.withColumns({"_m": pick(mood, "_m"), "_f": pick(felt, "_f")})
    one = one.withColumns({n: F.col(f"_m.{n}") for n, _, _ in mood} | {n: F.col(f"_f.{n}") for n, _, _ in felt})
    one = opened(one, own).withColumns({"validation": F.lit(1.0), "completeness": completeness(own), "span": span_accuracy(own), "enums": enum_validity(own), "consistency": consistency(own)})
    return one.withColumn("confidence", rounded(sum(F.col(t) * w for t, w in WEIGHTS.items()), 3)).select(*rows.columns, *WEIGHTS, "confidence")


def flagged(measured: DataFrame) -> DataFrame:
    """Terms and confidence as the row's new confidence (overall, method, breakdown) and its metadata flags."""
    breakdown = F.struct(*WEIGHTS)
    rest = [c for c in measured.columns if c not in (*WEIGHTS, "confidence")]
    return measured.select(*rest, F.struct(F.col("confidence").alias("overall"), F.lit(METHOD).alias("confidence_method"), breakdown.alias("breakdown")).alias("confidence"), F.create_map(F.lit("confidence_recalibrated"), F.lit("true"), F.lit("confidence_recalibrated_at"), F.lit(SINCE)).alias("metadata"))


def summary(measured: DataFrame) -> DataFrame:
    """By layer the rows, the mean (3 decimals), least and greatest confidence, and how many different ones there are."""
    return measured.groupBy("layer").agg(F.count(F.lit(1)).alias("total"), rounded(F.avg("confidence"), 3).alias("mean"), F.min("confidence").alias("least"), F.max("confidence").alias("greatest"), F.count_distinct("confidence").alias("different"))


def rewrite(table: Table) -> dict[str, dict]:
    """Give all rows of a table of layers (each layer a partition) their recomputed confidence, in one change, and say of each layer what summary says.

    Each layer is read with the others once; the summary is observed while its part is written. Only rows with a confidence from 0 to 1 pass.
    """
    since = table.version()
    whole = table.read(version=since)
    out: dict[str, dict] = {}
    if whole is None:
        return out
    parts = {}
    for layer in table.parts(since):
        seen = Observation()
        measured = terms(whole.select(*KEY, "layer", "raw")).filter(F.col("layer") == layer)
        c = F.col("confidence")
        watched = measured.observe(seen, F.count(F.lit(1)).alias("total"), F.sum(F.when(c.between(0, 1), 0).otherwise(1)).alias("bad"), F.avg(c).alias("mean"), F.min(c).alias("least"), F.max(c).alias("greatest"), F.size(F.collect_set(F.round(c * 1000).cast("int"))).alias("different"))  # 1,001 values at most
        parts[layer] = [table.stage(flagged(watched))]
        found = seen.get
        if found["bad"] or found["total"] != table.read(layer, version=since).count():
            raise ValueError(f"{layer}: {found}")
        out[layer] = {k: round(v, 3) if isinstance(v, float) else v for k, v in found.items() if k != "bad"}
    table.publish(parts, since)
    return out
