"""Annotations of any shape: paths and values of nested JSON, keys at any depth, and redaction for export."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: what stands for hidden text, and parts of the names of keys whose values are hidden
HIDDEN = "【已脱敏】"
HIDDEN_KEYS = ("原文", "source", "raw_text", "plain_text")
SHALLOW = 16


def _marks(raw: Column) -> Column:
    """The brackets and braces of a JSON text that stand in no string."""
    # escapes go first, so that a string is what stands between two quotes
    bare = F.regexp_replace(F.regexp_replace(raw, r"\\.", ""), '"[^"]*+"', "")
    return F.regexp_replace(bare, r"[^\[\]{}]", "")


def _most(marks: Column) -> Column:
    step = lambda acc, c: F.struct((acc["now"] + F.when(c.isin("[", "{"), 1).otherwise(-1)).alias("now"), F.greatest(acc["most"], acc["now"] + F.when(c.isin("[", "{"), 1).otherwise(-1)).alias("most"))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.when(F.length(marks) > 0, F.aggregate(F.split(marks, "(?!^)"), start, step, lambda acc: acc["most"])).otherwise(0)


def depth(raw: Column) -> Column:
    """How many objects and arrays are open at once in a JSON text."""
    return _most(_marks(raw))


def deepest_of(rows: DataFrame, raw: str = "raw") -> int:
    """The largest depth of the texts. Annotations of one form have the same marks, which are followed once."""
    return rows.select(_marks(F.col(raw)).alias("m")).distinct().agg(F.max(_most(F.col("m")))).first()[0] or 0


def flattened(rows: DataFrame, raw: str = "raw", deepest: int | None = None) -> DataFrame:
    """(the other columns.., path, value, kind): a row for each scalar of a JSON text at any depth, and for each empty object or array.

    Paths are written `$.key[0].key`. The texts are parsed to variants, and each step opens the objects and arrays of one level: as many steps as the
    deepest text needs, which one pass finds unless it is given. Malformed and null texts give no row. kind is the variant's own type.
    """
    keys = [c for c in rows.columns if c != raw]
    if deepest is None:
        deepest = deepest_of(rows, raw)
    out = rows.select(*keys, F.lit("$").alias("path"), F.try_parse_json(F.col(raw)).alias("v")).filter(F.col("v").isNotNull())
    tvf = rows.sparkSession.tvf
    for _ in range(deepest):
        # scalars and what is empty have no parts and go on as they are
        opened = out.lateralJoin(tvf.variant_explode_outer(F.col("v").outer()).toDF("_pos", "_key", "_value"))
        named = F.when(F.col("_key").isNotNull(), F.concat("path", F.lit("."), "_key")).when(F.col("_pos").isNotNull(), F.concat("path", F.lit("["), F.col("_pos").cast("string"), F.lit("]"))).otherwise(F.col("path"))
        out = opened.select(*keys, named.alias("path"), F.when(F.col("_pos").isNotNull(), F.col("_value")).otherwise(F.col("v")).alias("v"))
    kind = F.schema_of_variant("v")
    scalar = ~(F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("ARRAY")))
    value = F.when(scalar, F.col("v").cast("string")).otherwise(F.to_json("v"))
    return out.select(*keys, "path", value.alias("value"), F.regexp_extract(kind, "^[A-Z]+", 0).alias("kind"))


def values_of(rows: DataFrame, key: str, raw: str = "raw") -> DataFrame:
    """(the other columns.., path, value): the scalars under a key at any depth, as its own value or in its array."""
    pattern = r"(^|\.)" + key.replace(".", r"\.") + r"(\[\d+\])*$"
    return flattened(rows, raw).filter(F.col("path").rlike(pattern)).drop("kind")


def hidden(value: object, found: dict[str, int]) -> object:
    """A value without text of the original: that of text spans gives way to its length, and all under a key with a part of HIDDEN_KEYS to a
    placeholder, whatever it is. found counts by key."""
    if isinstance(value, list):
        return [hidden(v, found) for v in value]
    if not isinstance(value, dict):
        return value
    out = {}
    for key, v in value.items():
        if key == "text_span" and isinstance(v, dict) and "text" in v:
            length = {"char_length": len(v["text"])} if isinstance(v["text"], str) else {}
            out[key] = {**v, "text": HIDDEN, **length}
        elif any(part in key for part in HIDDEN_KEYS):
            out[key] = HIDDEN
        else:
            out[key] = hidden(v, found)
            continue
        found[key] = found.get(key, 0) + 1
    return out


def redacted(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """rows with the JSON text of an object redacted, and hidden_keys (map of key to number). Texts that are no JSON object, or nested about a thousand
    levels deep, are null with null hidden_keys."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts, keys = [], []
            for t in part:
                text, found = None, {}
                try:
                    value = json.loads(t) if t is not None else None
                    text = json.dumps(hidden(value, found), ensure_ascii=False) if isinstance(value, dict) else None
                except (ValueError, RecursionError):
                    pass
                texts.append(text)
                keys.append(None if text is None else found)
            yield pd.DataFrame({"raw": texts, "keys": keys})

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    met = rows.withColumn("_x", F.pandas_udf(run, "raw string, keys map<string,long>")(F.col(raw)))
    return met.withColumns({raw: F.col("_x.raw"), "hidden_keys": F.col("_x.keys")}).drop("_x")


def exported(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """flattened of the redacted texts. Redaction makes no text deeper, so the depth of what is given serves, and nothing is redacted to find it; but where
    that is beyond SHALLOW, in hidden or broken texts perhaps, the redacted ones are asked."""
    bound = deepest_of(rows, raw)
    return flattened(redacted(rows, raw).drop("hidden_keys"), raw, bound if bound <= SHALLOW else None)


def export_summary(clean: DataFrame, raw: str = "raw") -> DataFrame:
    """(kind, name, n) of redacted rows: lines in all, annotations and skipped lines, annotations by document, by status and by schema version, and hidden fields by key."""
    kept = F.col(raw).isNotNull()
    field = lambda name, none: F.coalesce(F.nullif(F.get_json_object(raw, f"$.{name}"), F.lit("")), F.lit(none))
    counted = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"), F.lit(1).cast("long").alias("n"))
    own = F.array(counted("lines", F.lit("total")), F.when(kept, counted("lines", F.lit("annotations"))).otherwise(counted("lines", F.lit("skipped"))), *(F.when(kept, counted(kind, field(key, none))) for kind, key, none in (("document", "document_id", "__unknown_doc__"), ("status", "status", "__no_status__"))), F.when(F.get_json_object(raw, "$.schema_version").isNotNull(), counted("schema_version", F.get_json_object(raw, "$.schema_version"))))
    by_key = F.transform(F.map_entries(F.coalesce("hidden_keys", F.create_map().cast("map<string,bigint>"))), lambda e: F.struct(F.lit("hidden").alias("kind"), e["key"].alias("name"), e["value"].alias("n")))
    return clean.select(F.explode(F.array_compact(F.concat(own, by_key))).alias("x")).select("x.*").groupBy("kind", "name").agg(F.sum("n").alias("n"))
