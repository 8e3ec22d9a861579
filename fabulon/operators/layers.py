"""Layers of annotations kept as JSON text, as typed columns, and the round of validation and repair before rows are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabulon.functions.similarity import locate

from .validate import checked, craft_rules

STRUCTURE = "D01 string, D04 struct<core string, intensity string, polarity string>, D05 int, D07 struct<type string, is_switch_point boolean>, D08 struct<time string, space string>, D09 array<string>"
EMOTION = "primary struct<emotion string, intensity string, polarity string>, arc struct<has_shift boolean>"


def layer(raw: str, name: str) -> Column:
    """JSON text of a layer: under `layers`, else at the root, else an empty object."""
    return F.coalesce(F.get_json_object(raw, f"$.layers.{name}"), F.get_json_object(raw, f"$.{name}"), F.lit("{}"))


def whole(c: Column) -> Column:
    """A number kept as a number or as text; null where it is neither."""
    return c.try_cast("bigint")


def structure(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Function, mood, pace, perspective, time and place of each row; null where the layer or a field is missing or of another type."""
    s = rows.withColumn("_s", F.from_json(layer(raw, "structure"), STRUCTURE))
    switch = F.coalesce(F.col("_s.D07.is_switch_point"), F.lit(False))
    return s.select("doc_id", "idx", F.col("_s.D01").alias("d01"), F.col("_s.D04.core").alias("core"), whole(F.col("_s.D04.intensity")).alias("inten"), F.col("_s.D04.polarity").alias("pol"), F.col("_s.D07.type").alias("persp"), switch.alias("switch"), F.col("_s.D08.time").alias("time"), F.col("_s.D08.space").alias("space"))


def emotion(rows: DataFrame, raw: str = "raw", longest: int = 20) -> DataFrame:
    """Primary emotion, its target and whether it shifts. An analysis nested in the layer counts as the layer; a target may be an object or a short text."""
    text = F.coalesce(F.get_json_object(layer(raw, "emotion"), "$.D19_emotion_analysis"), layer(raw, "emotion"))
    e = rows.withColumn("_t", text).withColumn("_e", F.from_json("_t", EMOTION))
    plain = F.get_json_object("_t", "$.target")
    target = F.coalesce(F.get_json_object("_t", "$.target.name"), F.when(~F.startswith(plain, F.lit("{")), plain))
    target = F.when((F.trim(target) != "") & (F.length(target) <= longest), target)
    return e.select("doc_id", "idx", F.col("_e.primary.emotion").alias("emo"), whole(F.col("_e.primary.intensity")).alias("emo_int"), F.col("_e.primary.polarity").alias("emo_pol"), target.alias("emo_tgt"), F.coalesce(F.col("_e.arc.has_shift"), F.lit(False)).alias("has_shift"))


def kind(raw: str = "raw") -> Column:
    """The layer that a row holds, by its keys."""
    has = lambda *names: F.coalesce(*(F.get_json_object(raw, f"$.{p}{n}") for n in names for p in ("layers.", ""))).isNotNull()
    return F.when(has("craft"), "craft").when(has("emotion"), "emotion").when(has("interpretation"), "interpretation").when(has("structure"), "structure").otherwise("unknown")


def committed(items: DataFrame) -> DataFrame:
    """Craft items (dim, kind, text, start, end, segment) as `valid`, `repaired` or `rejected`, repaired ones with the span and text that the segment holds.

    Only items that break a rule about their span go through the search; a second search would find the same span, so there is one round.
    """
    span = F.arrays_overlap("errors", F.array(F.lit("bounds"), F.lit("not in text")))
    names = [c for c in items.columns if c not in ("start", "end", "text")]
    rows = checked(items, craft_rules()).withColumn("_segment", F.when(span, F.col("segment"))).withColumnRenamed("is_valid", "_fine").drop("errors", "warnings")
    rows = rows.withColumn("_f", locate("_segment", "text")).withColumn("_hit", F.col("_segment").isNotNull() & F.col("_f.start").isNotNull())
    mended = lambda old, new: F.when(F.col("_hit"), new).otherwise(F.col(old)).alias(old)
    cut = F.substring("segment", F.col("_f.start") + 1, F.col("_f.end") - F.col("_f.start"))
    rows = rows.select(*names, "_fine", mended("start", F.col("_f.start")), mended("end", F.col("_f.end")), mended("text", cut))
    outcome = F.when(F.col("_fine"), "valid").when(F.col("is_valid"), "repaired").otherwise("rejected")
    return checked(rows, craft_rules()).withColumn("outcome", outcome).drop("_fine", "errors", "warnings", "is_valid")


def prompts(rows: DataFrame) -> DataFrame:
    """(doc_id, idx, prompt): what a model is asked for a segment (idx, txt, context_prev, context_next, reasons, summary).

    Empty contexts say that the text begins or ends there; reasons is an array of what triggers the emotion layer, summary may be null.
    """
    context = lambda c, none: F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(none)).otherwise(F.trim(c))
    why = F.when(F.size("reasons") > 0, F.concat(F.lit("emotion layer: "), F.array_join("reasons", "; "))).otherwise("emotion layer: no trigger")
    memory = F.when(F.coalesce("summary", F.lit("")) != "", F.concat(F.lit("\nmemory: "), F.col("summary"))).otherwise("")
    text = F.concat(F.lit("segment: "), F.col("idx").cast("string"), F.lit("\nbefore: "), context("context_prev", "(start)"), F.lit("\nafter: "), context("context_next", "(end)"), F.lit("\n---\n"), F.col("txt"), F.lit("\n---"), memory, F.lit("\n"), why)
    return rows.select("doc_id", "idx", text.alias("prompt"))


def imagery(craft: DataFrame) -> DataFrame:
    """One row for each item of D15 (an array of structs) in order, of unknown type where none is given; rows without items give none."""
    item = craft.select("doc_id", "idx", F.posexplode("d15").alias("pos", "i"))
    return item.select("doc_id", "idx", F.col("pos").cast("long").alias("pos"), "i.text", F.coalesce("i.type", F.lit("unknown")).alias("type"), "i.cluster", "i.start", "i.end")


def padded(rows: DataFrame, segments: DataFrame, version: str) -> DataFrame:
    """rows (doc_id, idx, ..) with text, segment_id and schema_version filled in from segments where they lack."""
    known = segments.select("doc_id", "idx", F.col("txt").alias("_txt"), F.col("segment_id").alias("_segment"))
    out = rows.join(known, ["doc_id", "idx"], "left")
    return out.withColumns({"txt": F.coalesce("txt", "_txt"), "segment_id": F.coalesce("segment_id", "_segment"), "schema_version": F.coalesce("schema_version", F.lit(version))}).drop("_txt", "_segment")


def first_seen(rows: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column by document, in the order of their first segments."""
    first = rows.filter(F.col(column).isNotNull()).groupBy("doc_id", column).agg(F.min("idx").alias("at"))
    return first.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", F.col(column).alias("v")))), lambda x: x["v"]).alias("values"))


def export_counters(rows: DataFrame) -> DataFrame:
    """Rows by document and status."""
    return rows.groupBy("doc_id", "status").agg(F.count(F.lit(1)).alias("n"))


def enum_schema(layer: str) -> dict:
    """A JSON schema that holds the closed values of a layer (structure or emotion)."""
    from fabulon.functions import enums as E

    text = lambda values: {"type": "string", "enum": list(values)}
    number = lambda low, high: {"type": "integer", "minimum": low, "maximum": high}
    of = lambda **properties: {"type": "object", "properties": properties, "required": list(properties)}
    feeling = of(emotion=text(E.EMOTIONS), intensity=number(1, 10), polarity=text(E.POLARITY))
    layers = {
        "structure": of(D01=text(E.D01), D04=of(core=text(E.D04_CORE), intensity=number(1, 10), polarity=text(E.POLARITY)), D05=number(1, 5), D07=of(type=text(E.D07)), D10={"enum": [*E.D10, None]}, D11={"type": "array", "items": text(E.D11), "minItems": 1}),
        "emotion": of(primary=feeling),
    }
    return of(layers=of(**{layer: layers[layer]}))


def filled_spans(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items (.., txt, text, start, end) with spans that lack or are wrong found by exact or white-space match, and the report of what changed."""
    from fabulon.functions.similarity import locate

    right = F.substring(F.col("txt"), F.col("start") + 1, F.col("end") - F.col("start")) == F.col("text")
    met = items.withColumn("_ok", F.coalesce(right, F.lit(False))).withColumn("_at", locate("txt", "text"))
    usable = F.col("_at.level").isin("exact", "whitespace_normalized")
    change = ~F.col("_ok") & usable
    out = met.withColumns({"start": F.when(change, F.col("_at.start")).otherwise(F.col("start")), "end": F.when(change, F.col("_at.end")).otherwise(F.col("end")), "filled": change})
    return out.drop("_ok", "_at"), out.groupBy(F.col("_at.level").alias("level"), "filled").agg(F.count(F.lit(1)).alias("n"))
