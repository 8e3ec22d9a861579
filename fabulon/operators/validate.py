"""Row validators: rules (id, severity, predicate) give arrays of errors and warnings; layers as typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabulon.functions import enums as E
from fabulon.functions.text import holds, quoted

# fixed values: keys that a merged row must have
MERGED = ("segment_id", "chapter", "section_type", "text_span")

Rule = tuple[str, str, Column]


def checked(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """rows with errors, warnings (ids of the rules that are broken) and is_valid."""
    broken = lambda kind: F.array_compact(F.array(*(F.when(F.coalesce(p, F.lit(True)), F.lit(i)) for i, k, p in rules if k == kind), F.lit(None).cast("string")))
    return rows.withColumns({"errors": broken("error"), "warnings": broken("warning")}).withColumn("is_valid", F.size("errors") == 0)


def outside(column: str, legal: list[str], nullable: bool = False) -> Column:
    bad = ~F.col(column).isin(*legal)
    return F.coalesce(bad, F.lit(False)) if nullable else F.coalesce(bad, F.lit(True))


def envelope_rules(raw: str = "raw") -> list[Rule]:
    """Root keys that must be there, null or not, in a row kept as JSON text."""
    keys = ["schema_version", "annotation_id", "document_id", "segment_id", "chapter", "section_type", "text_span", "layers", "confidence", "null_reasons", "alternatives", "status"]
    return [(f"missing {k}", "error", ~F.array_contains(F.json_object_keys(raw), k)) for k in keys]


def type_rules(raw: str = "raw") -> list[Rule]:
    """Reasons for nulls are an object and alternatives an array, where they are there and not null."""
    begins = lambda key, mark: F.coalesce(~F.startswith(F.get_json_object(raw, f"$.{key}"), F.lit(mark)), F.lit(False))
    return [("null_reasons", "error", begins("null_reasons", "{")), ("alternatives", "error", begins("alternatives", "["))]


def merged_rules(raw: str = "raw") -> list[Rule]:
    """Keys of a merged row."""
    return [(f"missing {k}", "error", F.coalesce(~F.array_contains(F.json_object_keys(raw), k), F.lit(True))) for k in MERGED]


def span_rules() -> list[Rule]:
    return [("span order", "error", F.col("start_char") > F.col("end_char")), ("span length", "error", F.length("txt") != F.col("end_char") - F.col("start_char"))]


def structure_rules(version: str | None = None) -> list[Rule]:
    legacy = E.D04_CORE + E.D04_LEGACY if version in {"2.5.0", "2.6.0", "2.7.0", "2.8.0"} else E.D04_CORE
    return [
        ("D01", "error", outside("d01", E.D01)), ("D04.core", "error", outside("mood", legacy)), ("D04.intensity", "error", ~F.col("inten").between(1, 10)),
        ("D04.polarity", "error", outside("pol", E.POLARITY, nullable=version != "2.6.0")), ("D05", "error", ~F.col("pace").between(1, 5)), ("D07", "error", outside("persp", E.D07)), ("D10", "error", outside("d10", E.D10, nullable=True)),
    ]


def confidence_rules() -> list[Rule]:
    live = F.col("status") != "superseded"
    return [
        ("overall", "error", ~F.col("overall").between(0, 1)), ("status", "error", outside("status", E.STATUS)),
        ("confirmed below 0.8", "error", live & (F.col("overall") < 0.8) & (F.col("status") == "confirmed")),
        ("tentative at 0.8", "warning", live & (F.col("overall") >= 0.8) & (F.col("status") != "confirmed")),
    ]


# fixed values: dimensions of each layer's confidence, and whether they must be numbers
DIMENSIONS = {"structure": (["D01", "D04", "D05", "D07", "D08", "D10", "D11"], True), "interpretation": (["D06", "D09"], False), "craft": (["D13", "D14", "D15", "D16", "D17", "D18"], False), "emotion": (["D19"], True)}


def dimension_rules(layer: str) -> list[Rule]:
    """The confidence's method, and its numbers (a map per_dimension) for the dimensions of a layer."""
    names, needed = DIMENSIONS[layer]
    value = lambda d: F.get(F.array(F.col("per_dimension")[d]), F.lit(0))
    bad = lambda d: F.coalesce(~value(d).between(0, 1) | F.isnan(value(d)), F.lit(needed))
    return [("confidence_method", "error", outside("confidence_method", E.CONFIDENCE_METHODS)), *((f"per_dimension.{d}", "error", bad(d)) for d in names)]


def _null_or(condition: Column, of: Column) -> Column:
    """Broken only where `of` is there."""
    return F.coalesce(of.isNotNull() & ~F.coalesce(condition, F.lit(False)), F.lit(False))


def structure_detail_rules() -> list[Rule]:
    """D07.is_switch_point, D08 (a struct), D11 (an array), D12 (a struct or null) and the section."""
    d12 = F.col("d12")
    return [
        ("D07.is_switch_point", "error", F.col("is_switch_point").isNull()), ("D08", "error", F.col("d08").isNull()),
        ("D08._time_type", "error", _null_or(F.col("d08.time_type").isin(*E.D08_TIME_TYPES), F.col("d08.time_type"))), ("D08._narrative_level", "error", _null_or(F.col("d08.narrative_level").isin(*E.D08_LEVELS), F.col("d08.narrative_level"))),
        ("D11", "error", F.coalesce(F.size("d11") < 1, F.lit(True)) | F.col("d11").isNull()), ("D11 value", "error", F.coalesce(F.exists("d11", lambda x: ~F.coalesce(x.isin(*E.D11), F.lit(False))), F.lit(False))),
        ("D12.mode", "error", _null_or(F.col("d12.mode").isin(*E.D12), d12)), ("D12.density", "error", _null_or(F.col("d12.density").between(0, 1), F.col("d12.density"))),
        ("D12.is_summary", "error", _null_or(F.col("d12.is_summary").isNotNull(), d12)), ("D12.is_scene", "error", _null_or(F.col("d12.is_scene").isNotNull(), d12)), ("section_type", "error", outside("section_type", E.SECTIONS)),
    ]


def interpretation_rules() -> list[Rule]:
    return [("D06", "error", outside("d06", E.D06, nullable=True)), ("D09", "error", F.size("themes") > 3), ("D09 repeated", "warning", F.size(F.array_distinct("themes")) < F.size("themes"))]


def interpretation_detail_rules() -> list[Rule]:
    """Quotes in D06's content stand in the segment (white space aside), techniques and the narrator's reliability are legal."""
    quotes = F.filter(quoted(F.coalesce(F.col("content"), F.lit(""))), lambda q: q != "")
    absent = F.exists(quotes, lambda q: ~holds(F.col("txt"), q))
    return [
        ("D06 quote", "error", F.coalesce(absent, F.lit(False))), ("D06._techniques", "error", F.coalesce(F.exists("techniques", lambda x: ~F.coalesce(x.isin(*E.D06_TECHNIQUES), F.lit(False))), F.lit(False))),
        ("narrator_reliability", "error", _null_or(F.col("reliability").isin(*E.RELIABILITY), F.col("reliability"))),
    ]


def emotion_rules() -> list[Rule]:
    return [("emotion", "error", outside("emo", E.EMOTIONS)), ("emotion.intensity", "error", ~F.col("emo_int").between(1, 10)), ("emotion.polarity", "error", outside("emo_pol", E.POLARITY)), ("target", "warning", F.col("emo_tgt").isNull())]


def _feeling(c: Column) -> Column:
    """Whether a struct (emotion, intensity, polarity) is legal."""
    return F.coalesce(c["emotion"].isin(*E.EMOTIONS) & c["intensity"].between(1, 10) & c["polarity"].isin(*E.POLARITY), F.lit(False))


def emotion_detail_rules() -> list[Rule]:
    """secondary (an array of feelings or null, two at most), target and trigger (structs or null), arc (a struct with a shift, or null) and expression (a
    struct whose key phrases stand in the segment)."""
    few = F.size("secondary") <= 2
    phrases = F.col("expression.key_phrases")
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    arc = F.col("arc")
    return [
        ("secondary empty", "error", F.coalesce(F.col("secondary").isNotNull() & (F.size("secondary") == 0), F.lit(False))), ("secondary many", "warning", F.coalesce(F.size("secondary") > 2, F.lit(False))),
        ("secondary", "error", F.coalesce(few & F.exists("secondary", lambda x: ~_feeling(x)), F.lit(False))), ("target.name", "error", F.col("target").isNotNull() & blank(F.col("target.name"))),
        ("trigger.description", "error", F.col("trigger").isNotNull() & blank(F.col("trigger.description"))), ("arc.has_shift", "error", arc.isNotNull() & ~F.coalesce(F.col("arc.has_shift"), F.lit(False))),
        ("arc.shift_point", "error", arc.isNotNull() & F.coalesce(F.col("arc.has_shift"), F.lit(False)) & blank(F.col("arc.shift_point"))),
        ("arc.before", "error", arc.isNotNull() & F.coalesce(F.col("arc.has_shift"), F.lit(False)) & ~_feeling(F.col("arc.before"))), ("arc.after", "error", arc.isNotNull() & F.coalesce(F.col("arc.has_shift"), F.lit(False)) & ~_feeling(F.col("arc.after"))),
        ("expression", "error", F.col("expression").isNull() | F.col("expression.direct").isNull() | F.col("expression.indirect").isNull()),
        ("key_phrases", "error", F.coalesce(F.size(phrases) < 1, F.lit(True)) | phrases.isNull()), ("key_phrases not in text", "error", F.coalesce(F.exists(phrases, lambda p: ~blank(p) & ~holds(F.col("txt"), p)), F.lit(False))),
    ]


def relation_rules() -> list[Rule]:
    return [("relation", "error", outside("rel", E.RELATIONS)), ("backwards", "error", F.col("tgt") < F.col("src")), ("confidence", "error", ~F.col("conf").between(0, 1))]


# fixed values: keys that a relation and a file of relations must have
REFERENCE, REFERENCES = ("ref_id", "relation_type", "source", "target"), ("schema_version", "doc_id", "cross_refs")


def reference_rules(ref: str = "ref") -> list[Rule]:
    """For a relation as JSON text: its keys, its type, and at either end, where that is an object, the segment and (a warning) the text it is anchored to."""
    at = lambda p: F.get_json_object(ref, f"$.{p}")
    keys = lambda of: F.coalesce(F.json_object_keys(of), F.array().cast("array<string>"))
    node = lambda end: F.when(F.array_contains(keys(ref), end), at(end)).otherwise("{}")
    is_object = lambda end: F.coalesce(F.startswith(node(end), F.lit("{")), F.lit(False))
    anchor = lambda end: F.coalesce(F.get_json_object(node(end), "$.anchor_text"), F.lit(""))
    return [
        *((f"missing {k}", "error", ~F.array_contains(keys(ref), k)) for k in REFERENCE), ("relation_type", "error", ~F.coalesce(at("relation_type").isin(*E.RELATIONS), F.lit(False))),
        *((f"{end}.segment_id", "error", is_object(end) & ~F.array_contains(keys(node(end)), "segment_id")) for end in ("source", "target")), *((f"{end}.anchor_text", "warning", is_object(end) & (anchor(end) == "")) for end in ("source", "target")),
    ]


def references_rules(raw: str = "raw") -> list[Rule]:
    """For a file of relations as JSON text: its keys, and that its relations are an array."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    refs = F.get_json_object(raw, "$.cross_refs")
    return [*((f"missing {k}", "error", ~F.array_contains(keys, k)) for k in REFERENCES), ("cross_refs", "error", F.array_contains(keys, "cross_refs") & ~F.coalesce(F.startswith(refs, F.lit("[")), F.lit(False)))]


def craft_rules() -> list[Rule]:
    """For exploded craft items (dim, kind, text, start, end, segment text)."""
    legal = {"D14": E.RHETORIC, "D15": E.IMAGERY, "D16": E.DICTION, "D17": E.SYNTAX}
    kind = F.lit(False)
    for dim, values in legal.items():
        kind = F.when(F.col("dim") == dim, ~F.col("kind").isin(*values)).otherwise(kind)
    return [("text", "error", F.trim("text") == ""), ("kind", "error", kind), ("bounds", "error", (F.col("start") < 0) | (F.col("end") > F.length("segment")) | (F.col("start") >= F.col("end"))), ("not in text", "error", ~F.contains("segment", "text"))]


def flat(rows: DataFrame) -> DataFrame:
    """(doc_id, idx, errors, warnings, is_valid) with the lists as text."""
    return rows.select("doc_id", "idx", F.array_join("errors", ";").alias("errors"), F.array_join("warnings", ";").alias("warnings"), "is_valid")


def quote_check(rows: DataFrame) -> DataFrame:
    """For quotes (txt, quote): exact, space (found when white space is dropped) or missing."""
    from fabulon.functions.text import without_space

    return rows.withColumn("found", F.when(F.contains("txt", "quote"), "exact").when(F.contains(without_space(F.col("txt")), without_space(F.col("quote"))), "space").otherwise("missing"))


def totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("n_valid"), F.sum(F.size("errors")).alias("n_errors"))


def trigger(rows: DataFrame) -> DataFrame:
    """Whether a segment is to get the emotion layer, and why."""
    reasons = F.array_compact(F.array(F.when(F.col("inten") >= 4, "intensity"), F.when(F.col("d01").isin("激励事件", "转折", "高潮", "结局"), "function"), F.when(F.col("d10").isNotNull(), "dialogue")))
    return rows.withColumn("reasons", F.array_join(reasons, ",")).withColumn("triggered", F.size(reasons) > 0)


def sampling_tier(rows: DataFrame, deep: tuple[str, ...] = ("激励事件", "转折", "高潮", "结局"), skip: tuple[str, ...] = ("过渡", "背景铺垫"), intensity: int = 6) -> DataFrame:
    why = F.array_compact(F.array(F.when(F.col("d01").isin(*deep), "function"), F.when(F.col("inten") >= intensity, "intensity"), F.when(F.col("sw") == 0, "switch")))
    return rows.withColumn("tier", F.when(F.size(why) > 0, "deep").when(F.col("d01").isin(*skip), "skip").otherwise("light")).withColumn("reasons", F.array_join(why, ","))


def person_targets(names: DataFrame, speakers: list[str], nouns: list[str], particles: str = "的之着了") -> DataFrame:
    """Names that are a known speaker, or short and neither hold a particle nor an abstract noun."""
    bad = F.exists(F.array(*(F.lit(n) for n in nouns)), lambda n: F.contains(F.col("name"), n))
    return names.filter(F.col("name").isin(*speakers) | ((F.length("name") <= 6) & ~F.col("name").rlike(f"[{particles}]") & ~bad))


def enum_differences(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """Values (kind, value) that only one side has."""
    return mine.exceptAll(theirs).withColumn("side", F.lit("left")).unionByName(theirs.exceptAll(mine).withColumn("side", F.lit("right")))
