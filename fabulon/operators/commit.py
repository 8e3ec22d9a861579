"""Annotations on their way into the tables: whole rows are judged, repaired in rounds and kept, layer by layer, so that a run that stops goes on where it was.

A craft row has doc_id, idx, segment (its text), schema_version, items (array of struct dim, kind, text, start, end, score) and voices (array of struct who, pattern).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabulon.functions import enums as E
from fabulon.functions.similarity import fuzzy_span, ratio
from fabulon.functions.text import squash
from fabulon.sources.versions import Table

from .validate import Rule, checked

KEY = ["doc_id", "idx"]
ITEM = "struct<dim:string,kind:string,text:string,start:bigint,end:bigint,score:int>"
ITEMS = f"array<{ITEM}>"
FIELDS = ["dim", "kind", "text", "start", "end", "score"]
TEXTS = FIELDS[:3]
# fixed values: versions of rows that are taken, the similarities of a quote and its span below which it is wrong or doubtful, and the rounds
VERSIONS = ("2.5.0", "2.6.0", "2.7.0", "2.8.0", "2.9.0", "2.10.0")
WRONG, DOUBTFUL, ROUNDS = 0.85, 0.95, 3
#: Rules about where a quote stands: only these are worth a repair.
PLACED = ("not in text", "span", "bounds", "drift")
KINDS = {"D14": E.RHETORIC, "D15": E.IMAGERY, "D16": E.DICTION, "D17": E.SYNTAX}


def version_rules(versions: tuple[str, ...] = VERSIONS) -> list[Rule]:
    return [("schema_version", "error", ~F.coalesce(F.col("schema_version").isin(*versions), F.lit(False)))]


def _slice(x: Column) -> Column:
    return F.substring(F.col("segment"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))


def _likeness() -> Column:
    """For each item how like its text the span's part of the segment is, white space aside; null where that is plain: equal, or without a whole span."""
    inside = lambda x: F.coalesce((x["start"] >= 0) & (x["start"] < x["end"]) & (x["end"] <= F.length("segment")), F.lit(False))
    off = F.exists("items", lambda x: inside(x) & F.coalesce(_slice(x) != x["text"], F.lit(False)))
    parts = F.transform("items", lambda x: F.when(inside(x) & (_slice(x) != x["text"]), F.struct(_slice(x).alias("a"), x["text"].alias("b"))))

    def run(found: pd.Series) -> pd.Series:
        flat = lambda t: " ".join((t or "").split())
        return found.map(lambda pairs: None if pairs is None else [None if p is None else ratio(flat(p["a"]), flat(p["b"])) for p in pairs])

    run.__annotations__ = {"found": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<double>")(F.when(off, parts))  # rows without a drifting item go by as nulls


def judged(rows: DataFrame, versions: tuple[str, ...] = VERSIONS) -> DataFrame:
    """rows with errors and warnings (`D15[0] bounds`: dimension, number of the item in the row, rule) and is_valid.

    An item needs a text that the segment holds (white space aside); a span, if it has one, with both ends inside the segment, of which .85 is like the text (a warning
    below .95); a legal kind for D14 to D17 and a score of 1 to 5 or none for D13. A voice needs a pattern; one that the segment lacks is a warning. The first rule about the text and
    its place that is broken is named, and the kind besides. Null items and voices count as none.
    """
    rows = rows.withColumns({"items": F.coalesce("items", F.array().cast(ITEMS)), "voices": F.coalesce("voices", F.array().cast("array<struct<who:string,pattern:string>>")), "segment": F.coalesce("segment", F.lit(""))})
    rows = rows.withColumn("_like", _likeness()).withColumn("_flat", squash(F.col("segment")))
    held = lambda quote: F.contains(F.col("_flat"), squash(quote))

    def place(x: Column, like: Column) -> Column:
        start, end = x["start"], x["end"]
        return (
            F.when(F.coalesce(x["text"], F.lit("")) == "", "text").when(~held(x["text"]), "not in text").when(start.isNull() & end.isNull(), F.lit(None)).when(start.isNull() | end.isNull(), "span")
            .when((start < 0) | (start >= end) | (end > F.length("segment")), "bounds").when(like < WRONG, "drift").when(like < DOUBTFUL, "doubtful")
        )

    def illegal(x: Column) -> Column:
        kinds = F.create_map(*(y for dim, legal in KINDS.items() for y in (F.lit(dim), F.array(*map(F.lit, legal)))))
        kind = F.when(x["dim"].isin(*KINDS) & ~F.coalesce(F.array_contains(kinds[x["dim"]], x["kind"]), F.lit(False)), "kind")
        return F.when((x["dim"] == "D13") & ~x["score"].between(1, 5), "score").otherwise(kind)

    like = lambda i: F.coalesce(F.get(F.col("_like"), i), F.lit(1.0))
    found = F.transform("items", lambda x, i: F.struct(F.concat(F.coalesce(x["dim"], F.lit("?")), F.lit("["), i.cast("string"), F.lit("] ")).alias("at"), place(x, like(i)).alias("place"), illegal(x).alias("kind")))
    said = F.transform("voices", lambda v: F.when(F.coalesce(v["pattern"], F.lit("")) == "", "pattern").when(~held(v["pattern"]), "elsewhere"))
    rows = rows.withColumns({"_items": found, "_voices": said})
    wrong = F.flatten(F.transform("_items", lambda x: F.array(F.when(x["place"] != "doubtful", F.concat(x["at"], x["place"])), F.concat(x["at"], x["kind"]))))
    doubts = F.transform("_items", lambda x: F.when(x["place"] == "doubtful", F.concat(x["at"], F.lit("drift"))))
    voice = lambda word: F.transform("_voices", lambda w, i: F.when(w == word, F.concat(F.lit("D18["), i.cast("string"), F.lit("] "), w)))
    version = F.array(*(F.when(broken, rule) for rule, _, broken in version_rules(versions)))
    out = rows.withColumns({"errors": F.array_compact(F.concat(version, wrong, voice("pattern"))), "warnings": F.array_compact(F.concat(doubts, voice("elsewhere")))})
    return out.withColumn("is_valid", F.size("errors") == 0).drop("_like", "_flat", "_items", "_voices")


def mended(segment: str, items: list[dict]) -> tuple[list[dict], int, list[str], list[str]]:
    """Items with spans that lack or drift found again: (items, how many changed, those that are nowhere, notes on quotes that were found by likeness)."""
    changed, lost, notes = 0, [], []
    out = []
    for i, x in enumerate(items):
        text = (x["text"] or "").strip()
        start, end = x["start"], x["end"]
        known = start is not None and end is not None and 0 <= start < end <= len(segment)
        if not text or (known and ratio(segment[start:end], text) >= DOUBTFUL):
            out.append(x)
            continue
        found = fuzzy_span(segment, text)
        if found is None:
            out.append(x)
            if start is None and end is None:
                lost.append(f"{x['dim']}[{i}] {text[:36]}")
            continue
        start, end, level, score = found
        out.append({**x, "start": start, "end": end, "text": segment[start:end]})
        changed += 1
        if level != "exact":
            notes.append(f"{x['dim']}[{i}] {level} {score:.4f}")
    return out, changed, lost, notes


def _repair(wanted: Column) -> Column:
    """mended where it is wanted, else null."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for segment, items in zip(rows["segment"], rows["items"], strict=True):
            if items is None:
                out.append((None, None, None, None))
            else:
                out.append(mended(segment, [{f: None if pd.isna(x[f]) else x[f] if f in TEXTS else int(x[f]) for f in FIELDS} for x in items]))
        return pd.DataFrame({"items": [r[0] for r in out], "changed": pd.array([r[1] for r in out], dtype="Int64"), "lost": [r[2] for r in out], "notes": [r[3] for r in out]})

    run.__annotations__ = {"rows": pd.DataFrame, "return": pd.DataFrame}
    packed = F.struct(F.when(wanted, F.col("segment")).alias("segment"), F.when(wanted, F.col("items")).alias("items"))
    return F.pandas_udf(run, f"items {ITEMS}, changed long, lost array<string>, notes array<string>")(packed)


def committed(rows: DataFrame, versions: tuple[str, ...] = VERSIONS) -> DataFrame:
    """Craft rows judged, repaired where a rule about the place of a quote is broken, and judged again.

    Adds errors, warnings, is_valid, rounds (how often a row was judged), repaired (items changed), lost and notes. The search is asked only for rows that fail by such a rule: the others pass
    by as nulls. A repaired item is its span's own text, which a later repair leaves alone, and what the search did not find it does not find again: so a row is the same after two rounds
    as after ROUNDS or any other number.
    """
    none = F.array().cast("array<string>")
    out = judged(rows, versions)
    placed = F.exists("errors", lambda e: F.substring_index(e, "] ", -1).isin(*PLACED))
    out = out.withColumn("_r", _repair(placed)).drop("errors", "warnings", "is_valid")
    changed = F.coalesce(F.col("_r.changed"), F.lit(0)).cast("long")
    out = out.withColumns({"items": F.coalesce("_r.items", "items"), "lost": F.coalesce("_r.lost", none), "notes": F.coalesce("_r.notes", none), "repaired": changed, "rounds": F.when(changed > 0, 2).otherwise(1).cast("long")}).drop("_r")
    return judged(out, versions)


def ruled(rules: Callable[[], list[Rule]], versions: tuple[str, ...] = VERSIONS) -> Callable[[DataFrame], DataFrame]:
    """A judge for layers that no repair helps: version and rules, once."""
    none = F.array().cast("array<string>")
    return lambda rows: checked(rows, version_rules(versions) + rules()).withColumns({"rounds": F.lit(1).cast("long"), "repaired": F.lit(0).cast("long"), "lost": none, "notes": none})


def messages(layer: str, rows: DataFrame) -> DataFrame:
    """(doc_id, idx, layer, kind, message): what was said of the rows of a layer, one row each: errors, warnings, quotes that are nowhere and notes of repairs."""
    kinds = {"errors": "error", "warnings": "warning", "lost": "unmatched", "notes": "repair"}
    # one pass: a union of the kinds would judge and repair each row once for each of them
    said = lambda c, k: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda m: F.struct(F.lit(k).alias("kind"), m.alias("message")))
    return rows.select(*KEY, F.lit(layer).alias("layer"), F.explode(F.concat(*(said(c, k) for c, k in kinds.items()))).alias("_x")).select(*KEY, "layer", "_x.kind", "_x.message")


def run(spark: SparkSession, root: str, incoming: dict[str, DataFrame], judges: dict[str, Callable[[DataFrame], DataFrame]], before: Callable[[str], None] = lambda layer: None) -> dict[str, dict[str, int]]:
    """Take the rows of each layer (doc_id, idx, ..) into the table at root; how many there were to do, were kept and were not, by layer.

    A layer's rows that the table has are done and left alone. Valid rows are kept with the outcome of their rounds, all messages go to `messages`, and rows that failed are named in `failed`;
    a layer's rows, messages and failures come into the table in one change, so that a run that stops at any point has whole layers, and the next one goes on with what is missing. Of several rows
    for one segment the last by arrival stands, if there is such a column. `before` is called ahead of each layer.
    """
    from .joins import last_wins

    table = Table(spark, root)
    out = {}
    for layer, rows in incoming.items():
        before(layer)
        done = table.read(layer)
        rows = last_wins(rows, "arrival") if "arrival" in rows.columns else rows
        todo = rows if done is None else rows.join(done.select(*KEY), KEY, "left_anti")
        part = table.stage(judges[layer](todo))
        found = spark.read.parquet(f"{table.root}/{part}")
        n, good = found.agg(F.count(F.lit(1)), F.count_if("is_valid")).first()
        out[layer] = {"todo": n, "kept": good, "failed": n - good}
        if n:
            kept = found.filter("is_valid").drop("errors", "warnings", "is_valid")
            bad = found.filter("not is_valid").select(*KEY, F.lit(layer).alias("layer"), F.array_join("errors", ";").alias("errors"))
            table.append(**{layer: kept, "messages": messages(layer, found), "failed": bad})
    return out
