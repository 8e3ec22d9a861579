"""Sinks: JSON lines, nested products, progress tables and reports."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAYERS = ("structure", "interpretation", "emotion", "craft")
# fixed values: what has to be done again when a layer is reset
CASCADE = {"structure": ("relations", "merge", "report"), "interpretation": ("merge", "report"), "emotion": ("merge", "report"), "craft": ("merge", "report")}

# sections of the report and the column of each
SECTIONS = {"functions": "d01", "perspectives": "persp", "information": "d06", "dialogue": "d10", "emotions": "emo", "polarity": "emo_pol", "targets": "emo_tgt", "imagery": "itype", "themes": "t1", "places": "loc", "seasons": "season"}


def json_lines(rows: DataFrame, path: str) -> None:
    """Spark's commit protocol makes the write atomic by task and job."""
    rows.write.mode("overwrite").json(path)


def documents(rows: DataFrame, path: str, column: str = "graph") -> None:
    """One JSON document a line."""
    rows.select(column).write.mode("overwrite").text(path)


def progress_table(segments: DataFrame) -> DataFrame:
    """All (doc_id, idx, layer), none done."""
    return segments.select("doc_id", "idx", F.explode(F.array(*map(F.lit, LAYERS))).alias("layer")).withColumn("done", F.lit(False))


def marked(progress: DataFrame, done: DataFrame) -> DataFrame:
    """progress with the rows of done (doc_id, idx, layer) set."""
    keys = ["doc_id", "idx", "layer"]
    return progress.join(done.select(*keys).distinct().withColumn("_now", F.lit(True)), keys, "left").select(*keys, (F.col("done") | F.coalesce("_now", F.lit(False))).alias("done"))


def reset(progress: DataFrame, layer: str) -> tuple[DataFrame, tuple[str, ...]]:
    """progress with a layer undone, and the phases that must run again."""
    return progress.withColumn("done", F.col("done") & (F.col("layer") != layer)), CASCADE[layer]


def sampling_plan(tiers: DataFrame) -> DataFrame:
    """Sorted segment numbers by document and tier."""
    return tiers.groupBy("doc_id", "tier").agg(F.sort_array(F.collect_list("idx")).alias("segments"))


def curve(values: list[float], width: int = 600, height: int = 120) -> str:
    """An SVG line through the values."""
    if not values:
        return ""
    low, high = min(values), max(values)
    points = " ".join(f"{i * width / max(1, len(values) - 1):.1f},{height - (v - low) / ((high - low) or 1) * height:.1f}" for i, v in enumerate(values))
    return f'<svg viewBox="0 0 {width} {height}"><polyline fill="none" stroke="currentColor" points="{points}"/></svg>'


def sections(rows: DataFrame, most: int = 10) -> DataFrame:
    """The `most` frequent values (ties: first met) of each section of the report by document; one pass and one aggregate for all sections."""
    one = F.array(*(F.struct(F.lit(name).alias("section"), F.col(column).cast("string").alias("value")) for name, column in SECTIONS.items()))
    n = rows.select("doc_id", "idx", F.explode(one).alias("s")).filter("s.value is not null").groupBy("doc_id", F.col("s.section").alias("section"), F.col("s.value").alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("first"))
    by = Window.partitionBy("doc_id", "section").orderBy(F.desc("n"), "first", "value")
    return n.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= most).select("doc_id", "section", "rank", "value", "n")


def report(rows: DataFrame, doc_id: int, style: str = "html") -> str:
    """Report of one document: three curves (mood, pace, polarity) and a table for each section that rows have columns for.

    What is collected is the curves of that one document and ten values a section.
    """
    own = rows.filter(F.col("doc_id") == doc_id)
    line = own.select("idx", "inten", "pace", "pol").orderBy("idx").collect()
    known = {name: column for name, column in SECTIONS.items() if column in rows.columns}
    wide = own.select("doc_id", "idx", *known.values(), *(F.lit(None).cast("string").alias(c) for c in SECTIONS.values() if c not in rows.columns))
    found = sections(wide).orderBy("section", "rank").collect()
    tables = {name: [(r["value"], r["n"]) for r in found if r["section"] == name] for name in known}
    if style == "markdown":
        out = [f"# Document {doc_id}", "", f"{len(line)} segments", ""]
        for name, values in tables.items():
            out += [f"## {name}", "", "| value | n |", "|-|-|", *(f"| {v.replace('|', '/')} | {n} |" for v, n in values), ""]
        return "\n".join(out)
    polarity = {"positive": 1, "negative": -1}
    curves = [("Intensity", [r["inten"] for r in line]), ("Pace", [r["pace"] for r in line]), ("Polarity", [polarity.get(r["pol"], 0) for r in line])]
    drawn = "".join(f"<h2>{n}</h2>{curve(v)}" for n, v in curves)
    body = "".join(f"<h2>{html.escape(name)}</h2><table>{''.join(f'<tr><td>{html.escape(v)}</td><td>{n}</td></tr>' for v, n in values)}</table>" for name, values in tables.items())
    return f"<html><body><h1>Document {doc_id}</h1><p>{len(line)} segments</p>{drawn}{body}</body></html>"
