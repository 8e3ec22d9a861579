"""Reports of many documents: composed in expressions, one file for each, written by the tasks that hold them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .writers import SECTIONS
from .writers import sections as frequencies

WIDTH, HEIGHT = 600, 120
#: Curves of a report: title, column, and the numbers of a column of words.
CURVES = [("Mood", "inten", None), ("Pace", "pace", None), ("Polarity", "pol", {"positive": 1, "negative": -1})]
FILES = {"html": "html", "markdown": "md"}


def escaped(c: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(mark), F.lit(name))
    return c


def cell(c: Column) -> Column:
    """Text of one cell of a Markdown table."""
    return F.regexp_replace(F.replace(c, F.lit("|"), F.lit("/")), r"\s+", " ")


def points(values: Column) -> Column:
    """The points of a line through an array of numbers, as the attribute of an SVG polyline; null numbers are passed over."""
    n = F.greatest(F.size(values) - 1, F.lit(1))
    low, high = F.array_min(values), F.array_max(values)
    span = F.when(high > low, high - low).otherwise(1)
    at = F.transform(values, lambda v, i: F.when(v.isNotNull(), F.concat(F.format_string("%.1f", (i * WIDTH / n).cast("double")), F.lit(","), F.format_string("%.1f", (HEIGHT - (v - low) / span * HEIGHT).cast("double")))))
    return F.array_join(F.array_compact(at), " ")


def _gathered(rows: DataFrame, extra: DataFrame | None) -> DataFrame:
    """One row for each document: n, s (sections: name, values with counts), c (each curve's numbers in order), d (details in order)."""
    number = lambda column, words: F.col(column).cast("double") if words is None else F.coalesce(F.create_map(*(F.lit(x) for pair in words.items() for x in pair))[F.col(column)], F.lit(0)).cast("double")
    line = F.array_sort(F.collect_list(F.struct("idx", *(number(c, words).alias(f"c{i}") for i, (_, c, words) in enumerate(CURVES)), *(F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in ("d01", "emo", "inten", "loc")))))
    base = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), line.alias("l"))
    parts = frequencies(rows).select("doc_id", F.lit(0).alias("part"), "section", F.col("rank"), "value", F.col("n").cast("string").alias("note"))
    if extra is not None:
        parts = parts.unionByName(extra.select("doc_id", F.lit(1).alias("part"), "section", F.col("rank").cast("long").alias("rank"), F.col("name").alias("value"), F.col("value").cast("string").alias("note")))
    place = {name: i for i, name in enumerate(SECTIONS)}
    order = F.coalesce(F.create_map(*(F.lit(x) for pair in place.items() for x in pair))[F.col("section")], F.lit(len(place)))
    one = parts.groupBy("doc_id", "part", "section").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "note"))).alias("v"))
    listed = one.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("part", order.alias("place"), "section", "v"))).alias("s"))
    return base.join(listed, "doc_id", "left")


def composed(rows: DataFrame, extra: DataFrame | None = None, style: str = "html") -> DataFrame:
    """(doc_id, report): the report of each document of the segments rows (doc_id, idx and the columns of SECTIONS and CURVES).

    It has the number of segments, the curves, a table of the ten most frequent values for each section, one for each further section of extra (doc_id, section, rank,
    name, value), and a line for each segment. A report is as long as its document has segments.
    """
    if style not in FILES:
        raise ValueError(f"unknown style {style}")
    all_ = _gathered(rows, extra).withColumn("s", F.coalesce("s", F.array().cast("array<struct<part:int,place:int,section:string,v:array<struct<rank:bigint,value:string,note:string>>>>")))
    join = lambda c: F.array_join(c, "")
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    title = text("Document ", F.col("doc_id"))
    if style == "markdown":
        tables = F.transform("s", lambda s: text("\n## ", s["section"], "\n\n| value | n |\n|-|-|\n", join(F.transform(s["v"], lambda v: text("| ", cell(v["value"]), " | ", cell(v["note"]), " |\n")))))
        lines = F.transform("l", lambda x: text("- ", x["idx"], ": ", x["d01"], ", ", x["emo"], " ", x["inten"], ", ", x["loc"], "\n"))
        return all_.select("doc_id", text("# ", title, "\n\n", F.col("n"), " segments\n", join(tables), "\n## segments\n\n", join(lines)).alias("report"))
    drawn = [text(f"<h2>{name}</h2><svg viewBox=\"0 0 {WIDTH} {HEIGHT}\"><polyline fill=\"none\" stroke=\"currentColor\" points=\"", points(F.col(f"l.c{i}")), "\"/></svg>") for i, (name, _, _) in enumerate(CURVES)]
    tables = F.transform("s", lambda s: text("<h2>", escaped(s["section"]), "</h2><table>", join(F.transform(s["v"], lambda v: text("<tr><td>", escaped(v["value"]), "</td><td>", escaped(v["note"]), "</td></tr>"))), "</table>"))
    lines = F.transform("l", lambda x: text("<li>", x["idx"], ": ", escaped(x["d01"]), ", ", escaped(x["emo"]), " ", x["inten"], ", ", escaped(x["loc"]), "</li>"))
    return all_.select("doc_id", text("<html><head><meta charset=\"utf-8\"><title>", title, "</title></head><body><h1>", title, "</h1><p>", F.col("n"), " segments</p>", *drawn, join(tables), "<h2>segments</h2><ol>", join(lines), "</ol></body></html>").alias("report"))


def write(reports: DataFrame, folder: str, style: str = "html", prefix: str = "document") -> DataFrame:
    """Write each report (doc_id, report) to a file `prefix-doc_id` of its own in a folder that all executors reach, and return a reader of the index (doc_id, file, bytes), which is written last.

    A file is written under another name and then renamed, so that it is whole or not there, and a task that runs again writes the same file. Only the names pass through the plan.
    """
    root = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = root.startswith("file:") or "://" not in root
        store, base = (pafs.LocalFileSystem(), unquote(urlparse(root).path)) if local else pafs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        for batch in batches:
            names, sizes = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw, name = (text or "").encode(), f"{prefix}-{doc}.{FILES[style]}"
                part = f"{base}/.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(raw)
                store.move(part, f"{base}/{name}")
                names.append(name)
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["doc_id", "file", "bytes"])

    index = reports.select(F.col("doc_id").cast("long").alias("doc_id"), "report").mapInArrow(run, "doc_id long, file string, bytes long")
    index.write.mode("overwrite").parquet(f"{root}/_index")
    return reports.sparkSession.read.parquet(f"{root}/_index")
