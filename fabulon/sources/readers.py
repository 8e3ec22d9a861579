"""Readers: texts in several encodings, JSON lines, JSON documents, TSV, enum tables in Markdown, lexicons, and model clients."""

from __future__ import annotations

import json
import re
import subprocess
import time
import urllib.request
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENCODINGS = ("utf-8-sig", "gbk", "gb18030")


def decode(raw: bytes, replace: bool = False) -> str:
    """The text in the first encoding that fits, line ends as \\n."""
    for name in ENCODINGS:
        try:
            return raw.decode(name).replace("\r\n", "\n").replace("\r", "\n")
        except UnicodeDecodeError:
            continue
    if not replace:
        raise ValueError("no known encoding")
    return raw.decode("utf-8", "replace")


def texts(spark: SparkSession, path: str, *, replace: bool = False) -> DataFrame:
    """(path, text) of the files of a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(x, replace) for x in b.column(1).to_pylist()], pa.string())], ["path", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, text string")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, *, strict: bool = False) -> DataFrame:
    """Rows of JSON lines; malformed lines fail (strict) or are left out."""
    if strict:
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    return spark.read.schema(wide).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad").filter("_bad is null").drop("_bad")


def json_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON files as wholes: objects or arrays; nothing if no file is there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=True, mode="DROPMALFORMED")


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """(raw) JSON text of each annotation of files that hold an object, an array, or JSON lines."""

    def parse(text: str) -> list[str]:
        try:
            found = json.loads(text)
            return [json.dumps(x, ensure_ascii=False) for x in (found if isinstance(found, list) else [found])]
        except ValueError:
            out = []
            for line in filter(str.strip, text.splitlines()):
                try:
                    out.append(json.dumps(json.loads(line), ensure_ascii=False))
                except ValueError:
                    continue
            return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([r for t in b.column(0).to_pylist() for r in parse(t)], pa.string())], ["raw"])

    return spark.read.text(path, wholetext=True).mapInArrow(run, "raw string")


def cross_refs(spark: SparkSession, path: str) -> DataFrame:
    """One row for each relation of all lines of relation files."""
    end = "struct<segment_id:string,chapter:string,anchor_text:string>"
    rows = json_lines(spark, path, f"document_id string, cross_refs array<struct<ref_id:string,relation_type:string,source:{end},target:{end},confidence:double,note:string>>")
    return rows.select("document_id", F.explode("cross_refs").alias("r")).select("document_id", "r.*")


def layer_paths(spark: SparkSession, folder: str, document: str, layers: list[str]) -> dict[str, str]:
    """The file of each layer of a document that is there: beside the segments first, else in the document's own folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = {}
    for layer in layers:
        for path in (f"{folder}/{document}_{layer}.jsonl", f"{folder}/{document}/{document}_{layer}.jsonl"):
            at = jvm.org.apache.hadoop.fs.Path(path)
            if layer not in found and at.getFileSystem(conf).exists(at):
                found[layer] = path
    return found


def batch_files(spark: SparkSession, path: str, pattern: str, schema: str) -> DataFrame:
    """Rows of the JSON-lines files of a pattern, with the name of each one's file."""
    return spark.read.schema(schema).option("pathGlobFilter", pattern).json(path).withColumn("file", F.col("_metadata.file_name"))


def tsv(spark: SparkSession, path: str, columns: int = 12) -> DataFrame:
    """Rows of a TSV file with at least `columns` columns, the header left out."""
    cells = F.split("value", "\t")
    return spark.read.text(path).select(cells.alias("cells")).filter((F.size("cells") >= columns) & (F.element_at("cells", 1) != "English Word"))


def lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, line, value): the lines of text files with what tells their order: the place at which a part of a file begins, and a number that rises within the part."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    return rows.withColumn("line", F.monotonically_increasing_id())


def joined_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): JSON lines as one text for each file, their texts in the order of the file with a blank line between.

    A line's text is that of its text span, else its text, else its content; empty ones, blank lines and lines that are no JSON are left out, and a file without texts has an empty
    one. Files are read in parts, by as many tasks as there are: the parts' places and the lines' numbers put them together again.
    """
    first = lambda *names: F.coalesce(*(F.nullif(F.get_json_object("value", f"$.{n}"), F.lit("")) for n in names))
    rows = lines_in_order(spark, path).withColumn("_t", F.when(F.try_parse_json("value").isNotNull(), first("text_span.text", "text", "content")))
    found = rows.groupBy("path").agg(F.array_sort(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct("block", "line", "_t")))).alias("l"))
    return found.select("path", F.array_join(F.transform("l", lambda x: x["_t"]), "\n\n").alias("text"))


def markdown_terms(spark: SparkSession, path: str, section: str | None = None) -> DataFrame:
    """(word) bold first cells of the rows of Markdown tables; with `section`, a pattern, only below a heading that it matches, up to the next heading of its level or above."""
    lines = lines_in_order(spark, path)
    level = F.length(F.regexp_extract("value", r"^(#{1,6})\s", 1))
    word = F.regexp_extract("value", r"^\|\s*\*\*([^*]+)\*\*\s*\|", 1).alias("word")
    if section is None:
        return lines.select(word).filter("word <> ''")
    # the last heading that opens the section, and whether one of its level or above has come since
    order = Window.partitionBy("path").orderBy("block", "line").rowsBetween(Window.unboundedPreceding, 0)
    opens = (level > 0) & F.col("value").rlike(section)
    marked = lines.withColumn("_opened", F.last(F.when(opens, F.struct(level.alias("level"), "block", "line")), ignorenulls=True).over(order)).withColumn("_level", level)
    inner = Window.partitionBy("path", "_opened").orderBy("block", "line").rowsBetween(Window.unboundedPreceding, 0)
    closes = (F.col("_level") > 0) & (F.col("_level") <= F.col("_opened.level")) & ~F.col("value").rlike(section)
    inside = marked.filter("_opened is not null").withColumn("_closed", F.max(closes.cast("int")).over(inner)).filter("_closed = 0")
    return inside.select(word).filter("word <> ''")


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(w, pos, cls, pol) of a JSON lexicon; empty if there is none."""
    return json_document(spark, path, "words array<struct<w:string,pos:string,cls:array<string>,int:int,pol:int>>").select(F.explode("words").alias("x")).select("x.w", "x.pos", "x.cls", "x.pol")


def xlsx_rows(path: str) -> list[list[str]]:
    """Cells of the first sheet of a workbook (driver side: lexicons are small)."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(path) as z:
        shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)] if "xl/sharedStrings.xml" in z.namelist() else []
        sheet = ET.fromstring(z.read("xl/worksheets/sheet1.xml"))
    value = lambda c: (shared[int(c.findtext("m:v", "0", ns))] if c.get("t") == "s" else c.findtext("m:v", "", ns))
    return [[value(c) for c in row.findall("m:c", ns)] for row in sheet.iter(f"{{{ns['m']}}}row")]


def constants(source: str, name: str) -> set[str]:
    """String constants of a named set or list in Python source, for consistency checks."""
    found = re.search(rf"^{name}\s*=\s*[\[{{](.*?)[\]}}]", source, re.MULTILINE | re.DOTALL)
    return set(re.findall(r"\"([^\"]*)\"", found[1])) if found else set()


Client = Callable[[str], str]


def mock_client(prompt: str) -> str:
    """A deterministic answer, for tests."""
    return json.dumps({"D01": "过渡", "length": len(prompt)}, ensure_ascii=False)


def command_client(command: list[str], seconds: int = 120) -> Client:
    """A process that reads a prompt and writes the answer; a non-zero exit is an error."""
    return lambda prompt: subprocess.run(command, input=prompt, capture_output=True, text=True, timeout=seconds, check=True).stdout


def http_client(url: str, model: str, key: str, retries: int = 3) -> Client:
    """A chat-completion endpoint, tried again after 1, 2, 4 ... seconds."""

    def ask(prompt: str) -> str:
        body = json.dumps({"model": model, "messages": [{"role": "user", "content": prompt}]}).encode()
        for i in range(retries):
            try:
                request = urllib.request.Request(url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
                with urllib.request.urlopen(request, timeout=120) as r:
                    return json.load(r)["choices"][0]["message"]["content"]
            except OSError:
                if i + 1 == retries:
                    raise
                time.sleep(2**i)
        raise OSError("no try left")

    return ask


def annotate(prompts: DataFrame, client: Client) -> DataFrame:
    """(doc_id, idx, answer, ok) from prompts (doc_id, idx, prompt); a failure is a row with ok false."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p in pdf.prompt:
                try:
                    out.append((client(p), True))
                except Exception as e:  # the model is outside: its failure is data
                    out.append((str(e), False))
            yield pd.DataFrame({"doc_id": pdf.doc_id, "idx": pdf.idx, "answer": [a for a, _ in out], "ok": [k for _, k in out]})

    return prompts.select("doc_id", "idx", "prompt").mapInPandas(run, "doc_id long, idx long, answer string, ok boolean")
