"""Segmentation: boundaries, greedy packing, ids, scene groups and their rebuilt texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabulon.functions.text import short_hash


def order():
    """Rows of a document in order."""
    return Window.partitionBy("doc_id").orderBy("idx")


# fixed values: headings that open a chapter, a prologue or an epilogue, in order of precedence
HEADINGS = [
    (r"^\s*第[一二三四五六七八九十百千万零两]+\s*章\b.*$", "chapter"),
    (r"^\s*第[0-9]+\s*章\b.*$", "chapter"),
    (r"^\s*第[一二三四五六七八九十百千万零两]+\s*[部卷集][节回]?\s*.*$", "chapter"),
    (r"^\s*Part\s+[0-9IVXLCDM]+\b.*$", "chapter"),
    (r"^\s*[一二三四五六七八九十百千万零两]+\s*$", "chapter"),
    (r"^\s*Chapter\s+[0-9IVXLCDM]+\b.*$", "chapter"),
    (r"^\s*CHAPTER\s+[0-9IVXLCDM]+\b.*$", "chapter"),
    (r"^\s*[IVXLCDM]+\s*$", "chapter"),
    (r"^\s*序章\s*$", "prologue"),
    (r"^\s*楔子\s*$", "prologue"),
    (r"^\s*尾声\s*$", "epilogue"),
    (r"^\s*后记\s*$", "epilogue"),
    (r"^\s*Prologue\s*$", "prologue"),
    (r"^\s*EPILOGUE\s*$", "epilogue"),
    (r"^\s*Epilogue\s*$", "epilogue"),
    (r"^\s*.{1,12}之[一二三四五六七八九十]+\s*$", "chapter"),
    (r"^\s*[0-9]+[、.．]\s*.{0,20}\s*$", "chapter"),
    (r"^\s*[一二三四五六七八九十]+[、.．]\s*.{0,20}\s*$", "chapter"),
]


def chapters(text: str, apart: int = 10) -> list[tuple[int, str, str, int]]:
    """(position, heading, kind, number) of the headings of a text; of headings closer than `apart` the first pattern's stays.
    A prologue has number 0, all others count up."""
    taken: dict[int, tuple[str, str]] = {}
    for pattern, kind in HEADINGS:
        for m in re.finditer(pattern, text, re.MULTILINE):
            if all(abs(at - m.start()) >= apart for at in taken):
                taken[m.start()] = (m[0].strip(), kind)
    out, n = [], 0
    for at in sorted(taken):
        name, kind = taken[at]
        n += kind != "prologue"
        out.append((at, name, kind, 0 if kind == "prologue" else n))
    return out


def estimate(text: str) -> int:
    """Tokens of a text: ideographs, Latin runs, and a quarter of what is left."""
    cjk, latin = len(re.findall("[一-鿿]", text)), len(re.findall("[A-Za-z]+", text))
    return max(1, cjk + latin + max(0, len(text) - cjk - latin) // 4) if text else 0


def pack(text: str, most: int = 2000) -> list[tuple[int, int]]:
    """Ranges of a text that tile it: paragraphs, or sentences of one that is too large, are packed until `most` tokens."""
    units: list[tuple[int, int]] = []
    for m in re.finditer(r"[^\n]*\n+|[^\n]+", text):
        if estimate(m[0]) <= most:
            units.append(m.span())
        else:
            units += [(m.start() + s.start(), m.start() + s.end()) for s in re.finditer(r"[^。！？!?.…]*[。！？!?.…]{1,6}[」』”’\"]?\s*|[^。！？!?.…]+", m[0])]
    out: list[tuple[int, int]] = []
    size = 0
    for a, b in units:
        n = estimate(text[a:b])
        if out and size + n <= most:
            out[-1], size = (out[-1][0], b), size + n
        else:
            out.append((a, b))
            size = n
    return out


def packed(docs: DataFrame, most: int = 2000) -> DataFrame:
    """(doc_id, segment_index, start_char, end_char, tokens, chapter): greedy segments of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                heads = chapters(text or "")
                for i, (a, b) in enumerate(pack(text or "", most)):
                    rows.append((doc, i, a, b, estimate(text[a:b]), next((h[1] for h in reversed(heads) if h[0] <= a), "")))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], ["doc_id", "segment_index", "start_char", "end_char", "tokens", "chapter"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, segment_index long, start_char long, end_char long, tokens long, chapter string")


def chunk(text: str, size: int = 2000) -> list[tuple[int, int]]:
    """Fallback: cuts after the first terminal mark once `size` characters are reached."""
    out, a = [], 0
    while a < len(text):
        m = re.compile(r"[。！？；!?;…]").search(text, a + size - 1)
        b = m.end() if m else len(text)
        out.append((a, b))
        a = b
    return out


# fixed values: headings that surely open the body
STRONG = re.compile(r"\s*(第[一二三四五六七八九十百千万零两\d]+[章部卷集回节]|Chapter|CHAPTER|序章|楔子|尾声|后记|Prologue|Epilogue)")
KINDS = {"chapter": "body", "prologue": "frontmatter", "epilogue": "epilogue"}
SEGMENT = "doc_id long, segment_index long, segment_id string, chapter string, chapter_index long, section_type string, start_char long, end_char long, tokens long, is_polluted boolean"


def sections(text: str) -> list[tuple[int, int, str, int, str]]:
    """(start, end, chapter, number, section type) of the stretches of a text. Headings before the first strong one belong to the front
    matter; without any heading the whole text is front matter."""
    heads = chapters(text)
    first = next((i for i, (_, name, kind, _) in enumerate(heads) if kind != "prologue" and STRONG.match(name)), 0)
    heads = heads[first:]
    if not heads:
        return [(0, len(text), "", 1, "frontmatter")]
    ends = [h[0] for h in heads[1:]] + [len(text)]
    front = [(0, heads[0][0], "frontmatter", 0, "frontmatter")] if text[: heads[0][0]].strip() else []
    return front + [(at, end, name, n, KINDS[kind]) for (at, name, kind, n), end in zip(heads, ends, strict=True)]


def segments_of(text: str, most: int = 2000, longest: int = 5000, size: int = 2000) -> list[tuple]:
    """(chapter, number, section type, start, end, tokens, polluted) of the segments of one text.

    A long text of few headings or few segments, or one with a segment of more than `longest` characters, is cut by size instead; all of its
    segments are marked as polluted, like those of a text without headings.
    """
    parts = sections(text)
    bare = len(parts) == 1 and parts[0][2] == ""
    n_heads = 0 if bare else sum(p[2] != "frontmatter" for p in parts)
    out = [(name, n, kind, start + a, start + b, estimate(text[start + a : start + b]), bare) for start, end, name, n, kind in parts for a, b in pack(text[start:end], most) if text[start + a : start + b].strip()]
    total = sum(r[4] - r[3] for r in out)
    if out and ((total > longest and (n_heads < 3 or len(out) < 3)) or max(r[4] - r[3] for r in out) > longest):
        out = [("", i + 1, "body", a, b, estimate(text[a:b]), True) for i, (a, b) in enumerate(chunk(text, size)) if text[a:b].strip()]
    return out


def segmented(docs: DataFrame, most: int = 2000, longest: int = 5000, size: int = 2000) -> DataFrame:
    """Segments of each whole text of docs (doc_id, text), ids by order; null and blank texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        names = ["doc_id", "segment_index", "segment_id", "chapter", "chapter_index", "section_type", "start_char", "end_char", "tokens", "is_polluted"]
        for batch in batches:
            rows = [(doc, i, f"{doc}_seg_{i:04d}", *r) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, r in enumerate(segments_of(text or "", most, longest, size))]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names)

    return docs.select("doc_id", "text").mapInArrow(run, SEGMENT)


# fixed values: advertisements and watermarks that are taken out of a text
WATERMARKS = (r"本作品下载于[^\n]+", r"更多好看小说下载敬请访问[^\n]+", r"笔趣阁[^\n]*", r"www\.[a-zA-Z0-9]+\.(com|net|org|cn)[^\n]*", r"感谢打赏[^\n]*", r"求收藏[^\n]*", r"求推荐[^\n]*", r"求月票[^\n]*")


def cleaned(docs: DataFrame) -> DataFrame:
    """docs without watermarks in text, blank lines in a row as one, white space off the ends."""
    text = F.col("text")
    for pattern in WATERMARKS:
        text = F.regexp_replace(text, pattern, "")
    return docs.withColumn("text", F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"^\s+|\s+\z", ""))


def possible_titles(lines: DataFrame) -> DataFrame:
    """Short lines (doc_id, idx, txt; blank lines are rows too) that can be titles: a blank line or the edge of the text on both sides,
    or before a line of eight characters at most; no mark of a sentence at the end."""
    line = F.trim("txt")
    short = F.length(line).between(2, 15) & ~F.right(line, F.lit(1)).isin(*"。！？，、；：") & ~((F.length(line) > 10) & F.contains(line, F.lit(" ")))
    rows = lines.withColumn("_before", F.trim(F.coalesce(F.lag("txt").over(order()), F.lit(""))) == "").withColumn("_after", F.trim(F.coalesce(F.lead("txt").over(order()), F.lit(""))) == "")
    return rows.filter(short & F.col("_before") & (F.col("_after") | (F.length(line) <= 8))).select("doc_id", "idx", line.alias("title"))


def with_ids(rows: DataFrame) -> DataFrame:
    """Segment ids by order in the document, and the short hash of the text."""
    number = F.row_number().over(order()) - 1
    return rows.select("doc_id", "idx", F.concat(F.col("doc_id").cast("string"), F.lit("_seg_"), F.lpad(number.cast("string"), 4, "0")).alias("segment_id"), F.substring(F.sha2("txt", 256), 1, 16).alias("hash"))


def normalised(docs: DataFrame) -> DataFrame:
    """Line ends as \\n, and the short hash of the stripped text."""
    text = F.regexp_replace("text", "\r\n?", "\n")
    return docs.withColumn("text", text).withColumn("hash", short_hash(F.col("text")))


def with_groups(rows: DataFrame, unit: str = "season") -> DataFrame:
    """Number of the run of rows that agree in `unit` with the row before (null agrees with null)."""
    new = F.lag("idx").over(order()).isNull() | ~F.col(unit).eqNullSafe(F.lag(unit).over(order()))
    return rows.withColumn("_new", new.cast("int")).withColumn("scene", F.sum("_new").over(order().rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def scene_groups(rows: DataFrame, unit: str = "season") -> DataFrame:
    return with_groups(rows, unit).select("doc_id", "idx", "scene")


def rebuilt(rows: DataFrame) -> DataFrame:
    """One row for each group: its range, number of segments, and digest of its text."""
    out = rows.groupBy("doc_id", "scene").agg(F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.count(F.lit(1)).alias("merged_from_count"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "txt"))), lambda s: s["txt"]), "\n").alias("text"))
    return out.withColumn("text_sha256", F.sha2("text", 256)).drop("text")
