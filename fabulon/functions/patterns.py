"""Many patterns in one pass: an automaton over Arrow batches, and an equi-join for sets of patterns that are too large to ship."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Patterns, and bytes of them, that one automaton holds at most; it takes about a hundred times these bytes in a task.
MOST, MOST_BYTES = 200_000, 1 << 21
EVERYWHERE, LONGEST, APART = "everywhere", "longest", "apart"
_built: dict[str, Automaton] = {}


class Automaton:
    """Finds all of a set of patterns in a text in one pass over it. Empty patterns are left out."""

    def __init__(self, words: list[str]):
        self.words = sorted({w for w in words if w})
        self.machine = ahocorasick.Automaton()
        for w in self.words:
            self.machine.add_word(w, w)
        if self.words:
            self.machine.make_automaton()

    def everywhere(self, text: str) -> list[tuple[int, str]]:
        """(place from 0, pattern) of every occurrence, overlapping ones too."""
        return [(end - len(w) + 1, w) for end, w in self.machine.iter(text)] if self.words else []

    def longest(self, text: str) -> list[tuple[int, str]]:
        """From left to right the longest pattern at each place that no one before it covers."""
        if not self.words:
            return []
        best = {end - len(w) + 1: w for end, w in self.machine.iter(text)}  # of one place longer ones end later
        out, free = [], 0
        for at in sorted(best):
            if at >= free:
                out.append((at, best[at]))
                free = at + len(best[at])
        return out

    def apart(self, text: str) -> list[tuple[int, str]]:
        """The occurrences of each pattern that do not overlap an earlier one of the same pattern."""
        out, free = [], {}
        for at, w in self.everywhere(text):
            if at >= free.get(w, 0):
                out.append((at, w))
                free[w] = at + len(w)
        return out


def _machine(name: str, shared) -> Automaton:
    """One automaton for each broadcast, here named, and Python worker; older ones go."""
    if name not in _built:
        _built.clear()
        _built[name] = Automaton(shared.value)
    return _built[name]


def small(words: DataFrame, *, most: int = MOST, most_bytes: int = MOST_BYTES) -> list | None:
    """The rows of words (w, ..), if their patterns are few enough for one automaton; null and empty patterns are left out."""
    known = words.filter(F.length("w") > 0)
    n, size = known.select("w").distinct().agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("w")), F.lit(0))).first()
    rows = known.limit(most + 1).collect() if n <= most and size <= most_bytes else []  # `most` at most, but for patterns that come again
    return rows if n <= most and size <= most_bytes and len(rows) <= most else None


def in_rows(rows: DataFrame, words: list[str], made, schema: str, *, text: str = "txt", mode: str = EVERYWHERE) -> DataFrame:
    """(the other columns of rows.., those of schema): what made says of the occurrences (place from 0, pattern) in each row's text, a dict for each row; a null text has none.
    For what is counted row by row: no occurrence leaves its task."""
    shared, name = rows.sparkSession.sparkContext.broadcast(words), uuid.uuid4().hex
    keys = [c for c in rows.columns if c != text]
    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text), schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = getattr(_machine(name, shared), mode)
        for batch in batches:
            found = [made([] if t is None else search(t)) for t in batch.column(0).to_pylist()]
            own = [batch.column(c + 1) for c in range(len(keys))]
            new = pa.RecordBatch.from_pylist(found) if found else None
            if new is not None:
                yield pa.RecordBatch.from_arrays([*own, *new.columns], [*keys, *new.schema.names])

    return rows.select(text, *keys).mapInArrow(run, ", ".join(fields))


def find(rows: DataFrame, words: DataFrame, *, text: str = "txt", mode: str = EVERYWHERE, most: int = MOST, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(the other columns of rows.., w, pos, before, after): the occurrences of the patterns of words (w) in a text column, with their places from 1 and the
    characters around them (null at the ends).

    mode: everywhere, longest (from left to right, none covers another) or apart (per pattern). The distinct patterns are counted first: up to `most` of
    `most_bytes` bytes go to the tasks as one automaton, more are joined with the parts of the texts that have a pattern's length. Both give the same rows.
    Null texts and patterns and empty patterns have no occurrence.
    """
    if mode not in (EVERYWHERE, LONGEST, APART):
        raise ValueError(f"unknown mode {mode}")
    known = words.select(F.col("w").cast("string").alias("w")).filter(F.length("w") > 0).distinct()
    n, size = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("w")), F.lit(0))).first()
    rows = rows.filter(F.col(text).isNotNull())
    if n > most or size > most_bytes:
        return _joined(rows, known, text, mode)
    shared = rows.sparkSession.sparkContext.broadcast([r[0] for r in known.collect()])  # `most` at most
    keys, name = [c for c in rows.columns if c != text], uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = getattr(_machine(name, shared), mode)
        for batch in batches:
            of, word, pos, before, after = [], [], [], [], []
            for i, t in enumerate(batch.column(0).to_pylist()):
                for at, w in search(t):
                    of.append(i)
                    word.append(w)
                    pos.append(at + 1)
                    before.append(t[at - 1] if at else None)
                    after.append(t[at + len(w) : at + len(w) + 1] or None)
            own = [batch.column(c + 1).take(pa.array(of, pa.int64())) for c in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(word, pa.string()), pa.array(pos, pa.int64()), pa.array(before, pa.string()), pa.array(after, pa.string())], [*keys, "w", "pos", "before", "after"])

    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text), "w string", "pos long", "before string", "after string"]
    return rows.select(text, *keys).mapInArrow(run, ", ".join(fields))


def _joined(rows: DataFrame, known: DataFrame, text: str, mode: str) -> DataFrame:
    """find by a join on the pattern itself: each text gives its parts of each length that patterns have, and no more of it goes along."""
    keys = [c for c in rows.columns if c != text]
    lengths = sorted(r[0] for r in known.select(F.length("w")).distinct().collect())  # different lengths of patterns
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())  # in a step of its own: beside explode it would number the parts
    at = numbered.select("_row", *keys, F.col(text).alias("_t"), F.explode(starts).alias("_p"))
    parts = at.select("_row", *keys, "_p", F.explode(F.array(*(F.struct(F.substring("_t", F.col("_p"), F.lit(k)).alias("w"), F.substring("_t", F.col("_p") + k, F.lit(1)).alias("after"), F.lit(k).alias("k")) for k in lengths))).alias("_x"), F.when(F.col("_p") > 1, F.substring("_t", F.col("_p") - 1, F.lit(1))).alias("before"))
    met = parts.filter(F.length("_x.w") == F.col("_x.k")).select("_row", *keys, F.col("_p").cast("long").alias("pos"), "before", F.col("_x.w").alias("w"), F.when(F.col("_x.after") != "", F.col("_x.after")).alias("after")).join(known, "w", "left_semi")
    if mode != EVERYWHERE:
        # in order of place, longer ones first, an occurrence stands if it begins where the last one that stands has ended
        group = ["_row"] if mode == LONGEST else ["_row", "w"]
        hits = met.groupBy(*group, *keys).agg(F.array_sort(F.collect_list(F.struct("pos", (-F.length("w")).alias("n"), *(["w"] if mode == LONGEST else []), "before", "after"))).alias("h"))
        first = F.struct(F.lit(0).cast("long").alias("free"), F.filter("h", lambda _: F.lit(False)).alias("kept"))
        stands = F.aggregate("h", first, lambda acc, x: F.when(x["pos"] >= acc["free"], F.struct((x["pos"] - x["n"]).cast("long").alias("free"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc))
        met = hits.select(*keys, *([] if mode == LONGEST else ["w"]), F.explode(stands["kept"]).alias("x")).select(*keys, *(["x.w"] if mode == LONGEST else ["w"]), "x.pos", "x.before", "x.after")
    return met.select(*keys, "w", "pos", "before", "after")


def kept_first(rows: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    """The first `most` rows of each group, with the number of all of them in `total`."""
    by = Window.partitionBy(*keys)
    return rows.withColumns({"rank": F.row_number().over(by.orderBy(*order)).cast("long"), "total": F.count(F.lit(1)).over(by)}).filter(F.col("rank") <= most)
