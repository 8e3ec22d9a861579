"""Chat formatting: transcripts are parsed by a hidden Markov model over lines, then rendered canonically.

Each line shows a speaker marker, a quoted one or none, whether it is blank or a bare marker, its length and whether it asks. The hidden states are,
for each role, the bare marker line of a turn, its first line, its later lines and blank lines, all of it twice: for transcripts that mark their turns and
for those that set them apart by blank lines, between which a path cannot change. The Viterbi path over a transcript's lines
gives turns and roles: a marker is a strong hint, a quoted one hardly any, and where markers lack, blank lines, the alternation of roles and the
length of lines decide. Scores are whole numbers (thousandths of natural logarithms, and below them fixed
numbers by turn and line that tell ties apart), so that sums do not depend on their order.

Canonical text has `<|role|>`, the turn's lines and `<|end|>` for each turn; backslashes and text that looks like such a mark are escaped.

`parse` and `format_transcripts` take whole transcripts. `format_pieces` takes conversations as rows (pieces of a transcript in an order) and never
holds a conversation: rows are dealt by ranges of the order into blocks of BLOCK rows; for a conversation that goes over the end of a block, the
block gives the best scores from every state before it to every state at its end; their products (of maxima and sums) along the
conversation give the states at each block's ends, with which the blocks are decoded. So the result is that of one Viterbi path over the
whole conversation, however rows are dealt.

Null or empty transcripts have no turn and render as empty text. Ties of paths go to the earlier state in STATES. Text of any length is parsed
whole. Repeated rows are rows of their own; rows of null conv_id form one conversation; a null order stands first; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import trimmed
from .scratch import Scratch
from .words import groups, numbers

ROLES = ("system", "user", "assistant", "tool")
# fixed values: names that stand for a role before a colon or inside a mark
NAMES = {
    "system": "system", "instruction": "system", "instructions": "system",
    "user": "user", "human": "user", "question": "user", "q": "user", "customer": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "answer": "assistant", "a": "assistant", "agent": "assistant",
    "tool": "tool", "function": "tool", "result": "tool",
}
MARK = re.compile(r"^\s*(>\s*)?(?:<\|(\w+)\|>|#{1,4}\s*(\w+)\s*:?\s*$|\[(\w+)\]|\**(\w+)\**\s*(?::|>))[ \t]?", re.ASCII)
KINDS = ("mark", "first", "more", "blank")
STATES = [(r, k, marked) for marked in (True, False) for r in ROLES for k in KINDS]
N, START, NEVER, BLOCK = len(STATES), len(STATES), -(10**13), 2048
#: Lengths of lines in characters, and for each role the shares of lines up to them and beyond.
LENGTHS = (60, 150, 300)
OF_LENGTH = {"system": (0.2, 0.35, 0.35, 0.1), "user": (0.2, 0.35, 0.35, 0.1), "assistant": (0.08, 0.17, 0.3, 0.45), "tool": (0.25, 0.25, 0.25, 0.25)}
#: Who speaks after whom, and first.
AFTER = {
    "system": {"system": 0.02, "user": 0.9, "assistant": 0.06, "tool": 0.02}, "user": {"system": 0.02, "user": 0.05, "assistant": 0.9, "tool": 0.03},
    "assistant": {"system": 0.02, "user": 0.85, "assistant": 0.04, "tool": 0.09}, "tool": {"system": 0.02, "user": 0.05, "assistant": 0.85, "tool": 0.08},
}
FIRST = {"system": 0.2, "user": 0.7, "assistant": 0.08, "tool": 0.02}
#: From a kind of line, with marked turns or without: shares of later lines, blank lines and the next turn.
NEXT = {
    True: {"mark": (0.97, 0.01, 0.02), "first": (0.6, 0.15, 0.25), "more": (0.6, 0.15, 0.25), "blank": (0.6, 0.15, 0.25)},
    False: {"mark": (0.97, 0.01, 0.02), "first": (0.59, 0.4, 0.01), "more": (0.59, 0.4, 0.01), "blank": (0.1, 0.05, 0.85)},
}
#: Shares of marked and quoted markers in first lines.
SHOWN = {True: (0.97, 0.001), False: (0.15, 0.05)}


def log(p: float) -> int:
    return 1024 * round(1000 * math.log(p)) if p > 0 else NEVER


def ties(turn: int | None, n: int) -> np.ndarray:
    """Fixed small numbers by which equal scores of the n-th line of a turn are told apart."""
    return (numbers(N, ((turn or 0) * 1009 + n) % (1 << 31)) >> np.uint64(54)).astype(np.int64)


def marker(line: str) -> tuple[str | None, bool, str]:
    """The role that a line's marker names, whether it is quoted, and the line without it."""
    m = MARK.match(line)
    name = NAMES.get(next(filter(None, m.groups()[1:])).lower()) if m else None
    return (name, bool(m[1]), line[m.end() :]) if name else (None, False, line)


@lru_cache(maxsize=1)
def steps() -> np.ndarray:
    """Scores of the steps between states, with the beginning of a transcript as the last row."""
    out = np.full((N + 1, N), NEVER, dtype=np.int64)
    for i, (r, k, marked) in enumerate([*STATES, ("", "", True)]):
        for j, (to, kind, mode) in enumerate(STATES):
            opens = {"mark": 0.3 if mode else 0.05, "first": 0.7 if mode else 0.95}.get(kind, 0)
            if i == START:
                out[i, j] = log(0.5 * FIRST[to] * (opens or (0.001 if kind == "blank" else 0)))
            elif mode == marked:
                more, blank, end = NEXT[mode][k]
                out[i, j] = log(end * AFTER[r][to] * opens if opens else (more if kind == "more" else blank) if to == r else 0)
    return out


@lru_cache(maxsize=4096)
def _scores(named: str | None, quoted: bool, bare: bool, blank: bool, length: int, asks: bool) -> np.ndarray:
    out = []
    for role, kind, marked in STATES:
        shown, cited = SHOWN[marked]
        looks = 1.0 if blank or bare else OF_LENGTH[role][length] * (0.6 if asks == (role == "user") else 0.4)
        if blank:
            p = {"mark": 0.0001, "first": 0.002, "more": 0.002, "blank": 0.95}[kind]
        elif named is None or quoted:
            p = {"mark": 0.0001, "first": cited if quoted else 1 - shown, "more": 0.05 if quoted else 0.9, "blank": 0.0005}[kind] * looks
        elif bare:
            p = {"mark": 0.9 if named == role else 0.002, "first": 0.02 if named == role else 0.0005, "more": 0.0006, "blank": 0.0005}[kind]
        else:
            p = {"mark": 0.0001, "first": shown if named == role else 0.001, "more": 0.0006, "blank": 0.0005}[kind] * looks
        out.append(log(p))
    return np.array(out, dtype=np.int64)


def emission(line: str) -> np.ndarray:
    """Scores of a line's features in each state."""
    named, quoted, body = marker(line)
    blank = not line.strip()
    length = sum(len(body) > n for n in LENGTHS)
    return _scores(named, quoted, named is not None and not quoted and not body.strip(), blank, 0 if blank else length, body.rstrip().endswith("?"))


def observed(turns: list[int | None], texts: list[str | None]) -> list[np.ndarray]:
    """The lines' scores of pieces of text."""
    return [emission(line) + ties(turn, n) for turn, text in zip(turns, texts, strict=True) for n, line in enumerate((text or "").split("\n"))]


def viterbi(seen: list[np.ndarray], enter: int = START, leave: int | None = None) -> list[int]:
    """The best states of lines with these scores after the state `enter`, ending in `leave` if given."""
    if not seen:
        return []
    step = steps()
    score, back = step[enter] + seen[0], []
    for own in seen[1:]:
        way = score[:, None] + step[:N]
        from_ = way.argmax(axis=0)
        score = way[from_, np.arange(N)] + own
        back.append(from_)
    at = int(score.argmax()) if leave is None else leave
    path = [at]
    for from_ in reversed(back):
        path.append(at := int(from_[at]))
    return path[::-1]


def products(seen: list[np.ndarray]) -> np.ndarray:
    """Best scores from each state before the lines (the last row: from the beginning of a transcript) to each state of the last line."""
    step = steps()
    out = step + seen[0]
    for own in seen[1:]:
        out = (out[:, :, None] + step[None, :N]).max(axis=1) + own
    return np.maximum(out, 2 * NEVER)


def parse(transcript: str | None) -> list[tuple[str, str]]:
    """Turns (role, text) of a transcript; white space around a turn's text is dropped."""
    lines = transcript.split("\n") if transcript and transcript.strip() else []
    turns: list[tuple[str, list[str]]] = []
    for line, state in zip(lines, viterbi([emission(x) for x in lines]), strict=True):
        role, kind, _ = STATES[state]
        if kind in ("mark", "first"):
            named, quoted, body = marker(line)
            turns.append((role, [body if named == role and not quoted else line]))
        elif turns:
            turns[-1][1].append(line)
    return [(role, "\n".join(body).strip()) for role, body in turns]


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def render(turns: list[tuple[str, str]]) -> str:
    """The canonical text of turns."""
    return "".join(f"<|{role}|>\n{escaped(text)}\n<|end|>\n" for role, text in turns)


def read_canonical(text: str) -> list[tuple[str, str]]:
    """The turns of a canonical text."""
    return [(m[1], re.sub(r"\\([\\|])", r"\1", m[2])) for m in re.finditer(r"<\|(\w+)\|>\n(.*?)\n?<\|end\|>\n", text, re.DOTALL)]


def format_transcripts(transcripts: DataFrame, *keys: str) -> DataFrame:
    """keys, n_turns, roles (joined by a comma), rendered for each row (keys.., transcript)."""
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse(t) for t in batch.column(n).to_pylist()]
            new = [pa.array([len(x) for x in found], pa.int64()), pa.array([",".join(r for r, _ in x) for x in found], pa.string()), pa.array([render(x) for x in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), *new], [*keys, "n_turns", "roles", "rendered"])

    rows = transcripts.select(*keys, F.col("transcript").cast("string").alias("transcript"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(trimmed(run), ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "n_turns long, roles string, rendered string"]))


def _cuts(conv: np.ndarray) -> list[int]:
    return [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), len(conv)]


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, conv, turn, raw) sorted -> (conv, block, scores) for the first and the last conversation of each block, which may go on elsewhere."""
    for group in groups(batches, 1):
        conv, turn, raw = group.column(1).to_numpy(), group.column(2), group.column(3)
        cuts = _cuts(conv)
        found = []
        for a, z in {(cuts[0], cuts[1]), (cuts[-2], cuts[-1])}:
            found.append((int(conv[a]), products(observed(turn[a:z].to_pylist(), raw[a:z].to_pylist())).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([group.column(0)[0].as_py()] * len(found), pa.int64()), pa.array([m.tolist() for _, m in found], pa.list_(pa.int64()))], ["conv", "block", "scores"])


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, scores) sorted -> (conv, block, enter, leave): the states before and at the end of each block of a conversation of several."""
    for group in groups(batches, 1):
        if group.num_rows > 1:
            each = [np.array(m, dtype=np.int64).reshape(N + 1, N) for m in group.column(2).to_pylist()]
            best = [each[0][START]]
            for m in each[1:]:
                new = (best[-1][:, None] + m[:N]).max(axis=0)
                best.append(np.maximum(new - new.max(), NEVER))
            at, leave = int(best[-1].argmax()), []
            for i in range(len(each) - 1, -1, -1):
                leave.append(at)
                at = int((best[i - 1] + each[i][:N, at]).argmax()) if i else START
            leave = leave[::-1]
            yield pa.RecordBatch.from_arrays([group.column(0).combine_chunks(), group.column(1).combine_chunks(), pa.array([START, *leave[:-1]], pa.int32()), pa.array(leave, pa.int32()), pa.array([False] * (len(leave) - 1) + [True])], ["conv", "block", "enter", "leave", "ends"])


def rendered(turns: list[int | None], texts: list[str | None], enter: int, leave: int | None, ends: bool) -> list[tuple[str | None, int, str]]:
    """For each piece of a conversation, in order: the role of its first line, the turns that begin in it, and its part of the canonical text."""
    lines = [(t or "").split("\n") for t in texts]
    path = iter(viterbi(observed(turns, texts), enter, leave))
    out, inside = [], enter != START
    for n, piece in enumerate(lines):
        text, role, begun, held = [], None, 0, []
        for line in piece:
            own, kind, _ = STATES[next(path)]
            role = role or own
            if kind in ("mark", "first"):
                named, quoted, body = marker(line)
                text += (["<|end|>\n"] if inside else []) + [f"<|{own}|>\n"]
                inside, held = True, []
                begun += 1
                body = body if named == own and not quoted else line
                if body.strip():
                    text.append(escaped(body) + "\n")
            elif line.strip():
                text += [*held, escaped(line) + "\n"]
                held = []
            else:
                held.append("\n")  # kept only if the turn goes on in the piece
        if ends and n == len(lines) - 1 and inside:
            text.append("<|end|>\n")
        out.append((role, begun, "".join(text)))
    return out


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, at, conv, turn, raw, enter, leave, ends) sorted -> (at, found_role, n_begun, rendered)."""
    for group in groups(batches, 1):
        conv = group.column(2).to_numpy()
        cuts = _cuts(conv)
        found: list[tuple] = []
        for a, z in zip(cuts, cuts[1:], strict=False):
            enter, leave, ends = (group.column(c)[a].as_py() for c in (5, 6, 7))
            found += rendered(group.column(3)[a:z].to_pylist(), group.column(4)[a:z].to_pylist(), START if enter is None else enter, leave, ends is not False)
        role, begun, text = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([group.column(1).combine_chunks(), pa.array(role, pa.string()), pa.array(begun, pa.int64()), pa.array(text, pa.string())], ["at", "found_role", "n_begun", "rendered"])


def format_pieces(pieces: DataFrame) -> DataFrame:
    """(conv_id, turn, role, raw, found_role, n_begun, rendered) for each row (conv_id, turn, role, raw): a conversation's pieces, in order of turn, role
    and raw, are lines of one transcript. found_role: the role of the piece's first line; n_begun: turns that begin in it; the conversation's
    canonical text is its `rendered` in that order."""
    scratch = Scratch(pieces.sparkSession)
    order = ["conv", "turn", "role", "raw", "tie"]
    rows = pieces.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "raw").withColumns({"conv": F.coalesce(F.col("conv_id"), F.lit(-(1 << 63))), "tie": F.monotonically_increasing_id()})
    ranged = scratch.cut(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    # numbers that rise with the order: the partition above bit 33, and in it the row
    data = scratch.cut(ranged.withColumn("at", F.monotonically_increasing_id()).drop("tie")).withColumn("block", F.shiftleft(F.shiftright("at", 33), 33) + F.expr(f"(at & {(1 << 33) - 1}) div {BLOCK}"))
    by_block = lambda df: df.repartition("block").sortWithinPartitions("block", "at")
    opened = by_block(data.select("block", "at", "conv", "turn", "raw")).select("block", "conv", "turn", "raw").mapInArrow(trimmed(_open), "conv long, block long, scores array<long>")
    carried = scratch.cut(opened.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(trimmed(_carried), "conv long, block long, enter int, leave int, ends boolean"))
    met = data.select("block", "at", "conv", "turn", "raw").join(carried.withColumnsRenamed({"conv": "conv2", "block": "block2"}), (F.col("conv") == F.col("conv2")) & (F.col("block") == F.col("block2")), "left")
    found = by_block(met.select("block", "at", "conv", "turn", "raw", "enter", "leave", "ends")).mapInArrow(trimmed(_decoded), "at long, found_role string, n_begun long, rendered string")
    return data.join(scratch.cut(found).withColumnRenamed("at", "at2"), F.col("at") == F.col("at2")).select("conv_id", "turn", "role", "raw", "found_role", "n_begun", "rendered")


# fixed values: markers of the styles in which the query writes transcripts; a style without markers has a blank line after each turn
STYLES = [
    {"system": "System: ", "user": "User: ", "assistant": "Assistant: ", "tool": "Tool: "},
    {"system": "### Instruction:\n", "user": "### Human:\n", "assistant": "### Assistant:\n", "tool": "### Function:\n"},
    {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n", "tool": "<|tool|>\n"},
    {"system": "[system] ", "user": "Q: ", "assistant": "A: ", "tool": "[tool] "},
    {},
]
#: Style numbers beyond the markers: of the first turn only, and with later lines of the assistant that quote a marker.
UNMARKED, FIRST_ONLY, QUOTING = 4, 5, 6


def raw_pieces(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, raw, style): rows (conv_id, turn, role, text) as pieces of raw transcripts, in a style by conv_id.

    Style 4 has no marker, style 5 has one at the least turn only, and in style 6 the later lines of the assistant quote the user's marker. Rows without a
    known role are written without a marker and rows of null text as an empty turn.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.trim(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    least = rows.groupBy("conv_id").agg(F.min("turn").alias("least")).withColumnRenamed("conv_id", "c2")
    rows = rows.join(least, F.col("conv_id").eqNullSafe(F.col("c2")), "left").withColumn("style", F.pmod(F.xxhash64("conv_id"), F.lit(QUOTING + 1)).cast("int"))
    marked = F.when(F.col("style") == QUOTING, F.lit(0)).when((F.col("style") == FIRST_ONLY) & (F.col("turn") == F.col("least")), F.lit(0)).when(F.col("style") < UNMARKED, F.col("style"))
    names = F.create_map(*[F.lit(x) for i, of in enumerate(STYLES) for role, text in of.items() for x in (f"{i}{role}", text)])
    mark = F.coalesce(names[F.concat(marked.cast("string"), F.col("role"))], F.lit(""))
    body = F.when((F.col("style") == QUOTING) & (F.col("role") == "assistant"), F.regexp_replace("text", "\n(?=.)", "\n> User: ")).otherwise(F.col("text"))
    apart = F.when(F.col("style").isin(UNMARKED, FIRST_ONLY), F.lit("\n")).otherwise(F.lit(""))
    return rows.select("conv_id", "turn", "role", F.concat(mark, body, apart).alias("raw"), "style")
