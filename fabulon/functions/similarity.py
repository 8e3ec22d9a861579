"""Sequence similarity and span search: Arrow UDFs around difflib, and their plain functions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ratios import ratios
from .text import PUNCTUATION

NEAR, SURE = 0.85, 0.99
#: Characters of a pair of texts that is remembered, at most.
SHORT = 128
#: Rows and windows that are compared at once, and counts of letters that are held at once.
ROWS, WINDOWS, CELLS = 512, 1 << 15, 1 << 22
#: Lengths up to which the places of windows are remembered.
OFTEN = 2000
NO_PUNCTUATION = dict.fromkeys(map(ord, PUNCTUATION))
# fixed values: honorifics that are stripped from names, in order
HONORIFICS = [
    "先生", "小姐", "女士", "太太", "夫人", "上尉", "中尉", "少校", "上校", "将军", "司令", "政委", "老师", "教授", "博士", "医生", "护士",
    "同学", "朋友", "同志", "师傅", "老板", "经理", "主任", "科长", "处长", "局长",
]
# fixed values: words of the structure layer and the emotion layer, and the term that each is normalised to
STRUCTURE_TERMS = {
    "悲哀": "悲伤", "悲痛": "悲伤", "哀伤": "悲伤", "惊恐": "恐惧", "害怕": "恐惧", "畏惧": "恐惧", "恐慌": "恐惧", "欢喜": "喜悦", "高兴": "喜悦", "开心": "喜悦", "快乐": "喜悦",
    "期望": "期待", "盼望": "期待", "孤单": "孤独", "孤寂": "孤独", "吃惊": "惊讶", "惊愕": "惊讶", "向往": "渴望", "渴求": "渴望", "羞愧": "羞耻", "丢脸": "羞耻",
    "厌烦": "厌恶", "反感": "厌恶", "释怀": "释然", "心慌": "焦虑", "焦躁": "焦虑",
}
EMOTION_TERMS = {
    "悲哀": "悲伤", "悲痛": "悲伤", "哀伤": "悲伤", "欢喜": "喜悦", "高兴": "喜悦", "开心": "喜悦", "恼怒": "愤怒", "愤懑": "愤怒", "怒火": "愤怒", "害怕": "恐惧", "畏惧": "恐惧",
    "惊奇": "惊讶", "愕然": "惊讶", "盼望": "期待", "期盼": "期待", "嫌弃": "厌恶", "厌烦": "厌恶", "信赖": "信任", "怅然": "怅惘", "羞愧": "羞耻", "难堪": "羞耻",
    "渴求": "渴望", "向往": "渴望", "妒忌": "嫉妒", "妒恨": "嫉妒", "困惑": "迷茫", "迷惘": "迷茫", "茫然": "迷茫", "自得": "得意",
}
TERMS = {"structure": STRUCTURE_TERMS, "emotion": EMOTION_TERMS}


def ratio(a: str | None, b: str | None) -> float:
    return SequenceMatcher(None, a or "", b or "").ratio()


@lru_cache(1 << 14)
def _letters(text: str) -> Counter:
    return Counter(text)


def may_reach(a: str, b: str, least: float) -> bool:
    """Whether ratio(a, b) can be `least` or more, by the lengths and then by the characters that both hold."""
    whole = len(a) + len(b)
    if not whole:
        return True
    if 2.0 * min(len(a), len(b)) / whole < least:
        return False
    x, y = _letters(a), _letters(b)
    return 2.0 * sum(min(n, y[c]) for c, n in x.items() if c in y) / whole >= least


def near_ratio(a: str, b: str, least: float) -> float:
    """ratio(a, b) where that is `least` or more, else something less than `least`. Pairs that the bounds rule out are not compared."""
    a, b = a or "", b or ""
    if len(a) + len(b) > SHORT:
        return ratio(a, b) if may_reach(a, b, least) else -1.0
    return _near_ratio(a, b, least)


@lru_cache(1 << 16)
def _near_ratio(a: str, b: str, least: float) -> float:
    return ratio(a, b) if may_reach(a, b, least) else -1.0


def best_match(texts: list[str], b: str, least: float) -> tuple[float, int] | None:
    """The highest ratio(text, b) of at least `least` and the first text that has it. Cheap upper bounds of the ratio spare most comparisons."""
    m, best = None, None
    for i, a in enumerate(texts):
        enough = least if best is None else best[0]
        if not may_reach(a, b, enough):
            continue
        m = m or SequenceMatcher(None, "", b)
        m.set_seq1(a)
        if (r := m.ratio()) >= enough and (best is None or r > best[0]):
            best = (r, i)
    return best


def collapsed(text: str) -> tuple[str, list[int]]:
    """The text with runs of white space as one space and none at its ends, and the place of each character."""
    places, gap = [], False
    for i, c in enumerate(text):
        if not c.isspace():
            places.append(i)
        elif not gap:
            places.append(i)
        gap = c.isspace()
    while places and text[places[0]].isspace():
        places.pop(0)
    while places and text[places[-1]].isspace():
        places.pop()
    return "".join(" " if text[i].isspace() else text[i] for i in places), places


def unpunctuated(text: str) -> tuple[str, list[int]]:
    places = [i for i, c in enumerate(text) if c not in PUNCTUATION]
    return "".join(text[i] for i in places), places


def _found(form: tuple[str, list[int]], needle: str) -> tuple[int, int] | None:
    at = form[0].find(needle) if needle else -1
    return (form[1][at], form[1][at + len(needle) - 1] + 1) if at >= 0 else None


def find_span(text: str, quote: str) -> tuple[int, int] | None:
    """Exact, else with runs of white space as one space in both."""
    quote = (quote or "").strip()
    if not text or not quote:
        return None
    at = text.find(quote)
    return (at, at + len(quote)) if at >= 0 else _found(collapsed(text), " ".join(quote.split()))


def _plain_span(text: str, quote: str) -> tuple[int, int, str, float] | None:
    """Exact, with white space and without punctuation."""
    at = text.find(quote)
    if at >= 0:
        return at, at + len(quote), "exact", 1.0
    needle = " ".join(quote.split())
    if any(c not in text for c in needle if c != " " and c not in PUNCTUATION):
        return None
    # the forms are made as plain texts first; places are wanted of what is found only
    if needle in " ".join(text.split()) and (found := _found(collapsed(text), needle)):
        return *found, "whitespace_normalized", 1.0
    bare = needle.translate(NO_PUNCTUATION)
    if bare and bare in text.translate(NO_PUNCTUATION) and (found := _found(unpunctuated(text), bare)):
        return *found, "punctuation_removed", 1.0
    return None


def _laid(n: int, length: int, least: float, step: int, turn: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Begin and size of the windows of a text for a quote of n characters, in the order of the search: of `step` sizes, from the turn'th on. Sizes whose ratio cannot be `least` are left out."""
    sizes = np.arange(max(1, int(n * 0.7)), min(length, int(n * 1.5) + 1) + 1)
    sizes = sizes[2.0 * np.minimum(n, sizes) / (n + sizes) >= least][turn * step : turn * step + step]
    if not len(sizes):
        return None
    apart = np.maximum(sizes // 4, 1)
    count = (length - sizes) // apart + 1
    begin = (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)) * np.repeat(apart, count)
    return begin, np.repeat(sizes, count)


_laid_often = lru_cache(1 << 10)(_laid)


def _windows(text: str, quote: str, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, size and bound of the windows whose ratio to the quote can be `least` by the characters that both hold, in the order of the search."""
    n, wanted = len(quote), Counter(quote)
    t = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters = np.frombuffer("".join(wanted).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)[:, None]
    kind = np.uint8 if n * 1.5 + 1 < 256 else np.int32  # counts may wrap, those of a window cannot
    most = np.array([*wanted.values()], dtype=kind)[:, None]
    laid = _laid_often if max(n, len(text)) <= OFTEN else _laid
    step = max(1, CELLS // (len(wanted) * (4 * len(text) // n + 1)))  # a size has about 4 * text / quote windows
    block = max(1, CELLS // (len(text) + 1))
    out, turn = [], 0
    while (at := laid(n, len(text), least, step if step < n else 2 * n + 2, turn)) is not None:
        begin, size = at
        end, both = begin + size, 0
        for i in range(0, len(wanted), block):
            upto = np.zeros((len(letters[i : i + block]), len(text) + 1), dtype=kind)
            np.cumsum(t == letters[i : i + block], axis=1, dtype=kind, out=upto[:, 1:])
            held = upto.take(end, axis=1)
            held -= upto.take(begin, axis=1)
            both = both + np.minimum(held, most[i : i + block], out=held).sum(axis=0, dtype=kind)
        bound = 2.0 * both / (n + size)
        kept = np.flatnonzero(bound >= least)
        out.append((begin[kept], size[kept], bound[kept]))
        turn += 1
        if step >= n:
            break
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def fuzzy_spans(texts: list[str | None], quotes: list[str | None], least: float = NEAR) -> list[tuple[int, int, str, float] | None]:
    """fuzzy_span of many texts and quotes. The window of the highest bound is compared first, of each; others then, where their bound reaches its score."""
    out: list[tuple[int, int, str, float] | None] = [None] * len(texts)
    for lo in range(0, len(texts), ROWS):
        met = []
        for i in range(lo, min(lo + ROWS, len(texts))):
            text, quote = texts[i], (quotes[i] or "").strip()
            if not text or not quote:
                continue
            out[i] = _plain_span(text, quote)
            if out[i] is None:
                begin, size, bound = _windows(text, quote, least)
                if len(begin):
                    met.append((i, quote, begin, size, bound))
        cut = lambda i, a, n: texts[i][a : a + n]  # noqa: B023, E731
        first = ratios([cut(i, a[z], n[z]) for i, _, a, n, bound in met for z in [int(bound.argmax())]], [m[1] for m in met])
        rest = [np.flatnonzero(m[4] >= max(least, min(s, SURE))) for m, s in zip(met, first, strict=True)]
        for at, of in _by_size(rest):
            scores = ratios([cut(met[m][0], met[m][2][z], met[m][3][z]) for m in of for z in rest[m]], [met[m][1] for m in of for _ in rest[m]])
            for m, score in zip(of, np.split(scores, at), strict=True):
                i, _, a, n, _ = met[m]
                if not len(score) or score.max() < least:
                    continue
                z = int((score >= SURE).argmax()) if (score >= SURE).any() else int(score.argmax())
                begin, size = int(a[rest[m][z]]), int(n[rest[m][z]])
                out[i] = begin, begin + size, "fuzzy_similarity", round(float(score[z]), 4)
    return out


def _by_size(rest: list[np.ndarray]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Rows in parts of about WINDOWS windows, with the places at which their windows part."""
    of, held = [], 0
    for m, r in enumerate(rest):
        of.append(m)
        held += len(r)
        if held >= WINDOWS or m == len(rest) - 1:
            yield np.cumsum([len(rest[k]) for k in of])[:-1], of
            of, held = [], 0


def fuzzy_span(text: str | None, quote: str | None, least: float = NEAR) -> tuple[int, int, str, float] | None:
    """(start, end, level, similarity): exact, white space, punctuation, then the most similar of the windows of every length from 0.7 to 1.5
    times the quote's, a quarter of their length apart; the first that is SURE ends the search."""
    return fuzzy_spans([text], [quote], least)[0]


def slice_similarity(text: str, start: int, end: int, quote: str) -> float:
    return ratio(quote, text[start:end]) if 0 <= start < end <= len(text) else 0.0


def plain_name(name: str) -> str:
    for h in HONORIFICS:
        if name.endswith(h) and len(name) > len(h):
            return name[: -len(h)]
    return name


def alias_similarity(a: str, b: str) -> float:
    return _alias_similarity(a, b) if len(a) + len(b) <= SHORT else _alias_similarity.__wrapped__(a, b)


@lru_cache(1 << 16)
def _alias_similarity(a: str, b: str) -> float:
    a, b = plain_name(a), plain_name(b)
    score = ratio(a, b)
    return max(score, 0.7) if len(a) >= 2 and len(b) >= 2 and (a in b or b in a) else score


def leaders(texts: list[str], least: float = 0.6) -> list[int]:
    """Greedy clusters in order: each text joins the leader most like it (at `least`), or leads its own."""
    heads: list[tuple[int, str]] = []
    out = []
    for t in texts:
        best, of = 0.0, -1
        for i, h in heads:
            score = near_ratio(t, h, least)
            if score >= least and score > best:
                best, of = score, i
        if of < 0:
            of = len(heads)
            heads.append((of, t))
        out.append(of)
    return out


def seq_ratio(a: str, b: str) -> Column:
    """Similarity of two columns."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(ratios(x.fillna("").tolist(), y.fillna("").tolist()), dtype=float)

    run.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")(a, b)


def locate(text: str, quote: str) -> Column:
    """(start, end, level, similarity) of a quote column in a text column."""

    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = [r or (None, None, "none", 0.0) for r in fuzzy_spans(x.fillna("").tolist(), y.fillna("").tolist())]
        return pd.DataFrame({"start": pd.array([r[0] for r in rows], dtype="Int64"), "end": pd.array([r[1] for r in rows], dtype="Int64"), "level": [r[2] for r in rows], "similarity": [float(r[3]) for r in rows]})

    run.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, "start long, end long, level string, similarity double")(text, quote)


def normalised_term(c: Column, layer: str = "structure") -> Column:
    """A term by the synonyms of its layer, itself if it has none."""
    table = F.create_map(*(F.lit(x) for pair in TERMS[layer].items() for x in pair))
    return F.coalesce(table[c], c)


def normalised_rows(rows: DataFrame, column: str, layer: str = "structure") -> tuple[DataFrame, DataFrame]:
    """rows with the terms of a column normalised, and the report of changes (old, new, n)."""
    new = normalised_term(F.col(column), layer)
    changes = rows.select(F.col(column).alias("old"), new.alias("new")).filter("old <> new").groupBy("old", "new").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn(column, new), changes
