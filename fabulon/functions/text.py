"""Scalar text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the contract sees it: Unicode spaces and the ideographic one.
SPACE = r"[\s   -     　\u0085\u001C-\u001F]+"
CJK = r"[一-鿿]"
# fixed values: quote marks, and the honorifics that are stripped from names, in order
QUOTES = "「」『』\"“”"
OPEN, CLOSE = "「『\"“‘", "」』\"”’"
PUNCTUATION = "，。！？；：、\"'「」『』（）《》【】—…·,.!?;:()[]{}-"


def squash(c: Column) -> Column:
    """Every run of white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def without_space(c: Column) -> Column:
    return F.regexp_replace(c, SPACE, "")


def quoted(c: Column) -> Column:
    """The quoted parts of a text, or the whole text if nothing is quoted."""
    parts = F.filter(F.split(c, "[" + QUOTES + "]"), lambda x, i: (i % 2 == 1) & (F.trim(x) != ""))
    return F.when(F.size(parts) > 0, F.transform(parts, F.trim)).otherwise(F.array(F.trim(c)))


def holds(text: Column, quote: Column) -> Column:
    """Whether a text has a quote, white space aside from its extent ignored."""
    return F.contains(squash(text), squash(quote))


def tokens_estimated(c: Column) -> Column:
    """Ideographs, Latin runs and a quarter of all other characters, 1 at least; 0 for an empty text."""
    cjk, latin = F.regexp_count(c, F.lit(CJK)), F.regexp_count(c, F.lit("[A-Za-z]+"))
    rest = F.greatest(F.lit(0), F.length(c) - cjk - latin)
    return F.when(F.length(c) == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), cjk + latin + F.floor(rest / 4))).cast("long")


def location_keyword(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.element_at(F.split(c, "[，,；;]"), 1), "[（(][^）)]*[）)]?", ""))


def year_of(c: Column) -> Column:
    """A year from 1500 to 2099 that stands by itself, as an int."""
    found = F.regexp_extract(c, r"\b(1[5-9]\d\d|20\d\d)\b", 1)
    return F.when(found != "", found.cast("int"))


def year_marked(c: Column) -> Column:
    found = F.regexp_extract(c, r"(\d{3,4})\s*年", 1)
    return F.when(found != "", found.cast("int"))


def season_of(c: Column) -> Column:
    found = F.regexp_extract(c, "[春夏秋冬]", 0)
    return F.when(found != "", found)


# fixed values: words of the four parts of the day, and what sets a text's time by chapter
DAY = ["早晨|早上|清晨|黎明|破晓", "上午|中午|正午|午时", "下午|午后|傍晚|黄昏|日落", "晚上|夜里|夜晚|午夜|深夜|子时"]
BY_CHAPTER = r"第[一二三四五六七八九十百千\d]+[章节回]"
# fixed values: names of a season, of a time of day and of a distance in time
MARKERS = {
    "season": "春|夏|秋|冬|春天|夏天|秋天|冬天", "period": "上午|下午|中午|晚上|深夜|凌晨|黄昏|黎明|早晨|清晨",
    "relative": "多年前|多年后|不久前|不久后|几天后|几个月后|一年后|十年后",
}


def time_hint(c: Column) -> Column:
    """1 to 4 by the time of day that a text names."""
    out = F.lit(None).cast("int")
    for i in range(4, 0, -1):
        out = F.when(c.rlike(DAY[i - 1]), F.lit(i)).otherwise(out)
    return out


def time_marker(c: Column, kind: str) -> Column:
    """The first season, period or relative time that a text names, or null."""
    found = F.regexp_extract(c, MARKERS[kind], 0)
    return F.when(found != "", found)


def time_goes_on(before: Column, now: Column) -> Column:
    """False only if both texts are explicit and the time of day goes back, or one lacks a time of day and the texts differ."""
    explicit = lambda c: time_hint(c).isNotNull() | c.rlike(BY_CHAPTER)
    known = (F.coalesce(before, F.lit("")) != "") & (F.coalesce(now, F.lit("")) != "")
    hints = time_hint(before).isNotNull() & time_hint(now).isNotNull()
    onward = F.when(hints, time_hint(now) >= time_hint(before)).otherwise(F.trim(before) == F.trim(now))
    return F.when(known & explicit(before) & explicit(now), onward).otherwise(F.lit(True))


def plain_place(c: Column) -> Column:
    """A place without a leading verb or preposition and a trailing locative; null if nothing is left."""
    out = F.regexp_replace(c, "^(在|位于|到了|来到|进入|离开)\\s*", "")
    out = F.trim(F.regexp_replace(out, "\\s*(里|中|内|上|下|旁|附近)$", ""))
    return F.when(out != "", out)


def same_place(a: Column, b: Column) -> Column:
    """Equal, one in the other, or one unknown."""
    a, b = plain_place(a), plain_place(b)
    return F.coalesce(F.contains(a, b) | F.contains(b, a), F.lit(True))


def word_form(c: Column) -> Column:
    """A word without notes in brackets, quote marks and space at its ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[（(].*?[)）]", ""), "[《》「」『』\"“”'‘’·]", ""))


def anchor(c: Column, size: int = 24) -> Column:
    """(text, start, end): the first characters of a text and the place at which its first six stand; null for a blank text."""
    head = F.left(c, F.lit(size))
    at = F.instr(c, F.left(head, F.lit(6))) - 1
    fits = (at >= 0) & (at + F.length(head) <= F.length(c))
    return F.when(F.trim(head) != "", F.struct(head.alias("text"), F.when(fits, at).alias("start"), F.when(fits, at + F.length(head)).alias("end")))


def rounded(c: Column, digits: int) -> Column:
    """Half up, in the same steps as the oracle's SQL."""
    return F.floor(c.cast("double") * F.lit(float(10**digits)) + F.lit(0.5)) / F.lit(float(10**digits))


def time_type(c: Column) -> Column:
    """Flashback, flashforward or analepsis by key words, in this order, else linear; unknown for null."""
    # fixed values: key words of each type
    words = {
        "flashback": ["回忆", "回想", "多年前", "曾经", "以前", "过去", "那年", "小时候", "童年", "往事", "记忆中", "昔日"],
        "flashforward": ["多年后", "后来", "将来", "未来", "若干年后", "十年后", "从此以后"],
        "analepsis": ["话说", "却说", "且说", "原来", "此前", "在此之前"],
    }
    out = F.lit("linear")
    for kind in reversed(words):
        out = F.when(c.rlike("|".join(words[kind])), F.lit(kind)).otherwise(out)
    return F.when(c.isNull(), F.lit("unknown")).otherwise(out)


def segment_number(c: Column) -> Column:
    """The number in a segment id: after _seg_, else after _scene_, else at the end, else 0."""
    out = F.lit(0)
    for pattern in (r"(\d+)$", r"_scene_(\d+)", r"_seg_(\d+)"):
        found = F.regexp_extract(c, pattern, 1)
        out = F.when(found != "", found.cast("int")).otherwise(out)
    return F.coalesce(out, F.lit(0))


def short_hash(c: Column) -> Column:
    """Sixteen hex digits of the sha256 of a text without white space at its ends."""
    return F.substring(F.sha2(F.regexp_replace(c, f"^{SPACE}|{SPACE}$", ""), 256), 1, 16)
