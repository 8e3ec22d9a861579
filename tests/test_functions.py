from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fabulon.functions import enums, similarity, text
from fabulon.operators import entities, segmentation
from fabulon.operators.scratchpad import Scratchpad


def test_sizes_of_closed_sets():
    sizes = {k: len(v) for k, v in enums.all_sets().items()}
    assert (sizes["D01"], sizes["D04_CORE"], sizes["D07"], sizes["EMOTIONS"], sizes["RHETORIC"], sizes["RELATIONS"]) == (10, 20, 7, 50, 8, 5)
    assert all(len(set(v)) == len(v) for v in enums.all_sets().values())


@given(st.text(alphabet="abc 第一章\n。!?", max_size=300))
@settings(max_examples=200, deadline=None)
def test_packing_tiles_the_text(t):
    spans = segmentation.pack(t, 20)
    assert "".join(t[a:b] for a, b in spans) == t
    assert "".join(t[a:b] for a, b in segmentation.chunk(t, 50)) == t


def test_chapters():
    t = "序章\n话说从前有一个人,住在山下。\n第一章 开始\n" + "文" * 30 + "\n第二章 继续\n" + "文" * 30 + "\n尾声\n完"
    assert [(k, n) for _, _, k, n in segmentation.chapters(t)] == [("prologue", 0), ("chapter", 1), ("chapter", 2), ("epilogue", 3)]


@pytest.mark.parametrize(("t", "n"), [("", 0), ("a", 1), ("中文 word word", 6), ("....", 1)])
def test_estimate(spark, t, n):
    assert segmentation.estimate(t) == n
    assert spark.createDataFrame([(t,)], "t string").select(text.tokens_estimated(F.col("t"))).first()[0] == n


def test_text_functions(spark):
    row = lambda c, v: spark.createDataFrame([(v,)], "t string").select(c(F.col("t"))).first()[0]
    assert row(text.squash, "  a　 b\n c ") == "a b c"
    assert row(text.quoted, "他说「你好」然后『走了』") == ["你好", "走了"] and row(text.quoted, " x ") == ["x"]
    assert row(text.location_keyword, "客厅（二楼），夜") == "客厅" and row(text.year_of, "in 1987, 2001") == 1987 and row(text.year_marked, "约 1987 年冬") == 1987
    assert row(text.season_of, "那年冬天") == "冬" and row(text.time_hint, "黄昏时分") == 3 and row(text.time_type, "他回忆起后来") == "flashback" and row(text.time_type, None) == "unknown"
    assert [row(text.segment_number, v) for v in ("d_seg_0012", "d_scene_003", "x9", "none", None)] == [12, 3, 9, 0, 0]


def test_spans():
    t = "月光洒在金箔一样的湖面上,风 很 轻。"
    assert similarity.fuzzy_span(t, "金箔")[:3] == (4, 6, "exact")
    assert similarity.fuzzy_span(t, "风  很 轻")[2] == "whitespace_normalized" and similarity.fuzzy_span(t, "风很轻。") is None
    assert similarity.fuzzy_span(t, "湖面上风")[2] == "punctuation_removed"
    assert similarity.fuzzy_span("abcdefghijklmnop" * 2, "cdefgXijkl")[2] == "fuzzy_similarity" and similarity.fuzzy_span("abc", "zzz") is None
    assert similarity.slice_similarity("abc", 0, 9, "abc") == 0 and similarity.slice_similarity("abc", 0, 3, "abc") == 1


def test_similarity_is_not_symmetric_in_long_texts():
    a, b = "x" * 250 + "y", "y" + "x" * 10
    assert similarity.ratio(a, b) == SequenceMatcher(None, a, b).ratio() and similarity.ratio(b, a) == SequenceMatcher(None, b, a).ratio()


def test_aliases_and_leaders():
    assert entities.merge_aliases([("王小明", 5), ("小明", 3), ("李四", 2)]) == {"王小明": "王小明", "小明": "王小明", "李四": "李四"}
    assert similarity.leaders(["red moon", "red moons", "sea"]) == [0, 0, 1]
    assert similarity.plain_name("张先生") == "张" and similarity.alias_similarity("张三先生", "张三") == 1.0


def test_scratchpad():
    pad = Scratchpad()
    pad.add_character("福贵", 1, aliases=("老人",), description="农民")
    assert pad.find("老人")["canonical_name"] == "福贵" and pad.find("谁") is None
    pad.add_character("福贵", 3)
    assert pad.characters["福贵"]["mention_count"] == 2 and pad.characters["福贵"]["last_segment"] == 3
    a = pad.add_event("福贵输掉了家里的田", 3, ("福贵",))
    assert pad.add_event("福贵输掉了家里的田产", 4) is a and len(pad.events) == 1 and a["event_id"] == "evt_001"
    pad.add_event("藏起了一把钥匙", 5, kind="plant")
    pad.close("藏起了一把钥匙")
    assert pad.statistics() == {"characters": 1, "events": 2, "open": 1, "pending": 0}
    assert Scratchpad.load(pad.dump()).dump() == pad.dump() and pad.resolve(6) == "福贵" and "福贵(2)" in pad.summary()


def test_first_person_and_items():
    pad = Scratchpad()
    pad.step(1, "我", (), None, None, "")
    assert not pad.characters  # nobody to bind to
    pad.step(2, "福贵", ("家珍",), None, None, "")
    pad.step(3, "福贵", ("我",), None, None, "")
    pad.step(4, None, ("我",), None, None, "")
    assert pad.find("我")["canonical_name"] == "福贵" and pad.characters["福贵"]["mention_count"] == 3 and "我" not in pad.characters
    pad.describe("我", "x" * 60)
    assert len(pad.characters["福贵"]["description"]) == 50 and pad.undescribed(1) == ["家珍"]
    pad.add_item("钥匙", 2, "秘密")
    assert pad.add_item(" 钥匙 ", 5, "秘密") == {"name": "钥匙", "first_segment": 2, "last_segment": 5, "notes": ["秘密"]} and pad.find_item("门") is None
    event = pad.add_event("他走了", 5)["event_id"]
    assert len(pad.open_events()) == 1 and pad.close_event(event) and not pad.open_events() and not pad.close_event("evt_999")
    assert Scratchpad.load(pad.dump()) == pad


def test_segments_of_a_whole_text():
    text = "一、缘起\n" + "序。" * 20 + "\n第一章 山\n" + "风。" * 30 + "\n第二章 水\n雨下了一夜才停。\n尾声\n完。\n"
    got = segmentation.segments_of(text)
    assert [(r[0], r[1], r[2]) for r in got] == [("frontmatter", 0, "frontmatter"), ("第一章 山", 2, "body"), ("第二章 水", 3, "body"), ("尾声", 4, "epilogue")]
    assert "".join(text[r[3] : r[4]] for r in got) == text and not any(r[6] for r in got)
    assert segmentation.segments_of("") == segmentation.segments_of(" \n ") == []
    bare = segmentation.segments_of("无标题。\n只有正文。")
    assert [(r[0], r[2], r[6]) for r in bare] == [("", "frontmatter", True)]


def test_long_texts_are_cut_by_size():
    text = "一二三四五六七八九。" * 900
    got = segmentation.segments_of(text)
    assert len(got) == 5 and all(r[6] and r[2] == "body" for r in got) and [r[4] - r[3] for r in got] == [2000] * 4 + [1000]
    assert "".join(text[r[3] : r[4]] for r in got) == text
    assert [r[4] - r[3] for r in segmentation.segments_of("x" * 9000)] == [9000]


@given(st.lists(st.text("abc", max_size=12), max_size=8), st.text("abc", max_size=12))
def test_best_match_equals_brute_force(texts, b):
    scores = [similarity.ratio(a, b) for a in texts]
    want = max(((r, -i) for i, r in enumerate(scores) if r >= 0.75), default=None)
    assert similarity.best_match(texts, b, 0.75) == (want and (want[0], -want[1]))


def test_words_of_a_lexicon():
    from fabulon.operators.metrics import split_by

    assert split_by("快乐的abc12 乐。", frozenset({"快乐", "bc"})) == ["快乐", "的", "abc12", "乐"]
    assert split_by("快乐", frozenset()) == ["快", "乐"] and split_by("", frozenset({"快乐"})) == []


@given(st.text("ab。c ", min_size=1, max_size=40), st.text("abc", min_size=1, max_size=12))
@settings(max_examples=300, deadline=None)
def test_fuzzy_windows_equal_brute_force(body, quote):
    found = similarity.fuzzy_span(body, quote, 0.6)
    if found and found[2] != "fuzzy_similarity":
        return
    n, best = len(quote), (0.0, 0, 0)
    for size in range(max(1, int(n * 0.7)), min(len(body), int(n * 1.5) + 1) + 1):
        for a in range(0, len(body) - size + 1, max(1, size // 4)):
            score = similarity.ratio(body[a : a + size], quote)
            if score > best[0] and best[0] < similarity.SURE:
                best = (score, a, a + size)
    assert found == ((best[1], best[2], "fuzzy_similarity", round(best[0], 4)) if best[0] >= 0.6 else None)
