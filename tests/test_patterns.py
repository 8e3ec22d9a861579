"""Many patterns in one pass against brute force, and both ways of finding them against each other."""

import random

import pytest

from fabulon.functions import patterns
from fabulon.functions.patterns import APART, EVERYWHERE, LONGEST, Automaton
from fabulon.operators import joins, lexicon


def brute(text, words, mode):
    every = sorted((i, w) for w in set(words) if w for i in range(len(text)) if text.startswith(w, i))
    if mode == EVERYWHERE:
        return every
    out, free = [], {}
    for at, w in sorted(every, key=lambda x: (x[0], -len(x[1]))):
        key = w if mode == APART else ""
        if at >= free.get(key, 0):
            out.append((at, w))
            free[key] = at + len(w)
    return sorted(out)


@pytest.mark.parametrize("mode", [EVERYWHERE, LONGEST, APART])
def test_automaton_equals_brute_force(mode):
    rnd = random.Random(7)
    for _ in range(400):
        words = ["".join(rnd.choices("ab世", k=rnd.randint(0, 4))) for _ in range(rnd.randint(0, 8))]
        text = "".join(rnd.choices("ab世c", k=rnd.randint(0, 25)))
        assert sorted(getattr(Automaton(words), mode)(text)) == brute(text, words, mode)


def test_five_thousand_patterns_in_one_pass():
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdef", k=rnd.randint(2, 6))) for _ in range(5000)]
    text = "".join(rnd.choices("abcdefg", k=3000))
    assert sorted(Automaton(words).longest(text)) == brute(text, words, LONGEST)


@pytest.mark.parametrize("mode", [EVERYWHERE, LONGEST, APART])
def test_both_ways_give_the_same_rows(spark, mode):
    rnd = random.Random(9)
    texts = [(i, "".join(rnd.choices("ab世", k=rnd.randint(0, 30)))) for i in range(60)] + [(60, None), (61, ""), (1, "abab"), (1, "abab")]
    words = ["ab", "a", "bab", "世a", "", None, "bb", "ab"]
    rows = spark.createDataFrame([(i, t, "x") for i, t in texts], "idx long, txt string, w2 string")
    known = spark.createDataFrame([(w,) for w in words], "w string")
    found = [sorted(map(tuple, patterns.find(rows, known, mode=mode, most=most).select("idx", "w", "pos", "before", "after").collect()), key=repr) for most in (100, 1)]
    want = sorted(((i, w, at + 1, t[at - 1] if at else None, t[at + len(w)] if at + len(w) < len(t) else None) for i, t in texts if t for at, w in brute(t, [w for w in words if w], mode)), key=repr)
    assert found[0] == found[1] == want
    assert patterns.find(rows, known.limit(0), mode=mode).count() == 0 and patterns.find(rows.limit(0), known, mode=mode, most=1).count() == 0


def test_size_of_patterns_is_checked(spark):
    rows = spark.createDataFrame([(1, "abc")], "idx long, txt string")
    known = spark.createDataFrame([("ab",), ("bc",)], "w string")
    plan = lambda **bounds: patterns.find(rows, known, **bounds)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan() and "MapInArrow" not in plan(most_bytes=3) and "MapInArrow" not in plan(most=1)
    with pytest.raises(ValueError):
        patterns.find(rows, known, mode="some")


def test_vote_by_hand(spark):
    rows = spark.createDataFrame([(1, 0, "好人坏"), (1, 1, "人好坏坏"), (1, 2, None), (1, 3, "无"), (1, 4, "坏好人好")], "doc_id long, idx long, txt string")
    words = lexicon.polarities(spark.createDataFrame([("好人", 2, 0), ("好人", 1, 1), ("好", 1, 0), ("坏", 2, 0), ("人坏", 1, 0), ("人", 0, 0), ("好坏坏", 1, 0), ("无", 3, 0)], "w string, pol int, at int"))
    got = {r["idx"]: (r["positive"], r["negative"], r["neutral"], r["dominant"], r["words"]) for r in lexicon.vote(rows, words).collect()}
    assert got[0] == (1, 1, 0, "positive", "好人:positive,坏:negative")
    assert got[1] == (1, 2, 1, "negative", "人:neutral,好:positive,坏:negative,坏:negative")
    assert got[2] == got[3] == (0, 0, 0, "neutral", "")
    assert got[4][:4] == (2, 1, 0, "positive")
    few = lexicon.vote(rows, words, most=1)
    assert {r["idx"]: (r["positive"], r["negative"], r["neutral"], r["dominant"], r["words"]) for r in few.collect()} == got


def test_containment_of_empty_and_equal_names(spark):
    a = spark.createDataFrame([(1, "ann"), (1, ""), (1, None), (2, "ann"), (1, "an"), (1, "ann")], "doc_id long, a string")
    b = spark.createDataFrame([(1, "an"), (1, "joanna"), (2, "bob"), (1, ""), (1, "ann")], "doc_id long, b string")
    assert sorted(map(tuple, joins.contained(a, b).collect())) == [(1, "an", "an"), (1, "an", "ann"), (1, "an", "joanna"), (1, "ann", "an"), (1, "ann", "ann"), (1, "ann", "joanna")]
