"""Steps that grew faster than the input: what they give is as before, by plainer means, and their plans keep to the cheaper form."""

import random

import pytest

import __spark_entry__ as entry
from fabulon.functions import ratios, similarity
from fabulon.operators import gate, joins, nested, network, relations
from fabulon.operators.gate import gram_repetition
from fabulon.plans.fixture import annotated

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def words(n, seed, letters="abcd", most=9):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_near_ratio_is_the_ratio_where_it_reaches():
    for a, b in zip(words(400, 1), words(400, 2)):
        for least in (0.3, 0.6, 0.85):
            exact, got = similarity.ratio(a, b), similarity.near_ratio(a, b, least)
            assert got == exact if exact >= least else got < least


def test_ratios_are_those_of_difflib():
    made = [words(300, s, letters, most) for s, letters, most in ((3, "ab", 40), (4, "abcdefgh ", 150), (5, "abcdefghijklmnopqrstuvwxyz    eeett", 460), (6, "日本🙂ab", 250), (7, "aab", 260))]
    a = [t for some in made for t in some]
    b = [t[len(t) // 3 :] + t[: len(t) // 4] + u[:9] if i % 2 else u for i, (t, u) in enumerate(zip(a, a[1:] + a[:1]))]
    a, b = a + ["", "", "a" * 250, "xy" * 150], b + ["", "a", "a" * 250, "xy" * 140 + "z"]
    assert ratios.ratios(a, b).tolist() == [similarity.ratio(p, q) for p, q in zip(a, b)]


def test_ratios_of_many_places_are_halved_and_then_left_to_difflib(monkeypatch):
    a, b = words(60, 8, "ab", 30) + ["ab" * 90] * 3, words(60, 9, "ab", 30) + ["ba" * 95] * 3
    monkeypatch.setattr(ratios, "PLACES", 300)
    assert ratios.ratios(a, b).tolist() == [similarity.ratio(p, q) for p, q in zip(a, b)]


def test_segments_are_compared_many_at_once(spark, monkeypatch):
    rows = entry.queries()["sim_seq_ratio"](spark, DIR)
    assert rows.count() > 0
    monkeypatch.setattr(similarity, "ratio", None)  # the plain function, a pair at a time
    told = spark.createDataFrame([(1, "abc", "abd"), (2, None, None), (3, "", "a")], "i int, a string, b string").select("i", similarity.seq_ratio("a", "b").alias("r"))
    assert {r.i: round(r.r, 6) for r in told.collect()} == {1: 0.666667, 2: 1.0, 3: 0.0}


@pytest.mark.parametrize("query", ["scratchpad_fold", "memory_fold", "alias_clusters", "object_leader_clusters"])
def test_no_group_of_pandas_for_each_document(spark, query):
    df = entry.queries()[query](spark, DIR)
    assert "FlatMapGroupsInPandas" not in plan(df) and df.count() > 0


def test_grams_are_counted_without_a_step_for_each(spark):
    assert "array_distinct" not in plan(entry.queries()["qg_repetition"](spark, DIR))
    texts = ["", None, "abcd", "abcde", "aaaaaaaaaa", "日本語🙂🙂🙂日本語🙂🙂🙂", "x" * 6000]
    got = {r[0]: tuple(r)[1:] for r in gram_repetition(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        grams = [t[:5000][j : j + 5] for j in range(len(t[:5000]) - 4)] if t else []
        if t is not None:
            assert got[i][:2] == (len(grams), len(set(grams)))


def test_votes_leave_their_task_once(spark):
    plans = plan(entry.queries()["lex_vote"](spark, DIR))
    assert "Join" not in plans and "Aggregate" not in plans


def test_messages_judge_each_row_once(spark):
    assert "Union" not in plan(entry.queries()["commit_messages"](spark, DIR))


def test_terms_read_their_rows_once(spark):
    assert "Join" not in plan(entry.queries()["conf_terms"](spark, DIR))


def test_spans_of_many_rows_are_those_of_a_plain_search(spark, monkeypatch):
    def plain(text, quote, least):
        best, n = (0.0, 0, 0), len(quote)
        for size in range(max(1, int(n * 0.7)), min(len(text), int(n * 1.5) + 1) + 1):
            for a in range(0, len(text) - size + 1, max(1, size // 4)):
                score = similarity.ratio(text[a : a + size], quote)
                if score > best[0]:
                    best = (score, a, a + size)
                    if score >= similarity.SURE:
                        return a, a + size, "fuzzy_similarity", round(score, 4)
        return (best[1], best[2], "fuzzy_similarity", round(best[0], 4)) if best[0] >= least else None

    texts = words(60, 11, "abcde", 90) + words(20, 12, "ab", 60)
    quotes = [t[5:17] + "~" + t[18:30] if i % 3 else t[9:2:-1] + "~" for i, t in enumerate(texts)]
    wanted = [plain(t, q, 0.7) if t else None for t, q in zip(texts, quotes)]
    assert sum(w is not None for w in wanted) > 20
    assert similarity.fuzzy_spans(texts, quotes, 0.7) == wanted == [similarity.fuzzy_span(t, q, 0.7) for t, q in zip(texts, quotes)]
    for name, value in (("CELLS", 300), ("ROWS", 7), ("WINDOWS", 5), ("OFTEN", 0)):
        monkeypatch.setattr(similarity, name, value)
    assert similarity.fuzzy_spans(texts, quotes, 0.7) == wanted


def test_quotes_are_spread_before_they_are_searched(spark):
    assert "RepartitionByExpression" in plan(entry.queries()["span_fuzzy"](spark, DIR))


@pytest.mark.parametrize("query", ["rel_rules", "rel_curated_first"])
def test_relations_are_dealt_by_number_of_rows(spark, monkeypatch, query):
    whole = sorted(map(tuple, entry.queries()[query](spark, DIR).collect()), key=repr)
    monkeypatch.setattr(relations, "ROWS", 40)
    rows = entry.queries()[query](spark, DIR)
    segments = annotated(spark, DIR).count()
    assert segments > 40 * 8 and f", {-(-segments // 40)}" in "".join(line for line in plan(rows).splitlines() if "RepartitionByExpression" in line)
    assert sorted(map(tuple, rows.collect()), key=repr) == whole


def test_nested_texts_are_opened_without_their_schema_at_each_level(spark):
    rows = entry.queries()["nested_values"](spark, DIR)
    lines = [line for line in plan(rows).splitlines() if "schema_of_variant" in line]
    assert len(lines) <= 1 and "Aggregate" not in plan(rows)


def test_exports_of_deep_texts_that_are_hidden_or_broken(spark):
    texts = ['{"a": {"b": [1]}}', '{"source": ' + "[" * 60 + "]" * 60 + "}", "[" * 90, "[1]", None]
    assert nested.deepest_of(spark.createDataFrame([(t,) for t in texts[:2]], "raw string")) == 61
    for some in (texts, texts[:1] + texts[3:]):
        got = {tuple(r) for r in nested.exported(spark.createDataFrame(list(enumerate(some)), "idx long, raw string")).select("idx", "path", "value").collect()}
        assert got == {(0, "$.a.b[0]", "1")} | ({(1, "$.source", nested.HIDDEN)} if len(some) > 3 else set())


def test_grams_are_counted_by_numbers(monkeypatch):
    wide = "".join(map(chr, range(0x4E00, 0x4E00 + 9000)))
    texts = [*words(40, 15, "abc ", 60), "", "abcd", "日本語🙂" * 9, "x" * 6000, wide, wide[:50] * 2]
    for size in (1, 2, 5):
        assert gate.distinct_grams(texts, size).tolist() == [len({t[i : i + size] for i in range(len(t) - size + 1)}) for t in texts]
    assert gate.distinct_grams([], 5).tolist() == [] and gate.distinct_grams(["", ""], 5).tolist() == [0, 0]


def test_garbage_is_counted_one_by_one(spark):
    assert "(?=" in gate.GARBAGE  # most places are passed by one look
    texts = ["a&nbsp;b<BR />c<div x=1>�\x01\t&AMP;</P><p >< &lt", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r[1] for r in gate.garbage_density(rows, "doc_id", "text").orderBy("doc_id").collect()] == [8, 0, None]


def test_names_of_a_network_are_looked_for_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(network, "contained", lambda *a: calls.append(1) or joins.contained(*a))
    rows = entry.queries()["net_edges"](spark, DIR)
    assert len(calls) == 1 and rows.count() > 0
