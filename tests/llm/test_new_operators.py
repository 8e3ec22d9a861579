"""Runs, sentencepiece and alignment against brute force, on texts, awkward rows and the given tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fabulon.llm import alignment, pieces, queries, runs

DIR = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = [" ", "  ", "a", "b", "the", "\n", "\t", "▁", "é", "ﬁ", "１", "\x00", "<|endoftext|>", "</s>", "<unk>", "<0x41>", "'s", "世界", "😀", "​", "　", ".", "ing", "́", "�", "﻿", " x", "\x85", "\x1c", "᠎", "\xa0", "12", " word"]
TEXTS = st.lists(st.sampled_from(AWKWARD), max_size=24).map("".join)
ODD = [(1, None), (2, ""), (3, "   "), (4, "a b " * 40), (4, "a b " * 40), (None, "x y z " * 5), (5, "word " * 3000), (6, "▁a b"), (7, "one two"), (8, "\n\n \t"), (9, "ends  with  gaps ")]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def brute_runs(w, least=12):
    """Every stretch with a period, by comparing all words p apart; the least period of equal stretches."""
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i >= p and j - i + p >= least:
                out.setdefault((i, j - i + p), p)
            i = j + 1 if j == i else j
    return sorted((s, n, p) for (s, n), p in out.items())


word_lists = st.one_of(
    st.lists(st.integers(0, 2), max_size=60),
    st.tuples(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=9)).map(lambda x: x[0] + x[1] * x[2] + x[3]),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(word_lists, min_size=1, max_size=5), st.sampled_from([1, 5, 1 << 20]))
def test_runs_equal_brute_force(texts, pairs):
    before, runs.PAIRS = runs.PAIRS, pairs
    try:
        found = runs.runs(np.array([x for w in texts for x in w], dtype=np.int64), [len(w) for w in texts])
    finally:
        runs.PAIRS = before
    want, at = [], 0
    for w in texts:
        want += [(s + at, n, p) for s, n, p in brute_runs(w)]
        at += len(w)
    assert list(zip(*(x.tolist() for x in found), strict=True)) == sorted(want, key=lambda r: (r[0], r[2]))


def changed(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected_runs(doc_id, text, change=changed):
    w = change(doc_id, (text or "").encode().split())
    found = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    s, n, p = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    return (doc_id, len(found), s, n, p, n and 1000 * n // p, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


RUN_COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_op11_equals_brute_force(spark):
    docs = queries.table(spark, DIR, "documents").filter("length(text) < 6000").limit(60)
    rows = docs.select("doc_id", "text").collect()
    got = runs.run_summaries(spark.createDataFrame(rows, docs.select("doc_id", "text").schema), change=runs.planted_tail)
    assert ordered(got.select(*RUN_COLUMNS).collect()) == ordered(expected_runs(*r) for r in rows)
    whole = queries.op11_periodic_runs(spark, DIR)
    assert whole.count() == 200 and whole.filter("n_runs > 0").count() >= 10


def test_runs_of_awkward_rows(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in ODD if t is None or len(t) < 5000], "doc_id long, text string, start int, words string")
    got = runs.run_summaries(docs)
    assert ordered(got.select(*RUN_COLUMNS).collect()) == ordered(expected_runs(i, t, lambda _, w: w) for i, t in ODD if t is None or len(t) < 5000)
    assert runs.run_summaries(docs.limit(0)).count() == 0 and runs.periodic_runs(docs.limit(0)).count() == 0
    long = runs.periodic_runs(spark.createDataFrame(ODD, "doc_id long, text string")).filter("doc_id = 5").collect()
    assert [tuple(r) for r in long] == [(5, 0, 3000, 1)]
    kept = runs.collapse_runs(spark.createDataFrame([(1, "a b c " * 6 + "d"), (2, None)], "doc_id long, text string"))
    assert ordered(kept.collect()) == [(1, "a b c d"), (2, "")]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=B)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXTS, max_size=6))
def test_pieces_equal_the_library(library, texts):
    ids = [library.encode(t) for t in texts]
    assert list(pieces.pieces(B).rows(texts)) == [(len(i), ",".join(map(str, i)), library.decode(i)) for i in ids]


def test_pieces_with_a_small_table(library):
    model, before = pieces.Pieces(B), pieces.TABLE
    texts = [f"w{i % 7} v{i} the w{i % 3}" for i in range(200)]
    pieces.TABLE = 20
    try:
        got = [r for lo in range(0, 200, 8) for r in model.rows(texts[lo : lo + 8])]
    finally:
        pieces.TABLE = before
    assert [r[1] for r in got] == [",".join(map(str, library.encode(t))) for t in texts] and len(model.known) <= 40
    model.apart = False
    assert list(model.rows(texts[:9])) == got[:9]


def test_op12_equals_the_library(spark, library):
    rows = queries.table(spark, DIR, "documents").select("doc_id", "text").collect()
    want = [(d, len(i), sha(",".join(map(str, i))), sha(library.decode(i))) for d, t in rows for i in [library.encode(t or "")]]
    assert ordered(queries.op12_sentencepiece(spark, DIR).collect()) == ordered(want)


def test_pieces_of_awkward_rows(spark, library):
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in ODD], "doc_id long, text string, n_tokens int, ids string")
    want = [(d, len(i), sha(",".join(map(str, i))), sha(library.decode(i))) for d, t in ODD for i in [library.encode(t or "")]]
    assert ordered(pieces.round_trip(docs, B).collect()) == ordered(want)
    encoded = pieces.encode_documents(docs, B)
    assert ordered(encoded.select("doc_id", "n_tokens").collect()) == ordered((d, n) for d, n, _, _ in want)
    assert ordered(pieces.decode_documents(encoded, B).collect()) == ordered((d, (t or "").replace("▁", " ")) for d, t in ODD)
    assert pieces.round_trip(docs.limit(0), B).count() == 0
    broken = spark.createDataFrame([(1, [3 + 0xC3, 3 + 0xA9]), (2, [3 + 0xC3]), (3, None)], "doc_id long, ids array<int>")
    assert ordered(pieces.decode_documents(broken, B).collect()) == [(1, "é"), (2, "�"), (3, None)]


def brute_groups(text, a, b):
    """Groups and links of one text by the sets of bytes at which tokens end."""
    if not text:
        return None
    both = alignment.pair(A, B)
    i, j = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    of_a, of_b = [both.a_bytes[x] for x in i], [both.b_bytes[x] for x in j]
    if not b"".join(of_a) == (" " + text).encode() == b"".join(of_b):
        return None
    end_a, end_b = (np.cumsum([len(x) for x in of]).tolist() for of in (of_a, of_b))
    groups, links, p, q = [], [], 0, 0
    for e in sorted(set(end_a) & set(end_b)):
        x, y = end_a.index(e) + 1, end_b.index(e) + 1
        groups.append(",".join(map(str, i[p:x])) + "|" + ",".join(map(str, j[q:y])))
        links.append((i[x - 1], j[y - 1]))
        p, q = x, y
    return len(i), len(j), ";".join(groups), links


@pytest.fixture(scope="module")
def byte_level():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(A)
    out.encode_special_tokens = True
    return out


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(TEXTS, max_size=6))
def test_groups_equal_brute_force(byte_level, library, texts):
    for t, got in zip(texts, alignment.pair(A, B).rows(texts), strict=True):
        want = brute_groups(t, byte_level, library)
        assert (got is None) == (want is None)
        if want:
            assert got[:3] == want[:3] and np.frombuffer(got[3], dtype=np.int64).tolist() == [b << 32 | a for a, b in want[3]]


def expected_alignment(rows, a, b):
    found = [(d, brute_groups(t, a, b)) for d, t in rows]
    count = Counter(x for _, f in found if f for x in f[3])
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return [(d, f[0], f[1], f[2].count(";") + 1, len(f[3]), sum(count[x] == top[x[1]] for x in f[3]), sum(count[x] for x in f[3]), sha(f[2])) if f else (d, 0, 0, 0, 0, 0, 0, "") for d, f in found]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_op13_equals_brute_force(spark, byte_level, library):
    rows = [tuple(r) for r in queries.table(spark, DIR, "documents").select("doc_id", "text").collect()]
    assert ordered(queries.op13_alignment(spark, DIR).select(*COLUMNS).collect()) == ordered(expected_alignment(rows, byte_level, library))


def test_alignment_of_awkward_rows_and_small_flushes(spark, byte_level, library):
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in ODD], "doc_id long, text string, links int, pair string").repartition(5)
    before, alignment.FLUSH = alignment.FLUSH, 3
    try:
        got = alignment.alignment_counts(docs, A, B)
        assert ordered(got.select(*COLUMNS).collect()) == ordered(expected_alignment(ODD, byte_level, library))
    finally:
        alignment.FLUSH = before
    assert alignment.alignment_counts(docs.limit(0), A, B).count() == 0
    assert alignment.alignment_counts(docs.filter("text is null"), A, B).select(*COLUMNS).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "")
    groups = alignment.align_documents(docs.filter("doc_id = 7"), A, B).first()
    assert groups["groups"].count("|") == len(groups["links"]) == groups["groups"].count(";") + 1


def test_results_outlive_other_calls(spark):
    """No operator's end takes away the tables of another one, and stages compose unwritten."""
    import corpus_pipeline

    near, passages = queries.op10_minhash_dedup(spark, DIR), queries.op7_substring_dedup(spark, DIR)
    n, m = near.count(), passages.count()
    docs = queries.table(spark, DIR, "documents")
    composed = corpus_pipeline.substring_stage(spark, corpus_pipeline.near_dedup_stage(spark, docs, DIR), DIR)
    k = composed.count()
    assert corpus_pipeline.run(spark, DIR).count() > 0
    assert (near.count(), passages.count(), composed.count()) == (n, m, k)
