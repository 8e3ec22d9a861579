"""The operators for training data against brute force, exact round trips and held-out accuracy, and on awkward rows."""

import base64
import hashlib
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers as P
from fabulon.llm import ann, bpe, chat, components, language_id, lm, minhash_dedup, mixing, quality, queries, substring_dedup, vector_dedup, words
from fabulon.llm.scratch import Scratch

DIR = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_50k.tiktoken")
TEXT = "the quick brown fox jumps over the lazy dog and runs far away from here into the green woods "


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns that clash with names inside the operators."""
    long_text = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    rows = [
        (1, TEXT * 9, "en", "a", 1), (2, TEXT * 9, "en", "a", 1), (2, TEXT * 9, "en", "a", 1), (3, None, "en", None, None), (4, "", None, "b", 0), (5, " \t\n ", "de", "b", 3),
        (None, TEXT * 9, "en", "a", 1), (None, None, None, None, None), (6, "word", "en", "c", 4), (7, long_text, "xx", "b", 9), (8, long_text + " end", "xx", "b", 9), (9, "éà 漢字 😀 x\u0000y", "fr", "", 5), (10, "w" * 50_000, "fr", "d", 5),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["rep", "node", "component_id", "component", "kept", "key", "shared", "grp", "seed", "doc", "other", "k", "id", "size", "taken", "target", "of", "row", "h", "ids", "score", "quality", "blocks", "a", "b", "n"]
    return df.withColumns({c: F.lit("clash") for c in clash})


def word_list(text):
    return (text or "").encode().lower().split()


def sets(texts):
    out = {}
    for i, t in texts.items():
        w = word_list(t)
        out[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# shared parts


@given(st.lists(st.text(alphabet="aAbB é\t\n\x0b ", max_size=30), max_size=6))
@settings(max_examples=100, deadline=None)
def test_words(lines):
    import pyarrow as pa

    data, offsets = words.utf8(pa.array(lines, pa.string()))
    starts, ends, rows = words.bounds(data, offsets)
    h = words.hashes(data, starts, ends)
    got = [[] for _ in lines]
    for a, b, r in zip(starts, ends, rows, strict=True):
        got[r].append(data[a:b].tobytes().lower())
    assert got == [word_list(x) for x in lines]
    flat = [w for x in got for w in x]
    assert len(set(h.tolist())) == len(set(flat)) and all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(i))


@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
@settings(max_examples=50, deadline=None)
def test_local_components(links):
    a, b = np.array([x for x, _ in links], int), np.array([y for _, y in links], int)
    assert dict(enumerate(components.local(26, a, b).tolist())) == groups(range(26), links)


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000, i) for i in range(1001, 1300)] + [(i, i + 1) for i in range(2000, 2040)]
    got = components.components(Scratch(spark), spark.createDataFrame([*links, (5, None), (7, 7)], "a long, b long"))
    want = groups({x for e in links for x in e}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in got.collect()} == {k: v for k, v in want.items() if k in linked}
    assert components.components(Scratch(spark), spark.createDataFrame([], "a long, b long")).count() == 0


# op1


def test_ann_recall(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 32))
    x[5] = x[6]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, shard int")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, shard=1500).collect()
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    hits = 0
    for q in range(0, 3000, 20):
        rows = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 21)) and all(abs(r["score"] - s[q, r["vec_id"]]) < 1e-9 for r in rows)
        assert rows == sorted(rows, key=lambda r: (-r["score"], r["vec_id"]))
        hits += len({r["vec_id"] for r in rows} & set(np.argsort(-s[q])[:20].tolist()))
    assert hits / (150 * 20) >= 0.9


@pytest.mark.parametrize("sigma", [0.0, 0.3, 0.5, 0.8])
def test_ann_recall_on_varied_norms(sigma):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(16000, 64))
    x *= np.exp(sigma * rng.normal(size=(len(x), 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    ids, q = np.arange(len(x)), np.arange(0, len(x), 400)
    of, row, score = ann.search(x, ids, ids[q], x[q], 20)
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    assert np.allclose(score, s[of, row]) and np.bincount(of).tolist() == [20] * len(q)
    hits = sum(len(set(row[of == i].tolist()) & set(np.argsort(-s[i])[:20].tolist())) for i in range(len(q)))
    assert hits >= 0.9 * 20 * len(q)


@pytest.mark.parametrize(("table", "rows", "most"), [("sf0.01", 500, 0.95), ("sf0.1", 2000, 0.65), (None, 50_000, 0.35)])
def test_ann_visits_a_share_of_the_rows(monkeypatch, table, rows, most):
    """Recall and the share of the rows that a query visits: on the tables (random directions, where neighbours are hardly nearer than others), and in clusters."""
    if table:
        import pyarrow.parquet as pq

        x = np.array(pq.read_table(f"/root/testdata/{table}/embeddings.parquet").column("embedding").to_pylist())
    else:
        rng = np.random.default_rng(3)
        x = rng.normal(size=(400, 64))[rng.integers(0, 400, rows)] + 0.35 * rng.normal(size=(rows, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    seen, found = [], ann.Index.candidates
    monkeypatch.setattr(ann.Index, "candidates", lambda self, *a: [seen.append(len(r) / len(self.data)) or r for r in found(self, *a)])
    assert len(x) == rows
    ids, q = np.arange(len(x)), np.arange(0, len(x), max(20, len(x) // 60))
    best = [[] for _ in q]
    for k in range(0, len(x), ann.SHARD):
        for i, row, score in zip(*ann.search(x[k : k + ann.SHARD], ids[k : k + ann.SHARD], ids[q], x[q], 20), strict=True):
            best[i].append((-score, k + row))
    s = x[q] @ x.T
    s[np.arange(len(q)), q] = -np.inf
    hits = sum(len({j for _, j in sorted(b)[:20]} & set(np.argsort(-s[i])[:20].tolist())) for i, b in enumerate(best))
    assert hits >= 0.9 * 20 * len(q) and np.mean(seen) <= most


def test_bands():
    norms = np.exp(np.random.default_rng(12).normal(size=9000))
    cut = ann.bands(norms)
    assert sorted(np.concatenate(cut).tolist()) == list(range(9000)) and all(norms[a].min() >= norms[b].max() for a, b in itertools.pairwise(cut))
    assert all(len(b) <= ann.BAND or norms[b].max() <= ann.RATIO * norms[b].min() for b in cut) and ann.bands(np.zeros(0)) == []


def test_ann_awkward(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [0.0, 1.0]), (40, []), (60, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_perturbations_rise_and_exclude():
    marks = ann.perturbations(4, 40)
    assert not marks[0].any() and len({tuple(m) for m in marks.tolist()}) == len(marks)
    assert all(not (m[j] and m[7 - j]) for m in marks for j in range(4))


# op2


def test_vector_dedup(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base + 0.06 * rng.normal(size=base.shape) * rng.random() for _ in range(6)])
    x[3], x[50] = x[2], x[2] * 5
    labels = [i % 3 if i % 11 else None for i in range(len(x))]
    for i in (0, 40, 80):
        labels[i] = 7
    df = spark.createDataFrame([(i, v.tolist(), lab, "c") for i, (v, lab) in enumerate(zip(x, labels, strict=True))], "vec_id long, embedding array<double>, label int, id string")
    got = {r["vec_id"]: r for r in vector_dedup.near_duplicate_vectors(df, limit=0.95, block=16).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = [(i, j) for i, j in itertools.combinations(range(len(x)), 2) if labels[i] is not None and labels[i] == labels[j] and u[i] @ u[j] >= 0.95]
    n, want = Counter(i for e in links for i in e), groups(range(len(x)), links)
    assert len(links) > 100 and len(got) == len(x)
    assert all(r["n_links"] == n[i] and r["component_id"] == want[i] and r["kept"] == (want[i] == i) for i, r in got.items())


@pytest.mark.parametrize("block", [3, 2048])
def test_repeated_vec_ids_count_once(spark, block):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(6, 8))
    rows = [(int(rng.integers(0, 25)), (base[rng.integers(0, 6)] + 0.12 * rng.integers(0, 3, 8)).tolist(), int(rng.integers(0, 2))) for _ in range(90)]
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in vector_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=block).collect()}
    cosine = lambda x, y: np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y))
    links = {(a, b) for (a, x, p), (b, y, q) in itertools.product(rows, rows) if a != b and p == q and cosine(x, y) >= 0.98}
    want = groups({r[0] for r in rows}, links)
    assert len(links) > 60 and got == {(i, sum(a == i for a, _ in links), want[i]) for i in want}


def test_quantisation_bound():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(60, 24)), rng.normal(size=(60, 24))
    ux, uy = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    i, j = vector_dedup.possible(vector_dedup.quantised(x), vector_dedup.quantised(y), 0.3, slice(0, 60))
    assert set(zip(*np.nonzero(ux @ uy.T >= 0.3), strict=True)) <= set(zip(i, j, strict=True))


def test_vector_dedup_awkward(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (6, [1.0, 0.0, 0.0], 1), (7, [float("nan"), 0.0], 1), (8, [1e-200, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, vector_dedup.near_duplicate_vectors(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (None, 0, None, True), (6, 0, 6, True), (7, 0, 7, True), (8, 2, 1, False)], key=str)
    near = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [1.0, 0.005], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, vector_dedup.near_duplicate_vectors(near).collect())) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]
    assert vector_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


# op3


@pytest.mark.parametrize("style", chat.STYLES[: chat.UNMARKED])
def test_chat_round_trip(style):
    turns = [("system", "Be kind.\nAnswer in short."), ("user", "what is it?"), ("assistant", "It is a fox.\n\nit runs."), ("user", "Thanks."), ("assistant", "Well."), ("user", "a"), ("user", "a"), ("tool", "x")]
    raw = "\n".join(style[r] + t for r, t in turns)
    assert chat.parse(raw) == turns and chat.read_canonical(chat.render(turns)) == turns


@given(st.lists(st.tuples(st.sampled_from(chat.ROLES), st.text(alphabet="a\\\\<|> \n")), max_size=4))
@settings(max_examples=200, deadline=None)
def test_canonical_text_is_read_back(turns):
    turns = [(r, t.strip()) for r, t in turns]
    assert chat.read_canonical(chat.render(turns)) == turns


def test_chat_markers_in_the_middle_and_missing():
    assert [r for r, _ in chat.parse("User: hi\nAssistant: see:\nnote: this stays\n> User: quoted\nUser: ok")] == ["user", "assistant", "user"]
    long_ = "The answer has many words that go on and on " * 9
    assert [r for r, _ in chat.parse(f"Be brief.\n\nWhat is it?\n\n{long_}\n\nAnd why?\n\n{long_}")] == ["system", "user", "assistant", "user", "assistant"]
    assert chat.parse(None) == chat.parse(" \n ") == [] and chat.render([]) == ""


def test_viterbi_is_the_best_path():
    lines = chat.observed([0, 1], ["Q: a b?\nA: fine", "User:"])
    step, n = chat.steps(), chat.N
    score = lambda p: step[chat.START][p[0]] + sum(step[a][b] for a, b in itertools.pairwise(p)) + sum(seen[s] for seen, s in zip(lines, p, strict=True))
    best = max(score(p) for p in itertools.product(range(n), repeat=len(lines)))
    assert score(chat.viterbi(lines)) == best == chat.products(lines)[chat.START].max()
    for enter, leave in ((chat.START, 5), (2, 6)):
        fixed = max(step[enter][p[0]] + score(p) - step[chat.START][p[0]] for p in itertools.product(range(n), repeat=len(lines)) if p[-1] == leave)
        got = chat.viterbi(lines, enter, leave)
        assert step[enter][got[0]] + score(got) - step[chat.START][got[0]] == fixed == chat.products(lines)[enter, leave]


def test_op3(spark):
    """Each style's share of rows with the right role, against a reader that goes by markers alone."""
    rows = chat.format_pieces(chat.raw_pieces(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))).collect()
    style = {r["conv_id"]: r["style"] for r in chat.raw_pieces(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).collect()}
    right, plain, n = Counter(), Counter(), Counter()
    last = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        at = style[r["conv_id"]]
        last[r["conv_id"]] = chat.marker(r["raw"].split("\n")[0])[0] or last.get(r["conv_id"], "user")
        n[at] += 1
        right[at] += r["found_role"] == r["role"] and r["n_begun"] == 1
        plain[at] += last[r["conv_id"]] == r["role"]
    assert sum(n.values()) == spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").count() and set(n) == set(range(7))
    assert all(right[i] >= 0.99 * n[i] for i in (0, 1, 2, 3, 6)), (right, n)
    assert all(right[i] >= 0.85 * n[i] and right[i] > 1.3 * plain[i] for i in (4, 5)), (right, plain, n)


def test_a_conversation_of_any_length_is_one(spark, monkeypatch):
    """Blocks of few rows, dealt in several ways, give the path of the whole transcript."""
    monkeypatch.setattr(chat, "BLOCK", 3)
    rng = np.random.default_rng(5)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", " ".join(["word"] * int(rng.integers(1, 60 if t % 2 else 12)))) for c, n in ((1, 300), (2, 2), (3, 7), (None, 5)) for t in range(n)]
    rows += [(4, 0, "user", "hi")] * 50
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    raw = chat.raw_pieces(df).withColumn("raw", F.concat(F.when(F.col("turn") % 5 == 0, "User: ").otherwise(""), F.col("raw"), F.lit("\n")))
    want = {}
    for c in (1, 2, 3, None, 4):
        texts = [(r["turn"], r["raw"]) for r in sorted(raw.filter(F.col("conv_id").eqNullSafe(F.lit(c))).collect(), key=lambda r: (r["turn"], r["role"], r["raw"]))]
        want[c] = chat.rendered(*map(list, zip(*texts, strict=True)), chat.START, None, True)
    for parts in (1, 7):
        got = {}
        for r in sorted(chat.format_pieces(raw.repartition(parts)).collect(), key=lambda r: (r["turn"], r["role"], r["raw"])):
            got.setdefault(r["conv_id"], []).append((r["found_role"], r["n_begun"], r["rendered"]))
        assert {c: got[c] for c in (1, 2, 3, None)} == {c: want[c] for c in (1, 2, 3, None)} and Counter(got[4]) == Counter(want[4])
    assert "".join(x for _, _, x in want[1]) == chat.render(chat.read_canonical("".join(x for _, _, x in want[1])))


def test_chat_awkward(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, None), (1, 2, None, "who?"), (None, 3, "user", None), (2, 700, "assistant", "x " * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"conv": F.lit(1), "block": F.lit("x"), "at": F.lit(2)})
    got = chat.format_pieces(chat.raw_pieces(df)).collect()
    assert Counter((r["conv_id"], r["turn"], r["role"]) for r in got) == Counter(r[:3] for r in rows)
    assert chat.format_pieces(chat.raw_pieces(df.limit(0))).count() == 0
    whole = chat.format_transcripts(spark.createDataFrame([(1, "User: a\nBot: b"), (2, None), (3, " ")], "k long, transcript string"), "k").collect()
    assert [(r["k"], r["n_turns"], r["roles"]) for r in sorted(whole)] == [(1, 2, "user,assistant"), (2, 0, ""), (3, 0, "")]


# op4


@pytest.fixture(scope="module")
def reference_bpe():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@given(st.text(max_size=60) | st.text(alphabet=" \t\n'sdé漢😀 　\x1c\x85x1", max_size=40))
@settings(max_examples=300, deadline=None)
def test_bpe_equals_tiktoken(reference_bpe, text):
    codec = bpe.codec(RANKS, P.PATTERN)
    ids = codec.encode(text)
    assert ids == reference_bpe.encode_ordinary(text) and codec.decode(ids) == text.encode() and codec.decode_text(ids) == text
    assert [b for _, b in codec.offsets(ids)][-1:] == ([len(text.encode())] if text else [])


def test_bpe_cache_of_any_size(monkeypatch, texts, reference_bpe):
    monkeypatch.setattr(bpe, "CACHE", 50)
    codec = bpe.ByteBPE(RANKS, P.PATTERN)
    assert all(codec.encode(t) == reference_bpe.encode_ordinary(t) for t in list(texts.values())[:20])


def test_bpe_split_characters():
    codec = bpe.codec(RANKS, P.PATTERN)
    ids = codec.encode("漢字😀")
    assert len(ids) > 3 and "�" in codec.decode_text(ids[:1]) and codec.decode(ids[:1]) + codec.decode(ids[1:]) == "漢字😀".encode()


def test_op4(spark, texts, reference_bpe):
    for r in queries.op4_bpe(spark, DIR).collect():
        ids = reference_bpe.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_awkward(spark, awkward):
    got = bpe.round_trip(awkward, RANKS, P.PATTERN).collect()
    assert len(got) == awkward.count() and {r["n_tokens"] for r in got if r["doc_id"] in (3, 4)} == {0}
    back = bpe.decode_documents(bpe.encode_documents(awkward, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == sorted((str(r["doc_id"]), r["text"] or "") for r in awkward.select("doc_id", "text").collect())
    assert bpe.round_trip(awkward.limit(0), RANKS, P.PATTERN).count() == 0


# op5


def test_op5(spark):
    rows = queries.op5_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_quality_awkward(spark, awkward):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (99, 0), (7, 0)], "doc_id long, quality int").withColumn("text", F.lit("x"))
    for given_labels in (labels, labels.limit(0)):
        got = quality.score(awkward, quality.train(awkward, given_labels)).collect()
        assert len(got) == awkward.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got} == {0.5} and quality.score(awkward.limit(0), np.zeros((1 << quality.BITS) + 1, np.float32)).count() == 0


# op6


def test_shares():
    t = mixing.shares([100, 100, 10], [5.0, 2.0, 1.0], 315, 2)
    assert t == [200.0, pytest.approx(95.0), 20.0] and mixing.shares([], [], 0, 2) == []


@given(st.lists(st.tuples(st.integers(0, 9), st.sets(st.integers(0, 2), min_size=1)), min_size=1, max_size=5), st.lists(st.integers(0, 12), min_size=3, max_size=3))
@settings(max_examples=80, deadline=None)
def test_flow_is_greatest(patterns, quotas):
    flow = mixing.min_cost_flow([(n, tuple(s)) for n, s in patterns], quotas, (0, 1))
    per = [sum(f.get(s, 0) for f in flow) for s in range(3)]
    assert all(p <= q for p, q in zip(per, quotas, strict=True)) and all(sum(f.values()) <= 2 * n and set(f) <= s for f, (n, s) in zip(flow, patterns, strict=True))
    # by the cut theorem the flow is the least, over sets of sources, of their room from patterns and the quotas of the others
    cut = min(sum(2 * n for n, s in patterns if s & side) + sum(q for i, q in enumerate(quotas) if i not in side) for k in range(4) for side in map(set, itertools.combinations(range(3), k)))
    assert sum(per) == cut
    # second copies are the least: what the greatest flow has beyond the greatest of first copies alone
    once = min(sum(n for n, s in patterns if s & side) + sum(q for i, q in enumerate(quotas) if i not in side) for k in range(4) for side in map(set, itertools.combinations(range(3), k)))
    assert sum(max(0, sum(f.values()) - n) for f, (n, _) in zip(flow, patterns, strict=True)) == cut - once


def test_flow_of_many_patterns_is_fast():
    import time

    rng = np.random.default_rng(4)
    took = []
    for n in (4000, 16000):
        patterns = [(int(rng.integers(1, 1000)), tuple(sorted(rng.choice(40, rng.integers(1, 5), replace=False).tolist()))) for _ in range(n)]
        began = time.time()
        flow = mixing.min_cost_flow(patterns, [sum(x for x, _ in patterns) // 27] * 40, (0, 1))
        took.append(time.time() - began)
        assert sum(sum(f.values()) for f in flow) > 1.4 * sum(x for x, _ in patterns)
    assert took[1] < 10 * took[0] + 1


def test_op6(spark, texts):
    rows = queries.op6_mixing(spark, "/root/testdata/sf0.01").collect()
    again = queries.op6_mixing(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and all(r["taken"] <= 2 * r["size"] for r in rows)
    taken, target, size = Counter(), {}, {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
    names = sorted(target)
    assert [target[s] for s in names] == pytest.approx(mixing.shares([size[s] for s in names], [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))], 1.5 * sum(size.values()), 2))
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in names)
    assert all(r["size"] == len(word_list(texts[r["doc_id"]])) for r in queries.op6_mixing(spark, DIR).collect())


def test_mixing_fills_past_a_long_document(spark):
    """One text holds half of the words of a source; the flow is met to within the shortest document left, whatever the hash order."""
    for seed in range(8):
        rows = [(i, "a", 50 + i % 40) for i in range(400)] + [(1000, "a", 28_000)]
        df = spark.createDataFrame(rows, "doc_id long, source string, n long")
        got = mixing.mix(df, F.array("source"), F.col("n"), share=0.6, seed=seed).collect()
        lack = got[0]["target"] - sum(r["taken"] for r in got)
        assert 0 <= lack < min((r["size"] for r in got if not r["taken"]), default=1), seed


def test_mixing_awkward(spark, awkward):
    got = mixing.mix(awkward, F.array("source"), mixing.words_of()).collect()
    assert len(got) == awkward.count() and all(r["taken"] <= 2 * r["size"] for r in got) and {r["taken"] for r in got if not r["size"]} == {0}
    both = mixing.mix(awkward.select("doc_id", "text"), F.array(F.lit("a"), F.when(F.col("doc_id") > 6, "b").otherwise("c")), mixing.words_of()).collect()
    named = mixing.mix(awkward.withColumns({"__mix_k": F.lit(1), "__mix_of": F.lit(2)}), F.array("source"), mixing.words_of())
    assert [(c, r[c]) for r in named.collect() for c in ("taken", "__mix_k")] == [x for r in got for x in (("taken", r["taken"]), ("__mix_k", 1))]
    assert len(both) == len(got) and mixing.mix(awkward.limit(0), F.array("source"), mixing.words_of()).count() == 0


# op7


def planted(spark):
    rng = np.random.default_rng(4)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    passage, short = fresh(80), fresh(40)
    fuzzy = [*passage[:30], "changed", *passage[31:55], *passage[56:]]
    rows = [(10, [*fresh(30), *passage, *fresh(30)]), (20, [*fresh(50), *passage, *fresh(9)]), (30, [*fuzzy, *fresh(40)]), (40, fresh(200)), (50, [*fresh(20), *short, *fresh(20)]), (60, [*fresh(20), *short, *fresh(20)]), (70, [*fresh(5), *passage, *fresh(5), *passage])]
    return spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string"), passage


def test_substring_dedup(spark):
    df, passage = planted(spark)
    got = sorted(map(tuple, substring_dedup.repeated_passages(df).collect()))
    assert [(r[0], r[1], r[2], r[4]) for r in got] == [(20, 50, 130, 10), (30, 0, 79, 10), (70, 5, 85, 10), (70, 90, 170, 10)]
    text = {r["doc_id"]: r["text"].split() for r in substring_dedup.drop_repeats(df).collect()}
    before = {r["doc_id"]: r["text"].split() for r in df.collect()}
    assert text[20] == before[20][:50] + before[20][130:] and text[30] == before[30][79:] and all(text[i] == before[i] for i in (10, 40, 50, 60)) and passage[0] not in text[70]


def test_exact_repeats_are_covered(spark, docs, texts):
    got = {}
    for r in substring_dedup.repeated_passages(docs).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["end_word"]))
    first, runs = {}, {}
    for i in sorted(texts):
        w = word_list(texts[i])
        for j in range(len(w) - 59):
            if first.setdefault(tuple(w[j : j + 60]), i) != i:
                runs.setdefault(i, set()).update(range(j + 5, j + 55))
    assert runs and all(len(v - got.get(i, set())) <= 0.02 * len(v) for i, v in runs.items())


@pytest.mark.parametrize("replaced", [0.05, 0.1, 0.15])
def test_fuzzy_passages_are_found(spark, replaced):
    """Passages with words replaced that stay as similar as asked, told by construction: at most a fifth of the words differ."""
    rng = np.random.default_rng(int(replaced * 100))
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    rows, want = [], {}
    for i in range(300):
        n = (60, 80, 120)[i % 3]
        passage = fresh(n)
        changed = list(passage)
        for at in rng.choice(np.arange(1, n - 1), round(replaced * n), replace=False):
            changed[at] = fresh(1)[0]
        rows += [(i, " ".join(fresh(70) + passage + fresh(70))), (1000 + i, " ".join(fresh(70) + changed + fresh(70)))]
        want[1000 + i] = n
    got = Counter()
    for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r["other_id"] == r["doc_id"] - 1000 and r["first_word"] >= 70 and r["end_word"] <= 70 + want[r["doc_id"]] and r["similarity"] >= 0.8
        got[r["doc_id"]] += r["n_words"]
    for n in (60, 80, 120):
        ids = [i for i in want if want[i] == n]
        assert sum(got[i] >= 0.8 * n for i in ids) >= 0.97 * len(ids), (n, sum(got[i] >= 0.8 * n for i in ids))


def test_passage_of_common_seeds_is_found(spark):
    """All seeds of a passage stand in earlier texts, each in another one; the passage itself is in two later texts."""
    rng = np.random.default_rng(6)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    passage = fresh(60)
    rows = [(i, " ".join([*fresh(30), *passage[i : i + 5], *fresh(30)])) for i in range(56)]
    rows += [(100, " ".join([*fresh(20), *passage, *fresh(20)])), (200, " ".join([*fresh(40), *passage, *fresh(5)]))]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["first_word"], r["end_word"], r["other_id"]) for r in got] == [(200, 40, 100, 100)]


def test_a_passage_of_which_parts_stand_in_earlier_texts(spark):
    """Texts before hold the middle, or both overlapping halves, of a passage of 60 words; two later ones hold all of it. All pairs are tried."""
    rng = np.random.default_rng(7)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    rows, want = [], {}
    for i in range(40):
        passage = fresh(60)
        parts = [passage[8:52]] if i % 2 else [passage[:45], passage[15:]]
        rows += [(1000 * i + 10 * j, " ".join([*fresh(30), *part, *fresh(30)])) for j, part in enumerate(parts)]
        rows += [(1000 * i + 500, " ".join([*fresh(20), *passage, *fresh(20)]))]
        # parts stand between the two as well
        rows += [(1000 * i + 510 + j, " ".join([*fresh(9), *part])) for j, part in enumerate(parts)]
        rows += [(1000 * i + 600, " ".join([*fresh(40), *passage, *fresh(5)]))]
        want[1000 * i + 600] = (40, 100, 1000 * i + 500)
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["first_word"], r["end_word"], r["other_id"]) for r in got} == want


def test_every_repeat_of_more_than_50_words_is_covered(spark, docs, texts):
    """Against brute force over all windows of 51 words."""
    got = {}
    for r in substring_dedup.repeated_passages(docs).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["first_word"], r["end_word"]))
    first, runs = {}, {}
    for i in sorted(texts):
        w = word_list(texts[i])
        for j in range(len(w) - 50):
            if first.setdefault(tuple(w[j : j + 51]), i) != i:
                runs.setdefault(i, set()).update(range(j, j + 51))
    assert runs and all(v <= got.get(i, set()) for i, v in runs.items()), [(i, len(v - got.get(i, set()))) for i, v in runs.items() if v - got.get(i, set())]


def test_texts_that_share_a_doc_id(spark):
    rng = np.random.default_rng(9)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    one, two, three = fresh(70), fresh(70), fresh(70)
    rows = [(1, " ".join(["a", *one])), (1, " ".join(["b", *two])), (1, " ".join(["b", *two])), (2, " ".join([*fresh(9), *one])), (2, " ".join([*fresh(9), *three])), (3, " ".join([*two, *fresh(9)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"__passages": F.lit(1), "seed": F.lit("s")})
    assert {(r["doc_id"], r["n_words"], r["other_id"]) for r in substring_dedup.repeated_passages(df).collect()} == {(2, 70, 1), (1, 70, 3)}
    left = Counter((r["doc_id"], len(r["text"].split())) for r in substring_dedup.drop_repeats(df).collect())
    assert left == Counter({(1, 71): 1, (1, 1): 2, (2, 9): 1, (2, 79): 1, (3, 79): 1})


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 3)), unique=True, max_size=40), st.integers(1, 7))
@settings(max_examples=200, deadline=None)
def test_partners_of_seeds(rows, size):
    import pyarrow as pa

    rows = sorted(rows)
    columns = lambda part: [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array([8 * r[2] for r in part], pa.int64())]
    batches = [pa.RecordBatch.from_arrays(columns(rows[a : a + size]), ["seed", "doc", "at"]) for a in range(0, len(rows), size)]
    got = sorted((d, o, xy >> 34, xy >> 2 & 0xFFFFFFFF) for b in substring_dedup._met(iter(batches)) for d, o, xy, _ in zip(*(c.to_pylist() for c in b.columns), strict=True))
    assert got == sorted(partners_of(rows))


def partners_of(rows):
    out = []
    for s, d, p in rows:
        before = [r for r in rows if r[0] == s and r[1] < d]
        if before:
            last = next(r for r in before if r[1] == before[-1][1])
            out += [(d, r[1], p, r[2]) for r in {before[0], last}]
    return out


def test_frequent_seeds_dealt_by_ranges_have_the_same_partners(spark):
    rng = np.random.default_rng(10)
    rows = sorted({(64 * int(s), int(d), int(p)) for s, d, p in zip(rng.integers(0, 4, 3000), rng.integers(0, 500, 3000), rng.integers(0, 9, 3000), strict=True)})
    seeds = spark.createDataFrame([(*r, 0) for r in rows], "seed long, doc long, pos int, kind byte")
    for hot in ([], [64, 192]):
        got = substring_dedup.partners(seeds, seeds.filter(F.col("seed").isin(hot)), F.broadcast(spark.createDataFrame([(h,) for h in hot], "hot long")), None, Scratch(spark)).collect()
        assert sorted((r["doc"], r["other"], r["xy"] >> 34, r["xy"] >> 2 & 0xFFFFFFFF) for r in got) == sorted(partners_of(rows))


@given(st.lists(st.integers(0, 5), max_size=25), st.lists(st.integers(0, 5), max_size=25))
@settings(max_examples=200, deadline=None)
def test_alignment_is_a_longest_one(a, b):
    pairs = substring_dedup.aligned(a, b)
    assert len(pairs) == substring_dedup.common(a, b) and all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(pairs))


@given(st.lists(st.integers(0, 5), max_size=25), st.lists(st.integers(0, 5), max_size=25))
@settings(max_examples=200, deadline=None)
def test_common_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert substring_dedup.common(a, b) == best[-1][-1]


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=1, max_size=9, unique=True))
@settings(max_examples=150, deadline=None)
def test_chains_are_the_best(anchors):
    seg = np.array([(x, x + 3, y, y + 3, 3) for x, y in anchors])
    gain = lambda c: sum(seg[i][4] for i in c) - 0.25 * sum(seg[j][0] - seg[i][1] + seg[j][2] - seg[i][3] for i, j in itertools.pairwise(c))
    fits = lambda c: all(seg[i][1] <= seg[j][0] and seg[i][3] <= seg[j][2] for i, j in itertools.pairwise(c))
    found = substring_dedup.chains(seg, 0.25)
    best = max(gain(c) for k in range(1, len(seg) + 1) for s in itertools.combinations(range(len(seg)), k) for c in [sorted(s, key=lambda i: tuple(seg[i]))] if fits(c))
    assert sorted(i for c in found for i in c) == list(range(len(seg))) and all(map(fits, found)) and math.isclose(gain(found[0]), best)


def test_substring_awkward(spark, awkward):
    out = substring_dedup.drop_repeats(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[8] == "end" and text[3] is None and text[4] == ""
    assert substring_dedup.drop_repeats(awkward.limit(0)).count() == 0 and substring_dedup.repeated_passages(awkward.limit(0)).count() == 0


# op8


def test_op8(spark, texts):
    rows = queries.op8_lm(spark, DIR).collect()
    counts = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*word_list(t), None])
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        tokens = [*word_list(texts[r["doc_id"]]), None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(w in counts for w in tokens), n) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens), rel_tol=1e-9)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_head_size_does_not_matter(spark, docs):
    vocabulary = set(bpe.read_ranks(RANKS))
    score = lambda head: {r["doc_id"]: (r["n_known"], round(r["score"], 6), round(r["base_score"], 6)) for r in lm.score_texts(docs, F.col("doc_id") % 5 != 1, vocabulary, head=head, steps=5, bound=50).collect()}
    assert score(10) == score(1 << 18)


def test_subwords_and_training_take_all_texts(spark, monkeypatch):
    """A word that stands in none of the few texts of the start is a subword, and every training token teaches."""
    rows = [(i, " ".join(["common"] * 5 if i % 50 else ["rarely", "seen"] * 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counted, held = [], []
    choose, train = lm.choose_subwords, lm.train_on_all
    monkeypatch.setattr(lm, "choose_subwords", lambda *a: held.append(choose(*a)) or held[-1])
    monkeypatch.setattr(lm, "train_on_all", lambda *a: counted.append((a[3], train(*a))) or counted[-1][1])
    monkeypatch.setattr(lm, "SHARD", 50)
    monkeypatch.setattr(lm, "SHARE", 1)
    vocabulary = {b"common", b"rarely", b"seen", b"se", b"Common", b"absent"}
    got = lm.score_texts(df, F.lit(True), vocabulary, steps=3, bound=1).collect()
    assert len(got) == 400 and held[0].n == 2 + 3 + 4  # three whole words; common, rarely, seen and se begin words
    text = b"common rarely seen sea other"
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    h, ids, _ = lm._tokens(data, offsets, held[0])
    starts, ends, _ = words.bounds(data, offsets)
    assert held[0].ids_of(h, np.append(lm.beginnings(data, starts, ends), 0)).tolist() == ids.tolist() and (ids == 0).sum() == 1
    start, model = counted[0]
    inputs, wanted, weight, _ = lm.windows(np.tile(lm._tokens(*(lambda x: (np.frombuffer(x, np.uint8), np.array([0, len(x)])))(b"rarely seen " * 40), held[0])[1], 1), np.array([81]), held[0].n)
    assert (model.log10(inputs, wanted) * weight).sum() > (start.log10(inputs, wanted) * weight).sum()


def test_every_training_text_teaches(spark, monkeypatch):
    """With the module's own settings the shards hold all tokens of all training texts, each once."""
    monkeypatch.setattr(lm, "SHARD", 50)
    teach = spark.range(400).selectExpr("id as doc_id", "repeat('common word ', cast(id % 7 as int)) as text")
    subwords, cuts, cut = lm.Subwords(Counter({b"common": 1}), Counter()), [], Scratch.cut
    monkeypatch.setattr(Scratch, "cut", lambda self, df: cuts.append(cut(self, df)) or cuts[-1])
    start = lm.Attention(subwords.n, np.full(subwords.n, 1 / subwords.n))
    model = lm.train_on_all(teach, 400, subwords, start, Scratch(spark))
    assert sum(r["n"] for r in cuts[0].collect()) == sum(2 * (i % 7) + 1 for i in range(400)) and cuts[0].count() == 8
    assert not np.allclose(model.flat(), start.flat())


def test_attention_is_causal_and_its_gradient_right():
    m = lm.Attention(12, np.full(12, 1 / 12))
    rng = np.random.default_rng(0)
    ids, counts = rng.integers(0, 12, 75), np.array([75])
    inputs, wanted, weight, _ = lm.windows(ids, counts, 12)
    assert weight.sum() == 75 and wanted[weight > 0].tolist() == ids.tolist()
    first = m.log10(inputs, wanted)
    changed = inputs.copy()
    changed[0, -1] = (changed[0, -1] + 1) % 12
    assert np.allclose(m.log10(changed, wanted)[0, :-1], first[0, :-1])
    every = np.stack([m.log10(inputs[:1], np.full((1, lm.HALF), i)) for i in range(12)])
    assert np.allclose((10**every).sum(axis=0), 1, atol=1e-4)
    loss = lambda: -(m.log10(inputs, wanted) * np.log(10) * weight).sum() / weight.sum()
    g = m.gradients(inputs, wanted, weight)
    for name in m.p:
        m.p[name] = m.p[name].astype(np.float64)
    for name in ("E", "P", "q", "k", "v", "o", "w1", "w2", "out", "b"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = m.p[name][at]
        m.p[name][at] = old + 1e-4
        up = loss()
        m.p[name][at] = old - 1e-4
        down = loss()
        m.p[name][at] = old
        assert math.isclose((up - down) / 2e-4, g[name][at], rel_tol=0.05, abs_tol=1e-4), name


def test_lm_awkward(spark, awkward):
    vocabulary = {b"the", b"w"}
    for training in (F.lit(True), F.lit(False), F.lit(None).cast("boolean")):
        got = lm.score_texts(awkward, training, vocabulary, steps=2).collect()
        assert len(got) == awkward.count() and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got) and {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1}
    assert lm.score_texts(awkward.limit(0), F.lit(True), vocabulary, steps=1).count() == 0


# op9


def test_op9(spark):
    rows = queries.op9_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held) and sum(r["rejected"] for r in rows) <= 0.01 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_kneser_ney_sums_to_one():
    m = language_id.KneserNey(Counter(t[i : i + 3] for t in ("  abc abd ", "  bca abc ") for i in range(len(t) - 2)), 3)
    for context in ("", "a", "ab", "c ", "zz"):
        seen = sum(m.p(context + c) for c in " abcd")
        assert seen < 1 + 1e-9 and (context == "zz" or math.isclose(seen + m.gamma(context) * (m.gamma(context[1:]) if len(context) == 2 else 1) * (m.gamma("") if context else 1) / m.size, 1, rel_tol=1e-6) or seen > 0.5)


def test_tables_equal_the_model():
    texts = {"x": ["abc abd bca cab abc"], "y": ["zxy xyz yzx zyx"]}
    counts = {}
    for k, ts in texts.items():
        s = [" " * 2 + language_id.normal(t).tobytes().decode("utf-32-le") for t in ts]
        counts[k] = Counter(t[i : i + 4] for t in s for i in range(len(t) - 3))
    t, models = language_id.Tables(counts, 4), {k: language_id.KneserNey(c, 4) for k, c in counts.items()}
    ce, n = t.entropies(["abd zyq", "qqq"])
    for row, text in enumerate(["abd zyq", "qqq"]):
        s = "   " + text + " "
        want = [-sum(math.log2(models[k].p(s[i - 3 : i + 1])) for i in range(3, len(s))) / (len(s) - 3) for k in t.langs]
        assert n[row] == len(s) - 3 and np.allclose(ce[row], want, atol=1e-4)


def test_language_awkward(spark, awkward):
    for given_docs in (awkward, awkward.limit(0)):
        tables = language_id.train(given_docs)
        got = language_id.identify(awkward, tables).collect()
        assert len(got) == awkward.count() and {r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 5)} == {"und"} and all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got} == {"und"} and language_id.keep_identified(awkward.limit(0), tables).count() == 0


# op10


@pytest.mark.parametrize("tile", [512, 3])
def test_minhash_dedup(spark, docs, texts, tile):
    got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(docs, percent=85, tile=tile).collect()}
    s = sets(texts)
    links = [(a, b) for a, b in itertools.combinations(s, 2) if s[a] and 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b])]
    want = groups(s, links)
    assert links and all(r["n_shingles"] == len(s[i]) and r["component_id"] == want[i] and r["kept"] == (want[i] == i) for i, r in got.items())


def test_large_group_of_near_copies(spark):
    """Copies of one text, each with other words changed: many pairs are below the threshold, but all hang together."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for at in rng.choice(120, rng.integers(0, 4), replace=False):
            w[at] = f"c{i}_{at}"
        rows.append((1000 - i, " ".join(w)))
    texts = dict(rows)
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85, tile=8).collect()}
    s = sets(texts)
    assert got == groups(s, [(a, b) for a, b in itertools.combinations(s, 2) if 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b])])


def test_minhash_awkward(spark, awkward):
    got = sorted(((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(awkward, percent=80).collect()), key=str)
    by = {g[0]: g for g in got}
    assert len(got) == awkward.count() and by["2"][2] == by["1"][2] == 1 and by["8"][2] == 7 and by["3"][1:] == (0, 3, True) and by["6"][1:] == (1, 6, True) and by["None"][2:] == (None, True)
    assert minhash_dedup.near_duplicates(awkward.limit(0)).count() == 0


# pipeline


def test_pipeline(spark, docs, texts, reference_bpe, tmp_path):
    now = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, DIR).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        kept[name] = now.collect()
        if name != "byte_level_bpe":
            assert sorted(now.columns) == sorted(docs.columns)
    s = sets({r["doc_id"]: r["text"] for r in kept["language_id"]})
    want = groups(s, [(a, b) for a, b in itertools.combinations(s, 2) if s[a] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])])
    assert sorted(r["doc_id"] for r in kept["minhash_near_dedup"]) == sorted(i for i in s if want[i] == i)
    assert [r["doc_id"] for r in sorted(kept["substring_dedup"])] == [r["doc_id"] for r in sorted(kept["minhash_near_dedup"])]
    mixed, whole = Counter(), {r["doc_id"]: r for r in kept["substring_dedup"]}
    for r in kept["mixing"]:
        assert r["text"] == whole[r["doc_id"]]["text"]
        mixed[r["doc_id"]] += 1
    assert max(mixed.values()) <= 2 and len(kept["byte_level_bpe"]) == len(kept["mixing"])
    digest = Counter(hashlib.sha256(" ".join(map(str, reference_bpe.encode_ordinary(r["text"]))).encode()).hexdigest() for r in kept["mixing"])
    assert Counter(r["ids_sha256"] for r in kept["byte_level_bpe"]) == digest
    assert sorted(map(tuple, corpus_pipeline.run(spark, DIR).collect())) == sorted(map(tuple, kept["byte_level_bpe"]))


def test_texts_that_share_a_doc_id_are_kept_unless_near(spark):
    other = " ".join(f"o{i}" for i in range(120))
    rows = [(1, TEXT * 3, "en", "a", 1), (1, other, "en", "a", 2), (1, other + " more", "en", "a", 3), (1, other, "en", "b", 2), (2, " ".join(f"p{i}" for i in range(90)), "en", "a", 4), (2, other + " x", "en", "a", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for given_docs in (df, df.orderBy(F.desc("n_chars"))):
        got = corpus_pipeline.near_dedup_stage(spark, given_docs, DIR).collect()
        assert sorted((r["doc_id"], r["n_chars"], r["source"]) for r in got) == [(1, 1, "a"), (1, 2, "a"), (2, 4, "a")]


def test_stages_on_awkward_rows(spark, awkward, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward, DIR).count() >= 0, name
        assert stage(spark, awkward.limit(0), DIR).count() == 0, name
