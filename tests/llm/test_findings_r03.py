"""Findings of round 3: each of these failed before its mending."""

from collections import Counter

import numpy as np
import pyarrow as pa

from fabulon.llm import lm, substring_dedup
from fabulon.llm.scratch import Scratch


def test_scoring_takes_few_windows_at_a_time(monkeypatch):
    subwords = lm.Subwords(Counter({b"a": 1}), Counter())
    seen, log10 = [], lm.Attention.log10
    monkeypatch.setattr(lm.Attention, "log10", lambda self, ids, wanted: seen.append(len(ids)) or log10(self, ids, wanted))
    model = lm.Model(subwords, lm.Attention(subwords.n, np.full(subwords.n, 1 / subwords.n)), np.zeros(0, np.uint64), np.zeros(0), {}, 0, 0)
    shared = type("Shared", (), {"value": model})
    rows = list(lm._scored(shared)(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b " * 3000])], ["row", "text"])])))
    assert sum(seen) == 376 and max(seen) <= lm.BATCH and sum(b.num_rows for b in rows) == 3 + 1


def seeds_of(rows):
    """A maker of given seeds: (doc, text) -> (seed, doc, pos, kind), with the seeds of a text at its places."""

    def run(batches):
        for batch in batches:
            own = [(s, d, p, 0) for d in batch.column(0).to_pylist() for s, e, p in rows if e == d]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in own], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int8()))], ["seed", "doc", "pos", "kind"])

    return run


def test_short_seeds_are_dealt_in_buckets(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = sorted({(64 * int(s), int(d), int(p)) for s, d, p in zip(rng.integers(-9, 9, 4000), rng.integers(0, 300, 4000), rng.integers(0, 9, 4000), strict=True)})
    want = []
    for s, d, p in rows:
        if before := [r for r in rows if r[0] == s and r[1] < d]:
            want += [(d, o, p, q) for o, q in {before[0][1:], next(r for r in before if r[1] == before[-1][1])[1:]}]
    text = spark.createDataFrame([(d, "x") for d in range(300)], "doc long, text string")
    for hot in ([], [64, 192]):
        often = spark.createDataFrame([(*r, 0) for r in rows if r[0] in hot], "seed long, doc long, pos int, kind byte")
        got = substring_dedup.short_partners(text, seeds_of(rows), often, np.array(hot, dtype=np.int64), [20, 50, 51, 200] if hot else [], Scratch(spark)).collect()
        assert sorted((r["doc"], r["other"], r["xy"] >> 34, r["xy"] >> 2 & 0xFFFFFFFF) for r in got) == sorted(want)
    made = list(substring_dedup._dealt(seeds_of(rows), np.zeros(0, np.int64), np.zeros(0, np.int64), 8)(iter([pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(["x"] * 300)], ["doc", "text"])])))
    assert sum(b.num_rows for b in made) <= 8 and sum(len(x) // 8 for b in made for x in b.column(1).to_pylist()) == len(rows)


def test_frequent_seeds_are_not_joined(spark):
    seeds = spark.createDataFrame([(64, d, 1, 1) for d in range(5000)] + [(640, 1, 3, 1), (640, 9, 4, 1)], "seed long, doc long, pos int, kind byte")
    found = substring_dedup.counted_partners(seeds, Scratch(spark))
    assert found.count() == 4999 + 4998 + 1  # of the two, a text after the first meets both, and the second text the first only


def test_stretches_and_alignment_of_long_runs():
    a = list(range(200))
    b = [*a[:70], -1, *a[71:150], -2, -3, *a[150:]]
    pairs = substring_dedup.aligned(a, b)
    assert [x for x, _ in pairs] == [x for x in a if x != 70] and substring_dedup.stretches(pairs, 0.8) == [(0, 200, 0, 202, 199 / 202)] and substring_dedup.stretches([], 0.8) == []
