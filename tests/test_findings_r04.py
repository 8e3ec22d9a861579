"""Findings of round 4: whole texts are measured, not their beginnings."""

import random

import duckdb
import pytest

from fabulon.operators import gate
from fabulon.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def made() -> list[str | None]:
    """Texts of over 5,000 characters that repeat themselves only later, or only before, and awkward ones."""
    rng = random.Random(4)
    fresh = "".join(chr(rng.randint(0x100, 0x1100)) for _ in range(6000))
    passage = "All of this is said again and again, and then once more. "
    return [fresh + passage * 150, passage * 90 + fresh * 2, passage * 90 + "".join(rng.sample(fresh, 6000)), fresh[:4000] + "\n\n" + fresh[4000:] + "🙂" * 7000, fresh[:5000], fresh[:5004] + "abcde" * 2, "abcdef", "abcde", "abcd", " \n\n ", "", None]


@pytest.mark.parametrize("name", ["qg_repetition", "qg_gram_repetition", "qg_verdict"])
def test_long_texts_are_as_in_the_sql(spark, tmp_path, name):
    spark.createDataFrame(list(enumerate(made())), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    df, rel = QUERIES[name](spark, str(tmp_path)), con.execute(SQL[name])
    assert df.columns == [c[0] for c in rel.description]
    assert sorted(map(tuple, df.collect())) == sorted(rel.fetchall())


def test_repetition_is_that_of_the_whole_text(spark):
    assert "5000" not in SQL["qg_repetition"]  # F1
    texts = made()
    got = {r.doc_id: r for r in gate.repetition(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, text in enumerate(texts):
        grams = [text[j : j + 5] for j in range(len(text) - 4)] if text else []
        share = 1 - len(set(grams)) / len(grams) if len(grams) > 1 else 0.0
        assert got[i].ratio == pytest.approx(share, abs=6e-4)
    assert [got[i].status for i in range(2)] == ["fail", "fail"] and got[0].ratio > 0.5


def test_grams_of_long_texts_are_counted_in_parts(monkeypatch):
    texts = [t or "" for t in made()]
    whole = gate.distinct_grams(texts, 5).tolist()
    for places in (0, 5, 12000, 20000):
        monkeypatch.setattr(gate, "PLACES", places)
        assert gate.distinct_grams(texts, 5).tolist() == whole
