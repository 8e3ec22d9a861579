"""Relations by rule against a fold, samples under any partitioning, nested annotations at any depth, and files read in parts."""

import json
import random

from pyspark.sql import functions as F

from fabulon.operators import nested, relations, sampling
from fabulon.sources import readers


def fold(rows, window=15):
    """The rules one after the other over one document's rows in order, the first of equal relations kept."""
    found, out = [], {}
    for (i0, a), (i1, b) in zip(enumerate(rows), list(enumerate(rows))[1:]):
        if a["inten"] is not None and b["inten"] is not None and abs(a["inten"] - b["inten"]) >= 4:
            found.append((i0, i1, "时序", "rule"))
    for i in range(1, len(rows)):
        if rows[i]["sw"] == 0 and rows[i - 1]["persp"] and rows[i]["persp"] and rows[i - 1]["persp"] != rows[i]["persp"]:
            found.append((i - 1, i, "对比", "rule"))
    places = {}
    for i, r in enumerate(rows):
        for t in r["themes"] or []:
            if t:
                places.setdefault(t, []).append(i)
    found += [(a, b, "呼应", "rule") for at in places.values() for k, a in enumerate(at) for b in at[k + 1 :] if a < b <= a + window]
    for name, longest in (("emo_tgt", 20), ("images", 30)):
        seen = {}
        for i, r in enumerate(rows):
            for x in [r[name]] if name == "emo_tgt" else r[name] or []:
                if x and len(x) <= longest:
                    seen.setdefault(x, []).append(i)
        found += [(a, b, "呼应", "rule_enhanced") for at in seen.values() for a, b in zip(at, at[1:])]
    plants = []
    for i, r in enumerate(rows):
        if r["d06"] == "隐藏":
            plants.append(i)
        elif r["d06"] == "揭示" and plants:
            found.append((plants.pop(), i, "伏笔-回收", "rule_enhanced"))
    for a, b, relation, source in found:
        out.setdefault((rows[a]["idx"], rows[b]["idx"], relation), source)
    return {(*k, s) for k, s in out.items()}


SCHEMA = "doc_id long, idx long, inten long, sw long, persp string, themes array<string>, emo_tgt string, images array<string>, d06 string"


def test_rules_equal_a_fold(spark):
    rnd = random.Random(11)
    docs = {}
    for d in range(25):
        some = lambda *xs: rnd.choice(xs)
        docs[d] = [
            {"doc_id": d, "idx": 3 * i + rnd.randint(0, 2), "inten": some(None, 1, 3, 5, 9), "sw": some(0, 1, None), "persp": some("a", "b", None), "themes": some(None, [], ["x"], ["y", "x"], ["x", "x", ""]), "emo_tgt": some(None, "", "ann", "t" * 21, "bob"), "images": some(None, ["m"], ["m", "m"], ["i" * 31, None]), "d06": some(None, "隐藏", "揭示", "z")}
            for i in range(rnd.choice([0, 1, 2, 30]))
        ]
    rows = [tuple(r.values()) for rs in docs.values() for r in rs]
    rnd.shuffle(rows)
    got = relations.rule_relations(spark.createDataFrame(rows, SCHEMA))
    by_doc = {}
    for r in got.collect():
        by_doc.setdefault(r["doc_id"], []).append((r["src"], r["tgt"], r["relation"], r["source"]))
    for d, rs in docs.items():
        assert sorted(by_doc.get(d, [])) == sorted(fold(rs)), d
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan ExistingRDD") == 1
    assert relations.rule_relations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sample_is_the_same_for_any_partitioning(spark):
    rows = spark.range(5000).selectExpr("id", "case when id % 10 = 0 then null when id % 3 = 0 then 'a' else 'b' end as s", "id % 100 as x")
    found = [sorted(r["id"] for r in sampling.stratified(rows.repartition(n), ["s"], ["id"], 40, seed=5, parts=p).collect()) for n, p in ((1, 64), (7, 1), (31, 3))]
    assert found[0] == found[1] == found[2] and len(found[0]) == 120
    assert sorted(r["id"] for r in sampling.stratified(rows, ["s"], ["id"], 40, seed=6).collect()) != found[0]
    by = sampling.stratified(rows, ["s"], ["id"], F.when(F.col("s") == "a", 10000).otherwise(0))
    assert by.filter("s = 'a'").count() == by.count() == rows.filter("s = 'a'").count()
    same = spark.createDataFrame([("a", 1)] * 30, "s string, id int")
    assert sampling.stratified(same, ["s"], ["id"], 7).count() == 7
    assert sampling.stratified(rows.limit(0), ["s"], ["id"], 5).count() == 0
    shares = {r["s"]: (r["n"], r["taken"], r["weight"]) for r in sampling.shares(rows, ["s"], sampling.stratified(rows, ["s"], ["id"], 40)).collect()}
    assert shares[None] == (500, 40, 12.5)


def brute_flat(value, path="$"):
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in brute_flat(v, f"{path}.{k}")]
    if isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in brute_flat(v, f"{path}[{i}]")]
    return [(path, json.dumps(value, ensure_ascii=False) if value in ([], {}) else value)]


def random_json(rnd, level=0):
    kind = rnd.random()
    if level > 6 or kind < 0.35:
        return rnd.choice(["", "a\"b]\\", "{x", "é\n", 5, True, False, None, -3, [], {}])
    if kind < 0.65:
        return [random_json(rnd, level + 1) for _ in range(rnd.randint(0, 3))]
    return {k: random_json(rnd, level + 1) for k in rnd.sample(["a", "source", "text_span", "text", "cross_refs_sources", "原文x", "b c", "sourc"], rnd.randint(0, 4))}


def plain(v):
    return None if v is None else str(v).lower() if isinstance(v, bool) else str(v)


def test_nested_values_equal_a_walk(spark):
    rnd = random.Random(12)
    values = [random_json(rnd) for _ in range(150)] + [[[[[[[[[[[["deep"]]]]]]]]]]]]
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)] + [(900, "{bad"), (901, None), (902, "")], "idx long, raw string")
    got = sorted(((r["idx"], r["path"], r["value"]) for r in nested.flattened(rows).collect()), key=repr)
    assert got == sorted(((i, p, plain(x)) for i, v in enumerate(values) for p, x in brute_flat(v)), key=repr)
    depth = lambda v: 1 + max(map(depth, v.values() if isinstance(v, dict) else v), default=0) if isinstance(v, (dict, list)) else 0
    assert [r[0] for r in rows.filter("idx < 900").orderBy("idx").select(nested.depth(F.col("raw"))).collect()] == [depth(v) for v in values]
    assert nested.flattened(rows.limit(0)).count() == 0


def test_redaction_rules(spark):
    value = {"source": {"deep": [1]}, "a": [{"cross_refs_sources": ["x"], "text": "stays"}], "text_span": {"text": "四个字符", "start": 1, "source": "kept"}, "b": {"text_span": {"text": None}, "raw_text_2": 1, "text_span2": {"text": "stays"}}, "原文": None, "Source": 3}
    rows = spark.createDataFrame([(1, json.dumps(value)), (2, "[1]"), (3, "no"), (4, None), (5, "{}"), (6, '{"a": ' + "[" * 5000 + "]" * 5000 + "}")], "idx long, raw string")
    got = {r["idx"]: (r["raw"], r["hidden_keys"]) for r in nested.redacted(rows).collect()}
    h = nested.HIDDEN
    assert json.loads(got[1][0]) == {"source": h, "a": [{"cross_refs_sources": h, "text": "stays"}], "text_span": {"text": h, "start": 1, "source": "kept", "char_length": 4}, "b": {"text_span": {"text": h}, "raw_text_2": h, "text_span2": {"text": "stays"}}, "原文": h, "Source": 3}
    assert got[1][1] == {"source": 1, "cross_refs_sources": 1, "text_span": 2, "raw_text_2": 1, "原文": 1}
    assert got[2] == got[3] == got[4] == (None, None) and got[5] == ("{}", {})
    summary = {(r["kind"], r["name"]): r["n"] for r in nested.export_summary(nested.redacted(rows.filter("idx < 6"))).collect()}
    assert summary[("lines", "total")] == 5 and summary[("lines", "skipped")] == 3 and summary[("document", "__unknown_doc__")] == 2 and summary[("hidden", "text_span")] == 2


def test_files_read_in_parts_give_the_same_text(spark, tmp_path):
    rnd = random.Random(13)
    lines = []
    for i in range(4000):
        lines.append(rnd.choice([json.dumps({"text_span": {"text": f"span {i}"}, "text": "no"}), json.dumps({"text": f"text {i}"}), json.dumps({"text_span": {"text": ""}, "content": f"content {i}"}), "", "{broken", json.dumps({"other": 1})]))
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.jsonl").write_text("\n")

    def text(line):
        try:
            x = json.loads(line)
        except ValueError:
            return None
        return (x.get("text_span") or {}).get("text") or x.get("text") or x.get("content")

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        got = readers.joined_lines(spark, str(tmp_path))
        assert got.count() and spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert {r["path"].rsplit("/", 1)[1]: r["text"] for r in got.collect()} == {"a.jsonl": "\n\n".join(t for t in map(text, lines) if t), "b.jsonl": ""}
    finally:
        spark.conf.set(key, before)


def test_terms_of_one_section(spark, tmp_path):
    (tmp_path / "t.md").write_text("# all\n| **zero** | x |\n## one: words\n| **a** | x |\n### inner\n| **b** |\n| c |\n## two\n| **d** |\n# words again\n| **e** | y |\n## sub\n| **f** |\n# last\n| **g** |\n")
    words = lambda section=None: sorted(r[0] for r in readers.markdown_terms(spark, str(tmp_path), section).collect())
    assert words() == list("abdefg") + ["zero"] and words("words") == ["a", "b", "e", "f"] and words("^## two") == ["d"] and words("none") == []
