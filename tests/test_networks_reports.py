"""Components against a search, edges against all pairs, and a report for each of many documents."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from fabulon.operators import network
from fabulon.plans.fixture import annotated
from fabulon.sources import reports

DIR = "/root/testdata/sf0.001"


def test_components_equal_a_search(spark):
    rnd = random.Random(21)
    links = [(d, f"n{a:03d}", f"n{b:03d}") for d in (1, 2) for a, b in [(i, i + 1) for i in range(40)] + [(rnd.randint(50, 140), rnd.randint(50, 140)) for _ in range(60)]] + [(3, "x", None), (3, "x", "x"), (None, "p", "q"), (1, "n001", "n000")]
    near = defaultdict(set)
    for d, a, b in links:
        if a and b and a != b:
            near[d, a].add((d, b))
            near[d, b].add((d, a))
    want = {}
    for start in sorted(near, key=lambda k: (str(k[0]), k[1])):
        todo = [start] if start not in want else []
        while todo:
            k = todo.pop()
            if k not in want:
                want[k] = start[1]
                todo += near[k]
    got = {(r["doc_id"], r["name"]): r["component"] for r in network.components(spark.createDataFrame(links, "doc_id long, a string, b string")).collect()}
    assert got == {k: v for k, v in want.items() if k[0] is not None}
    assert network.components(spark.createDataFrame([], "doc_id long, a string, b string")).count() == 0


def test_presence_by_alias(spark):
    rows = spark.createDataFrame([(1, 0, "ann here"), (1, 1, "annie"), (1, 2, None), (1, 3, "bob"), (2, 0, "ann")], "doc_id long, idx long, txt string")
    known = spark.createDataFrame([(1, 0, "ann"), (1, 3, "bob")], "doc_id long, idx long, who string")
    expected = spark.createDataFrame([(1, "ann", 2), (1, "bob", 1)], "doc_id long, who string, n_segments long")
    aliases = spark.createDataFrame([(1, "ann", "ann"), (1, "ann", ""), (1, "bob", "annie")], "doc_id long, who string, alias string")
    assert sorted(map(tuple, network.presence(known, expected, aliases, rows).collect())) == [(1, 0, "ann"), (1, 1, "ann"), (1, 3, "bob")]


def test_a_report_for_each_document(spark, tmp_path):
    a = annotated(spark, DIR)
    extra = spark.createDataFrame([(0, "a <b>", 0, "x|y\nz", '"q" & r')], "doc_id long, section string, rank long, name string, value string")
    n = a.select("doc_id").distinct().count()
    for style, ending in reports.FILES.items():
        index = reports.write(reports.composed(a, extra, style), str(tmp_path / style), style)
        assert index.count() == n and len(list((tmp_path / style).glob(f"document-*.{ending}"))) == n and not list((tmp_path / style).glob(".[0-9a-f]*[0-9a-f]"))
        assert {r["file"]: r["bytes"] for r in index.collect()} == {p.name: p.stat().st_size for p in (tmp_path / style).glob("document-*")}
    page = (tmp_path / "html" / "document-0.html").read_text()
    mine = a.filter("doc_id = 0").orderBy("idx").collect()
    assert page.count("<li>") == len(mine) and page.count("<polyline") == 3 and "a &lt;b&gt;" in page and "&quot;q&quot; &amp; r" in page
    values = [r["inten"] for r in mine]
    low, span = min(values), max(values) - min(values) or 1
    assert " ".join(f"{i * 600 / max(len(values) - 1, 1):.1f},{120 - (v - low) / span * 120:.1f}" for i, v in enumerate(values)) in page
    text = (tmp_path / "markdown" / "document-0.md").read_text()
    assert f"{len(mine)} segments" in text and '| x/y z | "q" & r |' in text and text.count("\n- ") == len(mine)
    # again, with one row less: the files are those of the new run
    again = reports.write(reports.composed(a.filter("not (doc_id = 0 and idx = 0)"), None, "markdown"), str(tmp_path / "markdown"), "markdown")
    assert again.count() == n and f"{len(mine) - (mine[0]['idx'] == 0)} segments" in (tmp_path / "markdown" / "document-0.md").read_text()
    assert reports.composed(a.limit(0)).count() == 0


def test_nodes_share_of_the_most_mentioned(spark):
    rows = spark.createDataFrame([(1, 0, "a"), (1, 0, "a"), (1, 1, "b"), (1, 2, "a")], "doc_id long, idx long, who string")
    assert sorted(map(tuple, network.nodes(rows).collect())) == [(1, "a", 3, 2, 1.0), (1, "b", 1, 1, 0.333)]
    assert network.nodes(rows.filter(F.lit(False))).count() == 0
