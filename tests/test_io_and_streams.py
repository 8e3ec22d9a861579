import json

from pyspark.sql import functions as F

from fabulon.operators import graph, joins, scratchpad
from fabulon.plans import fixture
from fabulon.sources import readers, writers
from fabulon.streaming import events, ingest

DIR = "/root/testdata/sf0.001"


def test_readers(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a.txt").write_bytes("第一章\r\n你好".encode("gbk"))
    (tmp_path / "t/b.txt").write_bytes("café".encode())
    assert sorted(r["text"] for r in readers.texts(spark, str(tmp_path / "t")).collect()) == ["café", "第一章\n你好"]
    (tmp_path / "x.jsonl").write_text('{"a":1}\n\nnot json\n{"a":2}\n')
    assert sorted(r["a"] for r in readers.json_lines(spark, str(tmp_path / "x.jsonl"), "a int").collect()) == [1, 2]
    assert readers.json_document(spark, str(tmp_path / "none.json"), "a int").count() == 0
    for i, body in enumerate(['{"k":1}', '[{"k":2},{"k":3}]', '{"k":4}\nbad\n{"k":5}']):
        (tmp_path / f"in{i}.json").write_text(body)
    assert sorted(json.loads(r["raw"])["k"] for r in readers.annotations(spark, str(tmp_path / "in*.json")).collect()) == [1, 2, 3, 4, 5]
    (tmp_path / "m.md").write_text("| **喜悦** | joy |\n| x | y |\n")
    assert [r["word"] for r in readers.markdown_terms(spark, str(tmp_path / "m.md")).collect()] == ["喜悦"]
    (tmp_path / "lex.json").write_text(json.dumps({"words": [{"w": "好", "pos": "adj", "cls": ["PH"], "int": 5, "pol": 1}]}))
    assert readers.lexicon(spark, str(tmp_path / "lex.json")).first()["pol"] == 1 and readers.lexicon(spark, str(tmp_path / "no.json")).count() == 0


def test_client_failures_are_rows(spark):
    prompts = spark.createDataFrame([(1, 0, "a"), (1, 1, "bb")], "doc_id long, idx long, prompt string")
    assert [r["ok"] for r in readers.annotate(prompts, readers.mock_client).collect()] == [True, True]
    assert [r["ok"] for r in readers.annotate(prompts, lambda p: 1 / 0).collect()] == [False, False]


def test_progress_and_report(spark):
    ann = fixture.annotated(spark, DIR)
    some = ann.filter("doc_id < 3").select("doc_id", "idx")
    table = writers.progress_table(some)
    done = writers.marked(table, table.filter("layer = 'craft'"))
    assert done.filter("done").count() == some.count()
    undone, phases = writers.reset(done, "craft")
    assert undone.filter("done").count() == 0 and phases == ("merge", "report")
    assert "<svg" in writers.report(ann, 1) and writers.report(ann, 1, "markdown").startswith("# Document 1")


def test_stack_pairs_equal_a_fold(spark):
    ann = fixture.annotated(spark, DIR)
    want = []
    for _, rows in ann.select("doc_id", "idx", "d06").toPandas().sort_values(["doc_id", "idx"]).groupby("doc_id"):
        stack = []
        for r in rows.itertuples():
            if r.d06 == "隐藏":
                stack.append(r.idx)
            elif r.d06 == "揭示" and stack:
                want.append((r.doc_id, stack.pop(), r.idx))
    assert sorted(map(tuple, joins.paired_last_in(ann).collect())) == sorted(want)


def test_top_chains(spark):
    edges = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 0)], "doc_id long, src long, tgt long")
    found = graph.top_chains(graph.chains(edges), 2).collect()
    assert [r["path"] for r in sorted(found, key=lambda r: r["rank"])] == ["0>1>2", "1>2>0"]


def test_stream_equals_batch(spark, tmp_path):
    e = spark.read.parquet(f"{DIR}/events.parquet")
    e.repartition(3).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "events"))
    q = events.by_user(stream).writeStream.outputMode("complete").format("memory").queryName("by_user").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("by_user").collect())) == sorted(map(tuple, events.by_user(e).collect()))


def test_ingest_resumes_and_upserts(spark, tmp_path):
    schema = "doc_id long, idx long, arrival long, v string"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    rows((1, 0, 1, "a"), (1, 1, 1, "b"), (1, 0, 2, "a2")).coalesce(1).write.mode("append").parquet(src)
    stream = lambda: spark.readStream.schema(schema).parquet(src)
    ingest.ingest(stream(), out, check).awaitTermination()
    rows((1, 1, 3, "b2"), (2, 0, 3, "c")).coalesce(1).write.mode("append").parquet(src)
    ingest.ingest(stream(), out, check).awaitTermination()
    assert sorted((r["doc_id"], r["idx"], r["v"]) for r in ingest.current(spark, out).collect()) == [(1, 0, "a2"), (1, 1, "b2"), (2, 0, "c")]


def test_running_memory(spark, tmp_path):
    rows = fixture.annotated(spark, DIR).filter("doc_id < 5").select("doc_id", "idx", "emo_tgt", "s1", "d01", "d06", "txt")
    rows.coalesce(1).write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
    q = ingest.running_memory(stream).writeStream.outputMode("update").format("memory").queryName("pads").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("pads").collect())) == sorted(map(tuple, scratchpad.fold(rows).collect()))
    assert rows.agg(F.count_distinct("doc_id")).first()[0] == spark.table("pads").count()


def test_report_has_all_sections(spark):
    rows = spark.createDataFrame([(1, i, "高潮", 5 + i, 3, "positive", "tag<b>" if i else "a|b") for i in range(3)], "doc_id long, idx long, d01 string, inten int, pace int, pol string, t1 string")
    text, page = writers.report(rows, 1, "markdown"), writers.report(rows, 1)
    assert "## functions" in text and "| 高潮 | 3 |" in text and "| a/b | 1 |" in text and "## places" not in text
    assert page.count("<svg") == 3 and "tag&lt;b&gt;" in page and "tag<b>" not in page
    assert writers.report(rows, 9).count("<td>") == 0


def test_empty_tables_give_empty_results(spark):
    from fabulon.operators import layers, portrait, techniques

    rows = spark.createDataFrame([], "doc_id long, idx long, d01 string, d06 string, persp string, sw int, time string, txt string, raw string")
    for out in (techniques.narrative_style(rows), techniques.time_structure(rows), techniques.beat_signals(rows), techniques.structure_health(rows), layers.structure(rows), layers.emotion(rows)):
        assert out.count() == 0
    said = spark.createDataFrame([], "doc_id long, idx long, item int, who string, pattern string, verb string, turn int")
    assert portrait.voices(said).count() == portrait.decisions(said).count() == 0


def test_layers_of_broken_rows(spark):
    from fabulon.operators import layers

    texts = [None, "", "not json", "{}", '{"layers": null}', '{"layers": {"structure": {"D04": {"intensity": 7.0}, "D08": "spring"}}}', '{"emotion": {"target": "' + "x" * 21 + '"}}']
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc_id long, idx long, raw string")
    assert all(r["d01"] is None and r["switch"] is False for r in layers.structure(rows).collect())
    assert all(r["emo"] is None and r["emo_tgt"] is None for r in layers.emotion(rows).collect())
    assert [r[0] for r in rows.select(layers.kind()).collect()] == ["unknown"] * 5 + ["structure", "emotion"]
