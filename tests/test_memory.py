"""The memory's rules one by one, and the stream against the batch."""

from pyspark.sql import functions as F

from fabulon.operators import memory
from fabulon.operators.memory import Memory
from fabulon.plans.custom import layer_rows
from fabulon.plans.fixture import annotated

DIR = "/root/testdata/sf0.001"


def row(idx, **given):
    return dict.fromkeys(memory.INPUT) | {"idx": idx} | given


def test_people():
    m = Memory()
    m.take(row(1, target="他", voices=["她"], speakers=["我", "你"]))
    assert not m.characters  # nobody whom a pronoun could mean
    m.take(row(2, target="福贵", secondary=["家珍", ""], speakers=["有庆", None]))
    assert list(m.characters) == ["福贵", "家珍", "有庆"] and all(c["mention_count"] == 1 for c in m.characters.values())
    m.take(row(3, target=" 福贵 ", secondary=["家珍"]))
    assert m.characters["福贵"]["mention_count"] == 2 and m.characters["家珍"]["mention_count"] == 1 and m.characters["家珍"]["last_segment"] == 2
    m.take(row(4, target="他"))
    assert m.characters["福贵"]["pending"] == ["他"] and m.characters["福贵"]["mention_count"] == 2 and m.characters["福贵"]["last_segment"] == 3
    m.take(row(5, voices=["她"]))
    assert m.characters["福贵"]["pending"] == ["他", "她"] and m.characters["福贵"]["mention_count"] == 3 and m.characters["福贵"]["last_segment"] == 5
    m.take(row(6, target="家产没了"))
    m.take(row(6, target="我们"))
    assert list(m.characters) == ["福贵", "家珍", "有庆"]
    m.take(row(7, target="徐福贵"))
    assert "徐福贵" in m.characters["福贵"]["pending"] and "徐福贵" not in m.characters
    m.take(row(8, speakers=["我"]))
    assert m.characters["福贵"]["aliases"] == ["我"] and m.characters["福贵"]["mention_count"] == 4
    assert "待确认：他/福贵 是否为同一人物？；她/福贵 是否为同一人物？；徐福贵/福贵 是否为同一人物？" in m.outline(8)


def test_events_and_information():
    m = Memory()
    m.take(row(1, target="福贵", d01="转折", txt="“福贵输了。 他走了！”", mood="悲伤", strength=8))
    m.take(row(2, d01="高潮", txt=" ", mood="愤怒", strength=9))
    m.take(row(3, d01="上升行动", txt="nothing"))
    assert [e["description"] for e in m.events] == ["转折：福贵输了。", "高潮（愤怒，强度9）"] and m.events[0]["involved"] == ["福贵"] and m.characters["福贵"]["related_events"] == ["evt_001"]
    m.take(row(4, d06="隐藏", content="本段隐藏了关键信息：一把旧钥匙藏在谷仓里的那个故事实在是很长很长。后来"))
    m.take(row(5, d06="埋设", content="完全是另外的一件事情，与前文无关"))
    m.take(row(6, d06="揭示", content="揭示了关键信息：一把旧钥匙藏在谷仓里；还有"))
    plant, other, told = m.events[2:]
    assert plant["description"] == "信息埋设：一把旧钥匙藏在谷仓里的那个故事实在是很长很长。" and plant["status"] == "closed" and other["status"] == "open"
    assert told["kind"] == "信息揭露" and told["description"] == "信息揭露：一把旧钥匙藏在谷仓里；（回收自evt_003）"
    m.take(row(7, d06="揭露", content="谁也不知道的新消息传来了"))
    assert other["status"] == "closed" and Memory.load(m.dump()) == m


def test_outline_is_cut_to_its_length():
    m = Memory()
    for i in range(30):
        m.add_character(f"人物{i:02d}号" + chr(0x4E00 + i) * 8, i, description="长" * 50)
        m.add_event(chr(0x5000 + i) * 45, i)
    assert len(m.outline(30)) > memory.CHARS and m.outline(30).count("长长") < 30 * 25
    few = Memory()
    for i in range(20):
        few.add_character(chr(0x4E00 + 40 * i) * 3, i, description=chr(0x5000 + i) * 50)
    assert sum(line.startswith("- ") for line in few.outline(1).splitlines()) == 15 and few.outline(1).startswith("【便签本摘要 - 处理到第 1 段】")


def test_stream_equals_batch_on_shuffled_rows(spark, tmp_path):
    rows = layer_rows(annotated(spark, DIR)).filter("doc_id < 6")
    for part, keep in enumerate(("idx < 5", "idx >= 5")):
        rows.filter(keep).orderBy(F.xxhash64("doc_id", "idx")).coalesce(1).write.parquet(f"{tmp_path}/in/p{part}")
    want = sorted(map(tuple, memory.remembered(rows).collect()))
    name = "memory_all"
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    memory.running(stream()).writeStream.outputMode("update").format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    found = {}
    for r in spark.table(name).collect():
        if r["doc_id"] not in found or r["last_idx"] >= found[r["doc_id"]]["last_idx"]:
            found[r["doc_id"]] = r
    assert sorted(map(tuple, found.values())) == want
