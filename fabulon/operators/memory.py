"""What a document's working memory takes from all layers of its segments: people by every way in which they are named, events, and what is planted and revealed.

One segment after the other is taken in, on the state of its document (Scratchpad). In batch a document is one ordered group; in a stream its state is kept by
key, and rows of a micro-batch are taken in order of idx. Both give the same memory as long as a later batch holds no earlier segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from fabulon.llm.words import groups

from .scratchpad import BATCH, CUT, Scratchpad

# fixed values: pronouns, things that are no person, turning functions, prefixes of templates
THIRD = ("他", "她", "它", "他们", "她们", "它们", "此人", "该人", "这人", "那人")
FIRST = ("我", "我们", "咱", "咱们", "自己", "本人")
BARE = ("我", "你", "他", "她", "它", "我们", "你们", "他们", "她们")
THINGS = (
    "家产", "财产", "钱", "房子", "土地", "家", "牛", "城市", "世界", "命运", "生活", "时间", "枪", "车", "音乐", "牢笼", "锁链", "勾当", "梦", "记忆", "爱情", "友谊",
    "荣誉", "责任", "自由", "权力", "真相", "秘密", "人生", "夜晚", "灵魂", "名字", "身份", "选择", "未来", "希望", "声音", "影子", "光",
)
TURNS = ("激励事件", "高潮", "转折", "下降行动", "结局")
PREFIXES = ("本段揭示了关键信息：", "本段隐藏了关键信息：", "本段揭露了关键信息：", "揭示了关键信息：", "隐藏了关键信息：", "关键信息：")
STAGES = {"隐藏": "埋设", "埋设": "埋设", "揭示": "揭露", "揭露": "揭露"}
SENTENCE, CONTENT, PEOPLE, EVENTS, PENDING, CHARS = 40, 30, 15, 20, 3, 1200
QUOTES = "\"'“” "


def _first_sentence(text: str, ends: str) -> str:
    """Up to the first place, past the beginning, of the first of the ends that the text has."""
    at = next((i for i in (text.find(e) for e in ends) if i > 0), None)
    return text if at is None else text[: at + 1]


class Memory(Scratchpad):
    """Scratchpad with the rules of the layers."""

    def suspect(self, name: str, alias: str) -> None:
        c = self.find(name)
        if alias not in c["pending"]:
            c["pending"].append(alias)

    def seen(self, c: dict, segment: int) -> None:
        c["last_segment"] = segment
        c["mention_count"] += 1

    def meet(self, name: str, segment: int, again: bool = True) -> None:
        """A known name counts (if `again`), one that is like a known one waits for an answer, any other is a new character."""
        known = self.find(name)
        if known:
            if again:
                self.seen(known, segment)
        elif near := self.similar(name):
            self.suspect(near, name)
        else:
            self.add_character(name, segment)

    def people(self, segment: int, target: str, secondary: list[str], voices: list[str], speakers: list[str]) -> None:
        if target in THIRD:
            if who := self.resolve(segment):
                self.suspect(who, target)
        elif target in FIRST:
            if near := self.similar(target):
                self.suspect(near, target)
        elif target and not target.startswith(THINGS):
            self.meet(target, segment)
        for name in filter(None, secondary):
            self.meet(name, segment, again=False)
        for name in filter(None, voices):
            if name not in THIRD:
                self.meet(name, segment)
            elif who := self.resolve(segment):
                self.suspect(who, name)
                self.seen(self.find(who), segment)
        for name in speakers:
            if name and name not in BARE:
                self.meet(name, segment)
        if "我" in (target, *speakers):
            self.bind_first_person(segment)

    def turn(self, segment: int, d01: str | None, mood: str, strength: int, text: str) -> None:
        """An event for a turning function: its first sentence, or without a text its mood."""
        if d01 not in TURNS:
            return
        said = _first_sentence(text.strip().strip(QUOTES), "。！？").replace("\r", " ").replace("\n", " ").strip().strip(QUOTES)[:SENTENCE]
        what = f"{d01}：{said}" if said else f"{d01}（{mood}，强度{strength}）" if mood and not text.strip() else d01
        here = tuple(k for k, c in self.characters.items() if segment in (c["first_segment"], c["last_segment"]))
        self.add_event(what[:CUT], segment, here, d01)

    def information(self, segment: int, d06: str | None, content: str) -> None:
        """What is planted and what is revealed; a reveal closes the latest plant of another segment that holds its beginning, else the latest one."""
        stage = STAGES.get(d06 or "")
        if not stage:
            return
        prefix = next((p for p in PREFIXES if content.startswith(p)), "")
        content = _first_sentence(content[len(prefix) :], "。！？；").strip()[:CONTENT]
        event = self.add_event(f"信息{stage}：{content}"[:CUT], segment, (), f"信息{stage}")
        if stage == "揭露":
            plants = [e for e in self.events if e["kind"] == "信息埋设" and e["segment"] != segment]
            told = [e for e in plants if content[:10] and content[:10] in e["description"]] or plants
            if told:
                told[-1]["status"] = "closed"
                event["description"] = f"{event['description']}（回收自{told[-1]['event_id']}）"[:CUT]

    def take(self, row: dict) -> None:
        """Take in one segment: people, events, information."""
        clean = lambda v: (v or "").strip()
        names = lambda v: [clean(x) for x in (v if v is not None else [])]
        segment = int(row["idx"])
        self.people(segment, clean(row["target"]), names(row["secondary"]), names(row["voices"]), names(row["speakers"]))
        self.turn(segment, row["d01"], clean(row["mood"]), 0 if pd.isna(row["strength"]) else int(row["strength"]), row["txt"] or "")
        self.information(segment, row["d06"], row["content"] or "")

    def outline(self, segment: int, most: int = PEOPLE) -> str:
        """The memory as lines for a prompt: people by mentions, the last events, what waits for an answer, and whom a description lacks. Fewer people if it is too long."""
        people = sorted(self.characters.values(), key=lambda c: -c["mention_count"])[:most]
        who = lambda c: f"- {c['canonical_name']}" + (f"（别名：{'、'.join(c['aliases'][:5])}）" if c["aliases"] else "") + f"：{c['description'] or '出场{}次'.format(c['mention_count'])}"
        lines = [f"【便签本摘要 - 处理到第 {segment} 段】"]
        if people:
            lines += ["已知人物：", *map(who, people)]
        if self.events:
            lines += ["已知事件：", *(f"- {e['event_id']}（{e['segment']}）" + (f"[{e['kind']}]" if e["kind"] else "") + f"：{e['description']}" for e in self.events[-EVENTS:])]
        open_ = [f"{a}/{c['canonical_name']} 是否为同一人物？" for c in self.characters.values() for a in c["pending"]]
        if open_:
            lines.append("待确认：" + "；".join(open_[:PENDING]))
        if bare := self.undescribed(least=5):
            lines.append("提示：以下人物需要生成描述：" + ", ".join(bare[:PENDING]))
        text = "\n".join(lines)
        return self.outline(segment, max(3, most // 2)) if len(text) > CHARS and most > 5 else text


INPUT = ["doc_id", "idx", "target", "secondary", "voices", "speakers", "d01", "mood", "strength", "txt", "d06", "content"]
SCHEMA = "doc_id long, last_idx long, n_characters long, n_events long, n_open long, n_pending long, outline string"


def _values(doc: int, last: int, m: Memory) -> dict:
    s = m.statistics()
    return {"doc_id": doc, "last_idx": last, "n_characters": s["characters"], "n_events": s["events"], "n_open": s["open"], "n_pending": s["pending"], "outline": m.outline(last)}


def _fold(m: Memory, rows: list[dict]) -> int:
    last = 0
    for row in rows:
        m.take(row)
        last = int(row["idx"])
    return last


def remembered(rows: DataFrame) -> DataFrame:
    """(doc_id, last_idx, numbers.., outline) of each document of the rows (INPUT): names are strings or arrays of them, null or empty where a segment has none. Rows without idx
    are left out; of a repeated segment each row is taken in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for group in groups(batches, 1):
            m, held = Memory(), group.to_pylist()
            out.append(_values(int(held[0]["doc_id"]), _fold(m, held), m))
            if len(out) == BATCH:
                yield pa.RecordBatch.from_pylist(out)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out)

    # documents in a row within a task: a group of pandas for each of them costs more than its fold
    known = rows.select(*INPUT).filter(F.col("doc_id").isNotNull() & F.col("idx").isNotNull())
    return known.repartition("doc_id").sortWithinPartitions("doc_id", "idx").mapInArrow(run, SCHEMA)


def running(stream: DataFrame) -> DataFrame:
    """remembered after each micro-batch of a stream of rows."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        m = Memory.load(state.get[0]) if state.exists else Memory()
        last = _fold(m, pd.concat(list(batches)).sort_values("idx", kind="stable").to_dict("records"))
        state.update((m.dump(),))
        yield pd.DataFrame([_values(int(key[0]), last, m)])

    return stream.select(*INPUT).filter(F.col("doc_id").isNotNull() & F.col("idx").isNotNull()).groupBy("doc_id").applyInPandasWithState(step, SCHEMA, "pad string", "update", GroupStateTimeout.NoTimeout)
