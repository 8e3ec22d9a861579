"""Working memory of a document: characters, events and what is planted and revealed, folded over its segments in order.

In batch, one document is one ordered group (its size is that of the document); in a stream the same fold runs on keyed state.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from fabulon.functions.similarity import alias_similarity, best_match
from fabulon.llm.words import groups

MOST_ALIASES, CUT, SAME_EVENT, KNOWN = 10, 50, 0.75, 0.5
FIRST_PERSON = "我"
TRIGGERS = {"激励事件", "上升行动", "转折", "高潮", "结局"}


@dataclass
class Scratchpad:
    """State of one document."""

    characters: dict[str, dict] = field(default_factory=dict)
    events: list[dict] = field(default_factory=list)
    items: list[dict] = field(default_factory=list)

    def add_character(self, name: str, segment: int | None = None, aliases: tuple[str, ...] = (), description: str = "") -> dict:
        name = name.strip()
        c = self.characters.setdefault(name, {"canonical_name": name, "aliases": [], "pending": [], "first_segment": segment, "last_segment": segment, "description": "", "mention_count": 0, "related_events": []})
        for a in aliases:
            self.add_alias(name, a)
        if description and len(description) <= CUT:
            c["description"] = description
        if segment is not None:
            c["mention_count"] += 1
            c["last_segment"] = segment
        return c

    def find(self, name: str) -> dict | None:
        return self.characters.get(name) or next((c for c in self.characters.values() if name in c["aliases"]), None)

    def add_alias(self, name: str, alias: str) -> None:
        c = self.characters[name]
        if alias != name and alias not in c["aliases"] and len(c["aliases"]) < MOST_ALIASES:
            c["aliases"].append(alias)

    def similar(self, name: str, least: float = KNOWN) -> str | None:
        scores = [(max(alias_similarity(name, x) for x in (k, *c["aliases"])), -i, k) for i, (k, c) in enumerate(self.characters.items())]
        best = max(scores, default=None)
        return best[2] if best and best[0] >= least else None

    def confirm(self, name: str, alias: str, yes: bool) -> None:
        c = self.characters[name]
        if alias in c["pending"]:
            c["pending"].remove(alias)
            if yes:
                self.add_alias(name, alias)

    def add_event(self, text: str, segment: int, who: tuple[str, ...] = (), kind: str = "") -> dict:
        text = text[:CUT]
        if alike := best_match([e["description"] for e in self.events], text, SAME_EVENT):
            e = self.events[alike[1]]
            e["segment"] = segment
            e["involved"] = sorted({*e["involved"], *who})
        else:
            e = {"event_id": f"evt_{len(self.events) + 1:03d}", "description": text, "segment": segment, "involved": sorted(who), "kind": kind, "status": "open"}
            self.events.append(e)
        for w in who:
            if w in self.characters and e["event_id"] not in self.characters[w]["related_events"]:
                self.characters[w]["related_events"].append(e["event_id"])
        return e

    def close(self, text: str) -> None:
        """Close the latest planted event that holds the start of the text, else the latest one."""
        planted = [e for e in self.events if e["kind"] == "plant" and e["status"] == "open"]
        hit = [e for e in planted if text[:10] in e["description"]] or planted
        if hit:
            hit[-1]["status"] = "closed"

    def close_event(self, event_id: str) -> bool:
        for e in self.events:
            if e["event_id"] == event_id:
                e["status"] = "closed"
                return True
        return False

    def open_events(self) -> list[dict]:
        return [e for e in self.events if e["status"] == "open"]

    def describe(self, name: str, text: str) -> None:
        """Set the description of a known character, cut to its limit."""
        if c := self.find(name):
            c["description"] = text[:CUT]

    def undescribed(self, least: int = 3, short: int = 10) -> list[str]:
        """Names mentioned often whose description is still short."""
        return [k for k, c in self.characters.items() if c["mention_count"] >= least and len(c["description"]) < short]

    def add_item(self, name: str, segment: int, note: str = "") -> dict:
        """A thing of the story with the notes on what it means, in the order met."""
        item = self.find_item(name)
        if item is None:
            item = {"name": name.strip(), "first_segment": segment, "last_segment": segment, "notes": []}
            self.items.append(item)
        item["last_segment"] = segment
        if note and note not in item["notes"]:
            item["notes"].append(note)
        return item

    def find_item(self, name: str) -> dict | None:
        return next((i for i in self.items if i["name"] == name.strip()), None)

    def bind_first_person(self, segment: int) -> None:
        """The narrator's "I" becomes an alias of the most mentioned (then earliest) character, once for each such character."""
        if not self.characters:
            return
        c = max(self.characters.values(), key=lambda c: (c["mention_count"], -(c["first_segment"] or 0)))
        if FIRST_PERSON not in (*c["aliases"], c["canonical_name"]):
            c["aliases"] = [*c["aliases"], FIRST_PERSON][:MOST_ALIASES]
            c["mention_count"] += 1
            c["last_segment"] = segment

    def resolve(self, segment: int) -> str | None:
        """Whom a pronoun means: near and often mentioned; the first of equals."""
        best = None
        for name, c in self.characters.items():
            score = 0.6 * max(0.0, 1 - (segment - (c["last_segment"] or 0)) / 20) + 0.4 * min(c["mention_count"] / 10, 1.0)
            if best is None or score > best[0]:
                best = (score, name)
        return best[1] if best else None

    def step(self, segment: int, target: str | None, speakers: tuple[str, ...], d01: str | None, d06: str | None, text: str) -> None:
        """Take in one segment: people first, then events, then what is planted or revealed."""
        named = dict.fromkeys(x.strip() for x in (target, *speakers) if x and x.strip())
        for name in (x for x in named if x != FIRST_PERSON):
            if self.find(name):
                self.add_character(self.find(name)["canonical_name"], segment)
            elif (near := self.similar(name)) and name not in self.characters[near]["pending"] and near != name and alias_similarity(name, near) < 1 and len(name) > 2:
                self.characters[near]["pending"].append(name)
            else:
                self.add_character(name, segment)
        if FIRST_PERSON in named:
            self.bind_first_person(segment)
        here = tuple(k for k, c in self.characters.items() if segment in (c["first_segment"], c["last_segment"]))
        if d01 in TRIGGERS:
            self.add_event(f"{d01}: {text[:40]}", segment, here, "plot")
        if d06 == "隐藏":
            self.add_event(text[:30], segment, here, "plant")
        elif d06 == "揭示":
            self.close(text[:30])

    def summary(self, most: int = 15, limit: int = 1200) -> str:
        """Characters by mentions and the last events, halved until the text fits."""
        people = sorted(self.characters.values(), key=lambda c: -c["mention_count"])[:most]
        out = "; ".join(f"{c['canonical_name']}({c['mention_count']})" for c in people) + " | " + "; ".join(e["description"] for e in self.events[-20:])
        return self.summary(most // 2, limit) if len(out) > limit and most > 1 else out

    def statistics(self) -> dict[str, int]:
        return {"characters": len(self.characters), "events": len(self.events), "open": sum(e["status"] == "open" for e in self.events), "pending": sum(len(c["pending"]) for c in self.characters.values())}

    def dump(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)

    @classmethod
    def load(cls, text: str) -> Scratchpad:
        return cls(**json.loads(text))


SCHEMA = "doc_id long, n_characters long, n_events long, n_open long, n_pending long, summary string"


#: Documents of a batch that a task gives back.
BATCH = 1000


def values_of(doc: int, pad: Scratchpad) -> dict:
    s = pad.statistics()
    return {"doc_id": doc, "n_characters": s["characters"], "n_events": s["events"], "n_open": s["open"], "n_pending": s["pending"], "summary": pad.summary()}


def row_of(doc: int, pad: Scratchpad) -> pd.DataFrame:
    return pd.DataFrame([values_of(doc, pad)])


def fold(rows: DataFrame) -> DataFrame:
    """One row for each document from rows (doc_id, idx, emo_tgt, s1, d01, d06, txt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for group in groups(batches, 1):
            pad = Scratchpad()
            doc, *columns = (c.to_pylist() for c in group.columns)
            for idx, emo_tgt, s1, d01, d06, txt in zip(*columns, strict=True):
                pad.step(int(idx), emo_tgt, (s1,), d01, d06, txt)
            out.append(values_of(int(doc[0]), pad))
            if len(out) == BATCH:
                yield pa.RecordBatch.from_pylist(out)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out)

    # documents in a row within a task: a group of pandas for each of them costs more than its fold
    return rows.select("doc_id", "idx", "emo_tgt", "s1", "d01", "d06", "txt").repartition("doc_id").sortWithinPartitions("doc_id", "idx").mapInArrow(run, SCHEMA)


def stream_step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The fold for applyInPandasWithState: rows of a micro-batch in order on the state of their document."""
    pad = Scratchpad.load(state.get[0]) if state.exists else Scratchpad()
    for r in pd.concat(list(batches)).sort_values("idx").itertuples():
        pad.step(int(r.idx), r.emo_tgt, (r.s1,), r.d01, r.d06, r.txt)
    state.update((pad.dump(),))
    yield row_of(int(key[0]), pad)
