"""SentencePiece encoding and decoding by a table of distinct chunks.

Where no piece has a white space marker behind another character, a merge never joins what stands before a run of markers with the
run. A text is then a row of chunks, each a run of markers and what follows up to the next run, and its ids are those of its chunks
in order. Every task keeps a table of the distinct chunks it met: a chunk is segmented by the library once, with its ids and the text
that they decode to, and texts are joined with the table by position. The table has TABLE chunks at most in two generations, of which
the older is dropped; what comes out does not depend on it. A model with other pieces, or one that changes texts before it encodes
them, is encoded text by text.

The table is one of a task and not of the corpus: to bring ids back to their places by a join would shuffle a row for each word of the
corpus twice, more than the texts themselves, while a task needs less than a microsecond for a word that it knows.

Null text counts as empty: no ids, no text. A text of any length is encoded whole. Repeated rows, null doc_ids and other columns, also of
clashing names, do no harm: only doc_id and text are read, and every row gives one row. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import trimmed
from .bpe import _two

MARK = "▁"
TABLE = 300_000
_CHUNK = re.compile(" +[^ ]*")


def chunks(text: str) -> list[str]:
    """The chunks of a text, written with spaces and without their first marker: the text is them, joined by single spaces."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    # only two spaces in a row, or one at an end, make a chunk with more markers than one or with nothing else
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [c[1:] for c in _CHUNK.findall(" " + text)]


class Pieces:
    """Encoder and decoder of one model file, with its table of chunks: ids as text, and decoded text with its first space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        sample = "  a ﬁ １ é  b "
        plain = self.model.decode(self.model.encode(sample)) == sample and self.model.decode(self.model.encode("a")) == "a"
        self.apart = plain and self.model.piece_to_id(MARK) != self.model.unk_id() and not any(re.search(f"[^{MARK}]{MARK}", n) for n in names)
        self.number = [str(i) for i in range(len(names))]
        # what an id decodes to by itself; bytes from 0x80 on, which decode together, and ids that decode to nothing have none
        own = lambda i: not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i))
        self.text = {i: n.replace(MARK, " ") for i, n in enumerate(names) if own(i)}
        self.text |= {i: chr(int(n[3:5], 16)) for i, n in enumerate(names) if self.model.is_byte(i) and int(n[3:5], 16) < 0x80}
        self.front = self.model.encode("a")
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def segment(self, found: list[str]) -> list[list[int]]:
        """The ids of chunks. The library puts a marker before what it encodes, which is the chunk's first; of a lone marker it makes nothing."""
        ids = self.model.encode(found, num_threads=1)
        return [i if c else [self.model.piece_to_id(MARK)] for c, i in zip(found, ids, strict=True)]

    def _decoded(self, ids: list[int]) -> str:
        """What ids decode to behind others: the library takes a space off the front."""
        try:
            return "".join(map(self.text.__getitem__, ids))
        except KeyError:
            return self.model.decode([*self.front, *ids])[1:]

    def _learn(self, new: list[str]) -> None:
        if len(self.known) + len(new) > TABLE // 2:
            self.older, self.known = self.known, {}
        back = [c for c in new if c in self.older]
        for c in back:
            self.known[c] = self.older[c]
        if back:
            new = [c for c in new if c not in self.older]
        for c, i in zip(new, self.segment(new), strict=True):
            self.known[c] = (",".join(map(self.number.__getitem__, i)), self._decoded(i))

    def rows(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """For each text the number of its ids, the ids joined by commas, and what they decode to."""
        if not self.apart:
            for t in texts:
                ids = self.model.encode(t)
                yield len(ids), ",".join([self.number[i] for i in ids]), self.model.decode(ids)
            return
        split = [chunks(t) for t in texts]
        first = [list(map(self.known.get, s)) for s in split]
        new = dict.fromkeys(c for s, found in zip(split, first, strict=True) if None in found for c, x in zip(s, found, strict=True) if x is None)
        before = self.known
        if new:
            self._learn(list(new))
        table = self.known
        for s, found in zip(split, first, strict=True):
            if None in found:
                found = [x or table.get(c) or before[c] for c, x in zip(s, found, strict=True)]
            ids = ",".join([x[0] for x in found])
            yield ids.count(",") + 1 if ids else 0, ids, "".join([x[1] for x in found])[1:]

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.rows([text]) for i in ids.split(",") if i]

    def forget(self) -> None:
        self.known, self.older = {}, {}


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """One for each Python worker and model file."""
    return Pieces(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, n_tokens): the ids of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                ids = [[int(i) for i in found.split(",") if i] for _, found, _ in model.rows([t or "" for t in part.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([len(i) for i in ids], pa.int64())], ["doc_id", "ids", "n_tokens"])
        model.forget()

    return _two(docs).mapInArrow(trimmed(run), "doc_id long, ids array<int>, n_tokens long")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); byte ids that are no UTF-8 become U+FFFD. Null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path).model
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x if x is None else model.decode(x) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(trimmed(run), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the decimal ids, joined by commas, and of the text that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        for batch in batches:
            found = []
            for lo in range(0, batch.num_rows, 64):
                found += [(n, digest(ids), digest(text)) for n, ids, text in model.rows([t or "" for t in batch.column(1).slice(lo, 64).to_pylist()])]
            n, ids, text = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        model.forget()

    return _two(docs).mapInArrow(trimmed(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
