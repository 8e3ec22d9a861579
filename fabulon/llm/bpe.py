"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The ranks of a public vocabulary file give the vocabulary and the merges; the 256 bytes are written as the printable
characters of the byte-level scheme, and offsets count bytes of the text. Each match of the split pattern is encoded by
itself, so that a match that was met before is taken from a cache of bounded size; what comes out does not depend on it.

Null text counts as empty: no ids, no bytes. A text of any length is encoded whole. Repeated rows and other columns, also
of clashing names, stay as they are: only doc_id and text are read, and every row gives one row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from .batches import small_batches, trimmed

CACHE = 150_000


def byte_chars() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair that each rank joins: the two parts that are left when only lower ranks may merge."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            if ranks.get(parts[best] + parts[best + 1], rank) >= rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


class ByteBPE:
    """Encoder and decoder for one file of ranks and one split pattern."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        chars = byte_chars()
        self.table = str.maketrans({b: c for b, c in enumerate(chars)})
        self.back = {c: b for b, c in enumerate(chars)}
        word = lambda x: x.decode("latin-1").translate(self.table)
        self.model = Tokenizer(models.BPE(vocab={word(t): r for t, r in ranks.items()}, merges=[(word(a), word(b)) for a, b in merges_of(ranks)], cache_capacity=0))
        self.bytes_of = {i: bytes(self.back[c] for c in t) for t, i in self.model.get_vocab().items()}
        self.split = regex.compile(pattern).findall
        self.ranks = ranks
        self.size = np.array([len(self.bytes_of.get(i, b"")) for i in range(max(ranks.values()) + 1)])
        self.number = [str(i) for i in range(max(ranks.values()) + 1)]
        # what is known of a match: number of ids, ids as text, bytes; of two generations the older is dropped
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def _ids(self, raw: list[bytes]) -> list[list[int]]:
        """The ids of matches, of which none is empty. The byte 0xFF is in no UTF-8 text and parts them."""
        chars = b"\xff".join(raw).decode("latin-1").translate(self.table).split(self.table[0xFF])
        ids = self.model.encode_batch_fast([chars], is_pretokenized=True, add_special_tokens=False)[0].ids
        # offsets: the ids of a match end where its bytes end
        cuts = [0, *(np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(r) for r in raw])) + 1).tolist()]
        # a match that is a token as a whole is that token
        return [[self.ranks[r]] if r in self.ranks else ids[a:b] for r, a, b in zip(raw, cuts, cuts[1:], strict=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that the cache lacks; each is decoded again from its ids."""
        if len(self.known) + len(pieces) > CACHE:
            self.older, self.known = self.known, {}
        back = [p for p in pieces if p in self.older]
        for p in back:
            self.known[p] = self.older[p]
        new = [p for p in pieces if p not in self.older] if back else pieces
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            for piece, ids in zip(part, self._ids([p.encode() for p in part]), strict=True):
                self.known[piece] = (len(ids), " ".join([self.number[i] for i in ids]), self.decode(ids))

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def pieces(self, texts: list[str]) -> Iterator[list[tuple[int, str, bytes]]]:
        """What is known of each match in each text. Matches that are new are learned together for all the texts."""
        found = [self.split(t) for t in texts]
        first = [list(map(self.known.get, f)) for f in found]
        new = dict.fromkeys(p for f, known in zip(found, first, strict=True) if None in known for p, x in zip(f, known, strict=True) if x is None)
        before = self.known
        if new:
            self._learn(list(new))
        more = self.known
        for f, known in zip(found, first, strict=True):
            yield [x or more.get(p) or before[p] for p, x in zip(f, known, strict=True)] if None in known else known

    def encode(self, text: str) -> list[int]:
        return [int(i) for found in self.pieces([text]) for x in found for i in x[1].split()]

    def offsets(self, ids: list[int]) -> list[tuple[int, int]]:
        """The range of bytes of the text that each id covers; characters may be split between ids."""
        out, at = [], 0
        for i in ids:
            out.append((at, at := at + len(self.bytes_of[i])))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_text(self, ids: list[int], errors: str = "replace") -> str:
        """Text of the ids; a character of which only some bytes are there becomes U+FFFD."""
        return self.decode(ids).decode("utf-8", errors)


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> ByteBPE:
    """One codec for each Python worker and file."""
    return ByteBPE(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, offsets, n_tokens): ids of each whole text and the byte at which each one's bytes begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                ids = [bpe.encode(t or "") for t in batch.column(1).slice(lo, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), pa.array(ids, pa.list_(pa.int32())), pa.array([[a for a, _ in bpe.offsets(x)] for x in ids], pa.list_(pa.int64())), pa.array([len(x) for x in ids], pa.int64())], ["doc_id", "ids", "offsets", "n_tokens"])

    return _two(docs).mapInArrow(trimmed(run), "doc_id long, ids array<int>, offsets array<long>, n_tokens long")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); bytes that are no UTF-8 become U+FFFD. Null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x if x is None else bpe.decode_text(x) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(trimmed(run), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the decimal ids, joined by one space, and of the bytes
    that the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for lo in range(0, batch.num_rows, 64):
                for found in bpe.pieces([t or "" for t in batch.column(1).slice(lo, 64).to_pylist()]):
                    count, ids, raw = zip(*found, strict=True) if found else ((), (), ())
                    n.append(sum(count))
                    of_ids.append(hashlib.sha256(" ".join(ids).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(b"".join(raw)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    return _two(docs).mapInArrow(trimmed(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _two(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
