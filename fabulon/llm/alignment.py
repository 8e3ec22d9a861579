"""Alignment of the tokens of two tokenizers, and corpus-wide counts of the id pairs that end together.

Tokens of A (a byte-level BPE of the tokenizers library, on a space and the text) and of B (a sentencepiece model, which puts a space before the
text itself) cover the same bytes. Where a token of A and one of B end at the same byte, the pair is a link and a group ends.

1. Texts are encoded once. Between two characters of which neither is white space, a space begins a piece of its own for either tokenizer: no
   pre-token of A and no piece of B goes past it. Each task keeps a table of the pieces between such spaces that it met (TABLE
   at most in two generations), with ids, groups and links, and a text is put together from it. Rows and links are written to the shared folder.
2. A link is one int64: B's id above bit 32, A's below. Tasks count theirs by np.unique, FLUSH links at a time, so that a pair gives a task's part of
   the sum at most once in that many, however frequent it is.
3. The partial counts are dealt by ranges of the pairs and sorted, and equal ones in a row are summed. Each range is a shard: two arrays,
   pairs and counts, in files of the shared folder that a task writes under a name of its own and that the rows of the job name.
   With it comes the highest count of each of its B ids; of those over all shards there are as many as B has ids at most.
4. Tasks look up the links of their texts: the shards are mapped into memory, the distinct links of a batch are found by searchsorted. A shared folder
   that is not in the file system is read by Spark's own file system into an unnamed file for that.

Null and empty texts have no tokens, nor has a text whose tokens' bytes are not those of a space and the text (as when it holds U+2581): zeros and an
empty string. Strings of special tokens are plain text. Repeated rows each count and give equal rows; null doc_ids do no harm. Only doc_id and text are read, so other columns, also
of clashing names, are of no matter. Empty tables give empty results. Pairs of equal count share the highest.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
import urllib.parse
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import trimmed
from .bpe import _two, byte_chars
from .pieces import MARK
from .scratch import Scratch

TABLE, FLUSH, BATCH = 150_000, 2_000_000, 64
#: A space between two characters that neither tokenizer takes for white space or for a marker of it.
_BLANK = rf"\s{MARK}᠎​﻿"
_SPACE = re.compile(f" (?<=[^{_BLANK}] )(?=[^{_BLANK}])")
_PLAIN = re.compile(f"[^{_BLANK}](?:[^{MARK}]*[^{_BLANK}])?")
#: Pieces that are encoded at a time.
TOGETHER = 2000


class Pair:
    """Both tokenizers, and what is known of pieces of texts: number of ids of A and of B, groups as text, and links; an empty tuple where the bytes differ."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {c: b for b, c in enumerate(byte_chars())}
        self.a_bytes = {}
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(MARK, " ").encode() for i, n in enumerate(names)]
        with open(a_path) as f:
            pre = json.load(f)["pre_tokenizer"]
        # texts come apart at spaces only where no piece of B and no pre-token of A holds one behind another character
        self.apart = not any(re.search(f"[^{MARK}]{MARK}", n) for n in names) and (pre or {}).get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        size = lambda of, n: np.array([len(of[i]) if i in of else 0 for i in range(n)], dtype=np.int64)
        self.a_size, self.b_size = size(self.a_bytes, max(self.a_bytes) + 1), size(dict(enumerate(self.b_bytes)), len(names))
        # ids as text, inside and at the end of their part of a group
        texts = lambda n, end: np.array([f"{i}{end}" for i in range(n)], dtype=object)
        self.a_text, self.b_text = ([texts(n, ","), texts(n, end)] for n, end in ((len(self.a_size), "|"), (len(self.b_size), ";")))
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def _encoded(self, texts: list[str]) -> list[tuple]:
        """For each text (number of ids of A, of B, groups each with `;` behind it, links as bytes); an empty tuple where the bytes differ."""
        out: list[tuple] = [()] * len(texts)
        # pieces without white space at their ends are encoded as one text, with spaces between, which come apart again
        plain = [i for i, t in enumerate(texts) if self.apart and _PLAIN.fullmatch(t)]
        for lo in range(0, len(plain), TOGETHER):
            part = plain[lo : lo + TOGETHER]
            whole = " ".join([texts[i] for i in part])
            found = self._aligned(*self._ids([whole])[0], [len(texts[i].encode()) + 1 for i in part], (" " + whole).encode())
            if found is None:  # some piece's bytes differ
                plain = plain[:lo]
                break
            for i, x in zip(part, found, strict=True):
                out[i] = x
        done = set(plain)
        rest = [i for i in range(len(texts)) if i not in done]
        for i, ids in zip(rest, self._ids([texts[i] for i in rest]), strict=True):
            raw = (" " + texts[i]).encode()
            found = self._aligned(*ids, [len(raw)], raw)
            out[i] = found[0] if found else ()
        return out

    def _ids(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return list(zip([x.ids for x in a], self.b.encode(texts, num_threads=1), strict=True)) if texts else []

    def _aligned(self, a: list[int], b: list[int], size: list[int], whole: bytes) -> list[tuple[int, int, str, bytes]] | None:
        """Texts of `size` bytes end to end: both tokenizers' tokens by the byte at which they end. None if their bytes are not those of the whole."""
        if not b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b)):
            return None
        ids_a, ids_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        end_a, end_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        common, in_a, in_b = np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)
        links = (ids_b[in_b] << 32 | ids_a[in_a]).tobytes()
        # a group's tokens of A, then its tokens of B
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        tokens = np.empty(len(ids_a) + len(ids_b), dtype=object)
        for ids, text, last, place in (
            (ids_a, self.a_text, in_a, np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, side="left")),
            (ids_b, self.b_text, in_b, np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, side="right")),
        ):
            tokens[place] = text[0][ids]
            tokens[place[last]] = text[1][ids[last]]
        ends = np.cumsum(size)
        upto = [[0, *np.searchsorted(x, ends, side="right").tolist()] for x in (end_a, end_b, common)]
        tokens = tokens.tolist()
        return [(x1 - x0, y1 - y0, "".join(tokens[x0 + y0 : x1 + y1]), links[8 * g0 : 8 * g1]) for x0, x1, y0, y1, g0, g1 in zip(upto[0], upto[0][1:], upto[1], upto[1][1:], upto[2], upto[2][1:], strict=False)]

    def rows(self, texts: list[str]) -> list[tuple[int, int, str, bytes] | None]:
        """(number of ids of A, of B, groups as text, links as bytes of int64) of each text; None without tokens."""
        split = [(_SPACE.split(t) if self.apart else [t]) if t else [] for t in texts]
        first = [list(map(self.known.get, s)) for s in split]
        new = list(dict.fromkeys(p for s, found in zip(split, first, strict=True) if None in found for p, x in zip(s, found, strict=True) if x is None))
        before = self.known
        if new:
            if len(self.known) + len(new) > TABLE:
                self.older, self.known = self.known, {}
            self.known |= {p: self.older[p] for p in new if p in self.older}
            fresh = [p for p in new if p not in self.known]
            self.known |= zip(fresh, self._encoded(fresh), strict=True)
        table = self.known
        out = []
        for s, found in zip(split, first, strict=True):
            if None in found:
                found = [x if x is not None else table[p] if p in table else before[p] for p, x in zip(s, found, strict=True)]
            if not found or () in found:
                out.append(None)
            else:
                n, m, groups, links = zip(*found, strict=True)
                out.append((sum(n), sum(m), "".join(groups)[:-1], b"".join(links)))
        return out

    def forget(self) -> None:
        self.known, self.older = {}, {}


@lru_cache(maxsize=4)
def pair(a_path: str, b_path: str) -> Pair:
    """One for each Python worker and pair of files."""
    return Pair(a_path, b_path)


def _encode(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                found = both.rows([t or "" for t in part.column(1).to_pylist()])
                links = [np.frombuffer(f[3] if f else b"", dtype=np.int64) for f in found]
                numbers = [pa.array([f[i] if f else 0 for f in found], pa.int64()) for i in (0, 1)]
                groups = pa.array([f[2] if f else None for f in found], pa.string())
                digests = pa.array([hashlib.sha256(f[2].encode()).hexdigest() if f else "" for f in found])
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, digests, groups, _listed(links)], ["doc_id", "n_a", "n_b", "groups_sha256", "groups", "links"])
        both.forget()

    return run


def _listed(parts: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


ALIGNED = "doc_id long, n_a long, n_b long, groups_sha256 string, groups string, links array<long>"


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, groups_sha256, groups, links): the groups of each text as `a1,a2|b1;a3|b2,b3` (null without tokens), and its links (B's id above bit 32)."""
    return _two(docs).mapInArrow(trimmed(_encode(a_path, b_path)), ALIGNED)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n): the links of a task, counted FLUSH at a time."""
    held: list[np.ndarray] = []
    size = 0

    def counted() -> pa.RecordBatch:
        pairs, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "n"])

    for batch in batches:
        found = batch.column(0).flatten().to_numpy()
        held.append(found)
        size += len(found)
        if size >= FLUSH:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n), partial: the counts of pairs of ids, not yet summed over tasks."""
    return aligned.select("links").mapInArrow(trimmed(_partial), "pair long, n long")


def summed(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal pairs in a row as one, with the sum of their counts."""
    if not len(pairs):
        return pairs, n
    begins = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    return pairs[begins], np.add.reduceat(n, begins)


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:") or "://" not in folder:
        return pafs.LocalFileSystem(), urllib.parse.unquote(urllib.parse.urlparse(folder).path)
    return pafs.FileSystem.from_uri(folder)


def _shards(folder: str):
    """Sorted partial counts of a range as one shard, and rows (path, low, high, size, b, top): the shard's place and the highest count of each B id in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        # the array lengths are not known before the end: a pair of raw files, written as the sums come
        name = f"{root}/{uuid.uuid4().hex}"
        tops: dict[int, int] = {}
        low = high = None
        size = 0
        rest = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        out = None

        def put(pairs: np.ndarray, n: np.ndarray) -> None:
            nonlocal out, size, low, high
            if not len(pairs):
                return
            if out is None:
                store.create_dir(root, recursive=True)
                out = [store.open_output_stream(f"{name}.{kind}") for kind in ("pairs", "counts")]
                low = int(pairs[0])
            out[0].write(pairs.tobytes())
            out[1].write(n.tobytes())
            size, high = size + len(pairs), int(pairs[-1])
            b = pairs >> 32
            begins = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            for i, top in zip(b[begins].tolist(), np.maximum.reduceat(n, begins).tolist(), strict=True):
                tops[i] = max(tops.get(i, 0), top)

        for batch in batches:
            pairs, n = summed(np.concatenate([rest[0], batch.column(0).to_numpy()]), np.concatenate([rest[1], batch.column(1).to_numpy()]))
            put(pairs[:-1], n[:-1])  # the last pair may go on in the next batch
            rest = (pairs[-1:], n[-1:])
        put(*rest)
        if out:
            for file in out:
                file.close()
            same = lambda v, kind: pa.array([v] * len(tops), kind)
            yield pa.RecordBatch.from_arrays([same(name, pa.string()), same(low, pa.int64()), same(high, pa.int64()), same(size, pa.int64()), pa.array(list(tops), pa.int64()), pa.array(list(tops.values()), pa.int64())], ["path", "low", "high", "size", "b", "top"])

    return run


class Counts:
    """The shards, mapped into memory as they are asked for."""

    def __init__(self, folder: str, shards: list[tuple[str, int, int, int]]):
        self.folder, self.shards = folder, shards
        self.low = np.array([s[1] for s in shards], dtype=np.int64)
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _array(self, path: str) -> np.ndarray:
        store, _ = _store(self.folder)
        if isinstance(store, pafs.LocalFileSystem):
            return np.memmap(path, dtype=np.int64, mode="r")
        with tempfile.TemporaryFile() as own, store.open_input_stream(path) as data:  # without a name: it goes with its mapping
            while part := data.read(1 << 22):
                own.write(part)
            own.flush()
            return np.memmap(own, dtype=np.int64, mode="r")

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """The counts of sorted distinct pairs, all of which are in the shards."""
        out = np.zeros(len(pairs), dtype=np.int64)
        shard = np.searchsorted(self.low, pairs, side="right") - 1
        cuts = np.flatnonzero(np.diff(shard)) + 1
        for at in np.split(np.arange(len(pairs)), cuts) if len(pairs) else []:
            s = int(shard[at[0]])
            if s not in self.open:
                self.open[s] = tuple(self._array(f"{self.shards[s][0]}.{kind}") for kind in ("pairs", "counts"))
            keys, counts = self.open[s]
            out[at] = counts[np.searchsorted(keys, pairs[at])]
        return out


def _looked_up(folder: str, index):
    """(doc_id, n_a, n_b, groups_sha256, links) with n_links, n_best and count_sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, tops = index.value
        counts = Counts(folder, shards)
        for batch in batches:
            column = batch.column(4)
            size = column.value_lengths().to_numpy(zero_copy_only=False)
            pairs, place = np.unique(column.flatten().to_numpy(), return_inverse=True)
            n = counts.of(pairs)
            best = n == tops[pairs >> 32]
            ends = np.concatenate([[0], np.cumsum(size)])
            add = lambda x: np.concatenate([[0], np.cumsum(x[place])])[ends]
            total, hits = np.diff(add(n)), np.diff(add(best.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2)), pa.array(size.astype(np.int64)), pa.array(size.astype(np.int64)), pa.array(hits), pa.array(total), batch.column(3)], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def alignment_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): a row for each row of docs (doc_id, text)."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        aligned = scratch.cut(align_documents(docs, a_path, b_path).drop("groups"))
        folder = f"{scratch.root}/shards"
        made = scratch.cut(link_counts(aligned).repartitionByRange("pair").sortWithinPartitions("pair").mapInArrow(trimmed(_shards(folder)), "path string, low long, high long, size long, b long, top long"))
        shards = sorted((tuple(r) for r in made.select("path", "low", "high", "size").distinct().collect()), key=lambda s: s[1])  # one for each range
        tops = made.groupBy("b").agg(F.max("top").alias("top")).toPandas()  # B's ids at most
        highest = np.zeros(int(tops["b"].max()) + 1 if len(tops) else 1, dtype=np.int64)
        highest[tops["b"].to_numpy()] = tops["top"].to_numpy()
        index = spark.sparkContext.broadcast((shards, highest))
        found = aligned.select("doc_id", "n_a", "n_b", "groups_sha256", "links").mapInArrow(trimmed(_looked_up(folder, index)), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
        return scratch.keep(found)
