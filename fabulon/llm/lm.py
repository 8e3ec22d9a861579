"""Language-model scoring: a causal self-attention model on leading subword ids, with word counts of the whole corpus.

Tokens are words (A-Z in lower case), then one end for each text. Each word has the id of a subword: the longest one of a fixed
list of public vocabulary entries with which it begins, or that it is as a whole. The probability of a word is that of its
subword id after the words before (self-attention, trained in numpy) times that of the word among the words of this id (counts over
all training texts, 0.5 added to each known word and to one unknown word). So the probabilities of all words add up to 1.

The subwords are chosen by the word counts of all training texts. The attention model is trained on all of them too: a start is
fitted on the driver (`steps` steps on about `bound` texts, chosen by a hash of doc_id), from which each shard of about SHARD texts takes one pass over
all of its windows; the shards hold every training text once, and the model is the mean of what they come to, by their tokens. So texts, steps and subword counts grow with the corpus, and
the outcome does not depend on how Spark deals the rows. Every training token is counted, in a shuffle. Scoring goes over windows of 32 ids of
which the last 16 are scored, so that each token is scored once with at least 16 ids of context (or all there are), many windows at once. The most
frequent words (HEAD at most) are sent to the executors with their counts; all other words of a text are joined with
the counts, so that no word is dropped.

Null text counts as empty: one end token. Repeated rows are rows of their own; a null doc_id is scored, but trains nothing.
Other columns are not read. Without training tokens N and V are 0. Empty tables give an empty result.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .batches import small_batches, trimmed
from .scratch import Scratch

WINDOW, HALF, IDS, DIM, HIDDEN, HEAD, BOUND, STEPS, PREFIX = 32, 16, 128, 16, 32, 1 << 18, 1500, 700, 6
FLUSH = 3_000_000
#: Texts of a shard, training texts of which one is taken (1: every one), windows of a step in a shard, the first rate there, and the number of sums that the driver adds up.
SHARD, SHARE, BATCH, RATE, SUMS = 1500, 1, 128, 0.003, 64
U = np.uint64
END = int(words.mix(np.array([0x454E44], dtype=np.uint64))[0])


class Subwords:
    """The ids: 0 for any other word, 1 for the end, then whole words and prefixes."""

    def __init__(self, counts: Counter, starts: Counter, n: int = IDS):
        """counts: of the words that are vocabulary entries; starts: of the entries with which words begin."""
        whole = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))][: (n - 2) // 2]
        begin = [w for w, c in sorted(starts.items(), key=lambda x: (-x[1] * len(x[0]), x[0]))][: n - 2 - len(whole)]
        self.n = 2 + len(whole) + len(begin)
        self.whole, self.whole_id = self._sorted(whole, 2)
        self.begin, self.begin_id = self._sorted(begin, 2 + len(whole))
        packed = np.array([pack(w) for w in begin] or [-1], dtype=np.int64)
        self.packed_id = np.argsort(packed)
        self.packed, self.packed_id = packed[self.packed_id], (2 + len(whole) + self.packed_id).astype(np.int16) if begin else np.zeros(1, np.int16)

    @staticmethod
    def _sorted(entries: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray]:
        if not entries:
            return np.zeros(1, U), np.zeros(1, np.int16)
        data = np.frombuffer(b"".join(entries), dtype=np.uint8)
        ends = np.cumsum([len(e) for e in entries])
        keys = words.hashes(data, np.concatenate([[0], ends[:-1]]), ends)
        order = np.argsort(keys)
        return keys[order], (first + order).astype(np.int16)

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The id of each word, of hash h."""
        out = np.zeros(len(starts), dtype=np.int16)
        todo = np.arange(len(starts))
        for size in [0, *range(PREFIX, 0, -1)]:
            if size:
                now = todo[ends[todo] - starts[todo] >= size]
                keys, of, wanted = self.begin, self.begin_id, words.hashes_at(self._total, starts[now], starts[now] + size)
            else:
                self._total = words.prefix_sums(data)
                now, keys, of, wanted = todo, self.whole, self.whole_id, h
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            out[now[hit]] = of[at[hit]]
            todo = np.flatnonzero(out == 0)
        self._total = None
        return out

    def ids_of(self, h: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The same of words by hash and packed beginning; 1 for the end."""
        out = np.zeros(len(h), dtype=np.int16)
        for size in [0, *range(PREFIX, 0, -1)]:
            keys, of, wanted = (self.packed, self.packed_id, cut(begin, size)) if size else (self.whole, self.whole_id, h)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = (keys[at] == wanted) & (out == 0)
            out[hit] = of[at[hit]]
        out[h == U(END)] = 1
        return out


def pack(word: bytes) -> int:
    """The first PREFIX bytes of a word and their number in one integer."""
    return min(len(word), PREFIX) << 48 | int.from_bytes(word[:PREFIX].ljust(PREFIX, b"\0"), "big")


def cut(packed: np.ndarray, size: int) -> np.ndarray:
    """Packed beginnings of `size` bytes of packed ones; -2 for shorter ones."""
    low = packed & ((1 << 48) - (1 << 8 * (PREFIX - size)))
    return np.where(packed >> 48 >= size, size << 48 | low, -2)


def beginnings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The words packed, A-Z in lower case."""
    size = np.minimum(ends - starts, PREFIX)
    out = size.astype(np.int64) << 48
    for i in range(PREFIX):
        byte = data[np.minimum(starts + i, len(data) - 1)].astype(np.int64)
        byte += 32 * ((byte >= 65) & (byte <= 90))
        out |= np.where(size > i, byte, 0) << 8 * (PREFIX - 1 - i)
    return out


def _entries(shared):
    """(h, begin, n) of distinct words -> (kind, entry, n): how many words are a vocabulary entry (0) and begin with one (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, of, packed, packed_of, size = shared.value
        total = np.zeros((2, size), dtype=np.int64)
        for batch in batches:
            h, begin, n = batch.column(0).to_numpy().view(U), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for kind, table, entry, wanted in [(0, keys, of, h), *((1, packed, packed_of, cut(begin, k)) for k in range(1, PREFIX + 1))]:
                if len(table):
                    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
                    hit = (table[at] == wanted) & (h != U(END))
                    np.add.at(total[kind], entry[at[hit]], n[hit])
        kind, entry = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int16)), pa.array(entry.astype(np.int32)), pa.array(total[kind, entry])], ["kind", "entry", "n"])

    return run


def choose_subwords(counted: DataFrame, vocabulary: set[bytes]) -> Subwords:
    """The subwords by the counts (h, begin, n) of all words; the driver holds two counts for each vocabulary entry."""
    known = sorted(w for w in vocabulary if w and w == w.lower())
    data, ends = np.frombuffer(b"".join(known), dtype=np.uint8), np.cumsum([len(w) for w in known]).astype(np.int64)
    keys = words.hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends) if known else np.zeros(0, U)
    short = np.array([i for i, w in enumerate(known) if len(w) <= PREFIX], dtype=np.int64)
    packed = np.array([pack(known[i]) for i in short], dtype=np.int64)
    order, by = np.argsort(keys), np.argsort(packed)
    sent = counted.sparkSession.sparkContext.broadcast((keys[order], order, packed[by], short[by], len(known)))
    found = counted.select("h", "begin", "n").mapInArrow(trimmed(_entries(sent)), "kind short, entry int, n long").groupBy("kind", "entry").agg(F.sum("n").alias("n")).collect()
    return Subwords(*(Counter({known[r["entry"]]: r["n"] for r in found if r["kind"] == kind}) for kind in (0, 1)))


def by(a: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """a @ matrix as one product over all windows."""
    return (a.reshape(-1, a.shape[-1]) @ matrix).reshape(*a.shape[:-1], matrix.shape[-1])


class Attention:
    """One layer of masked self-attention with a small feed-forward part, in numpy."""

    def __init__(self, n: int, unigram: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        d, h = DIM, HIDDEN
        init = lambda *shape: (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        # the ids n and n + 1 are the place before a text and its beginning
        self.p = {"E": init(n + 2, d), "P": 0.1 * init(WINDOW, d), "q": init(d, d), "k": init(d, d), "v": init(d, d), "o": init(d, d), "w1": init(d, h), "b1": np.zeros(h, np.float32), "w2": init(h, d), "out": 0.1 * init(d, n), "b": np.log(unigram).astype(np.float32)}
        self.n = n

    def forward(self, ids: np.ndarray) -> tuple:
        """ids (windows, WINDOW) of inputs -> scores, up to a sum for each row, (windows * HALF, n) of what follows the last HALF, and the parts."""
        p = self.p
        x = p["E"][ids]
        x += p["P"]
        h = np.ascontiguousarray(x[:, HALF:])
        q, k, v = by(h, p["q"] * np.float32(DIM**-0.5)), by(x, p["k"]), by(x, p["v"])
        s = q @ k.transpose(0, 2, 1)
        s += MASK
        before = ids == self.n
        if before.any():
            s += np.where(before, np.float32(-1e9), np.float32(0))[:, None, :]
        s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        s *= (1 / (s.reshape(-1, WINDOW) @ np.ones(WINDOW, np.float32))).reshape(len(ids), HALF, 1)
        o = s @ v
        y = by(o, p["o"])
        y += h
        z = by(y, p["w1"])
        z += p["b1"]
        np.maximum(z, 0, out=z)
        u = by(z, p["w2"])
        u += y
        logits = u.reshape(-1, DIM) @ p["out"]
        logits += p["b"]
        return logits, (x, h, q, k, v, s, o, y, z, u)

    def log10(self, ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """log10 probability of each wanted id (windows, HALF)."""
        logits, _ = self.forward(ids)
        top = logits.max(axis=1)
        own = logits[np.arange(len(logits)), wanted.ravel()]
        logits -= top[:, None]
        np.exp(logits, out=logits)
        return ((own - top - np.log(logits @ np.ones(self.n, np.float32))).astype(np.float64) / np.log(10)).reshape(wanted.shape)

    def gradients(self, ids: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        d, (x, h, q, k, v, s, o, y, z, u) = self.forward(ids)
        share = (weight / max(1.0, weight.sum())).astype(np.float32).ravel()
        d -= d.max(axis=1, keepdims=True)
        np.exp(d, out=d)
        d *= (share / (d @ np.ones(self.n, np.float32)))[:, None]
        d[np.arange(len(d)), wanted.ravel()] -= share
        flat = lambda a: a.reshape(-1, a.shape[-1])
        total = lambda a: np.ones(len(a), np.float32) @ a
        g = {"out": flat(u).T @ d, "b": total(d)}
        du = (d @ p["out"].T).reshape(u.shape)
        dz = by(du, p["w2"].T)
        dz *= z > 0
        g |= {"w2": flat(z).T @ flat(du), "w1": flat(y).T @ flat(dz), "b1": total(flat(dz))}
        dy = by(dz, p["w1"].T)
        dy += du
        g["o"] = flat(o).T @ flat(dy)
        do = by(dy, p["o"].T)
        ds = do @ v.transpose(0, 2, 1)
        ds -= (do * o).sum(axis=2, keepdims=True)
        ds *= s
        dv, dq, dk = s.transpose(0, 2, 1) @ do, ds @ k, ds.transpose(0, 2, 1) @ q  # q is scaled
        dq *= np.float32(DIM**-0.5)
        g |= {"q": flat(h).T @ flat(dq), "k": flat(x).T @ flat(dk), "v": flat(x).T @ flat(dv)}
        dx = by(dk, p["k"].T)
        dx += by(dv, p["v"].T)
        dx[:, HALF:] += dy
        dx[:, HALF:] += by(dq, p["q"].T)
        g["P"] = dx.sum(0)
        g["E"] = np.bincount((ids.reshape(-1, 1) * DIM + np.arange(DIM)).ravel(), dx.ravel(), p["E"].size).reshape(p["E"].shape).astype(np.float32)
        return g

    def fit(self, ids: np.ndarray, wanted: np.ndarray, weight: np.ndarray, steps: int = STEPS, batch: int = 128, rate: float = 0.01) -> None:
        rng = np.random.default_rng(9)
        self.descend(ids, wanted, weight, (rng.integers(0, len(ids), batch) for _ in range(steps)), steps, rate)

    def descend(self, ids: np.ndarray, wanted: np.ndarray, weight: np.ndarray, batches: Iterator[np.ndarray], steps: int, rate: float) -> None:
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        r = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t, rows in enumerate(batches, 1):
            for name, g in self.gradients(ids[rows], wanted[rows], weight[rows]).items():
                m[name] = 0.9 * m[name] + 0.1 * g
                r[name] = 0.99 * r[name] + 0.01 * g * g
                self.p[name] = (self.p[name] - rate * (1 - t / (steps + 1)) * (m[name] / (1 - 0.9**t)) / (np.sqrt(r[name] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(np.float64)

    def with_flat(self, flat: np.ndarray) -> Attention:
        out = copy.copy(self)
        cuts = np.cumsum([self.p[k].size for k in sorted(self.p)])[:-1]
        out.p = {k: v.reshape(self.p[k].shape).astype(np.float32) for k, v in zip(sorted(self.p), np.split(flat, cuts), strict=True)}
        return out


MASK = np.where(np.arange(WINDOW)[None, :] > np.arange(HALF, WINDOW)[:, None], np.float32(-1e9), np.float32(0))


def windows(ids: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts' ids (each text's one after the other): inputs (windows, WINDOW), wanted ids and their weights (windows, HALF),
    and the text of each window. Each id is wanted once."""
    per = -(-counts // HALF)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    row = np.repeat(np.arange(len(counts)), per)
    begin = (np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(per)])[:-1], per)) * HALF
    at = begin[:, None] + np.arange(-HALF - 1, HALF - 1)[None, :]  # the input at place i is the id before
    inputs = np.where(at < -1, n, n + 1).astype(np.int64)
    inside = (at >= 0) & (at < counts[row][:, None])
    inputs[inside] = ids[(first[row][:, None] + at)[inside]]
    goal = begin[:, None] + np.arange(HALF)[None, :]
    weight = goal < counts[row][:, None]
    wanted = np.zeros(goal.shape, dtype=np.int64)
    wanted[weight] = ids[(first[row][:, None] + goal)[weight]]
    return inputs, wanted, weight.astype(np.float32), row


def _tokens(data: np.ndarray, offsets: np.ndarray, subwords: Subwords) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and ids of all tokens, the end of each text included, and their number for each text."""
    starts, ends, rows = words.bounds(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(rows, minlength=n)
    h = words.hashes(data, starts, ends)
    places = np.cumsum(counts + 1) - 1
    word = np.ones(counts.sum() + n, dtype=bool)
    word[places] = False
    keys, ids = np.full(len(word), U(END)), np.ones(len(word), dtype=np.int16)
    keys[word], ids[word] = h, subwords.ids(data, starts, ends, h)
    return keys, ids, counts + 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> (h, begin, n): counts of the tokens, summed over many texts before they leave the task."""

    def flush(held: list) -> pa.RecordBatch:
        h, begin, n = (np.concatenate([x[i] for x in held]) for i in range(3))
        order = np.argsort(h, kind="stable")
        h, begin, n = h[order], begin[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(begin[at]), pa.array(np.add.reduceat(n, at))], ["h", "begin", "n"])

    held, size = [], 0
    for batch in batches:
        data, offsets = words.utf8(batch.column(0))
        for lo, hi in words.chunks(offsets):
            part = data[offsets[lo] : offsets[hi]]
            starts, ends, _ = words.bounds(part, offsets[lo : hi + 1] - offsets[lo])
            h, at, n = np.unique(words.hashes(part, starts, ends), return_index=True, return_counts=True)
            begin = beginnings(part, starts[at], ends[at]) if len(at) else np.zeros(0, np.int64)
            held.append((np.append(h, U(END)), np.append(begin, 0), np.append(n, hi - lo)))
            size += len(h) + 1
            if size > FLUSH:
                yield flush(held)
                held, size = [], 0
    if held:
        yield flush(held)


def _with_ids(shared):
    """(h, begin, n) -> (h, id, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = shared.value.ids_of(batch.column(0).to_numpy().view(U), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids), batch.column(2)], ["h", "id", "n"])

    return run


def _trained(shared):
    """(shard, doc_id, text) sorted -> (shard, n, model): the tokens of a shard, and n times the model after one pass over its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, start = shared.value
        for group in words.groups(batches, 1):
            shard, model, n = group.column(0)[0].as_py(), start, 0
            rng = np.random.default_rng([9, shard])
            data, offsets = words.utf8(group.column(2).combine_chunks())
            parts = list(words.chunks(offsets))
            for i, (lo, hi) in enumerate(parts):
                _, ids, counts = _tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], subwords)
                inputs, wanted, weight, _ = windows(ids, counts, subwords.n)
                steps = -(-len(inputs) // BATCH)
                model = model.with_flat(model.flat())
                model.descend(inputs, wanted, weight, iter(np.array_split(rng.permutation(len(inputs)), steps)), steps, RATE * (1 - i / len(parts)))
                n += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([n]), pa.array([(n * model.flat()).tobytes()], pa.binary())], ["shard", "n", "model"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, shard, n, model) sorted -> (part, n, model), summed over the shards in order."""
    for group in words.groups(batches, 1):
        total = sum(np.frombuffer(m, dtype=np.float64) for m in group.column(3).to_pylist())
        yield pa.RecordBatch.from_arrays([group.column(0).combine_chunks()[:1], pa.array([sum(group.column(2).to_pylist())]), pa.array([total.tobytes()], pa.binary())], ["part", "n", "model"])


def train_on_all(teach: DataFrame, n: int, subwords: Subwords, start: Attention, scratch: Scratch) -> Attention:
    """The mean, by tokens, of the models that shards of the n training texts, each of them in one, come to from `start`."""
    shards = max(1, -(-n // SHARD))
    sent = teach.sparkSession.sparkContext.broadcast((subwords, start))
    dealt = teach.select(F.pmod(F.xxhash64("doc_id", F.lit(21)), F.lit(shards)).alias("shard"), "doc_id", "text")
    models = scratch.cut(dealt.repartition("shard").sortWithinPartitions("shard", "doc_id", "text").mapInArrow(trimmed(_trained(sent)), "shard long, n long, model binary"))
    parts = models.select((F.col("shard") % SUMS).alias("part"), "shard", "n", "model").repartition("part").sortWithinPartitions("part", "shard")
    found = sorted(parts.mapInArrow(trimmed(_summed), "part long, n long, model binary").collect())  # SUMS rows at most
    if not found:
        return start
    return start.with_flat(sum(np.frombuffer(r["model"], dtype=np.float64) for r in found) / sum(r["n"] for r in found))


class Model:
    """What executors need: ids, attention, the frequent words, and totals by id."""

    def __init__(self, subwords: Subwords, attention: Attention, head: np.ndarray, counts: np.ndarray, by_id: dict[int, tuple[int, int]], total: int, distinct: int):
        order = np.argsort(head)
        self.subwords, self.attention, self.head, self.counts = subwords, attention, head[order], counts[order].astype(np.float64)
        self.total, self.distinct = total, distinct
        self.of_id = np.array([by_id.get(i, (0, 0))[0] + 0.5 * (by_id.get(i, (0, 0))[1] + 1) for i in range(subwords.n)])
        self.of_all = total + 0.5 * (distinct + 1)


def _scored(shared):
    """(row, text) -> for each text (row, part 0, n_tokens, known, base, model) of the frequent words, and for each other word of it
    (row, part 1, h, id, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            data, offsets = words.utf8(batch.column(1))
            number = batch.column(0).to_numpy()
            for lo, hi in words.chunks(offsets):
                h, ids, counts = _tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], m.subwords)
                row = np.repeat(np.arange(hi - lo), counts)
                if len(m.head):
                    at = np.minimum(np.searchsorted(m.head, h), len(m.head) - 1)
                    hit = m.head[at] == h
                    c = m.counts[at[hit]] + 0.5
                else:
                    hit, c = np.zeros(len(h), bool), np.zeros(0)
                base = np.bincount(row[hit], np.log10(c / m.of_all), hi - lo).astype(float)  # without a hit it counts in integers
                inside = np.bincount(row[hit], np.log10(c / m.of_id[ids[hit]]), hi - lo).astype(float)
                inputs, wanted, weight, of = windows(ids, counts, m.subwords.n)
                for a in range(0, len(inputs), BATCH):  # few at a time stay in the cache
                    found = m.attention.log10(inputs[a : a + BATCH], wanted[a : a + BATCH]) * weight[a : a + BATCH]
                    inside += np.bincount(of[a : a + BATCH], found.sum(axis=1), hi - lo)
                known = np.bincount(row[hit], minlength=hi - lo)
                rest = np.flatnonzero(~hit)
                order = rest[np.lexsort((h[rest], row[rest]))]
                r, k = row[order], h[order]
                first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])) if len(r) else np.zeros(0, int)
                n = np.diff(np.append(first, len(r)))
                none, zero = np.zeros(hi - lo, np.int64), np.zeros(len(first))
                columns = [
                    (number[lo:hi], number[lo:hi][r[first]]), (none.astype(np.int16), np.ones(len(first), np.int16)), (none, k[first].view(np.int64)), (none.astype(np.int16), ids[order][first]),
                    (counts.astype(np.int64), n.astype(np.int64)), (known.astype(np.int64), np.zeros(len(first), np.int64)), (base, zero), (inside, zero),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in columns], ["row", "part", "h", "id", "n", "known", "base", "model"])

    return run


def score_texts(docs: DataFrame, training: Column, vocabulary: set[bytes], *, bound: int = BOUND, head: int = HEAD, steps: int = STEPS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row of docs (doc_id, text); training says which rows teach."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, F.coalesce(training, F.lit(False)).alias("teaches"))
    teach = rows.filter("teaches and doc_id is not null")
    n = teach.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30))
    sample = [r["text"].encode().lower().split() for r in teach.filter(draw < (min(1 << 30, -(-bound * (1 << 30) // n)) if n else 0)).select("doc_id", "text").collect()]
    counted = scratch.cut(teach.select("text").mapInArrow(trimmed(_counted), "h long, begin long, n long").groupBy("h").agg(F.min("begin").alias("begin"), F.sum("n").alias("n")))
    subwords = choose_subwords(counted, vocabulary)
    sent = spark.sparkContext.broadcast(subwords)
    by_id = {r["id"]: (r["n"], r["v"]) for r in counted.select("h", "begin", "n").mapInArrow(trimmed(_with_ids(sent)), "h long, id short, n long").groupBy("id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    parts = [b" ".join(t) for t in sorted(sample)]
    data, offsets = np.frombuffer(b"".join(parts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    sample_ids, sample_n = [np.zeros(0, np.int16)], [np.zeros(0, np.int64)]
    for lo, hi in words.chunks(offsets):
        _, ids, counts = _tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], subwords)
        sample_ids.append(ids)
        sample_n.append(counts)
    ids, counts = np.concatenate(sample_ids), np.concatenate(sample_n)
    unigram = np.array([by_id.get(i, (0, 0))[0] for i in range(subwords.n)]) + 0.5
    attention = Attention(subwords.n, unigram / unigram.sum())
    if len(ids):
        inputs, wanted, weight, _ = windows(ids, counts, subwords.n)
        attention.fit(inputs, wanted, weight, steps)
    attention = train_on_all(teach, n, subwords, attention, scratch)
    level = F.floor(F.log2("n") * 16).cast("int").alias("level")
    at_least, most = None, 0
    for r in sorted(counted.groupBy(level).agg(F.count(F.lit(1)).alias("v"), F.min("n").alias("low")).collect(), key=lambda r: -r["level"]):
        most += r["v"]
        if most > head:
            break
        at_least = r["low"]
    top = counted.filter(F.col("n") >= at_least).select("h", "n").toPandas() if at_least is not None else None  # `head` rows at most
    keys = top["h"].to_numpy().view(np.uint64) if top is not None else np.zeros(0, np.uint64)
    model = Model(subwords, attention, keys, top["n"].to_numpy() if top is not None else np.zeros(0), by_id, sum(a for a, _ in by_id.values()), sum(b for _, b in by_id.values()))

    numbered = scratch.cut(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(trimmed(_numbered(spark.sparkContext.broadcast(model))), "row long, part short, h long, id short, n long, known long, base double, model double, doc_id long"))
    totals = F.broadcast(spark.createDataFrame([(i, float(model.of_id[i])) for i in range(subwords.n)], "of_id short, in_id double"))  # IDS rows at most
    rest = numbered.filter("part = 1").select("row", "h", "id", F.col("n").alias("times"))
    met = rest.join(counted.select(F.col("h").alias("h2"), "n"), F.col("h") == F.col("h2"), "left").join(totals, F.col("id") == F.col("of_id"))
    c = F.coalesce("n", F.lit(0)) + F.lit(0.5)
    per_row = met.groupBy(F.col("row").alias("row2")).agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known2"),
        F.sum(F.col("times") * F.log10(c / F.lit(model.of_all))).alias("base2"),
        F.sum(F.col("times") * F.log10(c / F.col("in_id"))).alias("model2"),
    )
    whole = numbered.filter("part = 0").join(per_row, F.col("row") == F.col("row2"), "left")
    return whole.select(
        "doc_id", F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("known2", F.lit(0))).cast("long").alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"), (F.col("model") + F.coalesce("model2", F.lit(0.0))).alias("score"),
    )


def _numbered(shared):
    """_scored for (row, doc_id, text), with doc_id in the rows of whole texts."""
    scored = _scored(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, ids = batch.column(0).to_numpy(), batch.column(1)
            order = np.argsort(own)
            for out in scored(iter([pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], ["row", "text"])])):
                part = out.column(1).to_numpy()
                at = order[np.searchsorted(own, out.column(0).to_numpy(), sorter=order)]
                docs = ids.take(pa.array(at, mask=part != 0))
                yield out.append_column("doc_id", docs)

    return run
