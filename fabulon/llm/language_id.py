"""Language identification by interpolated Kneser-Ney character models, one per language, in sorted hash arrays.

Texts are lower-cased and every run of characters that are no letters becomes one space; n-grams of 1 to `order` characters
are counted by executors over a bounded sample of the labelled documents (about `per_language` documents of each language,
chosen by a hash of doc_id; all of them where there are fewer). The tables hold, for each n-gram that any language has
seen, the interpolated log probability under each language, and for each context its back-off weight; both are looked up by
binary search in sorted arrays of hashes. The language of the lowest cross-entropy per character wins (ties: the
smallest name by code point). A fifth of the sample is held back from the counts; the excess of its cross-entropies over
their mean sets the limit beyond which a text is rejected.

Null text, and text without a letter: `und`, score 0, rejected. Without any labelled document everything is `und`.
Whole texts of any length are scored; repeated rows score alike; other columns are never read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches, trimmed
from .words import mix, numbers

ORDER, PER_LANGUAGE = 4, 300
#: Bits per character above a language's usual ones that a text may have in any case: texts of two known languages stay.
LEAST_EXCESS = 2.0
U = np.uint64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point the one of its lower-case letter, or the space."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def normal(text: str) -> np.ndarray:
    """Code points of the letters of a text, with one space before, after and for each run of other characters."""
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    points = np.concatenate([[np.uint32(32)], points, [np.uint32(32)]])
    gap = points == 32
    return points[~(gap & np.concatenate([[False], gap[:-1]]))]


def _keys(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive code points."""
    scale = numbers(8, 11)
    total = np.full(max(0, len(points) - n + 1), U(n))
    with np.errstate(over="ignore"):
        for j in range(n):
            total += (points[j : j + len(total)].astype(np.uint64) + U(1)) * scale[j]
    return mix(total)


def _gram_key(gram: str) -> int:
    return int(_keys(np.frombuffer(gram.encode("utf-32-le"), dtype=np.uint32), len(gram))[0])


class KneserNey:
    """Interpolated Kneser-Ney of one language from the counts of its longest n-grams."""

    def __init__(self, counts: dict[str, int], order: int):
        self.order, self.c, self.total, self.types, self.d = order, {}, {}, {}, {}
        level = counts
        for n in range(order, 0, -1):
            self.c[n] = level
            total, types = Counter(), Counter()
            for g, k in level.items():
                total[g[:-1]] += k
                types[g[:-1]] += 1
            once, twice = sum(k == 1 for k in level.values()), sum(k == 2 for k in level.values())
            self.total[n], self.types[n], self.d[n] = total, types, min(0.95, max(0.1, once / max(1, once + 2 * twice)))
            level = Counter(g[1:] for g in level)  # how many different characters come before
        self.size = len(self.c[1]) + 1

    def gamma(self, context: str) -> float:
        n = len(context) + 1
        total = self.total[n].get(context, 0)
        return self.d[n] * self.types[n][context] / total if total else 1.0

    def p(self, gram: str) -> float:
        n = len(gram)
        if not n:
            return 1 / self.size
        total = self.total[n].get(gram[:-1], 0)
        lower = self.p(gram[1:])
        return max(self.c[n].get(gram, 0) - self.d[n], 0) / total + self.gamma(gram[:-1]) * lower if total else lower


class Tables:
    """All languages' models in sorted arrays: for each length the keys, and log2 probabilities and back-off weights by language."""

    def __init__(self, counts: dict[str, dict[str, int]], order: int):
        self.langs, self.order = sorted(counts, key=lambda x: [ord(c) for c in x]), order
        models = [KneserNey(counts[x], order) for x in self.langs]
        self.grams, self.contexts = {}, {}
        for n in range(1, order + 1):
            grams = sorted(set().union(*(m.c[n] for m in models)))
            self.grams[n] = self._sorted(grams, [[np.log2(m.p(g)) for m in models] for g in grams])
            if n > 1:
                contexts = sorted({g[:-1] for g in grams})
                self.contexts[n] = self._sorted(contexts, [[np.log2(m.gamma(g)) for m in models] for g in contexts])
        self.floor = np.array([np.log2(m.gamma("") / m.size) for m in models], dtype=np.float32)
        self.mean = np.zeros(len(self.langs))
        self.limit = np.full(len(self.langs), np.inf)

    @staticmethod
    def _sorted(grams: list[str], rows: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array([_gram_key(g) for g in grams], dtype=np.uint64)
        order = np.argsort(keys)
        return keys[order], np.array(rows, dtype=np.float32)[order]

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def log2(self, points: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
        """log2 probabilities by language of the character at each place, from the n characters that end there."""
        if not n:
            return np.broadcast_to(self.floor, (len(at), len(self.langs)))
        grams, values = self.grams[n]
        out = np.empty((len(at), len(self.langs)), dtype=np.float32)
        wanted = _keys(points, n)[at - n + 1] if len(at) * 4 > len(points) else _keys(points[at[:, None] + np.arange(1 - n, 1)].ravel(), n)[::n] if len(at) else np.zeros(0, U)
        place, hit = self._find(grams, wanted)
        out[hit] = values[place[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            lower = self.log2(points, n - 1, at[miss])
            if n > 1:
                contexts, weights = self.contexts[n]
                near = points[at[miss][:, None] + np.arange(1 - n, 0)].ravel()
                place, hit = self._find(contexts, _keys(near, n - 1)[:: n - 1])
                lower = lower + np.where(hit[:, None], weights[place], 0)
            out[miss] = lower
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character under each language, and the number of characters, of texts that have a letter."""
        parts = [normal(t) for t in texts]
        pad = np.full(self.order - 1, 32, dtype=np.uint32)
        points = np.concatenate([x for p in parts for x in (pad[:-1], p)]) if parts else pad
        lengths = np.array([len(p) - 1 for p in parts])
        starts = np.cumsum([0, *(len(p) + len(pad) - 1 for p in parts)])[:-1] + len(pad)
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        bits = -np.add.reduceat(self.log2(points, self.order, at), np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64), axis=0, dtype=np.float64)
        return bits / lengths[:, None], lengths

    def excess(self, ce: np.ndarray, lengths: np.ndarray, best: np.ndarray) -> np.ndarray:
        return (ce[np.arange(len(ce)), best] - self.mean[best]) * np.minimum(1, np.sqrt(lengths / 64))

    def calibrate(self, texts: dict[str, list[str]]) -> None:
        for j, lang in enumerate(self.langs):
            texts_ = [t for t in texts.get(lang, []) if len(normal(t)) > 2]
            if texts_:
                ce, n = self.entropies(texts_)
                self.mean[j] = np.median(ce[:, j])
                over = self.excess(ce, n, np.full(len(ce), j))
                self.limit[j] = max(LEAST_EXCESS, 1.5 * np.quantile(over, 0.99))

    def classify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        names, score, out = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        have = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.langs else []
        size, part = 0, []
        for i in [*have, -1]:
            if part and (i < 0 or size + len(texts[i]) > 200_000):
                ce, n = self.entropies([texts[j] for j in part])
                best = ce.argmin(axis=1)
                odds = np.exp2(-(ce - ce.min(axis=1, keepdims=True)) * np.minimum(n, 64)[:, None]).sum(axis=1)
                score[part], out[part] = 1 / odds, self.excess(ce, n, best) > self.limit[best]
                for j, b in zip(part, best.tolist(), strict=True):
                    names[j] = self.langs[b]
                size, part = 0, []
            if i >= 0:
                size += len(texts[i])
                part.append(i)
        return names, score, out


def _counted(order: int):
    """(lang, text) -> (lang, gram, n): the n-grams of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = " " * (order - 2) + normal(text or "").tobytes().decode("utf-32-le", "replace")
                if len(s) > order:
                    found[lang].update(s[i : i + order] for i in range(len(s) - order + 1))
        rows = [(a, g, n) for a, c in found.items() for g, n in c.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["lang", "gram", "n"])

    return run


def train(labelled: DataFrame, *, order: int = ORDER, per_language: int = PER_LANGUAGE) -> Tables:
    """Tables from labelled documents (doc_id, text, lang). The driver gets n-gram counts, and the texts held back for the limits:
    about `per_language` documents of each language in all."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("doc_id is not null and lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Tables({}, order)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1 << 30, -(-per_language * (1 << 30) // n)))).otherwise(share)
    sample = rows.filter(draw < share)
    held = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(5)) == 0
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    grams = sample.filter(~held).select("lang", "text").mapInArrow(trimmed(_counted(order)), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    for lang, gram, n in grams.itertuples(index=False):
        counts[lang][gram] = int(n)
    tables = Tables(dict(counts), order)
    kept: dict[str, list[str]] = defaultdict(list)
    for r in sample.filter(held).select("lang", "text").collect():
        kept[r["lang"]].append(r["text"])
    tables.calibrate(kept)
    return tables


def identify(docs: DataFrame, tables: Tables) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                names, score, out = shared.value.classify(batch.column(1).slice(lo, 512).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 512), pa.array(names), pa.array(score), pa.array(out)], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimmed(run), "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, tables: Tables) -> DataFrame:
    """The rows of docs, in all their columns, whose text is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                yield part.filter(pa.array(~shared.value.classify(part.column(at).to_pylist())[2]))

    return docs.mapInArrow(trimmed(run), docs.schema)
