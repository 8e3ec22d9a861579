"""Tables of named partitions that are rewritten as a whole or not at all.

A table is a folder of written parts and of numbered manifests, each of which names the parts of every partition; the highest manifest is the table. A change writes its
parts first, has them checked, and then adds one manifest by a rename: whatever ends it before leaves the old table, and after it the new one. Parts that
no manifest names are leavings of changes that did not end, or of older versions, and `vacuum` deletes them. One change at a time is taken for granted: of two
that begin at one version the second fails. A lost executor costs Spark's own retry of its tasks, within one written part.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Check = Callable[[DataFrame, DataFrame], None]


class Conflict(RuntimeError):
    """The table has changed since the change began."""


class Table:
    """Partitions of one kind of rows, or of several, under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self) -> list[str]:
        at = self._path(self.root)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def version(self) -> int:
        """The number of the table's last change, 0 before the first."""
        return max((int(n[2:-5]) for n in self._names() if n.startswith("m-") and n.endswith(".json")), default=0)

    def parts(self, version: int | None = None) -> dict[str, list[str]]:
        """The parts of each partition."""
        version = self.version() if version is None else version
        return json.loads("\n".join(r[0] for r in self.spark.read.text(f"{self.root}/m-{version:012d}.json").collect())) if version else {}

    def read(self, *partitions: str, version: int | None = None) -> DataFrame | None:
        """The rows of some partitions, or of all; None if they have none."""
        known = self.parts(version)
        paths = [f"{self.root}/{p}" for name in (partitions or known) for p in known.get(name, [])]
        return self.spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def stage(self, rows: DataFrame) -> str:
        """Write rows as a part that no manifest names yet."""
        name = f"p-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{name}")
        return name

    def publish(self, parts: dict[str, list[str]], since: int) -> int:
        """Make these the table's parts; those of partitions that are not named stay."""
        if self.version() != since:
            raise Conflict(f"version {self.version()} instead of {since}")
        whole = self.parts(since) | parts
        tmp, to = self._path(f"{self.root}/.{uuid.uuid4().hex}"), self._path(f"{self.root}/m-{since + 1:012d}.json")
        out = self._fs.create(tmp, True)
        out.write(bytearray(json.dumps(whole).encode()))
        out.close()
        if self._fs.exists(to) or not self._fs.rename(tmp, to):
            self._fs.delete(tmp, False)
            raise Conflict(f"version {since + 1} is there")
        return since + 1

    def append(self, **rows: DataFrame) -> int:
        """Add rows to partitions, all in one change."""
        since = self.version()
        known = self.parts(since)
        return self.publish({name: [*known.get(name, []), self.stage(df)] for name, df in rows.items()}, since)

    def rewrite(self, change: Callable[[DataFrame], DataFrame], *partitions: str, keys: tuple[str, ...] = ("doc_id", "idx"), check: Check | None = None) -> int:
        """Put change(rows) in the place of each partition's rows, one part after the other, all in one change.

        Before it holds, each new part must have the keys that the old one has, each as often, and pass `check` (old, new), which raises if it does not.
        """
        since = self.version()
        known, done = self.parts(since), {}
        for name in partitions or known:
            old = self.read(name, version=since)
            if old is None:
                continue
            part = self.stage(change(old))
            new = self.spark.read.parquet(f"{self.root}/{part}")
            same_keys(old, new, keys)
            if check:
                check(old, new)
            done[name] = [part]
        return self.publish(done, since) if done else since

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete parts that none of the last `keep` versions names, and older manifests. No change may be under way."""
        last = self.version()
        held = [v for v in range(max(1, last - keep + 1), last + 1)]
        named = {p for v in held for parts in self.parts(v).values() for p in parts} | {f"m-{v:012d}.json" for v in held}
        gone = [n for n in self._names() if n not in named]
        for n in gone:
            self._fs.delete(self._path(f"{self.root}/{n}"), True)
        return sorted(gone)


def same_keys(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> None:
    """Raise unless both have each key as often."""
    count = lambda df, by: df.select(*keys, F.lit(by).alias("_by"))
    off = count(old, 1).unionByName(count(new, -1)).groupBy(*keys).agg(F.sum("_by").alias("_by")).filter("_by <> 0").limit(1).count()
    if off:
        raise ValueError("keys differ")
