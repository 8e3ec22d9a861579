"""Makes the package importable on executors that were not started with it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources along with the application, once, unless executors find them by PYTHONPATH."""
    sc = spark.sparkContext
    if sc.applicationId in _done:
        return
    _done.add(sc.applicationId)
    on_path = (sc._jvm.System.getenv("PYTHONPATH") or "").split(os.pathsep)
    if str(ROOT) in map(os.path.abspath, filter(None, on_path)):
        return
    at = Path(tempfile.mkdtemp(prefix="fabulon-")) / "fabulon.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted((ROOT / "fabulon").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    sc.addPyFile(str(at))
