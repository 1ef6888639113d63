"""Sends this package to the executors of a session whose Python path does not have it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parents[2]


def ship(spark: SparkSession) -> None:
    """Add the package to the session's files, once."""
    sc = spark.sparkContext
    if str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(sc, "_riskrank_sent", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="riskrank-"), "riskrank.zip")  # the driver serves it to the executors
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((_ROOT / "riskrank").rglob("*.py")):
            out.write(source, source.relative_to(_ROOT))
    sc.addPyFile(str(archive))
    sc._riskrank_sent = True
