"""Cutting lineage, and the package's code on Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once an application, so they need no installed copy."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="kiln-own-")  # Spark's file server hands it on to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{top.name}-own.zip", "w") as z:
        for path in sorted(top.rglob("*.py")):
            z.write(path, path.relative_to(top.parent))
    spark.sparkContext.addPyFile(f"{folder}/{top.name}-own.zip")
    _shipped.add(app)


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a checkpoint in the folder of ``spark.checkpoint.dir``, which survives lost executors. Only a local session may go without that setting."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="kiln-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
        context.setCheckpointDir(base)
    return df.checkpoint()
