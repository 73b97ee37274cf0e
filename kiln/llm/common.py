"""Helpers that several operators share: shared storage, words, deterministic hashes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six bytes (space, tab to carriage return).
NON_WORD = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_own_dirs: dict[str, str] = {}
_shipped: set[str] = set()
#: Shared folders made within the ``scratch`` block of this thread.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once an application, so they need no installed copy."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="kiln-code-")  # Spark's file server hands it on to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{top.name}.zip", "w") as z:
        for path in sorted(top.rglob("*.py")):
            z.write(path, path.relative_to(top.parent))
    spark.sparkContext.addPyFile(f"{folder}/{top.name}.zip")
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors and the driver share.

    Only a local session may go without that setting: it gets a folder of its own, removed at exit.
    """
    ship(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="kiln-")
            atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
        base = f"file://{_own_dirs[app]}"
    folder = f"{base.rstrip('/')}/kiln-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(folder)
    return folder


def drop(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete stored tables that nothing still to be run reads, or the whole folder where none is named."""
    context = spark.sparkContext
    for name in names or ("",):
        path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}".rstrip("/"))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the shared folders that operators made within the block; results must be stored elsewhere by then."""
    made: list[str] = []
    mark = _made.set(made)
    try:
        yield
    finally:
        _made.reset(mark)
        for folder in made:
            drop(spark, folder)


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash52(*parts: Column, seed: str = "") -> Column:
    """52 bits of md5 over the parts' text as a long; the same in any SQL engine that has md5."""
    joined = F.concat_ws("|", F.lit(seed), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
