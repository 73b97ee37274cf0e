"""Event features over a stream: the same aggregates as on the stored table, by event time."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet", files: int = 1) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).parquet(folder)


def daily_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """day, event_type, n, total: tumbling days; events later than ``late`` after the newest are dropped."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp"))
    counts = timed.withWatermark("at", late).groupBy(F.window("at", "1 day").alias("w"), "event_type")
    return counts.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """user_id, start, end, n: runs of a user's events without a pause of ``gap``."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp"))
    runs = timed.withWatermark("at", late).groupBy(F.session_window("at", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return runs.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


#: What is known of a user: the last event in order, and those that wait until no earlier one can come.
STATE = "last_us long, last_id long, last_type string, last_value double, us array<long>, ids array<long>, types array<string>, amounts array<double>"
LAST = "event_id long, user_id long, ts timestamp, gap_s long, last_type string, last_value double, n_before long"


def last_event_features(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Every event with the seconds since its user's event before it (by time, then event_id), that event's type and value, and whether there was one.

    Keyed state: an event waits in its user's state until the watermark has passed it, so files may arrive in any order within ``late`` and the result is that of
    the sorted table. Events later than that are dropped. State holds one event a user, and those of the last ``late``.
    """
    timed = events.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("at")).where("at is not null and user_id is not null")

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_us, last_id, last_type, last_value, us, ids, types, amounts = state.get if state.exists else (None, None, None, None, [], [], [], [])
        waiting = list(zip(us, ids, types, amounts, strict=True))
        for rows in batches:
            at = rows["at"].astype("int64") // {"ns": 1000, "us": 1}[getattr(rows["at"].dtype, "unit", "ns")]
            waiting += zip(at.tolist(), rows["event_id"].tolist(), rows["event_type"].tolist(), [None if pd.isna(v) else v for v in rows["value"]], strict=True)
        waiting.sort(key=lambda x: (x[0], x[1]))
        until = state.getCurrentWatermarkMs() * 1000
        out = []
        while waiting and waiting[0][0] <= until:
            now, event, kind, value = waiting.pop(0)
            out.append((event, key[0], pd.Timestamp(now, unit="us"), None if last_us is None else now // 1_000_000 - last_us // 1_000_000, last_type, last_value, int(last_us is not None)))
            last_us, last_id, last_type, last_value = now, event, kind, value
        state.update((last_us, last_id, last_type, last_value, *([x[i] for x in waiting] for i in range(4))))
        if waiting:
            state.setTimeoutTimestamp(max(waiting[0][0] // 1000, state.getCurrentWatermarkMs() + 1))
        made = pd.DataFrame(out, columns=["event_id", "user_id", "ts", "gap_s", "last_type", "last_value", "n_before"])
        yield made.astype({"gap_s": "Int64", "last_type": object, "last_value": "Float64"})

    return timed.withWatermark("at", late).groupBy("user_id").applyInPandasWithState(step, LAST, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def within_after(first: DataFrame, second: DataFrame, seconds: int = 3600, late: str = "1 day") -> DataFrame:
    """user_id, first_id, second_id, wait_s: events of two streams of one user, the second at most ``seconds`` after the first. Watermarks on both sides let Spark drop old state."""
    a = first.select(F.col("user_id"), F.col("event_id").alias("first_id"), F.col("ts").cast("timestamp").alias("a")).withWatermark("a", late)
    b = second.select(F.col("user_id").alias("b_user"), F.col("event_id").alias("second_id"), F.col("ts").cast("timestamp").alias("b")).withWatermark("b", late)
    met = a.join(b, (F.col("user_id") == F.col("b_user")) & (F.col("b") >= F.col("a")) & (F.col("b") <= F.col("a") + F.expr(f"interval {seconds} seconds")))
    return met.select("user_id", "first_id", "second_id", (F.unix_micros("b") / 1_000_000 - F.unix_micros("a") / 1_000_000).alias("wait_s"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a local session may go without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='kiln-')}"
        atexit.register(shutil.rmtree, base.removeprefix("file://"), ignore_errors=True)
    return f"{base.rstrip('/')}/kiln-{uuid.uuid4().hex}"


def run_once(stream: DataFrame, mode: str = "complete", folder: str | None = None) -> DataFrame:
    """Process what is there and return the result as stored Parquet; a batch that is run again replaces its own rows.

    With a ``folder`` of an earlier run, the query goes on from its checkpoint, and the result (but for ``complete``) holds the rows of both runs.
    """
    spark = stream.sparkSession
    folder = folder or shared_folder(spark)
    rows = f"{folder}/rows"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{rows}/batch-{number:09}")

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    top = spark._jvm.org.apache.hadoop.fs.Path(rows)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    batches = sorted(x.getPath().getName() for x in store.listStatus(top)) if store.exists(top) else []
    if not batches:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*(f"{rows}/{b}" for b in (batches[-1:] if mode == "complete" else batches)))
