"""Structured Streaming over growing tables: windows, late data, deduplication, stalls, generation.

Every pipeline is a transformation of a streaming DataFrame; `run_available` drives one over
all that is there and gives the result as a table in the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.shared import shared_folder


def stream_table(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream; its schema is read from the files that are there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def tail_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of growing logs; offsets are kept in the query's checkpoint, so each line comes once."""
    return spark.readStream.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))


def run_available(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a streaming query over all available input and gives what it wrote.

    In append mode windows and sessions that the watermark hasn't passed when the input ends
    are not written; in complete mode they are, and the last batch is the whole result.
    """
    spark = df.sparkSession
    base = f"{shared_folder(spark)}/stream-{name}-{uuid.uuid4().hex}"
    out = f"{base}/data"
    last = "*"

    def write(batch: DataFrame, number: int) -> None:
        nonlocal last
        last = number if mode == "complete" else last
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).option("basePath", out).parquet(f"{out}/batch={last}").select(*df.columns)


def tumbling_counts(events: DataFrame, time: str, width: str, late: str, *by: str) -> DataFrame:
    """(window_start, by, n) per tumbling window; events later than `late` behind are dropped."""
    seen = events.withWatermark(time, late)
    return seen.groupBy(F.window(time, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def sessions(events: DataFrame, time: str, gap: str, late: str, *by: str) -> DataFrame:
    """(by, session_start, session_end, n) of runs of events with pauses below `gap`."""
    seen = events.withWatermark(time, late)
    return seen.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(*by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def once(events: DataFrame, time: str, late: str, *keys: str) -> DataFrame:
    """First event of each key; the state of a key is dropped once the watermark has passed it."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def stalls(events: DataFrame, key: str, time: str, quiet_seconds: int, late: str) -> DataFrame:
    """(key, stalled_at, n_events): keys whose events have stopped for so long, found by event-time timers."""
    kind = events.schema[key].dataType.simpleString()

    def watch(k, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last, n = state.get
            state.remove()
            yield pd.DataFrame({key: [k[0]], "stalled_at": [last + quiet_seconds * 1_000_000], "n_events": [n]})
            return
        last, n = state.get if state.exists else (0, 0)
        for batch in batches:
            last = max(last, int(batch["__us"].max()))
            n += len(batch)
        state.update((last, n))
        state.setTimeoutTimestamp(max(last // 1000 + quiet_seconds * 1000, state.getCurrentWatermarkMs() + 1))

    timed = events.withWatermark(time, late).select(key, time, F.unix_micros(F.col(time).cast("timestamp")).alias("__us"))
    return timed.groupBy(key).applyInPandasWithState(watch, f"`{key}` {kind}, stalled_at bigint, n_events bigint", "last bigint, n bigint", "append", GroupStateTimeout.EventTimeTimeout)


def missing_from(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs whose key the sink doesn't have: what an incremental run still has to make."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def unfinished(attempts: DataFrame, key: str) -> DataFrame:
    """(key, attempts) of an attempt log without an ok row: the next round's work."""
    return attempts.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.max(F.coalesce(F.col("status") == "ok", F.lit(False))).alias("__ok")).where("not __ok").drop("__ok")
