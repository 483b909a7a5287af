"""Structured Streaming forms of the ordered operators.

Every stream has a checkpoint folder, so a restart goes on where it stopped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from planweave.session import remove, shared_folder


def parquet_stream(spark: SparkSession, folder: str, table: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of a Parquet table's files; times without a zone become times in UTC, so that they can bear watermarks."""
    batch = spark.read.parquet(f"{folder}/{table}.parquet")
    # As a pattern, since a stream takes a single file only so.
    rows = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/{table}.parque[t]")
    return rows.select(*[F.col(c).cast("timestamp").alias(c) if k == "timestamp_ntz" else F.col(c) for c, k in batch.dtypes])


def window_counts(stream: DataFrame, time: str, by: list[str], length: str, late: str = "1 hour", sums: dict[str, str] | None = None) -> DataFrame:
    """Counts and sums by tumbling window; windows close once the watermark is past them."""
    aggs = [F.count("*").alias("n"), *(F.sum(c).alias(k) for k, c in (sums or {}).items())]
    out = stream.withWatermark(time, late).groupBy(F.window(time, length), *by).agg(*aggs)
    return out.select(F.col("window.start").alias("start"), *by, "n", *(sums or {}))


def session_counts(stream: DataFrame, time: str, by: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Events by session: a gap of that length ends one."""
    out = stream.withWatermark(time, late).groupBy(F.session_window(time, gap), by).agg(F.count("*").alias("n"))
    return out.select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def histogram(stream: DataFrame, by: str, value: Column, bins: int = 5) -> DataFrame:
    """Running counts by equal bins of [0, 1]."""
    return stream.groupBy(by, F.least(F.floor(value * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def last_decisions(stream: DataFrame, item: str, action: str, seq: str) -> DataFrame:
    """item, state, seq whenever an item's last decision changes; a revert leaves a null state.  Late, older decisions change nothing."""
    key = dict(stream.dtypes)[item]

    def step(ids: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        best = state.get if state.exists else (-1, None)
        before = best
        for f in frames:
            if len(f):
                i = f[seq].idxmax()
                if int(f[seq][i]) > best[0]:
                    best = (int(f[seq][i]), f[action][i])
        if best != before:
            state.update(best)
            yield pd.DataFrame({item: [ids[0]], "state": [None if best[1] == "revert" else best[1]], "seq": [best[0]]})

    return stream.select(item, action, seq).groupBy(item).applyInPandasWithState(step, f"{item} {key}, state string, seq long", "seq long, action string", "update", "NoTimeout")


def new_items(stream: DataFrame, id: str, time: str, within: str = "1 day") -> DataFrame:
    """Each id once: appending an item again changes nothing."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([id])


def keep_history(stream: DataFrame, path: str, key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Append every state to a Parquet history under path, by batch; current_states() reads it back.

    A batch's folder is named after it and overwritten, so a batch that runs again changes nothing.
    """
    return stream.writeStream.foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{path}/batch={n}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collect_stream(stream: DataFrame, name: str, mode: str) -> DataFrame:
    """Run a stream over what is there now and return its rows.

    Each run has a folder of its own in the shared folder: batches are written
    there by the executors, a repeated batch over itself, and the state goes
    when the run has ended.  In complete mode the last batch is the result, in
    the others all batches together.
    """
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/stream-{name}-{uuid.uuid4().hex}"
    batches: dict[int, str] = {}

    def keep(rows: DataFrame, n: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/{n}")
        batches[n] = f"{folder}/rows/{n}"

    q = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        remove(spark, f"{folder}/state")
    if not batches:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*([batches[max(batches)]] if mode == "complete" else batches.values()))
