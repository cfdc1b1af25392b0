"""Tumbling windows of a stream with an account of its late rows.

Spark's own window aggregate drops a row whose window has closed and counts
at most how many; here every row ends in one of three places.  A micro-batch
puts the rows of open windows into mergeable partials, rows of closed windows
whole into a side table, and writes one account row: ``rows = counted +
late + untimed`` (no event time).  Nothing is held in memory between batches:
the windows are the sum of all partials, and each batch's outputs are keyed by its number, so a
replayed batch replaces itself.

The watermark of a batch is the latest event time of all earlier batches (from
their account rows) less the delay; a window is closed once its end is not
after it, as in Spark's append mode.  The first batch has none.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import windows
from ..sources import sinks
from .jobs import WATERMARK, timed_stream

ACCOUNT = T.StructType([T.StructField(c, T.LongType()) for c in ("batch", "rows", "counted", "late", "untimed", "latest_us")])


def _watermark(spark: SparkSession, path: str, batch_id: int, delay_us: int) -> int | None:
    """One number from the account rows of the batches before this one."""
    if batch_id == 0:
        return None
    latest = read_account(spark, path).filter(F.col("batch") < batch_id).agg(F.max("latest_us")).first()[0]
    return None if latest is None else latest - delay_us


def start_late_windows(stream: DataFrame, out_path: str, checkpoint: str, length: str, keys=("frame_protocols",),
                       watermark: str = WATERMARK, available_now: bool = False,
                       trigger_seconds: int | None = None) -> StreamingQuery:
    """Partials, late rows and account under ``out_path``; read them with
    :func:`read_windows`, :func:`read_late` and :func:`read_account`."""
    length_us, delay_us = windows.parse_duration_us(length), windows.parse_duration_us(watermark)
    out = out_path.rstrip("/")
    partial_sink, late_sink, account_sink = (sinks.parquet_batch_sink(f"{out}/{n}") for n in ("partials", "late", "account"))

    def run(batch: DataFrame, batch_id: int) -> None:
        closed = _watermark(batch.sparkSession, out, batch_id, delay_us)
        t = F.unix_micros("frame_time")
        end = t - F.pmod(t, F.lit(length_us)) + F.lit(length_us)
        late = F.coalesce(end <= F.lit(closed), F.lit(False)) if closed is not None else F.lit(False)
        rows = batch.withColumn("_late", late).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            partial_sink(windows.pane_partials(rows.filter(~F.col("_late")), "frame_time", length_us, list(keys)), batch_id)
            late_sink(rows.filter("_late").drop("_late"), batch_id)
            n = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("_late").alias("late"),
                         F.count_if(F.col("frame_time").isNull()).alias("untimed"), F.max(t).alias("latest_us"))
            counted = (F.col("rows") - F.col("late") - F.col("untimed")).alias("counted")
            account_sink(n.select(F.lit(batch_id).cast("bigint").alias("batch"), "rows", counted, "late", "untimed",
                                  "latest_us"), batch_id)
        finally:
            rows.unpersist()

    w = timed_stream(stream, watermark).writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.foreachBatch(run).start()


def read_windows(spark: SparkSession, out_path: str, length: str, keys=("frame_protocols",)) -> DataFrame:
    """The windows, as :func:`windows.window_features` gives them, of all rows that were not late."""
    length_us = windows.parse_duration_us(length)
    partials = spark.read.parquet(f"{out_path.rstrip('/')}/partials").drop("batch_id")
    return windows.windows_of_panes(partials, length_us, length_us, list(keys))


def read_late(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(f"{out_path.rstrip('/')}/late").drop("batch_id")


def read_account(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(ACCOUNT).option("recursiveFileLookup", "true").parquet(f"{out_path.rstrip('/')}/account")
