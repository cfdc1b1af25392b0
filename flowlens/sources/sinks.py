"""Sinks: console, document-index contract, multi-sink micro-batches,
delimited result files and model tables.

A streaming query writes through ``foreachBatch``: each micro-batch is
persisted once and written to every sink, so the source and the scoring
run once however many outputs there are.  Writes are keyed by the batch id
(one sub-folder per batch, overwritten on replay), so a batch re-run after
a failure replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import GEO_POINT_COLUMNS, SCORED_PACKET

BatchSink = Callable[[DataFrame, int], None]


def console_sink(df: DataFrame, checkpoint: str | None = None, truncate: bool = False):
    w = df.writeStream.outputMode("append").format("console").option("truncate", truncate)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def conform(df: DataFrame, schema: T.StructType = SCORED_PACKET,
            geo_columns=GEO_POINT_COLUMNS) -> DataFrame:
    """Output contract of the scored-packet index: exactly the contract's
    columns, in order, with its types; geo points as ``array<float>``
    ``[lon, lat]`` of length 2 (anything else becomes NULL)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"output lacks columns {missing}")
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in geo_columns:
            c = F.when(F.size(c) == 2, c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType = SCORED_PACKET) -> None:
    """Create an empty target with the contract schema if none exists yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def parquet_batch_sink(path: str, partition_by: list[str] | None = None) -> BatchSink:
    """Idempotent micro-batch writer: batch N goes to ``path/batch_id=N``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def connector_batch_sink(fmt: str, target: str, options: dict | None = None,
                         mode: str = "append") -> BatchSink:
    """Micro-batch writer for any batch connector (a document index, a
    warehouse table): ``batch.write.format(fmt).options(...).save(target)``.
    Used inside ``foreachBatch`` when the connector's package is installed;
    append-only targets should be given an id column to stay idempotent."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).options(**(options or {})).mode(mode).save(target)
    return write


def console_batch_sink(n: int = 20) -> BatchSink:
    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"-- batch {batch_id}")
        batch.show(n, truncate=False)
    return show


def multi_sink(*sinks: BatchSink) -> BatchSink:
    """One ``foreachBatch`` function feeding several sinks from one persisted batch
    (a single sink reads the batch directly)."""
    if len(sinks) == 1:
        return sinks[0]

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for s in sinks:
                s(batch, batch_id)
        finally:
            batch.unpersist()
    return run


def write_result_csv(df: DataFrame, path: str, vector_cols=(), sep: str = ",") -> None:
    """Delimited result file with a header; ML vectors are written as text."""
    out = df
    for c in vector_cols:
        out = out.withColumn(c, F.to_json(vector_to_array(F.col(c))))
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def save_model_table(df: DataFrame, path: str, version: str | None = None) -> None:
    """Persist a model table with its version and training time."""
    stamp = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    version = version or stamp.strftime("%Y%m%d%H%M%S")
    (df.withColumn("model_version", F.lit(version))
       .withColumn("trained_at", F.lit(stamp).cast("timestamp_ntz"))
       .write.mode("overwrite").parquet(path))


def load_model_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("model_version", "trained_at")
