"""File and message-bus sources for packet records.

* NDJSON capture logs (bulk-index action lines alternating with packets):
  ``spark.read.text`` -> drop action lines -> ``from_json`` with an explicit
  schema.  Splittable line-oriented input: one task per file block.
* Pipe-delimited exports with a header: the CSV reader with an explicit
  schema and ``DROPMALFORMED`` (short or mistyped rows are dropped, empty
  cells become NULL).
* Streams: the same decoders over ``readStream.text`` (a directory that
  receives files) or a Kafka topic.  The Kafka connector is not bundled
  here; the function only configures it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.decode import decode_packets, drop_index_lines, lenient_schema, normalise_packets
from ..schema import PACKET, PACKET_CSV

INDEX_LINE_PREFIX = '{"index":{"_index":"packets-'


# --------------------------------------------------------------- NDJSON

def packet_json(df: DataFrame) -> DataFrame:
    """Packet records -> one ``value`` JSON text per packet (Kafka/NDJSON form)."""
    return df.select(F.to_json(F.struct("timestamp", "layers")).alias("value"))


def write_packets_ndjson(df: DataFrame, path: str, with_index: bool = True,
                         mode: str = "error") -> None:
    """Write packets as NDJSON; with ``with_index`` each packet line follows
    a bulk-index action line naming a daily index."""
    value = F.to_json(F.struct("timestamp", "layers"))
    if with_index:
        day = F.date_format(F.timestamp_millis(F.col("timestamp").try_cast("bigint")), "yyyy-MM-dd")
        action = F.concat(F.lit(INDEX_LINE_PREFIX), day, F.lit('","_type":"doc"}}'))
        lines = df.select(F.explode(F.array(action, value)).alias("value"))
    else:
        lines = df.select(value.alias("value"))
    lines.write.mode(mode).text(path)


CORRUPT = "_corrupt_record"


def _from_reader(df: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON-reader rows -> decoded packets.  Index action lines parse to rows
    with no packet field at all and are dropped; lines that are not JSON keep
    their text in the corrupt-record column and are flagged ``_decoded=false``
    for quarantine."""
    fields = [F.col(f.name).isNotNull() for f in schema.fields]
    any_field = fields[0]
    for c in fields[1:]:
        any_field = any_field | c
    kept = df.filter(any_field | F.col(CORRUPT).isNotNull())
    return normalise_packets(kept.withColumn("_raw", F.col(CORRUPT)), schema, decoded=F.col(CORRUPT).isNull())


def _json_reader(reader, schema: T.StructType):
    return (reader.schema(lenient_schema(schema, CORRUPT)).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT))


def read_packets_ndjson(spark: SparkSession, path: str, schema: T.StructType = PACKET) -> DataFrame:
    """Batch NDJSON packet log -> decoded packets (+ ``_decoded`` flag).

    The JSON reader parses each line once and only into the fields a query
    reads (schema pruning happens in the scan)."""
    return _from_reader(_json_reader(spark.read, schema).json(path), schema)


def stream_packets_ndjson(spark: SparkSession, path: str, schema: T.StructType = PACKET,
                          max_files_per_trigger: int | None = None,
                          glob: str | None = None) -> DataFrame:
    """A directory receiving NDJSON files as a stream of decoded packets.
    The checkpoint of the consuming query records which files were read."""
    reader = _json_reader(spark.readStream, schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _from_reader(reader.json(path), schema)


def read_packets_text(spark: SparkSession, path: str, schema: T.StructType = PACKET) -> DataFrame:
    """NDJSON through the text reader and ``from_json`` (same result as
    :func:`read_packets_ndjson`; action lines dropped by their text)."""
    return decode_packets(drop_index_lines(spark.read.text(path)), "value", schema)


def stream_packets_kafka(spark: SparkSession, servers: str, topic: str = "packets",
                         schema: T.StructType = PACKET, starting_offsets: str = "latest",
                         min_partitions: int | None = None,
                         max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic of packet JSON -> decoded packets, keeping the broker
    timestamp as ``kafka_timestamp`` (needs the Kafka connector package).

    ``min_partitions`` splits topic partitions into more Spark tasks without
    a shuffle (a one-partition topic would otherwise be one task);
    ``max_offsets_per_trigger`` bounds a micro-batch."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    raw = reader.load()
    raw = raw.select(F.col("value").cast("string").alias("value"),
                     F.col("timestamp").alias("kafka_timestamp"))
    return decode_packets(raw, "value", schema, keep=("kafka_timestamp",))


def kafka_sink(df: DataFrame, servers: str, topic: str = "packets",
               checkpoint: str | None = None):
    """Stream packets to a Kafka topic as JSON values (needs the connector)."""
    w = (packet_json(df).writeStream.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


# --------------------------------------------------------------- delimited

def _with_header(header: str):
    def prepend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for pdf in batches:
            if first:
                pdf = pd.concat([pd.DataFrame({"value": [header]}), pdf], ignore_index=True)
                first = False
            yield pdf
        if first:  # empty partition: still a valid file with its header
            yield pd.DataFrame({"value": [header]})
    return prepend


def write_delimited_lines(lines: DataFrame, columns: list[str], path: str, sep: str = "|") -> None:
    """Write pre-rendered delimited ``value`` lines with a header as the first
    line of every output file (one file per partition)."""
    header = sep.join(columns)
    lines.select("value").mapInPandas(_with_header(header), "value string").write.text(path)


def read_packet_csv(spark: SparkSession, path: str, schema: T.StructType = PACKET_CSV,
                    sep: str = "|", header: bool = True, mode: str = "DROPMALFORMED",
                    cache: bool = False) -> DataFrame:
    """Delimited packet export with an explicit schema; malformed rows dropped.

    Whether a row is malformed must not depend on the columns a query
    reads, so the session keeps CSV column pruning off (see ``session``).
    ``cache`` keeps the parsed rows (memory, spilling to disk) for jobs that
    read the source several times."""
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    df = (spark.read.schema(schema).option("header", header).option("sep", sep)
          .option("mode", mode).csv(path))
    return df.persist(StorageLevel.MEMORY_AND_DISK) if cache else df


def stream_packet_csv(spark: SparkSession, path: str, schema: T.StructType = PACKET_CSV,
                      sep: str = "|", header: bool = True) -> DataFrame:
    return (spark.readStream.schema(schema).option("header", header).option("sep", sep)
            .option("mode", "DROPMALFORMED").csv(path))
