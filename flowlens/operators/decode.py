"""Decoding packet text into typed rows, filters, base columns, quarantine.

Everything is a narrow (map-only) transformation: no shuffle, so decoding
scales with the number of input partitions and works unchanged on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import format_epoch_ms
from ..schema import PACKET

INDEX_MARK = '{"index":'


def _lenient(schema: T.StructType) -> T.StructType:
    """Same shape with every leaf as STRING, so a JSON array where a scalar is
    declared (or the reverse) survives decoding as raw JSON text."""
    def conv(dt: T.DataType) -> T.DataType:
        if isinstance(dt, T.StructType):
            return T.StructType([T.StructField(f.name, conv(f.dataType), True) for f in dt.fields])
        return T.StringType()
    return conv(schema)


def _normalise(raw: Column, dt: T.DataType) -> Column:
    """Raw (lenient) value -> declared type: first element of an array for a
    scalar leaf, a one-element array for a scalar given where an array is
    declared."""
    if isinstance(dt, T.StructType):
        return F.when(raw.isNotNull(), F.struct(*[
            _normalise(raw.getField(f.name), f.dataType).alias(f.name) for f in dt.fields]))
    is_array_text = F.ltrim(raw).startswith("[")
    if isinstance(dt, T.ArrayType):
        return F.when(is_array_text, F.from_json(raw, dt)).otherwise(
            F.when(raw.isNotNull(), F.array(raw.cast(dt.elementType))))
    return F.when(is_array_text, F.get_json_object(raw, "$[0]")).otherwise(raw).cast(dt)


def lenient_schema(schema: T.StructType = PACKET, corrupt: str | None = None) -> T.StructType:
    """Reader schema: every leaf STRING, plus an optional corrupt-record column."""
    out = _lenient(schema)
    if corrupt:
        out = T.StructType([*out.fields, T.StructField(corrupt, T.StringType(), True)])
    return out


def normalise_packets(df: DataFrame, schema: T.StructType = PACKET, keep: tuple[str, ...] = (),
                      decoded: Column | None = None) -> DataFrame:
    """Leniently parsed packet columns -> declared types (see ``_normalise``).
    A ``_raw`` column (text that did not decode) is carried through."""
    cols = [_normalise(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    flag = decoded if decoded is not None else F.lit(True)
    raw = ["_raw"] if "_raw" in df.columns else []
    return df.select(*keep, *cols, flag.alias("_decoded"), *raw)


def decode_packets(df: DataFrame, value_col: str = "value",
                   schema: T.StructType = PACKET, keep: tuple[str, ...] = (),
                   lenient: bool = True) -> DataFrame:
    """Text (or bytes) column of packet JSON -> typed packet columns (the
    message-bus path; files go through the JSON reader instead).

    Adds ``_decoded`` (FALSE when the text is not a JSON object) and then the
    text itself as ``_raw``, so callers can route such rows to quarantine.  ``keep`` lists input columns to carry
    through (for example the broker timestamp or an id).  The JSON text is
    parsed once into one struct column; fields are then read from it."""
    text = F.col(value_col).cast("string")
    parse_schema = _lenient(schema) if lenient else schema
    out = df.select(*keep, text.alias("_raw"), F.from_json(text, parse_schema).alias("_data"))
    ok = F.col("_data").isNotNull() & F.ltrim(F.col("_raw")).startswith("{")
    ok = F.coalesce(ok, F.lit(False))
    out = out.select(*keep, "_data.*", ok.alias("_ok"), F.when(~ok, F.col("_raw")).alias("_raw"))
    if not lenient:
        return out.withColumnRenamed("_ok", "_decoded")
    return normalise_packets(out, schema, keep, F.col("_ok"))


def drop_index_lines(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Drop the bulk-index action lines that alternate with packet lines."""
    return df.filter(~F.col(value_col).contains(INDEX_MARK) | F.col(value_col).isNull())


def keep_transport(df: DataFrame, keep_undecoded: bool = False) -> DataFrame:
    """Keep packets that carry a TCP or a UDP layer (and, with
    ``keep_undecoded``, text that did not decode, for quarantine)."""
    cond = F.col("layers.tcp").isNotNull() | F.col("layers.udp").isNotNull()
    if keep_undecoded and "_decoded" in df.columns:
        cond = cond | ~F.col("_decoded")
    return df.filter(cond)


def transport_of(df_layers: str = "layers") -> Column:
    return (F.when(F.col(f"{df_layers}.tcp").isNotNull(), F.lit("tcp"))
            .when(F.col(f"{df_layers}.udp").isNotNull(), F.lit("udp")))


def base_columns(df: DataFrame) -> DataFrame:
    """Formatted time, addresses and transport ports (TCP wins over UDP)."""
    return df.withColumns({
        "timestamp": format_epoch_ms("timestamp"),
        "ip_src": F.col("layers.ip.ip_ip_src"),
        "ip_dst": F.col("layers.ip.ip_ip_dst"),
        "src_port": F.coalesce(F.col("layers.tcp.tcp_tcp_srcport"), F.col("layers.udp.udp_udp_srcport")),
        "dst_port": F.coalesce(F.col("layers.tcp.tcp_tcp_dstport"), F.col("layers.udp.udp_udp_dstport")),
    })


def drop_fields(df: DataFrame, fields=("event", "host", "log")) -> DataFrame:
    """Remove ingest bookkeeping fields (only those present)."""
    return df.drop(*[f for f in fields if f in df.columns])


def parse_embedded_json(df: DataFrame, schema: T.StructType | str,
                        source: str = "message") -> DataFrame:
    """Re-parse a JSON text column and lift its fields to the top level
    (no-op when the column is absent)."""
    if source not in df.columns:
        return df
    parsed = F.from_json(F.col(source), schema)
    names = (schema.fieldNames() if isinstance(schema, T.StructType)
             else T.StructType.fromDDL(schema).fieldNames())
    return df.withColumn("_msg", parsed).select(
        *[c for c in df.columns if c not in names], *[F.col(f"_msg.{n}").alias(n) for n in names])


def flag_quarantine(df: DataFrame, required: list[str]) -> DataFrame:
    """Add ``_ok`` (decoded and every ``required`` column non-NULL) and
    ``reason`` (why not) without filtering, so one pass can feed both the
    good and the quarantine output."""
    decoded = F.col("_decoded") if "_decoded" in df.columns else F.lit(True)
    ok = decoded
    for c in required:
        ok = ok & F.col(c).isNotNull()
    reason = F.when(~decoded, F.lit("not_json"))
    for c in required:
        reason = reason.when(F.col(c).isNull(), F.lit(f"null_{c}"))
    return df.withColumns({"_ok": F.coalesce(ok, F.lit(False)), "reason": reason})


def quarantined_text(df: DataFrame) -> Column:
    """What a quarantined row held: the line that did not decode, or the
    packet's layers as JSON."""
    layers = F.to_json("layers")
    return F.coalesce("_raw", layers) if "_raw" in df.columns else layers


def split_quarantine(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): rows where every ``required`` column is non-NULL
    and the text decoded, and the rest with a ``reason`` column."""
    flagged = flag_quarantine(df, required)
    good = flagged.filter("_ok").drop("_ok", "reason")
    bad = flagged.filter(~F.col("_ok")).drop("_ok")
    return good, bad
