"""Packet features, the standard scaler, and window-feature assembly.

The scaler is fitted with one aggregate pass (``avg`` and ``stddev_pop`` of
all seven features together; partial aggregation per partition, one tiny
final merge) and applied as a plain expression against a one-row broadcast
model, so scoring never shuffles the packet table.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import layer_int
from ..schema import FEATURES, WINDOW_FEATURES

_FEATURE_SOURCES = {
    "frame_len": ("frame", "frame_frame_len"),
    "ip_len": ("ip", "ip_ip_len"),
    "ip_proto": ("ip", "ip_ip_proto"),
    "tcp_srcport": ("tcp", "tcp_tcp_srcport"),
    "tcp_dstport": ("tcp", "tcp_tcp_dstport"),
    "udp_srcport": ("udp", "udp_udp_srcport"),
    "udp_dstport": ("udp", "udp_udp_dstport"),
}


def feature_columns(layers: str = "layers") -> dict[str, Column]:
    """The seven packet features: absent layer -> 0, unparsable field -> NULL."""
    return {name: layer_int(F.col(f"{layers}.{lay}"), field) for name, (lay, field) in _FEATURE_SOURCES.items()}


def with_features(df: DataFrame, layers: str = "layers", as_array: bool = True) -> DataFrame:
    """Add the seven feature columns and (optionally) ``features`` array<int>.

    Absent layer -> 0, unparsable field -> NULL (see ``layer_int``)."""
    out = df.withColumns(feature_columns(layers))
    if as_array:
        out = out.withColumn("features", F.array(*[F.col(c) for c in FEATURES]))
    return out


def fit_scaler(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """Scaler model table (feature, ordinal, mean, std).

    Population standard deviation; a constant column gets scale 1 so it maps
    to 0 instead of dividing by zero.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("ordinal"),
                              F.col(f"m_{c}").alias("mean"),
                              F.when(F.col(f"s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{c}")).alias("std"))
                     for i, c in enumerate(cols)])
    return one.select(F.inline(rows))


def scaler_params(scaler: DataFrame, cols: list[str] = FEATURES) -> list[tuple[float, float]]:
    """(mean, std) per feature in ``cols`` order from a scaler model table.

    The table has one row per feature, a size fixed by the model, so reading
    it into the plan as constants is bounded."""
    rows = {r["feature"]: (r["mean"], r["std"])
            for r in collect_bounded(scaler.select("feature", "mean", "std"), 4 * len(cols))}
    missing = [c for c in cols if c not in rows]
    if missing:
        raise ValueError(f"scaler model lacks features {missing}")
    return [rows[c] for c in cols]


def collect_bounded(df: DataFrame, max_rows: int) -> list:
    """Collect a model-sized table, failing instead of pulling an unbounded one."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} model rows")
    return rows


def scale(df: DataFrame, scaler: DataFrame | list[tuple[float, float]],
          cols: list[str] = FEATURES, out: str = "scaled_features") -> DataFrame:
    """``(x - mean) / std`` per feature as ``array<float>``.

    The model (one mean and one scale per feature) is compiled into the
    expression as constants: no join, no shuffle, whole-stage codegen.
    """
    params = scaler if isinstance(scaler, list) else scaler_params(scaler, cols)
    scaled = F.array(*[((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).cast("float")
                       for c, (m, s) in zip(cols, params)])
    return df.withColumn(out, scaled)


def assemble(df: DataFrame, cols: list[str] = WINDOW_FEATURES, out: str = "features",
             handle_invalid: str = "skip") -> DataFrame:
    """Dense ML vector of ``cols``; with ``skip`` rows holding a NULL are dropped."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def to_vector(col: str) -> Column:
    return array_to_vector(F.col(col))


def to_array(col: str) -> Column:
    return vector_to_array(F.col(col))
