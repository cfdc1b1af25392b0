"""K-Means scoring and training.

Scoring: the model is k centers of a few dimensions; it is compiled into the
plan as a constant array and every row computes its nearest center with one
higher-order expression.  No cross join, no shuffle, no Python worker.

Training: all restarts (and all k of an elbow) in lockstep, one job a step
(``lloyd``), lowest cost kept.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vector import nearest_centroid, nearest_constant_center
from . import lloyd

# Centers of one array expression; a larger model is several of them.
BLOCK = 1000

CENTERS_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("center", T.ArrayType(T.DoubleType()), False),
])


def centers_from_table(model: DataFrame) -> list[tuple[int, list[float]]]:
    """The model as ``[(cluster, vector)]``: any number of centers, held by the driver and the plan."""
    rows = model.select("cluster", "center").toLocalIterator()
    return sorted((int(r["cluster"]), [float(v) for v in r["center"]]) for r in rows)


def centers_literal(centers: list[tuple[int, list[float]]]) -> Column:
    """Constant array of the centers: one JSON literal that the optimizer folds."""
    rows = [{"cluster": int(c), "center": [float(v) for v in vec]} for c, vec in centers]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<cluster:int,center:array<double>>>")


def _centers(model) -> list[tuple[int, list[float]]]:
    return model if isinstance(model, list) else centers_from_table(model)


UNROLL_LIMIT = 128


def _nearest(x: str, centers: list[tuple[int, list[float]]]) -> Column:
    """Nearest-center expression: unrolled arithmetic for small models (fully
    compiled), beyond ``UNROLL_LIMIT`` center coordinates one array expression
    for every ``BLOCK`` constant centers (keeps the generated code small).  A
    vector of another length than the centers has a NULL distance in both."""
    if len(centers) * len(centers[0][1]) <= UNROLL_LIMIT:
        return nearest_constant_center(F.col(x), centers)
    best = [nearest_centroid(F.col(x), centers_literal(centers[i:i + BLOCK])) for i in range(0, len(centers), BLOCK)]
    return best[0] if len(best) == 1 else F.array_min(F.array(*best))


def assign(df: DataFrame, model, x: str = "scaled_features", out: str = "prediction") -> DataFrame:
    """Add ``struct<cluster int, distance float>`` of the nearest center.

    The distance is computed in DOUBLE, ties go to the lowest cluster id,
    and the result is stored as FLOAT (the scored-document type)."""
    best = _nearest(x, _centers(model))
    return df.withColumn(out, F.struct(best["cluster"].alias("cluster"),
                                       best["distance"].cast("float").alias("distance")))


def label(df: DataFrame, threshold: float = 2.6, dist: str = "prediction.distance",
          out: str = "anomaly", as_flag: bool = False) -> DataFrame:
    """Distance cut: ``ANOMALY``/``NORMAL`` (or 1/0 with ``as_flag``).

    The FLOAT distance is widened to DOUBLE for the comparison with the
    DOUBLE threshold, so FLOAT(2.6) is not above 2.6."""
    above = F.col(dist).cast("double") > F.lit(float(threshold))
    val = (F.when(above, F.lit(1)).otherwise(F.lit(0)) if as_flag
           else F.when(above, F.lit("ANOMALY")).otherwise(F.lit("NORMAL")))
    return df.withColumn(out, val)


def centroids_by_group(df: DataFrame, group: str, x: str = "scaled_features",
                       dim: int = 7) -> DataFrame:
    """A center table made of the mean vector of each ``group`` value,
    clusters numbered 0.. in the order of the group values."""
    aggs = [F.avg(F.get(F.col(x), i).cast("double")).alias(f"_m{i}") for i in range(dim)]
    means = df.groupBy(group).agg(*aggs)
    number = F.row_number().over(Window.orderBy(F.col(group).asc_nulls_last())) - 1  # one row a group
    return means.select(number.cast("int").alias("cluster"), F.array(*[f"_m{i}" for i in range(dim)]).alias("center"))


def inertia(df: DataFrame, model, x: str = "scaled_features") -> Column:
    """Aggregate expression: sum of squared distances to the nearest center."""
    best = _nearest(x, _centers(model))
    return F.sum(best["distance"] * best["distance"])


def inertia_one_cluster(x: str = "scaled_features", dim: int = 7) -> list[Column]:
    """Aggregate expressions whose sum is the k=1 inertia: n * var_pop per dimension."""
    return [F.count(F.get(F.col(x), i)) * F.var_pop(F.get(F.col(x), i).cast("double"))
            for i in range(dim)]


def lloyd_step(df: DataFrame, model, x: str = "scaled_features", dim: int = 7) -> DataFrame:
    """One Lloyd iteration: assign to the nearest center, then the new mean
    per cluster (partial aggregation per partition; k groups)."""
    assigned = assign(df, model, x)
    aggs = [F.avg(F.get(F.col(x), i).cast("double")).alias(f"c{i}") for i in range(dim)]
    return assigned.groupBy(F.col("prediction.cluster").alias("cluster")).agg(
        *aggs, F.count(F.lit(1)).alias("n"))


def train_kmeans(df: DataFrame, k: int, x: str = "scaled_features", n_init: int = 10, seed: int = 42,
                 max_iter: int = 300, tol: float = 1e-4, key: str | None = None) -> tuple[DataFrame, float]:
    """Best of ``n_init`` restarts -> (center table, inertia); see ``lloyd``."""
    fits = lloyd.fit_all(lloyd.vectors(df, x, key), [k], [seed + r for r in range(n_init)], max_iter, tol)
    if not fits:
        raise ValueError("no training rows")
    model = lloyd.best(fits)[k]
    centers = [(i, [float(v) for v in c]) for i, c in enumerate(model.centers)]
    return df.sparkSession.createDataFrame(centers, CENTERS_SCHEMA), float(model.inertia)


def elbow(df: DataFrame, ks=range(1, 10), x: str = "scaled_features", n_init: int = 10, seed: int = 42,
          key: str | None = None) -> DataFrame:
    """``k, inertia, knee``: the table behind the elbow choice, and the chosen one."""
    fits = lloyd.fit_all(lloyd.vectors(df, x, key), ks, [seed + r for r in range(n_init)])
    inertia = {k: float(f.inertia) for k, f in lloyd.best(fits).items()}
    at = lloyd.knee(inertia)
    return df.sparkSession.createDataFrame([(k, v, k == at) for k, v in inertia.items()], "k int, inertia double, knee boolean")
