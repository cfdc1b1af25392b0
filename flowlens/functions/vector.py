"""Array math for small fixed-length feature vectors, kept in the JVM.

Higher-order functions over ``array<double>`` replace per-row NumPy calls:
distances to k centroids become one expression per row, with no shuffle and
no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squared_distance(x, c) -> Column:
    """Sum of squared differences of two equal-length numeric arrays (DOUBLE)."""
    diffs = F.zip_with(_c(x), _c(c), lambda a, b: (a.cast("double") - b.cast("double")) *
                       (a.cast("double") - b.cast("double")))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, d: acc + d)


def euclidean(x, c) -> Column:
    return F.sqrt(squared_distance(x, c))


def nearest_constant_center(x, centers: list[tuple[int, list[float]]]) -> Column:
    """``struct<distance double, cluster int>`` of the nearest of constant
    ``centers`` [(cluster, vector)], unrolled into plain arithmetic so it
    compiles with the rest of the stage (k and the dimension are small
    model constants).  Ties go to the lowest cluster id; a vector of another
    length has a NULL distance."""
    dim = len(centers[0][1])
    xs = [F.get(_c(x), i).cast("double") for i in range(dim)]
    xs[0] = F.when(F.size(_c(x)) == dim, xs[0])  # another length: no distance
    cands = []
    for cluster, vec in sorted(centers):
        sq = None
        for xi, ci in zip(xs, vec):
            d = (xi - F.lit(float(ci))) * (xi - F.lit(float(ci)))
            sq = d if sq is None else sq + d
        cands.append(F.struct(F.sqrt(sq).alias("distance"), F.lit(int(cluster)).alias("cluster")))
    return F.array_min(F.array(*cands))


def nearest_centroid(x, centers) -> Column:
    """``struct<distance double, cluster int>`` of the nearest center.

    ``centers`` is an ``array<struct<cluster:int, center:array<double>>>``
    (a broadcast model row).  Ties go to the lowest cluster id because
    ``array_min`` orders structs field by field.
    """
    cands = F.transform(_c(centers), lambda m: F.struct(
        euclidean(x, m.getField("center")).alias("distance"),
        m.getField("cluster").alias("cluster")))
    return F.array_min(cands)
