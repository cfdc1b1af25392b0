"""Isolation forest on Spark.

Fit
  1. Sample: every tree takes ``psi`` rows (256, or all rows when fewer), those
     least by its own hash of their key.  A key is hashed once (md5); a tree's
     hash is ``(r * a + b) mod p`` of that number, so a hundred trees cost a
     hundred multiplications a row.  Only rows under a share that leaves each
     tree somewhat more than ``psi`` are shuffled; a tree that came out short
     doubles the share, so the sample is always the ``psi`` least.
  2. Growth, all trees at once, level by level: count, minimum and maximum of
     every feature per (tree, node), then the feature and the cut from
     ``md5(seed:tree:node)``.  Rows of a tree stay in one partition (``psi`` of
     them), so all levels share one shuffle, and a row carries the nodes on its
     path, which the node table is read from.
  3. Nodes are numbered as in a heap (root 1, children 2n and 2n + 1).  The node
     table (at most ``trees * (2 * psi - 1)`` rows) is the model.

Every number comes from md5 and arithmetic on whole numbers and doubles, so the
model is a function of the rows and the seed alone, and SQL can repeat it.

Score
  The node table is bounded by the parameters, so it ships with the scoring
  function; a pandas UDF walks all trees for a whole Arrow batch at once
  with NumPy.  Path lengths are whole millionths, so their sum does not depend
  on an order.  Score ``2 ** (-E[h(x)] / c(psi))``: higher is more anomalous.
  The label cut is the ``1 - contamination`` quantile of the training scores.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .features import collect_bounded
from .sampling import exact_percentile

EULER = 0.5772156649015329

def average_path_length(n):
    """c(n): mean path length of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


PRIME = 2147483647
UNIT = 1_000_000


def tree_hashes(n_trees: int, seed: int) -> list[tuple[int, int, int]]:
    """``(tree, a, b)`` of each tree's hash."""
    out = []
    for t in range(n_trees):
        h = hashlib.md5(f"{seed}:tree:{t}".encode()).hexdigest()
        out.append((t, int(h[:8], 16) % (PRIME - 1) + 1, int(h[8:16], 16) % PRIME))
    return out


def _hex(text: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(text, start, length), 16, 10).cast("bigint")


def sample(df: DataFrame, key: str, features: list[str], n_trees: int, psi: int, seed: int, n_rows: int) -> DataFrame:
    """``tree_id, x0, x1, ...``: the ``psi`` rows of each tree."""
    xs = [f"x{i}" for i in range(len(features))]
    md = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = df.select(*[F.col(c).cast("double").alias(x) for x, c in zip(xs, features)], md.alias("_k"))
    rows = rows.withColumn("_r", _hex(F.col("_k"), 1, 15) % F.lit(PRIME))
    trees = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
                      for t, a, b in tree_hashes(n_trees, seed)])
    share = (psi + 10 * math.sqrt(psi) + 20) / n_rows
    while True:
        limit = PRIME if share >= 1 else max(1, int(share * PRIME))
        hashed = F.transform(trees, lambda s: F.struct(
            s["t"].alias("tree_id"), ((F.col("_r") * s["a"] + s["b"]) % F.lit(PRIME)).alias("h")))
        drawn = rows.select("_k", *xs, F.explode(F.filter(hashed, lambda s: s["h"] < F.lit(limit))).alias("_d"))
        w = Window.partitionBy("_d.tree_id").orderBy("_d.h", "_k", *xs)
        taken = materialize(drawn.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= psi)
                            .select("_d.tree_id", *xs))
        sizes = taken.groupBy("tree_id").count().where(F.col("count") == psi).count()
        if sizes == n_trees or limit == PRIME:
            return taken
        share *= 2


def grow(taken: DataFrame, n_features: int, psi: int, seed: int) -> DataFrame:
    """The node table of the trees of a sample.

    A leaf stays what it is: later levels write the same record again."""
    spark = taken.sparkSession
    depth = int(math.ceil(math.log2(max(psi, 2))))
    xs = [f"x{i}" for i in range(n_features)]
    x = ", ".join(xs)
    spans = ", ".join(f"named_struct('i', {i}, 'lo', min({c}) OVER w, 'hi', max({c}) OVER w)" for i, c in enumerate(xs))
    hexed = "cast(conv(substring(md, {}, {}), 16, 10) AS bigint)"
    at = taken.repartition("tree_id").selectExpr(
        "tree_id", *xs, "1L AS node_id",
        "cast(array() AS array<struct<node_id:bigint,feature:int,cut:double,size:bigint,depth:int>>) AS path")
    for level in range(depth + 1):
        pick = f"get(used, cast({hexed.format(1, 8)} % size(used) AS int))" if level < depth else \
            "cast(NULL AS struct<i:int,lo:double,hi:double>)"
        at = spark.sql(f"""SELECT tree_id, {x}, CASE WHEN s IS NULL THEN node_id WHEN get(array({x}), s.i) <= cut THEN 2 * node_id
  ELSE 2 * node_id + 1 END AS node_id, array_append(path, named_struct('node_id', node_id, 'feature', coalesce(s.i, -1),
  'cut', cut, 'size', size, 'depth', cast(floor(log2(node_id + 0.5D)) AS int))) AS path
FROM (SELECT *, CASE WHEN raw >= s.hi THEN s.lo ELSE raw END AS cut
FROM (SELECT *, s.lo + cast({hexed.format(9, 13)} AS double) / {float(1 << 52)}D * (s.hi - s.lo) AS raw
FROM (SELECT *, CASE WHEN size(used) > 0 THEN {pick} END AS s
FROM (SELECT *, filter(spans, v -> v.hi > v.lo) AS used, md5(concat_ws(':', '{seed}', tree_id, node_id)) AS md
FROM (SELECT *, array({spans}) AS spans, count(1) OVER w AS size FROM {{at}} WINDOW w AS (PARTITION BY tree_id, node_id))))))""", at=at)
    return spark.sql("""SELECT DISTINCT tree_id, cast(n.node_id AS int) AS node_id, n.feature, n.cut,
  cast(CASE WHEN n.feature >= 0 THEN 2 * n.node_id ELSE -1 END AS int) AS left,
  cast(CASE WHEN n.feature >= 0 THEN 2 * n.node_id + 1 ELSE -1 END AS int) AS right,
  cast(n.size AS int) AS size, n.depth FROM (SELECT tree_id, explode(path) AS n FROM {at})""", at=at)


def fit(df: DataFrame, features: list[str], key: str, n_trees: int = 100, max_samples: int = 256,
        seed: int = 1) -> tuple[DataFrame, int]:
    """Grow the forest: (node table, psi)."""
    valid = df.na.drop(subset=features)
    n_rows = valid.count()
    if n_rows == 0:
        raise ValueError("no training rows")
    psi = min(max_samples, n_rows)
    return grow(sample(valid, key, features, n_trees, psi, seed, n_rows), len(features), psi, seed), psi


def leaf_units(size, depth):
    """Path length of a leaf in millionths: its depth plus c(size)."""
    return np.rint((np.asarray(depth, float) + average_path_length(size)) * UNIT).astype(np.int64)


class ForestModel:
    """Node arrays of a fitted forest, ready to score NumPy batches."""

    def __init__(self, nodes: DataFrame, psi: int, n_trees: int = 100):
        max_nodes = 2 * psi - 1
        rows = collect_bounded(nodes, n_trees * max_nodes)
        pdf = pd.DataFrame([r.asDict() for r in rows])
        self.psi = psi
        ids = sorted(pdf["tree_id"].unique())
        t_index = {t: i for i, t in enumerate(ids)}
        width = int(pdf["node_id"].max()) + 1
        shape = (len(ids), width)
        self.feature = np.full(shape, -1, dtype=np.int64)
        self.cut = np.zeros(shape)
        self.left = np.zeros(shape, dtype=np.int64)
        self.right = np.zeros(shape, dtype=np.int64)
        self.size = np.zeros(shape)
        self.depth = np.zeros(shape)
        ti = pdf["tree_id"].map(t_index).to_numpy()
        ni = pdf["node_id"].to_numpy()
        self.feature[ti, ni] = pdf["feature"].to_numpy()
        self.cut[ti, ni] = pdf["cut"].fillna(0.0).to_numpy()
        self.left[ti, ni] = pdf["left"].to_numpy()
        self.right[ti, ni] = pdf["right"].to_numpy()
        self.size[ti, ni] = pdf["size"].to_numpy()
        self.depth[ti, ni] = pdf["depth"].to_numpy()
        self.max_depth = int(self.depth.max())
        self.leaf_units = leaf_units(self.size, self.depth)
        self.c_psi = float(average_path_length(np.array([psi]))[0]) or 1.0

    def score(self, X: np.ndarray) -> np.ndarray:
        n = len(X)
        total = np.zeros(n, np.int64)
        rows = np.arange(n)
        for t in range(self.feature.shape[0]):
            idx = np.ones(n, dtype=np.int64)  # the root
            for _ in range(self.max_depth + 1):
                f = self.feature[t, idx]
                inner = f >= 0
                if not inner.any():
                    break
                go_left = X[rows, np.where(inner, f, 0)] <= self.cut[t, idx]
                nxt = np.where(go_left, self.left[t, idx], self.right[t, idx])
                idx = np.where(inner, nxt, idx)
            total += self.leaf_units[t, idx]
        mean_h = total / UNIT / self.feature.shape[0]
        return np.power(2.0, -mean_h / self.c_psi)


def score_column(model: ForestModel, features: list[str]) -> Column:
    """Anomaly score of each row (pandas UDF over Arrow batches)."""
    @F.pandas_udf("double")
    def _score(*cols: pd.Series) -> pd.Series:
        X = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        return pd.Series(model.score(X))
    return _score(*[F.col(c).cast("double") for c in features])


def score(df: DataFrame, model: ForestModel, features: list[str], out: str = "anomaly_score") -> DataFrame:
    """Score rows with complete features (rows with a NULL feature are skipped)."""
    return df.na.drop(subset=features).withColumn(out, score_column(model, features))


def threshold(scored_train: DataFrame, contamination: float = 0.1, col: str = "anomaly_score") -> float:
    """Label cut: the (1 - contamination) quantile of the training scores."""
    return exact_percentile(scored_train, col, 1.0 - contamination)


def label(df: DataFrame, cut: float, col: str = "anomaly_score", out: str = "anomaly") -> DataFrame:
    return df.withColumn(out, F.when(F.col(col) > F.lit(cut), F.lit(1)).otherwise(F.lit(0)))
