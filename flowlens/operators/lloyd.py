"""K-Means training, all models in lockstep.

Every restart of every ``k`` is fitted by the same jobs: a job reads the vectors
once and does one step of all models that have not settled, so an elbow over
nine ``k`` with ten restarts costs about as many jobs as its slowest model has
iterations, not the sum over ninety.

Start: k-means++ over all rows, as a race.  A row takes ``-log(u) / d`` seconds,
``d`` its squared distance to the nearest center so far and ``u`` from a hash of
its key, the seed and the step; the first one home is the next center, which is
a draw in proportion to ``d``.  A step is one minimum per seed, with one row a
task and seed to shuffle, and all ``k`` of a seed share it: the start for
``k`` centers begins with that for ``k - 1``.

Rows are stored in blocks of :data:`BLOCK` vectors, as bytes that a task maps
straight to an array.

Step: per block one matrix product gives ``|c|^2 - 2 c x`` for all live centers,
the squared distance less ``|x|^2``; per model the centers within its rounding
error of the least are marked, and a row with several (or none: not a number) is
decided by the plain distances, so rows go where those put them.  A second
product with the marks gives counts and sums per model and cluster; the cost is
summed from plain distances in the last step, the only one that needs it.  A task
gives one row per center, and Spark adds them up.  Nothing but centers comes to
the driver.  Bounds per row that spare distances would have to be written and
read again each step, more bytes per model than the vector itself has; in few
dimensions the distances are cheaper.

The result depends on the rows and seeds alone, but for the last digits of
sums.  Rows with a null vector or entry are left out; an empty cluster keeps its
center; with fewer different vectors than ``k`` a model has that many centers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

PRIME = 2147483647
BLOCK = 1024
_EPS = float(np.finfo(np.float64).eps)


def vectors(df: DataFrame, x: str = "scaled_features", key: str | None = None) -> DataFrame:
    """A number from each row's key (its vector, if there is none) and the vector
    in doubles, ``r, x`` as bytes of a block of rows, stored once for all steps."""
    named = F.col(key).cast("string") if key else F.to_json(F.struct(F.col(x).alias("x")))
    r = F.conv(F.substring(F.md5(F.coalesce(named, F.lit(""))), 1, 15), 16, 10).cast("bigint") % F.lit(PRIME)
    rows = df.select(r.alias("r"), F.transform(x, lambda v: v.cast("double")).alias("x"))
    rows = rows.where(F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull()))
    return materialize(rows.mapInArrow(_packed, "r binary, x binary"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def block() -> pa.RecordBatch:
        r = b"".join(p["r"].to_numpy().tobytes() for p in held)
        x = b"".join(p["x"].flatten().to_numpy(zero_copy_only=False).tobytes() for p in held)
        return pa.RecordBatch.from_pydict({"r": pa.array([r], pa.binary()), "x": pa.array([x], pa.binary())})
    for b in batches:
        at = 0
        while at < b.num_rows:
            held.append(b.slice(at, BLOCK - n))
            at, n = at + held[-1].num_rows, n + held[-1].num_rows
            if n == BLOCK:
                yield block()
                held, n = [], 0
    if n:
        yield block()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in batches:
        for r, x in zip(b["r"], b["x"]):
            r = np.frombuffer(r.as_buffer(), np.int64)
            yield r, np.frombuffer(x.as_buffer(), np.float64).reshape(len(r), -1)


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Rows by centers, dimension by dimension (no cancellation)."""
    out = np.zeros((len(x), len(centers)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - centers[None, :, i]) ** 2
    return out


def draw(seed: int, step: int) -> tuple[int, int]:
    h = hashlib.md5(f"{seed}:start:{step}".encode()).hexdigest()
    return int(h[:8], 16) % (PRIME - 1) + 1, int(h[8:16], 16) % PRIME


def _race(step: int, chosen: dict[int, list]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for r, x in _blocks(batches):
            for seed, centers in chosen.items():
                a, b = draw(seed, step)
                time = -np.log(((r * a + b) % PRIME + 0.5) / PRIME)
                if centers:
                    d = squared_distances(x, np.array(centers)).min(axis=1)
                    time = np.where(d > 0, time / np.where(d > 0, d, 1.0), np.inf)
                for i in np.flatnonzero(time == time.min()):
                    one = (float(time[i]), int(r[i]), x[i].tolist())
                    if np.isfinite(one[0]) and (seed not in best or one < best[seed]):
                        best[seed] = one
        for seed, (t, r1, x1) in best.items():
            yield pa.RecordBatch.from_pydict({"seed": pa.array([seed], pa.int64()), "t": pa.array([t]),
                                              "r": pa.array([r1], pa.int64()), "x": pa.array([x1], pa.list_(pa.float64()))})
    return run


def starts(rows: DataFrame, k: int, seeds: list[int]) -> dict[int, list[list[float]]]:
    """Up to ``k`` starting centers of every seed, in the order they were drawn."""
    out: dict[int, list[list[float]]] = {s: [] for s in seeds}
    live = list(seeds)
    for step in range(k):
        found = (rows.mapInArrow(_race(step, {s: out[s] for s in live}), "seed bigint, t double, r bigint, x array<double>")
                 .groupBy("seed").agg(F.min(F.struct("t", "r", "x")).alias("b")).collect())
        live = [f["seed"] for f in found]  # the others have a center at every vector
        for f in found:
            out[f["seed"]].append(list(f["b"]["x"]))
        if not live:
            break
    return out


def _room(centers: int) -> list[np.ndarray]:
    return [np.empty((centers, BLOCK)), np.empty((centers, BLOCK), bool), np.empty((centers, BLOCK))]


def _near(x: np.ndarray, centers: np.ndarray, sizes: list[int], room: list[np.ndarray]) -> np.ndarray:
    """Centers by rows: 1 where a center is the nearest of its model (the lowest
    cluster of a tie).  ``room`` holds the arrays of :func:`_room`, used again
    for each block: fresh ones of this size cost more than the arithmetic."""
    score, least, hit = (a[:, :len(x)] for a in room)
    with np.errstate(over="ignore", invalid="ignore"):
        norm = (centers ** 2).sum(axis=1)
        reach = np.sqrt(norm.max()) + np.sqrt((x ** 2).sum(axis=1))
        slack = 8 * (x.shape[1] + 4) * _EPS * reach ** 2
        np.matmul(np.column_stack([-2.0 * centers, norm]), np.column_stack([x, np.ones(len(x))]).T, out=score)
        at = 0
        for size in sizes:
            own = score[at:at + size]
            np.less_equal(own, own.min(axis=0) + slack, out=least[at:at + size])
            at += size
    np.copyto(hit, least)
    # A finite row has one mark a model or more.
    open_ = np.flatnonzero((np.ones(len(hit)) @ hit != len(sizes)) | ~np.isfinite(slack))
    if len(open_):
        far = squared_distances(x[open_], centers)
        at = 0
        for size in sizes:
            near = far[:, at:at + size].argmin(axis=1)
            hit[at:at + size, open_] = 0.0
            hit[at + near, open_] = 1.0
            at += size
    return hit


def _step(models: dict[int, list], with_cost: bool):
    names = list(models)
    sizes = [len(models[m]) for m in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = np.array([c for m in names for c in models[m]])
        total, cost = np.zeros((len(centers), centers.shape[1] + 1)), np.zeros(len(centers))
        room = _room(len(centers))
        for _, x in _blocks(batches):
            hit = _near(x, centers, sizes, room)
            total += hit @ np.concatenate([x, np.ones((len(x), 1))], axis=1)
            if with_cost:
                own, row = np.nonzero(hit)
                cost += np.bincount(own, ((x[row] - centers[own]) ** 2).sum(axis=1), len(centers))
        at = np.concatenate([np.arange(s) for s in sizes])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(names, sizes), pa.int64()), pa.array(at, pa.int32()), pa.array(total[:, -1]), pa.array(cost),
             pa.array(total[:, :-1].tolist(), pa.list_(pa.float64()))], ["model", "cluster", "n", "cost", "s"])
    return run


def step(rows: DataFrame, models: dict[int, list], with_cost: bool = True) -> dict[int, list[tuple[int, float, list[float]]]]:
    """Per model and cluster the members, their cost (0 without ``with_cost``) and their sums."""
    dim = len(next(iter(models.values()))[0])
    sums = [F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(dim)]
    cells = (rows.mapInArrow(_step(models, with_cost), "model bigint, cluster int, n double, cost double, s array<double>")
             .groupBy("model", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *sums).collect())
    out = {m: [(0, 0.0, [0.0] * dim)] * len(c) for m, c in models.items()}
    for c in cells:
        out[c["model"]][c["cluster"]] = (int(c["n"]), c["cost"], [c[f"s{i}"] for i in range(dim)])
    return out


class Fit:
    """One fitted model: ``centers``, members per cluster and the inertia."""

    def __init__(self, k: int, seed: int, centers: list[list[float]]):
        self.k, self.seed, self.centers = k, seed, centers
        self.sizes: list[int] = []
        self.inertia = 0.0


def fit_all(rows: DataFrame, ks, seeds: list[int], max_iter: int = 300, tol: float = 1e-4) -> list[Fit]:
    """A model for every ``k`` and seed.  A model settles when no center moves
    by more than ``tol``; settled ones take no part in later steps."""
    ks = sorted(set(int(k) for k in ks))
    first = starts(rows, max(ks), list(seeds))
    fits = [Fit(k, s, first[s][:k]) for k in ks for s in seeds if first[s]]
    live = list(range(len(fits)))
    for _ in range(max_iter):
        if not live:
            break
        cells = step(rows, {i: fits[i].centers for i in live}, with_cost=False)
        moving = []
        for i in live:
            new = [[v / n for v in s] if n else c for (n, _, s), c in zip(cells[i], fits[i].centers)]
            far = max(sum((a - b) ** 2 for a, b in zip(c, d)) for c, d in zip(new, fits[i].centers))
            fits[i].centers = new
            if far > tol * tol:
                moving.append(i)
        live = moving
    if fits:
        cells = step(rows, {i: f.centers for i, f in enumerate(fits)})
        for i, f in enumerate(fits):
            f.sizes, f.inertia = [c[0] for c in cells[i]], sum(c[1] for c in cells[i])
    return fits


def best(fits: list[Fit]) -> dict[int, Fit]:
    """The model of least inertia for each ``k`` (the lower seed of a tie)."""
    out: dict[int, Fit] = {}
    for f in sorted(fits, key=lambda f: (f.k, f.inertia, f.seed)):
        out.setdefault(f.k, f)
    return out


def knee(inertia: dict[int, float]) -> int | None:
    """The ``k`` whose point lies farthest below the line from the first to the
    last one, both axes scaled to 1 (the lowest of a tie)."""
    ks = sorted(inertia)
    if not ks:
        return None
    span, drop = (ks[-1] - ks[0]) or 1, (inertia[ks[0]] - inertia[ks[-1]]) or 1.0
    below = {k: 1 - (k - ks[0]) / span - (inertia[k] - inertia[ks[-1]]) / drop for k in ks}
    return max(ks, key=lambda k: (below[k], -k))
