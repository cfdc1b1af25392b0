"""Scaler, K-Means scoring, exact percentile, md5 split and isolation forest."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import features, iforest, kmeans, lloyd, sampling


def test_scaler_population_std_and_constant_column(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (4, 5)], "a int, b int")
    sc = {r.feature: r for r in features.fit_scaler(df, ["a", "b"]).collect()}
    assert sc["a"].std == pytest.approx(np.std([1, 2, 4]))
    assert sc["b"].std == 1.0
    out = features.scale(df, features.scaler_params(features.fit_scaler(df, ["a", "b"]), ["a", "b"]), ["a", "b"])
    vals = np.array([r.scaled_features for r in out.collect()])
    assert vals[:, 0].mean() == pytest.approx(0, abs=1e-6)
    assert vals[:, 0].std() == pytest.approx(1, abs=1e-6)
    assert (vals[:, 1] == 0).all()


def test_threshold_float_semantics(spark):
    centers = [(0, [0.0])]
    df = spark.createDataFrame([([2.6],), ([2.7],), ([3.0],), ([3.1],)], "scaled_features array<double>")
    out = kmeans.label(kmeans.assign(df, centers), 2.6)
    out = kmeans.label(out, 3.0, out="flag", as_flag=True)
    got = [(r.anomaly, r.flag) for r in out.orderBy(F.col("scaled_features")[0]).collect()]
    assert got == [("NORMAL", 0), ("ANOMALY", 0), ("ANOMALY", 0), ("ANOMALY", 1)]


def test_tie_goes_to_lower_cluster(spark):
    centers = [(3, [1.0, 0.0]), (1, [-1.0, 0.0])]
    df = spark.createDataFrame([([0.0, 0.0],)], "scaled_features array<double>")
    assert kmeans.assign(df, centers).first().prediction.cluster == 1


def test_nearest_center_matches_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 7))
    C = rng.normal(size=(5, 7))
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id int, scaled_features array<double>")
    got = {r.id: r.prediction.cluster for r in kmeans.assign(df, [(i, list(c)) for i, c in enumerate(C)]).collect()}
    want = ((X[:, None, :] - C[None, :, :]) ** 2).sum(-1).argmin(1)
    assert [got[i] for i in range(200)] == list(want)


def test_elbow_cost_decreases(spark):
    rng = np.random.default_rng(1)
    pts = np.concatenate([rng.normal(loc=m, scale=0.1, size=(50, 2)) for m in (0, 5, 10)])
    df = spark.createDataFrame([([float(a), float(b)],) for a, b in pts], "scaled_features array<double>")
    table = {r.k: r.inertia for r in kmeans.elbow(df, [1, 2, 3, 4], n_init=3).collect()}
    assert table[1] == pytest.approx(((pts - pts.mean(0)) ** 2).sum(), rel=1e-9)
    assert table[1] > table[2] > table[3] >= table[4]
    assert table[3] < 0.05 * table[1]


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.9, 0.999, 1.0])
def test_exact_percentile_matches_numpy(spark, p):
    rng = np.random.default_rng(2)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.exponential(size=1000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = sampling.exact_percentile(df, "x", p, buckets=16, band_rows=50)
    assert got == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)


def test_md5_split_is_stable(spark):
    df = spark.range(10000).withColumnRenamed("id", "k")
    part = sampling.md5_split_column("k", [0.7, 0.3], ["train", "test"], seed=5043)
    a = {r.k: r.p for r in df.select("k", part.alias("p")).collect()}
    b = {r.k: r.p for r in df.repartition(7).select("k", part.alias("p")).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.67 < share < 0.73


def _forest_data(spark, n=3000, outliers=30):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(n, 3))
    X[:outliers] += 8.0
    return spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "id long, a double, b double, c double")


def test_forest_invariants(spark):
    df = _forest_data(spark)
    feats = ["a", "b", "c"]
    nodes, psi = iforest.fit(df, feats, key="id", n_trees=50, max_samples=128, seed=7)
    assert psi == 128
    model = iforest.ForestModel(nodes, psi, n_trees=50)
    scored = iforest.score(df, model, feats)
    cut = iforest.threshold(scored, 0.1)
    labelled = iforest.label(scored, cut).collect()
    s = {r.id: r.anomaly_score for r in labelled}
    p95 = np.quantile(list(s.values()), 0.95)
    assert sum(s[i] > p95 for i in range(30)) >= 27          # planted outliers rank on top
    rate = sum(r.anomaly for r in labelled) / len(labelled)
    assert 0.09 <= rate <= 0.11
    # determinism and row-order independence
    nodes2, _ = iforest.fit(df.repartition(5).orderBy(F.rand(1)), feats, key="id", n_trees=50, max_samples=128, seed=7)
    canon = lambda t: sorted(tuple(r) for r in t.collect())
    assert canon(nodes) == canon(nodes2)


def test_forest_small_input_uses_per_tree_samples(spark):
    df = _forest_data(spark, n=300, outliers=5)
    nodes, psi = iforest.fit(df, ["a", "b", "c"], key="id", n_trees=20, max_samples=256, seed=1)
    assert psi == 256
    sizes = [r.size for r in nodes.filter("node_id = 1").collect()]
    assert len(sizes) == 20 and all(s == 256 for s in sizes)


def _plain_forest(rows, n_trees, psi, seed):
    """The forest by plain loops: {(tree, node): (feature, cut, size)}."""
    import hashlib

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()
    out = {}
    depth = int(np.ceil(np.log2(max(psi, 2))))
    for t, a, b in iforest.tree_hashes(n_trees, seed):
        order = []
        for k, *x in rows:
            h = md5(f"{seed}:{k}")
            order.append(((int(h[:15], 16) % iforest.PRIME * a + b) % iforest.PRIME, h, x))
        stack = [(1, [x for _, _, x in sorted(order)[:psi]])]
        while stack:
            node, part = stack.pop()
            lo, hi = np.min(part, axis=0), np.max(part, axis=0)
            use = [i for i in range(len(lo)) if hi[i] > lo[i]]
            if not use or node >= 1 << depth:
                out[t, node] = (-1, None, len(part))
                continue
            h = md5(f"{seed}:{t}:{node}")
            f = use[int(h[:8], 16) % len(use)]
            cut = lo[f] + int(h[8:21], 16) / 2.0 ** 52 * (hi[f] - lo[f])
            cut = lo[f] if cut >= hi[f] else cut
            out[t, node] = (f, cut, len(part))
            stack.append((2 * node, [x for x in part if x[f] <= cut]))
            stack.append((2 * node + 1, [x for x in part if x[f] > cut]))
    return out


@pytest.mark.parametrize("n,psi", [(40, 64), (700, 32)])
def test_forest_against_plain_loops(spark, n, psi):
    rng = np.random.default_rng(n)
    rows = [(k, float(rng.integers(4)), float(rng.normal()), 1.0) for k in range(n)]
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(3)
    nodes, used = iforest.fit(df, ["a", "b", "c"], key="id", n_trees=7, max_samples=psi, seed=9)
    got = {(r.tree_id, r.node_id): (r.feature, r.cut, r.size) for r in nodes.collect()}
    assert used == min(psi, n + 2) and got == _plain_forest(rows, 7, used, 9)


def test_forest_short_samples_are_drawn_again(spark, monkeypatch):
    """A share too small for one tree gives the same trees in the end."""
    df = _forest_data(spark, n=600, outliers=5)
    want = sorted(map(tuple, iforest.fit(df, ["a", "b", "c"], "id", 10, 64, 2)[0].collect()))
    taken = iforest.sample(df, "id", ["a", "b", "c"], 10, 64, 2, 600 * 6)
    assert sorted(map(tuple, iforest.grow(taken, 3, 64, 2).collect())) == want


def test_forest_one_row(spark):
    df = spark.createDataFrame([(1, 2.0)], "id long, a double")
    nodes, psi = iforest.fit(df, ["a"], "id", 3, 8, 1)
    assert psi == 1 and [(r.node_id, r.feature, r.size) for r in nodes.collect()] == [(1, -1, 1)] * 3


def _plain_kmeans(rows, k, seed, rounds):
    """Race start and Lloyd steps over (key, vector) rows by plain loops."""
    import hashlib
    r = [int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16) % lloyd.PRIME for i, _ in rows]
    X = np.array([x for _, x in rows])
    centers = []
    for step in range(k):
        a, b = lloyd.draw(seed, step)
        time = [-np.log(((v * a + b) % lloyd.PRIME + 0.5) / lloyd.PRIME) for v in r]
        if centers:
            d = [min(((x - c) ** 2).sum() for c in centers) for x in X]
            time = [t / v if v > 0 else np.inf for t, v in zip(time, d)]
        if np.isfinite(min(time)):
            centers.append(X[int(np.argmin(time))].copy())
    for _ in range(rounds):
        near = [int(np.argmin([((x - c) ** 2).sum() for c in centers])) for x in X]
        centers = [X[[i for i, n in enumerate(near) if n == j]].mean(0) if j in near else c for j, c in enumerate(centers)]
    return np.array(centers), sum(min(((x - c) ** 2).sum() for c in centers) for x in X)


def test_lockstep_models_match_plain_loops(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=3) + 4 * (i % 4)]) for i in range(300)]
    df = spark.createDataFrame([*rows, (900, None), (901, [1.0, None, 2.0])], "id long, x array<double>").repartition(3)
    for max_iter in (0, 2):
        fits = lloyd.fit_all(lloyd.vectors(df, "x", "id"), [1, 3, 5], [7, 8], max_iter=max_iter, tol=0.0)
        assert [(f.k, f.seed) for f in fits] == [(k, s) for k in (1, 3, 5) for s in (7, 8)]
        for f in fits:
            centers, cost = _plain_kmeans(rows, f.k, f.seed, max_iter)
            assert np.allclose(f.centers, centers) and f.inertia == pytest.approx(cost) and sum(f.sizes) == 300


def test_lockstep_settles(spark):
    rng = np.random.default_rng(6)
    pts = np.concatenate([rng.normal(loc=m, scale=0.1, size=(60, 2)) for m in (0, 5, 10)])
    df = spark.createDataFrame([([float(a), float(b)],) for a, b in pts], "scaled_features array<double>")
    table = kmeans.elbow(df, range(1, 7), n_init=4).collect()
    assert [r.k for r in table if r.knee] == [3]
    centers, cost = kmeans.train_kmeans(df, 3, n_init=4)
    assert cost == pytest.approx(sum(((pts[i:i + 60] - pts[i:i + 60].mean(0)) ** 2).sum() for i in (0, 60, 120)))
    assert sorted(r.cluster for r in centers.collect()) == [0, 1, 2]


def test_fewer_vectors_than_centers(spark):
    df = spark.createDataFrame([(i, [1.0 * (i % 2)]) for i in range(9)], "id long, x array<double>")
    fits = lloyd.fit_all(lloyd.vectors(df, "x", "id"), [4], [1])
    assert [len(f.centers) for f in fits] == [2] and fits[0].inertia == 0 and sorted(fits[0].sizes) == [4, 5]
    none = spark.createDataFrame([], "id long, x array<double>")
    assert lloyd.fit_all(lloyd.vectors(none, "x", "id"), [2], [1]) == []


def test_near_marks_follow_plain_distances():
    """Ties go to the lowest cluster, far rows are not decided by rounding."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(lloyd.BLOCK, 3)), 1)
    x[:50] += 1e8
    x[50] = [np.inf, 0.0, 0.0]
    sizes = [1, 2, 5, 5]
    centers = np.concatenate([x[100:108], [[1.0, 0, 0], [-1.0, 0, 0], [0, 1.0, 0], [0, -1.0, 0], [1e8, 1e8, 1e8 + 0.5]]])
    x[60:80] = 0.0
    room = lloyd._room(len(centers))
    for rows in (x, x[:70]):
        hit, at = lloyd._near(rows, centers, sizes, room), 0
        for size in sizes:
            want = lloyd.squared_distances(rows, centers[at:at + size]).argmin(axis=1)
            assert (hit[at:at + size].sum(axis=0) == 1).all() and (hit[at:at + size].argmax(axis=0) == want).all()
            at += size


@pytest.mark.parametrize("batch", ["100", "10000"])
def test_vectors_are_stored_in_blocks(spark, batch):
    """A step reads blocks of bytes, not a list per row, whatever the Arrow batches."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    df = spark.range(3000).selectExpr("id", "array(id * 1.0D, 2.0D) as x").coalesce(1)
    rows = lloyd.vectors(df, "x", "id")
    assert rows.count() == 3 and {f.dataType.simpleString() for f in rows.schema} == {"binary"}
    fit, = lloyd.fit_all(rows, [1], [1])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert fit.sizes == [3000] and fit.centers == [[1499.5, 2.0]]


def test_knee():
    assert lloyd.knee({1: 100.0, 2: 50.0, 3: 10.0, 4: 9.0, 5: 8.0}) == 3
    assert lloyd.knee({}) is None and lloyd.knee({4: 2.0}) == 4


def test_more_centers_than_a_block(spark):
    centers = spark.createDataFrame([(i, [float(i), float(i % 7)]) for i in range(2500)], kmeans.CENTERS_SCHEMA)
    df = spark.createDataFrame([(i, [i * 2.5, 3.0]) for i in range(0, 1000, 37)], "id int, scaled_features array<float>")
    vecs = [(float(i), float(i % 7)) for i in range(2500)]
    got = kmeans.assign(df, centers)
    assert "from_json" not in got._jdf.queryExecution().optimizedPlan().toString()  # folded to a constant
    for r in got.collect():
        x, y = r.scaled_features
        d = [((x - a) ** 2 + (y - b) ** 2) ** 0.5 for a, b in vecs]
        assert r.prediction.cluster == d.index(min(d)) and abs(r.prediction.distance - min(d)) < 1e-4


@pytest.mark.parametrize("n", [2, 200])
def test_vectors_of_another_length_have_no_distance(spark, n):
    df = spark.createDataFrame([([1.0],), ([1.0, 2.0, 3.0],)], "scaled_features array<float>")
    got = kmeans.assign(df, [(i, [float(i), 0.0]) for i in range(n)]).collect()
    assert [r.prediction.distance for r in got] == [None, None]


def test_centers_of_many_groups(spark):
    df = spark.range(3000).selectExpr("cast(id as string) as g", "array(cast(id as float)) as scaled_features")
    model = kmeans.centroids_by_group(df, "g", dim=1)
    names = sorted(map(str, range(3000)))
    assert kmeans.centers_from_table(model) == [(i, [float(g)]) for i, g in enumerate(names)]
