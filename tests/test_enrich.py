"""Range lookups through buckets of addresses."""

import random

from pyspark.sql import functions as F

from flowlens.operators import enrich
from flowlens.plans import catalog
from flowlens.session import materialize


def _looked_up(spark, rows, keys, ready):
    ranges = spark.createDataFrame(rows, "ip_start long, ip_end long, city string")
    df = spark.createDataFrame([(k,) for k in keys], "ip_int long")
    got = enrich.range_lookup(df, materialize(enrich.bucket_ranges(ranges)) if ready else ranges).collect()
    want = {k: next((c for a, b, c in rows if k is not None and a <= k <= b), None) for k in keys}
    assert len(got) == len(keys) and all(r.city == want[r.ip_int] for r in got)


def test_small_ranges_have_narrow_buckets(spark):
    rng = random.Random(3)
    cuts = sorted(rng.sample(range(10 << 24, (10 << 24) + (1 << 20)), 600))
    rows = [(a, b - 1, f"c{a}") for a, b in zip(cuts[::2], cuts[1::2])]
    keys = [None, 0, 2 ** 32 - 1] + [c + d for c in cuts for d in (-1, 0)]
    ranges = spark.createDataFrame(rows, "ip_start long, ip_end long, city string")
    per = enrich.bucket_ranges(ranges).groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert per < 20  # 16 buckets of /16 would hold 19 or more
    for ready in (False, True):
        _looked_up(spark, rows, sorted(set(keys), key=str), ready)


def test_wide_ranges_keep_wide_buckets(spark, monkeypatch):
    rows = [(0, (1 << 24) - 1, "a"), (1 << 24, 2 ** 31 - 1, "b"), (2 ** 31, 2 ** 32 - 1, "c")]
    wide = enrich.bucket_ranges(spark.createDataFrame(rows, "ip_start long, ip_end long, city string"))
    assert wide.schema["_bucket"].metadata == {"bits": 16} and wide.count() == 65536
    _looked_up(spark, rows, [0, (1 << 24) - 1, 1 << 24, 2 ** 32 - 1, None], True)


def test_no_ranges(spark):
    empty = spark.createDataFrame([], "ip_start long, ip_end long, city string")
    df = spark.createDataFrame([(5,)], "ip_int long")
    assert [r.city for r in enrich.range_lookup(df, empty).collect()] == [None]


def test_scoring_parses_the_features_once_for_its_model(spark, sf_small, monkeypatch):
    """Both fits read stored features, not the packets."""
    seen = []
    fit, centers = catalog.features.fit_scaler, catalog._centers
    monkeypatch.setattr(catalog.features, "fit_scaler", lambda df, *a: (seen.append(df), fit(df, *a))[1])
    monkeypatch.setattr(catalog, "_centers", lambda df: (seen.append(df), centers(df))[1])
    assert catalog.q_lineitem_score(spark, sf_small).count() > 0
    assert len(seen) == 2 and not any("lineitem" in f for df in seen for f in df.inputFiles())
