import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigear.operators import clusters as cl
from lexigear.operators import leaves as lv
from lexigear.operators import xorshift as xs
from lexigear.plans import gearbox


def flagged(n, seed=0):
    """Numbers beside flags, some of them equal."""
    rng = np.random.default_rng(seed)
    flags = np.eye(5)[rng.integers(0, 5, n)] / 0.4
    return np.hstack([rng.integers(0, 9, (n, 1)) / 3.0, flags, rng.normal(size=(n, 1))])


def frame(spark, x, parts):
    rows = [(i, "ab"[i % 2] if i % 7 else None, r.tolist()) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "point_id long, label string, features array<double>").repartition(parts, "point_id").persist()


@pytest.fixture
def small_chunks(spark, monkeypatch):
    """Several chunks for each partition."""
    monkeypatch.setattr(lv, "CHUNK", 3000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


SETS = [flagged(5000), np.random.default_rng(1).normal(size=(1500, 12)), np.ones((200, 2)), np.random.default_rng(2).integers(0, 3, (4000, 2)).astype(float), flagged(3)]


@pytest.mark.parametrize("x", SETS, ids=["flags", "wide", "equal", "grid", "few"])
def test_leaves_compare_few_centers_and_lose_none(x):
    order, ends = lv.leaf_order(x)
    assert sorted(order) == list(range(len(x))) and 0 < np.diff(ends, prepend=0).min() and np.diff(ends, prepend=0).max() <= lv.LEAF
    points, first = x[order], np.r_[0, ends[:-1]]
    leaves = lv.Leaves(points, ends, np.minimum.reduceat(points, first), np.maximum.reduceat(points, first), np.add.reduceat(points, first))
    for k in (1, 3, 40):
        centers = x[np.random.default_rng(k).integers(0, len(x), k)] + (0.01 if k == 3 else 0.0)
        distances = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
        least, own = distances.min(axis=1), leaves.clusters(centers)
        np.testing.assert_allclose(distances[np.arange(len(x)), own], least, atol=1e-9)
        np.testing.assert_allclose(leaves.costs(centers), least, atol=1e-9)
        shares = leaves.shares(centers)
        np.testing.assert_array_equal(shares[:, -1], np.bincount(own, minlength=k))
        for c in range(k):
            np.testing.assert_allclose(shares[c, :-1], points[own == c].sum(axis=0), atol=1e-8)
    if x is SETS[0]:
        kept = leaves.candidates(x[np.random.default_rng(9).choice(len(x), 40, False)])
        assert kept.any(axis=1).all() and kept.mean() < 0.2


def test_numbers_of_the_library(spark):
    for seed in (42, -7, 0, 1 << 20):
        java = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        mine = xs.XorShift(seed)
        assert java.nextInt() == mine.int32()
        assert [java.nextDouble() for _ in range(70)] == [*mine.random(1), *mine.random(0), *mine.random(69)]


def test_starts_of_the_library_in_shared_scans(spark, monkeypatch, small_chunks):
    """The library's own starts, in as many scans for all ks as for one."""
    data = frame(spark, flagged(4000), 5)
    points = cl.pack(data).persist()
    assert points.count() > 5
    scans = []
    with monkeypatch.context() as patched:
        patched.setattr(cl, "summed", lambda *a, f=cl.summed: scans.append(1) or f(*a))
        patched.setattr(cl, "kmeans_fit", None)
        found = cl.library_starts(points, (2, 3, 9, 30), 42)
    assert len(scans) == 3
    for k, centers in found.items():
        np.testing.assert_allclose(centers, cl.kmeans_start(data, k, 42), atol=1e-9)
    same = spark.createDataFrame([([1.0, 2.0],)] * 50, "features array<double>")
    assert cl.library_starts(cl.pack(same), (2, 4), 42)[4].tolist() == [[1.0, 2.0]]
    with pytest.raises(ValueError, match="needs points"):
        gearbox.fit_all(same.limit(0), (2,), seed=42)


def test_labels_and_distances_of_packed_points(spark, small_chunks):
    x = flagged(3000)
    data = frame(spark, x, 3)
    models = {2: x[:2], 20: x[:20]}
    scored = gearbox.with_predictions(data, models)
    points = cl.pack(data, label="label")
    found = {r[:3]: r.n for r in cl.clusters_by_label(points, models).collect()}
    for k in models:
        wanted = {(k, r[0], r.label): r.n for r in scored.groupBy(f"_p{k}", "label").agg(F.count("*").alias("n")).collect()}
        assert wanted == {key: n for key, n in found.items() if key[0] == k}
        sums = [r for r in cl.distance_sums(points, models).collect() if r.k == k]
        total = scored.agg(F.count("*"), F.sum(f"_d{k}")).head()
        assert (sum(r.n for r in sums), sum(r.total for r in sums)) == (total[0], pytest.approx(total[1]))
        assert all((r.bucket == cl.NO_DISTANCE) == (r.total == 0) for r in sums)
