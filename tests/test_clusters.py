import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigear.operators import clusters as cl
from lexigear.operators import features as ft
from lexigear.operators import outliers as ol
from lexigear.plans import gearbox


def points(n=400, m=3, seed=1):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(c, 0.5, (n // 2, m)) for c in (0.0, 4.0)])


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, f"Run_{i % 3}.csv", "ab"[i % 2], r.tolist()) for i, r in enumerate(points())]
    return spark.createDataFrame(rows, "point_id long, source_file string, label string, features array<double>").persist()


def test_assemble_refuses_nulls(spark):
    df = spark.createDataFrame([(1.0, 2), (None, 3)], "a double, b int")
    assert ft.assemble(df.where("a IS NOT NULL"), ["a", "b"]).head().features == [1.0, 2.0]
    with pytest.raises(Exception, match="null or NaN in column a"):
        ft.assemble(df, ["a", "b"]).collect()


@pytest.mark.parametrize("width", [2, 70])
def test_scaling(spark, width):
    x = np.random.default_rng(0).normal(3, 2, (40, width))
    x[:, 1] = 7.0
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, features array<double>")
    sample = np.array([r.features for r in ft.standardize(df).orderBy("i").collect()])
    whole = np.array([r.features for r in ft.normalize_pop(df).orderBy("i").collect()])
    np.testing.assert_allclose(sample[:, 0], (x[:, 0] - x[:, 0].mean()) / x[:, 0].std(ddof=1))
    np.testing.assert_allclose(whole[:, 0], (x[:, 0] - x[:, 0].mean()) / x[:, 0].std())
    np.testing.assert_allclose(sample[:, 1], 0.0)
    np.testing.assert_allclose(whole[:, 1], 0.0)


def test_one_hot_layout(spark):
    df = spark.createDataFrame([(5.0, "udp", "SF", 9), (6.0, "tcp", "S0", 8)], "d double, p string, s string, n int")
    rows = ft.one_hot(df, "d", ("p", "s"), ("n",)).orderBy("d").collect()
    assert [r.features for r in rows] == [[5.0, 0.0, 1.0, 0.0, 1.0, 9.0], [6.0, 1.0, 0.0, 1.0, 0.0, 8.0]]
    assert ft.categories(df, ["p", "s"]) == {"p": ["tcp", "udp"], "s": ["S0", "SF"]}


def test_sparse_rows_equal_dense_ones(spark):
    rows = [(float(i), "abc"[i % 3] if i % 7 else None, f"s{i % 90:02d}", i * 0.5) for i in range(300)]
    df = spark.createDataFrame(rows, "d double, p string, s string, n double")
    dense = {r.d: r.features for r in ft.one_hot(df, "d", ("p", "s"), ("n",)).collect()}
    for shipped in (1000, 0):
        for r in ft.one_hot_sparse(df, "d", ("p", "s"), ("n",), max_shipped=shipped).collect():
            x = [0.0] * r.features["size"]
            for i, v in zip(r.features["indices"], r.features["values"]):
                x[i] = v
            assert x == dense[r.d]
            assert len(r.features["indices"]) == 3 + (r.p is not None)
    other = spark.createDataFrame([(1.0, "zz", None, 2.0)], df.schema)
    r = ft.one_hot_sparse(other, "d", ("p", "s"), ("n",), ft.category_index(df, ("p", "s"))).head().features
    assert (r["size"], r["indices"], r["values"]) == (95, [0, 94], [1.0, 2.0])
    none = ft.one_hot_sparse(df.limit(0), "d", ("p", "s"), ("n",))
    assert none.count() == 0


def test_kmeans_takes_sparse_rows(spark):
    rows = [(100.0 * (i % 2) + i % 5, f"c{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "d double, p string")
    dense = ft.one_hot(df, "d", ("p",), ())
    sparse = ft.sparse_vectors(ft.one_hot_sparse(df, "d", ("p",), ()))
    scored = []
    for frame in (dense, sparse):
        model = cl.kmeans_fit(frame, 2)
        scored.append({r.p: r.distance for r in cl.score(frame, model).collect()})
    assert scored[0] == pytest.approx(scored[1])
    scaled = ft.scale_vectors(sparse)
    shifted = ft.normalize_pop(dense)
    a = cl.score(scaled, cl.kmeans_fit(scaled, 2)).agg(F.sum("distance")).head()[0]
    assert a == pytest.approx(cl.score(shifted, cl.kmeans_fit(shifted, 2)).agg(F.sum("distance")).head()[0], rel=0.05)
    spread = np.array([r.features.toArray() for r in scaled.orderBy("p").collect()])
    np.testing.assert_allclose(spread.std(axis=0), 1.0)


def test_sweep_scans_twice(spark, data):
    """The same report as scoring each k for itself."""
    found = gearbox.sweep_k(data, (2, 3, 5), top_n=4, threshold_rank=10, keep=["label"])
    for r in found.summary.collect():
        scored = cl.score(data, cl.kmeans_fit(data, r.k))
        rows = ol.top_outliers(scored, 10).collect()
        assert r.avg_distance == pytest.approx(scored.agg(F.avg("distance")).head()[0])
        assert (r.threshold, r.total, r.anomalies) == (pytest.approx(rows[-1].distance), 400, sum(x.distance > rows[-1].distance for x in rows))
        mine = found.outliers.where(F.col("k") == r.k).collect()
        assert [(x.point_id, x.prediction, x.label) for x in mine] == [(x.point_id, x.prediction, x.label) for x in rows[:4]]
    same = spark.createDataFrame([(i, [1.0]) for i in range(300)], "point_id long, features array<double>")
    tied = gearbox.sweep_k(same, (2,), keep=[])
    assert [x.point_id for x in tied.outliers.collect()] == list(range(25))
    assert (tied.summary.head().avg_distance, tied.summary.head().anomalies) == (0.0, 0)


def test_lloyd_explodes_nothing(data, capsys):
    points = cl.assign(data, [[0.0] * 3, [4.0] * 3])
    points.explain()
    assert "Generate" not in capsys.readouterr().out


def test_assign(spark, data):
    centers = [[0.0, 0.0, 0.0], [4.0, 4.0, 4.0], [9.0, 9.0, 9.0]]
    x = points()
    d = np.linalg.norm(x[:, None, :] - np.array(centers)[None], axis=2)
    rows = cl.assign(data, centers).orderBy("point_id").collect()
    assert [r.prediction for r in rows] == d.argmin(axis=1).tolist()
    np.testing.assert_allclose([r.distance for r in rows], d.min(axis=1))
    odd = spark.createDataFrame([(1, None), (2, [2.0, 2.0, 2.0])], "i int, features array<double>")
    found = {r.i: (r.prediction, r.distance) for r in cl.assign(odd, centers).collect()}
    assert found == {1: (None, None), 2: (0, pytest.approx(math.sqrt(12)))}


def test_lloyd(data):
    x = points()
    centers = np.array(cl.first_centers(data, 2, "point_id"))
    np.testing.assert_array_equal(centers, x[:2])
    for _ in range(3):
        nearest = np.linalg.norm(x[:, None] - centers[None], axis=2).argmin(axis=1)
        centers = np.array([x[nearest == c].mean(axis=0) for c in (0, 1)])
    np.testing.assert_allclose(cl.kmeans_lloyd(data, x[:2].tolist(), 3), centers)


def test_lloyd_keeps_an_empty_center(data):
    centers = cl.kmeans_lloyd(data, [[0.0] * 3, [4.0] * 3, [99.0] * 3], 2)
    assert centers[2] == [99.0] * 3


def test_model_scores(data):
    model = cl.kmeans_fit(data, 2)
    scored = cl.score(data, model)
    total = scored.agg(F.sum(F.col("distance") ** 2)).head()[0]
    assert total == pytest.approx(model.summary.trainingCost)
    again = cl.assign(data, cl.model_centers(model)).select("point_id", F.col("distance").alias("d"), F.col("prediction").alias("p"))
    both = scored.join(again, "point_id")
    assert both.where("prediction <> p OR abs(distance - d) > 1e-9").count() == 0
    frame = cl.centers_frame(data.sparkSession, cl.model_centers(model)).orderBy("cluster").collect()
    assert [r.cluster for r in frame] == [0, 1]
    assert cl.model_centers(cl.kmeans_default(data, 2))


def test_entropy(spark):
    def entropy(rows):
        return cl.cluster_entropy(spark.createDataFrame(rows, "prediction int, label string")).head()[0]

    assert entropy([(0, "a")] * 5 + [(1, "b")] * 3) == pytest.approx(0.0)
    assert entropy([(0, "a"), (0, "b"), (1, "a"), (1, "b")]) == pytest.approx(math.log(2))
    mixed = entropy([(0, "a")] * 3 + [(0, "b")] + [(1, "b")] * 4)
    assert mixed == pytest.approx(0.5 * -(0.75 * math.log(0.75) + 0.25 * math.log(0.25)))


def test_label_counts(data):
    scored = cl.assign(data, [[0.0] * 3, [4.0] * 3])
    assert [(r.label, r.n) for r in cl.label_counts(data).collect()] == [("a", 200), ("b", 200)]
    assert sum(r.n for r in cl.cluster_label_counts(scored).collect()) == 400


def test_elbow(spark):
    rows = spark.createDataFrame([(2, 10.0), (3, 9.0), (4, 6.0), (5, 5.5)], "k int, avg_distance double")
    found = {r.k: (r["drop"], r.largest_drop) for r in cl.elbow_deltas(rows).collect()}
    assert found == {2: (None, False), 3: (1.0, False), 4: (3.0, True), 5: (0.5, False)}


def scored_rows(spark, distances):
    rows = [(i, i % 2, d) for i, d in enumerate(distances)]
    return spark.createDataFrame(rows, "point_id long, prediction int, distance double")


def test_outliers_and_threshold(spark):
    scored = scored_rows(spark, [1.0, 5.0, 5.0, 3.0, None, 4.0])
    assert [r.point_id for r in ol.top_outliers(scored, 3).collect()] == [1, 2, 5]
    assert len(ol.top_outliers(scored, 50).collect()) == 5
    assert ol.anomaly_threshold(scored, 3).head()[0] == 4.0
    assert ol.anomaly_threshold(scored, 50).head()[0] == 1.0
    assert sorted(r.point_id for r in ol.anomalies(scored, n=3).collect()) == [1, 2]
    # A tie at the cut: both fives are not above the threshold five.
    assert ol.anomalies(scored, n=2).count() == 0
    share = ol.anomaly_share(scored, 3).head()
    assert (share.threshold, share.total, share.anomalies) == (4.0, 6, 2)
    assert share.percent == pytest.approx(100 * 2 / 6)


def test_top_report_needs_no_full_sort(data):
    plan = ol.top_outliers(cl.assign(data, [[0.0] * 3]))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_fixed_sample(spark):
    df = spark.range(500).withColumnRenamed("id", "point_id")
    one = {r[0] for r in ol.fixed_sample(df, 50).collect()}
    assert one == {r[0] for r in ol.fixed_sample(df.repartition(9), 50).collect()}
    assert len(one) == 50 and one != {r[0] for r in ol.fixed_sample(df, 50, seed=1).collect()}
    assert ol.fixed_sample(df, 5000).count() == 500


def test_projection(data):
    scored = cl.assign(data, [[0.0] * 3, [4.0] * 3])
    sample = ol.fixed_sample(scored, 100)
    found, explained = ol.project_2d(scored, sample, n=7)
    rows = found.collect()
    x = points()
    _, s, vt = np.linalg.svd(x - x.mean(axis=0))
    np.testing.assert_allclose(explained, (s**2 / (s**2).sum())[:2], rtol=1e-8)
    xy = np.array([[r.x, r.y] for r in rows])
    own = np.array([x[r.point_id] for r in rows]) @ vt[:2].T
    np.testing.assert_allclose(np.abs(xy), np.abs(own), atol=1e-8)
    flagged = {r.point_id for r in rows if r.is_outlier}
    assert flagged == {r.point_id for r in sorted(rows, key=lambda r: (-r.distance, r.point_id))[:7]}


def test_sources_and_overlap(spark):
    tops = spark.createDataFrame([(2, 1, "f"), (2, 2, "g"), (3, 1, "f"), (3, 9, "f")], "k int, point_id long, source_file string")
    assert {(r.k, r.source_file): r.n for r in ol.outlier_sources(tops).collect()} == {(2, "f"): 1, (2, "g"): 1, (3, "f"): 2}
    assert [tuple(r) for r in ol.outlier_overlap(tops).collect()] == [(2, 3, 1)]


def test_relative_distance(spark):
    scored = scored_rows(spark, [1.0, 0.0, 7.0, 0.0])
    rows = {r.point_id: r.relative for r in ol.relative_distance(scored).collect()}
    assert rows == {0: pytest.approx(0.2), 2: pytest.approx(1.4), 1: None, 3: None}


def test_sweep(data):
    sweep = gearbox.sweep_k(data, ks=(2, 3), top_n=5, threshold_rank=20, keep=["source_file"])
    rows = sweep.summary.orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3] and rows[0].avg_distance > rows[1].avg_distance
    for r in rows:
        scored = cl.assign(data, sweep.centers[r.k])
        share = ol.anomaly_share(scored, 20).head()
        assert (r.total, r.anomalies) == (share.total, share.anomalies)
        assert r.threshold == pytest.approx(share.threshold)
        best = [t.point_id for t in ol.top_outliers(scored, 5).collect()]
        kept = sweep.outliers.where(F.col("k") == r.k).orderBy(F.desc("distance"), "point_id").collect()
        assert [t.point_id for t in kept] == best
    assert gearbox.sweep_entropy(data, (2,)).count() == 1
    assert gearbox.sweep_scores(data, (2,)).count() == 1
