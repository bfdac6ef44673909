"""Steps that must stay bounded, or share their scans, on large tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexigear import shared
from lexigear.operators import clusters as cl
from lexigear.operators import decomposition as dc
from lexigear.operators import search as se
from lexigear.operators import tokens as tk
from lexigear.plans import gearbox, lsa


def test_large_scan_is_dealt_by_bytes(spark, folder, monkeypatch):
    spark.range(20_000).coalesce(1).write.parquet(folder)
    scan = spark.read.parquet(folder)
    assert shared.spread(scan).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(shared, "BYTES_PER_TASK", 2048)
    for keys in ((), ("id",)):
        dealt = shared.spread(scan, *keys)
        assert dealt.rdd.getNumPartitions() == -(-shared.scan_bytes(scan) // 2048) > 16
        sizes = dealt.rdd.glom().map(len).collect()
        assert sum(sizes) == 20_000 and max(sizes) < 2_000


class Factors:
    """What ``scan_once`` reads of a model."""

    def __init__(self, documents, sigma):
        self.documents, self.sigma = documents, sigma


@pytest.mark.parametrize("cosine", [False, True])
def test_scores_in_slices(spark, monkeypatch, cosine):
    """Slices of a batch give the best of the whole batch, ties by id."""
    x = np.random.default_rng(3).integers(-2, 3, (400, 2)).astype(float)
    rows = [(i, f"d{i}", r.tolist()) for i, r in enumerate(x)]
    model = Factors(spark.createDataFrame(rows, "doc_id long, title string, u array<double>").coalesce(1), np.ones(2))
    block = [(np.array([0, 1]), spark.sparkContext.broadcast(np.array([[1.0, 0.0], [0.6, 0.8]])))]
    found = []
    for step in (500_000, 30):
        monkeypatch.setattr(se, "SCORES_PER_STEP", step)
        found.append(sorted(map(tuple, se.scan_once(model, block, 5, cosine).collect())))
    assert found[0] == found[1] and len(found[0]) == 10


def blobs(spark, n=900, m=3):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(c, 0.3, (n // 3, m)) for c in (0.0, 5.0, -5.0)])
    return x, spark.createDataFrame([(i, "abc"[i * 3 // n], r.tolist()) for i, r in enumerate(x)], "point_id long, label string, features array<double>").persist()


def test_fits_share_scans_and_equal_the_library(spark, monkeypatch):
    """All ks take their steps together, and end where the library's fits end."""
    _, data = blobs(spark)
    scans = []
    step = cl.kmeans_step
    monkeypatch.setattr(cl, "kmeans_step", lambda d, centers, *a: scans.append(sorted(centers)) or step(d, centers, *a))
    models, seconds = gearbox.fit_all(data, (2, 3, 5), seed=42, max_iter=50)
    assert scans[0] == [2, 3, 5] and len(scans) <= 50 and set(seconds) == {2, 3, 5}
    for k, centers in models.items():
        np.testing.assert_allclose(centers, cl.model_centers(cl.kmeans_fit(data, k, 42, 50)), atol=1e-9)


def test_shared_starts(spark):
    x, data = blobs(spark)
    models, _ = gearbox.fit_all(data, (3, 40))
    assert sorted(np.round(models[3].mean(axis=1)).tolist()) == [-5.0, 0.0, 5.0] and models[40].shape == (40, 3)
    costs = {k: ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum() for k, c in models.items()}
    library = {k: cl.kmeans_fit(data, k, 1, 20).summary.trainingCost for k in models}
    assert costs[3] == pytest.approx(library[3]) and costs[40] < 1.25 * library[40]
    assert gearbox.sweep_entropy(data, (3, 40)).collect() == [(3, pytest.approx(0.0)), (40, pytest.approx(0.0))]
    same = spark.createDataFrame([([1.0, 2.0],)] * 50, "features array<double>")
    assert {k: c.tolist() for k, c in gearbox.fit_all(same, (2, 4))[0].items()} == {2: [[1.0, 2.0]], 4: [[1.0, 2.0]]}
    for odd in ([1.0, None], [1.0, float("nan")], None):
        with pytest.raises(Exception, match="finite|features"):
            gearbox.fit_all(spark.createDataFrame([([1.0, 2.0],), (odd,)], same.schema), (2,))


def test_nearest_of_all(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, None), (2, [9.0])], "i int, features array<double>").coalesce(1)
    found = gearbox.with_predictions(df, {1: [[5.0]], 2: [[0.0], [10.0]]}).orderBy("i").collect()
    assert [(r._p1, r._p2) for r in found] == [(0, 0), (None, None), (0, 1)]


def test_distances_come_with_the_clusters(spark):
    """No expression over the centers is left in the plan of the scoring scans."""
    x, data = blobs(spark)
    models = {2: [[0.0] * 3, [5.0] * 3], 3: [[0.0] * 3, [5.0] * 3, [-5.0] * 3]}
    found = gearbox.with_predictions(data, models).orderBy("point_id").collect()
    for k, centers in models.items():
        d = np.linalg.norm(x[:, None] - np.array(centers)[None], axis=2)
        assert [r[f"_p{k}"] for r in found] == d.argmin(axis=1).tolist()
        np.testing.assert_allclose([r[f"_d{k}"] for r in found], d.min(axis=1), rtol=1e-12)


def test_product_of_terms_takes_one_pass(spark, monkeypatch):
    """Up to 1,024 terms A'A comes from one pass, whose rows are dense a part at a time."""
    rng = np.random.default_rng(6)
    a = rng.random((90, 600)) * (rng.random((90, 600)) < 0.1)
    rows = [(np.flatnonzero(r).tolist(), r[r != 0].tolist()) for r in a]
    frame = spark.createDataFrame([*rows, ([], [])], "ids array<int>, weights array<double>").persist()
    passes = []
    summed = dc.summed
    monkeypatch.setattr(dc, "summed", lambda *args: passes.append(1) or summed(*args))
    monkeypatch.setattr(dc, "DENSE_DOUBLES", 1800)
    np.testing.assert_allclose(dc.gram(frame, 600), a.T @ a, atol=1e-12)
    passes.clear()
    sigma, v = dc.factorize(frame, 600, 25)
    assert len(passes) == 1
    exact = np.linalg.svd(a, full_matrices=False)
    np.testing.assert_allclose(sigma, exact[1][:25], rtol=1e-10)
    np.testing.assert_allclose(np.abs((v * exact[2][:25].T).sum(axis=0)), 1.0, atol=1e-8)


def test_terms_that_come_twice_in_a_row_add_up(spark):
    frame = spark.createDataFrame([([1, 1, 0], [1.0, 2.0, 5.0]), ([2], [1.0])], "ids array<int>, weights array<double>")
    a = np.array([[5.0, 3.0, 0.0], [0.0, 0.0, 1.0]])
    assert dc.gram_times(frame, np.eye(3)).tolist() == dc.gram(frame, 3).tolist() == (a.T @ a).tolist()


def test_lemmas_are_looked_up_in_slices(spark, monkeypatch):
    """Slices hold a bounded number of tokens, or one row, and give every row back in order."""
    rows = [["a"] * 3, [], None, ["b"] * 9, ["c"], ["d", None]]
    for batch in (pa.array(rows), pa.array([["z"], *rows])[1:]):
        monkeypatch.setattr(tk, "TOKENS_PER_STEP", 4)
        slices = [s.to_pylist() for s in tk._slices(iter([batch, batch[:0], batch]))]
        assert sum(slices, []) == rows * 2
        assert all(len(s) == 1 or sum(len(r or ()) for r in s) <= 4 for s in slices)


@pytest.mark.parametrize("max_map", [1000, 0])
def test_lemmas_of_odd_rows(spark, max_map):
    data = [(1, ["wolves", "x", None, "cats"]), (1, ["cats"]), (2, None), (3, []), (4, ["x"]), (None, ["cats", "x"])]
    docs = spark.createDataFrame(data * 30, "doc_id long, features array<string>").coalesce(1)
    lexicon = spark.createDataFrame([("wolf",), ("cat",), ("x",)], "lemma string")
    found = sorted(map(str, (tuple(r) for r in tk.lemmatize(docs, lexicon, max_map=max_map).collect())))
    alone = ["cat", "x"] if max_map else ["cats", "x"]  # a row without key joins nothing
    wanted = [(1, ["wolf", "x", None, "cat"]), (1, ["cat"]), (2, []), (3, []), (4, ["x"]), (None, alone)]
    assert found == sorted(map(str, wanted * 30))


def kept_frames(spark):
    """(bytes in memory, bytes on disk) of each persisted frame by its id."""
    return {r.id(): (r.memSize(), r.diskSize()) for r in spark._jsc.sc().getRDDStorageInfo()}


def test_fits_keep_rows_on_disk(spark, folder):
    """One copy of the rows at most, which no executor holds in memory."""
    rows = [(i, f"t{i}", [f"w{j % 17}" for j in range(i % 40)]) for i in range(200)]
    computed = spark.createDataFrame(rows, "doc_id long, title string, features array<string>")
    computed.write.parquet(folder)
    found = []
    for docs in (spark.read.parquet(folder), computed):
        before = kept_frames(spark)
        model = lsa.fit(docs, 10, 3)
        kept = [sizes for i, sizes in kept_frames(spark).items() if i not in before]
        assert len(kept) == 1 and kept[0][0] == 0 < kept[0][1]
        found.append(model.sigma)
    np.testing.assert_allclose(*found)
    assert shared.is_table(spark.read.parquet(folder)) and not shared.is_table(computed)
    assert not shared.is_table(spark.read.parquet(folder).withColumn("title", F.upper("title")))


def test_sweeps_keep_points_on_disk(spark, monkeypatch):
    _, data = blobs(spark)
    data.count()
    before, kept, step = kept_frames(spark), [], cl.kmeans_step
    monkeypatch.setattr(cl, "kmeans_step", lambda *a: kept.append(kept_frames(spark)) or step(*a))
    gearbox.sweep_entropy(data.select("label", "features"), (3,))
    sizes = [sizes for i, sizes in kept[0].items() if i not in before]
    assert len(sizes) == 1 and sizes[0][0] == 0 < sizes[0][1]
    assert set(kept_frames(spark)) <= set(before)
