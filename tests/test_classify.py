import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigear.operators import classify as jc


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "mfx"[i % 3], float(rng.normal(i % 2, 0.2)), "Yes" if i % 2 else "No") for i in range(200)]
    return spark.createDataFrame(rows, "id long, sex string, bmi double, sick string").persist()


def test_clean_and_split(spark, people):
    odd = spark.createDataFrame([(1, "Yes"), (2, None), (3, "Maybe"), (4, "No")], "id long, sick string")
    assert sorted(r.id for r in jc.clean_labels(odd, "sick").collect()) == [1, 4]
    train, test = jc.hash_split(people, "id")
    assert train.count() + test.count() == 200 and 25 <= test.count() <= 60
    assert train.join(test, "id").count() == 0
    a, b = jc.random_split(people)
    assert a.count() + b.count() == 200


def test_index_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("c",)], "x string")
    assert {(r.x, r.x_indexed) for r in jc.index_categories(df, ["x"]).collect()} == {("a", 0.0), ("b", 1.0), ("c", 2.0)}


def stages(classifier):
    return jc.tree_pipeline(["sex"], ["bmi"], "sick", classifier)


def test_tuned_trees_learn(people, folder):
    train, test = jc.hash_split(people, "id")
    tree = jc.decision_tree()
    grid = jc.tree_grid(tree, depths=(2, 3), bins=(100,))
    for tune in (jc.tune_cv(stages(tree), grid, jc.area_under_roc(), folds=2), jc.tune_tvs(stages(tree), grid, jc.area_under_roc())):
        best = tune.fit(train).bestModel
        scored = best.transform(test)
        assert jc.overall_metrics(jc.class_metrics(scored)).head().accuracy > 0.9
    best.stages[-1].write().overwrite().save(folder)
    assert len(jc.tree_grid(tree)) == 18
    assert len(jc.tree_grid(jc.random_forest(), trees=jc.TREES)) == 54


def test_one_vs_rest(people):
    model = stages(jc.gbt_one_vs_rest(2, 2)).fit(people)
    assert jc.overall_metrics(jc.class_metrics(model.transform(people))).head().accuracy > 0.9


def test_class_metrics(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 0), (2, 1)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    found = {r.label: (r.support, r.precision, r.recall) for r in jc.class_metrics(df).collect()}
    assert found == {0: (3, 2 / 3, 2 / 3), 1: (2, 1 / 3, 0.5), 2: (1, 0.0, 0.0)}
    row = jc.overall_metrics(jc.class_metrics(df)).head()
    assert row.accuracy == pytest.approx(0.5)
    assert row.weighted_precision == pytest.approx((3 * 2 / 3 + 2 / 3) / 6)
    table = jc.compare_models({"m": jc.overall_metrics(jc.class_metrics(df))}).collect()
    assert {r.metric for r in table} == {"accuracy", "weighted_precision", "weighted_recall"}


def test_binary_metrics(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "s double, y int")
    row = jc.binary_metrics(df, "s", "y").head()
    assert row.area_under_roc == pytest.approx(0.75)
    flat = jc.binary_metrics(df.withColumn("s", F.lit(1.0)), "s", "y").head()
    assert flat.area_under_roc == pytest.approx(0.5)
