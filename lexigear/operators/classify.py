"""Tabular classification with trees, and its metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigear.functions.text import hash_fraction

# The tuning grids.
IMPURITIES = ("entropy", "gini")
DEPTHS = (6, 12, 24)
BINS = (20, 50, 100)
TREES = (5, 10, 20)


def clean_labels(df: DataFrame, label: str, allowed: Sequence = ("Yes", "No")) -> DataFrame:
    """Rows whose label is one of ``allowed``; a null is none of them."""
    return df.where(F.col(label).isin(*allowed))


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    first, second = df.randomSplit([train, 1.0 - train], seed)
    return first, second


def hash_split(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A split decided by a hash of the key: the same for every partitioning."""
    draw = hash_fraction(F.col(key), seed)
    return df.where(draw < train), df.where(draw >= train)


def indexers(columns: Sequence[str], label: str, order: str = "frequencyDesc") -> list[StringIndexer]:
    """One indexer of all columns, fitted in one pass; rows with unseen categories are skipped."""
    every = [*columns, label]
    names = [*[f"{c}_indexed" for c in columns], "label"]
    return [StringIndexer(inputCols=every, outputCols=names, handleInvalid="skip", stringOrderType=order)]


def index_categories(df: DataFrame, columns: Sequence[str], order: str = "frequencyDesc") -> DataFrame:
    names = [f"{c}_indexed" for c in columns]
    stage = StringIndexer(inputCols=list(columns), outputCols=names, handleInvalid="skip", stringOrderType=order)
    return stage.fit(df).transform(df)


def tree_pipeline(categorical: Sequence[str], numeric: Sequence[str], label: str, classifier) -> Pipeline:
    """Indexers, assembled features and a classifier on ``label``."""
    features = [*numeric, *[f"{c}_indexed" for c in categorical]]
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    return Pipeline(stages=[*indexers(categorical, label), assembler, classifier])


def decision_tree() -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features")


def random_forest() -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features")


def gbt_one_vs_rest(depth: int = 6, iterations: int = 10) -> OneVsRest:
    """Boosted trees handle two classes; one model per class covers more."""
    return OneVsRest(
        classifier=GBTClassifier(labelCol="label", featuresCol="features", maxDepth=depth, maxIter=iterations)
    )


def tree_grid(classifier, impurities=IMPURITIES, depths=DEPTHS, bins=BINS, trees=None) -> list:
    grid = (
        ParamGridBuilder()
        .addGrid(classifier.impurity, list(impurities))
        .addGrid(classifier.maxDepth, list(depths))
        .addGrid(classifier.maxBins, list(bins))
    )
    if trees is not None:
        grid = grid.addGrid(classifier.numTrees, list(trees))
    return grid.build()


def area_under_roc() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    )


def accuracy() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName="accuracy"
    )


def tune_cv(pipeline: Pipeline, grid: list, evaluator, folds: int = 5, seed: int = 42, parallelism: int = 1):
    return CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator,
        numFolds=folds, seed=seed, parallelism=parallelism,
    )


def tune_tvs(pipeline: Pipeline, grid: list, evaluator, ratio: float = 0.8, seed: int = 42, parallelism: int = 1):
    return TrainValidationSplit(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator,
        trainRatio=ratio, seed=seed, parallelism=parallelism,
    )


def binary_metrics(scored: DataFrame, score: str, label: str = "label", bins: int = 0) -> DataFrame:
    """One row: area under the ROC curve and under the precision-recall curve.

    ``bins=0`` uses every distinct score as a threshold, which is exact.
    """
    scored = scored.select(F.col(score).cast("double").alias("_score"), F.col(label).cast("double").alias("_label")).persist()

    def area(name: str) -> float:
        return BinaryClassificationEvaluator(
            rawPredictionCol="_score", labelCol="_label", metricName=name, numBins=bins
        ).evaluate(scored)

    areas = (area("areaUnderROC"), area("areaUnderPR"))
    scored.unpersist()
    return scored.sparkSession.createDataFrame([areas], "area_under_roc double, area_under_pr double")


def confusion(scored: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return scored.groupBy(label, prediction).agg(F.count("*").alias("n"))


def class_metrics(scored: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """``label, support, precision, recall`` per label.  One counting shuffle.

    A label that is never predicted has precision 0.
    """
    cells = confusion(scored, prediction, label)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col(label).alias("label"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                         F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col(prediction).alias("label"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"),
                         F.lit(0).cast("long").alias("hit")),
            )
        ).alias("side")
    ).select("side.*")
    per_label = sides.groupBy("label").agg(
        F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    return per_label.select(
        "label", "support",
        F.when(F.col("predicted") > 0, F.col("hit") / F.col("predicted")).otherwise(0.0).alias("precision"),
        F.when(F.col("support") > 0, F.col("hit") / F.col("support")).otherwise(0.0).alias("recall"),
    )


def overall_metrics(per_label: DataFrame) -> DataFrame:
    """Accuracy and weighted precision and recall from ``class_metrics``."""
    total = F.sum("support")
    return per_label.agg(
        (F.sum(F.col("recall") * F.col("support")) / total).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("weighted_recall"),
    )


def compare_models(metrics: dict[str, DataFrame]) -> DataFrame:
    """One-row metric frames side by side: ``metric`` and one column per model."""
    long = None
    for model, row in metrics.items():
        pairs = F.explode(
            F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns])
        )
        part = row.select(F.lit(model).alias("model"), pairs.alias("m")).select("model", "m.*")
        long = part if long is None else long.unionByName(part)
    return long.groupBy("metric").pivot("model", list(metrics)).agg(F.first("value"))
