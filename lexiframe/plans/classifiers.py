"""Classifiers on numeric records and on text: fitting, tuning, predicting."""

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, Tokenizer, VectorIndexer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ..operators.split import hash_fold, hash_split
from .stages import ordered_input

MAX_CATEGORIES = 24
SEED = 234


def fit_logistic(
    df: DataFrame,
    max_iter: int = 10,
    reg: float = 0.01,
    overrides: dict | None = None,
) -> LogisticRegressionModel:
    """Logistic regression; ``overrides`` replaces parameters by name at fit time."""
    lr = LogisticRegression(maxIter=max_iter, regParam=reg)
    params = {lr.getParam(name): value for name, value in (overrides or {}).items()}
    return lr.fit(df, params)


def text_classifier(
    text: str = "text", features: int = 1000, max_iter: int = 10, reg: float = 0.001
) -> Pipeline:
    """Tokeniser, hashed term counts and logistic regression, not fitted."""
    tokenizer = Tokenizer(inputCol=text, outputCol="words")
    tf = HashingTF(numFeatures=features, inputCol="words", outputCol="features")
    return Pipeline(stages=[tokenizer, tf, LogisticRegression(maxIter=max_iter, regParam=reg)])


def category_indexer(features: str = "features", out: str = "indexedFeatures") -> VectorIndexer:
    """Slots with few values become categories; unseen ones get a value of their own."""
    return VectorIndexer(
        inputCol=features, outputCol=out, maxCategories=MAX_CATEGORIES, handleInvalid="keep"
    )


def tree(depth: int = 5, max_bins: int = 32) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(
        maxDepth=depth,
        maxBins=max_bins,
        impurity="entropy",
        labelCol="label",
        featuresCol="indexedFeatures",
    )


@dataclass
class TreeRun:
    """A fitted tree and the scored rows of the test part."""

    model: PipelineModel | CrossValidatorModel
    scored: DataFrame


def _parts(df: DataFrame, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    parts = hash_split(df, key, [0.9, 0.1], seed)
    return parts.where("part = 0").drop("part"), parts.where("part = 1").drop("part")


def train_tree(df: DataFrame, key: str, depth: int = 5, seed: int = SEED) -> TreeRun:
    """Fit on 90 percent of ``(key, label, features)`` rows, score the other 10.

    The indexer sees the training part only.
    """
    training, test = _parts(df, key, seed)
    rows = ordered_input(training, key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=[category_indexer(), tree(depth)]).fit(rows)
    finally:
        rows.unpersist()
    return TreeRun(model, model.transform(test))


def tune_tree(
    df: DataFrame,
    key: str,
    depths: tuple[int, ...] = (4, 5, 6),
    folds: int = 2,
    seed: int = SEED,
    parallelism: int = 1,
) -> TreeRun:
    """Choose the depth by cross-validation on weighted F1, folds taken from the key."""
    training, test = _parts(df, key, seed)
    rows = ordered_input(hash_fold(training, key, folds, seed), key)
    dt = tree(max_bins=30)
    cv = CrossValidator(
        estimator=Pipeline(stages=[category_indexer(), dt]),
        estimatorParamMaps=ParamGridBuilder().addGrid(dt.maxDepth, list(depths)).build(),
        evaluator=MulticlassClassificationEvaluator(metricName="f1"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = cv.fit(rows)
    finally:
        rows.unpersist()
    return TreeRun(model, model.transform(test.withColumn("fold", F.lit(0))))


def chosen_depth(run: TreeRun) -> int:
    """Depth of the fitted tree."""
    model = run.model.bestModel if isinstance(run.model, CrossValidatorModel) else run.model
    return model.stages[1].depth
