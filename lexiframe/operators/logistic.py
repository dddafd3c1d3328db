"""Logistic regression for a few numeric features, by Newton steps.

A step is one aggregate over the rows: the gradient and the Hessian of the penalised
log-likelihood, sums over all rows that are combined before they move. The driver solves a
system as large as the number of features. Rows with a null or NaN in a feature or the label
are left out.
"""

from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

INTERCEPT = "intercept"
#: More features make the Hessian too long a row of aggregates; MLlib serves those.
MAX_FEATURES = 30


@dataclass(frozen=True)
class Logistic:
    """Coefficients by feature, the intercept first; steps that were taken."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    steps: int

    def probability(self) -> Column:
        return probability(self.features, self.coefficients)


def probability(features: tuple[str, ...], coefficients) -> Column:
    terms = [F.lit(float(c)) * x for c, x in zip(coefficients, _inputs(features), strict=True)]
    return 1 / (1 + F.exp(-reduce(Column.__add__, terms)))


def _inputs(features: tuple[str, ...]) -> list[Column]:
    return [F.lit(1.0), *(F.col(x).cast("double") for x in features)]


def fit(
    df: DataFrame,
    features: tuple[str, ...],
    label: str = "label",
    reg: float = 0.0,
    steps: int = 25,
    tolerance: float = 1e-9,
) -> Logistic:
    """Maximise the mean log-likelihood of 0/1 labels less ``reg / 2`` times the squared coefficients.

    The intercept isn't penalised. Stops when no coefficient moves by more than ``tolerance``.
    Both labels must occur, and without a penalty the classes must not be separable.
    """
    features = tuple(features)
    if len(features) > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features")
    y, inputs = F.col(label).cast("double"), _inputs(features)
    rows = df.where(reduce(Column.__and__, [x.isNotNull() & ~F.isnan(x) for x in (*inputs, y)]))
    size = len(inputs)
    pairs = list(combinations_with_replacement(range(size), 2))
    penalty = np.diag([0.0] + [float(reg)] * len(features))
    w, taken = np.zeros(size), 0
    for taken in range(1, steps + 1):
        p = F.col("_p")
        sums = rows.withColumn("_p", probability(features, w)).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(y).alias("ones"),
            *(F.sum((y - p) * x).alias(f"g{i}") for i, x in enumerate(inputs)),
            *(F.sum(p * (1 - p) * inputs[i] * inputs[j]).alias(f"h{i}_{j}") for i, j in pairs),
        ).first()
        n = sums["n"]
        if not n or sums["ones"] in (0, n):
            raise ValueError("both labels must occur")
        gradient = np.array([sums[f"g{i}"] for i in range(size)]) / n - penalty @ w
        hessian = penalty.copy()
        for i, j in pairs:
            hessian[i, j] += sums[f"h{i}_{j}"] / n
            if i != j:
                hessian[j, i] = hessian[i, j]
        move = np.linalg.solve(hessian, gradient)
        w = w + move
        if np.abs(move).max() <= tolerance:
            break
    return Logistic(features, tuple(w.tolist()), taken)


def score(
    df: DataFrame,
    model: Logistic,
    threshold: float = 0.5,
    probability_col: str = "probability",
    prediction_col: str = "prediction",
) -> DataFrame:
    """Add the probability of 1, and 1 or 0 by the threshold; null where a feature is."""
    p = model.probability()
    return df.withColumn(probability_col, p).withColumn(prediction_col, (F.col(probability_col) > threshold).cast("double"))
