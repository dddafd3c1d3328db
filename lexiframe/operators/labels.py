"""Label ids and their decoding."""

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, functions as F

from .lookup import lookup_join


def fit_label_index(df: DataFrame, label: str = "label", out: str = "indexedLabel") -> StringIndexerModel:
    """Ids by falling frequency, ties in label order; unseen and null get the next id."""
    return StringIndexer(inputCol=label, outputCol=out, handleInvalid="keep").fit(df)


def label_ids(
    df: DataFrame,
    mapping: DataFrame,
    label: str = "label",
    out: str = "label_id",
    default: int | None = 1,
) -> DataFrame:
    """Ids from a ``(label, id)`` table; labels it lacks get ``default``."""
    pairs = mapping.toDF(label, "_id")
    return (
        lookup_join(df, pairs, label)
        .withColumn(out, F.coalesce("_id", F.lit(default)))
        .drop("_id")
    )


def decode_labels(
    df: DataFrame, labels: list[str], prediction: str = "prediction", out: str = "predictLabel"
) -> DataFrame:
    """Prediction index to label name, labels as given by the fitted indexer."""
    return IndexToString(inputCol=prediction, outputCol=out, labels=labels).transform(df)
