"""MLlib stages that give the same result for every partitioning of their input."""

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF
from pyspark.sql import DataFrame

from ..operators.forest import SparseForestClassifier
from ..operators.terms import MIN_DOCUMENTS, VOCABULARY_SIZE, vocabulary

HASH_SIZE = 21000


#: Of the rows of a forest, at least; its draws go by key.
PARTITIONS = 64
#: Rows that a partition of a forest holds, about.
FOREST_ROWS = 8192


def forest_partitions(rows: int, least: int = PARTITIONS) -> int:
    """Partitions for so many rows: what a task reads stays level, and no session has a say."""
    return max(least, -(-rows // FOREST_ROWS))


def ordered_input(df: DataFrame, key: str, partitions: int = PARTITIONS) -> DataFrame:
    """Place rows by key and sort them, so that bagging sees one fixed order."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


def count_stage(
    df: DataFrame,
    words: str = "words",
    out: str = "features",
    size: int = VOCABULARY_SIZE,
    min_df: int = MIN_DOCUMENTS,
) -> CountVectorizerModel:
    """Term counts over a vocabulary whose ties are settled by word.

    MLlib takes the vocabulary as a list, at most ``size`` words.
    """
    found = vocabulary(df, words, size, min_df).collect()
    return CountVectorizerModel.from_vocabulary(
        [row["word"] for row in found], inputCol=words, outputCol=out
    )


def hashed_tfidf_stages(
    words: str = "words", out: str = "features", size: int = HASH_SIZE, min_df: int = 0
) -> list:
    tf = HashingTF(inputCol=words, outputCol="rawFeatures", numFeatures=size)
    return [tf, IDF(inputCol="rawFeatures", outputCol=out, minDocFreq=min_df)]


def bayes(label: str, smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(smoothing=smoothing, modelType="multinomial", labelCol=label)


def forest(
    label: str, trees: int = 150, depth: int = 30, impurity: str = "gini", seed: int = 234, key: str = "pos"
) -> SparseForestClassifier:
    return SparseForestClassifier(key, label, trees, depth, impurity, seed)
