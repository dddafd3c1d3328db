"""``key:value`` dictionaries and word lists kept as text files."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import literal_split, strip
from .lines import number_lines


def _entries(lines: DataFrame) -> DataFrame:
    parts = literal_split("value", ":")
    return lines.select("pos", F.get(parts, 0).alias("key"), F.get(parts, 1).alias("entry"))


def last_entry_wins(entries: DataFrame, key: str, value: str, pos: str = "pos") -> DataFrame:
    """One row per key, holding the value from its last line."""
    return entries.groupBy(key).agg(F.max_by(value, pos).alias(value))


def idf_from_lines(lines: DataFrame) -> DataFrame:
    """``(pos, value)`` lines of ``word:idf`` to ``(word, idf)``.

    Text after a second colon is ignored.
    """
    rows = _entries(lines).select(
        "pos", F.col("key").alias("word"), F.col("entry").try_cast("double").alias("idf")
    )
    return last_entry_wins(rows, "word", "idf")


def read_idf(spark: SparkSession, path: str) -> DataFrame:
    return idf_from_lines(number_lines(spark, path))


def stopwords_from_lines(lines: DataFrame) -> DataFrame:
    return lines.select(strip("value").alias("word")).distinct()


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, white space around it removed."""
    return stopwords_from_lines(spark.read.text(path))


def categories_from_lines(lines: DataFrame) -> DataFrame:
    """``(pos, value)`` lines of ``id:category`` to ``(category, id)``."""
    rows = _entries(lines.withColumn("value", strip("value"))).select(
        "pos", F.col("entry").alias("category"), F.col("key").try_cast("int").alias("id")
    )
    return last_entry_wins(rows, "category", "id")


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return categories_from_lines(number_lines(spark, path))
