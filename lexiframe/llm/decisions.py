"""Carry decisions about rows back to the rows, without moving texts where possible."""

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.lookup import fits_broadcast


def row_hash(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


def attach(docs: DataFrame, decisions: DataFrame, key: str, text: str) -> DataFrame:
    """Left join on key (null-safe) and text hash.

    ``decisions`` has ``_key``, ``_hash`` (from :func:`row_hash`) and columns whose names
    start with ``_`` too; at most one row for each pair. It is broadcast only if measured
    to be small.
    """
    small = fits_broadcast(decisions)
    docs = docs.withColumn("_row", row_hash(key, text))
    right = F.broadcast(decisions) if small else decisions
    on = (F.col("_row") == F.col("_hash")) & F.col(key).eqNullSafe(F.col("_key"))
    return docs.join(right, on, "left").drop("_row", "_hash", "_key")
