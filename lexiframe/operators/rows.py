"""Splitting records into fields and shaping tables from them."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import literal_split


def split_records(
    df: DataFrame, delimiter: str, value: str = "value", fields: str = "fields"
) -> DataFrame:
    """Replace the line column by the array of its fields."""
    kept = [c for c in df.columns if c not in (value, fields)]
    return df.select(*kept, literal_split(value, delimiter).alias(fields))


def string_table(df: DataFrame, width: int | None = None, fields: str = "fields") -> DataFrame:
    """Add string columns ``f0..fN`` for the field array.

    Without ``width`` the first row decides, which reads that one row.
    """
    if width is None:
        width = df.select(F.size(fields)).first()[0]
    names = [F.get(fields, i).alias(f"f{i}") for i in range(width)]
    return df.select(*[c for c in df.columns if c != fields], *names)


def cast_all_to_double(df: DataFrame) -> DataFrame:
    """Every column as double under its own name; what is no number becomes null."""
    return df.select(*[F.col(c).cast("string").try_cast("double").alias(c) for c in df.columns])


def label_from(df: DataFrame, source: str | None = None, label: str = "label") -> DataFrame:
    """Move one column, by default the last, to the end as the label."""
    source = source or df.columns[-1]
    kept = [c for c in df.columns if c not in (source, label)]
    return df.select(*kept, F.col(source).alias(label))


def first_columns(df: DataFrame, k: int) -> DataFrame:
    return df.select(*df.columns[:k])


def project_typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"try_cast({c} AS {t}) AS {c}" for c, t in types.items()])


def label_last(df: DataFrame, fields: str = "fields", words: str = "words") -> DataFrame:
    """The last field becomes ``label``, the others stay an array."""
    n = F.greatest(F.size(fields) - 1, F.lit(0))
    return df.select(
        *[c for c in df.columns if c != fields],
        F.element_at(fields, -1).alias("label"),
        F.slice(fields, F.lit(1), n).alias(words),
    )


def content_and_label(df: DataFrame, fields: str = "fields") -> DataFrame:
    """The first field becomes ``content``, the last one ``label``."""
    return df.select(
        *[c for c in df.columns if c != fields],
        F.get(fields, 0).alias("content"),
        F.element_at(fields, -1).alias("label"),
    )


def doubles(strings: str | Column) -> Column:
    return F.transform(strings, lambda x: x.try_cast("double"))


def numeric_examples(df: DataFrame, fields: str = "fields") -> DataFrame:
    """Numeric records with the label last: ``label`` int and ``features`` vector.

    A malformed label is null, and so is the vector of a record with a malformed number.
    """
    rows = label_last(df, fields, "parts").withColumn("parts", doubles("parts"))
    whole = F.forall("parts", lambda x: x.isNotNull())
    # array_to_vector takes no null inside the array, wherever its result is used
    clean = F.when(whole, F.col("parts")).otherwise(F.array().cast("array<double>"))
    return rows.withColumn("label", F.col("label").try_cast("int")).withColumn(
        "features", F.when(whole, array_to_vector(clean))
    ).drop("parts")
