"""Text sinks. Every writer fails if its target exists, unless told otherwise."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import python_float, python_str


def pair_line(word: str, n: str) -> Column:
    """``('word', 3)``, quoted and escaped as Python prints a tuple."""
    return F.concat(F.lit("("), python_str(word), F.lit(", "), F.col(n).cast("string"), F.lit(")"))


def write_lines(df: DataFrame, line: Column, path: str, mode: str = "errorifexists") -> None:
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_pairs(df: DataFrame, path: str, word: str = "word", n: str = "n") -> None:
    write_lines(df, pair_line(word, n), path)


def _number(df: DataFrame, name: str) -> Column:
    double = dict(df.dtypes)[name] in ("double", "float")
    return python_float(name) if double else F.col(name).cast("string")


def write_predictions(
    df: DataFrame,
    path: str,
    label: str = "label",
    prediction: str = "prediction",
    order: str | None = None,
) -> None:
    """``label<TAB>prediction`` lines, in the order of a column if one is named."""
    line = F.concat_ws("\t", _number(df, label), _number(df, prediction))
    write_lines(df if order is None else df.orderBy(order), line, path)


def _vector_text(name: str) -> Column:
    return F.concat(
        F.lit("["), F.array_join(F.transform(vector_to_array(name), python_float), ","), F.lit("]")
    )


def write_probabilities(df: DataFrame, path: str, order: str | None = None) -> None:
    """``rawPrediction<TAB><TAB>probability`` lines, in the order of a column if one is named."""
    line = F.concat_ws("\t\t", _vector_text("rawPrediction"), _vector_text("probability"))
    write_lines(df if order is None else df.orderBy(order), line, path)


def write_class_accuracy(df: DataFrame, path: str) -> None:
    """``class = ratio`` lines in rank order; one row per class, so one file."""
    line = F.concat_ws(" = ", F.col("truth").cast("string"), python_float("accuracy"))
    write_lines(df.orderBy("rank").coalesce(1), line, path)
