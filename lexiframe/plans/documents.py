"""Preparing labelled documents for training and scoring."""

from pyspark.sql import DataFrame, functions as F

from ..functions.text import literal_split
from ..operators.labels import label_ids
from ..operators.rows import content_and_label, label_last, split_records
from ..operators.runs import label_dictionary, run_number
from ..operators.terms import KEYWORDS_PER_DOCUMENT, keywords
from ..operators.tokens import remove_stopwords, tokenize


def training_set(lines: DataFrame, pos: str = "pos", value: str = "value") -> DataFrame:
    """``kw1 kw2 ... label`` lines to ``(pos, label, words)``."""
    return label_last(split_records(lines.select(pos, value), " ", value))


def training_set_with_ids(
    lines: DataFrame, pos: str = "pos", value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """The training set with ``label_id`` numbered by run, and its label dictionary."""
    rows = run_number(training_set(lines, pos, value), "label", pos, "label_id")
    return rows, label_dictionary(rows, "label", "label_id")


def scoring_set(
    lines: DataFrame,
    idf: DataFrame,
    stopwords: list[str],
    pos: str = "pos",
    value: str = "value",
    mode: str = "space",
    n: int = KEYWORDS_PER_DOCUMENT,
) -> DataFrame:
    """``content^^label`` lines to ``(pos, label, words)`` with the top keywords."""
    rows = content_and_label(split_records(lines.select(pos, value), "^^", value))
    tokens = remove_stopwords(tokenize(rows, "content", mode), stopwords)
    return keywords(tokens, idf, pos, n=n, keep=("label",))


def scoring_set_with_ids(
    lines: DataFrame,
    idf: DataFrame,
    stopwords: list[str],
    mapping: DataFrame,
    default: int | None = 1,
    **options,
) -> DataFrame:
    """The scoring set with ``label_id`` looked up in a ``(label, id)`` table."""
    return label_ids(scoring_set(lines, idf, stopwords, **options), mapping, default=default)


def lines_of(df: DataFrame, pos: str, text: str, value: str = "value") -> DataFrame:
    """Lines of a text column with ``line``, their 0-based number inside the text."""
    return df.select(pos, F.posexplode(literal_split(text, "\n")).alias("line", value))
