"""Tokenising and stop-word filtering."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import WIDE_SPACE, blank_or_spaced, literal_split
from .lookup import lookup_join

# What \s matches in Java.
WHITE_SPACE = " \t\n\x0b\f\r"

# Runs of Han characters, and runs of anything else that is not white space.
SCRIPT_RUNS = r"[\p{IsHan}]+|[^\s\p{IsHan}]+"

HAN_PAIR = r"(?=(\p{IsHan}{2}))"

#: Texts whose words a segmenter's task holds as Python objects.
SEGMENTED_ROWS = 64


def token_array(text: str, mode: str = "space", pattern: str = SCRIPT_RUNS) -> Column:
    """Tokens of a text column.

    ``space``             split on one space, every empty token kept
    ``whitespace_lower``  lower-case, split on each white-space character, trailing
                          empty tokens dropped (one empty token for an empty text)
    ``regex``             every match of ``pattern``
    ``han_bigram``        Han runs as overlapping pairs, other runs as they are
    """
    if mode == "space":
        return literal_split(text, " ")
    if mode == "whitespace_lower":
        body = F.rtrim(F.lower(text), F.lit(WHITE_SPACE))
        return (
            F.when(F.col(text) == "", F.array(F.lit("")))
            .when(body == "", F.array().cast("array<string>"))
            .otherwise(F.split(body, r"\s", -1))
        )
    runs = F.regexp_extract_all(F.col(text), F.lit(pattern), 0)
    if mode == "regex":
        return runs
    if mode == "han_bigram":
        return F.flatten(
            F.transform(
                runs,
                lambda r: F.when(
                    r.rlike(r"^\p{IsHan}{2,}$"),
                    F.regexp_extract_all(r, F.lit(HAN_PAIR), 1),
                ).otherwise(F.array(r)),
            )
        )
    raise ValueError(f"unknown mode {mode!r}")


def tokenize(
    df: DataFrame,
    text: str,
    mode: str = "space",
    words: str = "words",
    pattern: str = SCRIPT_RUNS,
) -> DataFrame:
    return df.withColumn(words, token_array(text, mode, pattern))


def segment(
    df: DataFrame, text: str, segmenter: Callable[[str], list[str]], words: str = "words"
) -> DataFrame:
    """Tokenise with a function of the caller; only the text column goes through Python.

    Words of a few texts at a time are Python objects, whatever the size of a batch.
    """

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(texts: pa.Array) -> pa.Array:
        parts = (texts.slice(i, SEGMENTED_ROWS).to_pylist() for i in range(0, len(texts), SEGMENTED_ROWS))
        kind = pa.list_(pa.string())
        lists = [pa.array([None if t is None else list(segmenter(t)) for t in part], kind) for part in parts]
        return pa.concat_arrays(lists) if lists else pa.array([], kind)

    return df.withColumn(words, run(text))


def remove_stopwords(df: DataFrame, stopwords: list[str], words: str = "words") -> DataFrame:
    """Filter token arrays by a list held in the plan; order and copies stay.

    Words are looked at one by one for blanks only where an array holds a null or a space somewhere.
    """
    every = F.array_join(words, "", " ")
    odd = F.contains(every, F.lit(" ")) | F.contains(every, F.lit(WIDE_SPACE))
    kept = F.when(odd, F.filter(words, lambda w: ~blank_or_spaced(w))).otherwise(F.array_remove(words, ""))
    df = df.withColumn(words, kept)
    return df.withColumn(words, F.filter(words, lambda w: ~w.isin(list(stopwords)))) if stopwords else df


def drop_stopwords(tokens: DataFrame, stopwords: DataFrame, word: str = "word") -> DataFrame:
    """The same filter on one-token-per-row tables, as an anti join with a table."""
    return lookup_join(tokens.where(~blank_or_spaced(F.col(word))), stopwords, word, "left_anti")
