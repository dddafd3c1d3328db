"""Splits and folds that depend on the row key only."""

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

DIGESTS = 2**32


def key_digest(key: str, seed: int) -> Column:
    """An even, repeatable number below ``DIGESTS`` for a key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_split(
    df: DataFrame, key: str, weights: list[float], seed: int, out: str = "part"
) -> DataFrame:
    """Add the number of the part a row belongs to; parts are sized by ``weights``.

    A weight too small for any digest is an error, not an empty part.
    """
    total = sum(weights)
    edges = [round(DIGESTS * w / total) for w in accumulate(weights)]
    edges[-1] = DIGESTS
    if any(a >= b for a, b in zip([0, *edges], edges)):
        raise ValueError(f"a part of {weights} is below 1 in {DIGESTS}")
    digest = key_digest(key, seed)
    part = reduce(lambda acc, e: acc + (digest >= e).cast("int"), edges[:-1], F.lit(0))
    return df.withColumn(out, part)


def hash_fold(df: DataFrame, key: str, folds: int, seed: int, out: str = "fold") -> DataFrame:
    return df.withColumn(out, F.pmod(key_digest(key, seed), F.lit(folds)).cast("int"))
