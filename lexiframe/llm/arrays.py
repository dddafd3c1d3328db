"""Running sums inside array columns."""

from pyspark.sql import Column, functions as F

GROUP = 256


def _prefix(lengths: Column, start: Column) -> Column:
    zero = F.struct(start.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(
        lengths,
        zero,
        lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")
        ),
        lambda acc: acc["out"],
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, b: a + b)


def starts(lengths: Column) -> Column:
    """Where each piece starts if pieces of these (bigint) lengths follow each other.

    In two steps, so that many pieces cost little.
    """
    groups = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / GROUP), F.lit(0)).cast("int")),
        lambda g: F.slice(lengths, g * GROUP + 1, GROUP),
    )
    firsts = _prefix(F.transform(groups, _sum), F.lit(0))
    return F.flatten(F.zip_with(groups, firsts, _prefix))
