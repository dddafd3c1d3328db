"""Table profile and box-plot outliers with exact quantiles.

The table is read once. Its columns become ``(column, v, n)``, equal values counted before
they are moved, and are stored in ranges of (column, value). Everything else comes from that
table: a prefix sum over the totals of the ranges tells which range holds a wanted rank, and
only these ranges are summed up value by value. So neither a frequent value, nor a long
column, nor many columns end up in one task.
"""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import materialise


def number(column: str) -> Column:
    """The column as double; NaN is a missing value."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def value_ranges(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``(column, v, n, part)``: how often each value occurs; stored, one range of (column, value) a part.

    ``column`` is the place in ``columns``; missing values are left out. ``ranges`` is the
    number of parts at most, by default that of the session's shuffles.
    """
    values = df.select(F.posexplode(F.array(*map(number, columns))).alias("column", "v")).where(F.col("v").isNotNull())
    counts = values.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    by = ("column", "v")
    placed = counts.repartitionByRange(ranges, *by) if ranges else counts.repartitionByRange(*by)
    return materialise(placed.withColumn("part", F.spark_partition_id()), "value-ranges")


def _one_each(df: DataFrame, columns: int) -> DataFrame:
    """A row for each column, also for those without values."""
    ids = df.sparkSession.range(columns).select(F.col("id").cast("int").alias("column"))
    return ids.join(F.broadcast(df), "column", "left")


def column_quantiles(values: DataFrame, columns: int, probabilities: Sequence[float]) -> DataFrame:
    """``(column, q0..qN)`` of stored value ranges: exact, interpolated between neighbouring ranks."""
    def running(*by):
        return Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    positions = [F.lit(p) * (F.col("total") - 1) for p in probabilities]
    ranks = [rank for x in positions for rank in (F.floor(x), F.ceil(x))]
    # a row for each part and column
    parts = (
        values.groupBy("column", "part").agg(F.sum("n").alias("inside"))
        .withColumn("end", F.sum("inside").over(running("column", "part")))
        .withColumn("total", F.sum("inside").over(Window.partitionBy("column")))
        .withColumn("before", F.col("end") - F.col("inside"))
    )
    # at most two parts for each column and probability
    wanted = parts.where(reduce(or_, [(F.col("before") <= r) & (F.col("end") > r) for r in ranks]))
    placed = values.join(F.broadcast(wanted.select("column", "part", "before", "total")), ["column", "part"])
    placed = placed.withColumn("upto", F.col("before") + F.sum("n").over(running("column", "part", "v")))
    holds = [(F.col("upto") > r) & (F.col("upto") - F.col("n") <= r) for r in ranks]
    at = placed.groupBy("column").agg(
        *[F.max(F.when(h, F.col("v"))).alias(f"at{i}") for i, h in enumerate(holds)],
        *[F.max(x - F.floor(x)).alias(f"part{i}") for i, x in enumerate(positions)],
    )
    return _one_each(at, columns).select(
        "column",
        *[
            (F.col(f"at{2 * i}") + (F.col(f"at{2 * i + 1}") - F.col(f"at{2 * i}")) * F.col(f"part{i}")).alias(f"q{i}")
            for i in range(len(probabilities))
        ],
    )


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float], ranges: int | None = None) -> DataFrame:
    """One row ``q0..qN`` of a column; nulls if it has no values."""
    return column_quantiles(value_ranges(df, [column], ranges), 1, probabilities).drop("column")


def describe(df: DataFrame, columns: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``(column, count, mean, std, min, q1, median, q3, max)``, one row per column."""
    values = value_ranges(df, columns, ranges)
    v, n = F.col("v"), F.col("n")
    basics = values.groupBy("column").agg(
        F.sum(n).alias("count"), (F.sum(v * n) / F.sum(n)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    squares = values.join(F.broadcast(basics.select("column", "mean")), "column").groupBy("column").agg(
        F.when(F.sum(n) > 1, F.sqrt(F.sum(n * (v - F.col("mean")) ** 2) / (F.sum(n) - 1))).alias("std")
    )
    quartiles = column_quantiles(values, len(columns), [0.25, 0.5, 0.75]).toDF("column", "q1", "median", "q3")
    return quartiles.join(F.broadcast(basics), "column", "left").join(F.broadcast(squares), "column", "left").select(
        F.element_at(F.array(*map(F.lit, columns)), F.col("column") + 1).alias("column"),
        F.coalesce("count", F.lit(0).cast("long")).alias("count"),
        "mean", "std", "min", "q1", "median", "q3", "max",
    )


def outliers(df: DataFrame, column: str, whisker: float = 1.5) -> DataFrame:
    """The rows outside the whiskers of a box plot, sorted by ``column``, then the others."""
    quartiles = quantiles(df, column, [0.25, 0.75])
    reach = whisker * (F.col("q1") - F.col("q0"))
    low = quartiles.select(F.col("q0") - reach).scalar()
    high = quartiles.select(F.col("q1") + reach).scalar()
    value = number(column)
    return df.where((value < low) | (value > high)).orderBy(
        column, *[c for c in df.columns if c != column]
    )


def vector_statistics(df: DataFrame, features: str = "features") -> DataFrame:
    """One row of per-slot statistics of a vector column."""
    names = ["mean", "variance", "count", "numNonZeros", "max", "min", "normL1", "normL2"]
    return df.select(Summarizer.metrics(*names).summary(F.col(features)).alias("s")).select("s.*")
