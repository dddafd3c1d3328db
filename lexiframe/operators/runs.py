"""Numbering runs of equal labels in an ordered table."""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import materialise

#: Neighbouring rows that one window scans, about.
ROWS_PER_GROUP = 1 << 20
#: Groups at most; beyond that they grow.
MAX_GROUPS = 10_000


def _scan(items: DataFrame, window, change: Column) -> DataFrame:
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return items.withColumn("_change", change.cast("long")).withColumn(
        "_off", F.sum(F.col("_change") + F.col("_n")).over(upto) - F.col("_n")
    )


def _grouped(items: DataFrame) -> DataFrame:
    """Add ``_group``: ranges of keys with about as many rows each, however the keys are spread.

    The cut points are approximate quantiles, from a sketch of bounded size. Keys are cut as
    doubles, which keeps their order; equal doubles share a group.
    """
    keys = items.select(F.col("_key").cast("double").alias("_key"))
    groups = max(2, min(MAX_GROUPS, -(-items.count() // ROWS_PER_GROUP)))
    cuts = [i / groups for i in range(1, groups)]
    found = keys.agg(F.percentile_approx("_key", cuts, 10 * groups)).first()[0] or [0.0]
    splits = [-float("inf"), *sorted(set(found)), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_at", outputCol="_group")
    return cut.transform(items.withColumn("_at", F.col("_key").cast("double"))).drop("_at")


def _with_offsets(items: DataFrame) -> DataFrame:
    """Add ``_off``: the label changes seen when an item begins.

    ``items`` holds ``_key, _first, _last, _n``: a stretch of rows with its first
    and last label and the number of changes inside. Groups of neighbours are
    scanned on their own. Their summary, one stretch per group, is stored and scanned
    as a whole; what it carries into a group is added to the group's rows.
    """
    items = _grouped(items)
    window = Window.partitionBy("_group").orderBy("_key")
    follows = F.row_number().over(window) > 1
    scanned = _scan(items, window, follows & ~F.lag("_last").over(window).eqNullSafe(F.col("_first")))
    stretches = materialise(
        scanned.groupBy(F.col("_group").alias("_key")).agg(
            F.min_by("_first", F.col("_key")).alias("_first"),
            F.max_by("_last", F.col("_key")).alias("_last"),
            F.sum(F.col("_change") + F.col("_n")).alias("_n"),
        ),
        "stretches",
    )
    # at most MAX_GROUPS rows
    window = Window.orderBy("_key")
    previous = F.lag("_last", 1, "").over(window)
    placed = _scan(stretches, window, ~previous.eqNullSafe(F.col("_first")))
    starts = placed.select(F.col("_key").alias("_group"), F.col("_off").alias("_start"))
    return (
        scanned.join(F.broadcast(starts), "_group")
        .withColumn("_off", F.col("_off") + F.col("_start"))
        .drop("_group", "_start")
    )


def run_number(df: DataFrame, label: str, order: str, out: str = "run_id") -> DataFrame:
    """Number the runs of equal labels along ``order``, a unique integer column.

    The first run has id 0. As in a loop that starts from an empty previous label,
    a leading run of empty labels has id -1. Only ``order`` and ``label`` are numbered; the
    other columns are joined afterwards, so wide rows never meet in a window.
    """
    if set(df.columns) - {label, order}:
        numbers = materialise(run_number(df.select(order, label), label, order, out), "run-numbers")
        return df.join(numbers.drop(label), order).select(*df.columns, out)
    key = F.coalesce(
        F.col(order).cast("long"),
        F.raise_error(F.lit(f"{order} must be an integer and not null")).cast("long"),
    )
    rows = (
        df.withColumn("_key", key)
        .withColumn("_first", F.col(label).cast("string"))
        .withColumn("_last", F.col("_first"))
        .withColumn("_n", F.lit(0).cast("long"))
    )
    return (
        _with_offsets(rows)
        .withColumn(out, F.col("_off") - 1)
        .drop("_key", "_first", "_last", "_n", "_change", "_off")
    )


def label_dictionary(runs: DataFrame, label: str = "label", run_id: str = "run_id") -> DataFrame:
    """Label to the id of its last run; labels outside any numbered run are left out."""
    return (
        runs.where(F.col(run_id) >= 0).groupBy(label).agg(F.max(run_id).alias("label_id"))
    )


def run_lengths(runs: DataFrame, label: str, run_id: str = "run_id") -> DataFrame:
    """``(label, run_id, n)``."""
    return runs.groupBy(label, run_id).agg(F.count(F.lit(1)).alias("n"))


def last_run_length(runs: DataFrame, label: str, run_id: str = "run_id") -> DataFrame:
    """``(label, size)``: the length of each label's last run."""
    return (
        run_lengths(runs, label, run_id)
        .groupBy(label)
        .agg(F.max_by("n", run_id).alias("size"))
    )
