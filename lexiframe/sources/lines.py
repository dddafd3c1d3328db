"""Line-oriented and delimited input."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.text import literal_split
from ..operators import lookup
from .scratch import materialise

LEAST_SPLITS = "spark.sql.files.minPartitionNum"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value``."""
    return spark.read.text(path)


def _pin_splits(spark: SparkSession) -> None:
    """Files are cut by the number of cores there are, if nothing else is set; set what holds now."""
    if spark.conf.get(LEAST_SPLITS, None) is None:
        spark.conf.set(LEAST_SPLITS, str(spark.sparkContext.defaultParallelism))


def number_lines(spark: SparkSession, path: str, value: str = "value") -> DataFrame:
    """One row per line with its 0-based number ``pos`` in (file, offset) order.

    A file block is read by one task from top to bottom, so inside a block the
    running row id already gives the order. A first scan counts the lines of each block;
    only these totals, one row per file block, are stored and go through an ordered prefix sum.
    The scan of the result looks up its block there, so the text is never copied. Both scans
    must cut the files alike: ``spark.sql.files.minPartitionNum`` is set in the session unless it
    is, and a block that the first scan has not seen is an error, never a wrong number.
    """
    _pin_splits(spark)
    file, start, length = (F.col(f"_metadata.file_{x}") for x in ("path", "block_start", "block_length"))
    lines = spark.read.text(path).select(
        F.xxhash64(file, start, length, F.spark_partition_id()).alias("block"),
        # names of part files are ordered by their number
        F.struct(F.regexp_extract(file, r"/part-([0-9]+)", 1).try_cast("bigint").alias("n"), file.alias("file"), start.alias("start")).alias("place"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias(value),
    )
    blocks = lines.groupBy("place", "block").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"))
    earlier = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(
        blocks.select("block", "first_row", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")),
        "blocks",
    )
    if starts.groupBy("block").count().where("count > 1").limit(1).count():
        raise ValueError("two file blocks have the same hash")
    unseen = F.raise_error(F.lit("files or their cuts changed since their lines were counted")).cast("long")
    return lookup.lookup_join(lines.drop("place"), starts, "block").select(
        (F.coalesce("before", unseen) + F.col("row") - F.col("first_row")).alias("pos"), value
    )


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Quoted, comma-separated file with a header line."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, truth, prediction)`` of ``truth<TAB>prediction`` lines, in line order.

    Either number may be written as ``3`` or ``3.0``.
    """
    parts = literal_split("value", "\t")
    return number_lines(spark, path).select(
        "pos",
        *[F.get(parts, i).try_cast("double").cast("int").alias(c) for i, c in enumerate(("truth", "prediction"))],
    )
