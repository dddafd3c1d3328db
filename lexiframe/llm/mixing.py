"""Mixing sources to target weights by systematic sampling.

The targets share the size of all texts by the weights of the sources; a target stops at
``most`` times its source, and what is left over is shared again by weight. A text's
expected copies are target / source size. Within its source the expected copies are
summed in a fixed order, one random offset per source is added, and a text is taken once
for each whole number that the sum crosses. A few long texts can carry a small source far
from its target, so the offset is the best of a fixed number of random ones.

Sums are exact: expected copies are counted in units of 2^-24. The order goes by key hash.
The sum over a source is cut into strata of 4,096 hash bins: one window runs over a
source's strata and another over the rows of a stratum, never over a source.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.lookup import MAX_BROADCAST_BYTES, lookup_join
from ..sources.scratch import materialise
from .decisions import attach, row_hash

UNIT_BITS = 24
MOST = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"
TRIES = 64

#: Sizes in words, without a regular expression's cost for each word.
SPACES = "\t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    runs = F.split(F.translate(text, SPACES, " " * len(SPACES)), " ", -1)
    return F.coalesce(F.size(F.filter(runs, lambda x: x != "")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn. One row
    per source goes through a window without partitions.
    """
    all_rows = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = summed.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), place.cast("int")))
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    # sources fill up in the order of cap / weight; one is full if its share of the rest exceeds its cap
    marked = (
        weighed.withColumn("cap", most * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("weight", F.sum("w").over(all_rows))
        .withColumn("taken", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("gone", F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn(
            "full",
            F.col("cap").cast("double") * (F.col("weight") - F.col("gone"))
            <= F.col("w").cast("double") * (F.col("total") - F.col("taken")),
        )
        .withColumn("rest", F.col("total") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(all_rows))
        .withColumn("left", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(all_rows))
    )
    share = F.col("w") * F.col("rest").cast("double") / F.col("left")
    return marked.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def _hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


def _crossed(upto: Column, offset: Column) -> Column:
    """Whole numbers crossed by a row whose units end at ``upto``."""
    return F.shiftright(upto + offset, UNIT_BITS) - F.shiftright(upto + offset - F.col("units"), UNIT_BITS)


def systematic_copies(rows: DataFrame, seed: str = SEED, tries: int = TRIES) -> DataFrame:
    """Add ``copies`` to ``(key, hash, source, size, expected)`` rows.

    ``expected`` is a double, the same or not for the rows of a source. Rows that agree in
    key and hash are interchangeable. Of ``tries`` random offsets a source gets the
    one whose copies come nearest to its expected size.
    """
    placed = (
        rows.withColumn("units", F.floor(F.col("expected") * (1 << UNIT_BITS)).cast("bigint"))
        .withColumn("bin", _hex(F.coalesce(F.col("key").cast("string"), F.lit("")), 3))
    )
    stratum = ["source", "bin"]
    strata = materialise(placed.groupBy(*stratum).agg(F.sum("units").alias("sum")), "strata")
    over_strata = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    strata = strata.withColumn("before", F.coalesce(F.sum("sum").over(over_strata), F.lit(0)))
    strata = strata.select(*(F.col(x).alias(f"_{x}") for x in stratum), "before")
    on = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in stratum]
    within = Window.partitionBy(*stratum).orderBy("key", "hash").rowsBetween(Window.unboundedPreceding, 0)
    summed = (
        placed.join(strata, on[0] & on[1])
        .withColumn("upto", F.col("before") + F.sum("units").over(within))
        .select(*rows.columns, "units", "upto", F.to_json(F.struct("source")).alias("_name"))
    )
    summed = materialise(summed, "summed")
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    offsets = [_hex(F.concat(F.lit(f"{seed}{k}"), name), UNIT_BITS // 4) for k in range(tries)]
    wide = "decimal(38,0)"
    sums = [F.sum((F.col("size") * _crossed(F.col("upto"), x)).cast(wide)).alias(f"t{k}") for k, x in enumerate(offsets)]
    goal = F.sum(F.col("size").cast(wide) * F.col("units").cast(wide)).cast(wide).alias("goal")
    tried = summed.groupBy("_name", "source").agg(goal, *sums)
    misses = [
        F.struct(F.abs(F.col(f"t{k}").cast(wide) * (1 << UNIT_BITS) - F.col("goal")).alias("miss"), F.lit(k).alias("k"), x.alias("offset"))
        for k, x in enumerate(offsets)
    ]
    best = materialise(tried.select("_name", F.array_min(F.array(*misses))["offset"].alias("offset")), "offsets")
    return lookup_join(summed, best, "_name", max_bytes=MAX_BROADCAST_BYTES).select(*rows.columns, _crossed(F.col("upto"), F.col("offset")).alias("copies"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple = WEIGHTS, most: int = MOST, seed: str = SEED,
) -> DataFrame:
    """``(key, hash, source, size, source_size, target, expected, copies)`` of every row.

    A null or empty text has size 0 and a source of such texts the target 0; null sources
    are one source, the last. Repeated rows are sampled each by itself. Other columns
    aren't read; an empty table gives none. Reruns agree, on any partitioning.
    """
    sizes = materialise(
        docs.select(
            F.col(key).alias("key"), row_hash(key, text).alias("hash"),
            F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
        ),
        "sizes",
    )
    by_source = materialise(
        targets(sizes, weights, most).withColumn("_name", F.to_json(F.struct("source"))).drop("source"), "targets"
    )
    named = lookup_join(sizes.withColumn("_name", F.to_json(F.struct("source"))), by_source, "_name", max_bytes=MAX_BROADCAST_BYTES).drop("_name")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return systematic_copies(named.withColumn("expected", expected), seed)


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken."""
    taken = mix(docs, key, text, source, **how)
    decisions = taken.groupBy(F.col("key").alias("_key"), F.col("hash").alias("_hash")).agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")
    )
    decisions = materialise(decisions.where("_copies > 0"), "copies")
    joined = attach(docs.withColumn("_mix", row_hash(key, text)), decisions, key, text)
    single = joined.where("_rows = 1")
    # equal rows share their copies as evenly as can be
    place = F.row_number().over(Window.partitionBy("_mix", F.col(key)).orderBy(F.lit(0)))
    each = F.floor(F.col("_copies") / F.col("_rows"))
    extra = F.col("_copies") - each * F.col("_rows")
    repeated = joined.where("_rows > 1").withColumn("_copies", each + (place <= extra).cast("bigint"))
    return (
        single.union(repeated)
        .where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        .select(*docs.columns)
    )
