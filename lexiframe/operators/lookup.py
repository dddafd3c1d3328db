"""Joins of a large table with a dictionary."""

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sources.scratch import materialise

MAX_BROADCAST_BYTES = 64 << 20
#: What a lookup broadcasts whole, written out; in memory it is several times as much.
MAX_LOOKUP_BYTES = 16 << 20
#: Keys of the rows that are joined where they are, if the dictionary is too large to broadcast.
FREQUENT_KEYS = 50_000
#: Keys that the sketch follows for each of them.
TRACKED = 4
#: Bytes that the dictionary's entries of these keys may have.
NEAR_BYTES = 64 << 20
#: Bits of the filter of the other keys: for each key, and at most.
BITS_PER_KEY = 8
MAX_BITS = 1 << 27
WORD = 6


def _bytes() -> Column:
    return F.sum(F.octet_length(F.to_json(F.struct("*"))))


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Measure a table: is its content, written out, at most ``max_bytes``?"""
    return (df.agg(_bytes()).first()[0] or 0) <= max_bytes


def _hashed(df: DataFrame, key: str, kind: T.DataType) -> Column:
    """A hash of the key, equal for equal keys of both tables."""
    own = df.schema[key].dataType
    if own != kind and not (isinstance(own, T.IntegralType) and isinstance(kind, T.IntegralType)):
        raise ValueError(f"{key} is {own.simpleString()} in one table, {kind.simpleString()} in the other")
    return F.xxhash64(F.col(key).cast("bigint") if isinstance(own, T.IntegralType) else F.col(key))


def frequent_hashes(df: DataFrame, hashed: Column, n: int = FREQUENT_KEYS) -> DataFrame:
    """``(_rank, _hash)``: the most frequent hashes of the rows, by a mergeable sketch of bounded size."""
    tracked = max(100, TRACKED * n)
    best = df.select(hashed.alias("_hash")).agg(F.expr(f"approx_top_k(_hash, {n}, {tracked})").alias("best"))
    return best.select(F.posexplode("best").alias("_rank", "_item")).select("_rank", F.col("_item.item").alias("_hash"))


def _near(dictionary: DataFrame, marks: DataFrame, max_bytes: int) -> DataFrame:
    """``(_hash)`` of the first marks whose entries in the dictionary are within the size, added up."""
    entries = dictionary.join(F.broadcast(marks.select("_hash")), "_hash").groupBy("_hash").agg(_bytes().alias("_size"))
    # a row for each mark
    upto = Window.orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = marks.join(F.broadcast(entries), "_hash", "left").withColumn("_upto", F.sum(F.coalesce("_size", F.lit(0))).over(upto))
    return materialise(sized.where(F.col("_upto") <= max_bytes).select("_hash").distinct(), "frequent-keys")


def key_filter(hashes: DataFrame) -> tuple[DataFrame, int]:
    """``(_word, _bits)`` and the number of bits: a bit is set where a hash falls; 64 bits a row.

    A row that falls on a clear bit has no partner; one on a set bit may have one.
    """
    wanted = max(1, hashes.count()) * BITS_PER_KEY
    bits = min(MAX_BITS, 1 << max(WORD, wanted.bit_length()))
    at = F.pmod("_hash", F.lit(bits))
    words = hashes.select(F.shiftright(at, WORD).alias("_word"), F.expr(f"shiftleft(1L, cast(pmod(_hash, {bits}) & 63 as int))").alias("_bit"))
    return materialise(words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), "key-filter"), bits


def lookup_join(
    df: DataFrame,
    dictionary: DataFrame,
    key: str,
    how: str = "left",
    frequent: DataFrame | None = None,
    max_bytes: int = MAX_LOOKUP_BYTES,
    n: int = FREQUENT_KEYS,
) -> DataFrame:
    """Join with a dictionary, which should be a stored table or cheap to read.

    A dictionary measured to be small is broadcast. Beyond that the rows are split by
    their key. Rows of the ``n`` most frequent keys (in the rows, whether the dictionary
    has them or not) are joined in place with a broadcast of these keys' entries, whose size
    is measured, so no frequent key reaches one task. Rows that a filter of the other keys
    tells to have no partner stay in place too, as do null keys; only the rest, rows of rare
    keys in the dictionary, are shuffled. ``frequent`` is a table of frequent keys if they are known.
    """
    if how not in ("left", "inner", "left_anti"):
        raise ValueError(f"unknown join {how!r}")
    if fits_broadcast(dictionary, max_bytes):
        return df.join(F.broadcast(dictionary), key, how)
    kind = df.schema[key].dataType
    hashed, entries = _hashed(df, key, kind), dictionary.withColumn("_hash", _hashed(dictionary, key, kind))
    if frequent is None:
        marks = frequent_hashes(df.where(F.col(key).isNotNull()), hashed, n)
    else:
        known = frequent.select(_hashed(frequent, key, kind).alias("_hash")).limit(n)
        marks = known.select(F.row_number().over(Window.orderBy("_hash")).alias("_rank"), "_hash")
    near = _near(entries, materialise(marks, "marks"), NEAR_BYTES)
    far = entries.where(F.col(key).isNotNull()).join(F.broadcast(near), "_hash", "left_anti")
    words, bits = key_filter(far.select("_hash"))
    at = F.pmod("_hash", F.lit(bits))
    # both are stored and of bounded size
    marked = (
        df.withColumn("_hash", hashed).withColumn("_word", F.shiftright(at, WORD))
        .join(F.broadcast(near.withColumn("_near", F.lit(True))), "_hash", "left")
        .join(F.broadcast(words), "_word", "left")
    )
    bit = F.expr(f"shiftright(_bits, cast(pmod(_hash, {bits}) & 63 as int)) & 1")
    moves = F.col(key).isNotNull() & F.col("_near").isNull() & F.coalesce(bit == 1, F.lit(False))
    close = F.broadcast(entries.join(F.broadcast(near), "_hash", "left_semi").drop("_hash"))
    in_place = marked.where(~moves).select(*df.columns).join(close, key, how)
    moved = marked.where(moves).select(*df.columns).join(dictionary, key, how)
    return in_place.union(moved.select(*in_place.columns))
