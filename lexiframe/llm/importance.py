"""Documents drawn by how much more likely their hashed features are in a target text.

Features are runs of words; a feature's bucket is the CRC-32 of its bytes. The most frequent
words are patterns of an Aho-Corasick automaton, each between two delimiters, with a
payload: CRC and length. One scan of a text emits the payloads of its words. Words that are
no pattern lie in the gaps between the matches and get their payload there. The CRC of a run
follows from the payloads of neighbours alone, as appending bytes shifts a CRC linearly.

Which words are patterns (``PATTERNS`` at most) changes the time, not the result.

The buckets of each document are stored once. Their counts in corpus and target, one number
for each bucket and task, give the gains; the mean gain of a document and a noise made from
its key give its score, and the highest scores are drawn.
"""

import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sources.scratch import materialise
from .words import chunks, owners, sums, utf8

BUCKETS = 10_000
#: Words that the automaton holds.
PATTERNS = 1 << 16
#: Distinct words that a task counts before it starts afresh.
COUNTED = 1 << 19
#: Bytes of text that are scanned together.
CHUNK = 1 << 20
POLYNOMIAL = 0xEDB88320
NOISE = 2.0**32

# A-Z is lowered; all other ASCII but letters and digits delimits words.
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """Row k: the change of a CRC when 2**k zero bytes follow, a table for each of its four bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
    each = np.arange(256, dtype=np.uint32)
    tables = np.empty((32, 4, 256), np.uint32)
    for byte in range(4):
        value = each << np.uint32(8 * byte)
        tables[0, byte] = one[value & 255] ^ value >> np.uint32(8)
    for k in range(1, 32):
        for byte in range(4):
            tables[k, byte] = _shifted(tables[k - 1], tables[k - 1, byte])
    return tables


def _shifted(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def appended(crc: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of strings that others of these lengths follow."""
    crc, tables = crc.copy(), _shifts()
    for k in range(int(length.max(initial=0)).bit_length()):
        has = (length >> k & 1) > 0
        crc[has] = _shifted(tables[k], crc[has])
    return crc ^ other


class Scanner:
    """Payloads of all words of a batch of texts."""

    def __init__(self, patterns: list[str]):
        self.automaton = ahocorasick.Automaton()
        self.crc = np.zeros(len(patterns), np.uint32)
        self.bytes = np.zeros(len(patterns), np.int64)
        self.length = np.array(list(map(len, patterns)), np.int64)
        for i, word in enumerate(patterns):
            self.automaton.add_word(f" {word} ", i)
            self.crc[i], self.bytes[i] = zlib.crc32(word.encode()), len(word.encode())
        self.automaton.make_automaton()
        self.patterns = len(patterns)

    def payloads(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRC and length of each word, and the bounds of each text in them."""
        parts = [t.translate(WORDS).decode() for t in texts]
        joined = " " + " ".join(parts) + " "
        is_word = np.frombuffer(joined.encode("utf-32-le"), "<u4") != 32
        edge = np.flatnonzero(np.diff(is_word.view(np.int8)))
        first, end = edge[::2] + 1, edge[1::2] + 1
        crc, size = np.zeros(len(first), np.uint32), np.zeros(len(first), np.int64)
        rest = np.ones(len(first), bool)
        if self.patterns:
            found = np.fromiter(chain.from_iterable(self.automaton.iter(joined)), np.int64).reshape(-1, 2)
            which = found[:, 1]
            word = np.searchsorted(first, found[:, 0] - self.length[which])
            crc[word], size[word], rest[word] = self.crc[which], self.bytes[which], False
        for i in np.flatnonzero(rest).tolist():
            gap = joined[first[i] : end[i]].encode()
            crc[i], size[i] = zlib.crc32(gap), len(gap)
        starts = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
        return crc, size, np.searchsorted(first, starts + 1)


def runs_of_words(crc: np.ndarray, size: np.ndarray, bounds: np.ndarray, longest: int):
    """``(crc, text)`` of all runs of 1 to ``longest`` words, joined by a space."""
    text, ends = owners(bounds), np.repeat(bounds[1:], np.diff(bounds))
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    spaced = appended(space, crc, size) if longest > 1 else crc
    found, of = [crc], [text]
    acc = crc
    for n in range(2, longest + 1):
        at = np.flatnonzero(np.arange(len(acc)) + n <= ends[: len(acc)])
        if not len(at):
            break
        grown = np.zeros(int(at[-1]) + 1, np.uint32)
        grown[at] = appended(acc[at], spaced[at + n - 1], size[at + n - 1] + 1)
        acc = grown
        found.append(acc[at])
        of.append(text[at])
    return np.concatenate(found), np.concatenate(of)


def frequent_words(docs: DataFrame, text: str = "text", n: int = PATTERNS) -> list[str]:
    """About the ``n`` most frequent words: each task sends those of the ``n`` it met most."""

    def count(batches):
        seen = Counter()

        def best():
            rows = seen.most_common(n)
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.int64())], ["word", "n"]
            )

        for batch in chunks(batches, text, CHUNK):
            for t in utf8(batch.column(text)):
                seen.update(t.translate(WORDS).split(b" "))
            if len(seen) > COUNTED:
                yield best()
                seen.clear()
        yield best()

    words = docs.select(text).mapInArrow(count, "word string, n long").where(F.col("word") != "")
    found = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(n)
    return [r["word"] for r in found.collect()]


@lru_cache(maxsize=1)
def _scanner(patterns: str) -> Scanner:
    return Scanner(patterns.split(" ") if patterns else [])


def bucket_rows(docs: DataFrame, patterns, key: str | None, text: str, longest: int, buckets: int) -> DataFrame:
    """``(key, n_words, n_features, buckets)``: the bucket of each feature, as 32-bit numbers in a binary.

    ``patterns`` is a broadcast of words joined by spaces.
    """

    def scan(batches):
        scanner = _scanner(patterns.value)
        for batch in chunks(batches, text, CHUNK):
            crc, size, bounds = scanner.payloads(utf8(batch.column(text)))
            crc, of = runs_of_words(crc, size, bounds, longest)
            order = np.argsort(of, kind="stable")
            number = np.bincount(of, minlength=batch.num_rows)
            offsets = np.zeros(batch.num_rows + 1, np.int32)
            np.cumsum(4 * number, out=offsets[1:])
            packed = (crc[order] % np.uint32(buckets)).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *([batch.column(key)] if key else []),
                    pa.array(np.diff(bounds)),
                    pa.array(number),
                    pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(packed)]),
                ],
                [*([key] if key else []), "n_words", "n_features", "buckets"],
            )

    fields = T.StructType.fromDDL("n_words long, n_features long, buckets binary").fields
    columns = [key, text] if key else [text]
    return docs.select(*columns).mapInArrow(scan, T.StructType([*([docs.schema[key]] if key else []), *fields]))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of a batch, and the bounds of its rows in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 4
    data = column.buffers()[2]
    values = np.frombuffer(data, "<u4") if data is not None else np.zeros(0, np.uint32)
    return values[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def bucket_counts(rows: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, n)``; a task sends at most one row for each bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("buckets"))[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    each = rows.select("buckets").mapInArrow(count, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, gain)`` for every bucket, from the counts in corpus and target."""
    spark = corpus.sparkSession
    counts = (
        spark.range(buckets).withColumnRenamed("id", "bucket")
        .join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t"))
    )
    total = counts.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    s, t = F.lit(float((total["s"] or 0) + buckets)), F.lit(float((total["t"] or 0) + buckets))
    share = (F.col("t") + 1).cast("double") * s / ((F.col("s") + 1).cast("double") * t)
    return counts.select("bucket", F.floor(1000 * F.ln(share)).cast("long").alias("gain"))


def noise(key: str, seed: int) -> Column:
    """A Gumbel draw in thousandths that depends on seed and key; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / NOISE))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(key, n_features, weight, score, rank)``, one row for each row of ``docs``.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred (rounded
    down) are drawn: the highest scores, equal ones by key, null keys last. ``rank`` counts
    them from 1; it is null for the others. ``weight`` is the floor of the mean gain of a
    document's features, 0 without any. Null and empty texts have no words; equal texts weigh the
    same; repeated rows are drawn one by one; other columns aren't read; an empty table
    gives none, and an empty target is no text.
    """
    spark = docs.sparkSession
    patterns = spark.sparkContext.broadcast(" ".join(frequent_words(docs, text)))
    rows = materialise(bucket_rows(docs, patterns, key, text, longest, buckets), "buckets")
    aim = bucket_rows(target, patterns, None, text, longest, buckets)
    # a number for each bucket
    found = gains(bucket_counts(rows, buckets), bucket_counts(aim, buckets), buckets).toArrow()
    gain = np.zeros(buckets, np.int64)
    gain[np.asarray(found.column("bucket"))] = np.asarray(found.column("gain"))
    shared = spark.sparkContext.broadcast(gain)

    def weigh(batches):
        for batch in batches:
            values, bounds = _flat(batch.column("buckets"))
            number = np.diff(bounds)
            weight = sums(shared.value[values], bounds) // np.maximum(number, 1)
            columns = [batch.column(key), batch.column("n_words"), batch.column("n_features"), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "n_features", "weight"])

    fields = T.StructType.fromDDL("n_words long, n_features long, weight long").fields
    weighed = rows.select(key, "n_words", "n_features", "buckets").mapInArrow(weigh, T.StructType([docs.schema[key], *fields]))
    scored = materialise(weighed.withColumn("score", F.col("weight") + noise(key, seed)), "scored")
    return _drawn(scored, percent, least_words, key)


def _drawn(scored: DataFrame, percent: int, least_words: int, key: str) -> DataFrame:
    spark = scored.sparkSession
    able = F.col("n_words") >= least_words
    # scores are whole numbers between the extremes of gain and noise, some 100,000 whatever the corpus
    counts = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()
    score, n = np.asarray(counts.column("score")), np.asarray(counts.column("n"))
    order = np.argsort(-score)
    score, n = score[order], n[order]
    before = np.cumsum(n) - n
    draws = percent * int(n.sum()) // 100
    near = before < draws
    table = pa.table({"score": pa.array(score[near], pa.int64()), "_before": pa.array(before[near], pa.int64())})
    ranks = F.broadcast(spark.createDataFrame(table))
    joined = scored.join(ranks, "score", "left")
    of_score = Window.partitionBy("score").orderBy(F.col(key).asc_nulls_last())
    chosen = joined.where(able & F.col("_before").isNotNull()).withColumn("_at", F.col("_before") + F.row_number().over(of_score))
    columns = [key, "n_features", "weight", "score"]
    rank = F.when(F.col("_at") <= draws, F.col("_at")).alias("rank")
    others = joined.where(~able | F.col("_before").isNull())
    return chosen.select(*columns, rank).union(others.select(*columns, F.lit(None).cast("long").alias("rank")))
