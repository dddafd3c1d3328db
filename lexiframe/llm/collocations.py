"""Phrases whose words occur together, counted in quotient filters.

Texts are cut at punctuation and line ends into pieces, and those into words; phrases don't
reach beyond a piece. All counts are per language. A phrase that occurs often enough has
only frequent words, and only frequent phrases inside it. So the passes are:

1. A chunk of texts of one language becomes numbers of its own words, stored; its distinct
   words with their counts are added up over all chunks.
2. Frequent words get ids below 2**32. Each chunk gets the ids of its words by a join of
   distinct words, and is stored as ids, 0 where a piece ends or a word is rare.
3. Pairs of ids, 64 bits, are counted. A bitmap of the frequent ones, of bounded size, tells
   the next pass where longer phrases may be; a bit that stands for several pairs costs
   traffic, not results.
4. Three and four ids, 128 bits, are counted.

A task adds up what it counts in a bounded table, cuts it by shard and sends a counting
quotient filter for each shard. The number of shards follows the number of words, and the
permutation spreads phrases evenly over them; a phrase comes once from each table that a
task sends, however often it occurs. The filters of a shard are merged in order.
"""

from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sources.scratch import materialise
from . import quotient
from .superkmers import _bitmap, _marked
from .words import Interner, chunks, runs, utf8

UNKNOWN = "und"
#: Bytes of text that share a list of words.
CHUNK = 4 << 20
#: Phrases that a task counts before it sends them.
HELD = 1 << 20
#: Occurrences for each shard, about.
SHARD = 1 << 20
#: Bits of the bitmap of frequent pairs at most.
BITMAP_BITS = 28
#: Rows that are ranked together.
RANKED = 1 << 18
#: A byte that no text in UTF-8 has.
BREAK = b"\xff"
WORD_BITS = 32

# A-Z is lowered, .,;:!? and the line ends end a piece, a tab parts words.
LOWER = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n\n "
)


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u4").tobytes())


def _widened(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<u4")


def _coded(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``(chunk, lang, codes, words, counts)``: texts as numbers of the words of their chunk, 0 between pieces."""

    def code(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in chunks(batches, "_text", CHUNK):
            languages = batch.column("_lang").to_pylist()
            texts = utf8(batch.column("_text"))
            for language in dict.fromkeys(languages):
                joined = b"\n".join(t for t, x in zip(texts, languages, strict=True) if x == language)
                words = Interner({BREAK: 0})
                found = joined.translate(LOWER).replace(b"\n", b" " + BREAK + b" ").split()
                codes = np.fromiter(map(words.__getitem__, found), np.uint32, len(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part << 32 | number]),
                        pa.array([language]),
                        pa.array([_squeezed(codes)], pa.binary()),
                        pa.array([[w.decode() for w in words if w != BREAK]], pa.list_(pa.string())),
                        pa.array([np.bincount(codes, minlength=len(words))[1:]], pa.list_(pa.int64())),
                    ],
                    ["chunk", "lang", "codes", "words", "counts"],
                )
                number += 1

    columns = docs.select(F.coalesce(lang, F.lit(UNKNOWN)).alias("_lang"), F.col(text).alias("_text"))
    return columns.mapInArrow(code, "chunk long, lang string, codes binary, words array<string>, counts array<long>")


def _with_ids(words: DataFrame) -> DataFrame:
    """Number the rows of a table from 1 on; stored twice, as the numbers must not change."""
    placed = materialise(words.withColumn("_row", F.monotonically_increasing_id()), "frequent-words")
    part = F.shiftright("_row", 33)
    parts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row for each task
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    nth = F.col("_row").bitwiseAND((1 << 33) - 1)
    numbered = placed.withColumn("_part", part).join(F.broadcast(parts), "_part").withColumn("id", nth + F.col("_before") + 1)
    return materialise(numbered.drop("_row", "_part", "_before"), "word-ids")


def _numbered(coded: DataFrame, ids: DataFrame) -> DataFrame:
    """``(ids)`` of each chunk: the ids of its words, 0 between pieces and for rare words."""
    words = coded.select("chunk", "lang", F.posexplode("words").alias("code", "word"))
    found = words.join(ids.select("lang", "word", "id"), ["lang", "word"]).groupBy("chunk")
    known = found.agg(F.collect_list(F.struct("code", "id")).alias("known"))

    def number(batches):
        for batch in batches:
            for packed, known in zip(batch.column("codes").to_pylist(), batch.column("known"), strict=True):
                codes = _widened(packed)
                table = np.zeros(int(codes.max(initial=0)) + 1, np.uint32)
                flat = known.values
                table[np.asarray(flat.field("code")) + 1] = np.asarray(flat.field("id"))
                yield pa.RecordBatch.from_arrays([pa.array([_squeezed(table[codes])], pa.binary())], ["ids"])

    return coded.select("chunk", "codes").join(known, "chunk").select("codes", "known").mapInArrow(number, "ids binary")


def _pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed pairs of neighbours, and which of them are whole."""
    wide = ids.astype(np.uint64)
    return wide[:-1] << np.uint64(WORD_BITS) | wide[1:], (ids[:-1] > 0) & (ids[1:] > 0)


def pairs_of(ids: np.ndarray) -> tuple[np.ndarray, ...]:
    packed, whole = _pairs(ids)
    return (packed[whole],)


def longer_of(ids: np.ndarray, frequent, longest: int) -> tuple[np.ndarray, ...]:
    """Packed runs of three to ``longest`` ids all of whose pairs ``frequent`` tells to be so."""
    packed, whole = _pairs(ids)
    good = whole.copy()
    good[whole] = frequent(packed[whole])
    two = good[:-1] & good[1:]
    at = np.flatnonzero(two)
    first, second = [packed[at]], [packed[at + 1] << np.uint64(WORD_BITS)]
    if longest > 3:
        at = np.flatnonzero(two[:-1] & good[2:])
        first.append(packed[at])
        second.append(packed[at + 2])
    return np.concatenate(first), np.concatenate(second)


def _sent(numbered: DataFrame, grams, bits: int) -> DataFrame:
    """``(shard, filter)``: what the tasks count, a filter for each shard and filled table."""

    def count(batches):
        held, raw, waiting = None, [], 0

        def settle():
            nonlocal held, raw, waiting
            columns = tuple(map(np.concatenate, zip(*raw, strict=True)))
            fresh = quotient.Counts.of(quotient.permuted(columns))
            held, raw, waiting = fresh if held is None else quotient.Counts.merged([held, fresh]), [], 0

        def rows():
            found = list(held.shards(bits))
            for start in range(0, len(found), 256):
                some = found[start : start + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in some]), pa.array([quotient.pack(c, bits) for _, c in some], pa.binary())],
                    ["shard", "filter"],
                )

        for packed in chain.from_iterable(b.column("ids").to_pylist() for b in batches):
            found = grams(_widened(packed))
            raw.append(found)
            waiting += len(found[0])
            if waiting >= HELD:
                settle()
                if len(held) >= HELD:
                    yield from rows()
                    held = None
        if waiting:
            settle()
        if held is not None and len(held):
            yield from rows()

    return numbered.mapInArrow(count, "shard long, filter binary")


def _merged(sent: DataFrame, bits: int, least: int) -> DataFrame:
    """``(hi, lo, a)``: keys that occur at least so often, with ``lo`` 0 for keys of one number."""

    def merge(batches):
        for table in runs(batches, "shard"):
            shard, parts = table.column("shard")[0].as_py(), []
            for packed in table.column("filter").to_pylist():
                parts.append(quotient.unpack(packed, shard, bits))
                while len(parts) > 1 and len(parts[-1]) * 2 >= len(parts[-2]):
                    parts[-2:] = [quotient.Counts.merged(parts[-2:])]
            total = quotient.Counts.merged(parts)
            often = total.n >= least
            keys = quotient.restored(tuple(c[often] for c in total.columns))
            hi, lo = keys if len(keys) > 1 else (keys[0], np.zeros(len(keys[0]), np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), pa.array(total.n[often])], ["hi", "lo", "a"]
            )

    placed = sent.repartition(1 << bits, "shard").sortWithinPartitions("shard")
    return placed.mapInArrow(merge, "hi long, lo long, a long")


def _frequent(numbered: DataFrame, grams, words: int, least: int, name: str) -> DataFrame:
    bits = max(1, (words // SHARD).bit_length())
    return materialise(_merged(_sent(numbered, grams, bits), bits, least), name)


# A phrase is two longs of two ids each, 0 where it has no more words.
LAST = (1 << WORD_BITS) - 1


def _word(i: int) -> Column:
    packed = F.col("hi" if i < 2 else "lo")
    return F.shiftrightunsigned(packed, WORD_BITS) if i % 2 == 0 else packed.bitwiseAND(LAST)


def _packed(first: int, last: int) -> tuple[Column, Column]:
    """The phrase of the words ``first`` to ``last`` (exclusive) of a phrase."""
    ids = [_word(i) if i < last else F.lit(0).cast("long") for i in range(first, first + 4)]
    return tuple(F.shiftleft(ids[j], WORD_BITS).bitwiseOR(ids[j + 1]) for j in (0, 2))


def _size() -> Column:
    return F.lit(2) + (_word(2) > 0).cast("int") + (_word(3) > 0).cast("int")


def cut_score(a: Column, both: Column) -> Column:
    """``floor(2000000 * a / both)``; the product may pass 64 bits."""
    return F.call_function("div", a.cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(7,0)"), both.cast("decimal(20,0)"))


def _cuts(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``(hi, lo, a, l, r, score)`` of each phrase: its lowest-scoring cut, the first one of equals."""
    cuts = []
    for size in (2, 3, 4):
        for k in range(1, size):
            (lhi, llo), (rhi, rlo) = _packed(0, k), _packed(k, size)
            cut = F.struct(F.lit(k).alias("k"), lhi.alias("lhi"), llo.alias("llo"), rhi.alias("rhi"), rlo.alias("rlo"))
            cuts.append(F.when(_size() == size, cut))
    rows = grams.select("hi", "lo", "a", F.explode(F.array_compact(F.array(*cuts))).alias("cut")).select("hi", "lo", "a", "cut.*")
    left = counts.select(F.col("hi").alias("lhi"), F.col("lo").alias("llo"), F.col("a").alias("l"))
    right = counts.select(F.col("hi").alias("rhi"), F.col("lo").alias("rlo"), F.col("a").alias("r"))
    scored = rows.join(left, ["lhi", "llo"]).join(right, ["rhi", "rlo"])
    cut = F.struct(cut_score(F.col("a"), F.col("l") + F.col("r")).alias("score"), "k", "l", "r")
    return scored.groupBy("hi", "lo", "a").agg(F.min(cut).alias("cut")).select("hi", "lo", "a", "cut.l", "cut.r", "cut.score")


def _covered(grams: DataFrame) -> DataFrame:
    """``(hi, lo, longer)``: the highest count of a longer phrase around each phrase."""
    inside = []
    for size in (3, 4):
        for length in range(2, size):
            for at in range(size - length + 1):
                hi, lo = _packed(at, at + length)
                inside.append(F.when(_size() == size, F.struct(hi.alias("hi"), lo.alias("lo"))))
    rows = grams.where(_word(2) > 0).select("a", F.explode(F.array_compact(F.array(*inside))).alias("part"))
    return rows.groupBy("part.hi", "part.lo").agg(F.max("a").alias("longer"))


def phrases(
    docs: DataFrame,
    least: int = 30,
    longest: int = 4,
    covered: int = 80,
    top: int = 2000,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language.

    A phrase has 2 to ``longest`` (2 to 4) words and occurs ``a >= least`` times. It is cut
    where ``score``, the floor of 2,000,000 times its count by the sum of the counts ``l`` and
    ``r`` of both parts, is lowest, first of equals. It is left out if a longer one around it
    occurs at least ``covered`` percent as often. Order: score and ``a`` falling, then the
    phrase by its bytes. ``n`` counts the words of the language. A null language is ``und``, a
    null text is empty; repeated rows count again; other columns aren't read; an empty table
    gives none.
    """
    if not 2 <= longest <= 4 or least < 1:
        raise ValueError("phrases have 2 to 4 words and occur at least once")
    coded = materialise(_coded(docs, text, lang), "coded-chunks")
    each = coded.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("lang", "x.words", "x.counts")
    words = each.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("a"))
    ids = _with_ids(words.where(F.col("a") >= least))
    if ids.count() > LAST:
        raise ValueError("ids of frequent words have 32 bits")
    totals = materialise(
        coded.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n")),
        "word-totals",
    )
    occurrences = totals.agg(F.sum("n")).first()[0] or 0
    numbered = materialise(_numbered(coded, ids), "numbered-chunks")
    pairs = _frequent(numbered, pairs_of, occurrences, least, "pairs")
    grams = pairs
    if longest > 2:
        number = pairs.count()
        bits = min(BITMAP_BITS, max(12, (16 * number).bit_length()))
        spread = _spread(pairs)
        bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(spread, bits))

        def frequent(packed):
            return _marked(bitmap.value, bits, quotient.permuted((packed,))[0])

        more = _frequent(numbered, lambda x: longer_of(x, frequent, longest), occurrences, least, "longer-phrases")
        grams = pairs.union(more)
    single = ids.select(F.shiftleft("id", WORD_BITS).alias("hi"), F.lit(0).cast("long").alias("lo"), "a")
    scored = _cuts(grams, grams.union(single))
    kept = scored.join(_covered(grams), ["hi", "lo"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a"))
    )
    return _ranked(materialise(kept.drop("longer"), "phrases"), ids, totals, top)


def _spread(pairs: DataFrame) -> DataFrame:
    """``(least)``: the permuted keys, as the bitmap takes them."""

    def spread(batches):
        for batch in batches:
            keys = np.asarray(batch.column("hi")).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(quotient.permuted((keys,))[0].view(np.int64))], ["least"])

    return pairs.select("hi").mapInArrow(spread, "least long")


def _ranked(scored: DataFrame, ids: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first rows of each language, in parts first, so that a large language has many tasks."""
    first = ids.select(F.col("id").alias("_id0"), F.col("word").alias("_w0"), "lang")
    rows = scored.withColumn("_id0", _word(0)).join(first, "_id0")
    parts = max(1, scored.count() // RANKED)
    best = [F.desc("score"), F.desc("a")]
    of_part = Window.partitionBy("lang", F.pmod(F.xxhash64("hi", "lo"), F.lit(parts))).orderBy(*best)
    rows = rows.withColumn("_rank", F.rank().over(of_part)).where(F.col("_rank") <= top)
    for i in (1, 2, 3):
        other = ids.select(F.col("id").alias(f"_id{i}"), F.col("word").alias(f"_w{i}"))
        rows = rows.withColumn(f"_id{i}", _word(i)).join(other, f"_id{i}", "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", *(f"_w{i}" for i in range(4))))
    of_lang = Window.partitionBy("lang").orderBy(*best, "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(of_lang).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
