"""Repeated passages, counted exactly in buckets of super-k-mers.

A window is ``k`` consecutive words; its minimiser is the least hash of the runs of ``m``
words in it, so equal windows have equal minimisers. Consecutive windows of a text that
share a minimiser are a super-k-mer: one packed string, sent once to the bucket of the
minimiser, where its windows are unpacked, sorted and compared as words.

* Minimisers are counted first. A window whose minimiser occurs once in the corpus is
  unique, so its words stay where they are. The minimisers that occur more often are kept
  as a bitmap of ``2**BITS`` bits; a bit that stands for several costs traffic, not results.
* Equal packed strings are joined before they are sent: only the earliest travels, the
  others are repeats already.
* A minimiser with more than ``HOT`` super-k-mers sends single windows instead, dealt by
  first and last word too, so no bucket gathers what a few phrases share.
"""

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..sources.scratch import materialise
from .decisions import attach, row_hash
from .words import chunks, hashes, mixed, owners, runs, utf8, word_numbers

BITS, HOT_BITS = 28, 22
HOT = 2_000
LAST = 2**63 - 1


@dataclass(frozen=True)
class Windows:
    """Words of a window and of a minimiser."""

    k: int = 20
    m: int = 6

    @property
    def reach(self) -> int:
        """Runs of m words in a window: the most windows that one run can be the minimiser of."""
        return self.k - self.m + 1


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n < 1:
        return values[:0]
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[:n], values[width - step : width - step + n])


def super_kmers(word_hashes: np.ndarray, bounds: np.ndarray, w: Windows):
    """Minimiser, text, place of the first word, windows and recurrence of each super-k-mer.

    A super-k-mer recurs if its minimiser stands at two or more places in it.
    """
    n = len(word_hashes)
    if n < w.k:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool)
    grams = np.zeros(n - w.m + 1, np.uint64)
    for t in range(w.m):
        grams = mixed(grams) + word_hashes[t : t + len(grams)]
    grams = mixed(grams)
    least = _least(grams, w.reach)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    text_of = owners(bounds)
    at = np.flatnonzero(np.arange(len(least)) + w.k <= ends[: len(least)])
    least, text_of = least[at], text_of[at]
    opens = np.ones(len(at), bool)
    opens[1:] = (least[1:] != least[:-1]) | (text_of[1:] != text_of[:-1])
    first = np.flatnonzero(opens)
    least, text_of, at, size = least[first], text_of[first], at[first], np.diff(np.append(first, len(at)))
    within = np.arange(w.reach)
    left = (grams[at[:, None] + within] == least[:, None]).argmax(axis=1)
    last = at + size - 1
    right = (grams[last[:, None] + within[::-1]] == least[:, None]).argmax(axis=1)
    return least, text_of, at, size, at + left != last + w.reach - 1 - right


def _counted(text: str, w: Windows):
    """Minimisers with their super-k-mers; one that recurs inside its super-k-mer counts twice."""

    def count(batches):
        for batch in chunks(batches, text):
            ids, bounds, words = word_numbers(utf8(batch.column(text)))
            least, _, _, _, recurs = super_kmers(hashes(words)[ids], bounds, w)
            least, place = np.unique(least, return_inverse=True)
            weight = np.bincount(place, 1 + recurs, len(least)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), pa.array(weight)], ["least", "n"])

    return count


def _bitmap(least: DataFrame, bits: int) -> np.ndarray:
    """A bit for the first ``bits`` bits of each value: at most 2**(bits - 6) rows reach the driver."""
    place = F.shiftrightunsigned("least", 64 - bits)
    cells = (
        least.select(F.shiftright(place, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(least, {64 - bits}) & 63 AS int))").alias("bit"))
        .groupBy("cell")
        .agg(F.bit_or("bit").alias("word"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[np.asarray(cells.column("cell"))] = np.asarray(cells.column("word"))
    return bitmap.view(np.uint8)


def _marked(bitmap: np.ndarray, bits: int, least: np.ndarray) -> np.ndarray:
    place = least >> np.uint64(64 - bits)
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


class Earliest(dict):
    """Packed strings with the earliest place each was seen at; later places go to ``repeats``."""

    def __init__(self):
        super().__init__()
        self.repeats: list[tuple[int, int, int, int]] = []

    def add(self, key: int, packed: bytes, windows: int, doc: int, row: int, start: int) -> None:
        known = self.get((key, packed))
        if known is None or (doc, start) < known[:2]:
            if known:
                self.repeats += [(known[0], x, known[1], windows) for x in known[2]]
            self[key, packed] = (doc, start, [row], windows)
        elif (doc, start) > known[:2]:
            self.repeats.append((doc, row, start, windows))
        elif row not in known[2]:
            known[2].append(row)


SENT = "key bigint, doc bigint, row bigint, start bigint, windows bigint, packed binary"


def _rows(found: Earliest):
    rows = [(key, doc, x, start, n, packed) for (key, packed), (doc, start, own, n) in found.items() for x in own]
    rows += [(int(row), doc, row, start, n, None) for doc, row, start, n in found.repeats]
    types = [pa.int64()] * 5 + [pa.binary()]
    names = [x.split()[0] for x in SENT.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def _packed(w: Windows, bitmaps):
    def pack(batches):
        repeated, hot = bitmaps.value
        for batch in chunks(batches, "text"):
            texts = utf8(batch.column("text"))
            ids, bounds, words = word_numbers(texts)
            own = hashes(words)
            flat = list(chain.from_iterable(t.split() for t in texts))
            least, text_of, at, size, _ = super_kmers(own[ids], bounds, w)
            docs = [LAST if x is None else x for x in batch.column("key").to_pylist()]
            rows = batch.column("row").to_pylist()
            chosen = np.flatnonzero(_marked(repeated, BITS, least))
            often = _marked(hot, HOT_BITS, least[chosen])
            starts = at - bounds[text_of]
            found = Earliest()
            for i in chosen[~often].tolist():
                a, n, t = int(at[i]), int(size[i]), int(text_of[i])
                packed = b" ".join(flat[a : a + n + w.k - 1])
                found.add(int(least[i].view(np.int64)), packed, n, docs[t], rows[t], int(starts[i]))
            for i in chosen[often].tolist():
                t, start = int(text_of[i]), int(starts[i])
                places = np.arange(at[i], at[i] + size[i])
                keys = mixed(mixed(least[i] + own[ids[places]]) + own[ids[places + w.k - 1]]).view(np.int64)
                for j, (a, key) in enumerate(zip(places.tolist(), keys.tolist(), strict=True)):
                    found.add(key, b" ".join(flat[a : a + w.k]), 1, docs[t], rows[t], start + j)
            yield _rows(found)

    return pack


def _repeats_of(bucket: pa.Table, w: Windows) -> list[tuple[int, int, int, int]]:
    """``(doc, row, first, windows)`` of the windows of a bucket that also start earlier."""
    found = Earliest()
    for _, doc, row, start, n, packed in zip(*(c.to_pylist() for c in bucket.columns), strict=True):
        if packed is None:
            found.repeats.append((doc, row, start, n))
        else:
            found.add(0, packed, n, doc, row, start)
    if len(found) > 1 or any(x[3] > 1 for x in found.values()):
        windows = []
        for (_, packed), (doc, start, rows, n) in found.items():
            words = packed.split(b" ")
            windows += [(b" ".join(words[i : i + w.k]), doc, start + i, rows) for i in range(n)]
        windows.sort(key=lambda x: x[:3])
        first = None
        for window, doc, start, rows in windows:
            if first is None or window != first[0]:
                first = (window, doc, start)
            elif (doc, start) > first[1:]:
                found.repeats += [(doc, row, start, 1) for row in rows]
    return found.repeats


def _joined(repeats: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Neighbouring windows of a row as one span ``(doc, row, from, to)``."""
    spans: list[list[int]] = []
    for doc, row, start, n in sorted(repeats):
        if spans and spans[-1][:2] == [doc, row] and start <= spans[-1][3]:
            spans[-1][3] = max(spans[-1][3], start + n)
        else:
            spans.append([doc, row, start, start + n])
    return spans


def _sorted_buckets(w: Windows):
    def unpack(batches):
        held: list = []

        def out():
            spans = _joined(held)
            columns = zip(*spans, strict=True) if spans else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["doc", "row", "a", "b"])

        for bucket in runs(batches, "key"):
            held += _repeats_of(bucket, w)
            if len(held) > 100_000:
                yield out()
                held = []
        yield out()

    return unpack


def _cut(key: str, text: str, w: Windows):
    def cut(batches):
        for batch in chunks(batches, text):
            sizes, removed, kept = [], [], []
            for t, spans in zip(utf8(batch.column(text)), batch.column("_spans").to_pylist(), strict=True):
                words = t.split()
                edge = np.zeros(len(words) + 1, np.int64)
                for span in spans or ():
                    edge[span["a"]] += 1
                    edge[min(span["b"] + w.k - 1, len(words))] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                sizes.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([x for x, out in zip(words, gone.tolist(), strict=True) if not out]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                [key, "n_words", "n_removed", "kept"],
            )

    return cut


def repeated_windows(docs: DataFrame, key: str, text: str, w: Windows) -> DataFrame:
    """``(_key, _hash, a, b)``: windows that start at the words a to b - 1 of a row also start earlier."""
    plain = docs.select(F.col(key).cast("bigint").alias("key"), row_hash(key, text).alias("row"), F.col(text).alias("text"))
    counted = plain.select("text").mapInArrow(_counted("text", w), "least bigint, n bigint")
    often = materialise(counted.groupBy("least").agg(F.sum("n").alias("n")).where("n > 1"), "minimisers")
    bitmaps = docs.sparkSession.sparkContext.broadcast(
        (_bitmap(often, BITS), _bitmap(often.where(F.col("n") > HOT), HOT_BITS))
    )
    sent = plain.mapInArrow(_packed(w, bitmaps), SENT)
    spans = sent.repartition("key").sortWithinPartitions("key").mapInArrow(
        _sorted_buckets(w), "doc bigint, row bigint, a bigint, b bigint"
    )
    return spans.select(F.nullif("doc", F.lit(LAST)).alias("_key"), F.col("row").alias("_hash"), "a", "b")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", w: Windows = Windows()) -> DataFrame:
    """``(key, n_words, n_removed, kept)``: each row's words that no earlier passage covers.

    A word goes if a window over it also starts earlier: at a smaller key, or earlier in the
    row. ``kept`` are the others, joined by a space. Rows are judged on the input. A null
    or empty text has no words; a text shorter than a window keeps all. Rows that share a key
    don't come before each other; equal rows get equal results. Null keys come last. Other
    columns aren't read; an empty table gives none.
    """
    spans = repeated_windows(docs, key, text, w)
    by_row = spans.groupBy("_key", "_hash").agg(F.collect_list(F.struct("a", "b")).alias("_spans"))
    joined = attach(docs.select(key, text), materialise(by_row, "repeats"), key, text)
    fields = [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())
    ]
    return joined.select(key, text, "_spans").mapInArrow(_cut(key, text, w), T.StructType([docs.schema[key], *fields]))
