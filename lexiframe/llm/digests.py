"""Similarity digests of improbable features, and what editing does to them.

A feature is a window of 64 bytes. Its entropy is kept in 1,001 steps; how often each step
occurs in the corpus ranks the features by rarity, the rarest first. In each run of 64
neighbouring windows the leftmost rarest one scores a point; features with 16 points or more are
selected. Their hashes set five bits each in a Bloom filter of 2,048 bits; after 160
features the next filter of the chain begins. Two filters are as alike as their common
bits exceed what chance gives; two chains as the best matches of the shorter one.

Entropies are exact integers, rolled over a batch: a byte that enters or leaves a window
changes the sum by an amount that its count within the window gives.
"""

import base64
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .words import chunks, mixed, utf8

WIDTH = 64
STEPS = 1000
#: Windows of less entropy are never features.
LEAST_STEP = 100
POINTS = 16
FILTER_BITS, PLACES, CAPACITY = 2048, 5, 160
#: Part of the range above chance that still counts as nothing in common.
MARGIN = 0.3
CHUNK = 1 << 20
#: Bytes of text of a bucket of neighbouring rows.
BUCKET_BYTES = 16 << 20

_COUNT = np.arange(1, WIDTH + 1) / WIDTH
#: Share of a byte value that occurs c times in a window, in units of 2^-20 bits.
_SHARE = np.concatenate([[0], np.round(-_COUNT * np.log2(_COUNT) * 2**20)]).astype(np.int64)
_MOST = int(np.log2(WIDTH)) << 20


def entropy_steps(data: np.ndarray) -> np.ndarray:
    """Entropy step of the window that starts at each byte, as far as windows fit."""
    n = len(data)
    if n < WIDTH:
        return np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, WIDTH):
        same = (data[k:] == data[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    enters = before[WIDTH:]
    leaves = after[: n - WIDTH]
    change = _SHARE[enters + 1] - _SHARE[enters] + _SHARE[leaves] - _SHARE[leaves + 1]
    total = np.empty(n - WIDTH + 1, np.int64)
    total[0] = _SHARE[np.bincount(data[:WIDTH])].sum()
    np.cumsum(change, out=total[1:])
    total[1:] += total[0]
    return np.minimum(total * STEPS // _MOST, STEPS)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(list(map(len, texts)), out=bounds[1:])
    return np.frombuffer(b"".join(texts), np.uint8), bounds


def _inside(bounds: np.ndarray, windows: int, width: int) -> np.ndarray:
    """Starts of runs of ``width`` bytes that lie in one text, among the first ``windows`` places."""
    ends = np.repeat(bounds[1:], np.diff(bounds))[:windows]
    return np.flatnonzero(np.arange(windows) + width <= ends)


def step_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each entropy step occurs in the corpus: 1,001 numbers."""

    def count(batches):
        for batch in chunks(batches, text, CHUNK):
            data, bounds = _joined(utf8(batch.column(text)))
            steps = entropy_steps(data)
            found = np.bincount(steps[_inside(bounds, len(steps), WIDTH)], minlength=STEPS + 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(STEPS + 1)), pa.array(found)], ["step", "n"])

    rows = docs.select(text).mapInArrow(count, "step bigint, n bigint").groupBy("step").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(STEPS + 1, np.int64)
    for row in rows:
        counts[row["step"]] = row["n"]
    return counts


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each step, the rarest 0; weak windows come last."""
    order = np.lexsort((np.arange(len(counts)), counts, np.arange(len(counts)) < LEAST_STEP))
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    return rank


@dataclass
class Digest:
    """A chain of Bloom filters and the number of features in each."""

    filters: np.ndarray
    sizes: np.ndarray

    def __str__(self) -> str:
        parts = [bytes([n]) + f.tobytes() for n, f in zip(self.sizes.tolist(), self.filters, strict=True)]
        return base64.b64encode(b"".join(parts)).decode()


def features(texts: list[bytes], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and 64-bit hash of the selected features, in order of place."""
    data, bounds = _joined(texts)
    steps = entropy_steps(data)
    windows = len(steps)
    usable = _inside(bounds, windows, WIDTH)
    key = np.full(windows, np.iinfo(np.int64).max)
    key[usable] = (rank[steps[usable]] << 40) | usable
    size = np.diff(bounds)
    points = np.zeros(windows, np.int64)
    least, step = key, 1
    while step < WIDTH:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
        if not len(least):
            break
    if len(least):
        runs = _inside(bounds, len(least), 2 * WIDTH - 1)
        points = np.bincount(least[runs] & ((1 << 40) - 1), minlength=windows)
    chosen = np.flatnonzero(points >= POINTS)
    if len(chosen):
        chosen = chosen[steps[chosen] >= LEAST_STEP]
    text_of = np.searchsorted(bounds, chosen, "right") - 1
    # a text with too few windows for a selection gives its rarest one, or itself
    few = np.flatnonzero((size > 0) & (np.bincount(text_of, minlength=len(texts)) == 0))
    own = np.array([xxhash.xxh3_64_intdigest(texts[i]) for i in few if size[i] < WIDTH], np.uint64)
    rarest = np.array([bounds[i] + int(np.argmin(key[bounds[i] : bounds[i + 1] - WIDTH + 1])) for i in few if size[i] >= WIDTH], np.int64)
    chosen = np.concatenate([chosen, rarest])
    text_of = np.concatenate([text_of, few[size[few] >= WIDTH]])
    words = data[chosen[:, None] + np.arange(WIDTH)].view(np.uint64) if len(chosen) else np.zeros((0, 8), np.uint64)
    found = np.zeros(len(chosen), np.uint64)
    for i in range(WIDTH // 8):
        found = mixed(found * np.uint64(0x9E3779B97F4A7C15) + words[:, i])
    found = np.concatenate([found, own])
    text_of = np.concatenate([text_of, few[size[few] < WIDTH]])
    chosen = np.concatenate([chosen, np.zeros(len(own), np.int64)])
    order = np.lexsort((chosen, text_of))
    return text_of[order], found[order]


def digest(texts: list[bytes], rank: np.ndarray) -> list[Digest]:
    """The digests of the texts; an empty text has no filter."""
    text_of, found = features(texts, rank)
    # a feature counts once for each text, at its first place
    order = np.lexsort((found, text_of))
    first = np.ones(len(order), bool)
    first[1:] = (found[order][1:] != found[order][:-1]) | (text_of[order][1:] != text_of[order][:-1])
    keep = np.sort(order[first])
    text_of, found = text_of[keep], found[keep]
    count = np.bincount(text_of, minlength=len(texts))
    starts = np.cumsum(count) - count
    place = np.arange(len(found)) - starts[text_of]
    chain = -(-count // CAPACITY)
    offset = np.cumsum(chain) - chain
    row = offset[text_of] + place // CAPACITY
    bits = np.zeros((int(chain.sum()), FILTER_BITS), np.uint8)
    for i in range(PLACES):
        bits[row, (found >> np.uint64(11 * i) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    filters = np.packbits(bits, axis=1) if len(bits) else np.zeros((0, FILTER_BITS // 8), np.uint8)
    sizes = np.bincount(row, minlength=len(filters))
    return [Digest(filters[a : a + n], sizes[a : a + n]) for a, n in zip(offset.tolist(), chain.tolist(), strict=True)]


def likeness(a: Digest, b: Digest) -> float:
    """0 (as chance would have it) to 1 (one holds the other); equal digests give 1."""
    if len(a.filters) > len(b.filters):
        a, b = b, a
    if not len(b.filters):
        return 1.0
    if not len(a.filters):
        return 0.0
    x, y = a.filters.view(np.uint64), b.filters.view(np.uint64)
    if x.shape == y.shape and (x == y).all():
        return 1.0
    own, other = np.bitwise_count(x).sum(1, np.int64), np.bitwise_count(y).sum(1, np.int64)
    best = np.zeros(len(x))
    for i in range(len(x)):
        common = np.bitwise_count(x[i] & y).sum(1, np.int64)
        chance, most = own[i] * other / FILTER_BITS, np.minimum(own[i], other)
        floor = chance + MARGIN * (most - chance)
        best[i] = max(0.0, float(np.max((common - floor) / np.maximum(most - floor, 1e-9))))
    return float(np.minimum(best, 1.0) @ a.sizes / a.sizes.sum())


def neighbours(docs: DataFrame, key: str, text: str, size: int = BUCKET_BYTES) -> DataFrame:
    """``(bucket, tail, ord, row, key, text)``: rows in descending order of key, cut into buckets.

    A bucket holds some ``size`` bytes and ends with a copy (``tail``) of the row that
    follows; the very last row is followed by the first. Texts move once. On the driver:
    one cut and one first row for each bucket. Equal keys go by the hash of the text; a null
    key comes last.
    """
    order = F.coalesce(F.bitwise_not(F.col(key).cast("bigint")), F.lit(2**63 - 1))
    plain = docs.select(
        order.alias("ord"), F.xxhash64(text).alias("row"), F.col(key).alias("key"), F.col(text).alias("text")
    )
    total = plain.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = total // size + 1
    at = [i / n for i in range(1, n)]
    cuts = plain.agg(F.percentile_approx("ord", at, 100 * n).alias("c")).first()["c"] if at else []
    shared = docs.sparkSession.sparkContext.broadcast(np.unique(np.array(cuts or [], np.int64)))

    @F.pandas_udf("bigint")
    def bucket(order):
        import pandas as pd

        return pd.Series(np.searchsorted(shared.value, order.to_numpy(), "right"))

    placed = plain.withColumn("bucket", bucket("ord") if cuts else F.lit(0).cast("bigint"))
    heads = (
        placed.groupBy("bucket").agg(F.min(F.struct("ord", "row")).alias("head")).orderBy("bucket").collect()
    )
    ends = [(h["head"]["ord"], h["head"]["row"], heads[i - 1]["bucket"]) for i, h in enumerate(heads)]
    follows = docs.sparkSession.createDataFrame(ends, "ord bigint, row bigint, ends bigint")
    own = F.struct("bucket", F.lit(False).alias("tail"))
    copies = F.when(F.col("ends").isNull(), F.array(own)).otherwise(
        F.array(own, F.struct(F.col("ends").alias("bucket"), F.lit(True).alias("tail")))
    )
    return (
        placed.join(F.broadcast(follows), ["ord", "row"], "left")
        .withColumn("to", F.explode(copies))
        .select("to.bucket", "to.tail", "ord", "row", "key", "text")
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "tail", "ord", "row")
    )


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the beginning of the next text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


FIELDS = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(key: str, rank):
    names = [key, *(x.split()[0] for x in FIELDS.split(", "))]

    def out(rows, kept):
        texts = [r[3] for r in rows]
        own = ([kept] if kept else []) + digest([t.encode() for t in texts[1 if kept else 0 :]], rank.value)
        pairs = [i for i in range(len(rows) - 1) if not rows[i][1]]
        changed = [edited(texts[i], texts[i + 1]) for i in pairs]
        theirs = digest([t.encode() for t in changed], rank.value)
        columns = [
            [rows[i][2] for i in pairs],
            [len(texts[i]) for i in pairs],
            [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            [str(own[i]) for i in pairs],
            [str(x) for x in theirs],
            [likeness(own[i], x) for i, x in zip(pairs, theirs, strict=True)],
            [likeness(own[i], own[i + 1]) for i in pairs],
        ]
        return columns, own[-1]

    def compare(batches):
        held, size, kept = [], 0, None
        kinds = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            kinds[0] = batch.column("key").type
            for row in zip(*(batch.column(x).to_pylist() for x in ("bucket", "tail", "key", "text")), strict=True):
                held.append((*row[:3], row[3] or ""))
                size += len(held[-1][3])
                if size > CHUNK and len(held) > 1:
                    columns, kept = out(held, kept)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)
                    held, size = held[-1:], 0
        if len(held) > 1:
            columns, _ = out(held, kept)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return compare


def edit_sensitivity(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of each text and of its edited text, and how alike they and the next text's are.

    The next text is that of the next smaller key; the last row's is the first row's. A
    null text is empty; an empty text has an empty digest, which is like (1) another empty one and
    unlike (0) all others. Equal texts have equal digests; equal rows get a row each, with
    the order among them open. Other columns aren't read; an empty table gives none.
    """
    rank = docs.sparkSession.sparkContext.broadcast(rarity(step_counts(docs, text)))
    fields = T.StructType([T.StructField(key, docs.schema[key].dataType), *T.StructType.fromDDL(FIELDS)])
    return neighbours(docs, key, text).mapInArrow(_compared(key, rank), fields)
