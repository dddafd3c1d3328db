"""Near-duplicates by SuperMinHash signatures, banding, verification and components.

1. Equal word sequences form a class, named by its smallest key; only one member goes on.
2. SuperMinHash: an element draws a permutation of the m slots, one place per round, and
   offers round + fraction to the slot. Later rounds offer larger numbers, so a text is
   done when all its slots hold less than the number of the round.
3. Texts that share a band with its smallest key are candidates; the components of
   these are the candidate clusters.
4. The text of each member goes to its cluster once, where prefix filtering over the exact
   shingle sets finds the links. A pair whose ends are already joined is not compared. A
   cluster with more than ``TILE`` shingles is cut into blocks, and every pair of blocks
   meets in a task of its own.
5. Components of the links, then of the classes.
"""

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import MAX_BROADCAST_BYTES, fits_broadcast, lookup_join
from ..sources.scratch import materialise
from .components import Forest, components
from .words import chunks, hashes, mixed, owners, runs, shingle_hashes, utf8, word_numbers

#: Elements that draw their permutations at once.
BLOCK = 30_000
#: Shingles of a cluster that one task compares.
TILE = 4_000_000


@dataclass(frozen=True)
class Near:
    """Words of a shingle, least similarity in percent, slots of a band, odds to miss a link."""

    words: int = 5
    percent: int = 80
    rows: int = 6
    miss: float = 1e-6

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log1p(-((self.percent / 100) ** self.rows)))

    @property
    def slots(self) -> int:
        return self.bands * self.rows


def _offer(elements: np.ndarray, text_of: np.ndarray, slots: np.ndarray) -> None:
    """Lower the slots of the texts by their elements."""
    m = slots.shape[1]
    places = np.tile(np.arange(m, dtype=np.uint16), (len(elements), 1))
    flat, live = slots.reshape(-1), np.arange(len(elements))
    for j in range(m):
        live = live[(slots.max(axis=1) > j)[text_of[live]]]
        if not len(live):
            return
        draw = mixed(elements[live] + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) & (2**64 - 1)))
        pick = j + (mixed(draw) % np.uint64(m - j)).astype(np.int64)
        place = places[live, pick]
        places[live, pick] = places[live, j]
        np.minimum.at(flat, text_of[live] * m + place, (draw >> np.uint64(11)) * 2.0**-53 + j)


def superminhash(elements: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """Signatures of the texts' sets of 64-bit elements; infinite for an empty set."""
    size = np.diff(bounds)
    slots = np.full((len(size), m), np.inf)
    order = np.argsort(size, kind="stable")
    order = order[size[order] > 0]
    filled = np.cumsum(size[order])
    start = 0
    while start < len(order):
        before = filled[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(filled, before + BLOCK, "right")))
        texts = order[start:stop]
        if len(texts) == 1:
            own = slots[texts]
            for i in range(bounds[texts[0]], bounds[texts[0] + 1], BLOCK):
                part = elements[i : min(i + BLOCK, bounds[texts[0] + 1])]
                _offer(part, np.zeros(len(part), np.int64), own)
        else:
            own = slots[texts]
            part = np.concatenate([elements[bounds[t] : bounds[t + 1]] for t in texts])
            _offer(part, np.repeat(np.arange(len(texts)), size[texts]), own)
        slots[texts] = own
        start = stop
    return slots


def band_keys(slots: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each text and band."""
    bits = slots.view(np.uint64).reshape(len(slots), -1, rows)
    keys = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2])
    for i in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return keys.view(np.int64)


def _signatures(key: str, text: str, near: Near):
    def signed(batches):
        for batch in chunks(batches, text):
            texts = utf8(pc.ascii_lower(batch.column(text)))
            ids, bounds, words = word_numbers(texts)
            found, limits = shingle_hashes(hashes(words)[ids], bounds, near.words)
            bands = band_keys(superminhash(found, limits, near.slots), near.rows)
            content = [xxhash.xxh3_128_digest(b" ".join(t.split())) for t in texts]
            counts = np.diff(limits)
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * near.bands
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array(counts),
                    pa.array(content, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.reshape(-1))),
                ],
                ["key", "n_shingles", "content", "bands"],
            )

    return signed


def _shingle_numbers(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact numbers of the distinct shingles per text, rarest first, and their bounds."""
    ids, bounds, words = word_numbers(texts)
    n, size = len(ids), np.diff(bounds)
    step = np.int64(len(words) + 1)
    # beyond the end of a text stands a symbol of its own
    ends = np.repeat(bounds[1:], size)
    number = np.zeros(n, np.int64)
    for t in range(k):
        at = np.arange(n) + t
        symbol = np.where(at < ends, ids[np.minimum(at, max(n - 1, 0))], len(words))
        _, number = np.unique(number * step + symbol, return_inverse=True)
    whole = (np.arange(n) + k <= ends) | ((np.repeat(size, size) < k) & (np.arange(n) == np.repeat(bounds[:-1], size)))
    text_of = owners(bounds)[whole]
    number = number[whole]
    pair = np.unique(text_of * np.int64(n + 1) + number)
    text_of, number = pair // (n + 1), pair % (n + 1)
    count = np.bincount(number, minlength=n + 1)
    place = np.empty(len(count), np.int64)
    place[np.argsort(count, kind="stable")] = np.arange(len(count))
    number = place[number]
    by = np.lexsort((number, text_of))
    limits = np.zeros(len(size) + 1, np.int64)
    np.cumsum(np.bincount(text_of, minlength=len(size)), out=limits[1:])
    return number[by], limits


def spanning_links(texts: list[bytes], near: Near) -> list[tuple[int, int]]:
    """Links between texts by index, enough to connect all texts that links connect."""
    numbers, limits = _shingle_numbers(texts, near.words)
    size = np.diff(limits).tolist()
    lists = [numbers[a:b].tolist() for a, b in zip(limits[:-1], limits[1:], strict=True)]
    sets = [None] * len(texts)
    forest, index, links = Forest(), defaultdict(list), []
    for x in sorted(range(len(texts)), key=lambda i: (size[i], i)):
        n = size[x]
        if not n:
            continue
        prefix = lists[x][: n - -(-near.percent * n // 100) + 1]
        own = sets[x] = set(lists[x])
        tried: set[int] = set()
        for s in prefix:
            for y in index[s]:
                if y in tried or 100 * size[y] < near.percent * n:
                    continue
                tried.add(y)
                if forest.root(x) == forest.root(y):
                    continue
                common = len(own & sets[y])
                if 100 * common >= near.percent * (n + size[y] - common):
                    forest.join(x, y)
                    links.append((x, y))
            index[s].append(x)
    return links


def _verified(near: Near):
    def linked(batches):
        for tile in runs(batches, "tile"):
            keys = tile.column("key").to_pylist()
            if len(keys) < 2:
                continue
            links = spanning_links(utf8(pc.ascii_lower(tile.column("text").combine_chunks())), near)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i, _ in links], pa.int64()), pa.array([keys[j] for _, j in links], pa.int64())],
                ["a", "b"],
            )

    return linked


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", near: Near = Near()) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for each row.

    ``key`` is a bigint; rows that share one count as one document. Texts are lower-cased
    (A-Z). A text without words, or null, has an empty set and is linked with nothing; a
    row with a null key is linked with nothing, has a null component and is kept. Other
    columns aren't read; an empty table gives none.
    """
    plain = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    schema = "key bigint, n_shingles bigint, content binary, bands array<bigint>"
    signed = materialise(plain.mapInArrow(_signatures("key", "text", near), schema), "signatures")
    classes = (
        signed.where("n_shingles > 0 and key is not null")
        .groupBy("content")
        .agg(F.min(F.struct("key", "n_shingles", "bands")).alias("x"))
        .select("content", "x.*")
    )
    classes = materialise(classes, "classes")
    banded = classes.select("key", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("key").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = banded.join(heads, "band").where("key <> head").select("key", "head").distinct()
    clusters = components(pairs, "clusters")
    members = materialise(
        clusters.select(F.col("node").alias("key"), F.col("low").alias("cluster"))
        .union(clusters.select(F.col("low"), F.col("low")).distinct()),
        "members",
    )
    sizes = (
        members.join(classes.select("key", "n_shingles"), "key")
        .groupBy("cluster")
        .agg(F.sum("n_shingles").alias("size"))
        .select("cluster", F.ceil(F.col("size") / TILE).cast("int").alias("blocks"))
    )
    placed = materialise(members.join(sizes, "cluster"), "placed")
    own = F.pmod(F.xxhash64("key"), F.col("blocks"))
    tiles = (
        lookup_join(plain.where("key is not null"), placed, "key", "inner", max_bytes=MAX_BROADCAST_BYTES)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other")).alias("tile"), "key", "text")
    )
    links = tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(_verified(near), "a bigint, b bigint")
    joined = components(links, "near-links").select(F.col("node").alias("class_key"), F.col("low").alias("component"))
    names = classes.select("content", F.col("key").alias("class_key")).join(joined, "class_key", "left")
    names = names.select("content", F.coalesce("component", "class_key").alias("component_id"))
    result = (
        signed.select("key", "n_shingles", "content")
        .join(names, "content", "left")
        .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("key")))
        .withColumn("component_id", F.when(F.col("key").isNotNull(), F.col("component_id")))
    )
    return result.select(
        F.col("key").alias(key), "n_shingles", "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", near: Near = Near()) -> DataFrame:
    """The rows of one document of each group, with all their columns."""
    kept = near_duplicates(docs, key, text, near)
    gone = materialise(kept.where("not kept").select(F.col(key).alias("_gone")).distinct(), "gone")
    gone = F.broadcast(gone) if fits_broadcast(gone) else gone
    return docs.join(gone, F.col(key) == F.col("_gone"), "left_anti")
