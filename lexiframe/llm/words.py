"""Words, hashes and batches shared by the operators of this package.

A word is ``[^\\x20\\x09-\\x0D]+``. ``bytes.split()`` cuts at exactly these six bytes.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 4 << 20


class Interner(dict):
    """Numbers keys in the order in which they first appear."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def chunks(batches, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of a piece is at most ``limit`` bytes, or one row."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        start, total = 0, 0
        for i, n in enumerate(size.tolist()):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if batch.num_rows > start:
            yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Interner]:
    """Numbers of all words, the bounds of each text in them, and the words."""
    lists = [t.split() for t in texts]
    bounds = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)), out=bounds[1:])
    words = Interner()
    flat = map(words.__getitem__, chain.from_iterable(lists))
    return np.fromiter(flat, np.int64, int(bounds[-1])), bounds, words


def hashes(words) -> np.ndarray:
    """64-bit hashes that are the same in every task."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each word the index of its text."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum per text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def shingle_hashes(word_hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of all runs of ``k`` words per text, and the bounds of each text in them.

    A shorter text with words has one shingle: its whole sequence.
    """
    n = len(word_hashes)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    valid = np.arange(n) + k <= ends
    acc = np.zeros(n, np.uint64)
    for t in range(k):
        acc = mixed(acc) + np.concatenate([word_hashes[t:], np.zeros(min(t, n), np.uint64)])
    found, text_of = acc[valid], owners(bounds)[valid]
    short = np.flatnonzero((np.diff(bounds) < k) & (np.diff(bounds) > 0))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        size = np.diff(bounds)[short]
        for t in range(k - 1):
            has = size > t
            whole[has] = mixed(whole[has]) + word_hashes[bounds[short[has]] + t]
        found = np.concatenate([found, mixed(whole + size.astype(np.uint64))])
        text_of = np.concatenate([text_of, short])
    order = np.lexsort((found, text_of))
    found, text_of = found[order], text_of[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (text_of[1:] != text_of[:-1])
    found, text_of = found[fresh], text_of[fresh]
    limits = np.zeros(len(bounds), np.int64)
    np.cumsum(np.bincount(text_of, minlength=len(bounds) - 1), out=limits[1:])
    return found, limits


def runs(batches, key: str) -> Iterator[pa.Table]:
    """Consecutive rows of one key, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = keys[start]
    if held:
        yield pa.Table.from_batches(held)
