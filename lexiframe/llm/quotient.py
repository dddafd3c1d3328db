"""Counting quotient filters that keep every key in full.

A key is one or two 64-bit numbers. An invertible permutation spreads the keys evenly. Of a
permuted key the first bits choose the shard, the next ones are the quotient, and all the
others the remainder, so counts are exact and the keys can be read back.

A filter keeps its keys in order: for each quotient a run of remainders, the runs' lengths
as set bits that a clear bit ends, and a count of one byte for each key, with larger ones
apart. Filters of a shard are merged by their order.
"""

import struct
from dataclasses import dataclass

import numpy as np

from .words import mixed

#: Factors and shifts of ``words.mixed``, undone in reverse.
FACTORS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
INVERSE = tuple(np.uint64(pow(x, -1, 1 << 64)) for x in FACTORS)
#: Added before each round of the permutation of two numbers.
ROUNDS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
HEAD = struct.Struct("<BBBQQ")
LARGE = 255


def unmixed(x: np.ndarray) -> np.ndarray:
    """The number that ``words.mixed`` turns into ``x``."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * INVERSE[1]
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * INVERSE[0]
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def permuted(columns: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Keys of one or two numbers, spread; four Feistel rounds for two."""
    if len(columns) == 1:
        return (mixed(columns[0]),)
    x, y = columns
    x = x ^ mixed(y + ROUNDS[0])
    y = y ^ mixed(x + ROUNDS[1])
    x = x ^ mixed(y + ROUNDS[2])
    return x, y ^ mixed(x + ROUNDS[3])


def restored(columns: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The keys that :func:`permuted` spread."""
    if len(columns) == 1:
        return (unmixed(columns[0]),)
    x, y = columns
    y = y ^ mixed(x + ROUNDS[3])
    x = x ^ mixed(y + ROUNDS[2])
    y = y ^ mixed(x + ROUNDS[1])
    return x ^ mixed(y + ROUNDS[0]), y


@dataclass(frozen=True)
class Counts:
    """Permuted keys in order, each once, with their counts."""

    columns: tuple[np.ndarray, ...]
    n: np.ndarray

    @staticmethod
    def of(columns: tuple[np.ndarray, ...], n: np.ndarray | None = None) -> "Counts":
        """Add up the counts of equal keys; a key alone counts 1. Runs that are in order are merged."""
        if not len(columns[0]):
            return Counts(columns, np.zeros(0, np.int64))
        order = np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])
        columns = tuple(c[order] for c in columns)
        fresh = np.ones(len(order), bool)
        fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        first = np.flatnonzero(fresh)
        total = np.diff(np.append(first, len(order))) if n is None else np.add.reduceat(n[order], first)
        return Counts(tuple(c[first] for c in columns), total.astype(np.int64))

    @staticmethod
    def merged(parts: list["Counts"]) -> "Counts":
        if len(parts) == 1:
            return parts[0]
        columns = tuple(map(np.concatenate, zip(*(p.columns for p in parts), strict=True)))
        return Counts.of(columns, np.concatenate([p.n for p in parts]))

    def __len__(self) -> int:
        return len(self.n)

    def slice(self, start: int, stop: int) -> "Counts":
        return Counts(tuple(c[start:stop] for c in self.columns), self.n[start:stop])

    def shards(self, bits: int):
        """``(shard, counts)`` for each shard that has keys; the first ``bits`` bits choose it."""
        if not bits:
            yield 0, self
            return
        shard = (self.columns[0] >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        for start, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), len(shard)], strict=True):
            yield int(shard[start]), self.slice(start, stop)


def _bytes(values: np.ndarray, width: int) -> np.ndarray:
    """The last ``width`` bytes of each number, a row each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _numbers(rows: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view("<u8").reshape(-1).astype(np.uint64)


def pack(counts: Counts, bits: int) -> bytes:
    """The filter of one shard. There is about a quotient for each key, and remainders fill bytes."""
    n, rest = len(counts), 64 - bits
    quotient_bits = rest % 8
    while 1 << (quotient_bits + 8) <= n:
        quotient_bits += 8
    width = (rest - quotient_bits) // 8
    key = counts.columns[0] << np.uint64(bits) >> np.uint64(bits) if bits else counts.columns[0]
    quotient = (key >> np.uint64(8 * width)).astype(np.int64) if width < 8 else np.zeros(n, np.int64)
    runs = np.zeros(n + (1 << quotient_bits), np.uint8)
    runs[quotient + np.arange(n)] = 1
    large = counts.n >= LARGE
    return b"".join(
        [
            HEAD.pack(len(counts.columns), quotient_bits, width, n, int(large.sum())),
            np.packbits(runs).tobytes(),
            _bytes(key, width).tobytes(),
            *(c.astype("<u8").tobytes() for c in counts.columns[1:]),
            np.minimum(counts.n, LARGE).astype(np.uint8).tobytes(),
            counts.n[large].astype("<i8").tobytes(),
        ]
    )


def unpack(packed: bytes, shard: int, bits: int) -> Counts:
    """What :func:`pack` was given."""
    parts, quotient_bits, width, n, large = HEAD.unpack_from(packed)
    at = HEAD.size

    def read(kind, count):
        nonlocal at
        found = np.frombuffer(packed, kind, count, at)
        at += found.nbytes
        return found

    length = n + (1 << quotient_bits)
    runs = np.unpackbits(read(np.uint8, (length + 7) // 8), count=length)
    quotient = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
    key = _numbers(read(np.uint8, n * width).reshape(n, width))
    if width < 8:
        key |= quotient << np.uint64(8 * width)
    if bits:
        key |= np.uint64(shard) << np.uint64(64 - bits)
    others = [read("<u8", n).astype(np.uint64) for _ in range(parts - 1)]
    count = read(np.uint8, n).astype(np.int64)
    count[count == LARGE] = read("<i8", large)
    return Counts((key, *others), count)
