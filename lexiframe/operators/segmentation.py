"""Words of text that is written without spaces, by the cheapest path through a lattice.

The dictionary is counted from text that has spaces. A word that makes up the share p of its
occurrences costs -ln p; a character alone that is no such word costs as much as a word that
occurs once. A run of characters is cut so that the sum of costs is least; equal sums go to
fewer words, then to the longer first word. Costs are whole millionths, so sums are exact and
don't depend on the order of steps.

The dictionary is a bounded table (``size`` words of at most ``longest`` characters). Tasks get it
as a prefix trie in arrays. All runs of a batch are looked up and solved together: the trie
is walked from every character at once, and the paths grow from the ends of the runs,
a character of each run at a step. Words leave as ranges of the bytes that came. Places and costs are
held for a piece of a batch, whatever the size of the batch.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import pin_batches
from .terms import term_totals

SIZE = 200_000
LONGEST = 12
SCALE = 1_000_000
#: Runs of Han characters.
HAN = r"\p{IsHan}+"
#: Characters whose paths are found together, about.
BATCH = 1 << 18
#: Bytes of runs whose places are held together, about, unless a run has more.
PIECE = 1 << 20
NONE = np.iinfo(np.int64).max // 4


def dictionary(
    df: DataFrame, words: str = "words", size: int = SIZE, longest: int = LONGEST, least: int = 1
) -> DataFrame:
    """``(word, n)``: the ``size`` most frequent words of arrays, ties in word order.

    Only words of at most ``longest`` characters with at least ``least`` occurrences.
    """
    return (
        term_totals(df, words)
        .where(F.length("word").between(1, longest) & (F.col("n") >= least))
        .select("word", "n")
        .orderBy(F.desc("n"), "word")
        .limit(size)
    )


def word_costs(counts: DataFrame) -> DataFrame:
    """``(word, cost, unknown)``: costs of the words, and of a character that is none."""
    total = F.coalesce(counts.agg(F.sum("n")).scalar(), F.lit(1))
    cost = lambda n: F.round(F.ln(total / n) * SCALE).cast("long")
    return counts.select("word", cost(F.col("n")).alias("cost"), cost(F.lit(1)).alias("unknown"))


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    """Where keys are looked for first, in a table of ``size`` (a power of two) places."""
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - size.bit_length())).astype(np.int64)


@dataclass(frozen=True)
class Trie:
    """A hash table of arcs ``node << 21 | character`` (-1: none), the node each leads to, and the cost of the word that ends there."""

    arcs: np.ndarray
    nodes: np.ndarray
    cost: np.ndarray
    unknown: int
    longest: int

    @staticmethod
    def of(words: list[str], costs: list[int], unknown: int) -> "Trie":
        prefixes: dict[str, int] = {"": 0}
        arcs = []
        for word in words:
            for i, character in enumerate(word):
                if word[: i + 1] not in prefixes:
                    arcs.append((prefixes[word[:i]] << 21 | ord(character), len(prefixes)))
                    prefixes[word[: i + 1]] = len(prefixes)
        cost = np.full(len(prefixes), NONE, np.int64)
        cost[[prefixes[w] for w in words]] = costs
        size = 1 << max(3, (4 * len(arcs)).bit_length())
        keys, nodes = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        first = _slots(np.array([key for key, _ in arcs], np.int64), size).tolist()
        for at, (key, node) in zip(first, arcs, strict=True):
            while keys[at] >= 0:
                at = (at + 1) % size
            keys[at], nodes[at] = key, node
        return Trie(keys, nodes, cost, unknown, max(map(len, words), default=1))

    def follow(self, node: np.ndarray, character: np.ndarray) -> np.ndarray:
        """The node behind the arc of each node with each character, or -1."""
        key = node << 21 | character
        place, out = _slots(key, len(self.arcs)), np.full(len(key), -1, np.int64)
        found = self.arcs[place]
        hit = found == key
        out[hit] = self.nodes[place[hit]]
        at = np.flatnonzero(~hit & (found >= 0))
        while len(at):
            place[at] = (place[at] + 1) % len(self.arcs)
            found = self.arcs[place[at]]
            hit = found == key[at]
            out[at[hit]] = self.nodes[place[at[hit]]]
            at = at[~hit & (found >= 0)]
        return out

    def edges(self, text: np.ndarray, rest: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Places where words of each length begin, and the costs of these; ``rest`` characters are left in the run.

        Every place has one of length 1.
        """
        at, node = np.arange(len(text)), np.zeros(len(text), np.int64)
        alone = np.full(len(text), self.unknown, np.int64)
        places, costs = [at], [alone]
        for length in range(self.longest):
            if length:
                inside = rest[at] > length
                at, node = at[inside], node[inside]
            node = self.follow(node, text[at + length])
            known = node >= 0
            at, node = at[known], node[known]
            cost = self.cost[node]
            word = cost != NONE
            if length:
                places.append(at[word])
                costs.append(cost[word])
            else:
                alone[at[word]] = cost[word]
        return places, costs

    def starts(self, text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Does a word begin at each character of these runs (not empty)?"""
        bounds = np.cumsum(sizes)
        rest = np.repeat(bounds, sizes) - np.arange(len(text))
        places, costs = self.edges(text, rest)
        # the words, by falling distance from the end of their runs, then by place, then by length
        longest = int(sizes.max(initial=0))
        order = np.argsort(rest.astype(np.uint16) if longest < 1 << 16 else rest, kind="stable")
        number = np.zeros(len(text), np.int64)
        ranks = []
        for at in places:
            ranks.append(number[at])
            number[at] += 1
        first = np.zeros(len(text), np.int64)
        first[order] = np.cumsum(number[order]) - number[order]
        total = int(number.sum())
        start, length, cost = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int64)
        for n, (at, rank, given) in enumerate(zip(places, ranks, costs, strict=True), 1):
            to = first[at] + rank
            start[to], length[to], cost[to] = at, n, given
        # a sum of costs and a number of words in one number, if it fits
        bits = longest.bit_length() + 1
        most = max(1, self.unknown, int(np.where(self.cost == NONE, 0, self.cost).max(initial=0)))
        fits = (most * max(1, longest)) << bits < 1 << 62
        cost = (cost if fits else cost.astype(object)) * (1 << bits) + 1
        best = np.zeros(len(text) + 1, cost.dtype)
        ends = start + length
        # the end of a run is the next run's first place; there nothing follows
        last = length == rest[start]
        taken = np.ones(len(text), np.int64)
        steps = np.concatenate([[0], np.cumsum(np.bincount(rest, minlength=longest + 1)[1:])]).tolist()
        begins = np.append(first[order], total)
        for x, y in zip(steps, steps[1:]):
            low, high = begins[x], begins[y]
            at = order[x:y]
            sums = cost[low:high] + np.where(last[low:high], 0, best[ends[low:high]])
            least = np.minimum.reduceat(sums, begins[x:y] - low)
            best[at] = least
            # of equal ones the last stays, which is the longest
            equal = sums == np.repeat(least, number[at])
            taken[start[low:high][equal]] = length[low:high][equal]
        on = np.zeros(len(text), bool)
        now, end = bounds - sizes, bounds
        while len(now):
            on[now] = True
            now = now + taken[now]
            inside = now < end
            now, end = now[inside], end[inside]
        return on

    def cut(self, runs: list[str]) -> list[list[str]]:
        """The words of each run (not empty)."""
        return cut_strings(self, pa.array(runs, pa.string())).to_pylist()


def _cuts(sizes: np.ndarray, limit: int) -> zip:
    """Bounds of neighbours that are about so much together."""
    ends = [*(np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1).tolist(), len(sizes)]
    return zip([0, *ends], ends)


def cut_strings(trie: Trie, runs: pa.Array, is_run: np.ndarray | None = None) -> pa.ListArray:
    """The words of each string; those that are no runs, and empty ones, are one word and none.

    Words are ranges of the strings' own bytes.
    """
    runs = pa.concat_arrays([runs.cast(pa.large_string())])
    offsets = np.frombuffer(runs.buffers()[1], np.int64, len(runs) + 1, 8 * runs.offset)
    data = runs.buffers()[2] or pa.py_buffer(b"")
    is_run = np.ones(len(runs), bool) if is_run is None else is_run
    begins, sizes = [], []
    for start, end in _cuts(np.diff(offsets), PIECE):
        first, last = offsets[start], offsets[end]
        piece = np.frombuffer(data, np.uint8, last - first, first) if last > first else np.zeros(0, np.uint8)
        found, n = _cut_piece(trie, piece, offsets[start : end + 1] - first, is_run[start:end])
        begins.append((found + first).astype(np.int32))
        sizes.append(n)
    words = np.append(np.concatenate(begins), offsets[-1:].astype(np.int32))
    ends = np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)
    found = pa.StringArray.from_buffers(len(words) - 1, pa.py_buffer(words), data)
    return pa.ListArray.from_arrays(pa.array(ends), found)


def _cut_piece(trie: Trie, data: np.ndarray, offsets: np.ndarray, is_run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin in the bytes of these strings, and how many each string has."""
    begins = np.flatnonzero(data & 0xC0 != 0x80)
    text = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.int64)
    bounds = np.searchsorted(begins, offsets)
    sizes = np.diff(bounds)
    on = np.zeros(len(text), bool)
    on[bounds[:-1][sizes > 0]] = True
    chosen = np.flatnonzero(is_run & (sizes > 0))
    part = np.cumsum(sizes[chosen]) // BATCH
    for some in np.split(chosen, np.flatnonzero(np.diff(part)) + 1) if len(chosen) else ():
        n = sizes[some]
        at = np.arange(n.sum()) + np.repeat(bounds[some] - (np.cumsum(n) - n), n)
        on[at] = trie.starts(text[at], n)
    return begins[on], np.diff(np.append(0, np.cumsum(on))[bounds])


def _lists(like: pa.ListArray, bounds: np.ndarray, values: pa.Array) -> pa.ListArray:
    """Lists of values up to the given bounds, null where another list is."""
    sizes = np.concatenate([[0], np.cumsum(np.asarray(like.value_lengths().fill_null(0), np.int64))])
    mask = np.append(np.asarray(like.is_null()), False)
    return pa.ListArray.from_arrays(pa.array(bounds[sizes].astype(np.int32), mask=mask), values)


def _shared_trie(counts: DataFrame):
    pin_batches(counts.sparkSession)
    rows = word_costs(counts).toArrow()
    known, costs, unknown = (rows.column(name).to_pylist() for name in ("word", "cost", "unknown"))
    return counts.sparkSession.sparkContext.broadcast(Trie.of(known, costs, unknown[0] if unknown else 0))


def _once(cut):
    """The function, not run once more for a filter on its result: Spark copies deterministic ones into filters."""
    return cut.asNondeterministic()


def cut_runs(df: DataFrame, runs: str, counts: DataFrame, words: str = "words") -> DataFrame:
    """Add ``words``: the words of each run of an array, cut by :func:`dictionary` counts. No run may be null."""
    trie = _shared_trie(counts)

    @F.arrow_udf("array<array<string>>")
    def cut(lists: pa.Array) -> pa.Array:
        found = cut_strings(trie.value, lists.flatten())
        return _lists(lists, np.arange(len(found) + 1), found)

    return df.withColumn(words, _once(cut)(runs))


def segment_runs(df: DataFrame, text: str, counts: DataFrame, words: str = "words", run: str = HAN) -> DataFrame:
    """Add ``words``: the matches of ``run`` cut by :func:`dictionary` counts, other text at white space.

    ``counts`` has at most as many rows as the dictionary was made for. A null text has null words.
    """
    trie = _shared_trie(counts)

    @F.arrow_udf("array<string>")
    def cut(pieces: pa.Array, is_run: pa.Array) -> pa.Array:
        found = cut_strings(trie.value, pieces.flatten(), np.asarray(is_run.flatten(), bool))
        return _lists(pieces, np.asarray(found.offsets), found.values)

    pieces = F.regexp_extract_all(F.col(text), F.lit(rf"{run}|(?:(?!{run})\S)+"), 0)
    is_run = F.transform(pieces, lambda p: p.rlike(f"^(?:{run})$"))
    return df.withColumn(words, _once(cut)(pieces, is_run))


@F.arrow_udf(T.LongType())
def shared_ends(first: pa.Array, second: pa.Array) -> pa.Array:
    """How many ends of words two cuts (arrays of arrays) of the same runs share, over all runs of a row.

    Both have the same characters in the same order, so an end is a number of characters.
    """
    return pa.concat_arrays([
        _shared(first.slice(start, end - start), second.slice(start, end - start))
        for start, end in _cuts(_strings(first)[1] + _strings(second)[1], PIECE)
    ])


def _strings(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """How many lists each row of lists of strings has, and how many strings."""
    rows = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    strings = np.append(0, np.cumsum(np.asarray(lists.flatten().value_lengths().fill_null(0), np.int64)))
    return rows, np.diff(strings[np.append(0, np.cumsum(rows))])


def _shared(first: pa.ListArray, second: pa.ListArray) -> pa.Array:
    ends = [np.cumsum(np.asarray(pc.utf8_length(x.flatten().flatten()), np.int64)) for x in (first, second)]
    both = np.intersect1d(*ends, assume_unique=True)
    bounds = np.append(0, np.cumsum(_strings(first)[1]))
    return pa.array(np.diff(np.searchsorted(both, np.append(0, ends[0])[bounds], "right")), pa.int64())
