"""Quality rules from suffix arrays: how much of a text repeats within the text itself.

The words of a text are the symbols. Prefix doubling sorts the suffixes of all texts of a
batch at once (equal words of different texts are different symbols, so nothing matches
across texts); a suffix leaves the sort as soon as it is alone in its class. Longest
common prefixes of neighbours in the suffix array give, at each word, the longest repeat
that starts there. Repeats of ``window`` words or more that can't be extended to the left
are the maximal ones; the union of their spans is the covered part.

Every text is judged alone, so nothing is shuffled.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from .words import chunks, owners, sums, utf8, word_numbers

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rules:
    """Fewest words; words of a repeat; limits on the covered percentage and the longest repeat."""

    min_words: int = 20
    window: int = 8
    max_covered: int = 30
    max_longest: int = 200


def sort_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and for each k the classes of the windows of 2^k symbols.

    A class is named by the place of its first member in the sorted order. Symbols must be
    such that no two suffixes agree up to the end of the array.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int32)
    levels, length = [], 0
    key, previous = symbols[order], np.zeros(n, np.int64)
    while True:
        fresh = np.ones(len(order), bool)
        fresh[1:] = key[1:] != key[:-1]
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
        if length:
            rank = rank.copy()
            opens = np.ones(len(order), bool)
            opens[1:] = previous[1:] != previous[:-1]
            base = np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))
            rank[order] = previous + first - base
        else:
            rank[order] = first
        levels.append(rank)
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        order = order[~alone]
        if not len(order):
            break
        length = 2 * length or 1
        ahead = order + length
        tail = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1).astype(np.int64)
        key = rank[order] * np.int64(n + 1) + tail + 1
        by = np.argsort(key, kind="stable")
        order, key = order[by], key[by]
        previous = rank[order].astype(np.int64)
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes, levels


def longest_repeats(symbols: np.ndarray, window: int) -> np.ndarray:
    """For each place the length of the longest repeat that starts there, 0 if below ``window``."""
    n, longest = len(symbols), np.zeros(len(symbols), np.int64)
    if n < 2:
        return longest
    suffixes, levels = sort_suffixes(symbols)
    least = min(window.bit_length() - 1, len(levels) - 1)
    left, right = suffixes[:-1], suffixes[1:]
    same = levels[least][left] == levels[least][right]
    left, right = left[same], right[same]
    common = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        inside = np.maximum(a, b) < n
        level = levels[k]
        equal = inside & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])
        common[equal] += 1 << k
    enough = common >= window
    for place in (left[enough], right[enough]):
        np.maximum.at(longest, place, common[enough])
    return longest


def measure(column: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    """The figures of each text."""
    texts = utf8(column)
    ids, bounds, words = word_numbers(texts)
    text_of = owners(bounds)
    n = len(ids)
    longest = longest_repeats(text_of * np.int64(len(words) + 1) + ids, rules.window)
    starts = np.flatnonzero(longest)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + longest[starts], -1)
    covered = sums(np.cumsum(edge[:n]) > 0, bounds)
    extended = np.zeros(n, bool)
    extended[1:] = (longest[:-1] == longest[1:] + 1) & (text_of[:-1] == text_of[1:])
    maximal = sums((longest > 0) & ~extended, bounds)
    most = np.zeros(len(texts), np.int64)
    np.maximum.at(most, text_of[starts], longest[starts])
    size = np.asarray(pc.fill_null(pc.utf8_length(column), 0), dtype=np.int64)
    count = np.diff(bounds)
    space = np.array([len(t) - len(t.translate(None, SPACES)) for t in texts], np.int64)
    symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    failed = (count < rules.min_words) | (100 * covered > rules.max_covered * count)
    return {
        "n_words": count,
        "word_chars": size - space,
        "n_symbols": symbols,
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": covered,
        "base_failed": failed,
        "kept": ~failed & (most <= rules.max_longest),
        "longest_repeat": most,
        "n_maximal": maximal,
    }


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``key`` and the figures of each row's text, with the verdict ``kept``.

    ``n_maximal`` counts places where a maximal repeat starts. A null or empty text has no
    words and fails; equal rows get equal figures; other columns aren't read; an empty
    table gives none. Rows keep their key, null or not.
    """

    def figures(batches):
        for batch in chunks(batches, text):
            found = measure(batch.column(text), rules)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *map(pa.array, found.values())], [key, *found]
            )

    flags = ("base_failed", "kept")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "kept", "longest_repeat", "n_maximal"]
    fields = [T.StructField(x, T.BooleanType() if x in flags else T.LongType()) for x in names]
    return docs.select(key, text).mapInArrow(figures, T.StructType([docs.schema[key], *fields]))


def keep_good(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows whose text the rules keep, with all their columns."""

    def good(batches):
        for batch in chunks(batches, text):
            yield batch.filter(pa.array(measure(batch.column(text), rules)["kept"]))

    return docs.mapInArrow(good, docs.schema)
