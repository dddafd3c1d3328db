"""Token sequences filled by best-fit decreasing.

A document is the ids of its text and an end. What is longer than a sequence is cut into
pieces. Best-fit decreasing takes the pieces by falling length; each goes to the open
sequence with the least room that is enough for it, and to a new one if there is none. A
segment tree over the rooms finds it in logarithmic time.

Which sequence is tightest depends on rooms only, and pieces of one length are alike, so
they are placed together: as long as the tightest room is the same, each sequence of that
room takes as many of them as fit, one sequence after the other, which is what they would
do one by one. The tree works on the count of each length, whatever the number of
documents. With L tokens a sequence there are at most L lengths; a length opens or splits
at most three groups of equal sequences, and a group is touched once for each different
length in a sequence, of which there are at most sqrt(2 L). The steps are broadcast: some
400,000 at most for L = 2048.

Every piece then finds its step by its rank among the pieces of its length, a prefix sum
over the counts of the tasks that cut them.
"""

import os
import re
import struct
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..operators.lookup import fits_broadcast
from ..sources.scratch import materialise
from .words import chunks, utf8

SIZE = 2048
#: Bytes of text that are encoded together.
CHUNK = 1 << 20
#: Distinct runs of characters whose ids a worker remembers, in each of two generations.
REMEMBERED = 150_000
INTS = 4
#: Basic and Latin-1 letters, and the marks of ASCII.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªºµ")
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
PLAIN = re.compile(f"([{LETTERS}]+)([{re.escape(MARKS)}]*)")


class Rooms:
    """Open sequences by their room; a segment tree tells which rooms there are."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.open = [False] * (2 * self.width)
        self.groups: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _mark(self, room: int, is_open: bool) -> None:
        node = self.width + room
        self.open[node] = is_open
        while node > 1:
            node >>= 1
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def add(self, room: int, first: int, count: int) -> None:
        """``count`` sequences from number ``first`` on have this room."""
        if count and room:
            self.groups[room].append((first, count))
            self._mark(room, True)

    def take(self, room: int) -> tuple[int, int]:
        group = self.groups[room].pop()
        if not self.groups[room]:
            self._mark(room, False)
        return group

    def tightest(self, length: int) -> int | None:
        """The least room of an open sequence that holds ``length``."""
        node = self.width + length
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.width


@dataclass
class Steps:
    """Pieces by falling length: from place ``first`` on, ``per`` go into each sequence from ``sequence`` on."""

    size: int
    first: list[int] = field(default_factory=list)
    per: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    room: list[int] = field(default_factory=list)
    #: Number of pieces that are longer, for each length.
    longer: dict[int, int] = field(default_factory=dict)
    sequences: int = 0

    def arrays(self) -> tuple[np.ndarray, ...]:
        longer = np.zeros(self.size + 1, np.int64)
        for length, n in self.longer.items():
            longer[length] = n
        return longer, *(np.array(x, np.int64) for x in (self.first, self.per, self.sequence, self.room))


def best_fit(counts: dict[int, int], size: int = SIZE) -> Steps:
    """Best-fit decreasing on the number of pieces of each length (1 to ``size``)."""
    steps, rooms, place = Steps(size), Rooms(size), 0
    for length in sorted(counts, reverse=True):
        steps.longer[length] = place
        left = counts[length]
        while left:
            room = rooms.tightest(length)
            per = (size if room is None else room) // length
            wanted = -(-left // per)
            if room is None:
                room, first, found = size, steps.sequences, wanted
                steps.sequences += wanted
            else:
                first, found = rooms.take(room)
            used = min(found, wanted)
            placed = min(left, used * per)
            for column, value in zip(
                (steps.first, steps.per, steps.sequence, steps.room), (place, per, first, room), strict=True
            ):
                column.append(value)
            full, rest = divmod(placed, per)
            rooms.add(room, first + used, found - used)
            rooms.add(room - per * length, first, full)
            if rest:
                rooms.add(room - rest * length, first + full, 1)
            place += placed
            left -= placed
    return steps


def place(longer, first, per, sequence, room, size, length, rank) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of the pieces with these lengths and ranks."""
    at = longer[length] + rank
    step = np.searchsorted(first, at, side="right") - 1
    nth = at - first[step]
    return sequence[step] + nth // per[step], size - room[step] + nth % per[step] * length


def _bytes(ids: list[int]) -> bytes:
    """Little-endian, 32 bits each; for a few ids quicker than an array of numpy's."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Ids:
    """Ids, as bytes, of runs of characters without ASCII white space.

    No rule of the tokenizer looks beyond such a run. The library encodes each distinct one;
    those not met again for long are forgotten. Most are letters and punctuation after them.
    If the rules take each letter for itself and part letters from punctuation, which is
    tried out first, such a run is cut here, and only new pieces go to the library's model.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.rules = Tokenizer.from_str(tokenizer)
        self.rules.no_padding()
        self.rules.no_truncation()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        names = sorted((x.content for x in self.rules.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names)) or "(?!)")
        self.letters = self._letters()

    def _cut(self, text: str) -> list[str]:
        """The pieces that normaliser and splitter make of a text."""
        if self.rules.normalizer:
            text = self.rules.normalizer.normalize_str(text)
        return [x for x, _ in self.rules.pre_tokenizer.pre_tokenize_str(text)] if self.rules.pre_tokenizer else [text]

    def _letters(self) -> dict[int, str] | None:
        """What the rules make of each letter; nothing if a word is more than its letters."""
        each = {ord(x): self._cut(x) for x in LETTERS}
        if any(len(x) != 1 for x in each.values()):
            return None
        found = {c: x[0] for c, x in each.items()}
        return found if self._cut(LETTERS + MARKS) == [LETTERS.translate(found), MARKS] else None

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.pieces[piece] = _bytes([x.id for x in self.rules.model.tokenize(piece)])
        return ids

    def learn(self, runs: set[bytes]) -> None:
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        young, old, others = self.young, self.old, []
        # asked one by one: a difference with the keys would walk over all that is remembered
        for run in [x for x in runs if x not in young]:
            ids = old.get(run)
            if ids is not None:
                young[run] = ids
                continue
            text = run.decode()
            plain = PLAIN.fullmatch(text) if self.letters else None
            if plain and not self.special.search(text):
                word, marks = plain.groups()
                ids = self._piece(word.translate(self.letters))
                young[run] = ids + self._piece(marks) if marks else ids
            else:
                others.append((run, text))
        found = self.rules.encode_batch_fast([text for _, text in others], add_special_tokens=False)
        for (run, _), encoding in zip(others, found, strict=True):
            young[run] = _bytes(encoding.ids)

    def of(self, texts: list[bytes]) -> list[bytes]:
        runs = [t.split() for t in texts]
        self.learn(set(chain.from_iterable(runs)))
        return [b"".join(map(self.young.__getitem__, x)) for x in runs]


@lru_cache(maxsize=1)
def _ids(tokenizer: str) -> Ids:
    return Ids(tokenizer)


def _numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How many pieces of the same length came before each; ``seen`` is carried on."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    opens = np.flatnonzero(np.diff(ordered, prepend=-1))
    size = np.diff(np.append(opens, len(ordered)))
    nth = np.empty(len(lengths), np.int64)
    nth[order] = np.arange(len(ordered)) - np.repeat(opens, size) + seen[ordered]
    seen[ordered[opens]] += size
    return nth


def cut_pieces(
    docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, piece, start, length, ids, part, nth)``: the ids of each document, cut.

    ``nth`` counts the pieces of one length in the task ``part``. Store the table before use.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    mark, step = np.array([end], "<u4").tobytes(), INTS * size

    def cut(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, seen, part = _ids(shared.value), np.zeros(size + 1, np.int64), TaskContext.get().partitionId()
        for batch in chunks(batches, text, CHUNK):
            ids = [x + mark for x in encoder.of(utf8(batch.column(text)))]
            number = [-(-len(x) // step) for x in ids]
            row = np.repeat(np.arange(len(ids)), number)
            piece = np.concatenate([np.arange(n) for n in number])
            parts = [x[i : i + step] for x in ids for i in range(0, len(x), step)]
            lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // INTS
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(piece.astype(np.int64) * size),
                    pa.array(lengths),
                    pa.array(parts, pa.binary()),
                    pa.array(np.full(len(parts), part, np.int64)),
                    pa.array(_numbered(lengths, seen)),
                ],
                [key, "piece", "start", "length", "ids", "part", "nth"],
            )

    fields = "piece int, start long, length long, ids binary, part long, nth long"
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL(fields).fields])
    return docs.select(key, text).mapInArrow(cut, schema)


def pack(
    docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, piece, start, length, ids, sequence_id, offset)``, one row for each piece.

    ``tokenizer`` is the text of a tokenizer file; its truncation, padding and added start or
    end tokens aren't applied, ``end`` follows the ids of each document. ``ids`` are
    little-endian unsigned 32-bit integers. A null or empty text is the end alone; equal
    texts and repeated rows are packed one by one; a null key stays null; other columns
    aren't read; an empty table gives none. Sequences are numbered from 0 on, and the pieces
    of each leave no gap.
    """
    spark = docs.sparkSession
    pieces = materialise(cut_pieces(docs, tokenizer, size, end, key, text), "pieces")
    counts = materialise(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # at most one row for each length
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    steps = spark.sparkContext.broadcast(best_fit({r["length"]: r["n"] for r in lengths}, size).arrays())

    @F.arrow_udf("sequence_id long, offset long")
    def placed(length: pa.Array, rank: pa.Array) -> pa.Array:
        found = place(*steps.value, size, np.asarray(length), np.asarray(rank))
        return pa.StructArray.from_arrays([pa.array(x) for x in found], ["sequence_id", "offset"])

    # a row for each task and length: where it is too large to broadcast, the pieces are shuffled
    right = F.broadcast(before) if fits_broadcast(before) else before
    ranked = pieces.join(right, ["part", "length"])
    at = placed("length", F.col("nth") + F.col("before"))
    return ranked.select(key, "piece", "start", "length", "ids", at.alias("at")).select(
        key, "piece", "start", "length", "ids", "at.sequence_id", "at.offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the pieces of each sequence joined, at most ``size`` of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    ids = F.aggregate("parts", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"]))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", length.alias("length"), ids.alias("ids")
    )
