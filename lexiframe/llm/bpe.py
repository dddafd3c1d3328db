"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

Compilation. The automaton starts with one state per base symbol, a start state and every
arc between them. The merges are then applied in order, each as a gadget: for ``a b -> c``

* every state with an arc labelled a gets an arc labelled c,
* the new state c gets the arcs that leave state b,
* the arc labelled b leaves state a no more.

For ``a a -> c`` state a itself gets no arc c (in a a a the first two merge), and c follows
c. A merge whose arc is already gone changes nothing. The result is deterministic and its
paths from the start spell exactly the sequences that the merges produce, so a word has
one path. The arcs are kept as one bit per label and state.

Encoding is one pass over a word's characters, from left to right. A spelling table leads from
each character on to all labels spelled there; a label is an arc to the boundary behind it, and
the automaton tells if its state allows it. The start of a word has exactly one path, so a
boundary is entered at most once and no step is ever taken back. All new words of a batch take
their steps together, as table look-ups. Decoding emits the labels of the arcs.

Words come from the tokenizer file's own normalizer and pre-splitter, run on each distinct
run of characters between ASCII white space: no rule of these files looks beyond that.
"""

import gc
import json
import random
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, compress, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .words import chunks, utf8

#: Distinct runs of characters, and words, whose ids a task remembers: some 200 bytes each.
REMEMBERED = 400_000
#: Longest word that takes its steps together with others.
SHORT = 64
#: Characters whose arcs are looked up together.
BLOCK = 1 << 17
CHUNK = 1 << 20
#: White space and controls other than the space that joins runs.
ODD = re.compile(r"[^\S ]|[\x00-\x1f\x7f-\x9f]")


def compile_arcs(base: list[bool], merges: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """``(arcs, state)`` of the automaton.

    ``base`` tells for each base label whether it ends a word; merge i makes label
    ``len(base) + i``. Bit ``state[p]`` of row t tells if label t may follow label p, and bit 0
    if it may begin a word. A label that ends a word has no state (-1).
    """
    ends = list(base)
    for _, b in merges:
        ends.append(ends[b])
    total = len(ends)
    state = np.full(total, -1, np.int64)
    inner = ~np.array(ends)
    state[inner] = np.arange(1, inner.sum() + 1)
    arcs = np.zeros((total, int(inner.sum()) // 8 + 1), np.uint8)
    first = np.zeros(arcs.shape[1] * 8, bool)
    first[0] = True
    first[state[: len(base)][inner[: len(base)]]] = True
    arcs[: len(base)] = np.packbits(first, bitorder="little")
    for i, (a, b) in enumerate(merges):
        c = len(base) + i
        if ends[a]:
            continue
        byte, bit = int(state[a]) >> 3, np.uint8(1 << (int(state[a]) & 7))
        if not arcs[b, byte] & bit:
            continue
        arcs[c] = arcs[a]
        if a == b:
            arcs[c, byte] &= ~bit
        if not ends[c]:
            at, mark = int(state[c]) >> 3, np.uint8(1 << (int(state[c]) & 7))
            after = (arcs[: c + 1, int(state[b]) >> 3] >> np.uint8(int(state[b]) & 7)) & 1
            arcs[: c + 1, at] |= after * mark
            if a == b:
                arcs[c, at] |= mark
        arcs[b, byte] &= ~bit
    return arcs, state


def spelling_table(labels: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, step, source, ends)``: the labels' spellings as one table of transitions.

    ``codes`` gives a character's code by code point, its last entry stands for all characters
    in no label, and 0 for no character. From place x, code c leads to y = ``step[x]`` + c if
    ``source[y]`` is x, else nowhere. The last place is where all spellings begin; ``ends`` has
    the place where each label ends. Rows of transitions lie over each other, fullest first.
    """
    code = {x: i for i, x in enumerate(sorted(set().union(*labels)), 1)}
    rows: list[dict[int, int]] = [{}]
    ends = []
    for label in labels:
        at = 0
        for x in label:
            at = rows[at].setdefault(code[x], len(rows))
            if at == len(rows):
                rows.append({})
        ends.append(at)
    width = len(code) + 2
    size = 4 * len(rows) + width
    taken, shift, place = bytearray(size), [0] * len(rows), np.full(len(rows), size, np.int32)
    drawn = random.Random(0)
    for x in sorted(range(len(rows)), key=lambda x: -len(rows[x])):
        if rows[x]:
            at = drawn.randrange(size - width)
            while any(taken[at + c] for c in rows[x]):
                at = drawn.randrange(size - width)
            shift[x] = at
            for c, to in rows[x].items():
                taken[at + c] = 1
                place[to] = at + c
    step, source = np.zeros(size + 1, np.int32), np.full(size + 1, -1, np.int32)
    step[place] = shift
    for x, row in enumerate(rows):
        source[place[list(row.values())]] = place[x]
    codes = np.full(max(map(ord, code), default=0) + 2, len(code) + 1, np.int32)
    codes[list(map(ord, code))] = list(code.values())
    return codes, step, source, place[ends]


@dataclass(frozen=True)
class Automaton:
    """What a task needs: the splitter's definition, ids, the arcs and the spelling table."""

    splitter: str
    specials: dict[str, int]
    labels: dict[int, str]
    #: By label: id, state behind it, characters, where its row of arcs begins.
    ids: np.ndarray
    state: np.ndarray
    length: np.ndarray
    row: np.ndarray
    #: Rows of the arc table that differ, joined.
    arcs: np.ndarray
    codes: np.ndarray
    step: np.ndarray
    source: np.ndarray
    #: By place: the label spelled there inside a word and at its end, or -1.
    inner: np.ndarray
    final: np.ndarray

    def coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(code, ends)``: the words' characters, each word followed by a 0 at its end."""
        text = "\0".join(words) + "\0"
        code = self.codes[np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), len(self.codes) - 1)]
        ends = np.cumsum(np.fromiter(map(len, words), np.int32, len(words)) + np.int32(1), dtype=np.int32) - 1
        code[ends] = 0
        return code, ends

    def spelled(self, code: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(start, label)`` of all labels that the characters from ``start`` on spell."""
        place = np.full(len(start), len(self.step) - 1, np.int32)
        starts, labels, k = [], [], 0
        while len(start):
            to = self.step[place] + code[start + k]
            k += 1
            on = self.source[to] == place
            start, place = start[on], to[on]
            label = np.where(code[start + k] == 0, self.final[place], self.inner[place])
            on = label >= 0
            starts.append(start[on])
            labels.append(label[on])
        return np.concatenate(starts), np.concatenate(labels)

    def walk(self, code: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
        """``(came, steps)``: the label of the arc that enters each boundary, or -1, and how many
        arcs were taken: one for each boundary entered."""
        begins = np.append(np.int32(0), ends[:-1] + 1)
        sizes = ends - begins
        start, label = self.spelled(code, np.flatnonzero(code).astype(np.int32))
        rank = (start - np.repeat(begins, sizes + 1)[start]).astype(np.uint8)
        order = np.argsort(rank, kind="stable")
        start, label = start[order], label[order]
        end = start + self.length[label]
        row, after = self.row[label], self.state[label]
        state, came, steps = np.full(len(code), -1, np.int32), np.full(len(code), -1, np.int32), 0
        state[begins] = 0
        for x, y in pairwise(np.searchsorted(rank[order], np.arange(sizes.max(initial=0) + 1)).tolist()):
            at = state[start[x:y]]
            on = (at >= 0) & (self.arcs[row[x:y] + (at >> 3)] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            to = end[x:y][on]
            state[to] = after[x:y][on]
            came[to] = label[x:y][on]
            steps += len(to)
        return came, steps

    def encode(self, words: list[str]) -> Iterator[bytes]:
        """The ids, as bytes, of each of some pre-split words that aren't empty."""
        at = 0
        while at < len(words):
            if len(words[at]) > SHORT:
                yield self.ids[list(self.long_path(words[at]))].tobytes()
                at += 1
                continue
            upto, size = at, 0
            while upto < len(words) and len(words[upto]) <= SHORT and size < BLOCK:
                size += len(words[upto]) + 1
                upto += 1
            code, ends = self.coded(words[at:upto])
            came, _ = self.walk(code, ends)
            if (came[ends] < 0).any():
                word = words[at + int(np.argmax(came[ends] < 0))]
                raise ValueError(f"no path for {word!r}: a base symbol is missing")
            # back along the arcs, to mark the boundaries on the paths
            on, now = np.zeros(len(code), bool), ends
            begin = np.zeros(len(code), bool)
            begin[0], begin[ends[:-1] + 1] = True, True
            while len(now):
                on[now] = True
                now = now - self.length[came[now]]
                now = now[~begin[now]]
            ids = self.ids[came[on]].tobytes()
            for x, y in pairwise([0, *(4 * np.cumsum(on)[ends]).tolist()]):
                yield ids[x:y]
            at = upto

    def long_path(self, word: str) -> list[int]:
        """The labels of one word of any length: the same pass, boundary by boundary."""
        code, _ = self.coded([word])
        n = len(word)
        state, came, arcs = array("i", [-1]) * (n + 1), array("i", [-1]) * (n + 1), memoryview(self.arcs)
        state[0] = 0
        for x in range(0, n, BLOCK):
            start, label = self.spelled(code, np.arange(x, min(n, x + BLOCK), dtype=np.int64))
            order = np.argsort(start, kind="stable")
            start, label = start[order], label[order]
            columns = start, start + self.length[label], label, self.row[label], self.state[label]
            for at, to, arc, row, after in zip(*(c.tolist() for c in columns), strict=True):
                p = state[at]
                if p >= 0 and arcs[row + (p >> 3)] >> (p & 7) & 1:
                    state[to], came[to] = after, arc
        path, at = [], n
        while at:
            if came[at] < 0:
                raise ValueError(f"no path for a word of {n} characters: a base symbol is missing")
            path.append(came[at])
            at -= int(self.length[came[at]])
        return path[::-1]

    def word(self, word: str, memory: dict) -> tuple[int, ...]:
        """The ids of one pre-split word, kept in ``memory``."""
        if word not in memory:
            memory[word] = tuple(np.frombuffer(next(self.encode([word])), "<u4").tolist())
        return memory[word]

    def long_word(self, word: str) -> tuple[int, ...]:
        """The same, boundary by boundary and without memory."""
        return tuple(self.ids[self.long_path(word)].tolist())


@lru_cache(maxsize=2)
def automaton(tokenizer: str) -> Automaton:
    """Compile the text of a tokenizer file (JSON) with a BPE model that marks word ends."""
    given = json.loads(tokenizer)
    model, added = given["model"], given["added_tokens"]
    suffix = model.get("end_of_word_suffix")
    if model["type"] != "BPE" or not suffix or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
        raise ValueError("a BPE model with an end-of-word suffix is needed")
    if any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
        raise ValueError("added tokens are looked for in the plain text only")
    if any(re.search(r"[\t-\r ]", x["content"]) for x in added):
        raise ValueError("added tokens with white space inside are not looked for")
    vocab = model["vocab"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = {a + b for a, b in pairs}
    if len(made) < len(pairs):
        raise ValueError("two merges make the same token")
    names = [x for x in sorted(vocab, key=vocab.get) if x not in made]
    base = [x.endswith(suffix) for x in names]
    number = {x: i for i, x in enumerate(names)}
    merges = []
    for a, b in pairs:
        merges.append((number[a], number[b]))
        number[a + b] = len(names)
        names.append(a + b)
    arcs, state = compile_arcs(base, merges)
    spellings = [x.removesuffix(suffix) for x in names]
    codes, step, source, ends = spelling_table(spellings)
    marked = np.array([x.endswith(suffix) for x in names])
    inner, final = np.full(len(step), -1, np.int32), np.full(len(step), -1, np.int32)
    inner[ends[~marked]], final[ends[marked]] = np.flatnonzero(~marked), np.flatnonzero(marked)
    places: dict[bytes, int] = {}
    row = [places.setdefault(x.tobytes(), len(places) * arcs.shape[1]) for x in arcs]
    splitter = given | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}
    return Automaton(
        splitter=json.dumps(splitter),
        specials={x["content"]: x["id"] for x in added},
        labels={i: x for x, i in vocab.items()} | {x["id"]: x["content"] for x in added},
        ids=np.array([vocab[x] for x in names], "<u4"),
        state=state.astype(np.int32),
        length=np.array([len(x) for x in spellings], np.int32),
        row=np.array(row, np.int64),
        arcs=np.frombuffer(b"".join(places), np.uint8),
        codes=codes,
        step=step,
        source=source,
        inner=inner,
        final=final,
    )


class Encoder(dict):
    """Ids, as bytes, of runs of characters without ASCII white space, once they are learnt."""

    def __init__(self, table: Automaton):
        from tokenizers import Tokenizer

        super().__init__()
        rules = Tokenizer.from_str(table.splitter)
        self.normalizer, self.splitter = rules.normalizer, rules.pre_tokenizer
        self.table = table
        names = sorted(table.specials, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.words: dict[str, bytes] = {}

    def normal(self, text: str) -> str:
        return self.normalizer.normalize_str(text) if self.normalizer else text

    def alone(self, text: str) -> list[str | bytes]:
        """The words of one run, and the ids of added tokens as bytes."""
        found, at = [], 0
        for match in self.special.finditer(text) if self.special else ():
            found += [x for x, _ in self.splitter.pre_tokenize_str(self.normal(text[at : match.start()]))]
            found.append(np.array([self.table.specials[match.group()]], "<u4").tobytes())
            at = match.end()
        return found + [x for x, _ in self.splitter.pre_tokenize_str(self.normal(text[at:]))]

    def together(self, runs: list[bytes]) -> list[list[str]] | None:
        """The words of runs without any other white space, in one call of the splitter; None if
        the rules make or drop white space."""
        text = self.normal(b" ".join(runs).decode())
        parts = text.split(" ")
        if len(parts) != len(runs):
            return None
        words, n, end, found = self.splitter.pre_tokenize_str(text), 0, 0, []
        for part in parts:
            end += len(part)
            at = n
            while n < len(words) and words[n][1][1] <= end:
                n += 1
            found.append([x for x, _ in words[at:n]])
            end += 1
        return found

    def learn(self, runs: set[bytes]) -> None:
        """Encode the runs that are new; all their new words take their steps together."""
        # many lists, none in a cycle: the collector would walk all that is remembered again and again
        collecting = gc.isenabled()
        gc.disable()
        try:
            self._learn(runs)
        finally:
            if collecting:
                gc.enable()

    def _learn(self, runs: set[bytes]) -> None:
        for memory in (self, self.words):
            if len(memory) > REMEMBERED:
                # what came first is mostly what comes often
                for x in list(islice(memory, REMEMBERED // 2, None)):
                    del memory[x]
        runs, odd = [x for x in runs if x not in self], []
        text = b" ".join(runs).decode()
        if ODD.search(text) or self.special and self.special.search(text):
            plain = [not (ODD.search(x) or self.special and self.special.search(x)) for x in text.split(" ")]
            odd = list(compress(runs, [not x for x in plain]))
            runs = list(compress(runs, plain))
        found = self.together(runs) if runs else []
        if found is None:
            found, odd, runs = [], odd + runs, []
        mixed = [self.alone(x.decode()) for x in odd]
        memory = self.words
        new = set(chain.from_iterable(found)).union(x for words in mixed for x in words if type(x) is str)
        new = [x for x in new if x not in memory]
        memory.update(zip(new, self.table.encode(new), strict=True))
        known = memory.__getitem__
        self.update(zip(runs, [b"".join(map(known, words)) for words in found], strict=True))
        for run, words in zip(odd, mixed, strict=True):
            self[run] = b"".join([memory[x] if type(x) is str else x for x in words])


def read_tokenizer(path: str) -> str:
    """The text of a tokenizer file on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _text(ids: bytes, labels: dict[int, str]) -> str:
    return " ".join(map(labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_broadcasts: dict[tuple[str, str], object] = {}


def _shared(spark, tokenizer: str):
    """One broadcast of an automaton for a session, so that workers never hold several."""
    key = (spark.sparkContext.applicationId, tokenizer)
    if key not in _broadcasts:
        _broadcasts[key] = spark.sparkContext.broadcast(automaton(tokenizer))
    return _broadcasts[key]


def encode(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", decoded: bool = False
) -> DataFrame:
    """``(key, n_tokens, ids)``; ids are little-endian unsigned 32-bit integers in a binary.

    ``tokenizer`` is the text of a tokenizer file. Truncation, padding and added start or
    end tokens aren't applied. With ``decoded`` comes what :func:`decode` makes of the ids, in
    the same pass. A null or empty text has no ids; equal texts have equal ids; a row with a
    null key keeps it; other columns aren't read; an empty table gives none.
    """
    _check_decoder(tokenizer)
    shared = _shared(docs.sparkSession, tokenizer)

    def encoded(batches):
        encoder = Encoder(shared.value)
        labels = encoder.table.labels
        for batch in chunks(batches, text, CHUNK):
            runs = [t.split() for t in utf8(batch.column(text))]
            encoder.learn(set(chain.from_iterable(runs)))
            ids = [b"".join([encoder[x] for x in t]) for t in runs]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            columns = [batch.column(key), pa.array(sizes), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([_text(x, labels) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids", "decoded"][: len(columns)])

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    fields += [T.StructField("decoded", T.StringType())] * decoded
    return docs.select(key, text).mapInArrow(encoded, T.StructType([docs.schema[key], *fields]))


def _check_decoder(tokenizer: str) -> None:
    if json.loads(tokenizer).get("decoder"):
        raise ValueError("only tokenizers without a decoder are known here")


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """The same rows with ``decoded``: the labels of the arcs, joined by a space.

    That is what a tokenizer file without a decoder asks for. Null ids decode to the empty
    text. ``encoded`` must not have a column of the new name.
    """
    _check_decoder(tokenizer)
    shared = encoded.sparkSession.sparkContext.broadcast(automaton(tokenizer).labels)

    def emitted(batches):
        for batch in chunks(batches, ids, CHUNK):
            texts = [_text(x or b"", shared.value) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(emitted, T.StructType([*encoded.schema, T.StructField("decoded", T.StringType())]))
