"""Packing against a best-fit decreasing that places one piece at a time."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_operators import ROWS, documents, tokenizer
from tokenizers import Tokenizer

from lexiframe.llm import packing, queries

SF = "/root/testdata/sf0.001"


def one_by_one(lengths, size):
    """How often each filling occurs; which of two equally tight sequences is taken doesn't matter to it."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= x]
        if fits:
            i = min(fits, key=rooms.__getitem__)
        else:
            i = len(rooms)
            rooms.append(size)
        rooms[i] -= x
    return Counter(size - room for room in rooms)


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_is_that_of_single_pieces(seed):
    rnd = random.Random(seed)
    size = rnd.choice([1, 7, 64, 100, 128])
    lengths = [rnd.randint(1, rnd.choice([size, max(1, size // 3)])) for _ in range(rnd.choice([1, 50, 700]))]
    lengths += [rnd.randint(1, size)] * rnd.choice([0, 300])
    counts = Counter(lengths)
    steps = packing.best_fit(counts, size)
    inside, spans = {}, {}
    for length, n in counts.items():
        for rank in range(n):
            (sequence,), (offset,) = packing.place(*steps.arrays(), size, *(packing.np.array([x]) for x in (length, rank)))
            inside.setdefault(sequence, []).append(length)
            spans.setdefault(sequence, []).append((offset, offset + length))
    assert Counter(map(sum, inside.values())) == one_by_one(lengths, size)
    assert sorted(inside) == list(range(steps.sequences))
    for x in spans.values():
        x.sort()
        assert x[0][0] == 0 and x[-1][1] <= size and all(a[1] == b[0] for a, b in zip(x, x[1:]))


def test_no_counts_no_steps():
    assert packing.best_fit({}, 8).sequences == 0


def test_many_equal_pieces_take_few_steps():
    steps = packing.best_fit({5: 10**12, 3: 10**11, 1: 7}, 8)
    assert len(steps.first) <= 5 and steps.sequences == 10**12


def expected(rows, size):
    rules = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rules.no_truncation()
    rules.no_padding()
    pieces = Counter()
    for key, text in rows:
        ids = [*rules.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), size)):
            pieces[key, piece, start, tuple(ids[start : start + size])] += 1
    return pieces


@pytest.mark.parametrize("size, parts", [(256, 1), (256, 5), (2048, 3)])
def test_pack(spark, size, parts):
    docs = documents(spark).repartition(parts)
    out = packing.pack(docs, tokenizer(), size).collect()
    ids = [packing.np.frombuffer(r.ids, "<u4") for r in out]
    found = Counter((r.doc_id, r.piece, r.start, tuple(x.tolist())) for r, x in zip(out, ids))
    assert found == expected([(r[0], r[1]) for r in ROWS], size)
    inside = {}
    for r, x in zip(out, ids):
        assert r.length == len(x)
        inside.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert Counter(sum(n for _, n in x) for x in inside.values()) == one_by_one([r.length for r in out], size)
    for x in inside.values():
        x.sort()
        assert [a for a, _ in x] == [sum(n for _, n in x[:i]) for i in range(len(x))]
    assert sorted(inside) == list(range(len(inside)))


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), tokenizer()).collect() == []


def test_shuffled_counts_give_the_same_packing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(4, "doc_id")
    near = Counter(r.length for r in packing.pack(docs, tokenizer()).collect())
    monkeypatch.setattr(packing, "fits_broadcast", lambda df: False)
    far = packing.pack(docs, tokenizer())
    assert Counter(r.length for r in far.collect()) == near
    by_sequence = far.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert by_sequence.where("n <> end or n > 2048").count() == 0


def test_sequences_join_their_pieces(spark):
    packed = packing.pack(documents(spark), tokenizer(), 64)
    rows = packing.sequences(packed).collect()
    assert all(len(r.ids) == 4 * r.length <= 256 for r in rows)
    expected_ids = {}
    for r in sorted(packed.collect(), key=lambda r: (r.sequence_id, r.offset)):
        expected_ids[r.sequence_id] = expected_ids.get(r.sequence_id, b"") + bytes(r.ids)
    assert {r.sequence_id: bytes(r.ids) for r in rows} == expected_ids


def test_forgotten_runs_are_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.Ids(tokenizer())
    texts = [b"one two three four five", b"six seven one", b"eight two two"]
    fresh = [packing.Ids(tokenizer()).of([t])[0] for t in texts]
    assert [encoder.of([t])[0] for t in texts] == fresh == packing.Ids(tokenizer()).of(texts)


def test_query_has_the_crc_of_the_ids(spark):
    import zlib

    rows = queries.QUERIES["op11_best_fit"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    wanted = Counter()
    for (key, piece, start, ids), n in expected([tuple(r) for r in docs], 2048).items():
        wanted[key, piece, start, len(ids), zlib.crc32(packing.np.array(ids, "<u4").tobytes())] += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    assert len({r.sequence_id for r in rows}) == sum(one_by_one([r.length for r in rows], 2048).values())
