"""Collocations against a plain count of phrases, and the filters on their own."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import documents

from lexiframe.llm import collocations, quotient
from lexiframe.llm.quotient import Counts

DOCS = "text string, lang string, phrase string, a int, hi string"


def plain(rows, least, longest=4, covered=80, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if any(
                len(q) > len(p) and b >= least and 100 * b >= covered * a
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in f.items()
            ):
                continue
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts(seed, n=60):
    rnd = random.Random(seed)
    names = ["a", "B", "cé", "x\x1cy", "日本", "dd", "e-e", "f"]
    rows = [(None, "en"), ("", None), (" \t\n,,;", "en"), ("lone", "xx"), ("A b a b A b", None), ("a b a b", "und")]
    for _ in range(n):
        words = [rnd.choice(names[: rnd.choice([2, 4, 8])]) for _ in range(rnd.randrange(40))]
        seps = [rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\r\n"]) for _ in words]
        rows.append(("".join(w + s for w, s in zip(words, seps)), rnd.choice(["en", "en", "en", "de", None])))
    rows.append(("the end of it " * 50, "de"))
    return rows + rows[10:20]


@pytest.mark.parametrize("seed, least, longest, top", [(1, 5, 4, 2000), (2, 3, 4, 20), (3, 8, 3, 7), (4, 4, 2, 2000), (5, 1, 4, 2000)])
def test_phrases(spark, monkeypatch, seed, least, longest, top):
    rows = texts(seed, 12 if least == 1 else 60)
    # small chunks, tables and shards, and a bitmap that is too small for the pairs
    for name, value in {"CHUNK": 300, "HELD": 40, "SHARD": 100, "BITMAP_BITS": 12, "RANKED": 5}.items():
        monkeypatch.setattr(collocations, name, value)
    docs = spark.createDataFrame([(*r, "p", 1, "h") for r in rows], DOCS).repartition(3)
    out = collocations.phrases(docs, least, longest, top=top)
    assert sorted(map(tuple, out.collect())) == plain(rows, least, longest, top=top)


def test_same_for_any_size_of_chunks(spark):
    rows = texts(6)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    assert sorted(map(tuple, collocations.phrases(docs, 4).collect())) == plain(rows, 4)


def test_edges(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert collocations.phrases(none).collect() == []
    assert collocations.phrases(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).collect() == []
    out = collocations.phrases(documents(spark).withColumnRenamed("source", "lang"), least=30)
    assert all(r.n > 0 and r.a >= 30 for r in out.collect())
    for wrong in (1, 5):
        with pytest.raises(ValueError):
            collocations.phrases(none, longest=wrong)


def test_scores_pass_64_bits(spark):
    values = [(10**17 + 1, 10**17 + 3, 2 * 10**17 + 9), (4 * 10**18, 4 * 10**18, 4 * 10**18 + 1), (30, 31, 97)]
    df = spark.createDataFrame(values, "a long, l long, r long")
    both = F.col("l").cast("decimal(20,0)") + F.col("r")
    out = df.select("a", collocations.cut_score(F.col("a"), both).alias("s")).collect()
    assert {r.a: r.s for r in out} == {a: 2_000_000 * a // (left + right) for a, left, right in values}


@pytest.mark.parametrize("columns", [1, 2])
@pytest.mark.parametrize("bits", [0, 1, 5, 8, 13])
def test_filters_keep_keys_and_counts(columns, bits):
    rnd = np.random.default_rng(bits)
    keys = tuple(rnd.integers(0, 400, 3000).astype(np.uint64) << np.uint64(32) for _ in range(columns))
    spread = quotient.permuted(keys)
    assert all((a == b).all() for a, b in zip(quotient.restored(spread), keys))
    counts = Counts.of(spread, rnd.integers(1, 600, 3000))
    plain_counts = Counter()
    for n, *key in zip(rnd.permutation(3000) * 0 + 1, *keys):
        plain_counts[tuple(map(int, key))] += int(n)
    assert len(counts) == len(plain_counts)
    once = Counts.of(spread)
    assert dict(zip(zip(*(map(int, c) for c in quotient.restored(once.columns))), map(int, once.n))) == plain_counts
    back = [quotient.unpack(quotient.pack(part, bits), shard, bits) for shard, part in counts.shards(bits)]
    assert sum(map(len, back)) == len(counts)
    for i in range(columns):
        assert (np.concatenate([b.columns[i] for b in back]) == counts.columns[i]).all()
    assert (np.concatenate([b.n for b in back]) == counts.n).all()


def test_merging_filters_adds_counts():
    rnd = np.random.default_rng(1)
    parts = [rnd.integers(0, 50, n).astype(np.uint64) for n in (0, 1, 30, 200)]
    merged = Counts.merged([Counts.of((p,)) for p in parts])
    again = Counts.of((np.concatenate(parts),))
    assert (merged.columns[0] == again.columns[0]).all() and (merged.n == again.n).all()
    big = Counts.of((np.array([7, 7, 2**64 - 1], np.uint64),), np.array([10**15, 300, 254]))
    back = quotient.unpack(quotient.pack(big, 0), 0, 0)
    assert back.n.tolist() == [10**15 + 300, 254] and back.columns[0].tolist() == [7, 2**64 - 1]


def test_permutation_is_one_to_one():
    keys = np.arange(5000, dtype=np.uint64)
    for spread in (quotient.permuted((keys,)), quotient.permuted((keys, keys * 0)), quotient.permuted((keys * 0, keys))):
        assert len(set(zip(*(map(int, c) for c in spread)))) == 5000
        # leading bits are even: no shard of 16 has twice its share
        assert np.bincount((spread[0] >> np.uint64(60)).astype(np.int64), minlength=16).max() < 2 * 5000 / 16
