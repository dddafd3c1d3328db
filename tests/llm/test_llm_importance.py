"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_llm_operators import ROWS, documents

from lexiframe.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def plain(rows, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    def bucket(x):
        return zlib.crc32(x.encode()) % buckets

    lists = [(key, *features(text, longest)) for key, text in rows]
    s = Counter(bucket(x) for _, _, f in lists for x in f)
    t = Counter(bucket(x) for text in target for x in features(text, longest)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    out = []
    for key, n_words, f in lists:
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(f), weight, score, None, n_words])
    able = [r for r in out if r[5] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in out]


def by_text(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def corpus(seed, n=300):
    rnd = random.Random(seed)
    words = [rnd.choice("abcdeé日z09") + rnd.choice(["", "x", "Yy", "ß", "É"]) * rnd.randrange(3) for _ in range(80)]
    seps = [" ", " ", ", ", "\n", "--", "_", "\x00", "  ", "[", "'"]
    return [
        (i, "".join(rnd.choice(words) + rnd.choice(seps) for _ in range(rnd.choice([0, 5, 25, 60])))) for i in range(n)
    ]


@pytest.mark.parametrize("longest, buckets, patterns, percent", [(1, 10_000, 1 << 16, 10), (2, 500, 20, 33), (3, 70_000, 0, 100), (1, 50, 3, 0)])
def test_resample(spark, monkeypatch, longest, buckets, patterns, percent):
    found = importance.frequent_words
    monkeypatch.setattr(importance, "frequent_words", lambda docs, text: found(docs, text, patterns) if patterns else [])
    monkeypatch.setattr(importance, "CHUNK", 2000)
    rows, target = corpus(longest), [(i, t) for i, t in corpus(9, 20)] + [(98, None), (99, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    aim = spark.createDataFrame(target, "item_id bigint, text string")
    out = importance.resample(docs, aim, percent, longest=longest, buckets=buckets).collect()
    expected = plain(rows, [t for _, t in target], longest, buckets, percent)
    assert by_text(map(tuple, out)) == by_text(expected)


def test_edges(spark):
    aim = spark.createDataFrame([(1, "one two w1 w2")], "item_id bigint, text string")
    docs = documents(spark)
    out = importance.resample(docs, aim, percent=100).collect()
    # two rows with the same key and text share their ranks
    expected = plain([(r[0], r[1]) for r in ROWS], ["one two w1 w2"], percent=100)
    assert by_text(map(tuple, out)) == by_text(expected)
    assert importance.resample(documents(spark, []), aim).collect() == []
    nothing = importance.resample(docs, aim.limit(0)).collect()
    assert by_text(map(tuple, nothing)) == by_text(plain([(r[0], r[1]) for r in ROWS], []))


def test_ties_and_copies_draw_by_key(spark):
    rows = [(i, "same words again and again " * 10) for i in range(40)] + [(7, "same words again and again " * 10)] * 40 + [(None, "same words " * 30)] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    aim = spark.createDataFrame([("same",)], "text string")
    out = importance.resample(docs, aim, percent=50).collect()
    assert by_text(map(tuple, out)) == by_text(plain(rows, ["same"], percent=50))
    assert sorted(r.rank for r in out if r.rank) == list(range(1, len(rows) // 2 + 1))


def test_crc_of_neighbours():
    rnd = np.random.default_rng(3)
    pairs = [(rnd.bytes(int(a)), rnd.bytes(int(b))) for a, b in rnd.integers(0, 5000, (300, 2))]
    first, second = (np.array([zlib.crc32(p[i]) for p in pairs], np.uint32) for i in (0, 1))
    joined = importance.appended(first, second, np.array([len(b) for _, b in pairs]))
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_patterns_do_not_change_payloads():
    texts = [b"", b"One,two  three", "é two日 x".encode(), b"two", b"\x00two\x7ftwo ", b"zz" * 3000]
    expected = [features(t.decode(), 1)[1] for t in texts]
    for patterns in ([], ["two"], ["one", "two", "three", "é", "two日", "x", "zz"]):
        crc, size, bounds = importance.Scanner(patterns).payloads(texts)
        found = [list(zip(crc[a:b].tolist(), size[a:b].tolist())) for a, b in zip(bounds, bounds[1:])]
        assert found == [[(zlib.crc32(w.encode()), len(w.encode())) for w in x] for x in expected]
