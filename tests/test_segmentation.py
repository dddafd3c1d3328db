"""The word lattice against a plain search."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiframe.operators import segmentation
from lexiframe.operators.segmentation import Trie
from lexiframe.session import BATCH_BYTES


def plain(run, costs, unknown, longest):
    """Least cost, then fewest words, then the longest first word."""
    n = len(run)
    best = [None] * n + [(0, 0, 0)]
    for i in reversed(range(n)):
        best[i] = min(
            (costs.get(run[i:j], unknown) + best[j][0], 1 + best[j][1], i - j)
            for j in range(i + 1, min(n, i + longest) + 1)
            if run[i:j] in costs or j == i + 1
        )
    out, i = [], 0
    while i < n:
        out.append(run[i : i - best[i][2]])
        i -= best[i][2]
    return out


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_path(seed):
    rnd = random.Random(seed)
    words = sorted({"".join(rnd.choice("ab好") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(0, 12))})
    costs = [rnd.randint(1, 6) for _ in words]
    trie = Trie.of(words, costs, 7)
    runs = ["".join(rnd.choice("ab好🙂") for _ in range(rnd.randint(1, 15))) for _ in range(30)]
    assert trie.cut(runs) == [plain(x, dict(zip(words, costs)), 7, trie.longest) for x in runs]


def test_a_very_long_run():
    run = "甲乙丙" * 34_000
    words = Trie.of(["甲乙", "丙"], [5, 5], 9).cut([run, "丙"])
    assert words[1] == ["丙"] and len(words[0]) == 68_000 and "".join(words[0]) == run


def test_no_runs():
    assert Trie.of(["a"], [1], 1).cut([]) == []


def test_segment_runs(spark, monkeypatch):
    monkeypatch.setattr(segmentation, "BATCH", 3)
    given = ["我们 在 公园", "公园 里 我们 唱歌", "唱歌 我们", "在 家 里"]
    seen = spark.createDataFrame([(x.split(),) for x in given], "words array<string>")
    counts = segmentation.dictionary(seen)
    assert {r.word: r.n for r in counts.collect()} == {"我们": 3, "在": 2, "公园": 2, "里": 2, "唱歌": 2, "家": 1}
    texts = [("我们在公园里唱歌",), ("x我们 yz公园,家",), (None,), ("",), (" \t",), ("新字",), ("我",)]
    out = segmentation.segment_runs(spark.createDataFrame(texts, "text string").repartition(3), "text", counts).collect()
    assert {r.text: r.words for r in out} == {
        "我们在公园里唱歌": ["我们", "在", "公园", "里", "唱歌"],
        "x我们 yz公园,家": ["x", "我们", "yz", "公园", ",", "家"],
        None: None, "": [], " \t": [], "新字": ["新", "字"], "我": ["我"],
    }


def test_dictionary_is_bounded_and_settles_ties(spark):
    seen = spark.createDataFrame([(["b", "a", "c", "long", "a", "", "d"],)], "words array<string>")
    rows = segmentation.dictionary(seen, size=3, longest=3).collect()
    assert [(r.word, r.n) for r in rows] == [("a", 2), ("b", 1), ("c", 1)]
    assert segmentation.dictionary(seen, least=3).count() == 0


def test_empty_dictionary_cuts_characters(spark):
    counts = spark.createDataFrame([], "word string, n long")
    out = segmentation.segment_runs(spark.createDataFrame([("你好 a",)], "text string"), "text", counts).first()
    assert out.words == ["你", "好", "a"]


def test_costs(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 1)], "word string, n long")
    rows = {r.word: (r.cost, r.unknown) for r in segmentation.word_costs(counts).collect()}
    assert rows == {"a": (287682, 1386294), "b": (1386294, 1386294)}
    assert segmentation.word_costs(counts.where(F.lit(False))).collect() == []


def test_runs_of_an_array_and_shared_ends(spark, monkeypatch):
    """Rows keep their runs: no row for each run, no shuffle to bring them together."""
    monkeypatch.setattr(segmentation, "BATCH", 4)
    counts = spark.createDataFrame([("ab", 5), ("c", 3), ("好a", 4)], "word string, n long")
    given = [[["a", "b"], ["ab", "c"]], [], [["好", "ab"], ["x"]], None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "id int, given array<array<string>>")
    glued = df.withColumn("runs", F.transform("given", lambda x: F.array_join(x, ""))).coalesce(1)
    cut = segmentation.cut_runs(glued, "runs", counts, "found")
    out = cut.withColumn("shared", segmentation.shared_ends("given", "found"))
    rows = {r.id: (r.found, r.shared) for r in out.where("id < 3").collect()}
    assert rows == {0: ([["ab"], ["ab", "c"]], 3), 1: ([], 0), 2: ([["好", "ab"], ["x"]], 3)}
    assert cut.where("id = 3").first().found is None
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_sums_beyond_64_bits_and_collisions(monkeypatch):
    """Costs that don't fit beside a number of words are summed as whole numbers of any size; full tables still find."""
    big = 1 << 59
    assert Trie.of(["aa", "a"], [big, big], big).cut(["aaa"]) == [["aa", "a"]]
    monkeypatch.setattr(segmentation, "_slots", lambda keys, size: keys * 0 + size - 1)
    assert Trie.of(["ab", "abc", "d"], [5, 4, 3], 9).cut(["abcdab", "abd"]) == [["abc", "d", "ab"], ["ab", "d"]]


def test_a_large_batch_is_cut_in_pieces():
    """What is held besides the words follows a piece, not the batch; rows and runs are whole."""
    trie = Trie.of(["ab", "cd", "e"], [5, 5, 5], 9)
    runs = pa.array(["abcde" * 40] * 40_000)
    tracemalloc.start()
    found = segmentation.cut_strings(trie, runs)
    given = pa.ListArray.from_arrays(pa.array(np.arange(0, 40_001, 8, dtype=np.int32)), found)
    shared = segmentation.shared_ends.func(given, given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.value_lengths().unique().to_pylist() == [120] and shared.unique().to_pylist() == [8 * 120]
    assert peak < 120 << 20


def test_pieces_change_nothing(monkeypatch):
    trie = Trie.of(["ab", "b", "好a"], [2, 3, 4], 9)
    runs = pa.array(["x", "abab", "", "好a", "bab", "abb好a"], pa.string())
    is_run = np.array([True, False, True, True, True, False])
    lists = lambda x: pa.array(x, pa.list_(pa.list_(pa.string())))
    one = lists([[["a", "b"], ["ab"]], [], None, [["好a", "b"], []], [["c"]]]).slice(1)
    two = lists([[["ab"], ["a", "b"]], [], None, [["好", "ab"], []], [["c"]]]).slice(1)
    whole = [segmentation.cut_strings(trie, runs.slice(1), is_run[1:]).to_pylist(), segmentation.shared_ends.func(one, two).to_pylist()]
    assert whole == [[["abab"], [], ["好a"], ["b", "ab"], ["abb好a"]], [0, 0, 1, 1]]
    monkeypatch.setattr(segmentation, "PIECE", 1)
    assert whole == [segmentation.cut_strings(trie, runs.slice(1), is_run[1:]).to_pylist(), segmentation.shared_ends.func(one, two).to_pylist()]


def test_a_filter_on_words_cuts_no_run_twice(spark):
    counts = spark.createDataFrame([("ab", 5)], "word string, n long")
    df = spark.createDataFrame([(["ab", "aab"],), ([],)], "runs array<string>")
    out = segmentation.cut_runs(df, "runs", counts, "found").where(F.size("found") > 0)
    texts = segmentation.segment_runs(spark.createDataFrame([("我们 x",), ("",)], "text string"), "text", counts).where(F.size("words") > 0)
    assert [r.found for r in out.collect()] == [[["ab"], ["a", "ab"]]] and [r.words for r in texts.collect()] == [["我", "们", "x"]]
    for x in (out, texts):
        assert x._jdf.queryExecution().optimizedPlan().toString().count("cut(") == 1


def test_texts_leave_in_small_batches(spark):
    """Whatever the session had; a limit that is set stays."""
    counts = spark.createDataFrame([("ab", 5)], "word string, n long")
    df = spark.range(4000).select(F.array(F.repeat(F.lit("ab"), 5000)).alias("runs")).coalesce(1)
    spark.conf.unset(BATCH_BYTES)
    segmentation.cut_runs(df, "runs", counts)
    sizes = df.select("runs").mapInArrow(lambda xs: (pa.RecordBatch.from_pydict({"n": [x.nbytes]}) for x in xs), "n long")
    assert max(r.n for r in sizes.collect()) < 10 << 20
    spark.conf.set(BATCH_BYTES, "1m")
    segmentation.cut_runs(df, "runs", counts)
    assert spark.conf.get(BATCH_BYTES) == "1m" and sizes.count() > 30
    spark.conf.unset(BATCH_BYTES)
