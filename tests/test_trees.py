"""Trees from split statistics against a plain recursion."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiframe.operators import trees
from lexiframe.operators.trees import POISSON, Growth


def drawn(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def weighed(x, impurity):
    if impurity == "gini":
        return x * x
    return round(x * math.log(x) * 1_000_000) if x else 0


def side(counts, impurity):
    n = sum(counts.values())
    total = sum(weighed(x, impurity) for x in counts.values())
    return total / n if impurity == "gini" else total - weighed(n, impurity)


def counted(rows):
    out = Counter()
    for _, label, _, w in rows:
        out[label] += w
    return out


def plain(rows, g, tree, node=1):
    """A function from bins to label; rows are (key, label, bins, weight)."""
    counts = counted(rows)
    major = min(counts, key=lambda x: (-counts[x], x))
    best = None
    if node.bit_length() <= g.depth:
        for f in sorted({f for _, _, bins, _ in rows for f in bins}):
            if g.share < 1 and drawn(g.seed, tree, node, f) >= round(g.share * 2**32):
                continue
            place = {b: b for b in {bins[f] for _, _, bins, _ in rows if f in bins}}
            if f in g.categories:
                shares = {}
                for b in place:
                    inside = counted([r for r in rows if r[2].get(f) == b])
                    shares[b] = inside[major] / sum(inside.values())
                place = {b: i for i, b in enumerate(sorted(place, key=lambda b: (-shares[b], b)), 1)}
            for cut in sorted(set(place.values())):
                def right(bins, f=f, cut=cut, place=place):
                    return place.get(bins[f], 0 if f in g.categories else bins[f]) >= cut if f in bins else False

                sides = [counted([r for r in rows if right(r[2]) == s]) for s in (True, False)]
                if all(sum(s.values()) for s in sides):
                    gain = side(sides[0], g.impurity) + side(sides[1], g.impurity) - side(counts, g.impurity)
                    if gain > (1e-9 if g.impurity == "gini" else 0.5) and (best is None or gain > best[0]):
                        best = gain, right
    if best is None:
        return lambda bins: major
    right = best[1]
    branches = [plain([r for r in rows if right(r[2]) == s], g, tree, 2 * node + s) for s in (False, True)]
    return lambda bins: branches[right(bins)](bins)


def examples(seed, n=150, classes=3):
    rnd = random.Random(seed)
    rows = []
    for key in range(n):
        bins = {f: rnd.randint(1, 5) for f in range(6) if rnd.random() < 0.7}
        label = (bins.get(0, 0) > 2) + 2 * (bins.get(1, 0) in (1, 4)) + (rnd.random() < 0.2)
        rows.append((key, "abcde"[label % classes], bins))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "key long, label string, bins map<int,int>")


GROWTHS = [
    Growth(depth=3),
    Growth(depth=4, impurity="entropy", categories=frozenset([1, 3])),
    Growth(trees=3, depth=3, share=0.5, bagged=True),
    Growth(trees=2, depth=2, share=0.6, bagged=True, impurity="entropy", categories=frozenset([1]), seed=7),
]


@pytest.mark.parametrize("g", GROWTHS)
@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_plain_trees(spark, g, seed):
    rows = examples(seed, classes=4 if seed == 2 else 3)
    forest = trees.grow(frame(spark, rows), g)
    functions = []
    for t in range(g.trees):
        weights = [sum(drawn(g.seed, t, k) >= e for e in POISSON) if g.bagged else 1 for k, _, _ in rows]
        functions.append(plain([(*r, w) for r, w in zip(rows, weights) if w], g, t))
    wanted = {}
    for k, _, bins in rows:
        votes = Counter(f(bins) for f in functions)
        wanted[k] = min(votes, key=lambda x: (-votes[x], x))
    out = trees.vote(frame(spark, rows), forest).collect()
    assert {r.key: r.prediction for r in out} == wanted


def test_same_on_any_partitioning(spark):
    rows = frame(spark, examples(3))
    found = [trees.grow(rows.repartition(n), GROWTHS[2]) for n in (1, 8, 64)]
    assert found[0] == found[1] == found[2]


def test_importances_add_up_and_find_the_rule(spark):
    rows = [(k, "x" if k % 5 < 2 else "y", {0: k % 5 + 1, 1: k * 7 % 11 + 1}) for k in range(200)]
    found = trees.importances(trees.grow(frame(spark, rows), Growth(trees=3, depth=3, bagged=True)))
    assert sum(found.values()) == pytest.approx(1) and found[0] > 0.95


def test_edges(spark):
    g = Growth(depth=2)
    with pytest.raises(ValueError):
        trees.vote(frame(spark, []), trees.grow(frame(spark, []), g))
    single = trees.grow(frame(spark, [(1, "a", {}), (2, "a", {1: 3})]), g)
    assert not single.splits and trees.importances(single) == {}
    # rows without a label teach nothing, null and empty bins go left
    odd = frame(spark, [(1, None, {0: 9}), (2, "b", {0: 1}), (3, "b", {0: 2}), (None, "a", {}), (5, "a", None)])
    out = trees.vote(odd, trees.grow(odd, g)).collect()
    assert sorted((str(r.label), r.prediction) for r in out) == [("None", "b"), ("a", "a"), ("a", "a"), ("b", "b"), ("b", "b")]
    for wrong in ({"impurity": "none"}, {"trees": 1000, "depth": 8}):
        with pytest.raises(ValueError):
            Growth(**wrong)


def test_equal_bins(spark):
    df = spark.createDataFrame([(0.0, 1), (10.0, 1), (4.9, None), (None, 1), (5.0, 1)], "x double, y int")
    out = [r.bins for r in trees.equal_bins(df, ["x", "y"], 2).collect()]
    assert out == [{0: 1, 1: 1}, {0: 2, 1: 1}, {0: 1, 1: 0}, {0: 0, 1: 1}, {0: 2, 1: 1}]


def test_agrees_with_mllib_on_a_rule(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(400).select(
        F.col("id").alias("key"), (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 9).cast("double").alias("y")
    )
    df = df.withColumn("label", ((F.col("x") > 11) & (F.col("y") < 4) | (F.col("x") < 3)).cast("double"))
    rows = df.select("*", F.create_map(F.lit(0), F.col("x").cast("int") + 1, F.lit(1), F.col("y").cast("int") + 1).alias("bins"))
    ours = trees.vote(rows, trees.grow(rows, Growth(depth=4)))
    vectors = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    theirs = DecisionTreeClassifier(maxDepth=4).fit(vectors).transform(vectors)
    assert ours.where("label <> prediction").count() == theirs.where("label <> prediction").count() == 0


def test_word_bins_leave_out_other_words_before_they_group(spark):
    docs = [(1, ["x", "a", "y", "a"]), (2, ["x", "y"]), (3, []), (4, None), (5, ["a"] * 5 + ["b"])]
    df = spark.createDataFrame(docs, "id int, words array<string>")
    vocabulary = spark.createDataFrame([("a", 0), ("b", 1)], "word string, feature int")
    out = trees.word_bins(df, vocabulary, "id")
    assert {r.id: r.bins for r in out.collect()} == {1: {0: 2}, 2: {}, 3: {}, 4: {}, 5: {0: 3, 1: 1}}
    p = out._jdf.queryExecution().optimizedPlan().toString()
    assert p.index("Aggregate") < p.index("isnotnull(feature") and "first_pos" in p[: p.index("Join")]
