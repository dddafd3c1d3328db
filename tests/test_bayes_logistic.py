"""Long naive Bayes, its tuning, and Newton's logistic regression against plain versions and MLlib."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lexiframe.operators import bayes, logistic, lookup, terms
from lexiframe.operators.bayes import Line, upper_envelope


def plain_bayes(train, docs, smoothing=1.0, min_df=2, size=21000):
    n, df, of = Counter(), Counter(), defaultdict(Counter)
    for label, words in train:
        n.update(words)
        df.update(set(words))
        of[label].update(words)
    vocab = {w for w in sorted((w for w in n if df[w] >= min_df), key=lambda w: (-n[w], w))[:size]}
    sizes = Counter(label for label, _ in train)
    out = []
    for words in docs:
        known = [w for w in words if w in vocab]
        best = []
        for c in sizes:
            total = sum(x for w, x in of[c].items() if w in vocab) + smoothing * len(vocab)
            score = math.log((sizes[c] + smoothing) / (len(train) + smoothing * len(sizes)))
            score += sum(math.log((of[c][w] + smoothing) / total) for w in known)
            best.append((-round(score, 6), c))
        out.append(min(best))
    return out


def corpus(seed, classes, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        c = rnd.randrange(classes)
        words = [f"w{(c * 3 + rnd.randrange(6)) % (2 * classes)}" for _ in range(rnd.randrange(8))]
        rows.append((i, f"c{c:04}", words + ["all"] * rnd.randrange(3)))
    return rows


@pytest.mark.parametrize("seed, classes, smoothing", [(1, 3, 1.0), (2, 40, 1.0), (3, 7, 0.25)])
def test_bayes(spark, seed, classes, smoothing):
    rows = corpus(seed, classes, 200)
    df = spark.createDataFrame(rows, "id long, label string, words array<string>")
    extra = spark.createDataFrame([(900, None, ["all"]), (901, "x", []), (902, "x", None), (903, "x", ["new"])], df.schema)
    model = bayes.train_bayes(df.union(extra.where("label is null")), smoothing=smoothing)
    out = bayes.score_bayes(model, df.union(extra), "id", keep=("label",)).collect()
    given = [(r[0], r[2]) for r in rows] + [(900, ["all"]), (901, []), (902, []), (903, ["new"])]
    wanted = dict(zip([i for i, _ in given], plain_bayes([(r[1], r[2]) for r in rows], [w for _, w in given], smoothing)))
    assert len(out) == len(given)
    for r in out:
        assert r.score == pytest.approx(-wanted[r.id][0], abs=2e-6)
        assert r.prediction == wanted[r.id][1] or r.score == pytest.approx(-wanted[r.id][0], abs=1e-9)


def test_bayes_with_5000_labels(spark):
    df = spark.range(15_000).select(
        "id", F.format_string("c%05d", F.col("id") % 5000).alias("label"),
        F.array(F.concat(F.lit("w"), F.col("id") % 5000), F.concat(F.lit("v"), F.col("id") % 3), F.lit("all")).alias("words"),
    )
    model = bayes.train_bayes(df)
    assert model.classes.count() == 5000 and model.words.columns == ["word", "classes"]
    out = bayes.score_bayes(model, df.where("id < 5000"), "id", keep=("label",))
    assert out.where("prediction <> label").count() == 0
    # no word in common with any class: the best prior and size
    none = bayes.score_bayes(model, df.limit(1).withColumn("words", F.array(F.lit("zz"))), "id").first()
    assert none.prediction == "c00000" and none.score == pytest.approx(math.log(4 / 20000), abs=1e-6)


def test_bayes_beyond_the_broadcast_limit(spark, monkeypatch):
    rows = corpus(5, 9, 150)
    df = spark.createDataFrame(rows, "id long, label string, words array<string>")
    near = sorted(map(tuple, bayes.score_bayes(bayes.train_bayes(df), df, "id").collect()))
    monkeypatch.setattr(lookup.lookup_join, "__defaults__", ("left", None, 0, 5))
    assert sorted(map(tuple, bayes.score_bayes(bayes.train_bayes(df), df, "id").collect())) == near


def test_bayes_on_nothing(spark):
    df = spark.createDataFrame([], "id long, label string, words array<string>")
    model = bayes.train_bayes(df)
    docs = spark.createDataFrame([(1, "a", ["b"])], df.schema)
    assert [tuple(r) for r in bayes.score_bayes(model, docs, "id").collect()] == [(1, None, None)]
    assert bayes.score_bayes(model, df, "id").collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_upper_envelope(seed):
    rnd = random.Random(seed)
    lines = [Line(f"c{i}", float(rnd.randint(-9, 9)), -float(rnd.randint(0, 12)) / 4) for i in range(rnd.randint(1, 15))]
    found = upper_envelope(lines)
    assert found[0][0] == 0
    for size in range(60):
        line = [x for since, x in found if since <= size][-1]
        assert line.intercept + line.slope * size == max(x.intercept + x.slope * size for x in lines)


def test_tuning_equals_models_of_the_other_folds(spark):
    rows = corpus(8, 4, 120)
    df = spark.createDataFrame([(*r, r[0] % 3) for r in rows], "id long, label string, words array<string>, fold int")
    grid = (0.1, 1.0, 20.0)
    out = {(r.smoothing, r.fold): r.f1 for r in bayes.tune_bayes(df, "id", smoothings=grid, min_df=1).collect()}
    assert len(out) == 9
    vocabulary_is_whole = {w for _, _, ws in rows for w in ws}
    for (s, fold), f1 in out.items():
        train = [(r[1], r[2]) for r in rows if r[0] % 3 != fold]
        assert {w for _, ws in train for w in ws} == vocabulary_is_whole
        test = [r for r in rows if r[0] % 3 == fold]
        predicted = [c for _, c in plain_bayes(train, [r[2] for r in test], s, 1)]
        truth = [r[1] for r in test]
        total = 0.0
        for c in set(truth):
            hits = sum(t == p == c for t, p in zip(truth, predicted))
            total += truth.count(c) * 2 * hits / (truth.count(c) + predicted.count(c))
        assert f1 == pytest.approx(total / len(truth))
    means = {s: sum(out[s, f] for f in range(3)) / 3 for s in grid}
    chosen = bayes.best_smoothing(bayes.tune_bayes(df, "id", smoothings=grid, min_df=1))
    assert means[chosen] == pytest.approx(max(means.values()), abs=1e-6)


def points(spark, n=500):
    df = spark.range(n).select(
        "id", ((F.col("id") * 37 % 101).cast("double") / 50).alias("a"), ((F.col("id") * 53 % 97).cast("double") / 30).alias("b")
    )
    noisy = F.when(F.col("id") % 6 == 0, (F.col("id") % 4 > 1)).otherwise(F.col("a") + F.col("b") > 2.4)
    return df.withColumn("label", noisy.cast("double"))


@pytest.mark.parametrize("reg", [0.0, 0.05])
def test_newton_agrees_with_mllib(spark, reg):
    df = points(spark)
    ours = logistic.fit(df.repartition(3), ("a", "b"), reg=reg)
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    theirs = LogisticRegression(maxIter=500, regParam=reg, standardization=False, tol=1e-14).fit(vectors)
    assert ours.coefficients == pytest.approx((theirs.intercept, *theirs.coefficients), abs=1e-5)
    assert ours.steps < 12


def test_newton_leaves_out_broken_rows_and_uses_the_threshold(spark):
    df = points(spark, 200)
    broken = spark.createDataFrame(
        [(1, None, 1.0, 1.0), (2, float("nan"), 1.0, 0.0), (3, 1.0, 1.0, None)], "id long, a double, b double, label double"
    )
    both = df.unionByName(broken)
    model = logistic.fit(both, ("a", "b"), reg=0.1)
    assert model.coefficients == pytest.approx(logistic.fit(df, ("a", "b"), reg=0.1).coefficients)
    out = logistic.score(df, model, threshold=0.8, probability_col="p", prediction_col="q").collect()
    assert all((r.p > 0.8) == (r.q == 1.0) for r in out) and {r.q for r in out} == {0.0, 1.0}
    for wrong in (df.where("label = 1"), df.limit(0)):
        with pytest.raises(ValueError):
            logistic.fit(wrong, ("a",))


def test_words_of_docs_without_any(spark):
    df = spark.createDataFrame([(1, None)], "id long, words array<string>")
    assert terms.term_counts(df, "id").collect()[0].word is None


def test_rare_words_are_not_counted_by_class(spark, monkeypatch):
    """Words outside the vocabulary are neither moved nor stored for each class and fold."""
    rows = [(i, f"c{i % 3}", ["a", "b", f"only{i}", f"once{i}"], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, label string, words array<string>, fold int")
    stored = []
    keep = bayes.materialise
    monkeypatch.setattr(bayes, "materialise", lambda table, name: stored.append((name, keep(table, name))) or stored[-1][1])
    found = bayes.class_words(df, "label", "words", 10, 2, ("fold",))
    assert sorted(r.word for r in found.select("word").distinct().collect()) == ["a", "b"]
    assert sum(r.n for r in found.collect()) == 120
    assert max(table.count() for _, table in stored) <= 2 * 3 * 2


def test_few_classes_are_summed_in_the_row_of_their_document(spark, monkeypatch):
    """The same scores as with a row for each pair of document and class, and the documents move once."""
    rows = corpus(4, 4, 90) + [(90, "c0", []), (91, "c1", None), (92, "c1", ["unheard"])]
    df = spark.createDataFrame([(*r, r[0] % 3) for r in rows], "id long, label string, words array<string>, fold int")
    model = bayes.train_bayes(df, min_df=1)
    few = bayes.score_bayes(model, df, "id", keep=("label",))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "collect_list" not in plan
    tuned = {(r.smoothing, r.fold): r.f1 for r in bayes.tune_bayes(df, "id", min_df=1).collect()}
    monkeypatch.setattr(bayes, "FEW_SUMS", 0)
    many = bayes.score_bayes(model, df, "id", keep=("label",))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert tuned == pytest.approx({(r.smoothing, r.fold): r.f1 for r in bayes.tune_bayes(df, "id", min_df=1).collect()})
