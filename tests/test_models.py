"""Training, saving, scoring and tuning on small tables."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiframe.catalog import models
from lexiframe.operators import bayes
from lexiframe.plans import classifiers, documents, scoring, stages, training
from lexiframe.plans.training import TrainingPlan
from lexiframe.sources import read_lines, read_results

SF = "/root/testdata/sf0.001"

POINTS = [(float(x + y > 3), (float(x), float(y))) for x in range(4) for y in range(4)]


def vectors(spark, data):
    return spark.createDataFrame([(y, Vectors.dense(*x)) for y, x in data], ["label", "features"])


def test_logistic_overrides(spark):
    overrides = {"maxIter": 30, "regParam": 0.1, "threshold": 0.55, "probabilityCol": "myProbability"}
    points = vectors(spark, POINTS)
    model = classifiers.fit_logistic(points, overrides=overrides)
    out = model.transform(points).collect()
    assert all((r["myProbability"][1] > 0.55) == (r["prediction"] == 1.0) for r in out)
    assert sum(r["myProbability"][1] for r in out) == pytest.approx(sum(y for y, _ in POINTS), abs=1e-3)
    assert model.coefficients[0] == pytest.approx(model.coefficients[1], abs=1e-6)
    shown = {p.name: v for p, v in model.extractParamMap().items()}
    assert shown["threshold"] == 0.55 and shown["regParam"] == 0.1


def test_text_classifier_saved_fitted_and_not(spark, tmp_path):
    train = spark.createDataFrame(
        [(0, "salt water fish", 1.0), (1, "雪 冰", 0.0), (2, "fish net 海", 1.0), (3, "dry desert", 0.0)],
        "id int, text string, label double",
    )
    test = spark.createDataFrame([(4, "fish oil"), (5, "x y"), (6, "desert fish")], "id int, text string")
    chain = classifiers.text_classifier()
    model = chain.fit(train)
    model.write().overwrite().save(str(tmp_path / "fitted"))
    chain.write().overwrite().save(str(tmp_path / "unfitted"))
    expected = [r["prediction"] for r in model.transform(test).collect()]
    for again in (PipelineModel.load(str(tmp_path / "fitted")), Pipeline.load(str(tmp_path / "unfitted")).fit(train)):
        assert [r["prediction"] for r in again.transform(test).collect()] == expected
    fit = model.transform(train).collect()
    assert [r["prediction"] for r in fit] == [r["label"] for r in fit]


def test_hashed_tfidf_on_sentences(spark):
    df = spark.createDataFrame(
        [(0, ["hi", "spark"]), (1, ["hi", "java"]), (2, ["neat", "java"])], "id int, words array<string>"
    )
    tf, idf = stages.hashed_tfidf_stages(size=1 << 18)
    rows = idf.fit(tf.transform(df)).transform(tf.transform(df)).orderBy("id").collect()
    import math

    assert sorted(map(float, rows[0]["features"].values)) == pytest.approx(
        sorted([math.log(4 / 3), math.log(4 / 2)])
    )


def test_count_stage_settles_ties_by_word(spark):
    df = spark.createDataFrame([(["b", "a", "c"],), (["c", "b", "a"],), (["c", "z"],)], "words array<string>")
    for n in (1, 5):
        assert stages.count_stage(df.repartition(n), size=2).vocabulary == ["c", "a"]


def test_bayes_table_equals_mllib(spark):
    docs = models.labelled_words(spark, SF)
    train = docs.where("part = 0")
    table = bayes.score_bayes(bayes.train_bayes(train), docs, "pos")
    fitted = training.train(train.drop("part"), TrainingPlan("nb", "counts", "index"))
    mllib = scoring.score(fitted, docs).select("pos", "predictLabel")
    assert table.join(mllib, "pos").where("prediction <> predictLabel").count() == 0


@pytest.mark.parametrize("plan", [
    TrainingPlan("nb", "counts", "index"),
    TrainingPlan("rf", "tfidf", "run", trees=3, depth=4),
])
def test_save_load_and_score_to_files(spark, tmp_path, plan):
    lines = models.training_lines(spark, models.labelled_words(spark, SF))
    docs = documents.training_set_with_ids(lines)[0]
    model = training.train(docs, plan)
    label_map = docs.select("label").distinct().withColumn("id", F.lit(1))
    path = training.save(model, plan, str(tmp_path), label_map)
    assert training.load_label_map(spark, path).count() == 4
    again = training.load(path)
    f1 = scoring.score_to_files(again, docs, plan.label_column, str(tmp_path / "out"))
    assert 0 < f1 <= 1
    results = read_results(spark, str(tmp_path / "out" / "predictions"))
    scored = model.transform(docs)
    same = scored.orderBy("pos").select(F.col(plan.label_column).cast("int"), F.col("prediction").cast("int"))
    assert [tuple(r)[1:] for r in results.orderBy("pos").collect()] == [tuple(r) for r in same.collect()]
    assert read_lines(spark, str(tmp_path / "out" / "probabilities")).count() == docs.count()


def test_plans_have_paths_of_their_own():
    plans = [TrainingPlan(m, f, l) for m in ("nb", "rf") for f in ("counts", "tfidf") for l in ("index", "run")]
    plans += [TrainingPlan("nb", min_df=3), TrainingPlan("rf", partitions=8)]
    assert len({p.path("/models") for p in plans}) == len(plans)


def test_forest_does_not_depend_on_the_session(spark):
    rows = documents.training_set(models.training_lines(spark, models.labelled_words(spark, SF)))
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        model = training.train(rows, TrainingPlan("rf", trees=3, depth=4))
        found.append(model.stages[-1].toDebugString)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0].split("\n")[1:] == found[1].split("\n")[1:]


def test_forest_partitions_follow_the_rows(spark, monkeypatch):
    """A partition of a forest holds about as many rows whatever the size of the table."""
    found = []
    keep = training.ordered_input
    monkeypatch.setattr(training, "ordered_input", lambda *args: found.append(keep(*args)) or found[-1])
    monkeypatch.setattr(stages, "FOREST_ROWS", 10)
    for n in (30, 120):
        rows = spark.range(n).select(F.col("id").alias("pos"), F.lit("x").alias("label"), F.array(F.lit("w")).alias("words"))
        both = rows.withColumn("label", F.when(F.col("pos") % 2 == 0, "x").otherwise("y"))
        training.train(both, TrainingPlan("rf", "tfidf", size=50, trees=2, depth=2, partitions=4))
    assert [x.rdd.getNumPartitions() for x in found] == [4, 12]


def test_importances_need_counts(spark):
    rows = documents.training_set(models.training_lines(spark, models.labelled_words(spark, SF)))
    model = training.train(rows, TrainingPlan("nb", "tfidf"))
    with pytest.raises(ValueError):
        scoring.feature_importances(spark, model)


def test_feature_importances(spark):
    docs = models.labelled_words(spark, SF)
    model = training.train(docs, TrainingPlan("rf", "counts", "index", trees=5, depth=4))
    rows = scoring.feature_importances(spark, model)
    assert rows.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert rows.count() == len(model.stages[1].vocabulary)


def test_tuned_tree_depth_and_seen_labels(spark):
    df = spark.range(600).select(
        "id",
        (F.col("id") % 4).cast("int").alias("label"),
        F.array((F.col("id") % 4).cast("double"), (F.col("id") % 31).cast("double")).alias("x"),
    )
    from pyspark.ml.functions import array_to_vector

    run = classifiers.tune_tree(df.select("id", "label", array_to_vector("x").alias("features")), "id")
    assert classifiers.chosen_depth(run) <= 6
    assert run.scored.where("label <> prediction").count() == 0
    fixed = classifiers.train_tree(df.select("id", "label", array_to_vector("x").alias("features")), "id")
    assert fixed.scored.count() == run.scored.count() > 0


def test_preparation_jobs(spark):
    lines = spark.createDataFrame(
        [(0, "k1 k2 A"), (1, "k3 A"), (2, "k1 B"), (3, "A")], "pos long, value string"
    )
    rows, dictionary = documents.training_set_with_ids(lines)
    assert [tuple(r) for r in rows.select("pos", "label_id", "words").orderBy("pos").collect()] == [
        (0, 0, ["k1", "k2"]), (1, 0, ["k3"]), (2, 1, ["k1"]), (3, 2, []),
    ]
    assert {tuple(r) for r in dictionary.collect()} == {("A", 2), ("B", 1)}
    contracts = spark.createDataFrame(
        [(0, "the x y x^^A"), (1, "^^B"), (2, "plain"), (3, "y^^mid^^C")], "pos long, value string"
    )
    idf = spark.createDataFrame([("x", 2.0), ("y", 1.0)], "word string, idf double")
    out = documents.scoring_set_with_ids(contracts, idf, ["the"], dictionary)
    assert sorted(tuple(r) for r in out.select("pos", "label", "label_id", "words").collect()) == [
        (0, "A", 2, ["x", "y"]), (1, "B", 1, []), (2, "plain", 1, ["plain"]), (3, "C", 1, ["y"]),
    ]
