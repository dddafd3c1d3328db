"""Words counted in Arrow batches, and the terms that keywords leave out before the join."""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from lexiframe.catalog import text
from lexiframe.operators import lookup, terms, tokens
from lexiframe.plans import training
from lexiframe.plans.training import TrainingPlan
from lexiframe.session import BATCH_BYTES

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.collect()))


def test_stored_counts_equal_counts_in_rows(spark, monkeypatch):
    data = [(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["a", None, "a"]), (5, ["c"] * 9), (6, ["a"])]
    df = spark.createDataFrame(data, "id int, words array<string>")
    monkeypatch.setattr(terms, "BATCH_WORDS", 4)
    expected = terms.term_counts(df, "id")
    found = terms.stored_term_counts(df.coalesce(1), "id")
    assert rows(found.select(expected.columns)) == rows(expected)
    totals = {(r.word or "", r.n, r.df) for r in terms.term_totals(df.coalesce(1)).collect()}
    assert totals == {("a", 4, 3), ("b", 2, 1), ("c", 9, 1), ("", 1, 1)}


def test_keywords_with_a_large_idf_store_few_terms(spark, monkeypatch):
    """Terms that known weights outdo aren't stored; ranks are those of all terms."""
    words = text.corpus_words(spark, SF)
    idf = text.corpus_idf(words)
    columns = ["doc_id", "word", "tf", "first_pos", "tfidf", "rank"]
    small = rows(terms.ranked_keywords(words, idf, "doc_id", n=5).select(columns))
    stored, keep = [], terms.materialise
    monkeypatch.setattr(terms, "materialise", lambda df, name: stored.append(keep(df, name)) or stored[-1])
    monkeypatch.setattr(terms, "MAX_LOOKUP_BYTES", 0)
    monkeypatch.setattr(lookup.lookup_join, "__defaults__", ("left", None, 0, 50))
    for known in (terms.FREQUENT_KEYS, 300):
        monkeypatch.setattr(terms, "FREQUENT_KEYS", known)
        out = terms.ranked_keywords(words, idf, "doc_id", n=5)
        assert rows(out.select(columns)) == small
    every = terms.term_counts(words, "doc_id").where(F.col("word").isNotNull()).count()
    assert stored[0].count() < every / 2


def test_blanks_and_stopwords(spark):
    data = [(["a", "", "the", "a b", "x\u3000"],), (["the", "b", "", "b"],), ([None, "a"],), (None,), ([],)]
    df = spark.createDataFrame(data, "words array<string>")
    assert [r.words for r in tokens.remove_stopwords(df, ["the"]).collect()] == [["a"], ["b", "b"], ["a"], None, []]
    assert [r.words for r in tokens.remove_stopwords(df, []).collect()][:2] == [["a", "the"], ["the", "b", "b"]]


def test_lines_are_sorted_before_they_are_cut(spark):
    from lexiframe.catalog import models

    seen, keep = [], models.write_lines
    models.write_lines = lambda df, *args: seen.append(df) or keep(df, *args)
    try:
        models.training_lines(spark, models.labelled_words(spark, SF))
    finally:
        models.write_lines = keep
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan[plan.index("rangepartitioning") :]


def test_words_leave_in_small_batches_and_training_rows_stay_on_disk(spark, monkeypatch):
    """Neither batches of texts nor words of a training table add up in an executor."""
    df = spark.createDataFrame([(i, "ab"[i % 2], ["x", "yz"[i % 2]] * 4) for i in range(20)], ["pos", "label", "words"])
    kept, persist = [], type(df).persist
    monkeypatch.setattr(type(df), "persist", lambda self, level: kept.append(level) or persist(self, level))
    idf = spark.createDataFrame([("x", 9, 1.0)], ["word", "df", "idf"])
    for job in (
        lambda: terms.term_totals(df).count(),
        lambda: terms.stored_term_counts(df, "pos", idf=idf, n=1).count(),
        lambda: training.train(df, TrainingPlan("rf", "tfidf", trees=2, depth=2, size=50)),
    ):
        spark.conf.unset(BATCH_BYTES)
        job()
        assert spark.conf.get(BATCH_BYTES) == "8m"
    spark.conf.unset(BATCH_BYTES)
    model = training.train(df, TrainingPlan("nb", size=50))
    assert [r.prediction == r.indexedLabel for r in model.transform(df).collect()] == [True] * 20
    assert kept == [StorageLevel.DISK_ONLY] * 2
    spark.conf.unset(BATCH_BYTES)
