"""Physical plans: what moves, what is broadcast, and that Python stays out."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexiframe.catalog import all_queries, text
from lexiframe.catalog.registry import table
from lexiframe.operators import lookup, profile, runs, terms

SF = "/root/testdata/sf0.001"
PYTHON = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonMapIn")
# Segmenters: a function of the caller, and the word lattice.
WITH_PYTHON = {"segmented_words", "segmented_phrases"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(all_queries()))
def test_no_python_and_no_cross_join(spark, name):
    p = plan(all_queries()[name](spark, SF))
    # MLlib's models predict in JVM functions; only segmenters run in Python
    assert bool(PYTHON.search(p)) == (name in WITH_PYTHON)
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_keywords_move_each_document_once(spark):
    p = plan(entry.queries()["ranked_keywords"](spark, SF))
    assert p.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in p and "WindowGroupLimit" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_keywords_beyond_the_broadcast_limit(spark, monkeypatch):
    """Rows of frequent words stay with their document; only rows of rare words move by word."""
    monkeypatch.setattr(lookup.lookup_join, "__defaults__", ("left", None, 0, 50))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = text.document_words(spark, SF)
        out = terms.ranked_keywords(words, text.corpus_idf(words), "doc_id")
        p = plan(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
    assert "BroadcastHashJoin" in p and "hashpartitioning(word" in p and "WindowGroupLimit" in p
    monkeypatch.undo()
    small = terms.ranked_keywords(words, text.corpus_idf(words), "doc_id")
    assert sorted(map(repr, out.select(small.columns).collect())) == sorted(map(repr, small.collect()))


def test_tfidf_statistics_read_stored_counts(spark):
    """The texts are counted once for the fit and the statistics."""
    p = plan(entry.queries()["tfidf_statistics"](spark, SF))
    assert "rawFeatures" in p and "text:string" not in p


def test_term_counts_hold_one_document_at_a_time(spark):
    """No hash table over the documents of a task, whose size would grow with its share of the table."""
    p = plan(terms.term_counts(text.corpus_words(spark, SF), "doc_id"))
    assert "Aggregate" not in p and "Exchange" not in p
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["a", None, "a"])], "id int, words array<string>")
    rows = sorted((r.id, r.word or "", r.tf, r.first_pos) for r in terms.term_counts(df, "id").collect())
    assert rows == [(1, "a", 1, 1), (1, "b", 2, 0), (2, "", 0, None), (3, "", 0, None), (4, "", 0, 1), (4, "a", 2, 0)]


def test_a_large_idf_reads_the_documents_once(spark, monkeypatch):
    """Counts are stored before rows of frequent and of rare words part; no sketch if the idf has document counts."""
    words = text.corpus_words(spark, SF)
    idf = text.corpus_idf(words)
    small = terms.ranked_keywords(words, idf, "doc_id")
    monkeypatch.setattr(terms, "MAX_LOOKUP_BYTES", 0)
    monkeypatch.setattr(lookup.lookup_join, "__defaults__", ("left", None, 0, 50))
    monkeypatch.setattr(lookup, "frequent_hashes", None)
    out = terms.ranked_keywords(words, idf, "doc_id")
    assert "documents.parquet" not in plan(out)
    assert sorted(map(repr, out.select(small.columns).collect())) == sorted(map(repr, small.collect()))


def test_row_windows_are_partitioned(spark):
    orders = table(spark, SF, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    p = plan(runs.run_number(orders, "label", "o_orderkey"))
    single = [line for line in p.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) == 1 and p.count("FileScan") == 2
    scans = [line for line in p.splitlines() if "FileScan" in line]
    assert "o_orderkey" in scans[0] and "_first" in scans[1]  # rows, stored summary


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(entry.queries()["view_between"](spark, SF))
    assert "GreaterThanOrEqual(l_quantity,25.0)" in p and "LessThanOrEqual(l_quantity,30.0)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p


def test_counts_are_combined_before_the_shuffle(spark):
    p = plan(entry.queries()["word_count"](spark, SF))
    assert p.count("HashAggregate") == 2 and p.count("Exchange hashpartitioning") == 1


def test_a_profile_reads_its_table_once(spark, monkeypatch):
    plans, real = [], profile.materialise

    def recorded(df, name):
        plans.append(plan(df))
        return real(df, name)

    monkeypatch.setattr(profile, "materialise", recorded)
    plans.append(plan(profile.describe(table(spark, SF, "lineitem"), ["l_quantity", "l_tax", "l_discount"])))
    scans = [line for p in plans for line in p.splitlines() if "FileScan" in line]
    assert sum("lineitem" in line for line in scans) == 1
    assert plans[0].count("Exchange") == 2  # equal values are added up, then placed by range
    assert "Exchange SinglePartition" not in plans[1]


def test_lookups_beyond_the_broadcast_limit_filter_before_they_move(spark):
    rows = table(spark, SF, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, SF, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name").where("l_partkey % 3 = 0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(lookup.lookup_join(rows, parts, "l_partkey", max_bytes=0, n=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # of the rows, only those that the filter lets through are below the one exchange of theirs
    assert p.count("Exchange hashpartitioning(l_partkey") == 2
    below = p[p.index("Exchange hashpartitioning(l_partkey"):]
    below = below[: below.index("Exchange hashpartitioning(l_partkey", 10)]
    assert "Filter" in below and "_bits" in below and "l_orderkey" in below
    assert "Aggregate" not in p  # frequent keys come from a sketch, not from a count of all keys
