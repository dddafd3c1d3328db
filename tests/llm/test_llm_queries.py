"""The registered queries on the smallest tables, and the pipeline."""

import random

import brute
import pytest
from check_catalog import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from lexiframe.llm import bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    assert compare(spark, connect(SF), queries.QUERIES[name], queries.SQL[name], SF) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_near_duplicates_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.QUERIES["op10_superminhash"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.near(rows, 3, 85)


@pytest.mark.parametrize("name", ["op2_reply_trees", "op3_secret_ownership"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, columns = docs, docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{name}-{random.random()}"
        rows.write.parquet(path)
        rows = spark.read.parquet(path)
        assert rows.columns == columns
        counts.append({r.doc_id for r in rows.collect()})
    good = {r.doc_id for r in queries.QUERIES["op9_suffix_repetition"](spark, SF).where("kept").collect()}
    assert counts[0] == good
    groups = brute.near([(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good], 5, 80)
    assert counts[1] == {i for i, (_, root) in groups.items() if i == root} == counts[2]
    assert counts[3] <= counts[2]
    texts = rows.select("text").collect()
    assert not any(brute.secrets(r.text) for r in texts)
    assert rows.where(F.length("text") != F.col("n_chars")).count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
    assert out.count() == rows.count() == corpus_pipeline.run(spark, SF).count()
    text = bpe.read_tokenizer(corpus_pipeline.public_tokenizers.path(corpus_pipeline.TOKENIZER))
    assert bpe.decode(out, text).where("n_tokens > 0 and decoded = ''").count() == 0
