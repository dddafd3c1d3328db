"""Every query against its SQL twin, and the same rows for any partitioning."""

import pytest

import __spark_entry__ as entry
from check_catalog import compare, connect
from lexiframe.catalog import all_queries, all_sql, registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], SQL.get(name), SF) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "rank", "word", "tf", "tfidf"] and df.count() > 0


@pytest.mark.parametrize(
    "name",
    ["ranked_keywords", "vocabulary", "run_numbers", "hash_split", "class_accuracy_by_last_run",
     "label_index", "bayes_predictions", "scoring_job", "decision_tree"],
)
def test_partitioning_does_not_matter(spark, monkeypatch, name):
    from lexiframe.catalog import labels, models, rows, text

    found = []
    for n in (2, 7):
        def spread(spark, d, table_name, n=n):
            return registry.table(spark, d, table_name).repartition(n)

        for module in (labels, models, rows, text):
            monkeypatch.setattr(module, "table", spread)
        found.append(sorted(map(repr, QUERIES[name](spark, SF).collect())))
    assert found[0] == found[1]
