"""Runs of labels, label ids and category indexing."""

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import labels, runs
from ..plans.classifiers import category_indexer
from ..sources.scratch import materialise
from .registry import Registry, table

registry = Registry()
query = registry.add

RUNS_SQL = """
    marks AS (SELECT o_orderkey, o_orderpriority AS label,
                     CASE WHEN o_orderpriority = lag(o_orderpriority, 1, '') OVER (ORDER BY o_orderkey)
                          THEN 0 ELSE 1 END AS s
              FROM orders),
    runs AS (SELECT o_orderkey, label, (sum(s) OVER (ORDER BY o_orderkey) - 1)::BIGINT AS run_id
             FROM marks)
"""


def _runs(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("label"))
    return runs.run_number(orders, "label", "o_orderkey")


@query("run_numbers", f"WITH {RUNS_SQL} SELECT * FROM runs")
def run_numbers(spark, d):
    return _runs(spark, d)


@query(
    "label_dictionary",
    f"WITH {RUNS_SQL} SELECT label, max(run_id) AS label_id FROM runs GROUP BY label",
)
def label_dictionary(spark, d):
    return runs.label_dictionary(_runs(spark, d))


@query(
    "run_lengths",
    f"WITH {RUNS_SQL} SELECT label, run_id, count(*) AS n FROM runs GROUP BY ALL",
)
def run_lengths(spark, d):
    return runs.run_lengths(_runs(spark, d), "label")


@query(
    "last_run_lengths",
    f"""
    WITH {RUNS_SQL}, lengths AS (SELECT label, run_id, count(*) AS n FROM runs GROUP BY ALL)
    SELECT label, arg_max(n, run_id) AS size FROM lengths GROUP BY label
    """,
)
def last_run_lengths(spark, d):
    return runs.last_run_length(_runs(spark, d), "label")


@query(
    "label_ids_with_default",
    f"""
    WITH {RUNS_SQL}, ids AS (SELECT label, max(run_id) AS id FROM runs WHERE label <> '5-LOW' GROUP BY label)
    SELECT o_orderkey, o_orderpriority, coalesce(id, 1) AS label_id
    FROM orders LEFT JOIN ids ON label = o_orderpriority
    """,
)
def label_ids_with_default(spark, d):
    known = runs.label_dictionary(_runs(spark, d)).where("label <> '5-LOW'")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return labels.label_ids(orders, materialise(known, "label-map"), "o_orderpriority")


@query(
    "in_memory_dictionary",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 2 ELSE 1 END::INTEGER AS label_id
    FROM orders
    """,
)
def in_memory_dictionary(spark, d):
    mapping = spark.createDataFrame([("F", 0), ("O", 2)], "label string, id int")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return labels.label_ids(orders, mapping, "o_orderstatus").select("o_orderkey", "label_id")


INDEX_SQL = """
    sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    ids AS (SELECT source, (row_number() OVER (ORDER BY n DESC, source) - 1)::DOUBLE AS i FROM sizes)
"""


@query(
    "label_index",
    f"""
    WITH {INDEX_SQL}
    SELECT doc_id, source, i AS "indexedLabel" FROM documents JOIN ids USING (source)
    """,
)
def label_index(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return labels.fit_label_index(docs, "source").transform(docs)


@query(
    "decoded_labels",
    """
    SELECT doc_id, lang, lang AS "predictLabel" FROM documents
    """,
)
def decoded_labels(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    model = labels.fit_label_index(docs, "lang", "prediction")
    decoded = labels.decode_labels(model.transform(docs), model.labels)
    return decoded.select("doc_id", "lang", "predictLabel")


@query(
    "category_index",
    """
    WITH slots AS (
        SELECT 0 AS slot, l_linenumber::DOUBLE AS v FROM lineitem UNION ALL
        SELECT 1, l_tax FROM lineitem UNION ALL
        SELECT 2, l_discount FROM lineitem UNION ALL
        SELECT 3, l_quantity FROM lineitem),
    counts AS (SELECT slot, v, count(*) AS n FROM slots GROUP BY ALL),
    sized AS (SELECT *, count(*) OVER (PARTITION BY slot) AS k,
                     row_number() OVER (PARTITION BY slot ORDER BY v <> 0, v) - 1 AS i FROM counts)
    SELECT slot::INTEGER AS slot, v, CASE WHEN k <= 24 THEN i ELSE v END::DOUBLE AS indexed, n FROM sized
    """,
)
def category_index(spark, d):
    parts = ["l_linenumber", "l_tax", "l_discount", "l_quantity"]
    items = VectorAssembler(inputCols=parts, outputCol="features").transform(
        table(spark, d, "lineitem").select(*parts)
    )
    indexed = category_indexer().fit(items).transform(items)
    pairs = F.arrays_zip(
        vector_to_array("features").alias("v"), vector_to_array("indexedFeatures").alias("indexed")
    )
    return (
        indexed.select(F.posexplode(pairs).alias("slot", "p"))
        .groupBy("slot", F.col("p.v").alias("v"), F.col("p.indexed").alias("indexed"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


QUERIES = registry.queries
SQL = registry.sql
