"""Round trips through text and CSV files in the shared folder."""

from pyspark.sql import functions as F

from ..operators import metrics, terms, tokens
from ..sources import (
    materialise,
    number_lines,
    read_categories,
    read_csv,
    read_idf,
    read_lines,
    read_results,
    read_stopwords,
    shared_path,
    write_class_accuracy,
    write_lines,
    write_pairs,
    write_predictions,
)
from .registry import Registry, table
from .rows import CLASS_SQL, RULE_SQL, price_rule

registry = Registry()
query = registry.add


@query(
    "numbered_file_lines",
    """
    SELECT row_number() OVER (ORDER BY doc_id, line) - 1 AS pos, value
    FROM (SELECT doc_id, generate_subscripts(ls, 1) AS line, unnest(ls) AS value
          FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
    """,
)
def numbered_file_lines(spark, d):
    path = shared_path(spark, "lines")
    docs = table(spark, d, "documents").select("doc_id", "text").orderBy("doc_id")
    write_lines(docs, F.col("text"), path)
    return number_lines(spark, path)


@query(
    "file_word_count",
    """
    SELECT '(''' || word || ''', ' || count(*) || ')' AS value
    FROM (SELECT unnest(string_split(line, ' ')) AS word
          FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
    GROUP BY word
    """,
)
def file_word_count(spark, d):
    """Text file in, ``('word', n)`` lines out."""
    source, target = shared_path(spark, "text"), shared_path(spark, "counts")
    write_lines(table(spark, d, "documents"), F.col("text"), source)
    write_pairs(terms.word_count(tokens.tokenize(read_lines(spark, source), "value")), target)
    return read_lines(spark, target)


@query(
    "csv_with_header",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
)
def csv_with_header(spark, d):
    path = shared_path(spark, "csv")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    table(spark, d, "orders").select(*columns).write.csv(path, header=True)
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"
    return read_csv(spark, path, schema)


@query(
    "idf_dictionary_file",
    "SELECT source AS word, arg_max(n_chars, doc_id)::DOUBLE AS idf FROM documents GROUP BY source",
)
def idf_dictionary_file(spark, d):
    """``key:number:rest`` lines in document order; the last line of a key counts."""
    path = shared_path(spark, "idf")
    docs = table(spark, d, "documents").orderBy("doc_id")
    write_lines(docs, F.concat_ws(":", "source", F.col("n_chars").cast("string"), "lang"), path)
    return read_idf(spark, path)


@query("stopword_file", "SELECT DISTINCT c_mktsegment AS word FROM customer")
def stopword_file(spark, d):
    path = shared_path(spark, "stopwords")
    padded = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("\t "))
    write_lines(table(spark, d, "customer"), padded, path)
    return read_stopwords(spark, path)


@query("category_file", "SELECT c_name AS category, c_custkey::INTEGER AS id FROM customer")
def category_file(spark, d):
    path = shared_path(spark, "categories")
    line = F.concat_ws(":", F.col("c_custkey").cast("string"), F.col("c_name"))
    write_lines(table(spark, d, "customer").orderBy("c_custkey"), line, path)
    return read_categories(spark, path)


def _result_file(spark, d):
    path = shared_path(spark, "results")
    rule = price_rule(spark, d).withColumn("prediction", F.col("prediction").cast("double"))
    write_predictions(rule, path, "truth")
    return path


@query(
    "prediction_lines",
    f"""
    WITH {RULE_SQL}
    SELECT truth || chr(9) || prediction || '.0' AS value, count(*) AS n FROM rule GROUP BY ALL
    """,
)
def prediction_lines(spark, d):
    return read_lines(spark, _result_file(spark, d)).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "result_file",
    f"WITH {RULE_SQL} SELECT truth, prediction, count(*) AS n FROM rule GROUP BY ALL",
)
def result_file(spark, d):
    results = read_results(spark, _result_file(spark, d))
    return results.groupBy("truth", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query(
    "class_accuracy_file",
    f"""
    {CLASS_SQL}
    SELECT row_number() OVER (ORDER BY hits, first_hit) - 1 AS pos, truth::VARCHAR AS class,
           round(hits / total, 6) AS ratio
    FROM hits WHERE hits > 0
    """,
)
def class_accuracy_file(spark, d):
    path = shared_path(spark, "accuracy")
    write_class_accuracy(
        metrics.class_accuracy(price_rule(spark, d), "truth", "prediction", "pos"), path
    )
    parts = F.split("value", " = ")
    return number_lines(spark, path).select(
        "pos",
        F.get(parts, 0).alias("class"),
        F.round(F.get(parts, 1).cast("double"), 6).alias("ratio"),
    )


@query(
    "class_accuracy_job",
    f"""
    {CLASS_SQL},
    ranked AS (SELECT row_number() OVER (ORDER BY hits, first_hit) - 1 AS pos, truth, hits / total AS recall, hits / size AS by_run
               FROM hits JOIN last_run USING (truth) WHERE hits > 0)
    SELECT kind, pos, truth::VARCHAR AS class, round(CASE kind WHEN 'recall' THEN recall ELSE by_run END, 6) AS ratio
    FROM ranked, (VALUES ('recall'), ('last_run')) AS k(kind)
    """,
)
def class_accuracy_job(spark, d):
    """From a written result file to ``class = ratio`` files, with either size of a class."""
    path = shared_path(spark, "results")
    rule = price_rule(spark, d).withColumn("prediction", F.col("prediction").cast("double"))
    write_predictions(rule, path, "truth", order="pos")
    results = materialise(read_results(spark, path), "results")
    found = []
    for kind, measure in (("recall", metrics.class_accuracy), ("last_run", metrics.class_accuracy_by_last_run)):
        target = shared_path(spark, kind)
        write_class_accuracy(measure(results, "truth", "prediction", "pos"), target)
        parts = F.split("value", " = ")
        found.append(
            number_lines(spark, target).select(
                F.lit(kind).alias("kind"), "pos", F.get(parts, 0).alias("class"),
                F.round(F.get(parts, 1).cast("double"), 6).alias("ratio"),
            )
        )
    return found[0].union(found[1])


QUERIES = registry.queries
SQL = registry.sql
