"""Records, projections, predicates, limits and table statistics."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions.text import literal_split, strip
from ..functions.vectors import vector_sum
from ..operators import metrics, profile, rows, split
from .registry import Registry, table

registry = Registry()
query = registry.add

ORDER_RECORD = ["o_orderkey", "o_custkey", "o_orderpriority"]


def _order_records(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.concat_ws(",", *ORDER_RECORD).alias("value")
    )


@query(
    "comma_fields",
    """
    SELECT o_orderkey, len(fs) AS n_fields, fs[1] AS first_field, fs[-1] AS last_field
    FROM (SELECT o_orderkey, string_split(
              concat_ws(',', o_orderkey, o_custkey, o_orderpriority), ',') AS fs FROM orders)
    """,
)
def comma_fields(spark, d):
    out = rows.split_records(_order_records(spark, d), ",")
    return out.select(
        "o_orderkey",
        F.size("fields").cast("long").alias("n_fields"),
        F.get("fields", 0).alias("first_field"),
        F.element_at("fields", -1).alias("last_field"),
    )


@query(
    "string_table",
    """
    SELECT o_orderkey::VARCHAR AS f0, o_custkey::VARCHAR AS f1, o_orderpriority AS f2 FROM orders
    """,
)
def string_table(spark, d):
    records = _order_records(spark, d).select("value")
    return rows.string_table(rows.split_records(records, ","))


@query(
    "all_columns_to_double",
    """
    SELECT try_cast(o_orderkey::VARCHAR AS DOUBLE) AS f0, try_cast(o_custkey::VARCHAR AS DOUBLE) AS f1,
           try_cast(o_orderpriority AS DOUBLE) AS f2
    FROM orders
    """,
)
def all_columns_to_double(spark, d):
    return rows.cast_all_to_double(string_table(spark, d))


@query(
    "label_from_last_column",
    """
    SELECT o_orderkey::VARCHAR AS f0, o_custkey::VARCHAR AS f1, o_orderpriority AS label FROM orders
    """,
)
def label_from_last_column(spark, d):
    return rows.label_from(string_table(spark, d))


@query(
    "first_two_columns",
    "SELECT o_orderkey::VARCHAR AS f0, o_custkey::VARCHAR AS f1 FROM orders",
)
def first_two_columns(spark, d):
    return rows.first_columns(string_table(spark, d), 2)


@query(
    "selected_columns",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def selected_columns(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )


@query(
    "typed_projection",
    """
    SELECT c_name, try_cast(c_nationkey AS DOUBLE) AS c_nationkey,
           try_cast(c_mktsegment AS DOUBLE) AS c_mktsegment
    FROM customer
    """,
)
def typed_projection(spark, d):
    return rows.project_typed(
        table(spark, d, "customer"),
        {"c_name": "STRING", "c_nationkey": "DOUBLE", "c_mktsegment": "DOUBLE"},
    )


@query(
    "view_between",
    """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 25 AND 30
    """,
)
def view_between(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(
        "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 25 AND 30"
    )


@query(
    "view_like",
    """
    SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag LIKE 'R'
    """,
)
def view_like(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(
        "SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag LIKE 'R'"
    )


@query(
    "between_and_like",
    """
    SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS price
    FROM lineitem WHERE l_quantity BETWEEN 25 AND 30 AND l_returnflag LIKE 'R' GROUP BY 1
    """,
)
def between_and_like(spark, d):
    return (
        table(spark, d, "lineitem")
        .where(F.col("l_quantity").between(25, 30) & F.col("l_returnflag").like("R"))
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))
    )


@query(
    "first_rows",
    """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """,
)
def first_rows(spark, d):
    return (
        table(spark, d, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(10)
    )


@query("last_row", "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 1")
def last_row(spark, d):
    return table(spark, d, "orders").orderBy(F.desc("o_orderkey")).limit(1)


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query(
    "text_functions",
    """
    SELECT c_custkey, trim(padded) AS stripped, contains(c_name, '#00000') AS has_zeros,
           try_cast(replace(tail, '.0', '') AS INTEGER) AS parsed,
           concat_ws(chr(9), c_mktsegment, c_nationkey) AS line,
           array_to_string(list_slice(fs, 1, len(fs) - 1), ' ') AS all_but_last,
           len(string_split(concat('a  ', c_mktsegment, ' '), ' '))::INTEGER AS n_fields
    FROM (SELECT *, '  ' || c_name || ' ' AS padded, c_nationkey || '.0' AS tail,
                 string_split(c_name || ' x ' || c_mktsegment, ' ') AS fs FROM customer)
    """,
)
def text_functions(spark, d):
    fields = literal_split(F.concat_ws(" ", "c_name", F.lit("x"), "c_mktsegment"), " ")
    tail = F.concat(F.col("c_nationkey").cast("string"), F.lit(".0"))
    return table(spark, d, "customer").select(
        "c_custkey",
        strip(F.concat(F.lit(" \t"), "c_name", F.lit("　\n"))).alias("stripped"),
        F.contains("c_name", F.lit("#00000")).alias("has_zeros"),
        F.replace(tail, F.lit(".0"), F.lit("")).try_cast("int").alias("parsed"),
        F.concat_ws("\t", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("line"),
        F.array_join(F.slice(fields, F.lit(1), F.size(fields) - 1), " ").alias("all_but_last"),
        F.size(
            literal_split(F.concat(F.lit("a  "), "c_mktsegment", F.lit(" ")), " ")
        ).alias("n_fields"),
    )


def _numeric_records(spark, d):
    """``x1,...,xn,label`` lines made from orders, keyed by order."""
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.concat_ws(",", "o_custkey", "o_totalprice", status.otherwise(2).cast("string")).alias("value"),
    )


STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"


@query(
    "numeric_vectors",
    f"""
    SELECT o_orderkey, {STATUS_SQL}::INTEGER AS label, round(o_custkey + o_totalprice, 4) AS total
    FROM orders
    """,
)
def numeric_vectors(spark, d):
    out = rows.numeric_examples(rows.split_records(_numeric_records(spark, d), ","))
    total = F.round(vector_sum("features"), 4).alias("total")
    return out.select("o_orderkey", "label", total)


BUCKET_SQL = "('0x' || substr(md5('234:' || {key}), 1, 8))::BIGINT"
NINE_TENTHS = round(0.9 * 2**32)


@query(
    "hash_split",
    f"""
    SELECT o_orderkey, (CASE WHEN {BUCKET_SQL.format(key='o_orderkey')} >= {NINE_TENTHS}
                             THEN 1 ELSE 0 END)::INTEGER AS part
    FROM orders
    """,
)
def hash_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    return split.hash_split(orders, "o_orderkey", [0.9, 0.1], 234)


@query(
    "hash_folds",
    f"""
    SELECT o_orderkey, ({BUCKET_SQL.format(key='o_orderkey')} % 5)::INTEGER AS fold FROM orders
    """,
)
def hash_folds(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    return split.hash_fold(orders, "o_orderkey", 5, 234)


def price_rule(spark, d):
    """Order status as class id, and a guess at it from the price."""
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("pos"),
        status.otherwise(2).alias("truth"),
        F.when(price < 100000, 0).when(price < 400000, 1).otherwise(2).alias("prediction"),
    )


RULE_SQL = f"""
    rule AS (SELECT o_orderkey AS pos, {STATUS_SQL} AS truth,
                    CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice < 400000 THEN 1
                         ELSE 2 END AS prediction
             FROM orders)"""


@query(
    "overall_accuracy",
    f"""
    WITH {RULE_SQL}
    SELECT (count(*) FILTER (truth = prediction)) AS correct, count(*) AS total,
           round((count(*) FILTER (truth = prediction)) / count(*), 6) AS accuracy
    FROM rule
    """,
)
def overall_accuracy(spark, d):
    return metrics.accuracy(price_rule(spark, d), "truth", "prediction").withColumn(
        "accuracy", F.round("accuracy", 6)
    )


CLASS_SQL = f"""
    WITH {RULE_SQL},
    hits AS (SELECT truth, count(*) AS total, count(*) FILTER (truth = prediction) AS hits,
                    min(pos) FILTER (truth = prediction) AS first_hit
             FROM rule GROUP BY truth),
    starts AS (SELECT *, CASE WHEN lag(truth) OVER (ORDER BY pos) = truth THEN 0 ELSE 1 END AS s
               FROM rule),
    runs AS (SELECT truth, sum(s) OVER (ORDER BY pos) AS run FROM starts),
    lengths AS (SELECT truth, run, count(*) AS n FROM runs GROUP BY ALL),
    last_run AS (SELECT truth, arg_max(n, run) AS size FROM lengths GROUP BY truth)
"""


@query(
    "class_accuracy",
    f"""
    {CLASS_SQL}
    SELECT (row_number() OVER (ORDER BY hits, first_hit))::INTEGER AS rank, truth, hits,
           total AS size, round(hits / total, 6) AS accuracy
    FROM hits WHERE hits > 0
    """,
)
def class_accuracy(spark, d):
    out = metrics.class_accuracy(price_rule(spark, d), "truth", "prediction", "pos")
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "class_accuracy_by_last_run",
    f"""
    {CLASS_SQL}
    SELECT (row_number() OVER (ORDER BY hits, first_hit))::INTEGER AS rank, truth, hits, size,
           round(hits / size, 6) AS accuracy
    FROM hits JOIN last_run USING (truth) WHERE hits > 0
    """,
)
def class_accuracy_by_last_run(spark, d):
    out = metrics.class_accuracy_by_last_run(price_rule(spark, d), "truth", "prediction", "pos")
    return out.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "weighted_f1",
    f"""
    WITH {RULE_SQL},
    c AS (SELECT truth AS k, count(*) AS size FROM rule GROUP BY 1),
    p AS (SELECT prediction AS k, count(*) AS predicted FROM rule GROUP BY 1),
    h AS (SELECT truth AS k, count(*) AS hits FROM rule WHERE truth = prediction GROUP BY 1)
    SELECT round(sum(size * 2.0 * coalesce(hits, 0) / (size + coalesce(predicted, 0))) / sum(size), 6)
           AS f1
    FROM c LEFT JOIN p USING (k) LEFT JOIN h USING (k)
    """,
)
def weighted_f1(spark, d):
    out = metrics.weighted_f1(price_rule(spark, d), "truth", "prediction")
    return out.select(F.round("f1", 6).alias("f1"))


@query(
    "confusion_matrix",
    f"WITH {RULE_SQL} SELECT truth AS label, prediction, count(*) AS n FROM rule GROUP BY ALL",
)
def confusion_matrix(spark, d):
    return metrics.confusion(price_rule(spark, d), "truth", "prediction")


PROFILED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "table_profile",
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
               round(stddev_samp({c}), 6) AS std, min({c}) AS min,
               round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
               round(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS max
        FROM lineitem
        """
        for c in PROFILED
    ),
)
def table_profile(spark, d):
    out = profile.describe(table(spark, d, "lineitem"), PROFILED)
    return out.select(
        "column", "count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min",
        F.round("q1", 6).alias("q1"), F.round("median", 6).alias("median"),
        F.round("q3", 6).alias("q3"), "max",
    )


@query(
    "box_plot_outliers",
    """
    WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    SELECT event_id, value FROM events, q
    WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)
    """,
)
def box_plot_outliers(spark, d):
    return profile.outliers(table(spark, d, "events").select("event_id", "value"), "value")


@query(
    "vector_statistics",
    """
    SELECT slot::INTEGER AS slot, count(*) AS count, round(avg(x), 5) AS mean,
           round(var_samp(x), 5) AS variance, round(max(x), 5) AS max, round(min(x), 5) AS min,
           round(sum(abs(x)), 4) AS norm_l1, (count(*) FILTER (x <> 0))::DOUBLE AS non_zeros
    FROM (SELECT generate_subscripts(embedding, 1) - 1 AS slot, unnest(embedding)::DOUBLE AS x
          FROM embeddings)
    GROUP BY slot
    """,
)
def vector_statistics(spark, d):
    vectors = table(spark, d, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    stats = profile.vector_statistics(vectors)
    per_slot = F.arrays_zip(
        *[
            vector_to_array(name).alias(name)
            for name in ("mean", "variance", "max", "min", "normL1", "numNonZeros")
        ]
    )
    return stats.select("count", F.posexplode(per_slot).alias("slot", "s")).select(
        "slot",
        "count",
        F.round("s.mean", 5).alias("mean"),
        F.round("s.variance", 5).alias("variance"),
        F.round("s.max", 5).alias("max"),
        F.round("s.min", 5).alias("min"),
        F.round("s.normL1", 4).alias("norm_l1"),
        F.col("s.numNonZeros").alias("non_zeros"),
    )


QUERIES = registry.queries
SQL = registry.sql
