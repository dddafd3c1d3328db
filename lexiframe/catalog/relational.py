"""Classifiers grown and fitted by aggregates, compared with SQL prediction by prediction."""

from pyspark.sql import Window, functions as F

from ..operators import bayes, logistic, split, terms, trees
from ..operators.trees import Growth
from ..sources.scratch import materialise
from .registry import Registry, table
from .rows import BUCKET_SQL, NINE_TENTHS
from .text import TOKENS_SQL, corpus_words, document_words

registry = Registry()
query = registry.add

SEED = 234


def _is_in(feature, categories):
    return f"{feature} IN ({', '.join(map(str, sorted(categories)))})" if categories else "false"


def growth_sql(g: Growth) -> str:
    """CTEs ``p<depth>`` (tree, key, label, w, node), ``leaves`` and ``gains`` from ``examples`` and ``entries``.

    ``examples`` has key, label, train; ``entries`` has key, feature, bin.
    """
    if g.impurity == "gini":
        def c(x):
            return f"({x}) * ({x})"

        gain = "rgt::DOUBLE / n::DOUBLE + (whole + lft)::DOUBLE / (size - n)::DOUBLE - whole::DOUBLE / size::DOUBLE"
    else:
        def c(x):
            return f"(CASE WHEN ({x}) > 0 THEN round(({x})::DOUBLE * ln(({x})::DOUBLE) * 1000000)::BIGINT ELSE 0 END)"

        gain = f"(rgt - {c('n')})::DOUBLE + (whole + lft - {c('size - n')})::DOUBLE - (whole - {c('size')})::DOUBLE"
    least = "1e-9" if g.impurity == "gini" else "0.5"
    drawn = f"('0x' || substr(md5('{g.seed}:' || tree || ':' || key), 1, 8))::BIGINT"
    weight = " + ".join(f"({drawn} >= {edge})::INT" for edge in trees.POISSON) if g.bagged else "1"
    tried = f"('0x' || substr(md5('{g.seed}:' || tree || ':' || node || ':' || feature), 1, 8))::BIGINT < {round(g.share * 2**32)}"
    category = _is_in("feature", g.categories)
    parts = [
        f"p0 AS (SELECT tree, key, label, 1 AS node, CASE WHEN train THEN {weight} ELSE 0 END AS w "
        f"FROM examples, range({g.trees}) AS r(tree))"
    ]
    for d in range(g.depth + 1):
        parts.append(f"""t{d} AS (SELECT tree, node, label, sum(w)::BIGINT AS t FROM p{d}
            WHERE w > 0 AND node >= {1 << d} GROUP BY ALL),
        m{d} AS (SELECT tree, node, label AS major FROM t{d}
            QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY t DESC, label) = 1)""")
        if d == g.depth:
            break
        parts.append(f"""s{d} AS (SELECT tree, node, feature, bin, label, sum(w)::BIGINT AS n FROM p{d} JOIN entries USING (key)
            WHERE w > 0 AND node >= {1 << d} AND {tried if g.share < 1 else 'true'} GROUP BY ALL),
        o{d} AS (SELECT tree, node, feature, bin, CASE WHEN {category}
                     THEN row_number() OVER (PARTITION BY tree, node, feature ORDER BY hits / total DESC, bin) ELSE bin END AS place
            FROM (SELECT tree, node, feature, bin, sum(CASE WHEN label = major THEN n ELSE 0 END)::DOUBLE AS hits,
                         sum(n)::DOUBLE AS total FROM s{d} JOIN m{d} USING (tree, node) GROUP BY ALL)),
        w{d} AS (SELECT tree, node, sum(t)::BIGINT AS size, sum({c('t')})::BIGINT AS whole FROM t{d} GROUP BY ALL),
        r{d} AS (SELECT s{d}.*, place, t, sum(n) OVER (PARTITION BY tree, node, feature, label ORDER BY place DESC)::BIGINT AS r
            FROM s{d} JOIN o{d} USING (tree, node, feature, bin) JOIN t{d} USING (tree, node, label)),
        c{d} AS (SELECT tree, node, feature, place, sum(n)::BIGINT AS n, sum({c('r')} - {c('r - n')})::BIGINT AS rgt,
                        sum({c('t - r')} - {c('t - r + n')})::BIGINT AS lft FROM r{d} GROUP BY ALL),
        u{d} AS (SELECT tree, node, feature, place, (sum(n) OVER up)::BIGINT AS n, (sum(rgt) OVER up)::BIGINT AS rgt,
                        (sum(lft) OVER up)::BIGINT AS lft
            FROM c{d} WINDOW up AS (PARTITION BY tree, node, feature ORDER BY place DESC)),
        g{d} AS (SELECT tree, node, feature, place, {gain} AS gain FROM u{d} JOIN w{d} USING (tree, node) WHERE n < size),
        b{d} AS (SELECT * FROM g{d} WHERE gain > {least}
            QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, feature, place) = 1),
        p{d + 1} AS (SELECT p.tree, p.key, p.label, p.w, CASE WHEN b.feature IS NULL THEN p.node
                     ELSE 2 * p.node + (CASE WHEN {_is_in('b.feature', g.categories)} THEN coalesce(o.place, 0)
                                        ELSE coalesce(e.bin, 0) END >= b.place)::INT END AS node
            FROM p{d} p LEFT JOIN b{d} b ON b.tree = p.tree AND b.node = p.node
            LEFT JOIN entries e ON e.key = p.key AND e.feature = b.feature
            LEFT JOIN o{d} o ON o.tree = p.tree AND o.node = p.node AND o.feature = b.feature AND o.bin = e.bin)""")
    levels = range(g.depth + 1)
    parts.append("leaves AS (" + " UNION ALL ".join(f"SELECT * FROM m{d}" for d in levels) + ")")
    parts.append("gains AS (" + " UNION ALL ".join(f"SELECT tree, feature, gain FROM b{d}" for d in levels[:-1]) + ")")
    return ",\n".join(parts)


VOTES_SQL = """
    votes AS (SELECT key, p.label, major, count(*) AS n FROM p{depth} p JOIN leaves USING (tree, node) GROUP BY ALL),
    chosen AS (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, major) = 1)
"""

# Two of five priorities have a price rule, the others the status, which the features don't tell.
RULE = "CASE WHEN substr(o_orderpriority, 1, 1) IN ('2', '5') THEN CASE WHEN o_totalprice < 120000 THEN 'low' WHEN o_custkey % 7 = 0 THEN o_orderstatus ELSE 'high' END ELSE o_orderstatus END"

ORDER_TREE = Growth(depth=4, impurity="entropy", categories=frozenset([0]))

ORDER_TREE_SQL = f"""
    WITH ends AS (SELECT min(o_totalprice) AS p0, max(o_totalprice) AS p1, min(o_custkey)::DOUBLE AS c0,
                         max(o_custkey)::DOUBLE AS c1 FROM orders),
    examples AS (SELECT o_orderkey AS key, {RULE} AS label,
                        {BUCKET_SQL.format(key='o_orderkey')} < {NINE_TENTHS} AS train FROM orders),
    entries AS (
        SELECT o_orderkey AS key, 0 AS feature, substr(o_orderpriority, 1, 1)::INT AS bin FROM orders UNION ALL
        SELECT o_orderkey, 1, least(floor((o_totalprice - p0) / (p1 - p0) * 20), 19)::INT + 1 FROM orders, ends UNION ALL
        SELECT o_orderkey, 2, least(floor((o_custkey::DOUBLE - c0) / (c1 - c0) * 20), 19)::INT + 1 FROM orders, ends),
    {growth_sql(ORDER_TREE)},
    {VOTES_SQL.format(depth=ORDER_TREE.depth)}
    SELECT key AS o_orderkey, label, major AS prediction FROM chosen
"""


@query("statistics_tree", ORDER_TREE_SQL)
def statistics_tree(spark, d):
    """A tree on a category and two binned numbers, fitted on nine tenths, and what it says of all orders."""
    orders = table(spark, d, "orders").withColumn("label", F.expr(RULE))
    binned = trees.equal_bins(orders, ["o_totalprice", "o_custkey"], 20)
    # the category is feature 0, the numbers are 1 and 2
    shifted = F.transform_keys("bins", lambda k, _: k + 1)
    first = F.create_map(F.lit(0), F.substring("o_orderpriority", 1, 1).cast("int"))
    rows = binned.select(F.col("o_orderkey").alias("key"), "label", F.map_concat(first, shifted).alias("bins"))
    stored = materialise(split.hash_split(rows, "key", [0.9, 0.1], SEED), "tree-rows")
    forest = trees.grow(stored.where("part = 0"), ORDER_TREE)
    return trees.vote(stored, forest).select(F.col("key").alias("o_orderkey"), "label", "prediction")


WORDS = 400
WORD_FOREST = Growth(trees=5, depth=3, share=0.05, bagged=True)

WORD_FOREST_SQL = f"""
    WITH {TOKENS_SQL},
    examples AS (SELECT doc_id AS key, lang AS label, {BUCKET_SQL.format(key='doc_id')} < {NINE_TENTHS} AS train FROM documents),
    vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS feature
              FROM (SELECT word, sum(tf) AS n FROM tf JOIN examples ON key = doc_id WHERE train
                    GROUP BY word HAVING count(*) >= 2 ORDER BY n DESC, word LIMIT {WORDS})),
    entries AS (SELECT doc_id AS key, feature, least(tf, 3)::INT AS bin FROM tf JOIN vocab USING (word)),
    {growth_sql(WORD_FOREST)}
"""


def _word_rows(spark, d):
    """``(key, label, bins, part)`` of all documents, and the words by feature."""
    words = corpus_words(spark, d, "lang").withColumnRenamed("doc_id", "key")
    train = split.hash_split(words, "key", [0.9, 0.1], SEED).where("part = 0")
    found = terms.vocabulary(train, size=WORDS)
    # one window over the vocabulary, which is bounded
    by_count = Window.orderBy(F.desc("n"), "word")
    vocabulary = materialise(found.select("word", (F.row_number().over(by_count) - 1).alias("feature")), "forest-words")
    placed = document_words(spark, d, "lang").withColumnRenamed("doc_id", "key")
    rows = trees.word_bins(placed, vocabulary, "key", keep=("lang",)).withColumnRenamed("lang", "label")
    return materialise(split.hash_split(rows, "key", [0.9, 0.1], SEED), "forest-rows"), vocabulary


@query(
    "statistics_forest",
    f"""
    {WORD_FOREST_SQL},
    {VOTES_SQL.format(depth=WORD_FOREST.depth)}
    SELECT key AS doc_id, label, major AS prediction FROM chosen
    """,
)
def statistics_forest(spark, d):
    """Trees on word counts, bags and features drawn by digests; what most of them say of each document."""
    rows, _ = _word_rows(spark, d)
    forest = trees.grow(rows.where("part = 0"), WORD_FOREST)
    return trees.vote(rows, forest).select(F.col("key").alias("doc_id"), "label", "prediction")


@query(
    "statistics_forest_importances",
    f"""
    {WORD_FOREST_SQL},
    shares AS (SELECT tree, feature, gain / sum(gain) OVER (PARTITION BY tree) AS share FROM gains)
    SELECT word, round(sum(share) / (SELECT count(DISTINCT tree) FROM gains), 6) AS importance
    FROM shares JOIN vocab USING (feature) GROUP BY word
    """,
)
def statistics_forest_importances(spark, d):
    """The words that the forest uses, with their share in the gains."""
    rows, vocabulary = _word_rows(spark, d)
    found = trees.importances(trees.grow(rows.where("part = 0"), WORD_FOREST))
    # at most one feature for each split
    shares = spark.createDataFrame(list(found.items()), "feature int, importance double")
    return vocabulary.join(F.broadcast(shares), "feature").select("word", F.round("importance", 6).alias("importance"))


SMOOTHINGS = (0.01, 1.0, 30.0)

TUNED_SQL = f"""
    WITH {TOKENS_SQL},
    docs AS (SELECT doc_id, lang, {BUCKET_SQL.format(key='doc_id')} % 3 AS fold FROM documents),
    vocab AS (SELECT word FROM freq WHERE df >= 2 ORDER BY n DESC, word LIMIT 21000),
    known AS (SELECT tf.doc_id, tf.lang, word, tf, fold FROM tf SEMI JOIN vocab USING (word) JOIN docs USING (doc_id)),
    folds AS (SELECT unnest(range(3)) AS f),
    grid AS (SELECT unnest([{', '.join(map(str, SMOOTHINGS))}])::DOUBLE AS s),
    others AS (SELECT f, lang, word, sum(tf) AS m FROM known JOIN folds ON fold <> f GROUP BY ALL),
    words AS (SELECT f, lang, sum(m) AS t FROM others GROUP BY ALL),
    sizes AS (SELECT f, lang, count(*) AS d FROM docs JOIN folds ON fold <> f GROUP BY ALL),
    classes AS (SELECT f, lang, s, d, t, ln((d + s) / (sum(d) OVER (PARTITION BY f, s) + count(*) OVER (PARTITION BY f, s) * s)) AS prior,
                       ln(s) - ln(t + s * (SELECT count(*) FROM vocab)) AS slope
                FROM sizes JOIN words USING (f, lang), grid),
    lengths AS (SELECT d.doc_id, d.lang AS truth, d.fold AS f, coalesce(sum(tf), 0) AS size
                FROM docs d LEFT JOIN known USING (doc_id) GROUP BY ALL),
    gains AS (SELECT k.doc_id, o.lang, s, sum(tf * (ln(m + s) - ln(s))) AS gain
              FROM known k JOIN others o ON o.word = k.word AND o.f = k.fold, grid GROUP BY ALL),
    scores AS (SELECT l.doc_id, f, truth, c.lang, c.s, round(prior + slope * size + coalesce(gain, 0), 6) AS score
               FROM lengths l JOIN classes c USING (f) LEFT JOIN gains g ON g.doc_id = l.doc_id AND g.lang = c.lang AND g.s = c.s),
    best AS (SELECT f, s, truth, lang AS prediction FROM scores
             QUALIFY row_number() OVER (PARTITION BY doc_id, s ORDER BY score DESC, lang) = 1),
    sides AS (SELECT f, s, k, sum(size) AS size, sum(taken) AS taken, sum(hits) AS hits
              FROM (SELECT f, s, truth AS k, 1 AS size, 0 AS taken, (truth = prediction)::INT AS hits FROM best
                    UNION ALL SELECT f, s, prediction, 0, 1, 0 FROM best) GROUP BY ALL),
    quality AS (SELECT f, s, sum(size * 2.0::DOUBLE * hits / (size + taken)) / sum(size) AS f1 FROM sides GROUP BY ALL),
    chosen AS (SELECT s FROM quality GROUP BY s ORDER BY round(avg(f1), 6) DESC, s LIMIT 1)
    SELECT s AS smoothing, f::INTEGER AS fold, round(f1, 6) AS f1, s = (SELECT s FROM chosen) AS is_chosen FROM quality
"""


@query("tuned_bayes", TUNED_SQL)
def tuned_bayes(spark, d):
    """F1 of each fold for each smoothing, from one count by class and fold, and the smoothing to take."""
    words = document_words(spark, d, "lang").withColumnRenamed("lang", "label")
    folds = split.hash_fold(words, "doc_id", 3, SEED)
    scores = materialise(bayes.tune_bayes(folds, "doc_id", smoothings=SMOOTHINGS), "tuned")
    chosen = F.lit(bayes.best_smoothing(scores))
    return scores.select("smoothing", "fold", F.round("f1", 6).alias("f1"), (F.col("smoothing") == chosen).alias("is_chosen"))


# The rule holds for four orders in five; the others go by the customer.
POINTS_SQL = """
    points AS (SELECT o_orderkey, o_totalprice / 100000 AS x1, (o_custkey % 10)::DOUBLE / 10 AS x2,
                      CASE WHEN o_orderkey % 5 = 0 THEN (o_custkey % 2)::DOUBLE
                           ELSE (o_totalprice / 100000 + (o_custkey % 10)::DOUBLE / 10 > 2)::INT::DOUBLE END AS y FROM orders)
"""
STEPS = 4


def newton_sql(steps: int, reg: float) -> str:
    """CTEs ``w0`` to ``w<steps>`` with the coefficients b0, b1, b2 after each step, by Cramer's rule."""
    parts = ["w0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"]
    for k in range(steps):
        parts.append(f"""p{k} AS (SELECT x1, x2, y, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM points, w{k}),
        h{k} AS (SELECT avg(y - p) AS g0, avg((y - p) * x1) - {reg} * any_value(b1) AS g1, avg((y - p) * x2) - {reg} * any_value(b2) AS g2,
                        avg(p * (1 - p)) AS a, avg(p * (1 - p) * x1) AS b, avg(p * (1 - p) * x2) AS c,
                        avg(p * (1 - p) * x1 * x1) + {reg} AS d, avg(p * (1 - p) * x1 * x2) AS e, avg(p * (1 - p) * x2 * x2) + {reg} AS f
                 FROM p{k}, w{k}),
        q{k} AS (SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS det FROM h{k}),
        w{k + 1} AS (SELECT b0 + (g0 * (d * f - e * e) - b * (g1 * f - e * g2) + c * (g1 * e - d * g2)) / det AS b0,
                            b1 + (a * (g1 * f - e * g2) - g0 * (b * f - e * c) + c * (b * g2 - g1 * c)) / det AS b1,
                            b2 + (a * (d * g2 - g1 * e) - b * (b * g2 - g1 * c) + g0 * (b * e - d * c)) / det AS b2 FROM q{k}, w{k})""")
    return ",\n".join(parts)


def _points(spark, d):
    x1, x2 = F.col("o_totalprice") / 100000, (F.col("o_custkey") % 10).cast("double") / 10
    rule = F.when(F.col("o_orderkey") % 5 == 0, (F.col("o_custkey") % 2).cast("double")).otherwise((x1 + x2 > 2).cast("double"))
    return table(spark, d, "orders").select("o_orderkey", x1.alias("x1"), x2.alias("x2"), rule.alias("y"))


@query(
    "newton_coefficients",
    f"""
    WITH {POINTS_SQL}, {newton_sql(STEPS, 0.01)}
    SELECT unnest(['intercept', 'x1', 'x2']) AS feature, round(unnest([b0, b1, b2]), 6) AS coefficient FROM w{STEPS}
    """,
)
def newton_coefficients(spark, d):
    """Coefficients after a fixed number of Newton steps with a penalty."""
    model = logistic.fit(_points(spark, d), ("x1", "x2"), "y", reg=0.01, steps=STEPS, tolerance=0.0)
    names = (logistic.INTERCEPT, *model.features)
    rows = spark.createDataFrame(list(zip(names, model.coefficients)), "feature string, coefficient double")
    return rows.select("feature", F.round("coefficient", 6).alias("coefficient"))


@query(
    "newton_predictions",
    f"""
    WITH {POINTS_SQL}, {newton_sql(8, 0.1)}
    SELECT o_orderkey, y AS label, round(1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))), 5) AS "myProbability",
           (1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) > 0.55)::INT::DOUBLE AS prediction FROM points, w8
    """,
)
def newton_predictions(spark, d):
    """Probabilities and predictions at convergence, with a threshold and a column name of the caller."""
    points = _points(spark, d)
    model = logistic.fit(points, ("x1", "x2"), "y", reg=0.1)
    scored = logistic.score(points, model, threshold=0.55, probability_col="myProbability")
    return scored.select("o_orderkey", F.col("y").alias("label"), F.round("myProbability", 5).alias("myProbability"), "prediction")


QUERIES = registry.queries
SQL = registry.sql
