"""Training, tuning, scoring and inspecting classifiers on the given tables."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import bayes, labels, metrics, rows, split
from ..plans import classifiers, scoring, training
from ..plans.documents import scoring_set, scoring_set_with_ids, training_set, training_set_with_ids
from ..plans.training import TrainingPlan
from ..sources import number_lines, read_results, shared_path, write_lines
from ..sources.scratch import materialise
from .registry import Registry, table
from .rows import BUCKET_SQL, NINE_TENTHS
from .text import SLOTS_SQL, TOKENS_SQL, document_words, documents, scoring_inputs, words_of

registry = Registry()
query = registry.add

SEED = 234


def labelled_words(spark, d):
    """``(pos, label, text, words, part)``: every document; part 0 is for training."""
    named = documents(spark, d, "lang").withColumnsRenamed({"doc_id": "pos", "lang": "label"})
    return split.hash_split(words_of(named), "pos", [0.9, 0.1], SEED)


def training_lines(spark, docs):
    """``word word ... label`` lines of part 0 in a file, a run per label, frequent labels first.

    Texts are put in order before they are cut into words, as a sort runs what is below it twice.
    """
    chosen = docs.where("part = 0").drop("words")
    model = labels.fit_label_index(chosen, "label", "_index")
    line = F.array_join(F.concat("words", F.array("label")), " ")
    path = shared_path(spark, "training-lines")
    write_lines(words_of(model.transform(chosen).orderBy("_index", "pos")), line, path)
    return number_lines(spark, path)


MODEL_SQL = f"""
    WITH {TOKENS_SQL},
    train AS (SELECT doc_id, lang FROM documents
              WHERE {BUCKET_SQL.format(key='doc_id')} < {NINE_TENTHS}),
    ttf AS (SELECT tf.* FROM tf SEMI JOIN train USING (doc_id)),
    vocab AS (SELECT word FROM ttf GROUP BY word HAVING count(*) >= 2
              ORDER BY sum(tf) DESC, word LIMIT 21000),
    cw AS (SELECT lang, word, sum(tf) AS n FROM ttf SEMI JOIN vocab USING (word) GROUP BY ALL),
    totals AS (SELECT lang, sum(n) + (SELECT count(*) FROM vocab) AS total FROM cw GROUP BY lang),
    sizes AS (SELECT lang, count(*) AS n FROM train GROUP BY lang),
    classes AS (SELECT lang, total,
                       ln((n + 1) / ((SELECT count(*) FROM train) + (SELECT count(*) FROM sizes))) AS prior,
                       row_number() OVER (ORDER BY n DESC, lang) - 1 AS label_id
                FROM sizes JOIN totals USING (lang))
"""

BAYES_SQL = f"""
    {MODEL_SQL},
    known AS (SELECT doc_id, word, tf FROM tf SEMI JOIN vocab USING (word)),
    hits AS (SELECT doc_id, c.lang,
                    sum(tf * ln((coalesce(cw.n, 0) + 1) / c.total)) AS gain
             FROM known CROSS JOIN classes c
             LEFT JOIN cw ON cw.word = known.word AND cw.lang = c.lang GROUP BY ALL),
    scores AS (SELECT d.doc_id, d.lang, c.lang AS prediction, c.label_id,
                      round(c.prior + coalesce(gain, 0), 6) AS score
               FROM documents d CROSS JOIN classes c
               LEFT JOIN hits h ON h.doc_id = d.doc_id AND h.lang = c.lang),
    best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, prediction) AS r
             FROM scores)
"""


@query(
    "bayes_predictions",
    f"""
    {BAYES_SQL}
    SELECT doc_id AS pos, lang AS label, prediction, round(score, 2) AS score FROM best WHERE r = 1
    """,
)
def bayes_predictions(spark, d):
    model = bayes.train_bayes(labelled_words(spark, d).where("part = 0"))
    placed = document_words(spark, d, "lang").withColumnsRenamed({"doc_id": "pos", "lang": "label"})
    out = bayes.score_bayes(model, placed, "pos", keep=("label",))
    return out.withColumn("score", F.round("score", 2))


def _train(spark, d, plan):
    """All documents, and a model of the prepared training lines."""
    docs = labelled_words(spark, d)
    lines = training_lines(spark, docs)
    if plan.label == "run":
        return docs, training.train(training_set_with_ids(lines)[0], plan)
    return docs, training.train(training_set(lines), plan)


@query(
    "train_bayes_counts_label_index",
    f"""
    {BAYES_SQL}
    SELECT doc_id AS pos, lang AS label, prediction AS "predictLabel" FROM best WHERE r = 1
    """,
)
def train_bayes_counts_label_index(spark, d):
    docs, model = _train(spark, d, TrainingPlan("nb", "counts", "index"))
    return scoring.score(model, docs).select("pos", "label", "predictLabel")


@query(
    "train_bayes_counts_run_label",
    f"""
    {BAYES_SQL}
    SELECT doc_id, lang AS label, label_id::DOUBLE AS prediction FROM best WHERE r = 1
    """,
)
def train_bayes_counts_run_label(spark, d):
    docs, model = _train(spark, d, TrainingPlan("nb", "counts", "run"))
    return scoring.score(model, docs).select(F.col("pos").alias("doc_id"), "label", "prediction")


def check_scores(scored, classes):
    """Is each prediction the most probable class, and do the classes' probabilities add to 1?"""
    p = vector_to_array("probability")
    total = F.aggregate(p, F.lit(0.0), lambda x, y: x + y)
    top = F.get(p, F.col("prediction").cast("int"))
    return (F.abs(total - 1) < 1e-6) & (F.size(p) == classes) & (top == F.array_max(p))


# A forest has no SQL twin: keys and labels are compared, that its output is a choice among classes,
# and that on rows it hasn't seen it closes at least half of the gap between the majority's F1 and 1.
FLOOR_SQL = f"""
    WITH parts AS (SELECT doc_id, lang, {BUCKET_SQL.format(key='doc_id')} < {NINE_TENTHS} AS train FROM documents),
    major AS (SELECT lang FROM parts WHERE train GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1),
    floors AS (SELECT count(*) AS n, count(*) FILTER (lang = (SELECT lang FROM major)) AS m FROM parts WHERE {{where}})
    SELECT {{columns}}, round({{share}} + (1 - {{share}}) * (m / n * 2.0 * m / (m + n)), 6) AS floor_f1, true AS above
    FROM parts, floors
"""
VALID_SQL = FLOOR_SQL.format(where="NOT train", share=0.5, columns="doc_id AS pos, lang AS label, true AS valid")


def class_names(docs):
    """Labels of part 0, frequent ones first, as both kinds of label numbers have them."""
    counts = docs.where("part = 0").groupBy("label").count()
    return [r["label"] for r in counts.orderBy(F.desc("count"), "label").collect()]


def floor_f1(truth, share):
    """So far from the weighted F1 of class 0 for every row towards 1, from a column ``truth``."""
    n, m = F.count(F.lit(1)), F.count_if(F.col("truth") == 0)
    return truth.agg((share + (1 - share) * (m / n * 2.0 * m / (m + n))).alias("f1")).scalar()


def _checked(spark, d, plan):
    docs, model = _train(spark, d, plan)
    names = class_names(docs)
    # an index keeps a class for labels it hasn't seen
    scored = model.transform(docs)
    valid = check_scores(scored, len(names) + (plan.label == "index"))
    truth = F.array_position(F.array(*map(F.lit, names)), F.col("label")) - 1
    rows = materialise(
        scored.select("pos", "label", "part", truth.alias("truth"), "prediction", valid.alias("valid")), "checked"
    )
    held = rows.where("part = 1")
    floor = floor_f1(held, 0.5)
    above = metrics.weighted_f1(held, "truth", "prediction").scalar() >= floor
    return rows.select("pos", "label", "valid", F.round(floor, 6).alias("floor_f1"), above.alias("above"))


@query(
    "train_bayes_tfidf_run_label",
    f"""
    {MODEL_SQL}, {SLOTS_SQL},
    counts AS (SELECT doc_id, lang, slot, sum(tf) AS tf FROM tf JOIN slots USING (word) GROUP BY ALL),
    dfs AS (SELECT slot, count(*) AS df FROM counts SEMI JOIN train USING (doc_id) GROUP BY slot),
    x AS (SELECT doc_id, lang, slot, tf * ln(((SELECT count(*) FROM train) + 1) / (coalesce(df, 0) + 1)) AS x
          FROM counts LEFT JOIN dfs USING (slot)),
    sums AS (SELECT lang, slot, sum(x) AS n FROM x SEMI JOIN train USING (doc_id) GROUP BY ALL),
    whole AS (SELECT lang, sum(n) + 21000 AS total FROM sums GROUP BY lang),
    gains AS (SELECT doc_id, c.lang, sum(x * ln((coalesce(n, 0) + 1) / w.total)) AS gain
              FROM x CROSS JOIN classes c JOIN whole w ON w.lang = c.lang
              LEFT JOIN sums s ON s.lang = c.lang AND s.slot = x.slot GROUP BY ALL),
    best AS (SELECT d.doc_id, d.lang, c.label_id,
                    row_number() OVER (PARTITION BY d.doc_id ORDER BY round(c.prior + coalesce(gain, 0), 6) DESC, c.label_id) AS r
             FROM documents d CROSS JOIN classes c LEFT JOIN gains g ON g.doc_id = d.doc_id AND g.lang = c.lang)
    SELECT doc_id AS pos, lang AS label, label_id::DOUBLE AS prediction FROM best WHERE r = 1
    """,
)
def train_bayes_tfidf_run_label(spark, d):
    docs, model = _train(spark, d, TrainingPlan("nb", "tfidf", "run"))
    return scoring.score(model, docs).select("pos", "label", "prediction")


@query("train_forest_counts_label_index", VALID_SQL)
def train_forest_counts_label_index(spark, d):
    return _checked(spark, d, TrainingPlan("rf", "counts", "index"))


@query("train_forest_counts_run_label", VALID_SQL)
def train_forest_counts_run_label(spark, d):
    return _checked(spark, d, TrainingPlan("rf", "counts", "run"))


@query("train_forest_tfidf_run_label", VALID_SQL)
def train_forest_tfidf_run_label(spark, d):
    return _checked(spark, d, TrainingPlan("rf", "tfidf", "run", trees=10, depth=15))


@query("forest_feature_importances", f"{MODEL_SQL} SELECT word, true AS valid FROM vocab")
def forest_feature_importances(spark, d):
    """Every word of the vocabulary; importances are at least 0 and add to 1."""
    _, model = _train(spark, d, TrainingPlan("rf", "counts", "index"))
    found = scoring.feature_importances(spark, model)
    total = found.agg(F.sum("importance")).scalar()
    return found.select("word", ((F.col("importance") >= 0) & (F.abs(total - 1) < 1e-6)).alias("valid"))


@query(
    "saved_model_predictions",
    "SELECT doc_id AS pos, true AS same FROM documents",
)
def saved_model_predictions(spark, d):
    """Does a model predict the same after it was saved and loaded?"""
    plan = TrainingPlan("nb", "counts", "index")
    docs, model = _train(spark, d, plan)
    path = training.save(model, plan, shared_path(spark, "models"))
    before = scoring.score(model, docs).select("pos", "words", F.col("prediction").alias("before"))
    again = training.load(path).stages[1:]
    both = PipelineModel(again).transform(before)
    return both.select("pos", (F.col("prediction") == F.col("before")).alias("same"))


KEYWORD_BAYES_SQL = f"""
    {MODEL_SQL},
    weighted AS (SELECT doc_id, word, first_pos, round(tf * coalesce(idf, 0), 6) AS tfidf
                 FROM tf LEFT JOIN idf USING (word) ANTI JOIN common USING (word)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, first_pos) AS rank
               FROM weighted),
    gains AS (SELECT doc_id, c.lang, sum(ln((coalesce(cw.n, 0) + 1) / c.total)) AS gain
              FROM ranked SEMI JOIN vocab USING (word) CROSS JOIN classes c
              LEFT JOIN cw ON cw.word = ranked.word AND cw.lang = c.lang
              WHERE rank <= 50 GROUP BY ALL),
    best AS (SELECT d.doc_id, t.label_id AS truth, c.label_id AS prediction,
                    row_number() OVER (PARTITION BY d.doc_id
                                       ORDER BY round(c.prior + coalesce(gain, 0), 6) DESC, c.label_id) AS r
             FROM documents d JOIN classes t USING (lang) CROSS JOIN classes c
             LEFT JOIN gains g ON g.doc_id = d.doc_id AND g.lang = c.lang),
    scored AS (SELECT * FROM best WHERE r = 1),
    sides AS (SELECT k, sum(size) AS size, sum(predicted) AS predicted, sum(hits) AS hits
              FROM (SELECT truth AS k, 1 AS size, 0 AS predicted, (truth = prediction)::INT AS hits FROM scored
                    UNION ALL SELECT prediction, 0, 1, 0 FROM scored) GROUP BY k),
    quality AS (SELECT round(sum(size * 2.0 * hits / (size + predicted)) / sum(size), 6) AS f1 FROM sides)
"""


def contract_set(spark, d):
    """``content^^label`` lines from a file, prepared with stop-words and the corpus's idf."""
    path = shared_path(spark, "contracts")
    lines, idf, stop = scoring_inputs(spark, d)
    write_lines(lines.orderBy("pos"), F.col("value"), path)
    return number_lines(spark, path), idf, stop


def live_job(spark, d, plan):
    """Train, save, load, prepare, score, write both files: the folder and F1."""
    _, model = _train(spark, d, plan)
    base = shared_path(spark, "job")
    saved = training.load(training.save(model, plan, base))
    rows = scoring_set(*contract_set(spark, d))
    return f"{base}/out", scoring.score_to_files(saved, rows, "indexedLabel", f"{base}/out"), saved


@query(
    "scoring_job",
    f"""
    {KEYWORD_BAYES_SQL}
    SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos,
           truth || '.0' || chr(9) || prediction || '.0' AS value, f1
    FROM scored, quality
    """,
)
def scoring_job(spark, d):
    """The lines of the prediction file, in order, and the F1 that the job returned."""
    path, f1, _ = live_job(spark, d, TrainingPlan("nb", "counts", "index"))
    return number_lines(spark, f"{path}/predictions").withColumn("f1", F.round(F.lit(f1), 6))


@query(
    "probability_lines",
    f"""
    {KEYWORD_BAYES_SQL},
    scores AS (SELECT d.doc_id, c.label_id, c.prior + coalesce(gain, 0) AS score
               FROM documents d CROSS JOIN classes c LEFT JOIN gains g ON g.doc_id = d.doc_id AND g.lang = c.lang),
    odds AS (SELECT *, exp(score - max(score) OVER (PARTITION BY doc_id)) AS odds FROM scores),
    shares AS (SELECT *, odds / sum(odds) OVER (PARTITION BY doc_id) AS p FROM odds)
    SELECT dense_rank() OVER (ORDER BY doc_id) - 1 AS pos, label_id::INTEGER AS class,
           round(score, 4) AS score, round(p, 6) AS probability FROM shares
    """,
)
def probability_lines(spark, d):
    """The lines of the probability file, in order, read back as numbers."""
    path, _, _ = live_job(spark, d, TrainingPlan("nb", "counts", "index"))
    lines = number_lines(spark, f"{path}/probabilities")

    def numbers(i):
        part = F.get(F.split("value", "\t\t"), i)
        return F.split(F.substring(part, 2, F.length(part) - 2), ",").cast("array<double>")

    both = F.arrays_zip(numbers(0).alias("score"), numbers(1).alias("probability"))
    return lines.select("pos", F.posexplode(both).alias("class", "x")).select(
        "pos", "class", F.round("x.score", 4).alias("score"), F.round("x.probability", 6).alias("probability")
    )


@query(
    "forest_scoring_job",
    FLOOR_SQL.format(
        where="true",
        share=0,
        columns="row_number() OVER (ORDER BY doc_id) - 1 AS pos, lang AS label, true AS known, true AS f1_agrees",
    ),
)
def forest_scoring_job(spark, d):
    """The same job with the forest: labels decoded from its file, F1 recomputed from it and above the majority's.

    It scores keywords without stop-words, on which it wasn't trained.
    """
    path, f1, model = live_job(spark, d, TrainingPlan("rf", "counts", "index"))
    names = scoring.stage_of(model, StringIndexerModel).labels
    found = read_results(spark, f"{path}/predictions")
    relational = metrics.weighted_f1(found, "truth", "prediction").scalar()
    decoded = F.get(F.array(*map(F.lit, names)), F.col("truth"))
    floor = floor_f1(found, 0)
    return found.select(
        "pos",
        decoded.alias("label"),
        F.col("prediction").between(0, len(names) - 1).alias("known"),
        (F.abs(relational - f1) < 1e-6).alias("f1_agrees"),
        F.round(floor, 6).alias("floor_f1"),
        (relational > floor).alias("above"),
    )


@query(
    "scoring_with_label_map",
    f"""
    {KEYWORD_BAYES_SQL}
    SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, truth::BIGINT AS label_id,
           prediction::DOUBLE AS prediction
    FROM scored
    """,
)
def scoring_with_label_map(spark, d):
    """A model on run ids scores lines whose ids come from the label map saved beside it."""
    plan = TrainingPlan("nb", "counts", "run")
    rows, mapping = training_set_with_ids(training_lines(spark, labelled_words(spark, d)))
    path = training.save(training.train(rows, plan), plan, shared_path(spark, "models"), mapping)
    lines, idf, stop = contract_set(spark, d)
    scored = scoring_set_with_ids(lines, idf, stop, training.load_label_map(spark, path))
    return training.load(path).transform(scored).select("pos", "label_id", "prediction")


def order_examples(spark, d):
    """Numeric records ``priority,price,customer,status`` as examples keyed by order."""
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
    line = F.concat_ws(
        ",",
        F.substring("o_orderpriority", 1, 1),
        "o_totalprice",
        "o_custkey",
        status.otherwise(2).cast("string"),
    )
    orders = table(spark, d, "orders")
    records = orders.select("o_orderkey", line.alias("value"))
    return rows.numeric_examples(rows.split_records(records, ","))


def _binary_examples(spark, d):
    finished = (F.col("label") == 0).cast("double")
    return order_examples(spark, d).withColumn("label", finished)


# At the optimum the intercept, which isn't penalised, makes the mean probability the share of ones.
LOGISTIC_SQL = """
    SELECT o_orderkey, (o_orderstatus = 'F')::INT::DOUBLE AS label, true AS fitted FROM orders
"""


def _fitted(scored, probability):
    """Labels, and is the mean probability of class 1 the share of class 1?"""
    positive = F.get(vector_to_array(probability), 1)
    means = scored.agg(F.abs(F.avg(positive) - F.avg("label")) < 1e-3).scalar()
    agrees = (positive > F.lit(0.5)).cast("double") == F.col("prediction")
    return means, positive, agrees


@query("logistic_regression", LOGISTIC_SQL)
def logistic_regression(spark, d):
    examples = _binary_examples(spark, d)
    scored = classifiers.fit_logistic(examples).transform(examples)
    means, _, agrees = _fitted(scored, "probability")
    return scored.select("o_orderkey", "label", (means & agrees).alias("fitted"))


@query("logistic_regression_overrides", LOGISTIC_SQL.replace("AS fitted", "AS fitted, true AS threshold_kept"))
def logistic_regression_overrides(spark, d):
    examples = _binary_examples(spark, d)
    overrides = {
        "maxIter": 30, "regParam": 0.1, "threshold": 0.55, "probabilityCol": "myProbability",
    }
    out = classifiers.fit_logistic(examples, overrides=overrides).transform(examples)
    means, positive, _ = _fitted(out, "myProbability")
    kept = (positive > 0.55).cast("double") == F.col("prediction")
    return out.select("o_orderkey", "label", means.alias("fitted"), kept.alias("threshold_kept"))


def _quality(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    quality = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return docs, docs.join(quality, "doc_id")


def _same(docs, first, second):
    """Do two models predict the same with the same probability?"""
    one = first.transform(docs).select("doc_id", "prediction", vector_to_array("probability").alias("p"))
    two = second.transform(docs).select(
        "doc_id", F.col("prediction").alias("prediction2"), vector_to_array("probability").alias("p2")
    )
    close = F.abs(F.get("p", 1) - F.get("p2", 1)) < 1e-9
    return one.join(two, "doc_id").select("doc_id", ((F.col("prediction") == F.col("prediction2")) & close).alias("same"))


SAME_SQL = "SELECT doc_id, true AS same FROM documents"


@query("text_classifier", SAME_SQL.replace("AS same", "AS same, true AS fitted"))
def text_classifier(spark, d):
    """Does the fitted chain predict the same after it was saved and loaded?"""
    docs, labelled = _quality(spark, d)
    fitted = classifiers.text_classifier().fit(labelled)
    path = shared_path(spark, "text-classifier")
    fitted.write().overwrite().save(path)
    same = _same(docs, fitted, PipelineModel.load(path))
    # at the optimum the mean probability is the share of ones, whatever the features
    best = classifiers.text_classifier(features=50, max_iter=500).fit(labelled).transform(labelled)
    fits, _, _ = _fitted(best, "probability")
    return same.withColumn("fitted", fits)


@query("unfitted_stages", SAME_SQL)
def unfitted_stages(spark, d):
    """Does a chain that was saved and loaded before fitting predict as one that never was?"""
    path = shared_path(spark, "unfitted")
    chain = classifiers.text_classifier(features=20)
    chain.write().overwrite().save(path)
    docs, labelled = _quality(spark, d)
    labelled = labelled.repartition(4, "doc_id").sortWithinPartitions("doc_id")
    return _same(docs, chain.fit(labelled), Pipeline.load(path).fit(labelled))


# The label is a function of the first feature, so every prediction is known.
TREE_SQL = f"""
    WITH priority AS (SELECT o_orderkey, substr(o_orderpriority, 1, 1)::INT % 3 AS label FROM orders
                      WHERE {BUCKET_SQL.format(key='o_orderkey')} >= {NINE_TENTHS})
    SELECT o_orderkey, label, label::DOUBLE AS prediction FROM priority
"""


def _priority_examples(spark, d):
    first = F.get(vector_to_array("features"), 0).cast("int")
    return order_examples(spark, d).withColumn("label", F.pmod(first, F.lit(3)))


@query("decision_tree", TREE_SQL)
def decision_tree(spark, d):
    run = classifiers.train_tree(_priority_examples(spark, d), "o_orderkey")
    return run.scored.select("o_orderkey", "label", "prediction")


@query("tuned_decision_tree", TREE_SQL.replace("AS prediction", "AS prediction, true AS depth_allowed"))
def tuned_decision_tree(spark, d):
    run = classifiers.tune_tree(_priority_examples(spark, d), "o_orderkey")
    allowed = F.lit(classifiers.chosen_depth(run) <= 6).alias("depth_allowed")
    return run.scored.select("o_orderkey", "label", "prediction", allowed)


QUERIES = registry.queries
SQL = registry.sql
