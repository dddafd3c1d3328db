"""Multinomial naive Bayes as joins and aggregates, for any number of classes.

The model MLlib fits on count features, kept as long tables: a row for each word with the
classes it occurs in, and a row for each class. A document's score in class c is

    prior(c) + L ln s - L ln(T(c) + s V) + sum of tf (ln(n(c, w) + s) - ln s)

with s the smoothing, L its words of the vocabulary, V the vocabulary's size, T(c) the class's
words, and the sum over its words that occur in c. So a document meets only the classes that
it shares a word with. What the others score depends on L alone; the best of them is read off
the upper envelope of one line for each class.

Tuning counts each word by class and fold once. What a fold's model is trained on is the
total less the fold.
"""

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import materialise
from .lookup import lookup_join
from .terms import MIN_DOCUMENTS, VOCABULARY_SIZE, term_counts, vocabulary

#: Scores are compared to so many places; equal ones go to the first label.
PLACES = 6
#: Sums (for each class, in tuning for each class and smoothing) that a document's row holds as columns; with
#: more, each pair of a document and a class is a row.
FEW_SUMS = 16


@dataclass(frozen=True)
class Line:
    """``intercept + slope L`` for the class ``label``."""

    label: str
    intercept: float
    slope: float


def upper_envelope(lines: list[Line]) -> list[tuple[int, Line]]:
    """``(from, line)``: the highest line for whole L >= 0, of equal lines the one of the first label."""
    best: dict[float, Line] = {}
    for line in sorted(lines, key=lambda x: (x.slope, -x.intercept, x.label)):
        best.setdefault(line.slope, line)
    hull: list[tuple[float, Line]] = []
    for line in best.values():
        start = 0.0
        while hull:
            since, other = hull[-1]
            start = (other.intercept - line.intercept) / (line.slope - other.slope)
            if start > since:
                break
            hull.pop()
            start = 0.0
        hull.append((max(start, 0.0), line))
    # the first whole L at which a line is ahead
    found = [(0 if not i else int(start) + 1, line) for i, (start, line) in enumerate(hull)]
    return [x for i, x in enumerate(found) if i + 1 == len(found) or found[i + 1][0] > x[0]]


@dataclass
class BayesTable:
    """``words`` holds ``word, classes``, an array of ``(label, gain)`` where the word occurs.

    ``classes`` holds ``label, intercept, slope``: a class's score of L words none of which
    occur in it. ``others`` is the envelope of these lines.
    """

    classes: DataFrame
    words: DataFrame
    others: list[tuple[int, Line]]


def class_priors(df: DataFrame, label: str = "label", smoothing: float = 1.0) -> DataFrame:
    """``(label, prior)`` with ``ln((n + s) / (N + K s))``."""
    sizes = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n") + F.count(F.lit(1)) * smoothing).scalar()
    return sizes.select("label", F.ln((F.col("n") + smoothing) / total).alias("prior"))


def class_words(df: DataFrame, label: str, words: str, size: int, min_df: int, extra: tuple = ()) -> DataFrame:
    """``(word, *extra, label, n)`` for the ``size`` most frequent words; stored.

    The vocabulary comes first, from one count for each word. Only its words are counted by class, so
    rare words are neither moved nor stored for each class they occur in.
    """
    chosen = materialise(vocabulary(df, words, size, min_df).select("word", "n"), "class-vocabulary")
    rows = df.select(F.col(label).alias("label"), *extra, F.explode(words).alias("word"))
    frequent = chosen.orderBy(F.desc("n"), "word").select("word")
    known = lookup_join(rows, chosen.select("word"), "word", "inner", frequent=frequent)
    return materialise(known.groupBy("word", *extra, "label").agg(F.count(F.lit(1)).alias("n")), "class-words")


def train_bayes(
    df: DataFrame,
    label: str = "label",
    words: str = "words",
    size: int = VOCABULARY_SIZE,
    min_df: int = MIN_DOCUMENTS,
    smoothing: float = 1.0,
) -> BayesTable:
    """Count the vocabulary's words per class and smooth; class labels, as text, go through the driver.

    Rows without a label are left out.
    """
    known = df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("string"))
    counts = class_words(known, label, words, size, min_df)
    v = counts.agg(F.count_distinct("word")).first()[0]
    totals = counts.groupBy("label").agg(F.sum("n").alias("t"))
    slope = F.lit(log(smoothing)) - F.ln(F.coalesce("t", F.lit(0)) + F.lit(smoothing * max(v, 1)))
    classes = materialise(
        class_priors(known, label, smoothing).join(totals, "label", "left")
        .select(F.col("label").cast("string"), F.col("prior").alias("intercept"), slope.alias("slope")),
        "bayes-classes",
    )
    gain = F.ln(F.col("n") + smoothing) - F.lit(log(smoothing))
    entries = counts.groupBy("word").agg(F.collect_list(F.struct("label", gain.alias("gain"))).alias("classes"))
    lines = [Line(r["label"], r["intercept"], r["slope"]) for r in classes.collect()]
    return BayesTable(classes, materialise(entries, "bayes"), upper_envelope(lines))


def _other(others: list[tuple[int, Line]], size: Column) -> Column:
    """``(label, score)`` of the best class that shares no word, for so many words."""
    cases = [
        F.when(size >= since, F.struct(F.lit(x.label).alias("label"), (F.lit(x.intercept) + F.lit(x.slope) * size).alias("score")))
        for since, x in reversed(others)
    ]
    return F.coalesce(*cases)


def _highest(scores: Column) -> Column:
    """The highest of ``(label, score)`` pairs after rounding; of equal ones the first label."""
    rounded = F.transform(scores, lambda x: F.struct((-F.round(x["score"], PLACES)).alias("minus"), x["label"].alias("label")))
    return F.array_min(rounded)


def _of_few(model: BayesTable, lines: list, counts: DataFrame, id_col: str, keep: tuple) -> DataFrame:
    """``(id, *keep, _best)`` with the sums of all classes in the row of a document."""
    gains = F.map_from_entries("classes")
    entries = model.words.select(
        "word", F.lit(1.0).alias("_known"),
        *(F.coalesce(F.element_at(gains, F.lit(x["label"])), F.lit(0.0)).alias(f"_g{i}") for i, x in enumerate(lines)),
    )
    names = ["_known", *(f"_g{i}" for i in range(len(lines)))]
    sums = lookup_join(counts, entries, "word").groupBy(id_col, *keep).agg(
        *(F.coalesce(F.sum(F.col("tf") * F.col(name)), F.lit(0.0)).alias(name) for name in names)
    )
    scores = F.array(*(
        F.struct(F.lit(x["label"]).alias("label"), (x["intercept"] + x["slope"] * F.col("_known") + F.col(f"_g{i}")).alias("score"))
        for i, x in enumerate(lines)
    ))
    return sums.withColumn("_best", _highest(scores))


def score_bayes(
    model: BayesTable, df: DataFrame, id_col: str, words: str = "words", keep: tuple = ()
) -> DataFrame:
    """``(id, *keep, prediction, score)``: the best class of each document.

    Scores are rounded to six places; equal ones go to the first label. A model without
    classes predicts null.
    """
    counts = term_counts(df, id_col, words, keep)
    best = [F.col("_best.label").alias("prediction"), (-F.col("_best.minus")).alias("score")]
    lines = model.classes.limit(FEW_SUMS + 1).collect()
    if 0 < len(lines) <= FEW_SUMS:
        return _of_few(model, lines, counts, id_col, keep).select(id_col, *keep, *best)
    rows = lookup_join(counts, model.words, "word")
    # a pair without a class counts the words of the vocabulary
    entries = F.concat(
        F.array(F.struct(F.lit(None).cast("string").alias("_class"), F.lit(1.0).alias("_gain"))),
        F.transform("classes", lambda x: F.struct(x["label"].alias("_class"), x["gain"].alias("_gain"))),
    )
    each = rows.select(id_col, *keep, "tf", F.inline_outer(F.when(F.col("classes").isNotNull(), entries)))
    sums = each.groupBy(id_col, *keep, "_class").agg(F.sum(F.col("tf") * F.col("_gain")).alias("sum"))
    sums = lookup_join(sums, model.classes.withColumnRenamed("label", "_class"), "_class")
    found = sums.groupBy(id_col, *keep).agg(
        F.coalesce(F.max(F.when(F.col("_class").isNull(), F.col("sum"))), F.lit(0.0)).alias("_size"),
        F.collect_list(F.when(F.col("_class").isNotNull(), F.struct("_class", "sum", "intercept", "slope"))).alias("_shared"),
    )
    if not model.others:
        return found.select(id_col, *keep, F.lit(None).cast("string").alias("prediction"), F.lit(None).cast("double").alias("score"))
    scores = F.transform(
        "_shared",
        lambda x: F.struct(x["_class"].alias("label"), (x["intercept"] + x["slope"] * F.col("_size") + x["sum"]).alias("score")),
    )
    highest = _highest(F.concat(scores, F.array(_other(model.others, F.col("_size")))))
    return found.withColumn("_best", highest).select(id_col, *keep, *best)


def _left_out(docs: DataFrame, entries: DataFrame, lines: list, classes: list, smoothings: tuple, folds: int, id_col: str) -> DataFrame:
    """``(at, fold, label, prediction)`` of every document, its sums for all classes and smoothings in one row."""
    grid = [(i, s, j, c) for i, s in enumerate(smoothings) for j, c in enumerate(classes)]
    # the classes of a word by place: counts without each fold
    lefts = entries.select(
        "word", F.lit(1).alias("_known"),
        *(F.element_at(F.map_from_entries("classes"), F.lit(c)).alias(f"_l{j}") for j, c in enumerate(classes)),
    )
    numbered = docs.where(F.col("fold") >= 0)
    rows = lookup_join(term_counts(numbered, id_col, "words", ("fold", "label")), lefts, "word")
    gain = lambda j, s: F.ln(F.get(f"_l{j}", F.col("fold")) + s) - F.lit(log(s))
    sums = rows.groupBy(id_col, "fold", "label").agg(
        F.coalesce(F.sum(F.col("tf") * F.col("_known")), F.lit(0)).alias("size"),
        *(F.coalesce(F.sum(F.col("tf") * gain(j, s)), F.lit(0.0)).alias(f"g{i}_{j}") for i, s, j, _ in grid),
    )
    line = {(f, at, c): (intercept, slope) for f, at, c, intercept, slope in lines}

    def minus(i, j, c):
        intercept, slope = (F.get(F.array(*(F.lit(line[f, i, c][k]) for f in range(folds))), F.col("fold")) for k in (0, 1))
        return (-F.round(intercept + slope * F.col("size") + F.col(f"g{i}_{j}"), PLACES)).alias("minus")

    best = F.array(*(
        F.struct(
            F.lit(i).alias("at"),
            F.array_min(F.array(*(F.struct(minus(i, j, c), F.lit(c).alias("class")) for j, c in enumerate(classes))))["class"].alias("prediction"),
        )
        for i in range(len(smoothings))
    ))
    return sums.select("fold", "label", F.inline(best))


def _left_out_of_many(docs: DataFrame, entries: DataFrame, lines: DataFrame, smoothings: tuple, id_col: str) -> DataFrame:
    """The same with a row for each document, class and smoothing."""
    rows = lookup_join(term_counts(docs, id_col, "words", ("fold", "label")), entries, "word")
    known = F.sum(F.when(F.col("classes").isNotNull(), F.col("tf")).otherwise(0))
    size_of = rows.groupBy(id_col, "fold", "label").agg(known.alias("size"))
    gains = [
        F.sum(F.col("tf") * (F.ln(F.get("left", F.col("fold")) + s) - F.lit(log(s)))).alias(f"g{i}") for i, s in enumerate(smoothings)
    ]
    shared = rows.select(id_col, "fold", "tf", F.inline("classes")).groupBy(id_col, "fold", "class").agg(*gains)
    # every document in every class: the lines of its fold are at most classes times smoothings
    every = size_of.join(F.broadcast(lines), "fold").join(shared, [id_col, "fold", "class"], "left")
    gain = reduce(lambda acc, i: acc.when(F.col("at") == i, F.col(f"g{i}")), range(1, len(smoothings)), F.when(F.col("at") == 0, F.col("g0")))
    score = F.round(F.col("intercept") + F.col("slope") * F.col("size") + F.coalesce(gain, F.lit(0.0)), PLACES)
    best = F.min(F.struct((-score).alias("minus"), "class"))["class"].alias("prediction")
    return every.groupBy(id_col, "fold", "label", "at").agg(best)


def tune_bayes(
    df: DataFrame,
    id_col: str,
    fold: str = "fold",
    label: str = "label",
    words: str = "words",
    smoothings: tuple[float, ...] = (0.1, 1.0, 10.0),
    size: int = VOCABULARY_SIZE,
    min_df: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``(smoothing, fold, f1)``: weighted F1 of each fold under the model of the other folds.

    ``fold`` numbers folds from 0. The vocabulary is that of all rows; words are counted once by
    class and fold, and a model is the total less its fold. For few classes and folds: every
    document is scored in every class.
    """
    folds = (df.agg(F.max(fold)).first()[0] or 0) + 1
    docs = df.where(F.col(label).isNotNull()).select(id_col, F.col(fold).alias("fold"), F.col(label).alias("label"), F.col(words).alias("words"))
    counts = class_words(docs, "label", "words", size, min_df, ("fold",))
    v = counts.agg(F.count_distinct("word")).first()[0]
    # per class and fold: what is left without the fold; bounded by classes times folds
    sizes = docs.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("docs"))
    tokens = counts.groupBy("label", "fold").agg(F.sum("n").alias("tokens"))
    parts = [r.asDict() for r in sizes.join(tokens, ["label", "fold"], "left").collect()]
    classes = sorted({r["label"] for r in parts})
    lines = []
    for f in range(folds):
        left = {c: [0, 0] for c in classes}
        for r in parts:
            if r["fold"] != f:
                left[r["label"]][0] += r["docs"]
                left[r["label"]][1] += r["tokens"] or 0
        total = sum(d for d, _ in left.values())
        for i, s in enumerate(smoothings):
            for c, (d, t) in left.items():
                prior = log((d + s) / (total + len(classes) * s))
                lines.append((f, i, c, prior, log(s) - log(t + s * max(v, 1))))
    parts = F.struct(F.sum("n").alias("n"), F.collect_list(F.struct("fold", "n")).alias("folds"))
    of_word = counts.groupBy("word", "label").agg(parts.alias("x"))
    without = F.transform(
        F.sequence(F.lit(0), F.lit(folds - 1)),
        lambda f: F.aggregate(F.filter("x.folds", lambda p: p["fold"] == f), F.col("x.n"), lambda n, p: n - p["n"]),
    )
    left = of_word.select("word", "label", without.alias("left"))
    entries = materialise(
        left.groupBy("word").agg(F.collect_list(F.struct(F.col("label").alias("class"), "left")).alias("classes")), "fold-words"
    )
    if 0 < len(classes) * len(smoothings) <= FEW_SUMS:
        predicted = _left_out(docs, entries, lines, classes, smoothings, folds, id_col)
    else:
        lines = docs.sparkSession.createDataFrame(lines, f"fold int, at int, class {dict(df.dtypes)[label]}, intercept double, slope double")
        predicted = _left_out_of_many(docs, entries, lines, smoothings, id_col)
    sides = F.array(
        F.struct(F.col("label").alias("k"), F.lit(1).alias("size"), F.lit(0).alias("taken"), (F.col("label") == F.col("prediction")).cast("int").alias("hits")),
        F.struct(F.col("prediction").alias("k"), F.lit(0).alias("size"), F.lit(1).alias("taken"), F.lit(0).alias("hits")),
    )
    per_class = predicted.select("at", "fold", F.inline(sides)).groupBy("at", "fold", "k").agg(
        F.sum("size").alias("size"), F.sum("taken").alias("taken"), F.sum("hits").alias("hits")
    )
    f1 = F.sum(F.col("size") * 2.0 * F.col("hits") / (F.col("size") + F.col("taken"))) / F.sum("size")
    grid = F.array(*map(F.lit, smoothings))
    return per_class.groupBy("at", "fold").agg(f1.alias("f1")).select(F.get(grid, F.col("at")).alias("smoothing"), "fold", "f1")


def best_smoothing(scores: DataFrame) -> float:
    """The smoothing with the highest mean F1 over folds, to six places; of equal ones the least."""
    means = scores.groupBy("smoothing").agg(F.round(F.avg("f1"), PLACES).alias("f1"))
    return means.orderBy(F.desc("f1"), "smoothing").first()["smoothing"]
