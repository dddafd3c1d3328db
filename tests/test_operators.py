"""Edge cases on small inline rows."""

import math

import pytest
from pyspark.sql import functions as F

from lexiframe.functions import python_str, strip
from lexiframe.operators import labels, lookup, metrics, profile, rows, runs, split, terms, tokens
from lexiframe.sources import dictionaries, lines, sinks


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_split_keeps_every_empty_field(spark):
    data = ["", " a  b ", "x^^y^^z", "a^^", "plain"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "pos int, value string")
    space = dict(values(rows.split_records(df, " "), "pos", "fields"))
    caret = dict(values(rows.split_records(df, "^^"), "pos", "fields"))
    assert space == {i: v.split(" ") for i, v in enumerate(data)}
    assert caret == {i: v.split("^^") for i, v in enumerate(data)}
    out = rows.content_and_label(rows.split_records(df, "^^")).orderBy("pos")
    assert values(out, "content", "label") == [
        ("", ""), (" a  b ", " a  b "), ("x", "z"), ("a", ""), ("plain", "plain"),
    ]


def test_label_last(spark):
    df = spark.createDataFrame([("a b L",), ("L",)], "value string")
    out = rows.label_last(rows.split_records(df, " "))
    assert values(out, "label", "words") == [("L", ["a", "b"]), ("L", [])]


def test_string_table_casts_and_vectors(spark):
    df = spark.createDataFrame([("abc, 1.5 ,2",), ("3,4,5",)], "value string")
    table = rows.string_table(rows.split_records(df, ","))
    assert table.columns == ["f0", "f1", "f2"]
    cast = rows.label_from(rows.cast_all_to_double(table))
    assert cast.columns == ["f0", "f1", "label"]
    assert values(cast, "*") == [(None, 1.5, 2.0), (3.0, 4.0, 5.0)]
    assert rows.first_columns(cast, 2).columns == ["f0", "f1"]
    out = rows.numeric_examples(rows.split_records(df, ",")).orderBy("label").collect()
    assert [r["label"] for r in out] == [2, 5]
    assert out[0]["features"] is None and list(out[1]["features"]) == [3.0, 4.0]


@pytest.mark.parametrize(
    "text, expected",
    [(" A  b ", ["", "a", "", "b"]), ("", [""]), ("x\ty\n", ["x", "y"]), (" ", [])],
)
def test_lower_tokenizer_equals_mllib(spark, text, expected):
    from pyspark.ml.feature import Tokenizer

    df = spark.createDataFrame([(text,)], "text string")
    mllib = Tokenizer(inputCol="text", outputCol="words").transform(df).first()["words"]
    ours = tokens.tokenize(df, "text", "whitespace_lower").first()["words"]
    assert ours == expected == mllib


def test_other_token_modes(spark):
    df = spark.createDataFrame([("合同 spark法律条 文x",)], "text string")
    assert tokens.tokenize(df, "text", "regex").first()["words"] == [
        "合同", "spark", "法律条", "文", "x",
    ]
    assert tokens.tokenize(df, "text", "han_bigram").first()["words"] == [
        "合同", "spark", "法律", "律条", "文", "x",
    ]
    out = tokens.segment(df, "text", lambda t: t.split(" "))
    assert out.first()["words"] == ["合同", "spark法律条", "文x"]


def test_stopwords_in_both_forms(spark):
    words = ["The", "the", "", "a b", "x　y", "ok", "ok"]
    df = spark.createDataFrame([(1, words)], "id int, words array<string>")
    assert tokens.remove_stopwords(df, ["the"]).first()["words"] == ["The", "ok", "ok"]
    stop = spark.createDataFrame([("the",)], "word string")
    exploded = df.select("id", F.explode("words").alias("word"))
    assert sorted(values(tokens.drop_stopwords(exploded, stop), "word")) == [
        ("The",), ("ok",), ("ok",),
    ]


def test_strip_and_python_text(spark):
    data = ["　 a b\t", "don't", 'say "hi"', "it's \"x\"", "a\\b\n\t", "\x01 　", "中"]
    df = spark.createDataFrame([(v,) for v in data], "v string")
    out = values(df, strip("v"), python_str("v"))
    assert out == [(v.strip(), repr(v)) for v in data]


def test_pair_file_has_tuple_lines_and_refuses_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("a", 3), ("don't", 1)], "word string, n long")
    path = str(tmp_path / "pairs")
    sinks.write_pairs(df, path)
    assert sorted(r[0] for r in lines.read_lines(spark, path).collect()) == sorted(
        [str(("a", 3)), str(("don't", 1))]
    )
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_pairs(df, path)


def test_number_lines_follows_file_and_offset(spark, tmp_path):
    expected = []
    for name in ("a", "b", "c"):
        rows_ = [f"{name}{i}" for i in range(500)]
        (tmp_path / f"{name}.txt").write_text("\n".join(rows_) + "\n")
        expected += rows_
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = lines.number_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [v for _, v in sorted((r["pos"], r["value"]) for r in found)] == expected
    assert sorted(r["pos"] for r in found) == list(range(1500))


def test_dictionaries(spark, tmp_path):
    (tmp_path / "idf").write_text("w:1.0\nv:2.0\nw:3.0\nu:4:9\n")
    assert dict(values(dictionaries.read_idf(spark, str(tmp_path / "idf")), "word", "idf")) == {
        "w": 3.0, "v": 2.0, "u": 4.0,
    }
    (tmp_path / "cat").write_text("1:a\n2:b\n3:a\n")
    cats = dictionaries.read_categories(spark, str(tmp_path / "cat"))
    assert dict(values(cats, "category", "id")) == {"a": 3, "b": 2}
    (tmp_path / "stop").write_text(" the \nof\nof\n")
    assert sorted(values(dictionaries.read_stopwords(spark, str(tmp_path / "stop")), "word")) == [
        ("of",), ("the",),
    ]


def idf_table(spark, pairs):
    return spark.createDataFrame(pairs, "word string, idf double")


def test_keyword_ties_unknown_words_and_empty_documents(spark):
    df = spark.createDataFrame(
        [(1, "x", ["b", "a", "b", "c", "a"]), (2, "y", [])], "id int, label string, words array<string>"
    )
    out = terms.keywords(df, idf_table(spark, [("a", 1.0), ("b", 1.0)]), "id", keep=("label",))
    assert sorted(values(out, "id", "label", "words")) == [(1, "x", ["b", "a", "c"]), (2, "y", [])]
    top = terms.keywords(df, idf_table(spark, [("a", 1.0), ("b", 1.0)]), "id", n=1)
    assert dict(values(top, "id", "words"))[1] == ["b"]
    boost = spark.createDataFrame([("a", 1.5)], "word string, ratio double")
    top = terms.keywords(df, idf_table(spark, [("a", 1.0), ("b", 1.0)]), "id", boost=boost)
    assert dict(values(top, "id", "words"))[1] == ["a", "b", "c"]


def test_lookup_join_is_the_same_broadcast_or_salted(spark):
    df = spark.range(5000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("word"),
    )
    table = spark.range(60).select(F.concat(F.lit("k"), "id").alias("word"), F.col("id").alias("x")).union(
        spark.createDataFrame([("hot", -1)], "word string, x long")
    )
    for how in ("left", "inner", "left_anti"):
        # the most frequent word of the rows may be missing from the dictionary
        for dictionary in (table, table.where("word <> 'hot'")):
            small = lookup.lookup_join(df, dictionary, "word", how)
            for n in (1, 20):
                large = lookup.lookup_join(df, dictionary, "word", how, max_bytes=0, n=n)
                assert small.columns == large.columns
                assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))


def python_runs(labels_):
    """A run is a maximal stretch of equal labels; empty ones at the start have number -1."""
    from itertools import groupby

    stretches = [len(list(rows)) for _, rows in groupby(labels_)]
    first = -1 if labels_ and labels_[0] == "" else 0
    return [n for n, size in enumerate(stretches, first) for _ in range(size)]


@pytest.mark.parametrize("data", [["a", "a", "b", "a", "c", "c"], ["", "", "a"], ["a", "", "", "b"]])
def test_run_number(spark, data):
    df = spark.createDataFrame(list(enumerate(data)), "pos long, label string")
    out = runs.run_number(df, "label", "pos")
    assert [r["run_id"] for r in out.orderBy("pos").collect()] == python_runs(data)
    expected = {}
    for label, number in zip(data, python_runs(data)):
        if number >= 0:
            expected[label] = number
    assert dict(values(runs.label_dictionary(out), "label", "label_id")) == expected


@pytest.mark.parametrize("size, most", [(9, 10_000), (9, 5), (1 << 20, 10_000)])
def test_run_number_over_many_groups(spark, monkeypatch, size, most):
    import random

    monkeypatch.setattr(runs, "ROWS_PER_GROUP", size)
    monkeypatch.setattr(runs, "MAX_GROUPS", most)
    rnd = random.Random(size)
    keys = sorted(rnd.sample(range(-500, 3000), 400)) + [2**40, 2**62]
    data = [rnd.choice(["a", "b", None, ""]) for _ in keys]
    df = spark.createDataFrame(list(zip(keys, data)), "pos long, label string").repartition(5)
    out = [r["run_id"] for r in runs.run_number(df, "label", "pos").orderBy("pos").collect()]
    assert out == python_runs(data)


def test_label_lookup(spark):
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "label string")
    mapping = spark.createDataFrame([("a", 7)], "label string, id int")
    assert set(values(labels.label_ids(df, mapping), "label", "label_id")) == {
        ("a", 7), ("zz", 1), (None, 1),
    }
    assert (None, None) in values(labels.label_ids(df, mapping, default=None), "label", "label_id")


def test_label_index_ties_unseen_and_null(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "label string")
    model = labels.fit_label_index(fit)
    assert model.labels == ["c", "a", "b"]
    df = spark.createDataFrame([("zz",), ("a",), (None,)], "label string")
    assert [r["indexedLabel"] for r in model.transform(df).collect()] == [3.0, 1.0, 3.0]
    pred = spark.createDataFrame([(0.0,), (2.0,)], "prediction double")
    out = labels.decode_labels(pred, model.labels)
    assert values(out, "predictLabel") == [("c",), ("b",)]


def test_split_is_keyed_and_sized(spark):
    df = spark.range(20000)
    one = split.hash_split(df.repartition(3), "id", [0.9, 0.1], 234)
    two = split.hash_split(df.repartition(7), "id", [0.9, 0.1], 234)
    assert one.exceptAll(two).isEmpty()
    assert abs(one.where("part = 1").count() - 2000) < 200
    assert split.hash_split(df, "id", [0.9, 0.1], 1).exceptAll(one).count() > 0
    assert split.hash_fold(df, "id", 2, 1).groupBy("fold").count().count() == 2


def results(spark, pairs):
    return spark.createDataFrame(
        [(i, t, p) for i, (t, p) in enumerate(pairs)], "pos long, truth int, prediction int"
    )


def test_class_accuracy(spark):
    grouped = results(spark, [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)])
    cols = ("rank", "truth", "accuracy")
    assert values(metrics.class_accuracy(grouped, "truth", "prediction", "pos"), *cols) == [
        (1, 0, 0.5), (2, 1, 1.0),
    ]
    mixed = results(spark, [(0, 0), (1, 1), (0, 0)])
    assert (0, 1.0) in values(metrics.class_accuracy(mixed, "truth", "prediction", "pos"), "truth", "accuracy")
    by_run = metrics.class_accuracy_by_last_run(mixed, "truth", "prediction", "pos")
    assert (0, 2.0) in values(by_run, "truth", "accuracy")


def test_weighted_f1_equals_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.range(1000).select(
        (F.col("id") % 4).cast("double").alias("label"),
        ((F.col("id") * 7 + F.col("id") % 3) % 5).cast("double").alias("prediction"),
    )
    ours = metrics.weighted_f1(df).first()["f1"]
    assert math.isclose(ours, MulticlassClassificationEvaluator().evaluate(df), rel_tol=1e-12)
    acc = metrics.accuracy(df).first()
    assert acc["total"] == 1000 and acc["accuracy"] == acc["correct"] / 1000


@pytest.mark.parametrize("ranges", [1, 7, 300, None])
def test_quantiles_are_exact(spark, ranges):
    import random

    import numpy as np

    rnd = random.Random(5)
    data = [rnd.gauss(0, 1) for _ in range(700)] + [0.25] * 400 + [rnd.randint(-9, 9) for _ in range(100)]
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,)], "x double").repartition(5)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = profile.quantiles(df, "x", ps, ranges).first()
    assert np.allclose(list(found), np.quantile(data, ps), atol=1e-12)


def test_describe_and_outliers_match_pandas(spark):
    import pandas as pd

    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, 100.0], "b": [5.0, 5.0, 6.0, -50.0, 7.0]})
    df = spark.createDataFrame(pdf)
    found = profile.describe(df, ["a", "b"]).toPandas().set_index("column")
    expected = pdf.describe().T
    for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                         ("q1", "25%"), ("median", "50%"), ("q3", "75%"), ("max", "max")]:
        assert found[ours].tolist() == pytest.approx(expected.loc[found.index, theirs].tolist())
    assert values(profile.outliers(df, "a"), "a") == [(100.0,)]


def test_vector_statistics(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(1.0, 0.0),), (Vectors.dense(3.0, -2.0),)], ["features"])
    row = profile.vector_statistics(df).first()
    assert list(row["mean"]) == [2.0, -1.0] and row["count"] == 2
    assert list(row["numNonZeros"]) == [2.0, 1.0] and list(row["normL1"]) == [4.0, 2.0]


def test_nan_is_a_missing_value(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)] + [(float("nan"),), (None,)], "x double")
    row = profile.describe(df, ["x"]).first()
    assert (row["count"], row["mean"], row["max"], row["median"]) == (5, 22.0, 100.0, 3.0)
    assert [r["x"] for r in profile.outliers(df, "x").collect()] == [100.0]


def test_run_number_keeps_wide_rows(spark):
    df = spark.createDataFrame([(3, "b", "x"), (1, "a", None), (2, "a", "z")], "pos long, label string, words string")
    out = runs.run_number(df, "label", "pos")
    assert out.columns == ["pos", "label", "words", "run_id"]
    assert sorted(map(tuple, out.collect())) == [(1, "a", None, 0), (2, "a", "z", 0), (3, "b", "x", 1)]


def test_small_parts_of_a_split(spark):
    df = spark.range(400_000)
    parts = dict(values(split.hash_split(df, "id", [0.99999, 0.00001], 7).groupBy("part").count(), "part", "count"))
    assert parts[0] + parts[1] == 400_000 and 0 < parts[1] < 20
    with pytest.raises(ValueError):
        split.hash_split(df, "id", [1, 1e-12], 7)


@pytest.mark.parametrize("x", [0.0, -0.0, 1.0, 1e-5, 1.25e-5, 0.0001, -0.00012, 0.001, 12345678.0, 1e7, 1.5e15, 1e16,
                               -2.5e16, 1e22, 1e-300, 1.7976931348623157e308, 123456789.125, float("inf"), float("nan")])
def test_python_float(spark, x):
    from lexiframe.functions.text import python_float

    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(python_float("x")).first()[0] == repr(x)


def test_part_files_are_ordered_by_number(spark, tmp_path):
    from lexiframe.sources import number_lines

    for n in (2, 10, 99999, 100000):
        (tmp_path / f"part-{n:05d}-x.txt").write_text(f"{n}\n")
    assert [r["value"] for r in number_lines(spark, str(tmp_path)).orderBy("pos").collect()] == ["2", "10", "99999", "100000"]


@pytest.mark.parametrize("ranges", [1, 5, None])
def test_profile_of_many_columns_at_once(spark, ranges):
    """Ranges hold several columns or parts of one; a column without values keeps its row."""
    import random

    import numpy as np

    rnd = random.Random(11)
    data = [
        (rnd.gauss(1e6, 1.0), rnd.choice([0.0, -0.0, 7.0]), None, float("nan") if i % 2 else 3.0, i if i == 4 else None)
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e int").repartition(3)
    found = {r["column"]: r for r in profile.describe(df, df.columns, ranges).collect()}
    for i, name in enumerate("ab"):
        x = np.array([r[i] for r in data])
        row = found[name]
        assert row["count"] == 400
        assert np.allclose([row["mean"], row["std"], row["min"], row["max"]], [x.mean(), x.std(ddof=1), x.min(), x.max()], rtol=1e-9)
        assert np.allclose([row["q1"], row["median"], row["q3"]], np.quantile(x, [0.25, 0.5, 0.75]), rtol=1e-12)
    assert found["c"]["count"] == 0 and found["c"]["mean"] is None and found["c"]["median"] is None
    assert (found["d"]["count"], found["d"]["std"], found["d"]["q3"]) == (200, 0.0, 3.0)
    assert (found["e"]["count"], found["e"]["std"], found["e"]["median"]) == (1, None, 4.0)
    assert profile.describe(df.limit(0), ["a"]).first()["count"] == 0


def test_run_number_on_sparse_keys(spark, monkeypatch):
    """Keys spread over 64 bits, partly closer together than doubles can tell."""
    import random

    monkeypatch.setattr(runs, "ROWS_PER_GROUP", 100)
    stored = []
    real = runs.materialise
    monkeypatch.setattr(runs, "materialise", lambda df, name: stored.append(real(df, name)) or stored[-1])
    rnd = random.Random(3)
    keys = sorted({rnd.randrange(-(2**63), 2**63) for _ in range(1500)} | {2**62 + i for i in range(500)})
    data = [rnd.choice(["a", "b", None]) for _ in keys]
    df = spark.createDataFrame(list(zip(keys, data)), "pos long, label string").repartition(7)
    out = [r["run_id"] for r in runs.run_number(df, "label", "pos").orderBy("pos").collect()]
    assert out == python_runs(data)
    assert len(stored) == 1 and stored[0].count() <= 21
    assert runs.run_number(df.limit(0), "label", "pos").count() == 0


def test_number_lines_stores_totals_only(spark, tmp_path, monkeypatch):
    (tmp_path / "x.txt").write_text("".join(f"{i}\n" for i in range(3000)))
    stored = []
    real = lines.materialise
    monkeypatch.setattr(lines, "materialise", lambda df, name: stored.append(real(df, name)) or stored[-1])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = lines.number_lines(spark, str(tmp_path))
        assert [r["value"] for r in found.orderBy("pos").collect()] == [str(i) for i in range(3000)]
        assert len(stored) == 1 and set(stored[0].columns) == {"block", "first_row", "before"} and stored[0].count() < 30
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        with pytest.raises(Exception, match="cuts changed"):
            found.select(F.sum("pos")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lookup_join_moves_possible_partners_only(spark, monkeypatch):
    """Rows without a partner and rows of frequent keys stay; too many bytes of frequent keys take fewer of them."""
    df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"))
    table = spark.range(0, 20_000, 8).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x")).union(
        spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "k long, x long")
    )
    expected = sorted(map(repr, df.join(table, "k", "left").select("k", "id", "x").collect()))
    for near in (1 << 20, 0):
        monkeypatch.setattr(lookup, "NEAR_BYTES", near)
        out = lookup.lookup_join(df, table, "k", max_bytes=0, n=10)
        assert sorted(map(repr, out.select("k", "id", "x").collect())) == expected
    monkeypatch.setattr(lookup, "NEAR_BYTES", 1 << 20)
    seen = []
    real = lookup.key_filter
    monkeypatch.setattr(lookup, "key_filter", lambda hashes: seen.append(real(hashes)) or seen[-1])
    lookup.lookup_join(df, table, "k", max_bytes=0, n=10)
    words, bits = seen[0]
    hashes = df.where("id % 2 = 1").select(F.xxhash64("k").alias("_hash"))
    at = F.pmod("_hash", F.lit(bits))
    kept = hashes.withColumn("_word", F.shiftright(at, 6)).join(words, "_word").where(
        F.expr(f"shiftright(_bits, cast(pmod(_hash, {bits}) & 63 as int)) & 1 = 1")
    )
    assert kept.count() < 2000  # of 10,000 rows, one of which has a partner
    with pytest.raises(ValueError):
        lookup.lookup_join(df, table.withColumn("k", F.col("k").cast("string")), "k", max_bytes=0)
    ints = df.withColumn("k", F.col("k").cast("int"))
    both = lookup.lookup_join(ints, table, "k", "inner", max_bytes=0, n=3)
    assert both.count() == df.join(table, "k").count()


def test_a_segmenter_holds_the_words_of_few_texts(spark):
    class Word(str):
        live = 0

        def __new__(cls, text):
            cls.live += 1
            if cls.live > 3 * (tokens.SEGMENTED_ROWS + 1):
                raise MemoryError(f"{cls.live} words are held")
            return super().__new__(cls, text)

        def __del__(self):
            type(self).live -= 1

    df = spark.range(2000).coalesce(1).select("id", F.concat_ws(" ", "id", F.lit("b"), F.lit("c")).alias("text"))
    df = df.withColumn("text", F.when(F.col("id") != 7, F.col("text")))
    out = tokens.segment(df, "text", lambda t: [Word(x) for x in t.split()]).orderBy("id").collect()
    assert [r.words for r in out] == [None if i == 7 else [str(i), "b", "c"] for i in range(2000)]
