"""Lines, tokens, word counts, term weights and keywords of the documents."""

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.vectors import sparse_entries
from ..operators import profile, segmentation, terms, tokens
from ..plans.documents import lines_of, scoring_set, scoring_set_with_ids, training_set_with_ids
from ..plans.stages import HASH_SIZE, count_stage, hashed_tfidf_stages
from ..sources.scratch import materialise
from .registry import Registry, table

registry = Registry()
query = registry.add

STOPWORDS = 100


def documents(spark, d, *keep):
    return table(spark, d, "documents").select("doc_id", *keep, "text")


def one_line(docs):
    """Documents as single lines."""
    return docs.withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))


def words_of(docs):
    """``words`` beside ``text``, without empty tokens."""
    return tokens.remove_stopwords(tokens.tokenize(one_line(docs), "text"), [])


def corpus_words(spark, d, *keep):
    """``(doc_id, *keep, words)`` without empty tokens, documents where they are read."""
    return words_of(documents(spark, d, *keep)).drop("text")


#: The same: words are counted where their document is read.
document_words = corpus_words


def corpus_idf(words, min_df=2):
    return materialise(terms.inverse_document_frequency(words, "words", min_df), "idf")


def common_words(words, n=STOPWORDS):
    return terms.word_count(words).orderBy(F.desc("n"), "word").limit(n).select("word")


TOKENS_SQL = """
    lists AS (SELECT doc_id, lang, string_split(translate(text, chr(10), ' '), ' ') AS ws
              FROM documents),
    every AS (SELECT doc_id, lang, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos
              FROM lists),
    tokens AS (SELECT * FROM every WHERE word <> '' AND NOT contains(word, chr(12288))),
    size AS (SELECT count(*) AS documents FROM documents),
    tf AS (SELECT doc_id, lang, word, count(*) AS tf, min(pos) AS first_pos
           FROM tokens GROUP BY ALL),
    freq AS (SELECT word, sum(tf)::BIGINT AS n, count(*) AS df FROM tf GROUP BY word),
    idf AS (SELECT word, df, ln((documents + 1) / (df + 1)) AS idf FROM freq, size WHERE df >= 2),
    common AS (SELECT word FROM freq ORDER BY n DESC, word LIMIT 100)
"""

WEIGHTS_SQL = """
    weighted AS (SELECT doc_id, lang, word, tf, first_pos, round(tf * coalesce(idf, 0), 6) AS tfidf
                 FROM tf LEFT JOIN idf USING (word)),
    ranked AS (SELECT *, (row_number() OVER (PARTITION BY doc_id
                          ORDER BY tfidf DESC, first_pos))::INTEGER AS rank FROM weighted)
"""


# Constants of MurmurHash3 (32 bits) and its seed in MLlib.
LOW = 4294967295
FOUR_BYTES = " + ".join(f"coalesce(b[i * 4 + {j + 1}], 0) * {256**j}" for j in range(4))
#: CTE ``slots`` (word, slot): the place of each word of ``tokens`` among 21,000 hashed ones.
SLOTS_SQL = f"""
    spelled AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM tokens)),
    spelling AS (SELECT word, len(h) // 2 AS n,
                        list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT) AS b
                 FROM spelled),
    quads AS (SELECT word, n, list_transform(range(n // 4 + 1), lambda i: {FOUR_BYTES}) AS k FROM spelling),
    first AS (SELECT word, n, list_transform(k, lambda x: (x * 3432918353) & {LOW}) AS k FROM quads),
    turned AS (SELECT word, n, list_transform(k, lambda x: ((x << 15) | (x >> 17)) & {LOW}) AS k FROM first),
    mixed AS (SELECT word, n, list_transform(k, lambda x: (x * 461845907) & {LOW}) AS k FROM turned),
    rounds AS (SELECT *, list_reduce(k[:n // 4], lambda h, x:
                        ((((xor(h, x) << 13) | (xor(h, x) >> 19)) & {LOW}) * 5 + 3864292196) & {LOW}, 42::UBIGINT) AS h
              FROM mixed),
    ended AS (SELECT word, xor(xor(h, k[n // 4 + 1]), n::UBIGINT) AS h FROM rounds),
    once AS (SELECT word, (xor(h, h >> 16) * 2246822507) & {LOW} AS h FROM ended),
    twice AS (SELECT word, (xor(h, h >> 13) * 3266489909) & {LOW} AS h FROM once),
    hashed AS (SELECT word, xor(h, h >> 16)::BIGINT AS h FROM twice),
    slots AS (SELECT word, (((CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) % 21000 + 21000) % 21000)::INTEGER AS slot
              FROM hashed)
"""


@query(
    "text_lines",
    """
    SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INTEGER AS line, unnest(ls) AS value
    FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
    """,
)
def text_lines(spark, d):
    return lines_of(documents(spark, d), "doc_id", "text")


@query(
    "word_count",
    """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(line, ' ')) AS word
          FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
    GROUP BY word
    """,
)
def word_count(spark, d):
    return terms.word_count(tokens.tokenize(text_lines(spark, d), "value"))


@query(
    "space_tokens",
    """
    SELECT doc_id, (generate_subscripts(ws, 1) - 1)::INTEGER AS pos, unnest(ws) AS word
    FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)
    """,
)
def space_tokens(spark, d):
    docs = tokens.tokenize(table(spark, d, "documents"), "text")
    return docs.select("doc_id", F.posexplode("words").alias("pos", "word"))


@query(
    "lower_whitespace_tokens",
    """
    SELECT doc_id, len(ws)::INTEGER AS n_words, md5(array_to_string(ws, ' ')) AS digest
    FROM (SELECT doc_id, string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s') AS ws
          FROM documents)
    """,
)
def lower_whitespace_tokens(spark, d):
    docs = tokens.tokenize(table(spark, d, "documents"), "text", "whitespace_lower")
    return docs.select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.md5(F.array_join("words", " ")).alias("digest"),
    )


@query(
    "script_run_tokens",
    """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_extract_all(text, '\\p{Han}+|[^\\s\\p{Han}]+')) AS word FROM documents)
    GROUP BY word
    """,
)
def script_run_tokens(spark, d):
    return terms.word_count(tokens.tokenize(documents(spark, d), "text", "regex"))


PHRASE = r"\p{L}+(?: \p{L}+){0,7}"

LATTICE_SQL = """
    WITH phrases AS (SELECT doc_id, unnest(ps) AS phrase, generate_subscripts(ps, 1) AS pos
                FROM (SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}+(?: \\p{L}+){0,7}') AS ps FROM documents)),
    dict AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(phrase, ' ')) AS word FROM phrases)
             WHERE length(word) <= 12 GROUP BY word HAVING count(*) >= 2 ORDER BY n DESC, word LIMIT 20000),
    total AS (SELECT sum(n)::DOUBLE AS total FROM dict),
    costs AS (SELECT word, round(ln(total / n) * 1000000)::BIGINT AS cost FROM dict, total),
    glued AS (SELECT DISTINCT replace(phrase, ' ', '') AS run FROM phrases),
    parts AS (SELECT run, i, n, substr(run, i, n) AS word
              FROM (SELECT run, unnest(range(1, length(run) + 1)) AS i FROM glued), range(1, 13) AS r(n)
              WHERE i + n - 1 <= length(run)),
    arcs AS (SELECT run, i, n, coalesce(cost, round(ln(total) * 1000000)::BIGINT) AS cost
             FROM parts LEFT JOIN costs USING (word), total WHERE cost IS NOT NULL OR n = 1),
    spots AS (SELECT run, i, list({n: n::BIGINT, cost: cost}) AS arcs FROM arcs GROUP BY run, i),
    lattice AS (SELECT run, list({arcs: arcs, best: []::STRUCT(cost BIGINT, words BIGINT, neg BIGINT, path BIGINT[])[]}
                                 ORDER BY i DESC) AS spots FROM spots GROUP BY run),
    cut AS (SELECT run, list_reduce(spots, lambda after, x: {
                arcs: x.arcs,
                best: list_prepend(list_min(list_transform(x.arcs, lambda a: {
                    cost: a.cost + after.best[a.n].cost, words: 1 + after.best[a.n].words, neg: -a.n,
                    path: list_prepend(a.n, after.best[a.n].path)})), after.best)[1:12]},
                {arcs: []::STRUCT(n BIGINT, cost BIGINT)[],
                 best: [{cost: 0::BIGINT, words: 0::BIGINT, neg: 0::BIGINT, path: []::BIGINT[]}]}).best[1].path AS path
            FROM lattice),
    ends AS (
        SELECT doc_id, pos, run, path, list_transform(range(1, len(path) + 1), lambda k: list_sum(path[1:k])::BIGINT) AS found,
               list_transform(range(1, len(ws) + 1), lambda k: length(array_to_string(ws[1:k], ''))) AS given
        FROM (SELECT *, string_split(phrase, ' ') AS ws FROM phrases) JOIN cut ON run = replace(phrase, ' ', ''))
"""


@query(
    "segmented_phrases",
    f"""
    {LATTICE_SQL}
    SELECT doc_id, count(*) AS n_phrases, sum(len(given))::BIGINT AS n_words, sum(len(found))::BIGINT AS n_segments,
           sum(len(list_intersect(found, given)))::BIGINT AS n_shared,
           md5(string_agg(array_to_string(list_transform(range(1, len(path) + 1),
               lambda k: substr(run, found[k] - path[k] + 1, path[k])), ' '), chr(10) ORDER BY pos)) AS digest
    FROM ends GROUP BY doc_id
    """,
)
def segmented_phrases(spark, d):
    """Phrases of letters without their spaces, cut again by a dictionary of the corpus; how many ends are shared?"""
    given = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(PHRASE), 0), lambda p: F.split(p, " "))
    split = documents(spark, d).select("doc_id", given.alias("given"))
    counts = segmentation.dictionary(split.select(F.flatten("given").alias("words")), size=20_000, least=2)
    glued = split.withColumn("glued", F.transform("given", lambda x: F.array_join(x, "")))
    # not where phrases are empty, which would look for them twice
    cut = segmentation.cut_runs(glued, "glued", materialise(counts, "dictionary"), "found").where(F.size("found") > 0)
    return cut.select(
        "doc_id",
        F.size("given").cast("bigint").alias("n_phrases"),
        _sum(F.transform("given", F.size)).alias("n_words"),
        _sum(F.transform("found", F.size)).alias("n_segments"),
        segmentation.shared_ends("given", "found").alias("n_shared"),
        F.md5(F.array_join(F.transform("found", lambda x: F.array_join(x, " ")), "\n")).alias("digest"),
    )


def _sum(numbers):
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)


@query("segmented_words")
def segmented_words(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = tokens.segment(docs, "text", str.split)
    return out.select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.md5(F.array_join("words", " ")).alias("digest"),
    )


registry.sql["segmented_words"] = """
    SELECT doc_id, len(ws)::INTEGER AS n_words, md5(array_to_string(ws, ' ')) AS digest
    FROM (SELECT doc_id, string_split_regex(trim(text, ' ' || chr(10)), '\\s+') AS ws FROM documents)
"""


@query(
    "stopword_filter",
    f"""
    WITH {TOKENS_SQL},
    kept AS (SELECT * FROM tokens ANTI JOIN common USING (word))
    SELECT doc_id, coalesce(n_words, 0)::INTEGER AS n_words, coalesce(digest, md5('')) AS digest
    FROM documents
    LEFT JOIN (SELECT doc_id, count(*) AS n_words, md5(string_agg(word, ' ' ORDER BY pos)) AS digest
               FROM kept GROUP BY doc_id) USING (doc_id)
    """,
)
def stopword_filter(spark, d):
    words = corpus_words(spark, d)
    stop = [row["word"] for row in common_words(words).collect()]  # STOPWORDS rows
    return tokens.remove_stopwords(words, stop).select(
        "doc_id",
        F.size("words").alias("n_words"),
        F.md5(F.array_join("words", " ")).alias("digest"),
    )


@query(
    "stopword_anti_join",
    f"""
    WITH {TOKENS_SQL}
    SELECT doc_id, count(*) AS n, min(pos)::INTEGER AS first_pos, max(pos)::INTEGER AS last_pos
    FROM tokens ANTI JOIN common USING (word) GROUP BY doc_id
    """,
)
def stopword_anti_join(spark, d):
    rows = tokens.tokenize(one_line(documents(spark, d)), "text")
    stop = materialise(common_words(corpus_words(spark, d)), "stopwords")
    exploded = rows.select("doc_id", F.posexplode("words").alias("pos", "word"))
    return tokens.drop_stopwords(exploded, stop).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    )


@query(
    "term_frequencies",
    f"WITH {TOKENS_SQL} SELECT doc_id, word, tf FROM tf",
)
def term_frequencies(spark, d):
    return (
        terms.term_counts(corpus_words(spark, d), "doc_id")
        .where(F.col("word").isNotNull())
        .select("doc_id", "word", "tf")
    )


@query(
    "distinct_words",
    f"""
    WITH {TOKENS_SQL}
    SELECT doc_id, count(*)::INTEGER AS n_words, string_agg(word, ' ' ORDER BY first_pos) AS words
    FROM tf GROUP BY doc_id
    """,
)
def distinct_words(spark, d):
    out = corpus_words(spark, d).withColumn("words", terms.distinct_terms("words"))
    return out.where(F.size("words") > 0).select(
        "doc_id", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words")
    )


@query(
    "idf_values",
    f"WITH {TOKENS_SQL} SELECT word, df, round(idf, 6) AS idf FROM idf",
)
def idf_values(spark, d):
    out = terms.inverse_document_frequency(corpus_words(spark, d))
    return out.withColumn("idf", F.round("idf", 6))


@query(
    "idf_lookup",
    f"""
    WITH {TOKENS_SQL}
    SELECT doc_id, word, round(coalesce(idf, 0), 6) AS idf FROM tf LEFT JOIN idf USING (word)
    """,
)
def idf_lookup(spark, d):
    words = corpus_words(spark, d)
    counts = terms.term_counts(words, "doc_id").where(F.col("word").isNotNull())
    idf = corpus_idf(corpus_words(spark, d))
    joined = terms.idf_join(counts.select("doc_id", "word"), idf)
    return joined.select(
        "doc_id", "word", F.round(F.coalesce("idf", F.lit(0.0)), 6).alias("idf")
    )


@query(
    "vocabulary",
    f"""
    WITH {TOKENS_SQL}
    SELECT word, n, df FROM freq WHERE df >= 2 ORDER BY n DESC, word LIMIT 21000
    """,
)
def vocabulary(spark, d):
    return terms.vocabulary(corpus_words(spark, d))


@query(
    "vocabulary_counts",
    f"""
    WITH {TOKENS_SQL},
    vocab AS (SELECT word, (row_number() OVER (ORDER BY n DESC, word) - 1)::INTEGER AS slot
              FROM freq WHERE df >= 2)
    SELECT doc_id, slot, tf::DOUBLE AS n FROM tf JOIN vocab USING (word) WHERE slot < 21000
    """,
)
def vocabulary_counts(spark, d):
    words = corpus_words(spark, d)
    vectors = count_stage(words).transform(words)
    entries = vectors.select("doc_id", F.explode(sparse_entries("features")).alias("e"))
    return entries.select("doc_id", "e.slot", F.col("e.value").alias("n"))


@query(
    "hashed_term_counts",
    f"""
    WITH {TOKENS_SQL}, {SLOTS_SQL}
    SELECT doc_id, slot, sum(tf)::DOUBLE AS n FROM tf JOIN slots USING (word) GROUP BY ALL
    """,
)
def hashed_term_counts(spark, d):
    words = corpus_words(spark, d)
    tf = HashingTF(inputCol="words", outputCol="features", numFeatures=HASH_SIZE)
    entries = tf.transform(words).select("doc_id", F.explode(sparse_entries("features")).alias("e"))
    return entries.select("doc_id", "e.slot", F.col("e.value").alias("n"))


@query(
    "hashed_tfidf",
    f"""
    WITH tokens AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(text), '\\s+$', ''), '\\s')) AS word
                    FROM documents),
    {SLOTS_SQL},
    counts AS (SELECT doc_id, slot, count(*) AS tf FROM tokens JOIN slots USING (word) GROUP BY ALL),
    dfs AS (SELECT slot, count(*) AS df FROM counts GROUP BY slot)
    SELECT doc_id, slot, tf::DOUBLE AS tf,
           round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS weight
    FROM counts JOIN dfs USING (slot)
    """,
)
def hashed_tfidf(spark, d):
    """Count and weight of every slot that a document uses."""
    rows = tokens.tokenize(documents(spark, d), "text", "whitespace_lower")
    tf, idf = hashed_tfidf_stages()
    featured = tf.transform(rows)
    weighted = idf.fit(featured).transform(featured)
    sides = F.arrays_zip(sparse_entries("rawFeatures").alias("tf"), sparse_entries("features").alias("w"))
    entries = weighted.select("doc_id", F.explode(sides).alias("e"))
    return entries.select(
        "doc_id", "e.tf.slot", F.col("e.tf.value").alias("tf"), F.round("e.w.value", 6).alias("weight")
    )


@query(
    "tfidf_statistics",
    f"""
    WITH {TOKENS_SQL},
    vocab AS (SELECT word, df FROM freq WHERE df >= 2 ORDER BY n DESC, word LIMIT 21000),
    weights AS (SELECT doc_id, word, tf * ln((documents + 1) / (df + 1)) AS x FROM tf JOIN vocab USING (word), size)
    SELECT word, round(sum(x) / any_value(documents), 6) AS mean, count(*) FILTER (x <> 0) AS nonzeros,
           round(max(x), 6) AS most
    FROM weights, size GROUP BY word
    """,
)
def tfidf_statistics(spark, d):
    """Statistics of every slot of the documents' TF-IDF vectors."""
    words = corpus_words(spark, d)
    counts = count_stage(words, out="rawFeatures")
    # read by the fit and by the statistics: texts are tokenised and counted once more, not twice
    featured = materialise(counts.transform(words).select("rawFeatures"), "count-vectors")
    _, idf = hashed_tfidf_stages()
    vectors = idf.fit(featured).transform(featured)
    stats = profile.vector_statistics(vectors)
    slots = F.arrays_zip(
        F.array(*map(F.lit, counts.vocabulary)).alias("word"),
        vector_to_array("mean").alias("mean"),
        vector_to_array("numNonZeros").alias("nonzeros"),
        vector_to_array("max").alias("most"),
    )
    return stats.select(F.explode(slots).alias("s")).select(
        "s.word", F.round("s.mean", 6).alias("mean"), F.col("s.nonzeros").cast("long").alias("nonzeros"),
        F.round("s.most", 6).alias("most"),
    )


@query(
    "han_bigrams",
    """
    SELECT doc_id, list_aggregate(list_transform(range(1, length(t)), lambda i: substr(t, i, 2)), 'string_agg', ' ') AS pairs
    FROM (SELECT doc_id, translate(regexp_replace(text, '[^aeiou]', '', 'g'), 'aeiou',
                 chr(20013) || chr(22269) || chr(20154) || chr(27665) || chr(26085)) AS t FROM documents)
    WHERE length(t) >= 2
    """,
)
def han_bigrams(spark, d):
    """Vowels written as Han characters: one run per document, as overlapping pairs."""
    vowels = F.regexp_replace("text", "[^aeiou]", "")
    han = F.translate(vowels, "aeiou", "".join(map(chr, (20013, 22269, 20154, 27665, 26085))))
    rows = tokens.tokenize(documents(spark, d).withColumn("text", han), "text", "han_bigram")
    return rows.where(F.length("text") >= 2).select("doc_id", F.array_join("words", " ").alias("pairs"))


@query(
    "tfidf",
    f"""
    WITH {TOKENS_SQL},
    weights AS (SELECT word, ln((documents + 1) / (df + 1)) AS w FROM freq, size)
    SELECT doc_id, word, tf, round(tf * w, 6) AS tfidf FROM tf JOIN weights USING (word)
    """,
)
def tfidf(spark, d):
    return terms.tfidf(corpus_words(spark, d), "doc_id")


@query(
    "boosted_tfidf",
    f"""
    WITH {TOKENS_SQL}
    SELECT doc_id, word, round(tf * coalesce(idf, 0) * CASE WHEN c.word IS NULL THEN 1 ELSE 1.5 END, 6)
               AS tfidf
    FROM tf LEFT JOIN idf USING (word) LEFT JOIN common c USING (word)
    """,
)
def boosted_tfidf(spark, d):
    totals = materialise(terms.term_totals(corpus_words(spark, d)), "term-totals")
    frequent = totals.orderBy(F.desc("n"), "word").limit(STOPWORDS)
    boost = materialise(frequent.select("word", F.lit(1.5).alias("ratio")), "boost")
    idf = materialise(terms.idf_of_totals(totals, documents(spark, d).count()), "idf")
    counts = terms.term_counts(corpus_words(spark, d), "doc_id").where(F.col("word").isNotNull())
    return terms.weigh_terms(counts, idf, boost).select("doc_id", "word", "tfidf")


@query(
    "ranked_keywords",
    f"""
    WITH {TOKENS_SQL}, {WEIGHTS_SQL}
    SELECT doc_id, rank, word, tf, tfidf FROM ranked WHERE rank <= 50
    """,
)
def ranked_keywords(spark, d):
    words = corpus_words(spark, d)
    ranked = terms.ranked_keywords(words, corpus_idf(corpus_words(spark, d)), "doc_id")
    return ranked.where(F.col("word").isNotNull()).select("doc_id", "rank", "word", "tf", "tfidf")


@query(
    "keyword_lists",
    f"""
    WITH {TOKENS_SQL}, {WEIGHTS_SQL}
    SELECT doc_id, lang, coalesce(words, '') AS words
    FROM documents LEFT JOIN (SELECT doc_id, string_agg(word, ' ' ORDER BY rank) AS words
                              FROM ranked WHERE rank <= 50 GROUP BY doc_id) USING (doc_id)
    """,
)
def keyword_lists(spark, d):
    words = corpus_words(spark, d, "lang")
    idf = corpus_idf(corpus_words(spark, d))
    out = terms.keywords(words, idf, "doc_id", keep=("lang",))
    return out.withColumn("words", F.array_join("words", " "))


def labelled_lines(spark, d, delimiter):
    """``text<delimiter>lang`` lines numbered by document."""
    line = F.concat_ws(delimiter, "text", "lang")
    return one_line(documents(spark, d, "lang")).select(F.col("doc_id").alias("pos"), line.alias("value"))


@query(
    "training_set",
    """
    WITH marks AS (SELECT doc_id AS pos, lang AS label, text,
                          CASE WHEN lang = lag(lang, 1, '') OVER (ORDER BY doc_id) THEN 0 ELSE 1 END AS s
                   FROM documents)
    SELECT pos, label, (sum(s) OVER (ORDER BY pos) - 1)::BIGINT AS label_id,
           len(string_split(translate(text, chr(10), ' '), ' '))::INTEGER AS n_words,
           md5(translate(text, chr(10), ' ')) AS digest
    FROM marks
    """,
)
def training_set(spark, d):
    rows, _ = training_set_with_ids(labelled_lines(spark, d, " "))
    return rows.select(
        "pos",
        "label",
        "label_id",
        F.size("words").alias("n_words"),
        F.md5(F.array_join("words", " ")).alias("digest"),
    )


SCORING_SQL = f"""
    WITH {TOKENS_SQL},
    weighted AS (SELECT doc_id, word, first_pos, round(tf * coalesce(idf, 0), 6) AS tfidf
                 FROM tf LEFT JOIN idf USING (word) ANTI JOIN common USING (word)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, first_pos) AS rank
               FROM weighted),
    lists50 AS (SELECT doc_id, string_agg(word, ' ' ORDER BY rank) AS words
                FROM ranked WHERE rank <= 50 GROUP BY doc_id)
"""


def scoring_inputs(spark, d):
    """Labelled lines, idf and stop-words; one pass over the corpus counts for both."""
    totals = materialise(terms.term_totals(corpus_words(spark, d)), "term-totals")
    frequent = totals.orderBy(F.desc("n"), "word").limit(STOPWORDS).select("word")
    stop = [row["word"] for row in frequent.collect()]  # STOPWORDS rows
    idf = materialise(terms.idf_of_totals(totals, documents(spark, d).count()), "idf")
    return labelled_lines(spark, d, "^^"), idf, stop


@query(
    "scoring_set",
    f"""
    {SCORING_SQL}
    SELECT doc_id AS pos, lang AS label, coalesce(words, '') AS words
    FROM documents LEFT JOIN lists50 USING (doc_id)
    """,
)
def scoring_set_query(spark, d):
    out = scoring_set(*scoring_inputs(spark, d))
    return out.withColumn("words", F.array_join("words", " "))


@query(
    "scoring_set_with_ids",
    f"""
    {SCORING_SQL},
    marks AS (SELECT doc_id, lang,
                     CASE WHEN lang = lag(lang, 1, '') OVER (ORDER BY doc_id) THEN 0 ELSE 1 END AS s
              FROM documents WHERE lang <> 'es'),
    runs AS (SELECT lang, sum(s) OVER (ORDER BY doc_id) - 1 AS run FROM marks),
    ids AS (SELECT lang, max(run)::BIGINT AS id FROM runs GROUP BY lang)
    SELECT doc_id AS pos, coalesce(id, 1) AS label_id, coalesce(words, '') AS words
    FROM documents LEFT JOIN ids USING (lang) LEFT JOIN lists50 USING (doc_id)
    """,
)
def scoring_set_with_ids_query(spark, d):
    """Labels are numbered without one class, which then gets the default id."""
    lines, idf, stop = scoring_inputs(spark, d)
    known = labelled_lines(spark, d, " ").where(~F.col("value").endswith(" es"))
    _, dictionary = training_set_with_ids(known)
    mapping = materialise(dictionary, "label-map")
    out = scoring_set_with_ids(lines, idf, stop, mapping)
    return out.select("pos", "label_id", F.array_join("words", " ").alias("words"))


QUERIES = registry.queries
SQL = registry.sql
