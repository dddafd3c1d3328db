"""Secrets in texts, and how widely each value is copied.

Matches are marked inside the text by one replacement per kind; cutting at the marks gives
the matches and, from the lengths of the pieces, their places in code points. Values are
counted over the corpus by distinct repositories (keys) and owners. A value that many
repositories or owners share is an example; one that few have is live-looking. The strict kinds are
always reported. The loose kinds (``token``, ``login``) would drown the result in ids and
examples, so their matches are reported only where the value is live-looking.

Only DataFrame functions; texts never move, only the found values do.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import materialise
from .arrays import starts
from .decisions import attach, row_hash

# The kinds in their order, the pattern, the group of the value.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
STRICT = (("assign", ASSIGN, 1), ("access", "(AKIA[A-Z0-9]{16,})", 1), ("hex", "([0-9a-f]{24,})", 1))
LOOSE = (
    ("token", "([A-Za-z0-9_-]{24,})", 1),
    ("login", r"://[^\x20\x09-\x0D:/@]+:([^\x20\x09-\x0D:/@]{6,})@", 1),
)
LEAST_VALUE = 6
#: A value that more owners than this have is an example.
MOST_OWNERS = 2
#: So is one that more repositories than this have, be it of one owner.
MOST_REPOSITORIES = 10
MARK, OTHER = "\x01", "\x02"


def _matches(text: Column, order: int, pattern: str, group: int) -> Column:
    """``array<struct<start, order, end, value>>`` of one kind."""
    pieces = F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)
    lengths = F.transform(pieces, lambda x: F.length(x).cast("bigint"))
    parts = F.arrays_zip(pieces.alias("piece"), starts(lengths).alias("start"))
    # every second piece is a match
    found = F.filter(parts, lambda x, i: i % 2 == 1)
    spans = F.transform(
        found,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(order).alias("order"),
            (x["start"] + F.length(x["piece"])).alias("end"),
            F.regexp_extract(x["piece"], pattern, group).alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<start:bigint,order:int,end:bigint,value:string>>"
KINDS = STRICT + LOOSE


def _kind(order: Column) -> Column:
    return F.element_at(F.array(*(F.lit(k[0]) for k in KINDS)), order + 1)


def _line(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    parts = F.transform(spans, lambda x: F.concat_ws(":", _kind(x["order"]), x["start"].cast("string"), x["end"].cast("string")))
    return F.concat_ws(",", parts)


def candidates(docs: DataFrame, key: str, text: str, owner: str) -> DataFrame:
    """``(_key, _hash, _owner, strict, loose)`` of every row; spans in order."""
    clean = F.translate(F.coalesce(F.col(text), F.lit("")), MARK, OTHER)
    found = docs.select(
        F.col(key).alias("_key"), row_hash(key, text).alias("_hash"),
        F.col(owner).cast("string").alias("_owner"), clean.alias("text"),
    )
    for i, (kind, pattern, group) in enumerate(KINDS):
        found = found.withColumn(kind, _matches(F.col("text"), i, pattern, group))
    long = F.filter("assign", lambda x: F.length(x["value"]) >= LEAST_VALUE)
    random = F.filter(
        "token",
        lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Z]") & x["value"].rlike("[a-z]"),
    )
    found = found.withColumn("strict", F.array_sort(F.concat(long, "access", "hex")))
    loose = F.filter(
        F.concat(random, "login"),
        lambda x: ~F.exists("strict", lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"])),
    )
    return found.select("_key", "_hash", "_owner", "strict", F.array_sort(loose).alias("loose"))


def _values(found: DataFrame) -> DataFrame:
    """One row for each row of the corpus and distinct value in it."""
    hashes = F.array_distinct(F.transform(F.concat("strict", "loose"), lambda x: F.sha2(x["value"], 256)))
    return found.where("size(strict) + size(loose) > 0").select(
        "_key", "_hash", "_owner", F.explode(hashes).alias("secret")
    )


def ownership(values: DataFrame) -> DataFrame:
    """``(secret, repositories, owners)``: distinct keys and distinct owners that have the value."""
    counts = [
        values.select("secret", of).distinct().groupBy("secret").agg(F.count(F.lit(1)).alias(name))
        for of, name in (("_key", "repositories"), ("_owner", "owners"))
    ]
    return counts[0].join(counts[1], "secret")


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source",
    most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """``(_key, _hash, base, spans, n_live, n_examples, repositories, owners)`` of every row.

    ``base`` are the spans of the strict kinds, ``spans`` all of them with the loose ones
    whose value is live-looking: ``array<struct<start, order, end, value>>`` in code points,
    end exclusive. ``n_live`` and ``n_examples`` count the row's distinct values by verdict;
    ``repositories`` and ``owners`` are the figures of its most widely copied value, 0 without any.
    A null text is empty and has no spans. Null owners count as one owner, null keys as one
    repository. Repeated rows get equal results and count once. Other columns aren't read; an empty table gives none.
    """
    found = materialise(candidates(docs, key, text, owner), "candidates")
    values = materialise(_values(found), "values")
    few = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    live = ownership(values).withColumn("live", few)
    verdicts = (
        values.select("_key", "_hash", "secret").distinct().join(live, "secret")
        .groupBy("_key", "_hash")
        .agg(
            F.collect_set(F.when(F.col("live"), F.col("secret"))).alias("own"),
            F.count_if("live").alias("n_live"),
            F.count_if(~F.col("live")).alias("n_examples"),
            F.max("repositories").alias("repositories"),
            F.max("owners").alias("owners"),
        )
        .withColumnsRenamed({"_key": "_k", "_hash": "_h"})
    )
    joined = found.join(verdicts, F.col("_hash").eqNullSafe(F.col("_h")) & F.col("_key").eqNullSafe(F.col("_k")), "left")
    added = F.filter("loose", lambda x: F.array_contains("own", F.sha2(x["value"], 256)))
    return joined.select(
        "_key", "_hash",
        F.col("strict").alias("base"),
        F.array_sort(F.concat("strict", F.coalesce(added, F.array().cast(SPANS)))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_examples", F.lit(0)).alias("n_examples"),
        F.coalesce("repositories", F.lit(0)).alias("repositories"),
        F.coalesce("owners", F.lit(0)).alias("owners"),
    )


def report(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, digest and span list of each row of :func:`scan`."""
    orders = F.transform("base", lambda x: x["order"])
    counts = [
        (F.size("base") - F.size(F.array_remove(orders, i))).cast("bigint").alias(f"n_{kind}")
        for i, (kind, _, _) in enumerate(STRICT)
    ]
    return scanned.select(
        F.col("_key").alias(key), *counts, F.sha2(_line(F.col("base")), 256).alias("base_sha256"),
        _line(F.col("spans")).alias("spans"), "n_live", "n_examples", "repositories", "owners",
    )


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """The same rows and columns; each run of touching or overlapping spans becomes ``[secret]``."""
    found = scan(docs, key, text, owner).where("size(spans) > 0")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("gaps"))
    gaps = F.aggregate(
        "spans",
        start,
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(
                (x["start"] > acc["at"]) | (F.size(acc["gaps"]) == 0),
                F.concat(acc["gaps"], F.array(F.struct(acc["at"].alias("a"), x["start"].alias("b")))),
            ).otherwise(acc["gaps"]).alias("gaps"),
        ),
    )
    found = found.select("_key", "_hash", gaps.alias("_gaps")).dropDuplicates(["_key", "_hash"])
    joined = attach(docs, materialise(found, "redactions"), key, text)
    cut = F.transform("_gaps.gaps", lambda g: F.substring(F.col(text), (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")))
    rest = F.substring(F.col(text), (F.col("_gaps.at") + 1).cast("int"), F.length(text))
    clean = F.concat(F.array_join(cut, "[secret]"), F.lit("[secret]"), rest)
    return joined.withColumn(text, F.when(F.col("_gaps").isNotNull(), clean).otherwise(F.col(text))).select(*docs.columns)
