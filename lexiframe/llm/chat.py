"""Conversations from reply trees: paths by self-joins, ranked branches, one text for each.

A message has a tree, a node and the node it replies to. Pointer doubling: in each round a
message learns the ancestor of its ancestor, so a path of n messages takes log2(n)
self-joins, and only messages that haven't reached a root take part; what a round knows is kept, and the messages of a chosen path are found by
jumping with these tables, longest jumps first. Only ids and scores are joined until the
branches are chosen. All of it is DataFrame functions.

Template: ``<|turn|>`` role, line feed, text, ``<|end|>``, line feed. No ``<|`` is left in
an escaped text, so the marks can't be forged.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.scratch import materialise
from .arrays import starts

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
LEARNT = "assistant"


def escape(text: Column) -> Column:
    """Backslashes double; then ``<|`` becomes ``<\\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role stands on one line: its line feeds become ``<\\n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def climb(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Path sums of every message, and for each k the pairs of a message and its 2^k-th ancestor.

    ``messages`` has ``tree, node, parent, score``. A parent that isn't there is none. The
    sums are ``(tree, node, total, steps)``; messages on a loop of replies have none.
    """
    known = messages.select(F.col("tree").alias("_tree"), F.col("node").alias("_node"))
    state = materialise(
        messages.join(known, [F.col("tree") == F.col("_tree"), F.col("parent") == F.col("_node")], "left").select(
            "tree", "node", F.col("_node").alias("up"), F.coalesce("score", F.lit(0.0)).alias("total"),
            F.lit(1).cast("bigint").alias("steps"),
        ),
        "climb-0",
    )
    rows = state.count()
    done, climbing, levels = [state.where("up is null")], state.where("up is not null"), []
    # a loop of replies climbs for ever, a path of all rows for log2(rows) rounds
    while (1 << len(levels)) < 2 * rows and not climbing.isEmpty():
        levels.append(climbing.select("tree", "node", "up"))
        above = reduce(DataFrame.union, done, climbing).select(
            F.col("tree").alias("_tree"), F.col("node").alias("_node"), F.col("up").alias("_up"),
            F.col("total").alias("_total"), F.col("steps").alias("_steps"),
        )
        state = materialise(
            climbing.join(above, [F.col("tree") == F.col("_tree"), F.col("up") == F.col("_node")]).select(
                "tree", "node", F.col("_up").alias("up"), (F.col("total") + F.col("_total")).alias("total"),
                (F.col("steps") + F.col("_steps")).alias("steps"),
            ),
            f"climb-{len(levels)}",
        )
        done, climbing = [*done, state.where("up is null")], state.where("up is not null")
    return reduce(DataFrame.union, done).drop("up"), levels


def paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """``(tree, leaf, rank, node, depth)`` of the ``branches`` best branches of each tree, or of all.

    A branch runs from a root to a message without replies; its score is the mean of its
    messages' scores (null: 0). Ties go to the longer branch, then the smaller leaf.
    """
    ids = materialise(messages.select("tree", "node", "parent", F.col("score").cast("double")), "replies")
    sums, levels = climb(ids)
    answered = ids.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("steps")), F.desc("steps"), "node")
    leaves = sums.join(answered, ["tree", "node"], "left_anti").withColumn("rank", F.row_number().over(best))
    if branches is not None:
        leaves = leaves.where(F.col("rank") <= branches)
    found = materialise(leaves.select("tree", F.col("node").alias("leaf"), "rank", "node", F.col("steps").alias("depth")), "leaves")
    for k in range(len(levels) - 1, -1, -1):
        jumps = found.join(levels[k], ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        found = materialise(found.union(jumps), f"path-{k}")
    return found


def conversations(messages: DataFrame, branches: int | None = None, learnt: str = LEARNT) -> DataFrame:
    """``(tree, leaf, rank, formatted, loss)``, one row for each chosen branch.

    ``messages`` has ``tree, node, parent, role, text, score``; nodes are unique in their tree.
    ``loss`` has a span (code points, end exclusive) for each turn: its escaped text if its
    role is ``learnt``, else nothing. Null roles and texts are empty; null trees or nodes are
    in no branch; further columns aren't read; an empty table gives none.
    """
    chosen = paths(messages, branches)
    turns = (
        chosen.join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
        .groupBy("tree", "leaf", "rank")
        .agg(F.array_sort(F.collect_list(F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    )
    parts = turns.select(
        "tree", "leaf", "rank",
        F.transform("turns", lambda t: F.struct(
            F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == learnt).alias("learnt"),
        )).alias("parts"),
    )
    lengths = F.transform("parts", lambda p: (F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).cast("bigint"))
    placed = parts.withColumn("at", starts(lengths))

    def span(part: Column, at: Column) -> Column:
        start = at + F.length(part["head"])
        return F.struct(start.alias("start"), F.when(part["learnt"], start + F.length(part["body"])).otherwise(start).alias("end"))

    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return placed.select("tree", "leaf", "rank", text.alias("formatted"), F.zip_with("parts", "at", span).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The columns of :func:`conversations` with ``turns``: ``array<struct<role, text, learnt>>``.

    ``learnt`` is the unescaped text under the loss mask. Everything is read from the
    formatted text and the spans.
    """
    pieces = F.slice(F.split("formatted", r"<\|turn\|>", -1), 2, 2**31 - 1)
    lengths = F.transform("pieces", lambda p: (F.length(p) + len(OPEN)).cast("bigint"))
    cut = formatted.withColumn("pieces", pieces).withColumn("at", starts(lengths))

    def turn(z: Column) -> Column:
        body = F.substring(z["piece"], F.lit(1), F.length(z["piece"]) - len(CLOSE))
        line = F.locate("\n", body)
        own = F.substring(
            z["piece"], (z["span"]["start"] - z["at"] - len(OPEN) + 1).cast("int"),
            (z["span"]["end"] - z["span"]["start"]).cast("int"),
        )
        return F.struct(
            unescape_role(F.substring(body, F.lit(1), line - 1)).alias("role"),
            unescape(F.substring(body, line + 1, F.length(body))).alias("text"),
            unescape(own).alias("learnt"),
        )

    zipped = F.arrays_zip(F.col("pieces").alias("piece"), F.col("at"), F.col("loss").alias("span"))
    return cut.withColumn("turns", F.transform(zipped, turn)).drop("pieces", "at")


def threads(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` rows as messages, each a reply to the one before.

    Equal turns go by role, then text; null turns come first. Rows without a conversation
    are one conversation of their own, whose tree is the empty string.
    """
    plain = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    placed = plain.withColumn("node", place.cast("bigint"))
    return placed.select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )
